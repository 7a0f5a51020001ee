import random
import re
from collections import Counter, defaultdict

import pytest
from conftest_llm import rows_of

from cobble.llm import url_filters as U
from cobble.llm.queries import op7_urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def rule(host, path):
    best = None
    for name, prefix, verdict in RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(prefix):
            if best is None or len(name + prefix) > len(best[0]):
                best = (name + prefix, verdict)
    return best


def named(html):
    """Hosts of links, and names of three or more labels, written down without the operator's pattern."""
    found, html = set(), html or ""
    link = r"[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
    spots = [(m.start(), m.end()) for m in re.finditer("://" + link, html)]
    spots += [(m.start(1), m.end(1)) for m in re.finditer("[\"'=](//" + link + ")", html)]
    taken = 0
    for a, b in sorted(spots + [m.span() for m in re.finditer(r"(?:[A-Za-z0-9-]+\.){2,}[A-Za-z]{2,}", html)]):
        text = html[a:b]
        if a < taken:
            continue
        if not text.startswith((":", "/")):
            before, after = html[a - 1 : a], html[b : b + 2]
            if re.match(r"[\w@./-]", before, re.ASCII) or re.match(r"[\w@-]|\.\w", after, re.ASCII):
                continue
        taken = b
        found.add("".join(c.lower() if c.isascii() else c for c in text.lstrip(":/")))
    return found


def brute(pages):
    edges, allow, block, n = Counter(), Counter(), Counter(), Counter()
    for _, url, html in pages:
        host, path = parts(url)
        if host:
            n[host] += 1
            fit = rule(host, path)
            allow[host] += fit is not None and fit[1] == "allow"
            block[host] += fit is not None and fit[1] == "block"
            for other in named(html) - {host}:
                edges[host, other] += 1
    total = Counter()
    for (a, _), w in edges.items():
        total[a] += w

    def settle(flows, seed):
        """Scores of flows (from, to, share), until they stand still."""
        base = {h: 0.15 * s for h, s in seed.items() if s > 0}
        score = dict(base)
        for _ in range(300):
            new = defaultdict(float, base)
            for a, b, share in flows:
                new[b] += 0.85 * score.get(a, 0.0) * share
            score = dict(new)
        return score

    trust = settle([(a, b, w / total[a]) for (a, b), w in edges.items()], {h: allow[h] / n[h] for h in n})
    distrust = settle([(b, a, w / total[a]) for (a, b), w in edges.items()], {h: block[h] / n[h] for h in n})
    out = []
    for page, url, _ in pages:
        host, path = parts(url)
        fit = rule(host, path)
        t, d = trust.get(host, 0.0), distrust.get(host, 0.0)
        own = "block" if d >= 0.5 * 0.15 and d > t else "allow"
        out.append((page, host, path, fit and fit[0], fit[1] if fit else own, t, d))
    return sorted(out, key=str)


def check(df, pages):
    got, want = sorted(rows_of(df), key=str), brute(pages)
    by = lambda rows: sorted((r[:5] for r in rows), key=str)
    assert by(got) == by(want)
    scores = {r[1]: r[5:] for r in want}
    for r in got:
        assert r[5:] == pytest.approx(scores[r[1]], abs=2e-3)


def test_query_against_brute_force(spark, sf):
    pages = rows_of(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html"))
    check(op7_urls(spark, sf), pages)


LINK = '<a href="http://{}/x">x</a>'
PAGES = [
    (1, None, None),
    (2, "no scheme here/de/", LINK.format("a.example.com")),
    (3, "http://", ""),
    (4, "HTTP://A.Example.COM/de/x?y#z", LINK.format("b.example.org") * 3),
    (5, "http://b.example.org?x://c/fr/", LINK.format("a.example.com")),
    (6, "http://c.example.org/none#/fr/", LINK.format("A.EXAMPLE.com") + LINK.format("spam.net")),
    (7, "https://spam.net/", "mail@x.spam.com or www.c.example.org or index.html."),
    (8, "http://evilnet/", LINK.format("spam.net") * 2),
    (9, "http://x.net", "path only counts from its slash: http://spam.net"),
    (10, "http://example.net/en/1", None),
    (10, "http://example.net/en/1", None),
    (11, "http://sub.example.net/en", LINK.format("example.net")),
    (12, "a://b://c.net/x", ""),
    (13, "http://münchen.Ärzte.net/Ü/ß?", ""),
    (14, "ftp://org/fr/", LINK.format("friend.info") * 2 + "x" * 200_000),
    (15, "http://friend.info/", LINK.format("third.info")),
    (16, "http://third.info/a", ""),
    (17, "http://bad.info/a", LINK.format("only.net")),
    (18, "http://worse.info/a", LINK.format("bad.info")),
    (19, "http://only.net/", None),
    (20, "http://relative.info/", "<link href='//only.net/x'><img src=\"//only.net\"> a//friend.info, (//third.info)"),
    (21, "http://plain.info/", "<a href=\"/a/b\">x</a> <a href=page.html>y</a>"),
]
SCHEMA = "page_id bigint, url string, html string, host string, path int, rule int"


def frame(spark, pages):
    return spark.createDataFrame([(*p, "h", 1, 2) for p in pages], SCHEMA)


def test_odd_pages(spark):
    check(U.judge_urls(frame(spark, PAGES)), PAGES)


def test_distrust_reaches_those_who_link_to_blocked_hosts(spark):
    verdicts = {r.page_id: r.verdict for r in U.judge_urls(frame(spark, PAGES)).collect()}
    assert verdicts[7] == "block"  # by rule
    assert verdicts[17] == "block" and verdicts[18] == "block"  # by links to a blocked host, directly and further off
    assert verdicts[15] == verdicts[16] == "allow"


@pytest.mark.parametrize("linkers", [1, 2, 3, 10, 1000])
def test_popular_blocked_hosts_still_spread_distrust(spark, linkers):
    pages = [(0, "http://spam.net/", "")]
    pages += [(i, f"http://h{i}.info/", LINK.format("spam.net")) for i in range(1, linkers + 1)]
    pages += [(-i, f"http://mixed{i}.info/", LINK.format("spam.net") + LINK.format("a.info") + LINK.format("b.info")) for i in range(1, 4)]
    got = {r.page_id: r.verdict for r in U.judge_urls(frame(spark, pages)).collect()}
    assert all(got[i] == "block" for i in range(linkers + 1))
    assert all(got[-i] == "allow" for i in range(1, 4))


def test_generated_graph(spark):
    """Hosts that link to a few of their own kind; some kinds have blocked or allowed members."""
    rng = random.Random(9)
    hosts = [f"h{i}.{'net' if i % 17 == 0 else 'org' if i % 7 == 0 else 'info'}" for i in range(150)]
    pages = []
    for i, h in enumerate(hosts):
        for k in range(rng.randrange(1, 4)):
            to = [hosts[(i + 3 * rng.randrange(1, 20)) % 150] for _ in range(rng.randrange(4))]
            path = "/fr/x" if rng.random() < 0.5 else "/x"
            pages.append((10 * i + k, f"http://{h}{path}", "".join(LINK.format(t) for t in to)))
    check(U.judge_urls(frame(spark, pages)), pages)


def test_pages_without_links(spark):
    pages = [(i, f"http://h{i}.{'net' if i % 2 else 'info'}/", "no links, and a file.html") for i in range(6)]
    check(U.judge_urls(frame(spark, pages)), pages)


def test_native_plan(spark):
    plan = U.judge_urls(frame(spark, PAGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert U.judge_urls(frame(spark, [])).count() == 0
