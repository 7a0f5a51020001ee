import hashlib
import random
import re

from conftest_llm import documents, rows_of

from cobble.llm import decontam as D
from cobble.llm.queries import op5_decontamination


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for d, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        found.discard(None)
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def plain(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, sf, real):
    items = rows_of(spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text"))
    want = brute(real, items)
    got = op5_decontamination(spark, sf).collect()
    digest = lambda items_: hashlib.sha256(",".join(sorted(map(str, items_))).encode()).hexdigest()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == sorted(
        ((d, n, h, len(i), digest(i), h > 0 and 20 * h >= n) for d, n, h, i in want), key=str
    )
    assert any(r.contaminated for r in got) and not all(r.contaminated for r in got)


P = "the quick brown fox jumps over the lazy dog and then runs far away home again"
ITEMS = [(1, P), (2, "Word"), (2, "two words"), (3, None), (4, "..."), (None, "three"), (5, P), (6, "end"), (7, "a a a")]
DOCS = [
    (40, f"x {P.upper()}! y {P}"),
    (41, P.replace("lazy", "very lazy")),
    (42, "the quick brown fox"),
    (43, "a a a a two-words THREE"),
    (44, "the quick brown fox jumps over"),
    (45, "the lazy dog and then runs far away home again"),
]


def bench(spark, items):
    return spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, block int")


def test_odd_texts(spark, odd):
    docs = documents(spark, odd + DOCS)
    want = brute(odd + DOCS, ITEMS)
    assert plain(D.search(D.build_index(docs), bench(spark, ITEMS))) == want
    # Small blocks, and a benchmark sent a few items at a time, give the same.
    assert plain(D.search(D.build_index(docs, block_words=3), bench(spark, ITEMS), query_bytes=30)) == want


def test_proximity_finds_edited_passages(spark):
    got = {r.doc_id: r.n_near for r in D.contamination(documents(spark, DOCS), bench(spark, [(1, P)])).collect()}
    assert got[40] > 0 and got[41] > 0 and got[42] == got[43] == 0


def test_matches_with_item_kind_and_place(spark):
    docs = documents(spark, DOCS)
    for options in ({}, {"query_bytes": 30}):
        got = {tuple(r) for r in D.matches(D.build_index(docs), bench(spark, ITEMS), **options).collect()}
        want = set()
        for d, text in DOCS:
            w = words(text)
            for item, t in ITEMS:
                own = words(t)
                for i in range(max(1, len(own) - 12) if own else 0):
                    window = own[i : i + 13]
                    want |= {(d, item, "phrase", k, k + len(window)) for k in range(len(w) - len(window) + 1) if w[k : k + len(window)] == window}
        assert {r for r in got if r[2] == "phrase"} == want
        near = {r for r in got if r[2] == "near"}
        assert (41, 1, "near", 0, 13) in near
        assert all(0 <= a < b <= len(words(dict(DOCS)[d])) for d, _, _, a, b in got)


def test_near_matches_stay_in_their_document(spark):
    """Seven words at one document's end and six at the next one's beginning are no match of either."""
    w = P.split()[:13]
    rows = [(1, "x y z " + " ".join(w[:7])), (2, " ".join(w[7:]) + " x y z"), (3, " ".join([*w[:7], "oops", *w[7:]]))]
    got = {(r.doc_id, r.kind) for r in D.matches(D.build_index(documents(spark, rows).coalesce(1)), bench(spark, [(1, " ".join(w))])).collect()}
    assert got == {(3, "near")}


def test_near_matches_against_brute_force(spark):
    """The tiles of items in random texts of few words: every place where enough words stand near by, if an
    anchor stands there."""
    rng = random.Random(17)
    pick = lambda n: [rng.choice("abcdefghijklmnop") for _ in range(n)]
    items = [(i, " ".join(pick(26))) for i in range(4)]
    docs = [(i, " ".join(pick(8) + [w if rng.random() < 0.9 else "q" for w in items[i % 4][1].split()] + pick(8))) for i in range(12)]
    got = {(r.doc_id, r.item_id, r.start) for r in D.matches(D.build_index(documents(spark, docs)), bench(spark, items), anchors=13).collect() if r.kind == "near"}
    want = set()
    for d, text in docs:
        w = words(text)
        for item, t in items:
            for at in (0, 13):
                tile = words(t)[at : at + 13]
                for s in range(-12, len(w)):
                    if not any(0 <= s + k < len(w) and w[s + k] == tile[k] for k in range(13)):
                        continue
                    agree = sum(any(w[p] == tile[k] for p in range(max(0, s + k - 3), min(len(w), s + k + 4))) for k in range(13))
                    if agree >= 10:
                        want.add((d, item, max(s, 0)))
    assert got == want and got


def test_no_items_and_no_documents(spark, odd):
    assert all(not r.contaminated for r in D.contamination(documents(spark, odd), bench(spark, [])).collect())
    assert D.contamination(documents(spark, []), bench(spark, ITEMS)).count() == 0


def test_keep_clean(spark, odd):
    rows = odd + DOCS + [(41, "other text under a used id")]
    kept = sorted(((r.doc_id, r.text) for r in D.keep_clean(documents(spark, rows), bench(spark, ITEMS)).collect()), key=str)
    want = []
    for d, t in rows:
        (_, n, h, _) = brute([(d, t)], ITEMS)[0]
        if not (h > 0 and 20 * h >= n):
            want.append((d, t))
    assert kept == sorted(want, key=str)
