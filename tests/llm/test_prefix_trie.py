import hashlib
import random
import zlib
from collections import defaultdict

from cobble.llm import prefix_trie
from cobble.llm.queries import op11_prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n bigint, path string, depth bigint, e1 string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "p", 1, "x") for r in rows], SCHEMA)


def brute(rows):
    """Every prefix of every rebuilt conversation in a dictionary."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if built[c] == p)
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), children[p], leaves[p], saved[p], sha))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_all_prefixes(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_prefix_trie(spark, sf)) == brute(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_CHARS", 8)
    rows = [
        (None, 0, "user", "nobody"),
        (700, None, None, None),
        (700, 1, "user", "a"),
        (700, 1, "user", "a"),
        (700, 1, None, "b"),
        (701, 0, "user", "\U0001f600 long " * 5000),
        (702, 5, "", ""),
        (-3, 0, "user", "x"),
        (-250, 0, "user", "x"),
        (0, 0, "user", "x"),
    ]
    # Copies whose ids fill several blocks, conversations that lose all their turns, one deep conversation and its copy.
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1400, 100) for t in range(3)]
    rows += [(c, 0, "user", "gone") for c in range(5001, 5030)]
    rows += [(c, t, "user", f"deep {t}") for c in (2000, 2100, 2200) for t in range(60 if c < 2200 else 40)]
    assert got(prefix_trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_random_families(spark):
    rng = random.Random(4)
    rows = [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "ab", None, "é"]))
        for c in [*range(0, 40), *range(100, 140), *range(305, 330)]
        for t in range(rng.randrange(1, 9))
    ]
    assert got(prefix_trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_empty(spark):
    assert prefix_trie.prefix_trie(table(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(table(spark, [(None, 1, "user", "x")])).collect() == []
