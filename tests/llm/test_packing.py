import random
import re
from collections import Counter, defaultdict

from conftest_llm import documents, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cobble.llm import packing as P
from cobble.llm.queries import op9_packing


def brute(sizes, sources, clusters, capacity):
    """Every bin looked at for every document."""
    bins, places, rests = [], [], []
    for i, n in enumerate(sizes):
        for part in range(n // capacity):
            places.append((len(bins), i, part, capacity))
            bins.append([0, set(), set()])
        if n % capacity:
            rests.append((n % capacity, i, n // capacity))
    for n, i, part in sorted(rests, key=lambda r: (-r[0], r[1])):
        fit = [
            (b[0], k) for k, b in enumerate(bins) if b[0] >= n and sources[i] not in b[1] and clusters[i] not in b[2]
        ]
        if fit:
            k = min(fit)[1]
        else:
            k = len(bins)
            bins.append([capacity, set(), set()])
        bins[k][0] -= n
        bins[k][1].add(sources[i])
        bins[k][2].add(clusters[i])
        places.append((k, i, part, n))
    return places, [b[0] for b in bins]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 25), st.integers(0, 4), st.integers(0, 6)), max_size=60))
def test_tightest_compatible_bin(items):
    sizes, sources, clusters = ([x[k] for x in items] for k in range(3))
    assert P.pack_shard(sizes, sources, clusters, 10) == brute(sizes, sources, clusters, 10)


def test_hot_source():
    rng = random.Random(3)
    n = 1500
    sizes, sources = [rng.randrange(1, 400) for _ in range(n)], [0 if rng.random() < 0.5 else rng.randrange(12) for _ in range(n)]
    clusters = [rng.randrange(300) if rng.random() < 0.5 else 1000 + i for i in range(n)]
    assert P.pack_shard(sizes, sources, clusters, 1000) == brute(sizes, sources, clusters, 1000)


def check(rows, docs, capacity):
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for _, t, *_ in docs]
    assert sum(r.n_tokens for r in rows) == sum(words)
    want = Counter()
    for (d, *_), n in zip(docs, words):
        want.update((d, p) for p in range(-(-n // capacity)))
    assert Counter((r.doc_id, r.part) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert sum(r.n_tokens for r in own) + own[0].room == capacity and own[0].room >= 0
        assert [r.start for r in own] == [sum(x.n_tokens for x in own[:k]) for k in range(len(own))]
        assert len({r.source for r in own}) == len(own)
        known = [r.cluster for r in own if r.cluster is not None]
        assert len(set(known)) == len(known)


def test_query(spark, sf):
    docs = rows_of(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source"))
    rows = op9_packing(spark, sf).collect()
    check(rows, docs, P.CAPACITY)
    assert len({r.bin_id for r in rows}) < 0.8 * len(rows)


def test_odd_texts_over_shards(spark, odd):
    rows = [(d, t, None if i % 3 == 0 else f"src{i % 2}") for i, (d, t) in enumerate(odd * 3)]
    check(P.pack(documents(spark, rows), capacity=100, shard_docs=5).collect(), rows, 100)


def test_copies_part_company(spark):
    rows = [(i, "Same  text\nhere" if i % 2 else "same text here", f"s{i}") for i in range(10)]
    got = P.pack(documents(spark, rows), capacity=50).collect()
    assert len({r.bin_id for r in got}) == 10
    apart = P.pack(documents(spark, [(i, f"text {i}", f"s{i}") for i in range(10)]), capacity=50).collect()
    assert len({r.bin_id for r in apart}) == 1


def test_near_copies_part_company(spark, tmp_path):
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}é" for _ in range(4000)]
    text = " ".join(words)
    changed = " ".join([*words[:2000], "other", *words[2001:]])
    texts = [text, changed, f"{text} all rights reserved", changed.upper(), "another text", None, ""]
    ids = [1, 2, 2, None, 2, 5, 6]  # ids repeat and lack; the texts tell the rows apart
    rows = [(d, t, f"s{i}", 0) for i, (d, t) in enumerate(zip(ids, texts))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int")
    exact = P.pack(docs, capacity=20_000).collect()
    assert len({r.bin_id for r in exact}) == 2  # only the upper-case copy is kept apart
    near = P.pack_apart(docs, capacity=20_000).collect()
    long = [r for r in near if r.n_tokens > 4000]
    assert len({r.bin_id for r in long}) == 4 and len({r.cluster for r in long}) == 1
    assert len(near) == 7 and len({r.cluster for r in near}) == 3
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [r for r in op9_packing(spark, str(tmp_path)).collect() if r.n_tokens < 2048 and r.part == 1]
    assert len({r.bin_id for r in got}) == len(got) == 4


def test_one_pass_measures_what_the_columns_do(spark, odd):
    docs = documents(spark, [*odd, (11, "Ünd  GROSS\u00a0klein\tİ")])
    text = F.coalesce("text", F.lit(""))
    want = docs.select("doc_id", P.text_cluster(text).alias("cluster"), (P.word_count(text) + 1).alias("n_tokens"))
    got = P.measured(docs).select("doc_id", "cluster", "n_tokens")
    assert sorted(rows_of(got), key=str) == sorted(rows_of(want), key=str)


def test_a_source_in_most_rows(spark, tmp_path):
    """The whole query where one source holds two thirds of the rows."""
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{rng.randrange(999)}" for _ in range(rng.randrange(900))), "hot" if i % 3 else f"s{i}", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op9_packing(spark, str(tmp_path)).collect()
    check(got, [r[:3] for r in rows], P.CAPACITY)
    assert len({r.bin_id for r in got if r.source == "hot"}) == sum(r.source == "hot" for r in got)


def test_empty(spark):
    assert P.pack(documents(spark, [])).count() == 0
    assert P.pack_apart(documents(spark, [])).count() == 0
