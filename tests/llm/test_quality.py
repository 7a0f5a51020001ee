import math
import zlib

import numpy as np
import pytest
from conftest_llm import documents, rows_of

from cobble.llm import quality as Q
from cobble.llm.queries import op8_quality


def held_out(d):
    return d is None or zlib.crc32(str(d).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op8_quality(spark, sf).collect()
    assert all(r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.3) for r in rows)
    known = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = [s for s, y in known if y]
    bad = [s for s, y in known if not y]
    pairs = [(a > b) + 0.5 * (a == b) for a in good for b in bad]
    assert sum(pairs) / len(pairs) > 0.95
    assert sum(s >= 0.3 for s in good) / len(good) > 0.97


def test_updates_against_scalar_ftrl():
    """The vector updates equal the per-coordinate algorithm, one number at a time."""
    rng = np.random.default_rng(1)
    rows = [(rng.choice(50, 8, replace=False), rng.random(8), float(rng.integers(0, 2))) for _ in range(60)]
    z, n = [0.0] * 50, [0.0] * 50
    a, b, l1, l2 = 0.3, 1.0, 0.02, 0.1

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((b + math.sqrt(n[i])) / a + l2)

    for _ in range(2):
        for at, x, y in rows:
            w = {i: weight(i) for i in at}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at, x))))
            for i, v in zip(at, x):
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a * w[i]
                n[i] += g * g
    got = Q.ftrl(rows, 50, epochs=2, alpha=a, beta=b, l1=l1, l2=l2)
    assert got == pytest.approx([weight(i) for i in range(50)])


def test_scores_do_not_follow_the_held_out_labels(spark, real):
    docs = documents(spark, real)
    known = [(d, int(i % 3 > 0)) for i, (d, _) in enumerate(real)]
    schema = "doc_id bigint, quality int, text string"
    first = spark.createDataFrame([(d, y, "t") for d, y in known], schema)
    turned = spark.createDataFrame([(d, 1 - y if held_out(d) else y, "t") for d, y in known], schema)
    assert sorted(rows_of(Q.score_quality(docs, first))) == sorted(rows_of(Q.score_quality(docs, turned)))


def test_odd_texts_and_labels(spark, odd):
    docs = documents(spark, odd)
    labels = spark.createDataFrame([(1, 1), (2, None), (4, 0), (4, 1), (None, 1), (99, 1)], "doc_id bigint, quality int")
    rows = Q.score_quality(docs, labels).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id in (6, 7)}) == 1
    none = Q.score_quality(docs, labels.limit(0)).collect()
    assert len(none) == len(odd) and all(r.score == 0.5 for r in none)
    assert Q.score_quality(documents(spark, []), labels).count() == 0


def test_keep_good_keeps_columns(spark, real):
    docs = documents(spark, real)
    labels = spark.createDataFrame([(d, 1) for d, _ in real], "doc_id bigint, quality int")
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(real)
