import random

from test_decontam import words
from test_packing import check
from test_simhash import brute as components

import corpus_pipeline as C
from cobble.llm import decontam, packing, quality, secret_scan
from cobble.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def contaminated(text, windows):
    w = words(text)
    hit = {i + k for i in range(len(w) - 12) for k in range(13) if tuple(w[i : i + 13]) in windows}
    return len(hit) > 0 and 20 * len(hit) >= len(w)


def test_stages_against_brute_force(spark, sf):
    """Each stage on what the one before kept, against plain code; the last against run()."""
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in table(spark, sf, "documents").select(*COLUMNS).collect()]
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    assert all(len(words(t)) >= 13 for t in items if words(t))
    windows = {tuple(w[i : i + 13]) for w in map(words, items) for i in range(len(w) - 12)}
    weights = quality.quality_model(table(spark, sf, "documents"), table(spark, sf, "labels"))
    score = quality.scorer(weights.astype("float32").astype("float64"))
    allow = [secret_scan.re.compile(a, secret_scan.re.DOTALL) for a in secret_scan.ALLOW]

    def masked(r):
        text = secret_scan.masked(r[1], secret_scan.scan(r[1], allow)[1], "[SECRET]")
        return (r[0], text, r[2], r[3], len(text))

    plain = [
        lambda rows: [r for r in rows if score(r[1]) >= quality.GOOD],
        lambda rows: [r for r in rows if r[0] in {c for _, _, c in components([x[:2] for x in rows])}],
        lambda rows: [r for r in rows if not contaminated(r[1], windows)],
        lambda rows: [masked(r) for r in rows],
    ]
    for (_, stage), brute in zip(C.STAGES, plain):
        frame = stage(spark, spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"), sf)
        assert frame.columns == COLUMNS
        after = brute(docs)
        assert sorted(map(tuple, frame.collect())) == sorted(after)
        assert 0 < len(after) <= len(docs)
        docs = after
    rows = C.run(spark, sf).collect()
    check(rows, [(r[0], r[1], r[3]) for r in docs], packing.CAPACITY)


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, __score double, fp string"


def test_odd_rows_pass_every_stage(spark, sf, odd):
    rows = [(d, t, None, None, None, 0.5, "x") for d, t in odd]
    rng = random.Random(1)
    rng.shuffle(rows)
    for name, stage in C.STAGES:
        for docs in (rows, []):
            out = stage(spark, spark.createDataFrame(docs, ODD), sf)
            n = out.count()
            assert (n == 0) if not docs else n > 0, name
            if name != "packing":
                assert out.columns == [c.split()[0] for c in ODD.split(", ")]


def test_clean_documents_pass_decontamination_and_masking(spark, sf):
    docs = table(spark, sf, "documents").select(*COLUMNS).limit(50)
    none = table(spark, sf, "benchmark").limit(0)
    assert decontam.keep_clean(docs, none).count() == 50
    assert C.secret_stage(spark, docs, sf).count() == 50
