import random
import zlib

import numpy as np
import pytest
from conftest_llm import documents

from cobble.llm import toxicity as T
from cobble.llm.queries import op10_toxicity


def held_out(d):
    return d is None or zlib.crc32(str(d).encode()) % 5 == 0


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op10_toxicity(spark, sf).collect()
    assert all(r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.5) for r in rows)
    known = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in known if y], [s for s, y in known if not y]
    assert sum(s >= 0.5 for s in clean) / len(clean) < 0.02
    assert sum(s >= 0.5 for s in toxic) / len(toxic) > 0.8
    assert np.mean([[a > b for a in toxic] for b in clean]) > 0.95


def drawn(rng, n, balance, rates):
    y = rng.random(n) < balance
    votes = rng.random((n, rates.shape[1])) < rates[y.astype(int)]
    return y, votes


def patterns(y, votes, labelled):
    rows, at = np.unique(votes, axis=0, return_inverse=True)
    known = np.zeros((len(rows), 2))
    np.add.at(known, (at[:labelled], y[:labelled].astype(int)), 1)
    return rows, np.bincount(at, minlength=len(rows)).astype(float), known, at


def test_label_model_recovers_rates():
    rng = np.random.default_rng(7)
    rates = np.array([[0.02, 0.05, 0.01, 0.10], [0.70, 0.60, 0.40, 0.80]])
    y, votes = drawn(rng, 40_000, 0.15, rates)
    rows, n, known, at = patterns(y, votes, 300)
    model = T.fit_label_model(rows, n, known)
    assert model.balance == pytest.approx(0.15, abs=0.03)
    assert model.rates == pytest.approx(rates, abs=0.08)
    assert ((model.posterior(rows)[at] > 0.5) == y).mean() > 0.95


def test_correlated_voters_share_their_weight():
    rng = np.random.default_rng(8)
    rates = np.array([[0.03, 0.03, 0.03], [0.6, 0.6, 0.6]])
    y, votes = drawn(rng, 30_000, 0.2, rates)
    votes = np.column_stack([votes, votes[:, 0], votes[:, 0]])  # two copies of the first voter
    rows, n, known, _ = patterns(y, votes, 1000)
    model = T.fit_label_model(rows, n, known)
    assert model.correlations[0, 3] > 0.9 and abs(model.correlations[1, 2]) < 0.2
    assert model.weight[0] < 0.5 < model.weight[1]


def test_a_label_is_one_more_voter():
    """The posterior with a label equals Bayes' rule with a voter of known rates."""
    rng = np.random.default_rng(4)
    for p in rng.random(50):
        for toxic in (True, False):
            right = T.LABEL_RIGHT
            yes, no = (p * right, (1 - p) * (1 - right)) if toxic else (p * (1 - right), (1 - p) * right)
            assert T.with_label(p, toxic) == pytest.approx(yes / (yes + no))


def test_ballot_against_plain_votes():
    lexicon = T.Lexicon([("word_strong", 0), ("begin3_weak", 3)], [frozenset({"bad", "worse"}), frozenset({"vil"})])
    ballot = T.Ballot(lexicon)
    names = lexicon.names()
    votes = lambda text: {names[k] for k in range(len(names)) if ballot(text) >> k & 1}
    assert votes("") == set()
    assert votes("All is well, (Bad) though") == {"word_strong"}
    assert votes("vile vil") == {"begin3_weak", "insult"}
    assert votes("you are an IDIOT!!!") == {"insult", "disguised", "shouted", "addressed"}
    assert votes("what an 1d!0t") == {"disguised"}
    assert votes("idiots") == {"insult", "disguised"}


def test_pattern_voters_see_whole_pieces():
    ballot = T.Ballot(T.Lexicon())
    votes = lambda text: {n for k, n in enumerate(T.PATTERNS) if ballot(text) >> k & 1}
    for text in ("fuck", "so shit.", "stvpid", "1d10t/m0ron", "a tr@sh-talk show", "(!d!ot)", "you!diot"):
        assert votes(text) == {"disguised"}, text
    assert votes("idiot!") == votes("idiot.") == {"insult", "disguised"}
    assert votes("he/SCUMBAG/she") == {"insult", "shouted"}
    assert votes("no!!!") == {"shouted"}
    assert votes("shitake f_ck tr@shed drum lower Case") == set()
    assert T.TRAIN_ROWS == 24_000


def test_scorer_equals_the_training_features():
    lexicon = T.Lexicon([("word_strong", 0)], [frozenset({"bad"})])
    rng = np.random.default_rng(3)
    weights = rng.normal(size=1 << T.BITS)
    features, scorer = T.Features(lexicon), T.Scorer(lexicon, weights)
    for text in ("", "one two two", "bad idiot, you are an idiot", "Überlänge längere x-y z_1 " * 50):
        at, values = features(text)
        assert scorer(text) == pytest.approx(T.sigmoid(weights[at] @ values))


def test_odd_texts_and_labels(spark, odd):
    docs = documents(spark, odd)
    labels = spark.createDataFrame([(1, 1), (2, None), (4, 0), (4, 1), (None, 1), (99, 1)], "doc_id bigint, toxic int")
    rows = T.score_toxicity(docs, labels).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (6, 7)}) == 1
    assert T.score_toxicity(docs, labels.limit(0)).count() == len(odd)
    assert T.score_toxicity(documents(spark, []), labels).count() == 0


def test_planted_lexicon_is_found(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(300)]
    rows, known = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            text[rng.randrange(60)] = "zzq" + rng.choice(words)
        rows.append((i, " ".join(text)))
        known.append((i, int(toxic)))
    labels = spark.createDataFrame([k for k in known if not held_out(k[0])], "doc_id bigint, toxic int")
    got = {r.doc_id: r.predicted for r in T.score_toxicity(documents(spark, rows), labels).collect() if r.held_out}
    assert np.mean([got[i] == y for i, y in known if held_out(i)]) > 0.95
