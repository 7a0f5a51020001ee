"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

1. Lexicons: every word and every word beginning of 3 to 7 letters is counted, by documents, over at
   most ``TRAIN_ROWS`` labelled rows (hash-chosen, crc32(doc_id as text) mod 5 not 0; a documented
   bound); those that toxic documents hold far more often are the entries. They are dealt over
   voters by kind (length of the beginning, whole word) and by strength.
2. Voters: a lexicon voter votes on a text with an entry of its own. Pattern voters know common insults,
   insults addressed to someone, disguised spellings, and shouting. A text without any vote is voted
   clean by all.
3. Label model: the votes of all documents are counted by pattern (at most 2**voters rows, whatever
   the data). Expectation maximisation estimates the class balance, every voter's rate of voting
   in either class, and, from the joint votes, the correlation of every pair within the classes;
   correlated voters share their evidence (a voter's log-odds are divided by one plus its positive
   correlations), and the estimate is repeated with that. The start is the voters' rates among the
   labelled rows, whose labels also count as observations.
4. A linear classifier (hashed words, beginnings, votes; FTRL) is trained on the posterior labels of
   the same bounded rows and scores every text. A row's own label is one more voter in its posterior.

Null text: empty, no votes. Null labels are not used; without usable labels or entries the pattern
voters stay. Doc_ids labelled twice count once; repeated rows get a row each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import fsum, sqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobble.llm.common import materialize, prepare, slices, texts
from cobble.llm.quality import BITS, fold, sigmoid, train, training_rows

TRAIN_ROWS = 24_000
#: White-space-separated pieces remembered with their votes in a Python worker.
CACHE = 300_000
#: Lexicon entries: least toxic documents that hold one, least precision, and how many at most a kind.
LEAST_DOCS, LEAST_PRECISION, ENTRIES = 5, 0.5, 1000
BEGINNINGS = (3, 4, 5, 6, 7)
#: From this precision on an entry belongs to its kind's strong voter.
STRONG = 0.85
TOXIC = 0.5
ROUNDS = 50
#: How often a label is taken to be right: the rate of the voter that a row's own label is.
LABEL_RIGHT = 0.999

WORD = re.compile(r"[^\W\d_]+")
#: Public, general English insults; a fixed list.
INSULTS = frozenset(
    """asshole bastard bitch clown coward creep cretin disgusting dumb dumbass fool freak garbage
    idiot idiotic imbecile jerk liar loser moron moronic pathetic pig psycho scum scumbag sicko
    stupid trash ugly vermin vile weirdo worthless""".split()
)
ADDRESSED = re.compile(
    r"\b(?:you(?:'re| are)?|u r|shut up|go to hell|get lost)\b[^.!?\n]{0,30}\b(?:" + "|".join(sorted(INSULTS)) + r")s?\b",
    re.IGNORECASE,
)
DISGUISED = re.compile(
    r"(?:\b|(?<!\w))(?:[i1!]d[i1!][o0]t|m[o0]r[o0]n|l[o0]s[e3]r|s[ct]um|tr[a@4]sh|st[uv*]p[i1!*]d|d[u*]mb|sh[i1!*]t|f[u*@]ck|b[i1!*]tch)s?\b",
    re.IGNORECASE,
)
SHOUTED = re.compile(r"\b(?:" + "|".join(sorted(w.upper() for w in INSULTS)) + r")S?\b|!!!")
PATTERNS = ("insult", "disguised", "shouted", "addressed")


@dataclass
class Lexicon:
    """Entries of each voter: whole words (length 0) or beginnings of a length."""

    voters: list[tuple[str, int]] = field(default_factory=list)
    entries: list[frozenset[str]] = field(default_factory=list)

    def names(self) -> list[str]:
        return [v for v, _ in self.voters] + list(PATTERNS)


PUNCTUATION = ".,;:!?\"'()[]{}<>|&%$#*"


def tokens(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def piece_words(piece: str) -> list[str]:
    """The words of a white-space-separated piece; mostly it is one word with punctuation around."""
    low = piece.lower()
    bare = low.strip(PUNCTUATION)
    return [bare] if bare.isalpha() else WORD.findall(low)


def units(words: set[str]) -> set[tuple[int, str]]:
    """Whole words (0) and the beginnings of longer words."""
    out = {(0, w) for w in words}
    for k in BEGINNINGS:
        out.update((k, w[:k]) for w in words if len(w) > k)
    return out


def induce(rows: DataFrame) -> Lexicon:
    """Lexicon voters from labelled ``rows`` (doc_id, text, y), a bounded sample."""

    def counted(wanted: frozenset | None):
        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, most=1 << 20):
                seen: Counter = Counter()
                for text in batch.column("text").to_pylist():
                    own = units(tokens(text))
                    seen.update(own if wanted is None else own & wanted)
                kinds, words = zip(*seen, strict=True) if seen else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.int32()), pa.array(words, pa.string()), pa.array(list(seen.values()), pa.int64())],
                    names=["kind", "unit", "n"],
                )

        return spread

    def totals(part: DataFrame, wanted: frozenset | None) -> dict[tuple[int, str], int]:
        got = part.select("text").mapInArrow(counted(wanted), "kind int, unit string, n bigint")
        got = got.groupBy("kind", "unit").agg(F.sum("n").alias("n")).filter(F.col("n") >= (LEAST_DOCS if wanted is None else 1))
        return {(r.kind, r.unit): r.n for r in got.collect()}

    # Units of enough toxic rows, then how often the clean rows have those: both bounded by the sample.
    toxic = totals(rows.filter("y > 0"), None)
    clean = totals(rows.filter("y = 0"), frozenset(toxic)) if toxic else {}
    precision = {u: n / (n + clean.get(u, 0) + 1) for u, n in toxic.items()}
    best = sorted((u for u, p in precision.items() if p >= LEAST_PRECISION), key=lambda u: (-toxic[u], u))
    lexicon = Lexicon()
    for kind in (0, *BEGINNINGS):
        own = [u for u in best if u[0] == kind][:ENTRIES]
        for name, strong in (("strong", True), ("weak", False)):
            entries = frozenset(w for k, w in own if (precision[k, w] >= STRONG) == strong)
            if entries:
                lexicon.voters.append((f"{'word' if kind == 0 else f'begin{kind}'}_{name}", kind))
                lexicon.entries.append(entries)
    return lexicon


class Ballot:
    """Votes on texts; the votes of a white-space-separated piece are remembered."""

    def __init__(self, lexicon: Lexicon):
        self.by_kind: dict[int, dict[str, int]] = {}
        for k, ((_, kind), entries) in enumerate(zip(lexicon.voters, lexicon.entries, strict=True)):
            for w in entries:
                of = self.by_kind.setdefault(kind, {})
                of[w] = of.get(w, 0) | 1 << k
        self.first = len(lexicon.voters)
        # A word that begins like no entry and no insult gets no vote.
        self.starts = {w[:3] for entries in (*lexicon.entries, INSULTS) for w in entries}
        self.known: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        mask = 0
        for w in piece_words(piece):
            if w[:3] not in self.starts:
                continue
            for kind, of in self.by_kind.items():
                if kind == 0:
                    mask |= of.get(w, 0)
                elif len(w) > kind:
                    mask |= of.get(w[:kind], 0)
            if w in INSULTS or w[-1] == "s" and w[:-1] in INSULTS:
                mask |= 1 << self.first
        if DISGUISED.search(piece):
            mask |= 1 << self.first + 1
        # Neither a capital nor an exclamation: nothing is shouted.
        if ("!!!" in piece or not piece.islower()) and SHOUTED.search(piece):
            mask |= 1 << self.first + 2
        return mask

    def __call__(self, text: str) -> int:
        """The pattern of votes on a text: bit k is voter k's."""
        known, mask = self.known, 0
        for p in set(text.split()):
            m = known.get(p)
            if m is None:
                if len(known) >= CACHE:
                    known.clear()
                m = known[p] = self.piece(p)
            mask |= m
        if mask >> self.first & 1 and ADDRESSED.search(text):
            mask |= 1 << self.first + 3
        return mask


def count_patterns(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(pattern, n): how many rows of ``docs`` (doc_id, text) have each vote pattern."""
    return _patterns(docs.select("text"), lexicon).groupBy("pattern").agg(F.count("*").alias("n"))


def _patterns(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``rows`` with the pattern of votes on their text in its place."""
    held = rows.sparkSession.sparkContext.broadcast(lexicon)
    rest = [c for c in rows.columns if c != "text"]
    schema = ", ".join(["pattern bigint", *(f"{c} {dict(rows.dtypes)[c]}" for c in rest)])

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ballot = Ballot(held.value)
        for batch in slices(batches):
            got = pa.array([ballot(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([got, *(batch.column(c) for c in rest)], names=["pattern", *rest])

    return rows.mapInArrow(cast, schema)


@dataclass
class LabelModel:
    """P(toxic | votes) from rates, class balance and the weight that correlations leave a voter."""

    balance: float
    rates: np.ndarray  # (2, voters): how often a voter votes in the clean and the toxic class
    weight: np.ndarray
    correlations: np.ndarray

    def posterior(self, matrix: np.ndarray) -> np.ndarray:
        r = np.clip(self.rates, 1e-4, 1 - 1e-4)
        odds = np.where(matrix, np.log(r[1] / r[0]), np.log((1 - r[1]) / (1 - r[0])))
        z = np.log(self.balance / (1 - self.balance)) + (odds * self.weight).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_label_model(matrix: np.ndarray, n: np.ndarray, known: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """The label model of vote patterns ``matrix`` with counts ``n``; ``known`` (patterns, 2) counts labelled rows.

    The labelled rows' labels stand for their posterior; the other rows' posterior is estimated.
    """
    m = matrix.astype(float)
    labelled = known.sum(axis=1)
    free = np.maximum(n - labelled, 0.0)
    total = known.sum(axis=0)
    balance = float((total[1] + 1) / (total.sum() + 2)) if total.sum() else 0.1
    if total.sum():
        rates = np.stack([(known[:, c] @ m + 0.5 * (0.02 if c == 0 else 1)) / (total[c] + 1) for c in (0, 1)])
    else:
        share = n @ m / max(n.sum(), 1)
        rates = np.stack([share * 0.3, np.clip(share * 5, 0.2, 0.9)])
    model = LabelModel(balance, rates, np.ones(m.shape[1]), np.eye(m.shape[1]))
    for i in range(rounds):
        p = model.posterior(matrix)
        w = np.stack([free * (1 - p) + known[:, 0], free * p + known[:, 1]])
        if not w.sum():
            break  # no rows at all
        model.balance = float(np.clip(w[1].sum() / w.sum(), 1e-4, 0.999))
        model.rates = np.stack([(w[c] @ m + 0.01) / (w[c].sum() + 1) for c in (0, 1)])
        if i % 10 == 9:
            model.correlations = _correlations(m, w, model.rates)
            off = np.clip(model.correlations, 0, 1) - np.eye(m.shape[1])
            model.weight = 1 / (1 + off.clip(0).sum(axis=1))
    return model


def _correlations(m: np.ndarray, w: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Correlation of each pair of voters within the classes, averaged by class size."""
    out = np.zeros((m.shape[1], m.shape[1]))
    for c in (0, 1):
        d = m - rates[c]
        cov = (d * w[c][:, None]).T @ d
        scale = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
        out += cov / np.outer(scale, scale) * w[c].sum() / w.sum()
    np.fill_diagonal(out, 1.0)
    return out


def with_label(posterior: float, toxic: bool) -> float:
    """A row's posterior with its label as one more voter, right in ``LABEL_RIGHT`` of all cases in either class."""
    odds = posterior / (1 - posterior) * (LABEL_RIGHT / (1 - LABEL_RIGHT)) ** (1 if toxic else -1)
    return odds / (1 + odds)


def hashed(piece: str, low: int, size: int) -> list[int]:
    """Places of a piece's words and their beginnings of 5 and 6 letters, from ``low`` to ``size``."""
    own, room = [], size - low
    for w in piece_words(piece):
        own.append(low + crc32(w.encode()) % room)
        if len(w) > 5:
            own.append(low + crc32(w[:5].encode(), 5) % room)
        if len(w) > 6:
            own.append(low + crc32(w[:6].encode(), 6) % room)
    return own


class Features:
    """Features of a text: a place for each vote given or not, and the hashed units of its pieces.

    The units share a length that falls with their number, so long texts don't outweigh their votes.
    """

    def __init__(self, lexicon: Lexicon, bits: int = BITS):
        self.ballot, self.size = Ballot(lexicon), 1 << bits
        self.n = len(lexicon.names())
        self.low = 1 + 2 * self.n

    def flags(self, mask: int) -> list[int]:
        return [1 + 2 * k + (mask >> k & 1) for k in range(self.n)]

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at = [u for p in set(text.split()) for u in hashed(p, self.low, self.size)]
        places, counts = np.unique(np.array(at, np.int64), return_counts=True)
        flags = self.flags(self.ballot(text))
        values = counts * (0.5 / np.sqrt(max(len(at), 1)))
        return np.array([0, *flags, *places.tolist()], np.int64), np.concatenate([np.ones(1 + self.n), values])


class Scorer(Features):
    """Sparse dot products of texts with weights; a piece's share of them is remembered."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray, bits: int = BITS):
        super().__init__(lexicon, bits)
        self.weights: list[float] = weights.tolist()
        self.known: dict[str, tuple[int, float, int]] = {}

    def learn(self, piece: str) -> tuple[int, float, int]:
        if len(self.known) >= CACHE:
            self.known.clear()
        weights, at = self.weights, hashed(piece, self.low, self.size)
        got = self.known[piece] = (self.ballot.piece(piece), sum([weights[i] for i in at]), len(at))
        return got

    def __call__(self, text: str) -> float:
        known, learn = self.known.get, self.learn
        got = [known(p) or learn(p) for p in set(text.split())]
        mask = n = 0
        for m, _, k in got:
            mask |= m
            n += k
        if mask >> self.ballot.first & 1 and ADDRESSED.search(text):
            mask |= 1 << self.ballot.first + 3
        weights = self.weights
        # fsum: the same whatever the order of the pieces.
        z = fsum(d for _, d, _ in got) * (0.5 / sqrt(max(n, 1))) + weights[0]
        return float(sigmoid(z + sum([weights[i] for i in self.flags(mask)])))


def toxicity_model(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[Lexicon, LabelModel, np.ndarray]:
    """Lexicon voters, label model, and classifier weights for ``docs`` and ``labels``."""
    spark = docs.sparkSession
    prepare(spark)
    docs = texts(docs)
    rows = materialize(training_rows(docs, labels, "toxic", most), "toxic-rows")
    lexicon = induce(rows)
    # Patterns: at most 2 ** voters, and far fewer in practice; the counts cover every document.
    counted = {r.pattern: r.n for r in count_patterns(docs, lexicon).collect()}
    gold = _patterns(rows.select("text", "y"), lexicon).groupBy("pattern", "y").count().collect()
    patterns = sorted(counted.keys() | {r.pattern for r in gold} | {0})
    at = {p: i for i, p in enumerate(patterns)}
    matrix = np.array([[p >> k & 1 for k in range(len(lexicon.names()))] for p in patterns], bool)
    known = np.zeros((len(patterns), 2))
    for r in gold:
        known[at[r.pattern], int(r.y > 0)] += r["count"]
    model = fit_label_model(matrix, np.array([counted.get(p, 0) for p in patterns], float), known)
    posterior = dict(zip(patterns, model.posterior(matrix).tolist(), strict=True))
    held, soft = spark.sparkContext.broadcast(lexicon), spark.sparkContext.broadcast(posterior)

    def relabel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ballot = Ballot(held.value)
        for batch in slices(batches):
            pairs = zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True)
            got = pa.array([with_label(soft.value[ballot(t)], y > 0) for t, y in pairs])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), got], names=["doc_id", "text", "y"])

    taught = rows.select("doc_id", "text", "y").mapInArrow(relabel, "doc_id bigint, text string, y double")
    return lexicon, model, train(taught, Features(lexicon))


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    lexicon, _, weights = toxicity_model(docs, labels, most)
    held = docs.sparkSession.sparkContext.broadcast((lexicon, weights))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*held.value)
        for batch in slices(batches):
            got = [scorer(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return texts(docs).mapInArrow(rate, "doc_id bigint, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )
