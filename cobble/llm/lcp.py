"""Document fingerprints by locally consistent parsing.

A text is parsed bottom up. On each level, runs of an equal symbol become one symbol; deterministic
coin tossing then labels every symbol by the lowest bit in which it differs from its left neighbour
and that bit's value, and repeats this on the labels until fewer than six are left, then three; the
labels' local maxima begin the phrases (two to four symbols), and a phrase's name, a hash of its
symbols, is a symbol of the next level. A boundary depends on a few symbols around it only, so equal
substrings, at whatever offset, get equal names but for their ends.

Levels go on to the root: where a text is down to ``FEW`` symbols or fewer, their name together is the
name of the whole text, so any edit, however small in however long a text, changes it.

The fingerprint holds that name, the ``UPPER`` smallest names of every level above the third, the
``KEEP`` smallest hashed names of level 3 (about 15 to 20 characters), and of levels 1 and 2 too for
texts under ``SHORT`` code points: ``top:<hex of root and upper names>;3:<hex...>;2:...;1:...``.
Likeness is 1 for equal fingerprints alone; else it estimates the Jaccard similarity of the name sets,
on the highest of the levels 1 to 3 where both have ``ENOUGH`` names, else the lowest that both have.
A sketch of fixed size can't show a short passage that two very long texts share; all phrases of a text,
with their places, are there for that: ``phrase_names``.

Null text: empty; two empty texts are alike by 1, an empty and another by 0. Texts are parsed whole;
memory follows the longest text. Order for neighbours: doc_id descending, nulls last, then text;
repeated rows are neighbours of each other. A single row is its own neighbour.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cobble.llm.common import materialize, partitions, prepare, slices, texts

KEEP, SHORT, ENOUGH, LEVELS = 48, 512, 6, 3
UPPER, FEW = 4, 4
#: Text bytes parsed at a time, so that the arrays stay in the processor's cache.
PARSE_BYTES = 1 << 19

_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _toss_table() -> np.ndarray:
    """New label for (left, own) labels below 128."""
    left, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    x = left ^ own
    low = np.bitwise_count((x & -x) - 1).astype(np.int64) * (x > 0)
    return (2 * low + (own >> low & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()
#: The smallest of 0, 1, 2 that neither neighbour has (3 to 6: not among them).
_FREE = np.array([[min({0, 1, 2} - {a, b}) for b in range(7)] for a in range(7)], np.uint8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x ^= x >> np.uint64(29)
    x = x * _PLACES[1]
    x ^= x >> np.uint64(32)
    return x


def labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0, 1, 2 of symbols that differ from their left neighbours; ``first`` marks beginnings of texts."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = symbols[first] ^ symbols.dtype.type(1)
    x = symbols ^ left
    low = np.bitwise_count((x & -x) - symbols.dtype.type(1)).astype(symbols.dtype)
    own = (2 * low + (symbols >> low & symbols.dtype.type(1))).astype(np.uint8)
    for _ in range(3):  # fewer than 128, 14, 8, 6 labels
        prev = np.empty_like(own)
        prev[1:] = own[:-1]
        prev[first] = own[first] ^ 1
        own = _TOSS[prev.astype(np.uint16) << 7 | own]
    last = np.append(first[1:] - 1, len(own) - 1)
    edged = np.empty(len(own) + 2, np.uint8)
    edged[0] = edged[-1] = 6
    edged[1:-1] = own
    begins, ends = np.zeros(len(own), bool), np.zeros(len(own), bool)
    begins[first], ends[last] = True, True
    for c in (5, 4, 3):
        at = np.flatnonzero(edged[1:-1] == c)
        a, b = edged[at], edged[at + 2]
        edged[at + 1] = _FREE[np.where(begins[at], 6, a), np.where(ends[at], 6, b)]
    return edged[1:-1]


def next_level(symbols: np.ndarray, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of non-empty texts, and where each text begins among them."""
    names, first, _ = _next_level(symbols, first, level)
    return names, first


def _next_level(symbols: np.ndarray, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``next_level``, and at which symbol each phrase begins."""
    if not len(symbols):
        return symbols.astype(np.uint64), first, np.zeros(0, np.int64)
    begins = np.zeros(len(symbols), bool)
    begins[first] = True
    new = begins.copy()
    new[1:] |= symbols[1:] != symbols[:-1]
    runs = np.flatnonzero(new)
    length = np.diff(runs, append=len(symbols))
    first = np.searchsorted(runs, first)
    symbols = symbols[runs]
    if (length > 1).any():
        symbols = symbols.astype(np.uint64)
        many = length > 1
        symbols[many] = _mix(symbols[many] + _PLACES[2] * length[many].astype(np.uint64))
    own = labels(symbols, first)
    peak = np.zeros(len(own), bool)
    peak[1:-1] = (own[1:-1] > own[:-2]) & (own[1:-1] > own[2:])
    # A text's ends have no neighbour beyond them.
    peak[first] = True
    last = np.append(first[1:] - 1, len(own) - 1)
    inner = last[last > 0]
    peak[inner] |= own[inner] > own[inner - 1]
    starts = np.flatnonzero(peak)
    place = np.arange(len(own)) - np.repeat(starts, np.diff(starts, append=len(own)))
    seeded = _mix(symbols.astype(np.uint64) + np.uint64(level + 1))
    names = _mix(np.add.reduceat(seeded * _PLACES[np.minimum(place, 4)] + place.astype(np.uint64), starts))
    return names, np.searchsorted(starts, first), runs[starts]


def _smallest(names: np.ndarray, keep: int = KEEP) -> str:
    kept = np.unique((names >> np.uint64(32)).astype(np.uint32))[:keep]
    return kept.astype(">u4").tobytes().hex()


def _root(symbols: np.ndarray, level: int) -> str:
    """The name of a whole text that is down to a few symbols."""
    place = np.arange(len(symbols), dtype=np.uint64)
    seeded = _mix(symbols.astype(np.uint64) + np.uint64(level + 1))
    return f"{int(_mix(np.array([(seeded * _PLACES[: len(symbols)] + place).sum(dtype=np.uint64)]))[0]):016x}"


def fingerprints_of(strings: list[str]) -> list[str]:
    """The fingerprints of some texts, parsed together."""
    full = [i for i, s in enumerate(strings) if s]
    out = ["top:;3:;2:;1:"] * len(strings)
    if not full:
        return out
    symbols = np.frombuffer("".join(strings[i] for i in full).encode("utf-32-le"), "<u4").astype(np.uint32)
    sizes = np.array([len(strings[i]) for i in full])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    parts: list[list[str]] = [[] for _ in full]
    tops, roots = [""] * len(full), [""] * len(full)
    open_ = list(range(len(full)))  # texts whose root is not reached yet
    level = 0
    while open_:
        level += 1
        symbols, first = next_level(symbols, first, level)
        ends = np.append(first[1:], len(symbols))
        still = np.ones(len(open_), bool)
        for k, j in enumerate(open_):
            own = symbols[first[k] : ends[k]]
            if level == LEVELS or level < LEVELS and sizes[j] < SHORT:
                parts[j].append(f"{level}:{_smallest(own)}")
            elif level > LEVELS:
                tops[j] += _smallest(own, UPPER)
            # Level 3 is always kept, so no text stops before.
            if level >= LEVELS and len(own) <= FEW:
                roots[j], still[k] = _root(own, level), False
        if not still.all():
            symbols = symbols[np.repeat(still, ends - first)]
            count = (ends - first)[still]
            first = np.cumsum(count) - count
            open_ = [j for j, on in zip(open_, still, strict=True) if on]
    for j, i in enumerate(full):
        out[i] = ";".join([f"top:{roots[j]}{tops[j]}", *reversed(parts[j])])
    return out


def phrases_of(text: str, level: int = LEVELS) -> list[tuple[int, int, int]]:
    """(name, start, end) in code points of every phrase of a level: names of 64 bits, as signed numbers."""
    if not text:
        return []
    symbols = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint32)
    first, starts = np.array([0]), np.arange(len(symbols))
    for k in range(1, level + 1):
        symbols, first, at = _next_level(symbols, first, k)
        starts = starts[at]
    ends = np.append(starts[1:], len(text))
    return list(zip(symbols.view(np.int64).tolist(), starts.tolist(), ends.tolist(), strict=True))


PHRASES = "doc_id bigint, name bigint, start bigint, stop bigint"


def phrase_names(docs: DataFrame, level: int = LEVELS) -> DataFrame:
    """``(doc_id, name, start, stop)`` of every phrase of a level in every whole text of ``docs`` (doc_id, text).

    Equal passages share all interior names wherever they stand, so a join on ``name`` finds passages that
    documents of any length have in common.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PHRASES.split(", ")]
        for batch in slices(batches, most=PARSE_BYTES):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = phrases_of(text, level)
                if found:
                    columns = [[doc] * len(found), *map(list, zip(*found, strict=True))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return texts(docs).mapInArrow(run, PHRASES)


def _sketch(fingerprint: str) -> dict[int, np.ndarray]:
    """Names by level, those of levels 1 to 3."""
    return {int(p[0]): np.frombuffer(bytes.fromhex(p[2:]), ">u4") for p in fingerprint.split(";")[1:]}


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard similarity of two fingerprints' names, 0 to 1."""
    if a == b:
        return 1.0
    x, y = _sketch(a), _sketch(b)
    both = sorted((k for k in x.keys() & y.keys() if len(x[k]) and len(y[k])), reverse=True)
    if not both:
        return 0.0
    level = next((k for k in both if min(len(x[k]), len(y[k])) >= ENOUGH), both[-1])
    p, q = x[level], y[level]
    union = np.union1d(p, q)[:KEEP]
    n, of = int(np.isin(union, p).astype(int) @ np.isin(union, q).astype(int)), len(union)
    # Texts with equal names that differ all the same are less than alike.
    return min(n / of, (of - 0.5) / of)


def edited(text: str, after: str) -> str:
    """The text with its last third replaced by as much of the beginning of the text after it."""
    cut = len(text) // 3
    return text[: len(text) - cut] + after[:cut]


ROWS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
ROWS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(k, pa.string()) for k in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)
#: The written form: digests and sketches in bytes, half as long as in hex.
_BYTES = ["sha", *(f"{k}{level}" for k in ("own", "new") for level in ("top", *range(LEVELS, 0, -1)))]
WRITTEN = (
    "doc_id bigint, n_chars bigint, " + ", ".join(f"{k} binary" for k in _BYTES) + ", near_edited double, "
    "near_next double, kind string, shard int, text string"
)
WRITTEN_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(k, pa.binary()) for k in _BYTES]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
    + [("kind", pa.string()), ("shard", pa.int32()), ("text", pa.string())]
)


def _in_bytes(fingerprint: str) -> list[bytes | None]:
    """The top and the names of each level from the highest on; None for a level that a fingerprint leaves out."""
    parts: list[bytes | None] = [bytes.fromhex(p.split(":")[1]) for p in fingerprint.split(";")]
    return parts + [None] * (1 + LEVELS - len(parts))


def _in_text(prefix: str):
    """The fingerprint column from its columns of bytes."""
    parts = [
        F.concat(F.lit(f"{level}:"), F.lower(F.hex(f"{prefix}{level}"))) for level in ("top", *range(LEVELS, 0, -1))
    ]
    return F.concat_ws(";", *parts)


def compared(rows: list[tuple[int | None, str, str]]) -> list[tuple]:
    """Result rows for (doc_id, text, next text)."""
    new = [edited(t, after) for _, t, after in rows]
    prints = fingerprints_of([t for _, t, _ in rows] + new + [after for _, _, after in rows])
    n = len(rows)
    return [
        (d, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, c))
        for (d, t, _), e, a, b, c in zip(rows, new, prints[:n], prints[n : 2 * n], prints[2 * n :], strict=True)
    ]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted documents with their next in the partition; its first and last text for the others."""
    shard, held, held_print = TaskContext.get().partitionId(), None, None

    def edge(kind: str, doc: int | None, text: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"kind": kind, "shard": shard, "doc_id": doc, "text": text}], schema=WRITTEN_ARROW)

    for batch in slices(batches, most=PARSE_BYTES):
        rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True))
        if held is None:
            yield edge("head", *rows[0])
        else:
            rows = [held, *rows]
        new = [edited(a, b) for (_, a), (_, b) in zip(rows, rows[1:], strict=False)]
        skip = held is not None
        prints = fingerprints_of([t for _, t in rows[skip:]] + new)
        own = [held_print] * skip + prints[: len(rows) - skip]
        cols = [
            (
                *(d, len(t), hashlib.sha256(e.encode()).digest(), *_in_bytes(a), *_in_bytes(b)),
                *(likeness(a, b), likeness(a, c), "row", shard, None),
            )
            for (d, t), e, a, b, c in zip(rows, new, own, prints[len(rows) - skip :], own[1:], strict=False)
        ]
        if cols:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*cols, strict=True), WRITTEN_ARROW, strict=True)],
                schema=WRITTEN_ARROW,
            )
        held, held_print = rows[-1], own[-1]
    if held is not None:
        yield edge("tail", *held)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "text", "after")), strict=True):
            cols = zip(*compared([row]), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, ROWS_ARROW, strict=True)], schema=ROWS_ARROW
            )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its and its edited text's fingerprint, and two likenesses.

    The documents are dealt out and sorted once; a task sees each document's next but for its last
    one. Those, one of each partition, meet the next partition's first in a second, small step.
    """
    spark = docs.sparkSession
    prepare(spark)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc(), F.col("text").asc()]
    ranged = texts(docs).repartitionByRange(partitions(spark), *order[:2]).sortWithinPartitions(*order)
    parsed = materialize(ranged.mapInArrow(_neighbours, WRITTEN), "lcp")
    tails = parsed.filter("kind = 'tail'").select("doc_id", "text", "shard")
    heads = parsed.filter("kind = 'head'").select("shard", F.col("text").alias("after"))
    # One row of each partition, whatever the data.
    turn = heads.select("shard").withColumn("next", F.lead("shard").over(W.orderBy("shard")))
    turn = turn.withColumn("next", F.coalesce("next", F.min("shard").over(W.partitionBy())))
    pairs = tails.join(turn, "shard").drop("shard").join(heads.withColumnRenamed("shard", "next"), "next")
    last = pairs.select("doc_id", "text", "after").mapInArrow(_compare, ROWS)
    names = [f.name for f in ROWS_ARROW]
    rows = parsed.filter("kind = 'row'").select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        _in_text("own").alias("fingerprint"),
        _in_text("new").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
    return rows.unionByName(last.select(*names))
