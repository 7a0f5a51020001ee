"""Benchmark decontamination over a distributed positional inverted index.

Index: documents are gathered into blocks of about ``BLOCK_WORDS`` words. A block stores, for every
distinct word in it, the ascending positions of its occurrences (delta-coded, zstandard), and the
documents' lengths; one unused position stands between documents, so no phrase crosses two. The
blocks are a written table: any number of searches may read it.

Search: a window is ``WINDOW`` consecutive words of an item (an item with fewer, but not none, is one
window). In each block a window with an absent word is out at once. For the others the posting list
of the window's rarest word, shifted by its offset, gives the possible starts; the next rarest lists,
shifted likewise, are intersected with them until all words agree (exact phrase) or none is left.
Proximity: an item's windows that tile it (every ``WINDOW``-th) are looked up around each occurrence
of their ``ANCHORS`` rarest words in the block; where at least ``NEAR_SHARE`` of the window's words
stand within ``SLACK`` of their places in one document, that has a near match, which finds passages with
words put in, left out or replaced. Tiles, two anchors, and no items under ``WINDOW`` words: near matches
miss edited passages that are short or lost both anchors; they decide nothing in ``contamination``.
``matches`` gives every match with its item, its kind and its words.

The windows are sent to the tasks ``QUERY_BYTES`` of item text at a time; a longer benchmark takes
several passes over the index, so what is broadcast is bounded whatever its size.

Words: A-Z lower-cased, then runs of characters outside 00-2F, 3A-60, 7B-7F. Null or empty texts have
no words and no hits. Repeated item_ids are one item with the windows of all its rows; rows without
item_id count as hits but not as items. Repeated document rows give a row each. An empty benchmark
leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobble.llm.common import materialize, prepare, slices, texts

WINDOW, ANCHORS, SLACK, NEAR_SHARE = 13, 2, 3, 0.7
BLOCK_WORDS = 400_000
QUERY_BYTES = 4 << 20

#: Bytes of words: digits, a-z and all of any character beyond ASCII; A-Z become a-z, others spaces.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

INDEX = "shard int, block int, doc_ids array<bigint>, lengths array<int>, terms binary, counts binary, postings binary"
INDEX_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("terms", pa.binary()),
        ("counts", pa.binary()),
        ("postings", pa.binary()),
    ]
)


def words(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


class Block:
    """Documents whose words are being gathered."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.terms: dict[bytes, int] = {}
        self.ids: list[np.ndarray] = []
        self.held = 0

    def add(self, doc: int | None, text: str) -> None:
        own, term = words(text), self.terms
        self.docs.append(doc)
        self.lengths.append(len(own))
        self.ids.append(np.fromiter((term.setdefault(w, len(term)) for w in own), np.int32, len(own)))
        self.held += len(own) + 1

    def row(self, shard: int, block: int) -> pa.RecordBatch:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        ids = np.concatenate([*self.ids, np.empty(0, np.int32)])
        lengths = np.array(self.lengths, np.int64)
        at = np.arange(len(ids), dtype=np.int64) + np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(ids, kind="stable")
        counts = np.bincount(ids, minlength=len(self.terms)).astype("<u4")
        postings = at[order]
        gaps = np.diff(postings, prepend=0)
        first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[:-1]
        gaps[first] = postings[first]
        return pa.RecordBatch.from_pylist(
            [
                {
                    "shard": shard,
                    "block": block,
                    "doc_ids": self.docs,
                    "lengths": self.lengths,
                    "terms": squeeze(b"\n".join(self.terms)),
                    "counts": squeeze(counts.tobytes()),
                    "postings": squeeze(gaps.astype("<u4").tobytes()),
                }
            ],
            schema=INDEX_ARROW,
        )


def build_index(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The positional index of ``docs`` (doc_id, text), written to the shared folder."""
    prepare(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, n, block = TaskContext.get().partitionId(), 0, Block()
        for batch in slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                block.add(doc, text)
                if block.held >= block_words:
                    yield block.row(shard, n)
                    n, block = n + 1, Block()
        if block.docs:
            yield block.row(shard, n)

    return materialize(texts(docs).mapInArrow(build, INDEX), "postings")


class Windows:
    """The distinct windows of some items, as rows of term numbers (-1 beyond a short window's end)."""

    def __init__(self, items: list[tuple[int | None, str]], width: int):
        self.terms: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        tiles: set[tuple[int, ...]] = set()
        for item, text in items:
            own = [self.terms.setdefault(w, len(self.terms)) for w in words(text)]
            for at in range(max(1, len(own) - width + 1) if own else 0):
                key = tuple(own[at : at + width])
                owners.setdefault(key, set()).add(item)
                if at % width == 0:
                    tiles.add(key)
        self.rows = np.full((len(owners), width), -1, np.int32)
        for i, w in enumerate(owners):
            self.rows[i, : len(w)] = w
        self.items = [sorted(x for x in s if x is not None) for s in owners.values()]
        self.tiles = np.array([w in tiles for w in owners], bool)


class Postings:
    """Posting lists of one stored block, restricted to the terms of some windows."""

    def __init__(self, row: dict, terms: dict[bytes, int]):
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        raw = unzip(row["terms"])
        own = raw.split(b"\n") if raw else []
        counts = np.frombuffer(unzip(row["counts"]), "<u4").astype(np.int64)
        gaps = np.frombuffer(unzip(row["postings"]), "<u4").astype(np.int64)
        ends = np.cumsum(counts)
        sums = np.cumsum(gaps)
        self.lists: dict[int, np.ndarray] = {}
        self.counts = np.zeros(len(terms) + 1, np.int64)  # the last one stands for -1
        for i, t in enumerate(map(terms.get, own)):
            if t is not None:
                a, b = int(ends[i] - counts[i]), int(ends[i])
                self.lists[t] = sums[a:b] - (sums[a - 1] if a else 0)
                self.counts[t] = counts[i]


def _within(starts: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether one of the ascending ``wanted`` is between each start's ``low`` and ``high``."""
    at = np.searchsorted(wanted, low)
    ok = at < len(wanted)
    ok[ok] = wanted[at[ok]] <= high[ok]
    return ok


def phrase_starts(window: np.ndarray, post: Postings) -> np.ndarray:
    """Where the window occurs, word for word: shifted lists, intersected from the rarest on."""
    order = np.argsort(post.counts[window], kind="stable")
    starts = post.lists[window[order[0]]] - order[0]
    for k in order[1:]:
        if not len(starts):
            break
        starts = starts[_within(starts, post.lists[window[k]] - k, starts, starts)]
    return starts


def near_starts(
    window: np.ndarray, post: Postings, first: np.ndarray, anchors: int, slack: int, least: int
) -> np.ndarray:
    """Where at least ``least`` of the window's words stand within ``slack`` of their places, all of them in
    the document of the word that the window was looked up by. ``first``: where documents begin."""
    present = np.flatnonzero(post.counts[window])
    order = present[np.argsort(post.counts[window[present]], kind="stable")]
    found = []
    for anchor in order[:anchors]:
        own = post.lists[window[anchor]]
        doc = np.searchsorted(first, own, side="right") - 1
        starts, low, high = own - anchor, first[doc], first[doc + 1] - 1
        agree = np.zeros(len(starts), np.int64)
        for k in order:
            inside = np.maximum(starts - slack, low - k), np.minimum(starts + slack, high - k)
            agree += _within(starts, post.lists[window[k]] - k, *inside)
        # A window that sticks out of its document begins with it.
        found.append(np.maximum(starts, low)[agree >= least])
    return np.unique(np.concatenate(found))


def block_matches(row: dict, query: Windows, anchors: int, slack: int, share: float) -> Iterator[tuple]:
    """(window, starts, whether exact, where documents begin) of each window with matches in the block."""
    post = Postings(row, query.terms)
    first = np.concatenate([[0], np.cumsum(np.array(row["lengths"], np.int64) + 1)])
    used = query.rows >= 0
    present = ((post.counts[query.rows] > 0) & used).sum(axis=1)
    width = used.sum(axis=1)
    for i in np.flatnonzero((present == width) & (width > 0)):
        starts = phrase_starts(query.rows[i, : width[i]], post)
        if len(starts):
            yield i, starts, True, first
    for i in np.flatnonzero(query.tiles & (present >= np.ceil(share * width)) & (width == query.rows.shape[1])):
        starts = near_starts(query.rows[i], post, first, anchors, slack, int(np.ceil(share * width[i])))
        if len(starts):
            yield i, starts, False, first


def search_block(row: dict, query: Windows, anchors: int, slack: int, share: float) -> Iterator[tuple]:
    """(document's place, hit stretches as flat starts and ends, items, near windows) of each document."""
    lengths = np.array(row["lengths"], np.int64)
    first = np.concatenate([[0], np.cumsum(lengths + 1)])
    edge = np.zeros(int(first[-1]) + 1, np.int64)
    items: list[set] = [set() for _ in lengths]
    near = np.zeros(len(lengths), np.int64)
    width = (query.rows >= 0).sum(axis=1)
    for i, starts, exact, _ in block_matches(row, query, anchors, slack, share):
        own = np.unique(np.searchsorted(first, starts, side="right") - 1)
        if exact:
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + width[i], -1)
            for d in own:
                items[d].update(query.items[i])
        else:
            near[own] += 1
    hit = np.concatenate([[0], np.cumsum(edge)[:-1] > 0, [0]]).astype(np.int8)
    turns = np.flatnonzero(np.diff(hit))  # starts and ends by turns; a phrase never crosses documents
    bounds = np.searchsorted(turns, first)
    for d in range(len(lengths)):
        yield d, (turns[bounds[d] : bounds[d + 1]] - first[d]).tolist(), sorted(items[d]), int(near[d])


FOUND = (
    "shard int, block int, place int, doc_id bigint, n_words bigint, hits array<bigint>, "
    "items array<bigint>, n_near bigint"
)
FOUND_ARROW = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64())]
    + [("n_words", pa.int64()), ("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.int64())), ("n_near", pa.int64())]
)


def _searcher(broadcast, window: int, anchors: int, slack: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = Windows(broadcast.value, window)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                out = [
                    (row["shard"], row["block"], d, row["doc_ids"][d], row["lengths"][d], hits, items, near)
                    for d, hits, items, near in search_block(row, query, anchors, slack, share)
                ]
                cols = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(cols, FOUND_ARROW, strict=True)], schema=FOUND_ARROW
                )

    return run


MATCHES = "doc_id bigint, item_id bigint, kind string, start bigint, stop bigint"


def matches(
    index: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    anchors: int = ANCHORS,
    slack: int = SLACK,
    share: float = NEAR_SHARE,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Every match: doc_id, item_id (null for items without one), kind (``phrase`` or ``near``), and the words of
    the document from ``start`` to ``stop`` (exclusive) that an item's window lies on."""
    spark = index.sparkSession
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in MATCHES.split(", ")]

    def finder(broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query = Windows(broadcast.value, window)
            width = (query.rows >= 0).sum(axis=1)
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    for i, starts, exact, first in block_matches(row, query, anchors, slack, share):
                        docs = np.searchsorted(first, starts, side="right") - 1
                        begin = starts - first[docs]
                        end = np.minimum(begin + width[i], np.array(row["lengths"], np.int64)[docs])
                        owners = query.items[i] or [None]
                        n, k = len(starts), len(owners)
                        columns = [
                            [row["doc_ids"][d] for d in docs] * k,
                            [o for o in owners for _ in range(n)],
                            ["phrase" if exact else "near"] * (n * k),
                            np.tile(begin, k),
                            np.tile(end, k),
                        ]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        return run

    found = None
    for group in _item_groups(benchmark, query_bytes):
        own = index.mapInArrow(finder(spark.sparkContext.broadcast(group)), MATCHES)
        found = own if found is None else found.unionByName(own)
    return found.distinct()


def _item_groups(benchmark: DataFrame, most: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items, about ``most`` characters of text at a time; at least one group, maybe empty."""
    rows = benchmark.select(
        benchmark["item_id"].cast("bigint").alias("item_id"),
        F.coalesce(benchmark["text"].cast("string"), F.lit("")).alias("text"),
    )
    group: list[tuple[int | None, str]] = []
    held, any_yet = 0, False
    for r in rows.toLocalIterator():
        if group and held + len(r.text) > most:
            yield group
            group, held, any_yet = [], 0, True
        group.append((r.item_id, r.text))
        held += len(r.text)
    if group or not any_yet:
        yield group


def search(
    index: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    anchors: int = ANCHORS,
    slack: int = SLACK,
    share: float = NEAR_SHARE,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Per indexed document: doc_id, n_words, n_hit, items (ascending), n_near (tiles found near by)."""
    spark = index.sparkSession
    passes = [
        index.mapInArrow(_searcher(spark.sparkContext.broadcast(group), window, anchors, slack, share), FOUND)
        for group in _item_groups(benchmark, query_bytes)
    ]
    if len(passes) == 1:
        covered = "aggregate(sequence(1, size(hits) div 2), 0L, (a, i) -> a + hits[2 * i - 1] - hits[2 * i - 2])"
        n_hit = F.when(F.size("hits") > 0, F.expr(covered)).otherwise(F.lit(0).cast("bigint"))
        return passes[0].select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "n_near")
    # Stretches that several passes found count once.
    found = passes[0]
    for p in passes[1:]:
        found = found.unionByName(p)
    pairs = "CASE WHEN size(hits) > 0 THEN transform(sequence(0, size(hits) div 2 - 1), i -> struct(hits[2 * i] AS s, hits[2 * i + 1] AS e)) ELSE array() END"
    merged = found.groupBy("shard", "block", "place", "doc_id", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list(F.expr(pairs)))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sum("n_near").alias("n_near"),
    )
    n_hit = (
        "aggregate(runs, struct(0L AS reach, 0L AS n), (a, r) -> struct(greatest(a.reach, r.e) AS reach, "
        "a.n + greatest(0L, r.e - greatest(a.reach, r.s)) AS n), a -> a.n)"
    )
    return merged.select("doc_id", "n_words", F.expr(n_hit).alias("n_hit"), "items", "n_near")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Index ``docs`` and search the benchmark's windows in them; contaminated from a twentieth of the words on."""
    found = search(build_index(docs), benchmark, **options)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the contaminated ones.

    The texts' hash stands beside the id, so rows that share a doc_id, or have none, are judged each
    by its own text.
    """
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")), F.lit(11))
    judged = contamination(docs.select(key.alias("doc_id"), "text"), benchmark, **options)
    bad = judged.filter("contaminated").select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, key == bad["__bad"], "left_anti")
