"""Best-fit packing of documents into fixed token windows, under conflicts.

A bin may not hold two documents of one source or of one duplicate cluster. Documents are dealt by
hash into shards of about ``SHARD_DOCS``; a shard packs its documents by falling length. Open bins
are kept ordered by what is left in them and carry a bitmap of sources and one of duplicate
clusters; from the first bin with enough room (a successor search) the walk goes on to the next
tighter ones until one without conflict is found, so every document goes to the tightest compatible
bin, and to a new one only where there is none. A document longer than a bin is cut into whole bins
and a rest; the rest is packed like the others.

To keep a hot source (or cluster) from walking past all bins that already hold it, bins are also
counted: where every open bin holds the source, the walk is skipped, and a bin that is full leaves
the order. Shards bound the rest of the work whatever the skew.

Duplicate clusters are exact copies but for case and spacing, and with ``pack_apart`` also near
copies: the components that ``simhash`` links.

Only ids, lengths and hashes reach the packing. Length is the number of words (runs other than white
space) and one end mark. Null texts are empty, length 1; null sources are one source; empty texts
are not each other's duplicates. Repeated rows are duplicates and part company. Every row is placed.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cobble.llm import simhash
from cobble.llm.common import materialize, prepare, slices

CAPACITY, SHARD_DOCS = 2048, 4000

PLACES = (
    "bin_id string, slot int, doc_id bigint, part int, n_tokens int, start int, source string, cluster bigint, room int"
)

PLACES_ARROW = pa.schema(
    [("bin_id", pa.string()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("part", pa.int32())]
    + [("n_tokens", pa.int32()), ("start", pa.int32()), ("source", pa.string()), ("cluster", pa.int64())]
    + [("room", pa.int32())]
)


def pack_shard(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """(bin, document, part, tokens) in order of placement, and what is left in each bin."""
    places: list[tuple[int, int, int, int]] = []
    room: list[int] = []
    rests: list[tuple[int, int, int]] = []
    for i, size in enumerate(sizes):
        whole, rest = divmod(size, capacity)
        for part in range(whole):
            places.append((len(room), i, part, capacity))
            room.append(0)
        if rest:
            rests.append((rest, i, whole))
    rests.sort(key=lambda r: (-r[0], r[1]))
    # Only clusters seen twice here can be in conflict; the others need no bit.
    often = Counter(clusters)
    bits = {c: 1 << k for k, c in enumerate(c for c, n in often.items() if n > 1)}
    in_source, in_cluster = dict.fromkeys(range(len(room)), 0), dict.fromkeys(range(len(room)), 0)
    order: list[tuple[int, int]] = []  # (what is left, bin)
    holding: Counter = Counter()  # open bins that hold a source
    for size, i, part in rests:
        source, cluster = 1 << sources[i], bits.get(clusters[i], 0)
        at = bisect.bisect_left(order, (size, -1))
        found = None
        if at < len(order) and holding[source] < len(order):
            for k in range(at, len(order)):
                b = order[k][1]
                if not (in_source[b] & source or in_cluster[b] & cluster):
                    found = k
                    break
        if found is None:
            b, left = len(room), capacity
            room.append(capacity)
            in_source[b] = in_cluster[b] = 0
        else:
            left, b = order.pop(found)
        left -= size
        in_source[b] |= source
        in_cluster[b] |= cluster
        room[b] = left
        places.append((b, i, part, size))
        if left:
            bisect.insort(order, (left, b))
            holding[source] += 1
        elif found is not None:
            for s in range(in_source[b].bit_length()):
                if in_source[b] >> s & 1 and 1 << s != source:
                    holding[1 << s] -= 1
    return places, room


def word_count(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def text_cluster(text: Column) -> Column:
    """Hash of the lower-cased words: equal for exact copies but for case and spacing; null for no words."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))
    return F.when(words != "", F.xxhash64(words))


MEASURED = "doc_id bigint, source string, cluster bigint, n_tokens int, mix bigint, fp bigint"


def measured(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """All that packing with near copies needs of each row, by one pass over the texts: ``text_cluster``,
    ``word_count`` and an end mark, a hash of the text, and the lower-cased text's fingerprint."""
    prepare(docs.sparkSession)
    rows = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in slices(batches):
            clusters, sizes, mixes, prints = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = text.lower().encode().split()
                clusters.append(digest(b" ".join(words), 42) if words else None)
                sizes.append(len(words) + 1)
                mixes.append(digest(text.encode(), 3))
                prints.append(simhash.fingerprint(b" ".join(words), shingle))
            own = np.array([c or 0 for c in clusters], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("source"),
                    pa.array(own, mask=np.array([c is None for c in clusters], bool)),
                    pa.array(sizes, pa.int32()),
                    pa.array(np.array(mixes, np.uint64).view(np.int64)),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                ],
                MEASURED_NAMES,
            )

    return materialize(rows.mapInArrow(measure, MEASURED), "packing-measured")


MEASURED_NAMES = ["doc_id", "source", "cluster", "n_tokens", "mix", "fp"]


def near_clusters(rows: DataFrame, max_bits: int = 2) -> DataFrame:
    """(own, cluster) for each text cluster of ``measured`` rows that is a near copy of others: the least
    of its component.

    Text clusters stand for the ids, so rows with repeated ids, or none, are told apart by their texts.
    """
    texts = rows.filter("cluster IS NOT NULL").select(F.col("cluster").alias("own"), "fp").distinct()
    nodes = materialize(texts.groupBy("fp").agg(F.min("own").alias("least"), F.count("*").alias("n")), "packing-prints")
    roots = simhash.components(simhash.links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = linked.groupBy("root").agg(F.min("least").alias("cluster"), F.sum("n").alias("texts")).filter("texts > 1")
    groups = linked.join(best, "root").select("fp", "cluster")
    return materialize(texts.join(groups, "fp").filter("own <> cluster").select("own", "cluster"), "near-clusters")


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    shard_docs: int = SHARD_DOCS,
    cluster: Column | None = None,
    length: Column | None = None,
) -> DataFrame:
    """A row per part of each row of ``docs`` (doc_id, text, source).

    bin_id, slot (place in the bin), doc_id, part, n_tokens, start (token offset in the bin), source,
    cluster and room (tokens left in the bin). ``cluster`` and ``length`` may be given, else the words' hash and
    number are taken.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    items = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        (cluster if cluster is not None else text_cluster(text)).cast("bigint").alias("cluster"),
        (length if length is not None else word_count(text) + 1).cast("int").alias("n_tokens"),
        F.xxhash64(text, F.lit(3)).alias("mix"),
    )
    return place(items, capacity, shard_docs)


def pack_apart(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS, max_bits: int = 2) -> DataFrame:
    """``pack`` with near copies in one cluster too: texts are read once, everything else comes from
    the small table that this gives."""
    rows = measured(docs)
    near = near_clusters(rows, max_bits).select(F.col("own").alias("cluster"), F.col("cluster").alias("__near"))
    # A cluster that all copies of a text share is one row of ``near``; the copies' side may be split.
    items = rows.join(near, "cluster", "left").select(
        "doc_id", "source", F.coalesce("__near", "cluster").alias("cluster"), "n_tokens", "mix"
    )
    return place(items, capacity, shard_docs)


def place(items: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The rows of ``pack`` for (doc_id, source, cluster, n_tokens, mix)."""
    n = max(1, -(-items.count() // shard_docs))
    # Both the id and the text are in the hash, so neither repeated ids nor copies pile up in a shard.
    shard = F.pmod(F.xxhash64("doc_id", "mix", "n_tokens"), F.lit(n)).cast("int")

    def packed(rows: pa.Table) -> pa.Table:
        docs_, sources, clusters, sizes, mixes, shards = (
            rows.column(k).to_pylist() for k in ("doc_id", "source", "cluster", "n_tokens", "mix", "shard")
        )
        order = sorted(
            range(rows.num_rows),
            key=lambda i: (docs_[i] is not None, docs_[i] or 0, mixes[i], sizes[i], sources[i] is not None, sources[i] or ""),
        )
        numbers: dict[str | None, int] = {}
        own_sources = [numbers.setdefault(sources[i], len(numbers)) for i in order]
        own_clusters = [("alone", i) if clusters[i] is None else clusters[i] for i in order]
        places, room = pack_shard([sizes[i] for i in order], own_sources, own_clusters, capacity)
        filled: Counter = Counter()
        slots: Counter = Counter()
        out = []
        for b, k, part, n in places:
            i = order[k]
            out.append((f"{shards[i]}-{b}", slots[b], docs_[i], part, n, filled[b], sources[i], clusters[i], room[b]))
            slots[b] += 1
            filled[b] += n
        cols = zip(*out, strict=True)
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, PLACES_ARROW, strict=True)], schema=PLACES_ARROW)

    return items.withColumn("shard", shard).groupBy("shard").applyInArrow(packed, PLACES)
