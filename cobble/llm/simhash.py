"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set where over half of its shingles' XXH64 values have it.
Fingerprints link at ``max_bits`` or fewer differing bits, and linked ones form a component.

Multi-index hashing: the 64 bits are cut into segments with radii whose (radius + 1) add up to
``max_bits + 1``, so two fingerprints within ``max_bits`` must be within the radius in some segment.
Each distinct fingerprint enumerates the Hamming ball of that radius around its own segment value,
fetches the table's fingerprints with such a value and keeps those whose complete distance is small
enough. Copies share a fingerprint, so a group of copies is one row here.

A segment value that more than ``HOT_VALUE`` fingerprints share would give all pairs of them. Those
fingerprints, and the ones whose balls reach such a value, are linked exactly another way: distance
``max_bits`` (even) or less is the same as having a common point within half of it, so each emits
its ball of half the radius and every point links its fingerprints to the smallest of them. A point
has at most as many fingerprints as a ball has points, so no group grows with the input.

Components: repeated star contraction over the links (each vertex's larger neighbours, then its
smaller ones, are joined to its smallest), every round written to the shared folder.

Null text: empty; no words: fingerprint zero, linked like any other. Null doc_ids take part and get
the component's smallest known doc_id (null where all are null). Repeated rows give a row each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobble.llm.common import materialize, prepare, slices, texts

#: Fingerprints that may share a segment value before they are linked by common points.
HOT_VALUE = 64
#: Shingles hashed at a time.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of a UTF-8 text, as an unsigned integer."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and white space 0x20 and 0x09-0x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.frombuffer(b"".join([digest(g, 42) for g in grams]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer."""
    prepare(docs.sparkSession)

    def prints(batches):
        for batch in slices(batches):
            got = [fingerprint(t.encode(), shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(got, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    return texts(docs).mapInArrow(prints, "doc_id bigint, fp bigint")


def _ball(bits: int, radius: int) -> list[int]:
    """XOR masks of all points within ``radius`` of a value of ``bits`` bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _segments(max_bits: int, n: int = 2) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment that must be probed."""
    width, out = 64 // n, []
    for i in range(n):
        reach = (max_bits + 1) // n + (i < (max_bits + 1) % n)
        if reach:
            out.append((64 - width * (i + 1), width, reach - 1))
    return out


def links(distinct: DataFrame, max_bits: int, hot_value: int = HOT_VALUE) -> DataFrame:
    """Pairs (a, b) of different fingerprints of ``distinct`` (fp), enough to connect all within ``max_bits``."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    segments = _segments(max_bits)

    def keys(balls: bool) -> list:
        out = []
        for s, (shift, width, radius) in enumerate(segments):
            value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
            masks = _ball(width, radius) if balls else [0]
            out += [F.struct(F.lit(s).alias("seg"), value.bitwiseXOR(F.lit(m)).alias("key")) for m in masks]
        return out

    def spread(df: DataFrame, balls: bool) -> DataFrame:
        return df.select("fp", F.explode(F.array(*keys(balls))).alias("k")).select("fp", "k.seg", "k.key")

    held = spread(distinct, False)
    hot = held.groupBy("seg", "key").count().filter(F.col("count") > hot_value).select("seg", "key")
    hot = materialize(hot, "simhash-hot")
    probes = spread(distinct, True)
    cold = held.withColumnRenamed("fp", "other").join(hot, ["seg", "key"], "left_anti")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    found = probes.join(cold, ["seg", "key"]).filter((F.col("fp") != F.col("other")) & (distance <= max_bits))
    found = found.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
    if hot.isEmpty():
        return found.distinct()
    crowd = probes.join(hot, ["seg", "key"], "left_semi").select("fp").distinct()
    masks = [F.lit(_signed(m)) for m in _ball(64, max_bits // 2)]
    points = crowd.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(m) for m in masks])).alias("point"))
    # At most as many fingerprints as a ball has points, so the list of a point is short.
    shared = points.groupBy("point").agg(F.array_sort(F.collect_list("fp")).alias("fps")).filter(F.size("fps") > 1)
    stars = shared.select(F.col("fps")[0].alias("a"), F.explode(F.expr("slice(fps, 2, size(fps) - 1)")).alias("b"))
    return found.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable."""
    edges = materialize(edges.select("a", "b"), "simhash-edges")
    size = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()  # a > b from here on: each node and a smaller one
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        out = joined.filter("b > m").select(F.col("m").alias("a"), "b").unionByName(
            small.select(F.col("m").alias("a"), F.col("a").alias("b"))
        )
        edges = materialize(out.distinct(), "simhash-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == size:
            break
        size = now
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, hot_value: int = HOT_VALUE) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    prints = materialize(fingerprints(docs, shingle), "simhash-fp")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-node")
    roots = components(links(nodes.select("fp"), max_bits, hot_value)).withColumnRenamed("node", "fp")
    linked = nodes.join(roots, "fp")
    best = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(best, "root").select("fp", "component_id")
    copies = nodes.filter("n > 1").join(roots, "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    groups = linked.unionByName(copies)  # a fingerprint of one document without links needs no row
    return prints.join(groups.withColumn("grouped", F.lit(True)), "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the document of each component that gives it its id.

    Rows that repeat a kept doc_id are one document: the smallest by all columns stays. Rows
    without a doc_id can't be named as a component's document; they stay only where no named
    document is in their component, one for each text.
    """
    found = near_duplicates(docs, shingle, max_bits)
    named = found.filter("doc_id = component_id").select("doc_id").distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    kept = docs.join(named, "doc_id", "left_semi")
    kept = kept.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("__row")).select("doc_id", "__row.*")
    nameless = docs.filter("doc_id IS NULL")
    if not nameless.isEmpty():
        alone = found.filter("component_id IS NULL").select("fingerprint").distinct()
        prints = _with_print(nameless, shingle)
        lone = prints.join(alone, prints["__fp"] == alone["fingerprint"], "left_semi").drop("__fp")
        kept = kept.unionByName(lone.dropDuplicates(["text"]).select(*kept.columns))
    return kept.select(*docs.columns)


def _with_print(docs: DataFrame, shingle: int) -> DataFrame:
    @F.pandas_udf("string")
    def hexed(column: pd.Series) -> pd.Series:
        return column.map(lambda t: f"{fingerprint((t or '').encode(), shingle):016x}")

    return docs.withColumn("__fp", hexed("text"))
