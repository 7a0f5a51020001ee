"""Conversation prefix trie by truncation peeling.

Every distinct sequence of first turns is a node. The peel goes from the deepest level up: rows are
conversations that end at the level, merged with the nodes that survived below it; the last piece of
every row's path is stripped, the rows are grouped by what is left, and the group's counts, leaves
and saved code points are summed while the group (the parent node) is found. A hot first turn or a
copied conversation is summed map-side, so no group is gathered.

Two things keep the rounds few and the rows small:

* A path is a list of *segments*, runs of turns over which the number of conversations that share the
  prefix does not change (so nothing branches or ends inside them). A round strips a segment: a
  conversation of 400 turns of its own costs one round, not 400. The inside of a segment follows from
  its end: one child, the same members and leaves, and code points added up towards its top.
* A prefix is named by 120 bits, the exclusive-or of MD5 values of (position, turn), so a running
  window over each conversation names all its prefixes.

Order of a conversation: turn (null first), then role, then text. A null role or text is empty. Rows
without a conv_id belong to no conversation and are dropped. Repeated rows are turns of their own. A
conversation may be left without turns; it ends at the root. No rows: no nodes. Further columns are
never read.

Digests of the ids that end at a node are made in two steps: ids in order (by range, so a node's ids
spread over tasks) become comma-joined blocks, and one stream per node hashes its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cobble.llm.common import materialize, partitions, prepare

#: Conversations whose ids share a hundred may start with its first one's turns, this many at most (exclusive).
FAMILY, HEADS = 100, 6
#: Characters of comma-joined ids in one block.
BLOCK_CHARS = 1 << 16

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _lane(digest: Column, start: int) -> Column:
    """60 bits of a hexadecimal digest as a number."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, i, name, chars)``: turns counted from 0, named by a digest of role and text."""
    role = F.coalesce(conversations["role"].cast("string"), F.lit(""))
    text = F.coalesce(conversations["text"].cast("string"), F.lit(""))
    rows = conversations.select(
        conversations["conv_id"].cast("bigint").alias("conv_id"),
        conversations["turn"].cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    ).filter("conv_id IS NOT NULL")
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("bigint").alias("i"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("name"),
        F.length("text").cast("bigint").alias("chars"),
    )


def rebuild(own: DataFrame) -> DataFrame:
    """``(conv_id, depth, name, chars)``: the first h turns of the family's first conversation, then the
    conversation's own turns after its first h, h = crc32(conv_id) % 6."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    heads = own.filter((F.col("conv_id") % FAMILY == 0) & (F.col("i") < HEADS)).select(
        F.col("conv_id").alias("base"), "i", "name", "chars"
    )
    sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("have"))
    members = own.select("conv_id").distinct().select("conv_id", base.alias("base"), h.alias("h"))
    first = (
        members.join(heads, "base").filter("i < h").select("conv_id", (F.col("i") + 1).alias("depth"), "name", "chars")
    )
    rest = (
        own.select("conv_id", "i", "name", "chars", base.alias("base"), h.alias("h"))
        .filter("i >= h")
        .join(sizes, "base", "left")
        .select("conv_id", F.expr("i - h + least(h, coalesce(have, 0)) + 1").alias("depth"), "name", "chars")
    )
    return first.unionByName(rest)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """``(conv_id, depth, chars, k1, k2)``: every prefix of every conversation under its 120-bit name."""
    digest = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), "name"))
    lanes = rebuilt.select("conv_id", "depth", "chars", digest.alias("d"))
    lanes = lanes.select("conv_id", "depth", "chars", _lane(F.col("d"), 1).alias("x1"), _lane(F.col("d"), 16).alias("x2"))
    upto = W.partitionBy("conv_id").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    return lanes.select(
        "conv_id", "depth", "chars", F.bit_xor("x1").over(upto).alias("k1"), F.bit_xor("x2").over(upto).alias("k2")
    )


def segmented(rows: DataFrame) -> DataFrame:
    """Prefixes with the members of each (``n``, smallest ``rep``), its parent's ``above``, its segment,
    whether it ends the segment, the code points from it to the segment's end, and the end's name."""
    shared = rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("rep")).filter("n > 1")
    counted = rows.join(shared, ["k1", "k2"], "left").select(
        "conv_id",
        "depth",
        "chars",
        "k1",
        "k2",
        F.coalesce("n", F.lit(1)).cast("bigint").alias("n"),
        F.coalesce("rep", "conv_id").alias("rep"),
    )
    path = W.partitionBy("conv_id").orderBy("depth")
    marked = counted.select(
        "*",
        F.lag("rep").over(path).alias("above"),
        F.coalesce((F.lag("n").over(path) != F.col("n")).cast("int"), F.lit(1)).alias("starts"),
    ).withColumn("seg", F.sum("starts").over(path))
    back = W.partitionBy("conv_id", "seg").orderBy(F.col("depth").desc())
    return marked.select(
        "conv_id", "depth", "n", "rep", "above", "seg",
        F.sum("chars").over(back).alias("below"),
        (F.row_number().over(back) == 1).alias("last"),
        F.first("k1").over(back).alias("e1"),
        F.first("k2").over(back).alias("e2"),
    )


ROOT = "named_struct('seg', 0L, 'e1', 0L, 'e2', 0L, 'chars', 0L)"


def paths(members: DataFrame, segs: DataFrame) -> DataFrame:
    """``(conv_id, path)``: the segments of each conversation from the root on."""
    parts = segs.groupBy("conv_id", "seg", "e1", "e2").agg(F.max("below").alias("chars"))
    part = F.struct(F.col("seg").cast("bigint").alias("seg"), "e1", "e2", "chars")
    lists = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    joined = members.join(lists, "conv_id", "left")
    return joined.select("conv_id", F.expr(f"concat(array({ROOT}), coalesce(parts, array()))").alias("path"))


def peel(ended: DataFrame) -> DataFrame:
    """``(e1, e2, conv_id, n, children, leaves, saved)`` of every segment, the root's included.

    ``ended``: ``(path, n, conv_id)``, one row for each node at which conversations end. ``saved`` is
    that of the subtrees below the segment's end.
    """
    spark = ended.sparkSession
    deepest = ended.agg(F.max(F.size("path"))).first()[0] or 0
    done, survived = [], None
    for level in range(deepest, 0, -1):
        rows = ended.filter(F.size("path") == level).selectExpr(
            "path", "n", "conv_id", "0L AS child", "0L AS leaves", "0L AS saved"
        )
        if survived is not None:
            rows = rows.unionByName(survived)
        tip = F.element_at("path", -1)
        nodes = (
            rows.groupBy(tip["e1"].alias("e1"), tip["e2"].alias("e2"))
            .agg(
                F.first("path").alias("path"),
                F.sum("n").alias("n"),
                F.min("conv_id").alias("conv_id"),
                F.sum("child").alias("children"),
                F.sum("leaves").alias("leaves"),
                F.sum("saved").alias("saved"),
            )
            .withColumn("leaves", F.greatest("leaves", F.lit(1)))
        )
        nodes = materialize(nodes, "trie-level")
        done.append(nodes.drop("path"))
        survived = nodes.select(
            F.expr("slice(path, 1, size(path) - 1)").alias("path"),
            "n",
            "conv_id",
            F.lit(1).cast("bigint").alias("child"),
            "leaves",
            (F.col("saved") + (F.col("n") - 1) * F.element_at("path", -1)["chars"]).alias("saved"),
        )
    if not done:
        schema = "e1 bigint, e2 bigint, n bigint, conv_id bigint, children bigint, leaves bigint, saved bigint"
        return spark.createDataFrame([], schema)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (e1, e2, conv_id) to comma-joined blocks, one or more a node."""
    key, ids, size, out = None, [], 0, []

    def close() -> None:
        out.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for e1, e2, c in zip(*(batch.column(x).to_pylist() for x in ("e1", "e2", "conv_id")), strict=True):
            if (e1, e2) != key or size >= BLOCK_CHARS:
                if key is not None:
                    close()
                key, ids, size = (e1, e2), [], 0
            ids.append(c)
            size += len(str(c)) + 1
        if out:
            yield _batch(out, ("e1", "e2", "first", "ids"))
            out = []
    if key is not None:
        close()
        yield _batch(out, ("e1", "e2", "first", "ids"))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order to one SHA-256 a node."""
    key, sha, out = None, None, []
    for batch in batches:
        for e1, e2, ids in zip(*(batch.column(x).to_pylist() for x in ("e1", "e2", "ids")), strict=True):
            if (e1, e2) != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (e1, e2), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if out:
            yield _batch(out, ("e1", "e2", "ends_sha256"))
            out = []
    if key is not None:
        out.append((*key, sha.hexdigest()))
        yield _batch(out, ("e1", "e2", "ends_sha256"))


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = [pa.string() if n in ("ids", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def end_hashes(ends: DataFrame) -> DataFrame:
    """``(e1, e2, ends_sha256)`` from the ``(e1, e2, conv_id)`` of all conversations."""
    n = partitions(ends.sparkSession)
    keys = ["e1", "e2"]
    order = ends.repartitionByRange(n, *keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    blocks = order.mapInArrow(_blocks, "e1 bigint, e2 bigint, first bigint, ids string")
    by_node = blocks.repartition(n, *keys).sortWithinPartitions(*keys, "first")
    return by_node.mapInArrow(_hashes, "e1 bigint, e2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prepare(conversations.sparkSession)
    own = materialize(turns(conversations), "trie-turns")
    rows = materialize(prefixes(rebuild(own)), "trie-prefixes")
    segs = materialize(segmented(rows), "trie-segments")
    members = own.select("conv_id").distinct()
    path = materialize(paths(members, segs), "trie-paths")
    tip = F.element_at("path", -1)
    ended = path.groupBy(tip["e1"].alias("e1"), tip["e2"].alias("e2")).agg(
        F.first("path").alias("path"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")
    )
    result = peel(materialize(ended, "trie-ended"))
    hashes = end_hashes(path.select(tip["e1"].alias("e1"), tip["e2"].alias("e2"), "conv_id"))
    result = result.join(hashes, ["e1", "e2"], "left").select(
        "e1", "e2", F.col("conv_id").alias("top"), "n", "children", "leaves", "saved", "ends_sha256"
    )
    result = materialize(result, "trie-result")
    # A node is where its smallest member passes; the root is no prefix and comes from the peel alone.
    root = result.filter("e1 = 0 AND e2 = 0 AND n IS NOT NULL")
    smallest = root.select(F.col("top").alias("smallest"))
    inner = segs.filter("conv_id = rep").select("conv_id", "depth", "above", "below", "last", "e1", "e2")
    nodes = inner.join(result, ["e1", "e2"]).join(F.broadcast(smallest))
    last = F.col("last")
    below = nodes.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        F.when(F.col("depth") == 1, F.col("smallest")).otherwise(F.col("above")).alias("parent_conv_id"),
        F.col("n").cast("bigint").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        F.col("leaves").cast("bigint").alias("n_leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("below")).cast("bigint").alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("ends_sha256")), F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )
    top = root.select(
        F.col("top").alias("conv_id"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.col("n").cast("bigint").alias("n_convs"),
        F.col("children").cast("bigint").alias("n_children"),
        F.col("leaves").cast("bigint").alias("n_leaves"),
        F.col("saved").cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )
    return top.unionByName(below)
