"""Token-ID output: zstandard frames with a shared dictionary, one frame per document.

Format of a token folder (two Parquet tables, so any store that Spark reaches will do, and a lost
executor's tasks are committed once):

* ``dictionary``: one row ``(dict_sha256, id_bytes, dictionary)``; an empty dictionary where there
  were too few samples to train one.
* ``blocks``: rows ``(shard, block, first_doc, last_doc, doc_ids, n_tokens, offsets, dict_sha256,
  payload)`` in ascending doc_id order over (shard, block). ``payload`` is the concatenation of one
  zstandard frame per document, document i is ``payload[offsets[i]:offsets[i + 1]]``: a reader
  opens one short document without touching its neighbours, and min/max statistics of ``first_doc``
  and ``last_doc`` prune the others. Ids are little-endian unsigned of ``id_bytes`` bytes.

The dictionary is trained on the first ``SAMPLE_IDS`` ids of ``SAMPLE_DOCS`` documents chosen by
hash (a documented bound; it alters sizes, never ids).

Null text: empty, only the end id. Null doc_ids come first. Repeated rows are all kept, in order of
(doc_id, text). No rows: no blocks, no result rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cobble.llm.common import gathered, partitions, prepare, slices, texts
from cobble.session import shared_scratch

SAMPLE_DOCS, SAMPLE_IDS, DICT_BYTES = 512, 2048, 32 << 10
#: A block is closed at this many compressed bytes or documents.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4096
#: Words kept with their ids in a Python worker; beyond it the cache starts anew.
CACHE_WORDS = 400_000
LEVEL = 3
#: Text bytes whose words are looked up together: the more, the fewer distinct words in all.
ENCODE_BYTES = 16 << 20

BLOCKS = (
    "shard int, block int, first_doc bigint, last_doc bigint, doc_ids array<bigint>, n_tokens array<int>, "
    "offsets array<bigint>, dict_sha256 string, payload binary"
)


#: How the tokenizer that ``Runs`` knows prepares a text (fixed values: they must equal its file's).
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KNOWN_STEPS = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "BPE")


class Runs:
    """Ids of words of printable ASCII and Latin-1 letters, by the library's BPE model alone.

    For these characters the normaliser only lower-cases and the pre-tokenizer only cuts a word
    into runs of letters, single digits and runs of others. The runs repeat far more than words
    with their punctuation do, so each is given to the model once.
    """

    FIT = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

    def __init__(self, tok, dtype: np.dtype):
        self.tokenize, self.dtype = tok.model.tokenize, dtype
        self.known: dict[str, bytes] = {}
        # Byte-level BPE writes a byte as itself where that prints, the others from 256 on.
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in prints]
        self.byte = {b: b for b in prints} | {b: 256 + i for i, b in enumerate(others)}

    @staticmethod
    def serve(tok) -> bool:
        """Whether the tokenizer prepares texts the way this class relies on."""
        got = json.loads(tok.to_str())
        steps = [x["type"] for x in (got["normalizer"] or {}).get("normalizers", [])]
        cuts = (got["pre_tokenizer"] or {}).get("pretokenizers", [])
        split = cuts[0].get("pattern", {}).get("Regex") if cuts else None
        return (steps, [x["type"] for x in cuts], got["model"]["type"]) == KNOWN_STEPS and split == KNOWN_SPLIT

    def run(self, run: str) -> bytes:
        if run.isascii():
            text = run
        else:
            text = "".join(chr(self.byte[b]) for b in run.encode())
        return np.array([t.id for t in self.tokenize(text)], self.dtype).tobytes()

    def word(self, word: str) -> bytes:
        known, out = self.known, b""
        for run in self.CUT.findall(word.lower()):
            ids = known.get(run)
            if ids is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                ids = known[run] = self.run(run)
            out += ids
        return out


class WordEncoder:
    """Ids of whole texts by the tokenizers library, each distinct word encoded once.

    Valid for tokenizers whose pre-tokens never span ASCII white space and which drop it: then a
    text's ids are its words' ids one after another.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.runs = Runs(self.tok, self.dtype) if Runs.serve(self.tok) else None

    def _learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known.clear()
        rest = words
        if self.runs:
            rest, fit, word = [], Runs.FIT.fullmatch, self.runs.word
            for w in words:
                # A special token's name in a word is left to the library.
                if fit(w) and "<|" not in w:
                    self.known[w] = word(w)
                else:
                    rest.append(w)
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, self.dtype).tobytes()

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's ids begin (one more than texts)."""
        lists = pc.ascii_split_whitespace(column)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        got = list(map(self.known.get, words))
        if missing := [w for w, g in zip(words, got, strict=True) if g is None]:
            self._learn(missing)
            got = [self.known[w] if g is None else g for w, g in zip(words, got, strict=True)]
        ids = np.frombuffer(b"".join(got), self.dtype)
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // self.dtype.itemsize
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = sizes[which]
        ends = np.cumsum(n)
        take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[which] - (ends - n), n)
        bounds = np.concatenate([[0], ends])
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return ids[take], bounds[first]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _arrays(path: str, end_id: int, batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    enc = encoder(path)
    ids, bounds = enc(batch.column("text"))
    end = np.array([end_id], enc.dtype)
    for i in range(len(bounds) - 1):
        yield np.concatenate([ids[bounds[i] : bounds[i + 1]], end])


def train_dictionary(docs: DataFrame, path: str, end_id: int) -> bytes:
    """A zstandard dictionary from the first ids of some documents; empty when they are too few."""
    import zstandard

    def heads(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_pydict({"head": [a[:SAMPLE_IDS].tobytes() for a in _arrays(path, end_id, batch)]})

    picked = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = docs.join(F.broadcast(picked), "doc_id", "left_semi").mapInArrow(heads, "head binary").limit(SAMPLE_DOCS)
    heads_ = sorted(r.head for r in sample.collect())  # at most SAMPLE_DOCS * SAMPLE_IDS ids
    try:
        return zstandard.train_dictionary(DICT_BYTES, heads_).as_bytes() if len(heads_) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _pack(path: str, end_id: int, dictionary: bytes, sha: str) -> Callable:
    def pack(batches):
        import zstandard

        shard, block = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        ).compress
        docs, counts, frames, held = [], [], [], 0

        def flush():
            ids = [d for d in docs if d is not None]
            row = (shard, block, min(ids, default=None), max(ids, default=None), docs, counts)
            row += (np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist(), sha, b"".join(frames))
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], schema=BLOCK_ARROW)

        for batch in gathered(slices(batches), ENCODE_BYTES):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), _arrays(path, end_id, batch), strict=True):
                frame = squeeze(ids.tobytes())
                docs.append(doc)
                counts.append(len(ids))
                frames.append(frame)
                held += len(frame)
                if held >= BLOCK_BYTES or len(docs) >= BLOCK_DOCS:
                    yield flush()
                    block += 1
                    docs, counts, frames, held = [], [], [], 0
        if docs:
            yield flush()

    return pack


BLOCK_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first_doc", pa.int64()),
        ("last_doc", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int32())),
        ("offsets", pa.list_(pa.int64())),
        ("dict_sha256", pa.string()),
        ("payload", pa.binary()),
    ]
)


def write_tokens(docs: DataFrame, out: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode ``docs`` (doc_id, text) into the token folder ``out``."""
    spark = docs.sparkSession
    prepare(spark)
    docs = texts(docs)
    dictionary = train_dictionary(docs, tokenizer, end_id)
    sha = hashlib.sha256(dictionary).hexdigest()
    width = encoder(tokenizer).dtype.itemsize
    spark.createDataFrame(
        [(sha, width, bytearray(dictionary))], "dict_sha256 string, id_bytes int, dictionary binary"
    ).coalesce(1).write.parquet(f"{out}/dictionary")
    # The text's hash spreads many rows of one doc_id over several ranges.
    n, spread = partitions(spark), F.xxhash64("text")
    ranged = docs.repartitionByRange(n, "doc_id", spread).sortWithinPartitions("doc_id", spread, "text")
    ranged.mapInArrow(_pack(tokenizer, end_id, dictionary, sha), BLOCKS).write.parquet(f"{out}/blocks")


def read_dictionary(spark: SparkSession, out: str) -> tuple[str, int, bytes]:
    row = spark.read.parquet(f"{out}/dictionary").first()
    return row.dict_sha256, row.id_bytes, bytes(row.dictionary)


def opener(dictionary: bytes, sha: str, width: int) -> Callable[[bytes, str], np.ndarray]:
    """A function from a frame and its block's dictionary hash to the frame's ids."""
    import zstandard

    dtype = np.dtype("<u2" if width == 2 else "<u4")
    unzip = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    ).decompress

    def ids(frame: bytes, named: str) -> np.ndarray:
        if named != sha:
            raise ValueError(f"block needs dictionary {named}, got {sha}")
        return np.frombuffer(unzip(frame), dtype)

    return ids


def read_document(spark: SparkSession, out: str, doc_id: int) -> list[np.ndarray]:
    """The ids of every document with this doc_id: prunes blocks by their bounds, opens only its frames."""
    sha, width, dictionary = read_dictionary(spark, out)
    ids = opener(dictionary, sha, width)
    rows = (
        spark.read.parquet(f"{out}/blocks")
        .filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
        .select("dict_sha256", F.posexplode("doc_ids").alias("i", "doc"), "offsets", "payload", "shard", "block")
        .filter(F.col("doc") == doc_id)
        .selectExpr(
            "dict_sha256", "shard", "block", "i",
            "substring(payload, int(offsets[i] + 1), int(offsets[i + 1] - offsets[i])) AS frame",
        )
        .orderBy("shard", "block", "i")
    )
    return [ids(bytes(r.frame), r.dict_sha256) for r in rows.collect()]


def token_digests(spark: SparkSession, out: str) -> DataFrame:
    """Per document of a token folder: doc_id, start, n_tokens, ids_crc32, frame_bytes."""
    sha, width, dictionary = read_dictionary(spark, out)

    def digest(batches):
        ids = opener(dictionary, sha, width)
        for batch in batches:
            for b in batch.to_pylist():
                rows = {k: [] for k in ("shard", "block", "doc_id", "before", "n_tokens", "ids_crc32", "frame_bytes")}
                before, at, payload = 0, b["offsets"], b["payload"]
                for i, doc in enumerate(b["doc_ids"]):
                    a = ids(payload[at[i] : at[i + 1]], b["dict_sha256"])
                    crc = zlib.crc32(a.astype("<u4").tobytes())
                    for k, v in zip(rows, (b["shard"], b["block"], doc, before, len(a), crc, at[i + 1] - at[i]), strict=True):
                        rows[k].append(v)
                    before += len(a)
                yield pa.RecordBatch.from_pydict(rows, schema=DIGEST_ARROW)

    blocks = spark.read.parquet(f"{out}/blocks")
    docs = blocks.select("shard", "block", "doc_ids", "offsets", "dict_sha256", "payload").mapInArrow(
        digest,
        "shard int, block int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint, frame_bytes bigint",
    )
    sums = blocks.selectExpr("shard", "block", "aggregate(n_tokens, 0L, (a, x) -> a + x) AS n")
    in_shard = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before_block = sums.select("shard", "block", F.coalesce(F.sum("n").over(in_shard), F.lit(0)).alias("in_shard"))
    # One row per shard: as many as write partitions, whatever the data.
    over = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = sums.groupBy("shard").agg(F.sum("n").alias("n"))
    before_shard = shards.select("shard", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("shards"))
    starts = before_block.join(before_shard, "shard")
    return docs.join(starts, ["shard", "block"]).select(
        "doc_id",
        (F.col("shards") + F.col("in_shard") + F.col("before")).cast("bigint").alias("start"),
        "n_tokens",
        "ids_crc32",
        "frame_bytes",
    )


DIGEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32())]
    + [(k, pa.int64()) for k in ("doc_id", "before", "n_tokens", "ids_crc32", "frame_bytes")]
)


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write a token folder under the shared folder and return what is read back from it."""
    out = shared_scratch(docs.sparkSession, "tokens")
    write_tokens(docs, out, tokenizer, end_id)
    return token_digests(docs.sparkSession, out)
