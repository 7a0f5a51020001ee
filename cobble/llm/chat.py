"""Chat formatting by columnar byte assembly, with a loss mask, and its exact reading back.

Template of a turn: ``<s>[ROLE]`` role ``[/ROLE]`` body ``</s>``. The body of an assistant turn is a
space and the text; any other's is ``[INST] `` text `` [/INST]``. Inside roles and texts a control
string gets a backslash after its first character and a backslash is doubled, so no control string
is left in them and undoing it gives the text back.

Rows are range-partitioned by (conv_id, turn), so a conversation of any length is formatted by
several tasks. A batch becomes pieces: the rows of one conversation in it. Their bytes are assembled
by column: the lengths of all headers, texts and footers, their cumulative offsets, scatter indices
in numpy, and one preallocated buffer that is the Arrow column of the formatted pieces. A piece
carries its loss mask, byte starts and ends of the assistant texts.

Rows of a conversation come by turn (nulls first), then role, then text; repeated rows are repeated
turns. Null texts and roles are empty; the role ``assistant`` alone is under the mask. Rows without
conv_id form one conversation, null. Empty table: no pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobble.llm.common import materialize, partitions, prepare, slices

CONTROLS = ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]")
HEAD, BODY, FOOT = "<s>[ROLE]", ("[/ROLE][INST] ", "[/ROLE] "), (" [/INST]</s>", "</s>")
TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](?:\[INST\] (.*?) \[/INST\]| (.*?))</s>", re.DOTALL)
UNDO = re.compile(r"\\(\\?)")


def escape(column: pa.Array) -> pa.Array:
    """Control strings broken up by a backslash, backslashes doubled."""
    column = pc.replace_substring(column, "\\", "\\\\")
    return pc.replace_substring_regex(column, r"(<|\[)(/?s>|/?ROLE\]|/?INST\])", r"\1\\\2")


def unescape(text: str) -> str:
    return UNDO.sub(r"\1", text)


def _segments(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each string starts and how long it is."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), at[:-1], np.diff(at)


def assemble(roles: pa.Array, bodies: pa.Array, loss: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns, the turns' ends, and the starts of the texts in it."""
    fixed = [HEAD.encode(), *(b.encode() for b in (*BODY, *FOOT))]
    at = np.cumsum([0, *map(len, fixed)])
    constants = np.frombuffer(b"".join(fixed), np.uint8)
    n, which = len(roles), loss.astype(np.int64)
    role_bytes, role_at, role_n = _segments(roles)
    body_bytes, body_at, body_n = _segments(bodies)
    sources = (constants, role_bytes, constants, body_bytes, constants)
    starts = (np.full(n, at[0]), role_at, at[1 + which], body_at, at[3 + which])
    sizes = np.stack([np.full(n, len(fixed[0])), role_n, np.diff(at)[1 + which], body_n, np.diff(at)[3 + which]], axis=1)
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    begins = ends - sizes
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for k, (source, start) in enumerate(zip(sources, starts, strict=True)):
        size = sizes[:, k]
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(begins[:, k], size) + within] = source[np.repeat(start, size) + within]
    return out, ends[:, -1], begins[:, 3]


PIECES = (
    "conv_id bigint, shard int, piece int, n_turns int, formatted string, "
    "loss_starts array<bigint>, loss_ends array<bigint>"
)


def format_chats(rows: DataFrame) -> DataFrame:
    """Pieces of ``rows`` (conv_id, turn, role, text): order a conversation's by (shard, piece)."""
    spark = rows.sparkSession
    prepare(spark)
    clean = rows.select(
        rows["conv_id"].cast("bigint").alias("conv_id"),
        rows["turn"].cast("bigint").alias("turn"),
        F.coalesce(rows["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(rows["text"].cast("string"), F.lit("")).alias("text"),
    )
    keys = ["conv_id", "turn", "role", "text"]
    ranged = clean.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, piece = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            conv = batch.column("conv_id")
            n = len(conv)
            known = conv.is_valid().to_numpy(zero_copy_only=False)
            ids = conv.fill_null(0).to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (known[1:] != known[:-1])]))
            loss = pc.equal(batch.column("role"), "assistant").to_numpy(zero_copy_only=False)
            bodies = escape(batch.column("text"))
            out, ends, body_at = assemble(escape(batch.column("role")), bodies, loss)
            last = np.concatenate([new[1:], [n]])
            bounds = np.concatenate([[0], ends[last - 1]])
            base = np.repeat(bounds[:-1], last - new)
            size = _segments(bodies)[2]
            marked = np.concatenate([[0], np.cumsum(loss)])
            spans = pa.array(np.concatenate([marked[new], [marked[n]]]).astype(np.int32))
            text = pa.StringArray.from_buffers(len(new), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out))
            yield pa.RecordBatch.from_arrays(
                [
                    conv.take(pa.array(new)),
                    pa.array(np.full(len(new), shard, np.int32)),
                    pa.array(np.arange(piece, piece + len(new), dtype=np.int32)),
                    pa.array((last - new).astype(np.int32)),
                    text,
                    pa.ListArray.from_arrays(spans, pa.array((body_at - base)[loss])),
                    pa.ListArray.from_arrays(spans, pa.array((body_at + size - base)[loss])),
                ],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )
            piece += len(new)

    return ranged.mapInArrow(build, PIECES)


def _read(formatted: str) -> Iterator[tuple[str, str]]:
    for m in TURN.finditer(formatted):
        yield unescape(m[1]), unescape(m[2] if m[2] is not None else m[3])


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)
DIGEST_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
    + [("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from pieces in order; holds one piece and the running hashes."""
    state, done, now = None, [], object()

    def closed() -> list:
        conv, n, turns, chars, loss, size = state
        return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), size]

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), DIGEST_ARROW, strict=True)], schema=DIGEST_ARROW
        )

    for batch in batches:
        for i in range(batch.num_rows):
            p = {k: batch.column(k)[i].as_py() for k in ("conv_id", "formatted", "loss_starts", "loss_ends")}
            if now != p["conv_id"]:
                if state:
                    done.append(closed())
                now = p["conv_id"]
                state = [now, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in _read(p["formatted"]):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            raw = p["formatted"].encode()
            for a, b in zip(p["loss_starts"], p["loss_ends"], strict=True):
                own = unescape(raw[a:b].decode())
                state[3] += len(own)
                state[4].update(own.encode())
            state[5] += len(p["formatted"])
        if done:
            yield rows()
            done = []
    if state:
        done.append(closed())
        yield rows()


def chat_digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from its pieces: turns, loss text and formatted length.

    A SHA-256 over a conversation has one order, so its pieces pass through one task, streamed and
    sorted, one piece in memory.
    """
    prepare(pieces.sparkSession)
    ordered = pieces.repartition(partitions(pieces.sparkSession), "conv_id").sortWithinPartitions("conv_id", "shard", "piece")
    return ordered.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(_digest, DIGESTS)


def chat_output(rows: DataFrame) -> DataFrame:
    """Format, write, read back."""
    return chat_digests(materialize(format_chats(rows), "chat"))
