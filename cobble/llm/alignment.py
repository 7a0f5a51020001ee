"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes.

A is a byte-level BPE of the ``tokenizers`` library, B a byte-fallback BPE of ``sentencepiece``. Both
encode a space and the text. Offsets at which tokens of both end cut a text into groups; an A and a B
token of one group are linked.

The groups of a byte range form a *fragment*: an open beginning (tokens up to the first common end), closed
groups, and an open rest (tokens behind the last common end). Fragments of neighbouring ranges
compose: the first one's rest and the second one's beginning become one closed group, or stay open where
a range has no common end. That is associative, so a very long document is cut into ranges that
tasks work on apart, and a tree of groupings over Spark composes them. Ranges end anywhere, inside
words too. What is encoded for a range reaches from the last place before it to the first place
behind it at which neither tokenizer ever joins tokens (a space behind a printing ASCII character).
Where there is no such place near, ranges are merged: the tokenizers themselves need such a run whole.

Short documents are fragments closed at both ends. They are worked on in blocks: a block keeps its
distinct id pairs with the number of its documents that link them, and per document the places of its
pairs in that list. Corpus-wide counts are sums over blocks; they come back to a block by
one equality join of distinct (block, pair) rows, so a frequent pair has one row a block, not one a
document.

Distinct words are encoded once per worker: pre-tokens for A, runs of blanks with the word behind them
for B (none of B's pieces holds a blank behind anything else; checked when the model is loaded).

Null and empty texts, and texts whose pieces spell other bytes than the text (as where it holds U+2581),
have no tokens: zeros, and an empty string for the groups. Null doc_ids and repeated rows are
kept; each row is a document of its own. No rows: no rows. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobble.llm.common import materialize, partitions, prepare, slices, texts
from cobble.llm.token_counts import byte_letters, character_classes, pretoken_starts

#: Documents of more bytes are cut into ranges of this size.
RANGE_BYTES = 1 << 20
#: Bytes of text in a block, and those that are worked on at a time.
BLOCK_BYTES, SLICE_BYTES = 32 << 20, 4 << 20
#: Groups with more links than this are counted by distinct ids rather than link by link.
MANY_LINKS = 4096
#: Id pairs in one row of a long document.
ROW_PAIRS = 1 << 20
#: Words remembered by a worker for each tokenizer.
CACHE_WORDS = 400_000
#: Fragments composed at once.
FAN = 16
#: An id pair is one number: A's id, then B's in this many bits.
B_BITS = 15


# ------------------------------------------------------------------------------ encoding


class Words:
    """Remembered encodings of distinct words: ids of 16 bits; none where the ids don't spell the word."""

    bytes_of: list[bytes]

    def __init__(self) -> None:
        self.known: dict[bytes, bytes] = {}

    def encode(self, words: list[bytes]) -> list[list[int]]:
        raise NotImplementedError

    def _table(self) -> None:
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.spelling = pa.array(self.bytes_of, pa.large_binary())

    def learn(self, words: list[bytes]) -> None:
        lists = self.encode(words)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.uint16, int(sizes.sum()))
        ends = np.cumsum(sizes)
        # All at once: as many bytes in each word, and the same ones.
        upto = np.concatenate([[0], np.cumsum(self.lengths[flat])])
        same = upto[ends] - upto[ends - sizes] == np.fromiter(map(len, words), np.int64, len(words))
        good = bool(same.all()) and b"".join(self.spelling.take(pa.array(flat)).to_pylist()) == b"".join(words)
        raw, stop = flat.tobytes(), (ends * 2).tolist()
        start = [0, *stop[:-1]]
        self.known.update(zip(words, [raw[a:b] for a, b in zip(start, stop, strict=True)], strict=True))
        if not good:
            for word, ids in zip(words, lists, strict=True):
                if b"".join([self.bytes_of[i] for i in ids]) != word:
                    self.known[word] = b""

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each token ends in the data, starts of words that could not be spelled)."""
        offsets = np.concatenate([starts, [len(data)]]).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = column.dictionary_encode()
        words = coded.dictionary.to_pylist()
        got = list(map(self.known.get, words))
        if missing := [w for w, ids in zip(words, got, strict=True) if ids is None]:
            if len(self.known) + len(missing) > CACHE_WORDS:
                self.known = {w: ids for w, ids in zip(words, got, strict=True) if ids is not None}
            self.learn(missing)
            got = [self.known[w] for w in words]
        flat = np.frombuffer(b"".join(got), np.uint16)
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 2
        first = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = sizes[which]
        last = np.cumsum(n)
        ids = flat[np.arange(int(n.sum())) + np.repeat(first[which] - (last - n), n)]
        # Words that can't be spelled leave gaps: ends are counted from each word's start.
        total = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        before = total[last - n]
        return ids, total[1:] + np.repeat(starts - before, n), starts[(sizes == 0)[which]]


class WordsA(Words):
    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        self.letters = byte_letters()
        byte = {c: b for b, c in enumerate(self.letters)}
        vocab = tok.get_vocab(with_added_tokens=False)
        spelled = {i: bytes(byte[c] for c in w) for w, i in vocab.items()}
        self.bytes_of = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.tokenize = tok.model.tokenize
        self._table()

    def encode(self, words: list[bytes]) -> list[list[int]]:
        letters, tokenize = self.letters, self.tokenize
        return [[t.id for t in tokenize("".join([letters[b] for b in w]))] for w in words]


class WordsB(Words):
    BYTE = re.compile(r"<0x([0-9A-F]{2})>")

    def __init__(self, path: str):
        super().__init__()
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if len(pieces) > 1 << B_BITS or any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path}: pieces with a blank inside, or too many of them")
        self.bytes_of = [
            bytes([int(m[1], 16)]) if self.model.is_byte(i) and (m := self.BYTE.fullmatch(p)) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.blank = self.model.piece_to_id("▁")
        self._table()

    def encode(self, words: list[bytes]) -> list[list[int]]:
        # The model puts one blank before what it is given, and nothing where that is empty.
        lists = self.model.encode([w[1:].decode() for w in words], num_threads=1)
        return [ids or [self.blank] for ids in lists]


@dataclass
class Tools:
    a: WordsA
    b: WordsB
    classes: np.ndarray


_TOOLS: dict[tuple[str, str], Tools] = {}


def tools(a_path: str, b_path: str, classes: bytes) -> Tools:
    key = (a_path, b_path)
    if key not in _TOOLS:
        _TOOLS[key] = Tools(WordsA(a_path), WordsB(b_path), np.frombuffer(zlib.decompress(classes), np.uint8))
    return _TOOLS[key]


@dataclass
class Tokens:
    """Tokens of some texts laid end to end: ids and where they end; ``bad`` marks texts without tokens."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    bad: np.ndarray


def encode(t: Tools, data: np.ndarray, begins: np.ndarray) -> Tokens:
    """Tokens of texts that each begin with a blank. Those of texts that can't be spelled are dropped."""
    a_starts = np.flatnonzero(pretoken_starts(data, begins, t.classes))
    blank = data == 0x20
    head = np.zeros(len(data) + 1, bool)
    head[begins] = True
    head = head[:-1]
    b_starts = np.flatnonzero(head | (blank & ~np.concatenate([[False], blank[:-1]])))
    a, a_ends, a_bad = t.a(data, a_starts)
    b, b_ends, b_bad = t.b(data, b_starts)
    bad = np.zeros(len(begins), bool)
    for where in (a_bad, b_bad):
        bad[np.searchsorted(begins, where, side="right") - 1] = True
    if bad.any():
        a_ok = ~bad[np.searchsorted(begins, a_ends - 1, side="right") - 1]
        b_ok = ~bad[np.searchsorted(begins, b_ends - 1, side="right") - 1]
        a, a_ends, b, b_ends = a[a_ok], a_ends[a_ok], b[b_ok], b_ends[b_ok]
    return Tokens(a, a_ends, b, b_ends, bad)


# ------------------------------------------------------------------------------ groups


@dataclass
class Groups:
    """Closed groups: each token's group, and the tokens of each group."""

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    na: np.ndarray
    nb: np.ndarray


def grouped(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, common: np.ndarray) -> Groups:
    """Groups that end at ``common`` (every token ends at or before the last)."""
    ga, gb = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    return Groups(a, b, ga, gb, np.bincount(ga, minlength=len(common)), np.bincount(gb, minlength=len(common)))


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, size: int) -> np.ndarray:
    at = np.zeros(size + 1, bool)
    at[a_ends] = True
    both = np.zeros(size + 1, bool)
    both[b_ends] = True
    return np.flatnonzero(at & both)


def link_pairs(g: Groups, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, pair) numbers in order, and the links of each. ``owner``: that of each group."""
    links = g.na * g.nb
    many = links > MANY_LINKS
    few_nb = np.where(many, 0, g.nb)
    per_a = few_nb[g.a_group]
    total = int(per_a.sum())
    b_first = np.concatenate([[0], np.cumsum(g.nb)])[:-1]
    run = np.cumsum(per_a) - per_a
    b_at = np.arange(total) + np.repeat(b_first[g.a_group] - run, per_a)
    code = (g.a.astype(np.int64) << B_BITS) | (owner[g.a_group] << 31)
    keys, counts = np.unique(np.repeat(code, per_a) | g.b[b_at], return_counts=True)
    if many.any():
        more, weights = [keys], [counts]
        a_first = np.concatenate([[0], np.cumsum(g.na)])[:-1]
        for i in np.flatnonzero(many):
            ua, ca = np.unique(g.a[a_first[i] : a_first[i] + g.na[i]], return_counts=True)
            ub, cb = np.unique(g.b[b_first[i] : b_first[i] + g.nb[i]], return_counts=True)
            more.append(((ua.astype(np.int64)[:, None] << B_BITS) | ub | (int(owner[i]) << 31)).reshape(-1))
            weights.append((ca[:, None] * cb).reshape(-1))
        keys, place = np.unique(np.concatenate(more), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, place, np.concatenate(weights))
    return keys, counts


_WRITTEN = pa.array([f"{i}{mark}".encode() for mark in (",", "|", ";") for i in range(1 << 16)], pa.large_binary())


def group_text(g: Groups) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;`` of all groups one after another (a semicolon behind each), and where each group begins."""
    a_upto, b_upto = np.cumsum(g.na), np.cumsum(g.nb)
    code = np.empty(len(g.a) + len(g.b), np.int32)
    if not len(code):
        return np.zeros(0, np.uint8), np.zeros(len(g.na) + 1, np.int64)
    a_at = np.arange(len(g.a)) + (b_upto - g.nb)[g.a_group]
    b_at = np.arange(len(g.b)) + a_upto[g.b_group]
    code[a_at], code[b_at] = g.a, g.b
    code[a_at[a_upto - 1]] += 1 << 16
    code[b_at[b_upto - 1]] += 2 << 16
    written = _WRITTEN.take(pa.array(code))
    offsets = np.frombuffer(written.buffers()[1], np.int64, len(code) + 1, written.offset * 8)
    body = np.frombuffer(written.buffers()[2], np.uint8)
    group_first = (a_upto - g.na) + (b_upto - g.nb)
    return body, offsets[np.concatenate([group_first, [len(code)]]).astype(np.int64)]


# ------------------------------------------------------------------------------ short documents

BLOCKS = (
    "block string, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "sha array<string>, n_pairs array<bigint>, places binary, links binary, pairs array<int>, docs array<bigint>"
)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers below 2**32, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts of any size: as 32 bits with the few larger ones' high halves behind them."""
    return _pack(np.concatenate([counts & 0xFFFFFFFF, counts >> 32]) if (counts >> 32).any() else counts)


def _unpack_counts(data: bytes, n: int) -> np.ndarray:
    got = _unpack(data).astype(np.int64)
    return got if len(got) == n else got[:n] | (got[n:] << 32)


def _align(t: Tools, parts: list[bytes]) -> dict[str, np.ndarray | list]:
    """Figures of whole texts (each with its blank), and their distinct pairs, text by text."""
    n = len(parts)
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    got = encode(t, data, begins)
    common = common_ends(got.a_ends, got.b_ends, len(data))
    g = grouped(got.a, got.a_ends, got.b, got.b_ends, common)
    owner = np.searchsorted(begins, common - 1, side="right") - 1
    keys, counts = link_pairs(g, owner)
    body, group_at = group_text(g)
    n_groups = np.bincount(owner, minlength=n)
    first = np.cumsum(n_groups) - n_groups
    shas = [
        hashlib.sha256(body[group_at[f] : group_at[f + k] - 1]).hexdigest() if k else ""
        for f, k in zip(first.tolist(), n_groups.tolist(), strict=True)
    ]
    per = lambda x: np.bincount(owner, x, minlength=n).astype(np.int64)
    links = np.zeros(n, np.int64)
    np.add.at(links, owner, g.na * g.nb)
    return {
        "n_a": per(g.na), "n_b": per(g.nb), "n_groups": n_groups, "n_links": links, "sha": shas,
        "n_pairs": np.bincount(keys >> 31, minlength=n), "keys": keys & 0x7FFFFFFF, "counts": counts,
    }


def _short(t: Tools, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, serial = TaskContext.get().partitionId(), 0
    held: list[dict] = []
    size = 0

    def close() -> pa.RecordBatch:
        keys = np.concatenate([h["keys"] for h in held])
        pairs, places, docs = np.unique(keys, return_inverse=True, return_counts=True)
        n_pairs = np.concatenate([h["n_pairs"] for h in held])
        # Places ascend within a document: differences pack better.
        steps = np.diff(places, prepend=0)
        begins = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
        steps[begins] = places[begins]
        counts = np.concatenate([h["counts"] for h in held])
        lists = {k: np.concatenate([h[k] for h in held]) for k in ("n_a", "n_b", "n_groups", "n_links")}
        row = {
            "block": f"{part}-{serial}",
            "doc_ids": [d for h in held for d in h["doc_ids"]],
            **lists,
            "sha": [s for h in held for s in h["sha"]],
            "n_pairs": n_pairs,
            "places": _pack(steps),
            "links": _pack_counts(counts),
            "pairs": pairs.astype(np.int32),
            "docs": docs,
        }
        kinds = {"block": pa.string(), "sha": pa.list_(pa.string()), "places": pa.binary(), "links": pa.binary(), "pairs": pa.list_(pa.int32())}
        return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.list_(pa.int64()))) for k, v in row.items()], list(row))

    for batch in slices(batches, most=SLICE_BYTES):
        column = batch.column("text").cast(pa.large_binary()).to_pylist()
        some = _align(t, [b" " + x if x else b"" for x in column])
        held.append(some | {"doc_ids": batch.column("doc_id").to_pylist()})
        size += sum(map(len, column))
        if size >= BLOCK_BYTES:
            yield close()
            held, size, serial = [], 0, serial + 1
    if held:
        yield close()


RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)
_RESULT_KINDS = [pa.int64()] * 7 + [pa.string()]
_RESULT_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _finish(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents, by the corpus-wide counts of the block's pairs."""
    order = np.argsort(counts.column("pair").to_numpy())
    total = counts.column("total").to_numpy()[order].astype(np.int64)
    best = counts.column("best").to_numpy()[order].astype(np.int64)
    out = []
    for row in blocks.to_pylist():
        n_pairs = np.array(row["n_pairs"], np.int64)
        begins = np.cumsum(n_pairs) - n_pairs
        steps = _unpack(row["places"]).astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(steps)])
        places = upto[1:] - np.repeat(upto[begins], n_pairs)
        links = _unpack_counts(row["links"], len(places))
        sums = [np.concatenate([[0], np.cumsum(links * x[places])]) for x in (best, total)]
        n_best, count_sum = (s[begins + n_pairs] - s[begins] for s in sums)
        columns = [row[k] for k in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")] + [n_best, count_sum, row["sha"]]
        out.append(pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, _RESULT_KINDS, strict=True)], _RESULT_NAMES))
    return pa.concat_tables(out) if out else pa.table({n: pa.array([], k) for n, k in zip(_RESULT_NAMES, _RESULT_KINDS, strict=True)})


# ------------------------------------------------------------------------------ long documents

RANGES = "row string, doc_id bigint, k int, at bigint, low bigint, high bigint, text binary"


def cut_ranges(data: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """(low, high, from, to): byte ranges, and what is encoded for each."""
    raw = np.frombuffer(data, np.uint8)
    behind = raw[:-1]
    safe = np.flatnonzero((raw[1:] == 0x20) & (behind > 0x20) & (behind < 0x7F)) + 1
    edges = np.arange(size, len(data), size)
    i = np.searchsorted(safe, edges, side="right")
    j = np.searchsorted(safe, edges, side="left")
    near = (i > 0) & (j < len(safe))
    edges, i, j = edges[near], i[near] - 1, j[near]
    close = (edges - safe[i] <= size // 2) & (safe[j] - edges <= size // 2)
    edges, i, j = edges[close], i[close], j[close]
    lows, highs = [0, *edges.tolist()], [*edges.tolist(), len(data)]
    return list(zip(lows, highs, [0, *safe[i].tolist()], [*safe[j].tolist(), len(data)], strict=True))


def _cut(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, serial = TaskContext.get().partitionId(), 0
    names = ["row", "doc_id", "k", "at", "low", "high", "text"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            data = b" " + text.as_py().encode()
            for k, (low, high, x, y) in enumerate(cut_ranges(data, size)):
                row = (f"{part}-{serial}", doc_id, k, x, low, high, data[x:y])
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)
            serial += 1


_INTS = "array<int>"
#: A fragment: an open beginning and rest (without a common end, all of it is the beginning).
FRAGMENT = f"ok boolean, cut boolean, pre_a {_INTS}, pre_b {_INTS}, suf_a {_INTS}, suf_b {_INTS}"
#: Closed groups of a document: their place, figures, pairs and text.
CLOSED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, pairs array<int>, links array<bigint>, body binary"
FRAGMENTS = f"row string, doc_id bigint, k int, piece int, {FRAGMENT}, {CLOSED}"

_KINDS = {
    "row": pa.string(), "doc_id": pa.int64(), "k": pa.int32(), "piece": pa.int32(), "ok": pa.bool_(), "cut": pa.bool_(),
    **dict.fromkeys(("pre_a", "pre_b", "suf_a", "suf_b", "pairs"), pa.list_(pa.int32())), "links": pa.list_(pa.int64()),
    **dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), pa.int64()), "body": pa.binary(),
}


def _rows(rows: list[dict]) -> pa.RecordBatch:
    names = list(rows[0])
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], _KINDS[n]) for n in names], names)


def _closed(g: Groups) -> Iterator[dict]:
    """Figures, pairs and text of closed groups; pairs beyond ROW_PAIRS go to further rows."""
    keys, counts = link_pairs(g, np.zeros(len(g.na), np.int64))
    body, _ = group_text(g)
    figures = {"n_a": len(g.a), "n_b": len(g.b), "n_groups": len(g.na), "n_links": int((g.na * g.nb).sum())}
    for at in range(0, max(len(keys), 1), ROW_PAIRS):
        yield {
            **(figures if not at else dict.fromkeys(figures, 0)),
            "pairs": keys[at : at + ROW_PAIRS].astype(np.int32),
            "links": counts[at : at + ROW_PAIRS].astype(np.int64),
            "body": b"" if at else body.tobytes(),
        }


def fragment(t: Tools, text: bytes, at: int, low: int, high: int) -> tuple[dict, Groups]:
    """The open ends of a range's tokens, and its closed groups."""
    data = np.frombuffer(text, np.uint8)
    got = encode(t, data, np.array([0]))
    in_a = (got.a_ends + at > low) & (got.a_ends + at <= high)
    in_b = (got.b_ends + at > low) & (got.b_ends + at <= high)
    a, a_ends = got.a[in_a].astype(np.int32), got.a_ends[in_a]
    b, b_ends = got.b[in_b].astype(np.int32), got.b_ends[in_b]
    common = common_ends(a_ends, b_ends, len(data))
    out = {"ok": not bool(got.bad[0]), "cut": len(common) > 0}
    if not len(common):
        out |= {"pre_a": a, "pre_b": b, "suf_a": [], "suf_b": []}
        return out, grouped(a[:0], a_ends[:0], b[:0], b_ends[:0], common)
    first, last = common[0], common[-1]
    out |= {"pre_a": a[a_ends <= first], "pre_b": b[b_ends <= first], "suf_a": a[a_ends > last], "suf_b": b[b_ends > last]}
    ka, kb = (a_ends > first) & (a_ends <= last), (b_ends > first) & (b_ends <= last)
    return out, grouped(a[ka], a_ends[ka], b[kb], b_ends[kb], common[1:])


def _fragments(t: Tools, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ends, closed = fragment(t, r["text"], r["at"], r["low"], r["high"])
            for piece, figures in enumerate(_closed(closed)):
                head = {"row": r["row"], "doc_id": r["doc_id"], "k": r["k"], "piece": piece}
                yield _rows([head | ends | figures])


def compose(x: dict, y: dict) -> dict:
    """Two neighbouring fragments as one. ``joints``: the groups closed where fragments met, with the
    number of the range before whose own groups they come."""
    if not x["cut"] and not y["cut"]:
        return x | {"pre_a": x["pre_a"] + y["pre_a"], "pre_b": x["pre_b"] + y["pre_b"]}
    if not x["cut"]:
        return y | {"k": x["k"], "pre_a": x["pre_a"] + y["pre_a"], "pre_b": x["pre_b"] + y["pre_b"]}
    if not y["cut"]:
        return x | {"suf_a": x["suf_a"] + y["pre_a"], "suf_b": x["suf_b"] + y["pre_b"]}
    a, b = x["suf_a"] + y["pre_a"], x["suf_b"] + y["pre_b"]
    joint = [{"at": y["first"], "a": a, "b": b}] if a or b else []
    return x | {"suf_a": y["suf_a"], "suf_b": y["suf_b"], "joints": x["joints"] + joint + y["joints"]}


_JOINTS = "joints array<struct<at:int, a:array<int>, b:array<int>>>"
TREE = f"row string, k int, first int, cut boolean, pre_a {_INTS}, pre_b {_INTS}, suf_a {_INTS}, suf_b {_INTS}, {_JOINTS}"
_TREE_KINDS = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), *[pa.list_(pa.int32())] * 4,
               pa.list_(pa.struct([("at", pa.int32()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))]
_TREE_NAMES = ["row", "k", "first", "cut", "pre_a", "pre_b", "suf_a", "suf_b", "joints"]


def _compose_group(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: r["k"])
    out = rows[0]
    for r in rows[1:]:
        out = compose(out, r)
    out = out | {"k": out["k"] // FAN}
    return pa.Table.from_arrays([pa.array([out[n]], k) for n, k in zip(_TREE_NAMES, _TREE_KINDS, strict=True)], _TREE_NAMES)


def reduce_tree(fragments: DataFrame) -> DataFrame:
    """One fragment a document, by rounds that each compose up to FAN neighbours."""
    # A range that has no common end has no groups of its own: what comes first is the first range that has one.
    rows = fragments.selectExpr("row", "k", "k AS first", "cut", "pre_a", "pre_b", "suf_a", "suf_b", f"cast(array() AS {_JOINTS[7:]}) AS joints")
    most = rows.agg(F.max("k")).first()[0]
    while most:
        grouped_rows = rows.withColumn("up", F.expr(f"k div {FAN}")).groupBy("row", "up")
        rows = materialize(grouped_rows.applyInArrow(lambda g: _compose_group(g.drop_columns(["up"])), TREE), "align-tree")
        most //= FAN
    return rows


def _joint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first group and the joints of each document's last fragment, in the form of closed groups."""
    for batch in batches:
        for r in batch.to_pylist():
            joints = [{"at": r["first"], "a": r["pre_a"], "b": r["pre_b"]}, *r["joints"]]
            for j in joints:
                a, b = np.array(j["a"], np.int64), np.array(j["b"], np.int64)
                none = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                g = Groups(a, b, *none, np.array([len(a)]), np.array([len(b)]))
                for piece, figures in enumerate(_closed(g)):
                    yield _rows([{"row": r["row"], "k": j["at"], "piece": piece - (1 << 30)} | figures])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 a document from its groups in order; the last semicolon is left out."""
    row, sha, tail = None, None, b""
    names = ["row", "sha"]

    def out() -> pa.RecordBatch:
        sha.update(tail[:-1])
        return pa.RecordBatch.from_arrays([pa.array([row]), pa.array([sha.hexdigest()])], names)

    for batch in batches:
        for r, body in zip(batch.column("row").to_pylist(), batch.column("body").to_pylist(), strict=True):
            if r != row:
                if row is not None:
                    yield out()
                row, sha, tail = r, hashlib.sha256(), b""
            if body:
                sha.update(tail)
                tail = body
    if row is not None:
        yield out()


# ------------------------------------------------------------------------------ all documents


def best_pairs(counts: DataFrame) -> DataFrame:
    """``(pair, total, best)``: corpus-wide counts, and whether no pair of the same A id has more."""
    total = materialize(counts.groupBy("pair").agg(F.sum("docs").alias("total")), "align-pairs")
    a = F.shiftrightunsigned("pair", B_BITS).alias("a")
    top = total.groupBy(a).agg(F.max("total").alias("top"))
    return total.select("pair", "total", a).join(top, "a").select("pair", "total", (F.col("total") == F.col("top")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``RESULT`` of every document."""
    spark = docs.sparkSession
    prepare(spark)
    classes = character_classes(a_path)
    rows = texts(docs)
    is_long = F.octet_length("text") > range_bytes
    n = partitions(spark)

    def short(batches):
        yield from _short(tools(a_path, b_path, classes), batches)

    def fragments(batches):
        yield from _fragments(tools(a_path, b_path, classes), batches)

    def cut(batches):
        yield from _cut(range_bytes, batches)

    blocks = materialize(rows.filter(~is_long).mapInArrow(short, BLOCKS), "align-blocks")
    listed = blocks.select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select(
        "block", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs")
    )
    counts = listed.select("pair", "docs")

    ranges = materialize(rows.filter(is_long).mapInArrow(cut, RANGES), "align-ranges")
    has_long = bool(ranges.take(1))
    if has_long:
        parts = materialize(ranges.repartition(n, "row", "k").mapInArrow(fragments, FRAGMENTS), "align-fragments")
        good = parts.groupBy("row", "doc_id").agg(F.min("ok").alias("ok"))
        whole = parts.join(good.filter("ok").select("row"), "row")
        top = reduce_tree(whole.filter("piece = 0"))
        joints = top.mapInArrow(_joint_rows, f"row string, k int, piece int, {CLOSED}")
        closed = materialize(whole.select(*joints.columns).unionByName(joints), "align-closed")
        pair_rows = closed.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x"))
        pair_rows = pair_rows.groupBy("row", F.col("x.pairs").alias("pair")).agg(F.sum("x.links").alias("links"))
        pair_rows = materialize(pair_rows, "align-long-pairs")
        counts = counts.unionByName(pair_rows.select("pair", F.lit(1).cast("bigint").alias("docs")))

    pairs = materialize(best_pairs(counts), "align-best")
    known = listed.select(F.col("block").alias("of"), "pair").join(pairs, "pair")
    result = blocks.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_finish, RESULT)
    if has_long:
        figures = closed.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")])
        sums = pair_rows.join(pairs, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("total")).alias("count_sum"),
        )
        ordered = closed.select("row", "k", "piece", "body").repartition(n, "row").sortWithinPartitions("row", "k", "piece")
        digests = ordered.select("row", "body").mapInArrow(_digests, "row string, sha string")
        long = good.select("row", "doc_id").join(figures, "row", "left").join(sums, "row", "left").join(digests, "row", "left")
        zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in _RESULT_NAMES[1:7]]
        result = result.unionByName(long.select("doc_id", *zero, F.coalesce("sha", F.lit("")).alias("groups_sha256")))
    return result
