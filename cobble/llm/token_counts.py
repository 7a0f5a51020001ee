"""Token counts by a compiled tokenizer: finite-state transducers and a scan over chunk state maps.

The byte-level BPE tokenizer of a ``tokenizers`` file is compiled to two transducers:

* the *cutter* reads classes of characters (letter, number, blank, other white space, the rest) and
  marks where pre-tokens begin. It needs two characters on either side, so it runs over whole arrays;
* the *counter* reads bytes. Its state holds, for every suffix of what was read that begins some
  token, what can't follow the last token before that suffix, and how many tokens lie since. Each transition is
  annotated with the change in the number of tokens of the pre-token read so far (which may be
  negative: "a", "b", "c" may become "abc"). It rests on a property of BPE: a sequence of tokens
  is a text's encoding just when each neighbouring pair is the encoding of its own bytes, so the
  encodings of all prefixes follow one another by looking at pairs only. Transitions are worked
  out when a text first takes them, then read from a table.

Texts are cut into chunks of ``CHUNK`` bytes, which all advance together, one byte a step. A chunk
where a pre-token begins has a constant state map behind that place: it is run from there at once.
A chunk without such a place (a long run of letters, say) gets the entry of its map that its
neighbour's bytes suggest. A prefix scan composes the maps; where an entry that was not made is
needed, it is made and the scan goes on. At last the bytes before each chunk's first pre-token run from
the state that the scan found.

Special tokens in a text count as the library's default counts them: one each, and texts are cut there.

Null text: empty, no tokens. Null doc_ids and repeated rows are kept, one result row each. No rows:
no rows. Columns other than doc_id and text are never read. A text of any length goes through in
pieces; memory does not grow with it beyond the text itself.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cobble.llm.common import prepare, slices, texts

#: Bytes of a chunk, and of the text that is worked on at a time (a multiple of it).
CHUNK, PIECE = 256, 4 << 20
#: States in the table (a kilobyte each); beyond it the table starts anew from the states in use.
MOST_STATES = 1 << 17
#: Fences remembered as narrowed to a suffix.
MOST_PAIRS = 1 << 20
#: An opening with this many tokens or fewer is dropped once none of them fits.
FEW = 8
#: Bytes on either side of a piece that decide where its pre-tokens begin.
AROUND = 32

LETTER, NUMBER, OTHER, WHITE, BLANK = range(5)
#: What may follow an apostrophe as a pre-token of its own (fixed values: the tokenizer's pattern).
AFTER_ONE, AFTER_TWO = b"stmd", (b"re", b"ve", b"ll")

RESULT = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


@functools.lru_cache(4)
def character_classes(path: str) -> bytes:
    """The class of every code point, as the tokenizer's own pre-tokenizer treats it (compressed).

    Runs of characters that Python's tables put into one class are given to the pre-tokenizer behind a
    character of that class. Where they don't stay together, they are halved until they do.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    mates = {LETTER: "x", NUMBER: "1", OTHER: "!"}
    classes = np.full(0x110000, WHITE, np.uint8)
    guess = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)])
    edges = [0, *(np.flatnonzero(np.diff(guess)) + 1).tolist(), 0xD800, 0xE000, 0x110000]
    edges = sorted(set(edges))
    todo = [(a, b, int(guess[a])) for a, b in zip(edges, edges[1:]) if not 0xD800 <= a < 0xE000]
    while todo:
        a, b, kind = todo.pop()
        if len(split(mates[kind] + "".join(map(chr, range(a, b))))) == 1:
            classes[a:b] = kind
        elif b - a > 1:
            m = (a + b) // 2
            todo += [(a, m, kind), (m, b, kind)]
        else:
            for other, mate in mates.items():
                if len(split(mate + chr(a))) == 1:
                    classes[a] = other
    classes[0x20] = BLANK
    return zlib.compress(classes.tobytes(), 9)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters begin in UTF-8 bytes, and their code points."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    if len(at) == len(data):
        return at, lead
    more = np.concatenate([data, np.zeros(3, np.uint8)])
    points = lead.copy()
    for low, high, keep, n in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        i = np.flatnonzero((lead >= low) & (lead < high))
        p = lead[i] & keep
        for k in range(1, n + 1):
            p = (p << 6) | (more[at[i] + k] & 0x3F)
        points[i] = p
    return at, points


def pretoken_starts(data: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The cutter: marks the bytes at which pre-tokens begin. ``begins``: where texts begin."""
    marks = np.zeros(len(data), bool)
    if not len(data):
        return marks
    at, points = code_points(data)
    kind = classes[points]
    first = np.zeros(len(at) + 1, bool)
    first[np.searchsorted(at, begins)] = True
    first[-1] = True
    ends = first[1:]
    first = first[:-1]
    before = np.concatenate([[OTHER], kind[:-1]]).astype(np.uint8)
    after = np.concatenate([kind[1:], [OTHER]])
    white = kind >= WHITE
    start = first | np.where(
        white,
        # A run of white space, and its last character where something follows.
        (before < WHITE) | ((after < WHITE) & ~ends),
        # Anything joins the blank before it, and its own kind.
        (before != BLANK) & (before != kind),
    )
    quotes = np.flatnonzero(start & (points == 0x27))
    if len(quotes):
        last = np.concatenate([points, np.zeros(3, np.int32)])
        cut = np.concatenate([first, np.ones(3, bool)])
        one, two = last[quotes + 1], last[quotes + 2]
        inside = ~cut[quotes + 1]
        single = inside & np.isin(one, np.frombuffer(AFTER_ONE, np.uint8))
        double = np.zeros(len(quotes), bool)
        for a, b in AFTER_TWO:
            double |= (one == a) & (two == b)
        double &= inside & ~cut[quotes + 2]
        for i, n in ((quotes[single], 1), (quotes[double], 2)):
            for k in range(1, n + 1):
                start[i + k] = False
            nxt = i + n + 1
            start[nxt[nxt < len(start)]] = True
    marks[at[start]] = True
    return marks


def byte_letters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: itself where it prints, else from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class Counter:
    """The counting transducer, compiled as far as texts have needed it.

    A state is a tuple of (suffix, fence, tokens since, negated), longest suffix first. The fence says
    what can't follow the last token before the suffix: parts that this token's end would merge with.
    Tokens with the same fence behave alike, which keeps the states few. State 0 has read nothing;
    state 1 stands for an unknown one and counts nothing.
    """

    FRESH, UNKNOWN = ((b"", 0, 0),), ()

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        known = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if model["type"] != "BPE" or not plain or spec["normalizer"] or any(cut.get(k) != v for k, v in known.items()):
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        added = spec["added_tokens"]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added tokens that take in their surroundings are not supported")
        self.special = re.compile(b"|".join(re.escape(t["content"].encode()) for t in added)) if added else None

        byte = {c: b for b, c in enumerate(byte_letters())}
        spell = {w: bytes(byte[c] for c in w) for w in model["vocab"]}
        self.ids = {spell[w]: i for w, i in model["vocab"].items()}
        self.bytes_of = {i: w for w, i in self.ids.items()}
        #: (left, right) -> (rank, merged)
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            a, b = (spell[x] for x in (m.split(" ") if isinstance(m, str) else m))
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        made = {self.bytes_of[i] for _, i in self.merges.values()}
        self.ids = {w: i for w, i in self.ids.items() if len(w) == 1 or w in made}
        self._spines()
        self._clear()

    def _clear(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.table = np.full(1024 << 8, -1, np.int32)
        self._state(self.FRESH)
        self._state(self.UNKNOWN)
        self.table[256:512] = (1 << 8) | 127

    def _state(self, key: tuple) -> int:
        i = self.number.get(key)
        if i is None:
            i = self.number[key] = len(self.states)
            self.states.append(key)
            if (i + 1) << 8 > len(self.table):
                self.table = np.concatenate([self.table, np.full(len(self.table), -1, np.int32)])
        return i

    def _spines(self) -> None:
        """For every token its first parts (what its left edge was while it was made) with the rank at
        which each went into a larger one, and of its last parts the merges they could still make."""
        halves = {m[1]: (p, m[0]) for p, m in self.merges.items()}
        right_of: dict[int, list[tuple[int, int]]] = {}
        for (a, b), (rank, _) in self.merges.items():
            right_of.setdefault(a, []).append((rank, b))
        self.halves, self.right_of = halves, {a: sorted(m) for a, m in right_of.items()}
        self.left_parts: dict[int, list[tuple[bytes, int]]] = {}
        self.fences: list[dict[bytes, int]] = [{}]
        self.fence_number: dict[frozenset, int] = {frozenset(): 0}
        self.fence_after: dict[int, int] = {}
        self.narrower: dict[tuple[int, bytes], int] = {}
        #: The tokens that begin with an opening, where these are few.
        self.ways: dict[bytes, list[int] | None] = {}
        for w, i in self.ids.items():
            for k in range(1, len(w)):
                some = self.ways.setdefault(w[:k], [])
                if some is not None:
                    some.append(i)
                    if len(some) > FEW:
                        self.ways[w[:k]] = None

    def lefts(self, token: int) -> list[tuple[bytes, int]]:
        """A token's first parts, itself included, and the ranks at which they were taken up."""
        found = self.left_parts.get(token)
        if found is None:
            found, part, until = [], token, len(self.merges)
            while True:
                found.append((self.bytes_of[part], until))
                if part not in self.halves:
                    break
                (part, _), until = self.halves[part]
            self.left_parts[token] = found
        return found

    def _fence(self, bars: dict[bytes, int]) -> int:
        key = frozenset(bars.items())
        i = self.fence_number.get(key)
        if i is None:
            i = self.fence_number[key] = len(self.fences)
            self.fences.append(bars)
        return i

    def fence(self, token: int) -> int:
        """What can't follow a token: part -> lowest rank at which the token's end would merge with it."""
        found = self.fence_after.get(token)
        if found is None:
            bars: dict[bytes, int] = {}
            part, until = token, len(self.merges)
            while True:
                for rank, right in self.right_of.get(part, ()):
                    if rank >= until:
                        break
                    w = self.bytes_of[right]
                    bars[w] = min(rank, bars.get(w, rank))
                if part not in self.halves:
                    break
                (_, part), until = self.halves[part]
            found = self.fence_after[token] = self._fence(bars)
        return found

    def fits(self, fence: int, token: int) -> bool:
        """Whether a token may follow: no part of its left edge merges across before it is taken up.
        Of equal merges the left one comes first, so one that lies across goes before one in the token."""
        bars = self.fences[fence]
        return not bars or all(bars.get(w, until + 1) > until for w, until in self.lefts(token))

    def narrow(self, fence: int, suffix: bytes) -> int | None:
        """The fence as far as it concerns tokens that begin with ``suffix``; None where no such token fits."""
        key = (fence, suffix)
        if key not in self.narrower:
            if len(self.narrower) >= MOST_PAIRS:
                self.narrower.clear()
            few = self.ways[suffix]
            if few is not None and not any(self.fits(fence, t) for t in few):
                self.narrower[key] = None
            else:
                bars = {w: r for w, r in self.fences[fence].items() if w.startswith(suffix) or suffix.startswith(w)}
                self.narrower[key] = self._fence(bars)
        return self.narrower[key]

    def step(self, state: tuple, byte: bytes) -> tuple[tuple, int]:
        """The next state and the change in the number of tokens."""
        for suffix, fence, since in state:
            token = self.ids.get(suffix + byte)
            if token is not None and self.fits(fence, token):
                break
        else:
            raise ValueError("no token fits: the merges do not form a BPE vocabulary")
        change, live = since + 1, []
        for suffix, fence, since in state:
            longer = suffix + byte
            if longer in self.ways and (rest := self.narrow(fence, longer)) is not None:
                live.append((longer, rest, since - change))
        return (*live, (b"", self.fence(token), 0)), change

    def _compile(self, cells: np.ndarray) -> None:
        for cell in cells.tolist():
            state, change = self.step(self.states[cell >> 8], bytes([cell & 255]))
            i = self._state(state)
            self.table[cell] = (i << 8) | (change + 127)

    def _restart(self, live: list[np.ndarray]) -> None:
        """A new table with the states in use; the arrays are renumbered in place."""
        used = np.unique(np.concatenate(live))
        keys = [self.states[s >> 8] for s in used.tolist()]
        self._clear()
        fresh = np.array([self._state(k) << 8 for k in keys], np.int32)
        for a in live:
            a[:] = fresh[np.searchsorted(used, a)]

    def advance(
        self, data: np.ndarray, marks: np.ndarray, lengths: np.ndarray, state: np.ndarray, out: np.ndarray, keep: list[np.ndarray]
    ) -> None:
        """Run rows of ``data`` side by side, ``lengths`` bytes each (longest first), from ``state``.

        ``state`` becomes the end states; ``out`` gets each byte's change plus 127; ``keep`` holds further
        arrays of states that a new table must renumber.
        """
        steps = int(lengths[0]) if len(lengths) else 0
        running = np.searchsorted(-lengths, -np.arange(steps), side="left") if steps else []
        cols, flags = np.ascontiguousarray(data[:, :steps].T), np.ascontiguousarray(marks[:, :steps].T)
        cell, got = np.empty(len(state), np.int32), np.empty(len(state), np.int32)
        for t in range(steps):
            n = int(running[t])
            s, c, v = state[:n], cell[:n], got[:n]
            np.copyto(s, 0, where=flags[t, :n])
            np.add(s, cols[t, :n], out=c)
            np.take(self.table, c, out=v, mode="clip")
            while int(v.min()) < 0:
                missing = np.unique(c[v < 0])
                if len(self.states) + len(missing) > MOST_STATES:
                    self._restart([state, *keep])
                    np.add(s, cols[t, :n], out=c)
                    missing = np.unique(c[np.take(self.table, c) < 0])
                self._compile(missing)
                np.take(self.table, c, out=v, mode="clip")
            out[:n, t] = v & 255
            np.bitwise_and(v, ~255, out=s)

    def changes(self, data: np.ndarray, marks: np.ndarray, state: tuple) -> tuple[np.ndarray, tuple]:
        """Each byte's change in the number of tokens, reading on from ``state``; and the state at the end,
        which holds where the bytes fill whole chunks."""
        n = -(-len(data) // CHUNK)
        room = n * CHUNK - len(data)
        bytes_ = np.concatenate([data, np.zeros(room, np.uint8)]).reshape(n, CHUNK)
        flags = np.concatenate([marks, np.zeros(room, bool)]).reshape(n, CHUNK)
        out = np.full((n, CHUNK), 127, np.uint8)
        whole = np.full(n, CHUNK)
        first = np.where(flags.any(axis=1), flags.argmax(axis=1), CHUNK)
        constant = first < CHUNK

        # Maps of chunks in which a pre-token begins: constant from there on.
        end = np.full(n, 1 << 8, np.int32)
        start = np.array([self._state(state) << 8], np.int32)
        self.advance(bytes_, flags, whole, end, out, [start])

        # The others: one entry each, from the state that the bytes before suggest.
        rest = np.flatnonzero(~constant)
        guess = np.zeros(n, np.int32)
        if len(rest):
            deep = rest[(rest > 0) & ~constant[rest - 1]]
            warm = np.zeros(len(deep), np.int32)
            self.advance(bytes_[deep - 1], flags[deep - 1], whole[deep], warm, np.empty((len(deep), CHUNK), np.uint8), [start, end])
            guess[deep] = warm
            shallow = rest[(rest > 0) & constant[rest - 1]]
            guess[shallow] = end[shallow - 1]
            guess[rest[rest == 0]] = start[0]
            todo = rest
            while len(todo):
                s, o = guess[todo].copy(), np.empty((len(todo), CHUNK), np.uint8)
                self.advance(bytes_[todo], flags[todo], whole[todo], s, o, [start, end, guess])
                end[todo], out[todo] = s, o
                # Compose: a chunk's state is known if all maps since the last constant one fit together.
                before = np.concatenate([start, end[:-1]])
                index = np.arange(n)
                broken = ~constant & (guess != before)
                last_broken = np.maximum.accumulate(np.where(broken, index, -1))
                last_constant = np.maximum.accumulate(np.where(constant, index, -1))
                previous = np.concatenate([[-1], last_broken[:-1]])
                todo = index[broken & (previous <= last_constant)]
                guess[todo] = before[todo]

        # Bytes before each chunk's first pre-token, from the states that the scan found.
        heads = np.flatnonzero(constant & (first > 0))
        heads = heads[np.argsort(-first[heads], kind="stable")]
        s = np.concatenate([start, end[:-1]])[heads]
        o = np.empty((len(heads), CHUNK), np.uint8)
        if len(heads):
            self.advance(bytes_[heads], flags[heads], first[heads], s, o, [start, end])
            inside = np.arange(CHUNK) < first[heads][:, None]
            out[heads] = np.where(inside, o, out[heads])
        final = self.states[int(end[-1]) >> 8] if n else state
        return out.reshape(-1)[: len(data)].astype(np.int16) - 127, final


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def _long(auto: Counter, data: np.ndarray, classes: np.ndarray) -> int:
    """Tokens of one text, piece by piece."""
    total, state = 0, Counter.FRESH
    for a in range(0, len(data), PIECE):
        b = min(a + PIECE, len(data))
        lo, hi = max(0, a - AROUND), min(len(data), b + AROUND)
        while lo and (data[lo] & 0xC0) == 0x80:
            lo += 1
        while hi < len(data) and (data[hi] & 0xC0) == 0x80:
            hi -= 1
        marks = pretoken_starts(data[lo:hi], np.array([0]), classes)[a - lo : b - lo]
        changes, state = auto.changes(data[a:b], marks, state)
        total += int(changes.sum(dtype=np.int64))
    return total


def _short(auto: Counter, parts: list[bytes], classes: np.ndarray) -> np.ndarray:
    """Tokens of each of some texts that are not empty, all in one run."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
    changes, _ = auto.changes(data, pretoken_starts(data, begins, classes), Counter.FRESH)
    return np.add.reduceat(changes, begins, dtype=np.int64)


def count_all(auto: Counter, column: list[bytes], classes: np.ndarray) -> np.ndarray:
    """Tokens of each text, special tokens counted as one each."""
    counts = np.zeros(len(column), np.int64)
    held, rows, size = [], [], 0

    def close() -> None:
        if held:
            np.add.at(counts, rows, _short(auto, held, classes))
            held.clear()
            rows.clear()

    for i, text in enumerate(column):
        parts = auto.special.split(text) if auto.special else [text]
        counts[i] += len(parts) - 1
        for part in parts:
            if len(part) > PIECE:
                counts[i] += _long(auto, np.frombuffer(part, np.uint8), classes)
            elif part:
                if size + len(part) > PIECE:
                    close()
                    size = 0
                held.append(part)
                rows.append(i)
                size += len(part)
    close()
    return counts


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every document."""
    prepare(docs.sparkSession)
    packed = character_classes(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.frombuffer(zlib.decompress(packed), np.uint8)
        auto = counter(path)
        for batch in slices(batches):
            column = batch.column("text").cast(pa.large_binary()).to_pylist()
            n = count_all(auto, column, classes)
            size = np.array([len(t) for t in column], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts(docs).mapInArrow(count, RESULT)
