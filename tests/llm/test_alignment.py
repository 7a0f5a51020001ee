import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import documents, rows_of

from cobble.llm import alignment as L
from cobble.llm.queries import op12_alignment, tokenizer_path
from cobble.llm.token_counts import character_classes

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def groups_of(libraries, text):
    """The groups of a text, encoded whole, as lists of ids; empty without tokens."""
    a, b = libraries
    if not text:
        return []
    whole = (" " + text).encode()
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [x for x in range(256) if x not in printing]
    byte = {chr(x): x for x in printing} | {chr(256 + i): x for i, x in enumerate(other)}
    enc = a.encode(" " + text, add_special_tokens=False)
    a_tokens = [(i, bytes(byte[c] for c in w)) for i, w in zip(enc.ids, enc.tokens)]
    b_tokens = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        b_tokens.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()))
    if any(b"".join(w for _, w in x) != whole for x in (a_tokens, b_tokens)):
        return []
    ends = []
    for tokens in (a_tokens, b_tokens):
        at, out = 0, []
        for i, w in tokens:
            at += len(w)
            out.append((i, at))
        ends.append(out)
    common = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
    groups = [[[], []] for _ in common]
    for side, tokens in enumerate(ends):
        for i, e in tokens:
            groups[bisect_left(common, e)][side].append(i)
    return groups


def brute(libraries, rows):
    docs = [(d, groups_of(libraries, t)) for d, t in rows]
    linked = [Counter((a, b) for ga, gb in groups for a in ga for b in gb) for _, groups in docs]
    total = Counter(p for c in linked for p in c)
    top = defaultdict(int)
    for (a, _), n in total.items():
        top[a] = max(top[a], n)
    out = []
    for (d, groups), c in zip(docs, linked):
        text = ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
        out.append((
            d, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(c.values()),
            sum(n for p, n in c.items() if total[p] == top[p[0]]), sum(n * total[p] for p, n in c.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


ODD = [
    (20, "a\u2581b"), (21, "  two  blanks   end  "), (22, " "), (23, "    "), (24, "<s></s><unk><|endoftext|><0x0A>\x00\x01"),
    (25, "\u3000a\u200bb ﬁ \ufeff \r\n\t"), (26, "日本語のテキスト"), (27, "x" * 500), (28, "internationalization unbelievably"),
    (29, "é" * 40 + "\U0001f600" * 30),
]


def test_query_against_whole_texts(spark, sf, real, libraries):
    got = op12_alignment(spark, sf)
    assert got.columns == L._RESULT_NAMES
    assert sorted(rows_of(got), key=str) == brute(libraries, real)


def test_odd_rows(spark, odd, libraries):
    rows = odd + ODD
    assert sorted(rows_of(L.align(documents(spark, rows), A, B)), key=str) == brute(libraries, rows)


@pytest.mark.parametrize("size", [40, 200])
def test_ranges_of_long_documents(spark, odd, real, libraries, monkeypatch, size):
    """Every text of more than a few bytes goes through ranges, fragments and the tree."""
    monkeypatch.setattr(L, "FAN", 3)
    rows = [(d, t[:4000] if t else t) for d, t in odd + ODD + real[:25]]
    rows += [(1000, "no place to cut" + "x1" * 200 + " and then words again " * 20), (1001, "\u2581 " + "some words here " * 50)]
    got = L.align(documents(spark, rows), A, B, range_bytes=size)
    assert sorted(rows_of(got), key=str) == brute(libraries, rows)


def test_empty(spark):
    assert L.align(documents(spark, []), A, B).collect() == []
    assert rows_of(L.align(documents(spark, [(1, None), (None, "")]), A, B)) == [(d, 0, 0, 0, 0, 0, 0, "") for d in (1, None)]


def test_composition_is_associative(libraries):
    t = L.tools(A, B, character_classes(A))
    rng = random.Random(5)
    text = (" " + " ".join(rng.choice(["misalignment", "x1y2", "日本語", "don't", "under_score", "a"]) for _ in range(40))).encode()
    parts = []
    for k, low in enumerate(range(0, len(text), 4)):
        ends, _ = L.fragment(t, text, 0, low, min(low + 4, len(text)))
        ends = {n: v.tolist() if isinstance(v, np.ndarray) else v for n, v in ends.items()}
        parts.append(ends | {"k": k, "first": k, "joints": []})
    assert len(parts) > 10 and not all(p["cut"] for p in parts)

    def fold(some):
        while len(some) > 1:
            i = rng.randrange(len(some) - 1)
            some = [*some[:i], L.compose(some[i], some[i + 1]), *some[i + 2 :]]
        return some[0]

    first = fold(parts)
    assert all(fold(parts) == first for _ in range(20))


def test_large_groups_are_counted_by_ids(monkeypatch):
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 9, 60), rng.integers(0, 9, 50)
    one = np.zeros(60, np.int64), np.zeros(50, np.int64)
    g = L.Groups(a, b, *one, np.array([60]), np.array([50]))
    plain = L.link_pairs(g, np.zeros(1, np.int64))
    monkeypatch.setattr(L, "MANY_LINKS", 10)
    many = L.link_pairs(g, np.zeros(1, np.int64))
    assert [x.tolist() for x in plain] == [x.tolist() for x in many]


def test_packed_numbers():
    for values in ([], [0, 1, 255, 256, (1 << 32) - 1], [5, 1 << 40, 7]):
        v = np.array(values, np.int64)
        assert L._unpack_counts(L._pack_counts(v), len(v)).tolist() == values
