import random
import zlib

import numpy as np
import pytest
from conftest_llm import documents, rows_of

from cobble.llm import token_counts as C
from cobble.llm.queries import op13_token_counts, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def classes():
    return np.frombuffer(zlib.decompress(C.character_classes(PATH)), np.uint8)


def whole(library, rows):
    out = []
    for d, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        out.append((d, len((t or "").encode()), n, n > 512))
    return sorted(out, key=str)


def test_query_against_the_library(spark, sf, real, library):
    got = op13_token_counts(spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(rows_of(got), key=str) == whole(library, real)


def test_odd_rows(spark, odd, library):
    rows = [*odd, (20, "a<|endoftext|>  <|endoftext|><|endoftext|>\n\n"), (21, "<|endoftext|>"), (22, "  "), (23, "don't I'LL we've 's's \u3000'd")]
    assert sorted(rows_of(C.token_counts(documents(spark, rows), PATH)), key=str) == whole(library, rows)


def test_empty(spark):
    assert C.token_counts(documents(spark, []), PATH).collect() == []


PARTS = [
    "a", "b", "s", "'", "re", "ve", "ll", " ", "  ", "\n", "\t", "1", "23", "é", "日", "\u3000", " !", "?", "<|endoftext|>",
    "<|endoftext", "the", "ing", " '", "'s", "😀", "\x00", "m", "t", "d", "\u0301", "½", "٣",
]


def texts(rng, n, most=30):
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(most))) for _ in range(n)]
    spans = [(32, 127), (0xA0, 0x500), (0x3000, 0x9FFF), (0x10000, 0x1FFFF)]
    wild = ["".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(rng.randrange(most))) for _ in range(n // 4)]
    letters = ["".join(rng.choice("abehiknorstu") for _ in range(rng.randrange(most))) for _ in range(n // 4)]
    return mixed + wild + letters


def counted(auto, classes, some):
    return C.count_all(auto, [t.encode() for t in some], classes).tolist()


def encoded(library, some):
    return [len(library.encode(t, add_special_tokens=False).ids) for t in some]


def test_random_texts(library, classes):
    some = texts(random.Random(1), 3000) + texts(random.Random(2), 40, 2000)
    assert counted(C.Counter(PATH), classes, some) == encoded(library, some)


@pytest.mark.parametrize("chunk, piece, states", [(4, 64, 50), (16, 32, 1 << 17), (256, 512, 300)])
def test_chunks_pieces_and_new_tables(library, classes, monkeypatch, chunk, piece, states):
    """Long runs without a pre-token's beginning, cut anywhere, with the table starting anew often."""
    monkeypatch.setattr(C, "CHUNK", chunk)
    monkeypatch.setattr(C, "PIECE", piece)
    monkeypatch.setattr(C, "MOST_STATES", states)
    rng = random.Random(3)
    runs = ["a" * 700, "ab" * 300, "日本" * 200, " " * 300 + "x", "!?" * 300, "".join(rng.choice("aeinst") for _ in range(900))]
    some = texts(rng, 200, 60) + runs + [" ".join(runs), "'s" * 90, "it's " * 50]
    assert counted(C.Counter(PATH), classes, some) == encoded(library, some)


def test_transitions_count_prefixes(library):
    """The changes along a word add up to the number of tokens of every prefix."""
    auto = C.Counter(PATH)
    for word in (b" unbelievable", b"aaaaaaaaaaaaaaaaaaaa", b"xyzzyhousekeeping", b"!!!!!!!!!??"):
        state, n = C.Counter.FRESH, 0
        for k in range(len(word)):
            state, change = auto.step(state, word[k : k + 1])
            n += change
            assert n == len(library.model.tokenize("".join(C.byte_letters()[b] for b in word[: k + 1])))


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        C.Counter(tokenizer_path())
