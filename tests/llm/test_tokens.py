import zlib

import numpy as np
import pytest
from conftest_llm import documents, rows_of

from cobble.llm import tokens
from cobble.llm.queries import op1_tokens, tokenizer_path
from cobble.session import shared_scratch


def brute(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_whole_text_encoding(spark, sf, real):
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op1_tokens(spark, sf).collect()]
    assert sorted(got) == sorted(brute(real))


def test_odd_texts(spark, odd):
    got = rows_of(tokens.token_output(documents(spark, odd), tokenizer_path()))
    want = brute(odd)
    assert sorted(x[2:4] for x in got) == sorted(x[2:] for x in want)
    assert sorted((x[0] or 0, x[2], x[3]) for x in got) == sorted((x[0] or 0, x[2], x[3]) for x in want)
    # Starts follow one another without gaps.
    by_start = sorted(got, key=lambda x: x[1])
    assert [x[1] for x in by_start] == [0, *np.cumsum([x[2] for x in by_start])[:-1]]
    ids = [x[0] for x in by_start]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_cache_renewal_and_special_strings(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    enc, tok = tokens.WordEncoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    texts = ["a bc d e", "", "e f<|endoftext|>g bc", "a a a x don't 12abéé İI"] * 3
    for part in (texts[:2], texts):
        ids, bounds = enc(pa.array(part))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [
            tok.encode(t, add_special_tokens=False).ids for t in part
        ]


def test_one_document_and_dictionary(spark, real):
    out = shared_scratch(spark, "tokens-test")
    tokens.write_tokens(documents(spark, real), out, tokenizer_path())
    sha, width, dictionary = tokens.read_dictionary(spark, out)
    assert width == 2 and len(dictionary) > 0
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    for d, t in real[:3]:
        (ids,) = tokens.read_document(spark, out, d)
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids + [2]
    with pytest.raises(ValueError):
        tokens.opener(dictionary, sha, width)(b"", "other")


def test_empty(spark):
    assert tokens.token_output(documents(spark, []), tokenizer_path()).count() == 0
