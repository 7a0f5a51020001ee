import hashlib
import random

import numpy as np
import pytest
from conftest_llm import documents, rows_of

from cobble.llm import lcp as L
from cobble.llm.queries import op6_fingerprints


# One symbol at a time, by the definition, against the arrays.


def toss(symbols):
    out = []
    for i, s in enumerate(symbols):
        left = symbols[i - 1] if i else s ^ 1
        low = ((s ^ left) & -(s ^ left)).bit_length() - 1
        out.append(2 * low + (s >> low & 1))
    return out


def brute_labels(symbols):
    own = symbols
    for _ in range(4):
        own = toss(own)
    assert all(x < 6 for x in own)
    for c in (5, 4, 3):
        around = [None, *own, None]
        own = [min({0, 1, 2} - {around[i], around[i + 2]}) if x == c else x for i, x in enumerate(own)]
    return own


MASK = 2**64 - 1
PLACES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


def mix(x):
    x = x * PLACES[0] & MASK
    x ^= x >> 29
    x = x * PLACES[1] & MASK
    return x ^ x >> 32


def brute_level(symbols, level):
    """Phrases as (name, number of symbols below)."""
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    symbols = [mix(s + PLACES[2] * n & MASK) if n > 1 else s for s, n in runs]
    own = brute_labels(symbols)
    phrases, below = [], []
    for i, s in enumerate(symbols):
        peak = 0 < i and own[i] > own[i - 1] and (i + 1 == len(own) or own[i] > own[i + 1])
        if i == 0 or peak:
            phrases.append([])
            below.append(0)
        phrases[-1].append(s)
        below[-1] += runs[i][1]
    assert all(len(p) <= 5 for p in phrases)
    names = [mix(sum(mix(s + level + 1 & MASK) * PLACES[min(k, 4)] + k for k, s in enumerate(p)) & MASK) for p in phrases]
    return names, below


def brute_print(text):
    if not text:
        return "top:;3:;2:;1:"
    hexed = lambda names, n: "".join(f"{x:08x}" for x in sorted({x >> 32 for x in names})[:n])
    symbols, parts, upper, level = [ord(c) for c in text], [], "", 0
    while level < 3 or len(symbols) > 4:
        level += 1
        symbols, _ = brute_level(symbols, level)
        if level == 3 or level < 3 and len(text) < 512:
            parts.insert(0, f"{level}:{hexed(symbols, 48)}")
        elif level > 3:
            upper += hexed(symbols, 4)
    root = mix(sum(mix(s + level + 1 & MASK) * PLACES[k] + k for k, s in enumerate(symbols)) & MASK)
    return ";".join([f"top:{root:016x}{upper}", *parts])


TEXTS = ["", "a", "aa", "ab", "aaaa bbbb", "hello world " * 3, "日本語😀" * 40, "".join(chr(97 + i * i % 26) for i in range(900))]


def test_fingerprints_against_definition(real):
    texts = TEXTS + [t[:2000] for _, t in real[:12]]
    want = [brute_print(t) for t in texts]
    assert L.fingerprints_of(texts) == want
    assert [L.fingerprints_of([t])[0] for t in texts] == want  # neighbours in a batch don't matter


def test_phrases_against_definition(real):
    for text in [t for t in TEXTS if t] + [real[0][1][:1500]]:
        symbols, spans = [ord(c) for c in text], [(i, i + 1) for i in range(len(text))]
        for level in (1, 2, 3):
            symbols, below = brute_level(symbols, level)
            at, merged = 0, []
            for n in below:
                merged.append((spans[at][0], spans[at + n - 1][1]))
                at += n
            spans = merged
            got = L.phrases_of(text, level)
            assert [(x & MASK, a, b) for x, a, b in got] == [(x, a, b) for x, (a, b) in zip(symbols, spans)]


@pytest.mark.parametrize("n", [1_800, 18_000, 119_000])
def test_any_edit_changes_the_fingerprint(n):
    rng = random.Random(n)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n // 6)]
    texts = [" ".join(words)]
    for _ in range(20):
        k = rng.randrange(len(words) - 50)
        texts.append(" ".join([*words[:k], "other", *words[k + 1 :]]))
        texts.append(" ".join([*words[:k], *(w[::-1] + "x" for w in words[k : k + 50]), *words[k + 50 :]]))
    prints = L.fingerprints_of(texts)
    assert len(set(prints)) == len(set(texts))
    assert all(L.likeness(prints[0], p) < 1 for p, t in zip(prints, texts) if t != texts[0])


def test_a_passage_that_two_very_long_texts_share(spark):
    rng = random.Random(31)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    shared = text(50)
    rows = [(i, f"{text(9000 + 700 * i)} {shared} {text(9000)}") for i in range(2)]
    names = L.phrase_names(documents(spark, [*rows, (2, None), (3, "")]))
    found = names.alias("a").join(names.alias("b"), "name").filter("a.doc_id = 0 AND b.doc_id = 1").select("a.start", "a.stop").collect()
    at = rows[0][1].index(shared)
    inside = [r for r in found if at <= r.start and r.stop <= at + len(shared)]
    assert sum(r.stop - r.start for r in inside) > 0.6 * len(shared)
    assert L.phrase_names(documents(spark, [])).count() == 0


def test_labels_are_proper():
    rng = np.random.default_rng(2)
    for kind in (np.uint32, np.uint64):
        symbols = rng.integers(0, 50, 5000).astype(kind)
        symbols = symbols[np.append(True, symbols[1:] != symbols[:-1])]
        own = L.labels(symbols, np.array([0]))
        assert set(own.tolist()) <= {0, 1, 2} and (own[1:] != own[:-1]).all()


def test_equal_substrings_share_names_at_any_offset():
    rng = random.Random(4)
    middle = "".join(rng.choice("abcdefgh ") for _ in range(600))
    names = []
    for _ in range(6):
        around = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(1, 200))) for _ in range(2)]
        symbols, first = np.array([ord(c) for c in around[0] + middle + around[1]], np.uint32), np.array([0])
        for level in (1, 2, 3):
            symbols, first = L.next_level(symbols, first, level)
        names.append(set(symbols.tolist()))
    shared = set.intersection(*names)
    assert len(shared) >= 15  # of about 600 / 15


@pytest.mark.parametrize("n", [400, 3000])
def test_likeness_follows_the_shared_part(n):
    rng = random.Random(n)
    text = lambda k: "".join(rng.choice("abcdefghijklm nopq") for _ in range(k))
    a, b = text(n), text(n)
    pa, pb, pe, ph = L.fingerprints_of([a, b, L.edited(a, b), a[: n // 2] + b[: n // 2]])
    assert L.likeness(pa, pa) == 1.0
    assert L.likeness(pa, pb) < 0.1
    assert 0.3 < L.likeness(pa, pe) < 0.75  # two thirds shared: a Jaccard similarity of one half
    assert L.likeness(pa, ph) < L.likeness(pa, pe) + 0.1
    assert L.likeness(pa, L.fingerprints_of([""])[0]) == 0.0


def check(rows, docs):
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {}
    for r in rows:
        got.setdefault(r[0], []).append(r)
    assert sum(map(len, got.values())) == len(docs)
    for i, (d, t) in enumerate(order):
        t = t or ""
        after = order[(i + 1) % len(order)][1] or ""
        if sum(x[0] == d for x in docs) > 1 or sum(x[0] == order[(i + 1) % len(order)][0] for x in docs) > 1:
            continue  # ties: any order among equal ids is tested by count alone
        new = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        prints = L.fingerprints_of([t, new, after])
        want = (d, len(t), hashlib.sha256(new.encode()).hexdigest(), prints[0], prints[1])
        (row,) = got[d]
        assert row[:5] == want
        assert row[5] == L.likeness(*prints[:2]) and row[6] == L.likeness(prints[0], prints[2])


def test_query_against_brute_force(spark, sf, real):
    rows = rows_of(op6_fingerprints(spark, sf))
    check(rows, real)
    whole = [r for r in rows if r[1] > 2000]
    assert sum(r[5] for r in whole) / len(whole) > 0.35
    assert all(0 <= x <= 1 for r in rows for x in r[5:])


def test_odd_texts(spark, odd):
    check(rows_of(L.fingerprint_documents(documents(spark, odd))), odd)


def test_one_and_no_document(spark):
    ((d, n, _, a, b, near, after),) = rows_of(L.fingerprint_documents(documents(spark, [(3, "abcdef")])))
    assert (d, n, after) == (3, 6, 1.0) and b == L.fingerprints_of(["abcdab"])[0] and a == L.fingerprints_of(["abcdef"])[0]
    assert L.fingerprint_documents(documents(spark, [])).count() == 0
