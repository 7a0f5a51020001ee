import random
import re

import xxhash
from conftest_llm import documents, rows_of

from cobble.llm import simhash as S
from cobble.llm.queries import op3_simhash


def brute_print(text):
    low = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(docs, bits=2):
    prints = [brute_print(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, (d, _) in zip(group, docs):
        least[g] = min((x for x in (least.get(g), d) if x is not None), default=None)
    return sorted((d or -1, f"{p:016x}", least[g] if least[g] is not None else -1) for (d, _), p, g in zip(docs, prints, group))


def clean(rows):
    return sorted((d or -1, p, c if c is not None else -1) for d, p, c in rows)


def test_query_against_all_pairs(spark, sf, real):
    assert clean(rows_of(op3_simhash(spark, sf))) == brute(real)


def test_odd_texts(spark, odd):
    assert clean(rows_of(S.near_duplicates(documents(spark, odd)))) == brute(odd)


def grouped(prints, bits):
    left, out = set(prints), set()
    while left:
        todo = [left.pop()]
        own = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= bits}
            left -= near
            own |= near
            todo += near
        out.add(frozenset(own))
    return out


def linked(spark, prints, bits, hot):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    distinct = spark.createDataFrame([(signed(x),) for x in prints], "fp bigint")
    roots = rows_of(S.components(S.links(distinct, bits, hot)))
    out = {}
    for node, root in roots:
        out.setdefault(root, set()).add(node % (1 << 64))
    alone = set(prints) - {x for g in out.values() for x in g}
    return {frozenset(g) for g in out.values()} | {frozenset([x]) for x in alone}


def cloud(rng, n, centres, flips):
    out = set()
    for _ in range(n):
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, flips)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


def test_links_at_random_and_with_hot_values(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(4)]
    # Many fingerprints around few centres: their halves are shared far over the limits tried here.
    for bits in (0, 2, 4):
        prints = cloud(rng, 400, centres, 5)
        want = grouped(prints, bits)
        for hot in (1_000_000, 3):
            assert linked(spark, prints, bits, hot) == want, (bits, hot)


def test_chain_is_one_component(spark):
    prints = [(1 << k) - 1 for k in range(0, 65, 2)]
    assert linked(spark, prints, 2, 64) == {frozenset(prints)}


def test_keep_one(spark, odd):
    rows = odd + [(30, "One two three")]
    kept = S.keep_one(documents(spark, rows))
    ids = [r.doc_id for r in kept.collect()]
    want = {c for _, _, c in brute(rows) if c != -1}
    assert {i for i in ids if i is not None} == want
    assert len([i for i in ids if i is not None]) == len(want)
    assert kept.columns == documents(spark, rows).columns


def test_empty(spark):
    assert S.near_duplicates(documents(spark, [])).count() == 0
