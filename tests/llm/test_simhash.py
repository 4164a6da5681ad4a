import random
from itertools import combinations

import numpy as np
import xxhash
from starforge.llm import simhash
from starforge.llm.common import components

from corpus_texts import docs_of, sentence  # noqa: F401


def brute_print(text, n):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(prints, bits):
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(nodes, 2):
        if bin(a ^ b).count("1") <= bits:
            root[find(b)] = find(a)
    return {n: find(n) for n in nodes}


def test_sets_cover_every_choice():
    sets = simhash.position_sets(5, 4)
    assert all(any(set(s) <= set(c) for s in sets) for c in combinations(range(8), 5))


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:40]:
        for _ in range(6):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    for block in (512, 3):  # also with buckets cut into many blocks
        links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 3, block)
        got = {r["node"]: r["root"] for r in components(links).collect()}
        want = brute_components([s[0] & (1 << 64) - 1 for s in signed], 3)
        classes = {}
        for (s,) in signed:
            classes.setdefault(want[s & (1 << 64) - 1], set()).add(s)
        for members in classes.values():
            assert len({got.get(m, m) for m in members}) == 1
        assert len({got.get(s, s) for (s,) in signed}) == len(classes)


def test_documents(docs_of):
    base = sentence(1, 300)
    pairs = [(9, base), (4, base.upper()), (7, base + " more"), (5, sentence(2, 50)), (6, None), (3, ""), (8, " \n"), (None, base)]
    pairs += [(5, sentence(2, 50)), (11, "one"), (12, "two words"), (13, sentence(3, 30_000))]
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs_of(pairs)).collect()}
    prints = [brute_print(t, 3) for _, t in pairs]
    root = brute_components(prints, 3)
    least = {}
    for (i, _), p in zip(pairs, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    assert got == {(i, f"{p:016x}", least[root[p]]) for (i, _), p in zip(pairs, prints)}


def test_one_of_each(docs_of):
    base = sentence(1, 300)
    pairs = [(9, base), (4, base), (4, base), (None, base), (6, None), (3, ""), (None, "alone here now"), (8, sentence(4, 80)), (8, sentence(5, 80))]
    kept = simhash.one_of_each(docs_of(pairs))
    assert kept.columns == docs_of([]).columns
    rows = [(r["doc_id"], r["text"], r["_r1"]) for r in kept.collect()]
    want = [(4, base, 1), (3, "", 1), (None, "alone here now", 1), (8, sentence(4, 80), 1), (8, sentence(5, 80), 1)]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert simhash.one_of_each(docs_of([])).count() == 0


def test_long_chain_is_one_component(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1001), (5000, 1000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1001: 1000, 5000: 1000}
