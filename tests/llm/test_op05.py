"""SimHash: fingerprints and components against plain loops."""

import random

import numpy as np
import xxhash

from finsieve.llm import op05_simhash as simhash
from finsieve.llm.components import components
from tests.llm.helpers import AWKWARD, docs


def plain(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    size = min(3, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + size]), 42) for i in range(len(w) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, radius):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    known = sorted(prints)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in known}


def check(spark, texts, **how):
    got = sorted(((r.id, int.from_bytes(r.fp, "big"), r.component) for r in simhash.near_duplicates(docs(spark, texts), **how).collect()), key=str)
    prints = [(i, plain(t)) for i, t in texts]
    group = classes({f for _, f in prints}, 2)
    low = {}
    for i, f in prints:
        if i is not None:
            low[group[f]] = min(i, low.get(group[f], i))
    assert got == sorted(((i, f, low.get(group[f])) for i, f in prints), key=str)


def test_awkward_rows(spark):
    check(spark, AWKWARD)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_chains_of_near_copies_in_small_tiles(spark):
    rng = random.Random(4)
    texts = []
    for g in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(300)]
        for _ in range(14):
            base[rng.randrange(300)] = f"x{rng.randrange(500)}"
            texts.append((len(texts), " ".join(base)))
    check(spark, texts, tile=5)


def test_links_of_all_pairs_of_tiles():
    rng = np.random.default_rng(6)
    for words, radius in ((1, 2), (4, 40)):
        seed = rng.integers(0, 1 << 63, (20, words)).astype(np.uint64)
        rows = np.repeat(seed, 10, axis=0)
        for r in rows:
            for _ in range(rng.integers(0, radius)):
                r[rng.integers(words)] ^= np.uint64(1) << np.uint64(rng.integers(64))
        a, b = rows[:90], rows[90:]
        i, j = simhash.tile_links(a, b, radius)
        near = np.bitwise_count(rows[:90, None, :] ^ rows[None, 90:, :]).sum(axis=2, dtype=int) <= radius
        label = list(range(200))

        def find(x):
            while label[x] != x:
                x = label[x]
            return x
        for x, y in zip(i.tolist(), j.tolist()):
            label[find(x)] = find(y)
        assert len(i) < 200
        for x, y in zip(*np.nonzero(near)):
            assert find(int(x)) == find(int(y) + 90)


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, k) for k in range(1001, 1200)]
    low = {}

    def find(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            low[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(low)}
