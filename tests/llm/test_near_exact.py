"""Near-dedup of the pipeline against the Jaccard similarity of all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from finsieve.llm import op05_simhash as simhash
from tests.conftest import SMALL
from tests.llm.helpers import docs

STAGES = dict(corpus_pipeline.STAGES)


def grams(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def survivors(texts):
    """The smallest id of every group that pairs of 0.8 or more connect."""
    sets, root = [grams(t) for _, t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (name, _) in enumerate(texts):
        low[find(i)] = min(name, low.get(find(i), name))
    return sorted(low.values())


def edited(rng, base, changes):
    out = list(base)
    for at in rng.sample(range(5, len(base) - 5), changes):
        out[at] = f"x{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("held", [simhash.HELD, 20_000])
def test_pairs_about_the_threshold(spark, monkeypatch, held):
    monkeypatch.setattr(simhash, "HELD", held)
    rng = random.Random(8)
    texts = []
    for size, changes in [(n, c) for n in (60, 220, 600) for c in range(1, max(2, n // 25))] * 4:
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [base, edited(rng, base, changes)]
    family = [f"v{k}" for k in range(300)]  # neighbours chain, the ends do not
    for _ in range(12):
        family = edited(rng, family, 5)
        texts.append(family)
    texts = [(i, " ".join(t)) for i, t in enumerate(texts)]
    kept = sorted(r.doc_id for r in STAGES["near_dedup"](spark, docs(spark, texts), SMALL).collect())
    assert kept == survivors(texts)


def test_a_phrase_counts_once(spark):
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    phrase, body = words(6), words(100)
    texts = [(1, words(60) + phrase * 60), (2, words(60) + phrase * 60), (3, body + phrase), (4, body + phrase * 40)]
    texts = [(i, " ".join(t)) for i, t in texts]
    kept = sorted(r.doc_id for r in STAGES["near_dedup"](spark, docs(spark, texts), SMALL).collect())
    assert kept == survivors(texts) == [1, 2, 3]


def test_short_texts(spark):
    words = [f"w{k}" for k in range(60)]
    texts = [(10 * n + k, " ".join(f"{n}.{w}" for w in words[: n - k])) for n in range(6, 30) for k in (0, 1, 2)]
    kept = sorted(r.doc_id for r in STAGES["near_dedup"](spark, docs(spark, texts), SMALL).collect())
    assert kept == survivors(texts)


def test_chance_of_a_bit():
    share = simhash.widest_share(0.8)
    rng = np.random.default_rng(3)
    for a, b, c in ((1, 0, 4), (1, 1, 8), (30, 30, 240)):
        one, two, both = (rng.integers(0, 2, (20_000, n)).sum(axis=1) for n in (a, b, c))
        assert ((one + both > (a + c) / 2) != (two + both > (b + c) / 2)).mean() <= share + 0.01
