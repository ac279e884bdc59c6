"""Context-tree scores against a plain recursive tree, and base scores against plain counts."""

import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from finsieve.llm import op03_ctw as ctw
from finsieve.llm.common import held_out
from tests.llm.helpers import AWKWARD, docs


def brute(train: list[bytes], depth: int):
    """Probability of a byte behind a context by the definition: one tree per decision."""
    counts = Counter()
    for text in train:
        line = b"\n" * depth + text
        for i in range(depth, len(line)):
            for k in range(8):
                node, bit = 1 << k | line[i] >> (8 - k), line[i] >> (7 - k) & 1
                for d in range(depth + 1):
                    counts[line[i - d:i], node, bit] += 1
    contexts = {c for c, _, _ in counts}

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    known = {}

    def parts(c, node):
        if (c, node) not in known:
            own = kt(counts[c, node, 0], counts[c, node, 1])
            if len(c) == depth:
                known[c, node] = own, None
            else:
                below = sum(weighted(x, node) for x in (bytes([y]) + c for y in range(256)) if x in contexts)
                known[c, node] = own, below
        return known[c, node]

    def weighted(c, node):
        own, below = parts(c, node)
        return own if below is None else math.log(0.5 * math.exp(own) + 0.5 * math.exp(below))

    def chance(context, byte):
        total = 0.0
        for k in range(8):
            node, bit = 1 << k | byte >> (8 - k), byte >> (7 - k) & 1
            p = None
            for d in range(depth, -1, -1):
                c = context[depth - d:]
                a = counts[c, node, bit], counts[c, node, 0] + counts[c, node, 1]
                q = (a[0] + 0.5) / (a[1] + 1)
                own, below = parts(c, node)
                p = q if p is None else (math.exp(own) * q + math.exp(below) * p) / (math.exp(own) + math.exp(below))
            total += math.log10(p)
        return total
    return chance


def test_scores(spark):
    texts = [(i, t) for i, t in enumerate(["ab ab abc", "ab abc", None, "", "abba", "ab ab abc", "zz É z", "abc  ab\n"] * 3)]
    held = {i: zlib.crc32(str(i).encode()) % 3 == 0 for i, _ in texts}
    assert any(held.values())
    got = {r.id: r for r in ctw.score(docs(spark, texts), held_out(F.col("doc_id"), 3, 0), depth=3, block=40).collect()}
    words = {i: (t or "").encode().lower().split() for i, t in texts}
    train = Counter(w for i in words if not held[i] for w in [*words[i], None])
    n, v = sum(train.values()), len(train)
    chance = brute([b" ".join(words[i]) + b"\n" for i in words if not held[i]], 3)
    for i, w in words.items():
        r, line = got[i], b"\n\n\n" + b" ".join(w) + b"\n"
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(w) + 1, n)
        assert r.n_known == sum(train[x] > 0 for x in [*w, None])
        assert math.isclose(r.base_score, sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in [*w, None]))
        assert math.isclose(r.score, sum(chance(line[k - 3:k], line[k]) for k in range(3, len(line))), rel_tol=1e-5)


def test_awkward_rows(spark):
    out = ctw.score(docs(spark, AWKWARD), held_out(F.col("doc_id"), 10, 0)).collect()
    assert sorted(str(r.id) for r in out) == sorted(str(i) for i, _ in AWKWARD)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    empty = [r.score for r in out if r.id in (1, 2, 3)]
    assert len(set(empty)) == 1
    assert ctw.score(docs(spark, []), held_out(F.col("doc_id"), 10, 0)).count() == 0


def test_nothing_to_learn_from(spark):
    row = ctw.score(docs(spark, [(1, "ab")]), F.lit(True)).first()
    assert row.train_tokens == 0 and math.isclose(row.score, 24 * math.log10(0.5), rel_tol=1e-6)
