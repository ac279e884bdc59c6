"""Decontamination against a plain search, over one and many shards."""

import re

import pytest

from finsieve.llm import op06_decontaminate as dec
from tests.llm.helpers import AWKWARD, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(text, items):
    words, hit, found = WORD.findall(lower(text)), set(), set()
    for item, body in items:
        w = WORD.findall(lower(body))
        size = min(10, len(w))
        for i in range(len(w) - size + 1) if w else ():
            for j in range(len(words) - size + 1):
                if words[j:j + size] == w[i:i + size]:
                    hit.update(range(j, j + size))
                    found.add(item)
    return len(words), len(hit), len(found), dec.digest_text(list(found)), bool(hit)


@pytest.mark.parametrize("shard", [1 << 20, 40])
def test_awkward_rows(spark, shard):
    items = [(1, "Two, three: four!"), (2, None), (3, ""), (4, " .. "), (10, "one TWO three four five six seven eight nine ten eleven twelve"),
             (10, "one TWO three four five six seven eight nine ten eleven twelve"), (12, "über öl"), (13, "word word word"), (14, "end")]
    texts = AWKWARD + [(20, "x-one/two three;four five six seven eight nine ten eleven  twelve two three four ÜBER öl über öl"), (21, "twothree four")]
    small = [(i, t[:3000] if t else t) for i, t in texts]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    out = dec.decontaminate(docs(spark, small), table, shard_bytes=shard)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in dec.digest(out).collect()), key=str)
    assert got == sorted(((i, *plain(t, items)) for i, t in small), key=str)
    spans = {r.id: [(s.a, s.b) for s in r.spans] for r in out.collect()}
    assert [dict(small)[20][a:b] for a, b in spans[20]] == ["one/two three;four five six seven eight nine ten eleven  twelve two three four", "über öl"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in dec.digest(dec.decontaminate(docs(spark, AWKWARD), none)).collect()] == [False] * len(AWKWARD)
    assert dec.decontaminate(docs(spark, []), none).count() == 0
