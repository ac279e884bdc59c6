"""Packing: every piece once, gapless places, ids of the whole tokenizer, few sequences."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from finsieve.llm import op02_packing as packing
from tests.llm.helpers import AWKWARD, docs

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(FILE)


def test_ids_are_those_of_the_whole_text(whole):
    encoder = packing.Encoder(FILE)
    texts = [t for _, t in AWKWARD if t] + [
        "it's we'll I'D don't'S 3.14 v2 a_b", "x́y   z\u0085w", "ΑΣ ΑΣ. İstanbul ǅ ﬁ", "tab\tcr\rvt\x0bff\x0c\x1c\x7f!", "<|startoftext|>a <|x",
    ]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def check(packed, texts, whole, capacity):
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in packed.collect():
        got[r.id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, t in texts:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            want[i].append((k, a, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(n for v in want.values() for _, _, n, _ in v)


def test_awkward_rows(spark, whole):
    check(packing.pack_documents(docs(spark, AWKWARD), FILE), AWKWARD, whole, 4096)
    assert packing.pack_documents(docs(spark, []), FILE).count() == 0


def test_levels_of_small_blocks_stay_near_the_lower_bound(spark, whole):
    rng = np.random.default_rng(3)
    texts = [(i, "cat " * int(n)) for i, n in enumerate(rng.integers(1, 70, 400))]
    cut = packing.stage(packing.pieces(docs(spark, texts), FILE, capacity=64), "p")
    places = packing.pack(cut.select("uid", "length"), 64, block=50)
    bins, total = check(cut.join(places, "uid"), texts, whole, 64)
    assert bins <= 1.03 * total / 64 + 1


def test_evolution_keeps_every_item_and_beats_its_parents():
    rng = np.random.default_rng(5)
    size = rng.integers(900, 2100, 120).tolist()
    first = packing.evolve(size, [], 1)
    later = packing.evolve(size, first, 2)
    for gene in first + later:
        fill = np.bincount(gene, weights=size)
        assert len(gene) == 120 and fill.max() <= packing.CAPACITY
    assert len(set(later[0])) <= len(set(first[0])) <= len(packing._seeded(size, packing.CAPACITY))
