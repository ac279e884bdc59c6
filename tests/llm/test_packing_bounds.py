"""Packing of items of which hardly any two fit together."""

import random

import pytest
from pyspark.sql import functions as F

from finsieve.llm import op02_packing as packing


@pytest.mark.parametrize("small", [0, 6])
def test_blocks_stay_bounded(spark, monkeypatch, small):
    sizes, epochs = [], packing._epochs

    def seen(items, blocks, level, capacity):
        sizes.append(items.groupBy(F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks))).count().agg(F.max("count")).first()[0])
        return epochs(items, blocks, level, capacity)

    monkeypatch.setattr(packing, "_epochs", seen)
    rng = random.Random(5)
    lengths = [rng.randrange(2049, 4050) for _ in range(500)] + [rng.randrange(2, 9) for _ in range(small)]
    items = spark.createDataFrame(list(enumerate(lengths)), "uid bigint, length bigint")
    packed = packing.pack(items, block=8).collect()
    assert sorted(r.uid for r in packed) == list(range(len(lengths)))
    assert max(sizes) <= 2 * 8 * 8 and (small or len(sizes) == 1)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, lengths[r.uid]))
    assert len(sequences) == 500
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
