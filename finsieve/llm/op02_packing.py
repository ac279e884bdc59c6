"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Pieces are dealt by hash into blocks of a bounded size. Each block is evolved by two islands.
Crossover injects whole well-filled bins of one parent into the other, drops bins that share a
document with them, and best-fits the displaced documents. Between epochs the best individuals of
an island migrate to the block's next island. Bins filled well are final, and so are items that fit with
no other item left; the rest of every block is dealt anew into fewer blocks, until a single block is
left, so the loss does not add up over blocks. Where nearly nothing gets final, blocks double up to
``GROWTH`` times, and such blocks end the packing: each may leave bins that items of another block would fill.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from finsieve.llm.common import pieces as slices, spread
from finsieve.session import stage

CAPACITY = 4096
END = 1
BLOCK = 2048
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
CHILDREN = 10
ELITE = 2
#: Bins at least so full are final when a block is done.
FULL = 0.99
#: Blocks grow so many times at most, which bounds what one task evolves.
GROWTH = 8
CACHE = 400_000


class Encoder:
    """Ids of a text by the tokenizer file, with a bounded cache of words.

    Words are what blanks and line feeds separate. The tokenizer drops white space, and neither
    its normal form nor its merges reach across it, so ids of words concatenate to ids of the
    text. Printable ASCII words go to the file's BPE model piece by piece, all others
    through the whole tokenizer.
    """

    def __init__(self, file: str):
        import re

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(file)
        self.model = self.whole.model
        self.split = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
        self.plain = re.compile(r"[!-~]+").fullmatch
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = np.array([t.id for t in self.model.tokenize(part)], "<u4").tobytes()
            if len(self.parts) < CACHE:
                self.parts[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if self.plain(word) and "<|" not in word:
            ids = b"".join(map(self._part, self.split(word.lower())))
        else:
            ids = np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.words) < CACHE and len(word) < 64:
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        get, slow = self.words.get, self._word
        words = text.replace("\n", " ").split(" ")
        found = [get(w) for w in words]
        if None in found:
            found = [slow(w) if f is None else f for w, f in zip(words, found)]
        return b"".join(found)


@lru_cache(maxsize=1)
def _encoder(file: str) -> Encoder:
    """One per worker process, so that the tasks it runs share the cache of words."""
    return Encoder(file)


def pieces(
    docs: DataFrame, file: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = True
) -> DataFrame:
    """(uid, id, piece, start, length, ids_crc32, ids) per piece of at most ``capacity`` tokens.

    A null text is an empty one: one piece that holds the end id alone. ``uid`` numbers the
    pieces: the task's partition and a count within it. Without ``keep_ids`` the ids are null.
    """
    picked = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("t"))
    kind = picked.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(file), np.array([END], "<u4").tobytes()
        uid = TaskContext.get().partitionId() << 36
        for batch in slices(batches, 4 << 20):
            at, number, start, length, crc, blobs = [], [], [], [], [], []
            for row, t in enumerate(batch.column(1).to_pylist()):
                ids = memoryview(encoder.encode(t or "") + end)
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    blob = ids[a:a + 4 * capacity]
                    at.append(row)
                    number.append(k)
                    start.append(a // 4)
                    length.append(len(blob) // 4)
                    crc.append(zlib.crc32(blob))
                    blobs.append(blob if keep_ids else None)
            uids = pa.array(range(uid, uid + len(at)), pa.int64())
            uid += len(at)
            yield pa.RecordBatch.from_arrays(
                [uids, batch.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(blobs, pa.binary())],
                names=["uid", "id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    return picked.mapInArrow(
        run, f"uid bigint, id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
    )


def _best_fit(bins: list[list[int]], room: list[int], items: list[int], size: list[int], capacity: int) -> None:
    """Put items, longest first, where least room is left; open a bin when none has room."""
    order = sorted((r, b) for b, r in enumerate(room))
    for item in sorted(items, key=lambda i: -size[i]):
        k = bisect.bisect_left(order, (size[item], -1))
        if k == len(order):
            bins.append([item])
            room.append(capacity - size[item])
            bisect.insort(order, (room[-1], len(bins) - 1))
        else:
            _, b = order.pop(k)
            bins[b].append(item)
            room[b] -= size[item]
            bisect.insort(order, (room[b], b))


def _fitness(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then mean squared fill, which rewards full bins beside an empty one."""
    return -len(bins), sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def _cross(mother: list[list[int]], father: list[list[int]], size: list[int], capacity: int, rng) -> list[list[int]]:
    """Inject well-filled bins of ``father``; bins of ``mother`` that share an item with them are dissolved."""
    fills = np.array([sum(size[i] for i in b) for b in father], float)
    weight = (fills / capacity) ** 8
    take = rng.choice(len(father), max(1, len(father) // 4), replace=False, p=weight / weight.sum())
    taken = [father[k] for k in take]
    held = {i for b in taken for i in b}
    kept, loose = [], []
    for b in mother:
        if held.isdisjoint(b):
            kept.append(list(b))
        else:
            loose += [i for i in b if i not in held]
    # The emptiest bins of the mother go too, so that their items can close gaps.
    fill = [sum(size[i] for i in b) for b in kept]
    for k in sorted(range(len(kept)), key=fill.__getitem__)[: max(1, len(kept) // 20)]:
        loose += kept[k]
        kept[k] = []
    bins = [list(b) for b in taken] + [b for b in kept if b]
    room = [capacity - sum(size[i] for i in b) for b in bins]
    _best_fit(bins, room, loose, size, capacity)
    return bins


def _genes(bins: list[list[int]], n: int) -> list[int]:
    gene = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            gene[i] = k
    return gene


def _bins(gene: list[int]) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(gene):
        bins.setdefault(k, []).append(i)
    return list(bins.values())


def _seeded(size: list[int], capacity: int, rng=None) -> list[list[int]]:
    """Best fit, longest first; with ``rng`` a random quarter is placed next-fit before, so that parents differ."""
    bins: list[list[int]] = []
    room: list[int] = []
    head = rng.permutation(len(size))[: len(size) // 4].tolist() if rng is not None else []
    for i in head:
        if not bins or size[i] > room[-1]:
            bins.append([])
            room.append(capacity)
        bins[-1].append(i)
        room[-1] -= size[i]
    _best_fit(bins, room, list(set(range(len(size))).difference(head)), size, capacity)
    return bins


def evolve(size: list[int], elites: list[list[int]], seed: int, capacity: int = CAPACITY) -> list[list[int]]:
    """The best individuals of one island after an epoch, best first, as bin numbers per item."""
    rng = np.random.default_rng(seed)
    people = [_bins(list(g)) for g in elites] or [_seeded(size, capacity)]
    lower = -(-sum(size) // capacity)

    def ready(bins: list[list[int]]) -> bool:
        return len(bins) <= lower and sum(sum(size[i] for i in b) >= FULL * capacity for b in bins) >= lower - 1

    if not ready(people[0]):
        people += [_seeded(size, capacity, rng) for _ in range(POPULATION - len(people))]
    ranked = sorted(((_fitness(b, size, capacity), k, b) for k, b in enumerate(people)), reverse=True)
    for child in range(CHILDREN):
        if len(ranked) < 2 or ready(ranked[0][2]):
            break
        a, b = (int(min(rng.integers(0, len(ranked), 2))) for _ in range(2))  # the better of two, twice
        born = _cross(ranked[a][2], ranked[b if b != a else (b + 1) % len(ranked)][2], size, capacity, rng)
        ranked.append((_fitness(born, size, capacity), POPULATION + child, born))
        ranked = sorted(ranked, reverse=True)[:POPULATION]
    return [_genes(b, len(size)) for _, _, b in ranked[:ELITE]]


def _epochs(items: DataFrame, blocks: int, level: int, capacity: int) -> DataFrame:
    """(block, uids, sizes, gene) of the best packing of every block."""
    block = F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks))
    base = items.withColumn("block", block).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("x")
    ).select("block", F.col("x.uid").alias("uids"), F.col("x.length").alias("sizes"))
    base = stage(base, "blocks")
    empty = F.array().cast("array<array<int>>")
    state = base.select("*", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island")).withColumn("elites", empty)
    schema = "block bigint, uids array<bigint>, sizes array<bigint>, island int, elites array<array<int>>"
    for epoch in range(EPOCHS):

        def run(frames: Iterable[pd.DataFrame], epoch=epoch) -> Iterator[pd.DataFrame]:
            for frame in frames:
                frame["elites"] = [
                    evolve([int(s) for s in r.sizes], [list(map(int, g)) for g in r.elites],
                           (int(r.block) * ISLANDS + int(r.island)) * 64 + epoch, capacity)
                    for r in frame.itertuples()
                ]
                yield frame[["block", "uids", "sizes", "island", "elites"]]

        state = stage(spread(state, "block", "island").mapInPandas(run, schema), "islands")
        if epoch + 1 < EPOCHS:  # an island goes on with its own best and its neighbour's
            near = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("elites", 1, 1).alias("guest"))
            state = state.join(near, ["block", "island"]).select(
                "block", "uids", "sizes", "island", F.concat("elites", "guest").alias("elites")
            )
    best = F.col("elites")[0]
    bins = F.size(F.array_distinct(best))
    top = state.groupBy("block").agg(F.min_by(F.struct("uids", "sizes", best.alias("gene")), F.struct(bins, "island")).alias("s"))
    return top.select("block", "s.uids", "s.sizes", "s.gene")


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """(uid, sequence_id, offset) for every row of ``items``(uid, length).

    ``uid`` is unique and ``length`` from 1 to ``capacity``. An item that fills a sequence is one.
    Levels run until one block holds all items left, or blocks of ``GROWTH`` times ``block`` items get nearly
    nothing final; each level keeps well-filled bins.
    """
    most, stuck = GROWTH * block, False
    whole = items.filter(F.col("length") == capacity).select(
        "uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    left, done, level, serial = stage(items.filter(F.col("length") < capacity).select("uid", "length"), "items"), [whole], 0, 0
    count = left.count()
    while count:
        blocks = -(-count // block)
        placed = _epochs(left, blocks, level, capacity)
        each = placed.select(
            "block", F.posexplode(F.arrays_zip("uids", "sizes", "gene")).alias("i", "x")
        ).select("block", F.col("x.gene").alias("bin"), F.struct(F.col("x.uids").alias("uid"), F.col("x.sizes").alias("length")).alias("x"))
        bins = each.groupBy("block", "bin").agg(F.sort_array(F.collect_list("x")).alias("x"))
        fill = F.aggregate("x", F.lit(0).cast("bigint"), lambda s, x: s + x["length"])
        bins = stage(bins.withColumn("fill", fill), "bins")
        last = blocks == 1 or stuck
        done_with = F.lit(last) | (F.col("fill") >= FULL * capacity)
        if not last:
            rest = bins.filter(~done_with).select(F.inline("x"))
            smallest = rest.agg(F.min("length")).first()[0] or capacity
            # No two items left fit together where one of them is so long: exact, whatever the other bins hold.
            done_with = done_with | ((F.size("x") == 1) & (F.col("fill") > capacity - smallest))
        final = bins.filter(done_with)
        number = F.lit(serial) + F.col("block") * F.lit(count).cast("bigint") + F.col("bin")
        done.append(
            final.select(number.alias("sequence_id"), F.posexplode("x").alias("i", "item"), "x").select(
                F.col("item.uid").alias("uid"), "sequence_id",
                F.aggregate(F.slice("x", F.lit(1), F.col("i")), F.lit(0).cast("bigint"), lambda s, x: s + x["length"]).alias("offset"),
            )
        )
        if last:
            break
        left = stage(bins.filter(~done_with).select(F.inline("x")), "left")
        serial, level, before, count = serial + blocks * count, level + 1, count, left.count()
        if count > 0.9 * before:  # nearly nothing gets final: larger blocks, and an end when they may not grow
            stuck = block >= most
            block = min(2 * block, most)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(
    docs: DataFrame, file: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = True
) -> DataFrame:
    """Every piece of every row with its place: (id, piece, start, length, ids_crc32, ids, sequence_id, offset).

    Rows that repeat, also with the same id or a null one, are packed apart. An empty table gives
    an empty one. Other columns of ``docs`` are not touched.
    """
    cut = stage(pieces(docs, file, id, text, capacity, keep_ids), "pieces")
    return cut.join(pack(cut.select("uid", "length"), capacity), "uid").drop("uid")
