"""SimHash near-duplicates by exact tiled comparison.

Distinct fingerprints are sorted into cells by the population counts of their four parts.
Two fingerprints within the radius have population counts that differ by no more in sum,
so tile pairs of cells further apart are skipped and all others are compared bit by bit in
numpy. Links inside a pair of tiles leave the task as a spanning forest: a group of n near
copies costs at most n rows per tile pair and no link between components is lost.

With ``jaccard`` the fingerprints, then of distinct shingles, only propose: the shingle sets of every
group that a pair of tiles proposes meet in one task, and the forest is that of the pairs whose
sets are similar enough.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from finsieve.llm.common import pieces
from finsieve.llm.components import components
from finsieve.session import stage

SEED = 42
PARTS = 4
#: Bytes of shingle sets that are compared in one task.
HELD = 64 << 20
# Odd multipliers of a 64-bit finaliser; word j > 0 of a wide fingerprint remixes the first hash with them.
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
STEP = 0x9E3779B97F4A7C15


def _remix(h: np.ndarray, j: int) -> np.ndarray:
    if j == 0:
        return h
    h = h + np.uint64((STEP * j) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None, shingle: int) -> np.ndarray:
    """Hashes of the runs of ``shingle`` words; of a shorter text the one run there is, none without a word."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    size = min(shingle, len(tokens))
    grams = map(b" ".join, zip(*(tokens[i:] for i in range(size))))
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), np.uint64, len(tokens) - size + 1)


def fingerprint(text: bytes | None, shingle: int, words: int, distinct: bool = False) -> bytes:
    """Big-endian fingerprint of 64 * ``words`` bits; all zero when there is no word. With ``distinct`` a shingle counts once."""
    hashes = shingles(text, shingle)
    hashes = np.unique(hashes) if distinct else hashes
    count = len(hashes)
    if not count:
        return bytes(8 * words)
    ones = np.zeros((words, 64), np.int64)
    for start in range(0, count, 1 << 15):
        part = hashes[start:start + (1 << 15)]
        for j in range(words):
            bits = np.unpackbits(_remix(part, j).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones[j] += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return np.packbits(ones * 2 > count).tobytes()


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1, distinct: bool = False
) -> DataFrame:
    """(id, fp) for every row. A null text has no words, like an empty one."""
    picked = docs.select(F.col(id).alias("id"), F.col(text).cast("string").cast("binary").alias("t"))
    kind = picked.schema["id"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            prints = [fingerprint(t, shingle, words, distinct) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary())], names=["id", "fp"])

    return picked.mapInArrow(run, f"id {kind.simpleString()}, fp binary")


def _counts(blob: bytes, words: int) -> list[int]:
    ones = np.bitwise_count(np.frombuffer(blob, np.uint8)).reshape(PARTS, -1).sum(axis=1)
    return [int(x) for x in ones]


def _offsets(radius: int, step: int, span: int) -> list[list[int]]:
    """Cell offsets whose population counts can differ by ``radius`` or less; of o and -o only one."""
    near = []
    reach = min(span // step, (radius - 1) // step + 1)
    for o in itertools.product(range(-reach, reach + 1), repeat=PARTS):
        least = sum((abs(x) - 1) * step + 1 for x in o if x)
        if least <= radius and o >= (0,) * PARTS:
            near.append(list(o))
    return near


class _Forest:
    """Union-find over the rows of two tiles."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.label[i], self.label[j]
        apart = a != b
        if not apart.any():
            return
        n = len(self.label)
        pairs = np.unique(a[apart].astype(np.int64) * n + b[apart])
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        for p in pairs.tolist():
            x, y = find(p // n), find(p % n)
            if x != y:
                root[max(x, y)] = min(x, y)
        moved = np.arange(n)
        for x in root:
            moved[x] = find(x)
        self.label = moved[self.label]


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int, screen: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two tiles of fingerprints, or within one (``b`` None).

    ``a`` and ``b`` hold one row of 64-bit words per fingerprint. The first two words are compared for
    all pairs; pairs up to ``screen`` bits apart there, by default ``radius``, are compared as a
    whole. Returns positions in a followed by b.
    """
    base = 0 if b is None else len(a)
    other = a if b is None else b
    forest = _Forest(base + len(other))
    words, rows = a.shape[1], max(1, (1 << 20) // max(1, len(other)))
    first = min(words, 2)
    for start in range(0, len(a), rows):
        chunk = a[start:start + rows]
        far = np.bitwise_count(chunk[:, None, 0] ^ other[None, :, 0])
        if first == 2:
            far = far + np.bitwise_count(chunk[:, None, 1] ^ other[None, :, 1])  # at most 128, fits a byte
        i, j = np.nonzero(far <= (radius if screen is None else screen))
        if words > first:
            far = far[i, j].astype(np.int64)
            for w in range(first, words):
                far += np.bitwise_count(chunk[i, w] ^ other[j, w])
            i, j = i[far <= radius], j[far <= radius]
        forest.add(i + start, j + base)
    at = np.flatnonzero(forest.label != np.arange(len(forest.label)))
    return at, forest.label[at]


def set_links(
    a: np.ndarray, sets: list[np.ndarray], split: int, radius: int, jaccard: float, screen: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs of rows within ``radius`` whose sorted ``sets`` have a Jaccard similarity of ``jaccard``.

    With ``split`` only pairs of a row before it and one from it on are compared, else all pairs.
    """
    root = list(range(len(a)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    most = radius if screen is None else screen
    first = min(a.shape[1], 2)
    for i in range(split or len(a)):
        start = split or i + 1
        differ = np.bitwise_count(a[start:] ^ a[i]).astype(np.int64)
        near = np.flatnonzero((differ[:, :first].sum(axis=1) <= most) & (differ.sum(axis=1) <= radius)) + start
        for j in near.tolist():
            x, y = find(i), find(j)
            if x == y:
                continue
            n, m = len(sets[i]), len(sets[j])
            if min(n, m) < jaccard * max(n, m) - 1:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both and both / (n + m - both) >= jaccard:
                root[max(x, y)] = min(x, y)
    label = np.array([find(x) for x in range(len(a))], np.int64)
    at = np.flatnonzero(label != np.arange(len(a)))
    return at, label[at]


def _verified(proposed: DataFrame, sets: DataFrame, radius: int, words: int, screen: int | None, jaccard: float) -> DataFrame:
    """Edges (a, b) of the proposed groups (grp, side, fp) that the shingle ``sets`` (fp, s) bear out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None

        def edges() -> pa.RecordBatch:
            held.sort(key=lambda r: r[:2])
            prints = [r[1] for r in held]
            a = np.frombuffer(b"".join(prints), ">u8").astype(np.uint64).reshape(-1, words)
            split = sum(r[0] == 0 for r in held)
            i, j = set_links(a, [np.frombuffer(r[2], np.uint64) for r in held], split if split < len(held) else 0, radius, jaccard, screen)
            return pa.RecordBatch.from_arrays(
                [pa.array([prints[k] for k in x.tolist()], pa.binary()) for x in (i, j)], names=["a", "b"]
            )

        for batch in batches:
            for grp, *row in zip(*(batch.column(c).to_pylist() for c in ("grp", "side", "fp", "s"))):
                if grp != current and held:
                    yield edges()
                    held.clear()
                current = grp
                held.append(tuple(row))
        if held:
            yield edges()

    # A group of more bytes is cut into parts, and every two of them that can hold a pair meet in a task of their own.
    sized = stage(proposed.join(sets.select("fp", F.length("s").alias("size")).hint("merge"), "fp"), "sized")
    parts = sized.groupBy("grp").agg(F.ceil(F.sum("size") / HELD).cast("int").alias("parts"), (F.max("side") == 1).alias("cross"))
    dealt = sized.drop("size").join(parts.hint("merge"), "grp").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low = F.when(F.col("cross"), F.when(F.col("side") == 0, F.col("part")).otherwise(F.col("x"))).otherwise(F.least("part", "x"))
    high = F.when(F.col("cross"), F.when(F.col("side") == 0, F.col("x")).otherwise(F.col("part"))).otherwise(F.greatest("part", "x"))
    side = F.when(F.col("cross"), F.col("side")).otherwise((F.col("part") > F.col("x")).cast("int"))
    met = dealt.select(F.struct("grp", low.alias("p"), high.alias("q")).alias("grp"), side.alias("side"), "fp").join(sets.hint("merge"), "fp")
    sent = met.select("grp", "side", "fp", "s").repartition("grp").sortWithinPartitions("grp")
    return sent.mapInArrow(run, "a binary, b binary")


def links(
    prints: DataFrame, radius: int, words: int = 1, tile: int = 8192, screen: int | None = None, groups: bool = False
) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` as all links within ``radius`` do.

    With ``groups`` the rows are (grp, side, fp) instead: what such links connect within a pair of tiles is a
    group, and ``side`` says which of the two tiles a fingerprint is from.

    A cell with many fingerprints is cut into tiles of about ``tile``, so no task holds more
    than two tiles at a time. The numbers of tiles per cell come from a count over all rows.
    """
    step = max(1, radius // 2)
    span = 64 * words // PARTS
    offsets = _offsets(radius, step, span)

    def celled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(0).to_pylist()
            cells = [[c // step for c in _counts(x, words)] for x in blobs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cells, pa.list_(pa.int32()))], names=["fp", "cell"]
            )

    cells = stage(prints.select("fp").distinct().mapInArrow(celled, "fp binary, cell array<int>"), "cells")
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    # At most (span // step + 1) ** 4 cells, 83,521 for a fingerprint of one word and radius 2.
    tiles = stage(
        cells.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("cell", "part", "parts").agg(F.array_join(F.collect_list(F.hex("fp")), "").alias("blob"))
        .select("cell", "part", "parts", F.unhex("blob").alias("blob")),
        "tiles",
    )
    # Pairs of tiles are found by their cells alone. The blobs are joined on afterwards; which of the two joins last
    # alternates, so that the pairs of every tile spread over both its partners' tasks.
    near = F.array(*[F.array(*[F.lit(x) for x in o]) for o in offsets])
    keys = tiles.select("cell", "part")
    left = keys.select(F.col("cell").alias("c"), F.col("part").alias("p"), F.explode(near).alias("o"))
    met = left.select("c", "p", F.zip_with("c", "o", lambda u, v: u + v).alias("cell")).join(keys, "cell").filter(
        "c != cell or p <= part"
    )
    one, two = F.struct(F.col("c").alias("cell"), F.col("p").alias("part")), F.struct("cell", "part")
    odd = F.xxhash64("c", "p").bitwiseXOR(F.xxhash64("cell", "part")).bitwiseAND(1) == 1
    met = stage(met.select(F.when(odd, one).otherwise(two).alias("first"), F.when(odd, two).otherwise(one).alias("last")), "pairs")
    blobs = tiles.select(F.struct("cell", "part").alias("key"), "blob")
    pairs = met.join(blobs.select(F.col("key").alias("first"), F.col("blob").alias("x")), "first").join(
        blobs.select(F.col("key").alias("last"), F.col("blob").alias("y")), "last"
    ).select("x", F.when(F.col("first") != F.col("last"), F.col("y")).alias("y"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 8 * words
        for batch in batches:
            froms, tos = [], []
            for x, y in zip(batch.column(0), batch.column(1)):
                x, y = x.as_py(), y.as_py()
                blob = x + (y or b"")
                a = np.frombuffer(x, ">u8").astype(np.uint64).reshape(-1, words)
                b = None if y is None else np.frombuffer(y, ">u8").astype(np.uint64).reshape(-1, words)
                i, j = tile_links(a, b, radius, screen)
                froms += [blob[k * width:(k + 1) * width] for k in i.tolist()]
                tos += [blob[k * width:(k + 1) * width] for k in j.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(froms, pa.binary()), pa.array(tos, pa.binary())], names=["a", "b"])

    def propose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, number = 8 * words, TaskContext.get().partitionId() << 36
        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            for x, y in zip(batch.column(0), batch.column(1)):
                x, y = x.as_py(), y.as_py()
                blob = x + (y or b"")
                a = np.frombuffer(x, ">u8").astype(np.uint64).reshape(-1, words)
                b = None if y is None else np.frombuffer(y, ">u8").astype(np.uint64).reshape(-1, words)
                i, j = tile_links(a, b, radius, screen)
                roots, of = np.unique(j, return_inverse=True)
                for k, g in zip([*i.tolist(), *roots.tolist()], [*of.tolist(), *range(len(roots))]):
                    out.append((number + g, int(k >= len(a)), blob[k * width:(k + 1) * width]))
                number += len(roots)
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()))], names=["grp", "side", "fp"]
            )

    if groups:
        return pairs.mapInArrow(propose, "grp bigint, side int, fp binary")
    return pairs.mapInArrow(compare, "a binary, b binary")


def _sets(docs: DataFrame, id: str, text: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """(fp, s) for ``wanted`` (key, fp), key an id of ``docs``: the sorted hashes of its distinct shingles."""
    picked = docs.select(F.col(id).alias("key"), F.col(text).cast("string").cast("binary").alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            held = [np.unique(shingles(t, shingle)).tobytes() for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(held, pa.binary())], names=["fp", "s"])

    return picked.join(wanted.hint("merge"), "key").select("fp", "t").mapInArrow(run, "fp binary, s binary")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2, words: int = 1, tile: int = 8192,
    screen: int | None = None, jaccard: float | None = None,
) -> DataFrame:
    """(id, fp, component) for every row of ``docs``; component is the smallest id reachable over links.

    A text without words (null, empty, blank) has the fingerprint zero and is linked like any
    other. Rows that repeat, also with the same id, each give a row. A null id is never a
    component unless the whole component has null ids. An empty table gives an empty one.
    Other columns of ``docs`` are not touched. ``words`` 64-bit words make one fingerprint; without
    ``screen`` (see ``tile_links``) the comparison is exact. With ``jaccard`` a link also needs that
    similarity of the sets of shingles, recomputed from the texts; ids are unique then and not null. Texts of one
    fingerprint count as equal.
    """
    prints = stage(fingerprints(docs, id, text, shingle, words, jaccard is not None), "prints")
    reps = prints.groupBy("fp").agg(F.min("id").alias("low"))
    if jaccard is None:
        edges = links(prints, radius, words, tile, screen)
    else:
        proposed = stage(links(prints, radius, words, tile, screen, groups=True), "proposed")
        wanted = reps.join(proposed.select("fp").distinct().hint("merge"), "fp").select(F.col("low").alias("key"), "fp")
        sets = stage(_sets(docs, id, text, wanted, shingle), "sets")
        edges = stage(_verified(proposed, sets, radius, words, screen, jaccard), "edges")
    roots = components(edges).withColumnRenamed("node", "fp")
    classes = stage(reps.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "classes")
    lows = classes.groupBy("root").agg(F.min("low").alias("component"))
    named = classes.join(lows, "root").select("fp", "component")
    return prints.join(named, "fp").select("id", "fp", "component")


def widest_share(similarity: float, sizes: int = 120) -> float:
    """Largest chance that a bit differs between two sets of at least this Jaccard similarity.

    Of large sets that is the angle between them; of small ones ties weigh more, so all pairs of sets with up to
    ``sizes`` shingles in both together are worked out from the binomials.
    """
    most = math.acos(2 * similarity / (1 + similarity)) / math.pi
    row = [np.array([math.comb(n, k) / 2**n for k in range(n + 1)]) for n in range(sizes + 1)]
    for union in range(1, sizes + 1):
        apart = math.floor(union * (1 - similarity) + 1e-9)
        for a in range(apart + 1):
            for b in range(min(a, apart - a) + 1):
                c = union - a - b
                ones = np.arange(c + 1)
                # The chance of a majority of ones on either side, given the ones among the common shingles.
                one, two = (
                    (np.arange(x + 1)[None, :] + ones[:, None] > (c + x) / 2) @ row[x] for x in (a, b)
                )
                most = max(most, float(row[c] @ (one * (1 - two) + two * (1 - one))))
    return most


def radius_for(similarity: float, bits: int, errors: float = 1) -> int:
    """Differing bits expected of two shingle sets of this Jaccard similarity and about equal size, and ``errors`` standard errors."""
    return reach(math.acos(2 * similarity / (1 + similarity)) / math.pi, bits, errors)


def reach(share: float, bits: int, errors: float) -> int:
    """Differing bits expected when each differs with chance ``share``, and ``errors`` standard errors."""
    return math.floor(bits * share + errors * math.sqrt(bits * share * (1 - share)))
