"""Exact nearest neighbours of a query set by a block matrix join of int8 product tiles.

Vectors are packed into tiles where they are read. Blocks of queries meet blocks of tiles in a grid,
so a candidate is sent once per query block and a query once per candidate block. Each tile pair
is an int8 product; with the exact norm of each vector's quantisation error it bounds every distance
from both sides. Pairs whose lower bound exceeds the k-th best distance known are dropped, the rest
are computed anew in double precision and kept in a heap per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from finsieve.session import stage

TILE = 4096
#: Candidates in one block of the grid, and queries in one.
BLOCK, QUERIES = 16384, 2048


def tiles(vectors: DataFrame, id: str, vector: str, tile: int = TILE) -> DataFrame:
    """(tile, dim, n, ids, uids, data): packed vectors of one length; ``uid`` numbers the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 36
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def row(dim: int) -> pa.RecordBatch:
            nonlocal serial
            parts = held.pop(dim)
            ids, data = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            uids = np.arange(serial, serial + len(ids), dtype=np.int64)
            serial += len(ids)
            return pa.RecordBatch.from_pylist(
                [{"tile": int(uids[0]), "dim": dim, "n": len(ids), "ids": ids.tobytes(), "uids": uids.tobytes(), "data": data.tobytes()}],
                schema=shape,
            )

        shape = pa.schema([("tile", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()),
                           ("uids", pa.binary()), ("data", pa.binary())])
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
                ends = np.cumsum(lengths)
                for dim in np.unique(lengths).tolist():
                    at = np.flatnonzero(lengths == dim)
                    data = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                    held.setdefault(dim, []).append((ids[at], data))
                    if sum(len(p[0]) for p in held[dim]) + 1024 > tile:
                        yield row(dim)
        for dim in list(held):
            yield row(dim)

    return rows.mapInArrow(pack, "tile bigint, dim int, n int, ids binary, uids binary, data binary")


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scales, squared norms of the decoded vectors, norms of the errors."""
    scale = np.abs(x).max(axis=1, initial=0) / 127
    scale[scale == 0] = np.finfo(float).tiny
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    wide = codes.astype(np.float64)
    error = np.sqrt(((x - wide * scale[:, None]) ** 2).sum(axis=1))
    return codes, scale, (wide**2).sum(axis=1) * scale**2, error


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows; squares are added in component order."""
    return np.sqrt(np.add.accumulate((a - b) ** 2, axis=1)[:, -1])


class _Best:
    """A bounded heap per query: the k smallest (distance, id, uid)."""

    def __init__(self, n: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n)]
        self.limit = np.full(n, np.inf)

    def add(self, query: int, distance: float, id: int, uid: int) -> None:
        heap, item = self.heaps[query], (-distance, -id, -uid)
        if len(heap) < self.k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)
        if len(heap) == self.k:
            self.limit[query] = -heap[0][0]


def nearest(q: np.ndarray, q_uids: np.ndarray, blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> _Best:
    """The k nearest of every query over blocks of (vectors, ids, uids)."""
    best, size = _Best(len(q), k), 256
    coded = quantised(q)
    product = np.float32 if q.shape[1] * 127**2 < 1 << 24 else np.float64  # integers up to there are exact
    with np.errstate(over="ignore", invalid="ignore"):
        for c, ids, uids in blocks:
            codes, scale, norm, error = quantised(c)
            right = codes.astype(product).T
            for start in range(0, len(q), size):
                rows = slice(start, start + size)
                dots = (coded[0][rows].astype(product) @ right).astype(np.float64)
                square = coded[2][rows, None] + norm - 2 * dots * coded[1][rows, None] * scale
                near = np.sqrt(np.maximum(square, 0))
                slack = coded[3][rows, None] + error
                # Rounding of the squared distance, as a distance.
                slack = slack + np.sqrt(1e-13 * (coded[2][rows, None] + norm))
                low, high = near - slack, near + slack
                own = q_uids[rows, None] == uids
                high[own] = np.inf
                limit = best.limit[rows]
                if len(ids) > k:
                    limit = np.minimum(limit, np.partition(high, k - 1, axis=1)[:, k - 1])
                i, j = np.nonzero(~(low > limit[:, None]) & ~own)
                for part in range(0, len(i), 1 << 14):
                    a, b = i[part:part + (1 << 14)] + start, j[part:part + (1 << 14)]
                    for x, d, y, u in zip(a.tolist(), exact(q[a], c[b]).tolist(), ids[b].tolist(), uids[b].tolist()):
                        best.add(x, d, y, u)
    return best


def neighbours(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 10, every: int = 100, tile: int = TILE,
    block: int = BLOCK, queries: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row whose id is divisible by ``every``.

    Nearness is Euclidean distance in double precision; ties go to the smaller id. Vectors that are
    null, empty, zero, or hold a null or non-finite component take no part, nor do null ids.
    Vectors of other lengths are no candidates. Rows that repeat are rows: each is a query of its
    own, and all but the query's own row are candidates. Fewer candidates than ``k`` are all
    returned. An empty table gives an empty one; other columns are ignored.
    """
    packed = stage(tiles(vectors, id, vector, tile), "tiles")
    sizes = {r["dim"]: (r["c"], r["q"]) for r in packed.groupBy("dim").agg(F.sum("n").alias("c"), F.count("*").alias("q")).collect()}

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                at = np.flatnonzero(ids % every == 0)
                data = np.frombuffer(r["data"]).reshape(-1, r["dim"])[at]
                uids = np.frombuffer(r["uids"], np.int64)[at]
                out += [{"dim": r["dim"], "uid": int(u), "id": int(ids[a]), "x": x.tobytes()} for u, a, x in zip(uids, at, data)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("dim", pa.int32()), ("uid", pa.int64()), ("id", pa.int64()), ("x", pa.binary())]))

    asked = stage(packed.mapInArrow(pick, "dim int, uid bigint, id bigint, x binary"), "queries")
    counts = {r["dim"]: r["n"] for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    grid = [(d, -(-c // block), -(-counts.get(d, 0) // queries)) for d, (c, _) in sizes.items() if counts.get(d)]
    schema = "query_id bigint, quid bigint, vec_id bigint, uid bigint, score double"
    if not grid:
        return packed.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    shape = packed.sparkSession.createDataFrame(grid, "dim int, s bigint, b bigint")
    left = packed.join(F.broadcast(shape), "dim").select(
        "dim", F.pmod(F.xxhash64("tile"), F.col("s")).alias("s"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("b"),
        "ids", "uids", "data",
    )
    right = asked.join(F.broadcast(shape), "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("s"), F.pmod(F.xxhash64("uid"), F.col("b")).alias("b"),
        "uid", "id", "x",
    )

    def search(found: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "quid": [], "vec_id": [], "uid": [], "score": []}
        if found.num_rows and asked.num_rows:
            dim = found.column("dim")[0].as_py()
            q = np.frombuffer(b"".join(asked.column("x").to_pylist())).reshape(-1, dim)
            q_ids, q_uids = asked.column("id").to_pylist(), asked.column("uid").to_numpy()
            parts = ((np.frombuffer(d.as_py()).reshape(-1, dim), np.frombuffer(i.as_py(), np.int64), np.frombuffer(u.as_py(), np.int64))
                     for i, u, d in zip(found.column("ids"), found.column("uids"), found.column("data")))
            for n, heap in enumerate(nearest(q, q_uids, parts, k).heaps):
                for d, i, u in heap:
                    for name, value in zip(out, (q_ids[n], int(q_uids[n]), -i, -u, -d)):
                        out[name].append(value)
        return pa.table(out, schema=pa.schema([(n, pa.float64() if n == "score" else pa.int64()) for n in out]))

    met = left.groupBy("dim", "s", "b").cogroup(right.groupBy("dim", "s", "b")).applyInArrow(search, schema)
    order = Window.partitionBy("quid").orderBy("score", "vec_id", "uid")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
