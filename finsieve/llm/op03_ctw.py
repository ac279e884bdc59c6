"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has a context tree over the bytes before it. A node of
the tree keeps how often the decision was 0 and 1 behind its context. Its Krichevsky-Trofimov
estimate is mixed half and half with the product of its children, so every depth takes part, and
a decision's probability mixes the estimates of all depths by the weights that training left.

Counts of byte n-grams (the deepest context and the byte behind it) hold all that is needed. They
are summed over the corpus, and a subtree is all n-grams that share the last two context bytes; the
two depths above are tables bounded by the alphabet. A document's code length is a sum over its
n-grams. Documents are dealt into blocks; each block gets the part of the model that it needs, so
the model may grow with the corpus and is never broadcast. What is exchanged is packed: the sorted
keys of a block, n-grams or word hashes, travel as one value per bucket of keys, and the number
of buckets grows with the corpus, so that a bucket's share stays the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from finsieve.llm.common import pieces, spread
from finsieve.session import stage

DEPTH = 5
#: Text bytes in a block, n-grams that are sorted at a time, and text bytes of the corpus per bucket of keys.
BLOCK, CHUNK, BUCKET = 16 << 20, 2 << 20, 8 << 20
END = b"\n"
GRAM, WORD = 0, 1
_PACKED = "block bigint, kind int, bucket int, size bigint, keys binary, n binary"


def sequence(text: bytes | None) -> tuple[list[bytes], bytes]:
    """Lower-case words, and the bytes that are scored: words with a blank between, then the end."""
    words = (text or b"").lower().split()
    return words, b" ".join(words) + END


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with its ``depth`` bytes before, as one number each, and where each text starts.

    In front of a text stands the end of another.
    """
    pad = END * depth
    flat = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
    ends = np.cumsum([len(t) + depth for t in texts])
    key = np.zeros(len(flat) - depth, np.int64)
    for back in range(depth + 1):
        key |= flat[depth - back:len(flat) - back].astype(np.int64) << (8 * back)
    own = np.ones(len(key), bool)
    for back in range(depth):  # the padding of the texts after the first is no byte of theirs
        own[ends[:-1] - depth + back] = False
    lengths = np.array([len(t) for t in texts])
    return key[own], np.concatenate([[0], np.cumsum(lengths)[:-1]])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, n = (np.concatenate(x) for x in zip(*parts))
    unique, at = np.unique(key, return_inverse=True)
    return unique, np.bincount(at, weights=n, minlength=len(unique)).astype(np.int64)


def word_keys(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; the end counts as a word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def block_counts(texts: list[bytes], learn: list[bool], depth: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of a block's n-grams and words; the counts are those in texts that are learned from."""
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {GRAM: [], WORD: []}
    held: dict[bool, tuple[list[bytes], list[bytes]]] = {True: ([], []), False: ([], [])}

    def flush(learned: bool) -> None:
        lines, words = held[learned]
        for kind, key in ((GRAM, grams(lines, depth)[0]), (WORD, word_keys(words))):
            for start in range(0, len(key), CHUNK):
                unique, n = np.unique(key[start:start + CHUNK], return_counts=True)
                parts[kind].append((unique, n if learned else np.zeros_like(n)))
            if len(parts[kind]) > 8:
                parts[kind] = [_merged(parts[kind])]
        lines.clear()
        words.clear()

    for text, learned in zip(texts, learn):
        tokens, line = sequence(text)
        lines, words = held[learned]
        lines.append(line)
        words += tokens
        words.append(END)
        if len(lines) >= 256 or len(line) > CHUNK:
            flush(learned)
    for learned in (True, False):
        if held[learned][0]:
            flush(learned)
    return {kind: _merged(p) for kind, p in parts.items()}


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys in order) of every bucket that has keys."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for at in np.split(order, cuts) if len(order) else ():
        yield int(bucket[at[0]]), at


def squeezed(values: np.ndarray) -> bytes:
    """An array of 8-byte numbers, byte by byte of the same weight, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def expanded(blob: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view(kind).ravel()


def _ln_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series behind a shift by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def ln_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    a, b = zeros.astype(float), ones.astype(float)
    return _ln_gamma(a + 0.5) + _ln_gamma(b + 0.5) - _ln_gamma(a + b + 1) - np.log(np.pi)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def mixed(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight of a node's own estimate against its children's, and the log of its weighted probability.

    ``below`` is the sum of the children's logs.
    """
    own = ln_kt(zeros, ones)
    return _sigmoid(own - below), np.logaddexp(own, below) - np.log(2)


def subtree(gram: np.ndarray, n: np.ndarray, depth: int, top: int = 2) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Probability of each n-gram's eight decisions by the depths from ``top`` down, and the nodes at ``top``.

    ``gram`` are distinct and hold all n-grams of the subtree, those that were never learned with a
    count of zero. Nodes are named by context and by the decisions made, with a 1 in front.
    """
    byte = gram & 255
    out = np.empty((len(gram), 8))
    orders, keys = {}, {}
    for d in range(depth, top - 1, -1):
        key = gram & ((1 << 8 * (d + 1)) - 1)
        orders[d] = np.argsort(key, kind="stable")
        keys[d] = key[orders[d]]
    nodes: dict[str, list] = {"node": [], "zeros": [], "ones": [], "weighted": []}
    for k in range(8):
        bit = (byte >> (7 - k)) & 1
        p, below = None, None
        for d in range(depth, top - 1, -1):
            order, name = orders[d], keys[d] >> (8 - k)
            new = np.concatenate([[True], name[1:] != name[:-1]])
            start, group = np.flatnonzero(new), np.cumsum(new) - 1
            counts, bits = n[order], bit[order]
            ones = np.add.reduceat(counts * bits, start)
            zeros = np.add.reduceat(counts, start) - ones
            if d == depth:
                weight, weighted = np.ones(len(start)), ln_kt(zeros, ones)
            else:
                weight, weighted = mixed(zeros, ones, np.add.reduceat(below[order], start))
            chance = (np.where(bits == 1, ones[group], zeros[group]) + 0.5) / (zeros[group] + ones[group] + 1.0)
            estimate = np.empty(len(gram))
            estimate[order] = chance if p is None else weight[group] * chance + (1 - weight[group]) * p[order]
            p = estimate
            below = np.zeros(len(gram))  # a node's log stands at its first n-gram, for the sum a depth up
            below[order[start]] = weighted
        out[:, k] = p
        nodes["node"].append((name[start] >> k) << 8 | 1 << k | (name[start] & ((1 << k) - 1)))
        nodes["zeros"].append(zeros)
        nodes["ones"].append(ones)
        nodes["weighted"].append(weighted)
    return out, {c: np.concatenate(v) for c, v in nodes.items()}


def top_tables(rows: list[tuple[int, int, int, float]]) -> tuple[np.ndarray, ...]:
    """(weight, chance of a 1) per node at depth one and at depth zero, from (node, zeros, ones, below) at depth one.

    A node is the last byte and the decisions made. There are less than 65,536.
    """
    zeros, ones, below = np.zeros(1 << 16), np.zeros(1 << 16), np.zeros(1 << 16)
    for node, a, b, w in rows:
        zeros[node], ones[node], below[node] = a, b, w
    weight1, weighted = mixed(zeros, ones, below)
    chance1 = (ones + 0.5) / (zeros + ones + 1)
    z0, o0, b0 = (x.reshape(256, 256).sum(axis=0) for x in (zeros, ones, weighted))
    weight0, _ = mixed(z0, o0, b0)
    return weight1, chance1, weight0, (o0 + 0.5) / (z0 + o0 + 1)


def finished(gram: np.ndarray, p: np.ndarray, tables: tuple[np.ndarray, ...]) -> np.ndarray:
    """log10 probability of each n-gram's byte, with the two upper depths mixed in."""
    weight1, chance1, weight0, chance0 = tables
    byte, last, total = gram & 255, (gram >> 8) & 255, np.zeros(len(gram))
    for k in range(8):
        node, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
        at = last << 8 | node
        q = np.where(bit == 1, chance1[at], 1 - chance1[at])
        q = weight1[at] * q + (1 - weight1[at]) * p[:, k]
        root = np.where(bit == 1, chance0[node], 1 - chance0[node])
        total += np.log10(weight0[node] * root + (1 - weight0[node]) * q)
    return total


def _blocks(docs: DataFrame, id: str, text: str, held: Column, block: int) -> DataFrame:
    """(id, held, t, block): rows as they are read, with a new block after every ``block`` bytes of text; t is compressed."""
    picked = docs.select(F.col(id).alias("id"), held.alias("held"), F.col(text).cast("string").cast("binary").alias("t"))
    kind = picked.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size = TaskContext.get().partitionId() << 24, 0
        pack = zstandard.ZstdCompressor(6).compress
        for batch in pieces(batches, 1 << 20):
            size += batch.nbytes
            if size > block:
                now, size = now + 1, batch.nbytes
            small = pa.array([pack(t or b"") for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), small, pa.array([now] * batch.num_rows, pa.int64())], names=["id", "held", "t", "block"]
            )

    return stage(picked.mapInArrow(run, f"id {kind}, held boolean, t binary, block bigint"), "blocks")


def _counted(rows: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(block, kind, bucket, size, keys, n): the distinct keys of each block, as far as one task reads it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        flat = (row for b in pieces(batches) for row in zip(*(b.column(c).to_pylist() for c in ("block", "t", "held"))))
        for block, group in groupby(flat, key=lambda r: r[0]):
            texts, learn = [], []
            for _, t, held in group:
                texts.append(unpack(t))
                learn.append(not held)
            out = []
            for kind, (keys, n) in block_counts(texts, learn, depth).items():
                out += [(block, kind, b, len(at), squeezed(keys[at]), squeezed(n[at])) for b, at in by_bucket(keys, buckets)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["block", "kind", "bucket", "size", "keys", "n"]
            )

    return stage(rows.select("block", "t", "held").mapInArrow(run, _PACKED), "counts")


def _totals(counts: DataFrame) -> DataFrame:
    """(kind, bucket, keys, n, total, known): each bucket's keys over all blocks, the sum of counts and how many are above 0."""

    def merge(rows: pa.Table) -> pa.Table:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for keys, n in zip(rows.column("keys"), rows.column("n")):
            parts.append((expanded(keys.as_py(), np.int64), expanded(n.as_py(), np.int64)))
            if sum(len(p[0]) for p in parts[1:]) > max(CHUNK, len(parts[0][0])):
                parts = [_merged(parts)]
        keys, n = _merged(parts)
        return pa.table({
            "kind": rows.column("kind")[:1], "bucket": rows.column("bucket")[:1], "keys": pa.array([squeezed(keys)], pa.binary()),
            "n": pa.array([squeezed(n)], pa.binary()), "total": pa.array([int(n.sum())]), "known": pa.array([int((n > 0).sum())]),
        })

    shape = "kind int, bucket int, keys binary, n binary, total bigint, known bigint"
    return stage(spread(counts, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(merge, shape), "totals")


def _model(totals: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(kind, bucket, keys, value) of the log10 probabilities of all n-grams, in parts that share two context bytes."""

    def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column("keys"), batch.column("n")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(expanded(keys.as_py(), np.int64)), pa.array(expanded(n.as_py(), np.int64))], names=["gram", "n"]
                )

    flat = totals.filter(F.col("kind") == GRAM).select("keys", "n").mapInArrow(unpacked, "gram bigint, n bigint")
    trees = spread(flat.withColumn("suffix", F.shiftright("gram", 8).bitwiseAND(0xFFFF)), "suffix").groupBy("suffix")

    def summed(rows: pa.Table) -> pa.Table:
        _, nodes = subtree(rows.column("gram").to_numpy(), rows.column("n").to_numpy(), depth)
        last = (nodes["node"] >> 8 & 255) << 8 | nodes["node"] & 255  # the last byte and the decisions
        return pa.table({"node": pa.array(last, pa.int32()), **{c: pa.array(nodes[c]) for c in ("zeros", "ones", "weighted")}})

    nodes = trees.applyInArrow(summed, "node int, zeros bigint, ones bigint, weighted double")
    upper = nodes.groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).collect()  # under 65,536 rows
    tables = totals.sparkSession.sparkContext.broadcast(top_tables([tuple(r) for r in upper]))

    def finish(rows: pa.Table) -> pa.Table:
        gram = rows.column("gram").to_numpy()
        p, _ = subtree(gram, rows.column("n").to_numpy(), depth)
        # Seven digits are enough for a sum of logarithms, and half of the bytes then compress to nothing.
        logp = finished(gram, p, tables.value).astype(np.float32).astype(np.float64)
        out = [(GRAM, b, squeezed(gram[at]), squeezed(logp[at])) for b, at in by_bucket(gram, buckets)]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["kind", "bucket", "keys", "value"])

    return trees.applyInArrow(finish, "kind int, bucket int, keys binary, value binary")


def _returned(counts: DataFrame, model: DataFrame) -> DataFrame:
    """(block, kind, keys, value): every block's keys with their values in the model."""

    def look(rows: pa.Table, model: pa.Table) -> pa.Table:
        out = []
        if model.num_rows:
            keys = np.concatenate([expanded(k.as_py(), np.int64) for k in model.column("keys")])
            value = np.concatenate([expanded(v.as_py(), np.float64) for v in model.column("value")])
            order = np.argsort(keys)
            keys, value = keys[order], value[order]
            for block, kind, own in zip(rows.column("block"), rows.column("kind"), rows.column("keys")):
                own = own.as_py()
                out.append((block.as_py(), kind.as_py(), own, squeezed(value[np.searchsorted(keys, expanded(own, np.int64))])))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, kinds)], names=["block", "kind", "keys", "value"])

    by = ("kind", "bucket")
    asked = spread(counts.select("block", "kind", "bucket", "keys"), *by)
    return asked.groupBy(*by).cogroup(spread(model, *by).groupBy(*by)).applyInArrow(
        look, "block bigint, kind int, keys binary, value binary"
    )


def score(
    docs: DataFrame, held: Column, id: str = "doc_id", text: str = "text", depth: int = DEPTH, block: int = BLOCK, bucket: int = BUCKET
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Rows where ``held`` is false are learned from. Words are lower-cased (A-Z) and parted by ASCII white
    space; one end follows. ``score`` is the log10 probability of words joined by a blank and the
    end, ``base_score`` that of a unigram model smoothed by 0.1; its words are told apart by 64-bit
    hashes. A null or wordless text is the end alone. Rows that repeat count and score as rows; without
    any row to learn from every decision has chance one half. An empty table gives an empty one;
    other columns are ignored. ``depth`` is from 2 to 6.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    buckets = int(size // bucket) + 1
    rows = _blocks(docs, id, text, held, block)
    counts = _counted(rows, depth, buckets)
    totals = _totals(counts)
    words = totals.filter(F.col("kind") == WORD)
    tokens, kinds = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()

    def floats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = [squeezed(expanded(n.as_py(), np.int64).astype(np.float64)) for n in batch.column("value")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(value, pa.binary())], names=batch.schema.names)

    shape = "kind int, bucket int, keys binary, value binary"
    model = _model(totals, depth, buckets).unionByName(
        words.select("kind", "bucket", "keys", F.col("n").alias("value")).mapInArrow(floats, shape)
    )
    back = _returned(counts, model)
    kind = rows.schema["id"].dataType.simpleString()

    def apply(docs: pa.Table, model: pa.Table) -> pa.Table:
        known = {}
        for which in (GRAM, WORD):
            at = np.flatnonzero(model.column("kind").to_numpy() == which)
            part = model.take(pa.array(at))
            keys = np.concatenate([expanded(k.as_py(), np.int64) for k in part.column("keys")])
            value = np.concatenate([expanded(v.as_py(), np.float64) for v in part.column("value")])
            order = np.argsort(keys)
            known[which] = keys[order], value[order]
        unpack = zstandard.ZstdDecompressor().decompress
        n_tokens, n_known, base, score, lines, words = [], [], [], [], [], []

        def flush() -> None:
            if not lines:
                return
            key, start = grams(lines, depth)
            keys, value = known[GRAM]
            score.extend(np.add.reduceat(value[np.searchsorted(keys, key)], start).tolist())
            keys, value = known[WORD]
            count = value[np.searchsorted(keys, word_keys(words))]
            start = np.concatenate([[0], np.cumsum(n_tokens[len(base):])[:-1]]).astype(np.int64)
            n_known.extend(np.add.reduceat((count > 0).astype(np.int64), start).tolist())
            base.extend(np.add.reduceat(np.log10((count + 0.1) / (tokens + 0.1 * (kinds + 1))), start).tolist())
            lines.clear()
            words.clear()

        size = 0
        for t in docs.column("t"):
            own, line = sequence(unpack(t.as_py()))
            n_tokens.append(len(own) + 1)
            words += own
            words.append(END)
            lines.append(line)
            size += len(line)
            if size > CHUNK:
                flush()
                size = 0
        flush()
        return pa.table({
            "id": docs.column("id"), "held_out": docs.column("held"), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([tokens] * len(base), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
        })

    return spread(rows, "block").groupBy("block").cogroup(spread(back, "block").groupBy("block")).applyInArrow(
        apply, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
