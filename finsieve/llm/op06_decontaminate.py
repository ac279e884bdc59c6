"""Benchmark decontamination with one Aho-Corasick automaton over normalised windows.

Text and items are normalised byte by byte: A-Z become a-z, ASCII that is neither a letter
nor a digit becomes a blank, other bytes stay. Each window of ten item words is one pattern
with blanks around it. A document is scanned once; occurrences are mapped to word numbers and
to character offsets of the original text. The benchmark is cut into shards of a bounded
number of bytes; each is one automaton, and the documents pass shard after shard.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from finsieve.llm.common import pieces
from finsieve.session import stage

WINDOW = 10
#: Bytes of item text in one automaton; what is broadcast never holds more (one item may be larger).
SHARD_BYTES = 16 << 20
_NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
#: Words in the original text, where A-Z still stand.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_NORMAL).split()


def build(items: list[tuple], window: int = WINDOW) -> ahocorasick.Automaton | None:
    """Automaton over the windows of (item_id, text) pairs; a value is (words, item numbers)."""
    owners: dict[bytes, set[int]] = {}
    for number, (_, text) in enumerate(items):
        words = words_of(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            owners.setdefault(b" ".join(words[i:i + window]), set()).add(number)
    if not owners:
        return None
    found = ahocorasick.Automaton()
    for key, who in owners.items():
        found.add_word(f" {key.decode('latin-1')} ", (key.count(b" ") + 1, tuple(sorted(who))))
    found.make_automaton()
    return found


def scan(automaton: ahocorasick.Automaton | None, words: list[bytes]) -> list[tuple[int, int, int]]:
    """(first word, words, item number) of every occurrence of every window."""
    if automaton is None or not words:
        return []
    line = f" {b' '.join(words).decode('latin-1')} "
    found = list(automaton.iter(line))
    if not found:
        return []
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
    out = []
    for end, (length, who) in found:
        last = int(np.searchsorted(blanks, end)) - 1
        out += [(last - length + 1, length, item) for item in who]
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open word ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _shards(benchmark: DataFrame, id: str, text: str, shard_bytes: int) -> int:
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    return max(1, -(-size // shard_bytes))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, n_words, ranges, items, spans) for every row of ``docs``; with ``carry`` also t, the text, and those columns in ``carried``.

    ``ranges`` are the hit word ranges, merged and half-open; ``items`` the ids of items with
    an occurring window; ``spans`` the (start, end) character offsets of the ranges in the
    original text. A null or wordless text has no words and no hits. Null and wordless items
    have no windows; items that repeat an id count as one. Repeated rows of ``docs`` each give
    a row; an empty table or an empty benchmark gives no hits. Other columns are ignored.
    """
    kind = benchmark.select(F.col(item).alias("i")).schema["i"].dataType.simpleString()
    rows = docs.select(
        F.col(id).alias("id"), F.col(text).cast("string").alias("t"),
        F.array().cast("array<struct<a: bigint, b: bigint>>").alias("ranges"), F.array().cast(f"array<{kind}>").alias("items"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    added = StructType.fromDDL("n_words bigint, spans array<struct<a: bigint, b: bigint>>").fields
    known = benchmark.select(F.col(item).alias("i"), F.col(item_text).cast("string").alias("t")).filter("t is not null")
    n = _shards(benchmark, item, item_text, shard_bytes)
    pairs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    for shard in range(n):
        last = shard + 1 == n
        part = known.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == shard)
        given = docs.sparkSession.sparkContext.broadcast([(r["i"], r["t"].encode()) for r in part.collect()])

        def run(batches: Iterable[pa.RecordBatch], given=given, last=last) -> Iterator[pa.RecordBatch]:
            automaton, names = build(given.value, window), [i for i, _ in given.value]
            for batch in pieces(batches):
                count, ranges, items, spans = [], [], [], []
                had = zip(batch.column("ranges").to_pylist(), batch.column("items").to_pylist())
                for t, (old, ids) in zip(batch.column("t"), had):
                    words = words_of(t.as_buffer().to_pybytes() if t.is_valid else None)
                    hits = scan(automaton, words)
                    count.append(len(words))
                    if hits:
                        whole = [(r["a"], r["b"]) for r in old] + [(a, a + k) for a, k, _ in hits]
                        old = [{"a": a, "b": b} for a, b in _merged(whole)]
                        ids = list({*ids, *(names[i] for _, _, i in hits)})
                    ranges.append(old)
                    items.append(ids)
                    if last and old:
                        at = [m.span() for m in _WORD.finditer(t.as_py())]
                        spans.append([{"a": at[r["a"]][0], "b": at[r["b"] - 1][1]} for r in old])
                    else:
                        spans.append([])
                out = dict(zip(batch.schema.names, batch.columns))
                out |= {"ranges": pa.array(ranges, pairs), "items": pa.array(items, batch.schema.field("items").type)}
                if last:
                    out |= {"n_words": pa.array(count, pa.int64()), "spans": pa.array(spans, pairs)}
                    if not carry:
                        del out["t"]
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

        shape = StructType([f for f in rows.schema.fields if carry or not last or f.name != "t"] + (added if last else []))
        rows = rows.mapInArrow(run, shape)
        if not last:
            rows = stage(rows, "shard")
    return rows


def digest(ids: DataFrame) -> DataFrame:
    """The contract's columns from the operator's."""
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    n_hit = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda s, r: s + r["b"] - r["a"])
    return ids.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def digest_text(item_ids: list) -> str:
    """What ``items_sha256`` hashes, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, item_ids))).encode()).hexdigest()
