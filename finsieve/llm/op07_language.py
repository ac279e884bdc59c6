"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent one- to three-grams, most frequent first. The distance of a
document to a language is the sum over its own profile of how far each n-gram is out of place in the
language's, with a full penalty for one that is not there. N-grams are counted over whole texts
by sorting packed numbers, many documents at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from finsieve.llm.common import pieces

TOP = 300
SLICE = 2 << 20
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-case words with one blank around each; empty when there is no letter."""
    inside = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {inside} " if inside else ""


def counted(texts: list[str], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram, count) of all n-grams, sorted by owner and n-gram.

    ``owner`` numbers the group that each text counts for. An n-gram is up to three code points of
    21 bits, so shorter ones come first. None reaches over a blank.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    if not len(codes):
        none = np.zeros(0, np.int64)
        return none, none, none
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen)
    bits = int(len(alphabet)).bit_length()
    small = np.zeros(0x110000, np.uint64)
    small[alphabet] = np.arange(1, len(alphabet) + 1)
    c = small[codes]
    blank = codes == 0x20
    doc = np.repeat(owner.astype(np.uint64), [len(t) for t in texts]) << np.uint64(3 * bits)
    one = (doc | c)[~blank]
    two = (doc[1:] | c[:-1] << np.uint64(bits) | c[1:])[~(blank[:-1] & blank[1:])]
    three = (doc[2:] | c[:-2] << np.uint64(2 * bits) | c[1:-1] << np.uint64(bits) | c[2:])[~blank[1:-1]]
    keys = np.concatenate([one, two, three])
    if int(owner.max(initial=0)).bit_length() + 3 * bits <= 32:
        keys = keys.astype(np.uint32)
    keys.sort()
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(start, len(keys)))
    keys = keys[start].astype(np.int64)
    wide, mask = np.concatenate([[0], alphabet]), (1 << bits) - 1
    gram = wide[keys >> 2 * bits & mask] << 42 | wide[keys >> bits & mask] << 21 | wide[keys & mask]
    return keys >> 3 * bits, gram, count


def ranked(owner: np.ndarray, gram: np.ndarray, count: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram, rank) of the ``top`` most frequent per owner; ties go to the smaller n-gram."""
    at = np.arange(len(owner), dtype=np.int64)
    width = int(len(owner)).bit_length()
    most = 60 - width - int(owner.max(initial=0)).bit_length()
    rare = (1 << most) - 1 - np.minimum(count, (1 << most) - 1)
    order = np.sort((owner << (most + width)) | (rare << width) | at) & ((1 << width) - 1)
    o = owner[order]
    first = np.searchsorted(o, o)
    rank = at - first
    keep = rank < top
    return o[keep], gram[order][keep], rank[keep]


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return pieces(batches, SLICE)


def profiles(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """(lang, gram, rank): the ``top`` n-grams of every language over all rows that ``learn`` admits."""
    picked = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("t")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            o, g, c = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((g, o))
            o, g, c = o[order], g[order], c[order]
            start = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (g[1:] != g[:-1])]))
            return o[start], g[start], np.add.reduceat(c, start)

        for batch in _slices(batches):
            owner = np.array([names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()], np.int64)
            found = counted([letters(t) for t in batch.column(1).to_pylist()], owner)
            if len(found[0]):
                held.append(found)
            if len(held) > 32:
                held = [merged()]
        if held:
            o, g, c = merged()
            known = list(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([known[x] for x in o.tolist()], pa.string()), pa.array(g), pa.array(c)], names=["lang", "gram", "n"]
            )

    sums = picked.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return sums.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < top).select("lang", "gram", "rank")


def identify(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text", top: int = TOP) -> DataFrame:
    """(id, lang_pred, score) for every row of ``docs``; ``known`` are profiles of (lang, gram, rank).

    ``und`` with score 0 if the text is null or has no letter, or no language is known. The score is
    1 less the distance as a share of the largest possible; ties go to the first language by name.
    What is broadcast are ``top`` rows per language. Rows that repeat each give a row, a null id
    too; an empty table gives an empty one. Other columns are not touched.
    """
    rows = known.collect()
    langs = sorted({r["lang"] for r in rows})
    grams = np.array(sorted({r["gram"] for r in rows}), np.int64)
    place = np.full((len(grams) + 1, len(langs)), top, np.int32)
    spot = {g: i for i, g in enumerate(grams.tolist())}
    for r in rows:
        place[spot[r["gram"]], langs.index(r["lang"])] = r["rank"]
    shared = docs.sparkSession.sparkContext.broadcast((langs, grams, place))
    picked = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("t"))
    kind = picked.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, grams, place = shared.value
        for batch in _slices(batches):
            texts = [letters(t) for t in batch.column(1).to_pylist()]
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            o, g, rank = ranked(*counted(texts, np.arange(len(texts))), top)
            if langs and len(o):
                at = np.searchsorted(grams, g)
                at[at == len(grams)] = 0
                there = place[np.where(grams[at] == g, at, len(grams))]
                out = np.where(there == top, top, np.abs(there - rank[:, None]))
                start = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
                total = np.add.reduceat(out, start, axis=0)
                size = np.diff(np.append(start, len(o)))
                best = total.argmin(axis=1)
                for d, b, t, n in zip(o[start].tolist(), best.tolist(), total.min(axis=1).tolist(), size.tolist()):
                    pred[d], score[d] = langs[b], 1 - t / (top * n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"]
            )

    return picked.mapInArrow(run, f"id {kind}, lang_pred string, score double")
