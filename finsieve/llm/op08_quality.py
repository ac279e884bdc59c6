"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts are counted in numpy. A small forest is fitted on labelled rows; every
path from a root to a node is a rule, a conjunction of bounds on statistics. A lasso logistic
regression weighs the rules and sets most weights to zero. What is left is compiled into one
Spark column expression, which scores every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from finsieve.llm.common import pieces
from finsieve.session import stage

#: At most so many labelled rows, those with the smallest hash of their id, are fitted on.
FIT_ROWS = 20_000
TREES, DEPTH, LASSO = 20, 4, 0.0005
THRESHOLD = 0.7
STATISTICS = (
    "n_bytes", "n_words", "n_lines", "upper", "lower", "digit", "blank", "high", "mark", "stop_mark", "pipe",
    "word_length", "distinct_words", "same_as_before", "top_word", "marked_words", "distinct_pairs", "distinct_lines",
    "line_length", "high_run", "top_byte", "mixed_words",
)
_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _b = bytes([_c])
    _CLASS[_c] = (0 if _b.isupper() else 1 if _b.islower() else 2 if _b.isdigit() else 3 if _b.isspace()
                  else 4 if _c >= 0x80 else 5 if _b in b".,;:?'\"-()" else 6 if _b == b"|" else 7)


def statistics(text: bytes | None) -> list[float]:
    """Numbers in the order of ``STATISTICS``; all zero for a null or empty text."""
    text = text or b""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=counts, minlength=8) / n
    words = text.split()
    m = max(1, len(words))
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    return [
        math.log1p(n), math.log1p(len(words)), math.log1p(len(lines)), kinds[0], kinds[1], kinds[2], kinds[3], kinds[4],
        kinds[7], kinds[5], kinds[6], sum(map(len, words)) / m, len(tally) / m, same / m,
        max(tally.values(), default=0) / m, sum(not w[-1:].isalnum() and w[-1] < 0x80 for w in words) / m,
        pairs / max(1, m - 1), len(set(lines)) / k, math.log1p(n / k),
        sum(c for c in np.sort(counts)[-8:].tolist()) / n, counts.max() / n,
        sum(w.upper() == w for w in words) / m,
    ]


def measured(docs: DataFrame, id: str, text: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, s) for every row, s the statistics as an array of doubles; with ``carry`` also t, the text, and those columns in ``carried``."""
    picked = docs.select(
        F.col(id).alias("id"), F.col(text).cast("string").alias("t"), *([F.struct(*carry).alias("carried")] if carry else [])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [statistics(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch.column("t")]
            out = dict(zip(batch.schema.names, batch.columns)) | {"s": pa.array(rows, pa.list_(pa.float64()))}
            if not carry:
                del out["t"]
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    shape = [f for f in picked.schema.fields if carry or f.name != "t"]
    return picked.mapInArrow(run, StructType([*shape, StructField("s", ArrayType(DoubleType()))]))


Rule = frozenset[tuple[int, str, float]]


def rules_of(dump: str) -> list[Rule]:
    """All root-to-node conjunctions of one tree, from Spark's printed form; tighter bounds replace wider ones."""
    found: list[Rule] = []
    path: list[tuple[int, str, float]] = []
    for line in dump.splitlines():
        body = line.lstrip(" ")
        if not body.startswith(("If ", "Else ")):
            continue
        level = len(line) - len(body) - 2
        _, feature, op, bound = body[body.index("(") + 1:body.rindex(")")].split(" ")
        path = [*path[:level], (int(feature), op, float(bound))]
        tight: dict[tuple[int, str], float] = {}
        for f, o, b in path:
            old = tight.get((f, o))
            tight[f, o] = b if old is None else min(old, b) if o == "<=" else max(old, b)
        found.append(frozenset((f, o, b) for (f, o), b in tight.items()))
    return found


def condition(rule: Rule, stats: Column) -> Column:
    out = F.lit(True)
    for f, op, bound in sorted(rule):
        out = out & (stats[f] <= bound if op == "<=" else stats[f] > bound)
    return out


@dataclass(frozen=True)
class RuleModel:
    """Intercept and weighted rules; ``score`` compiles them into a Spark column."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(condition(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, id: str, text: str, label: str, rows: int) -> DataFrame:
    """(id, s, y): statistics of at most ``rows`` labelled documents that ``learn`` admits.

    ``learn`` is over ``labels``. Labels other than 0 and 1, null ones too, are not used; of
    several labels of one id the smallest counts.
    """
    known = labels.filter(learn & F.col(label).isin(0, 1)).groupBy(F.col(id).alias("_id")).agg(
        F.min(label).cast("double").alias("_y")
    )
    known = stage(known.orderBy(F.xxhash64("_id"), "_id").limit(rows), "labelled")
    chosen = docs.select(F.col(id).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(known), "_id")
    return stage(measured(chosen, "_id", "_t").join(F.broadcast(known.withColumnRenamed("_id", "id")), "id")
                 .withColumnRenamed("_y", "y"), "measured")


def fit(known: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = 42) -> RuleModel:
    """Fit rules and weights on (s, y). Without both labels the score is the constant share of label 1, or a half."""
    total, ones = known.agg(F.count("*"), F.sum("y")).first()
    if not total or ones in (0, total):
        share = min(max((ones / total) if total else 0.5, 1e-6), 1 - 1e-6)
        return RuleModel(math.log(share / (1 - share)), ())
    known = known.withColumn("x", array_to_vector("s"))
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=5, seed=seed,
        featureSubsetStrategy="onethird",
    ).fit(known)
    rules = sorted({r for t in forest.trees for r in rules_of(t.toDebugString)}, key=sorted)
    if not rules:
        return RuleModel(math.log(ones / (total - ones)), ())
    bits = F.array(*[condition(r, F.col("s")).cast("double") for r in rules])
    marked = stage(known.select("y", bits.alias("b")), "rules").select("y", array_to_vector("b").alias("x"))
    model = LogisticRegression(
        featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False
    ).fit(marked)
    weights = tuple((r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w)
    return RuleModel(float(model.intercept), weights)


def score(
    docs: DataFrame, model: RuleModel, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, score, predicted) for every row of ``docs``; predicted is 1 from ``threshold`` on.

    With ``carry`` the rows also have t, the text, and those columns in ``carried``.

    Null and empty texts are scored by statistics of zero. Rows that repeat each give a row, a
    null id too; an empty table gives an empty one. Other columns are not touched.
    """
    scored = measured(docs, id, text, carry).withColumn("score", model.score(F.col("s"))).drop("s")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
