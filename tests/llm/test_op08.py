"""Quality: rules read from trees, compiled scores, accuracy on documents held out."""

import math

from pyspark.sql import functions as F

from finsieve.llm import op08_quality as quality
from finsieve.llm.common import held_out, table
from tests.conftest import ORACLE
from tests.llm.helpers import AWKWARD, docs

DUMP = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=3
  If (feature 0 <= 0.5)
   If (feature 1 <= 1.5E-4)
    Predict: 0.0
   Else (feature 1 > 1.5E-4)
    If (feature 0 <= 0.25)
     Predict: 1.0
    Else (feature 0 > 0.25)
     Predict: 0.0
  Else (feature 0 > 0.5)
   Predict: 1.0
"""


def test_rules_of_a_tree():
    assert set(quality.rules_of(DUMP)) == {
        frozenset({(0, "<=", 0.5)}), frozenset({(0, "<=", 0.5), (1, "<=", 1.5e-4)}), frozenset({(0, "<=", 0.5), (1, ">", 1.5e-4)}),
        frozenset({(0, "<=", 0.25), (1, ">", 1.5e-4)}), frozenset({(0, "<=", 0.5), (0, ">", 0.25), (1, ">", 1.5e-4)}), frozenset({(0, ">", 0.5)}),
    }


def test_compiled_scores(spark):
    model = quality.RuleModel(-1.0, ((frozenset({(0, "<=", 2.0), (1, ">", 0.0)}), 2.5), (frozenset({(1, "<=", 0.0)}), -0.5)))
    rows = spark.createDataFrame([([2.0, 1.0],), ([3.0, 1.0],), ([0.0, 0.0],)], "s array<double>")
    got = [r[0] for r in rows.select(model.score(F.col("s"))).collect()]
    assert all(math.isclose(g, 1 / (1 + math.exp(-z))) for g, z in zip(got, (1.5, -1.0, -1.5)))


def test_awkward_rows(spark):
    frame = docs(spark, AWKWARD)
    labels = spark.createDataFrame([(4, 0), (4, 1), (6, 1), (7, None), (9, 5), (None, 1), (77, 1)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        known = quality.labelled(frame, given, F.lit(True), "doc_id", "text", "quality", 100)
        out = quality.score(frame, quality.fit(known)).collect()
        assert sorted(str(r.id) for r in out) == sorted(str(i) for i, _ in AWKWARD)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert quality.score(docs(spark, []), quality.RuleModel(0.0, ())).count() == 0
    assert quality.statistics(None) == quality.statistics(b"") == [0.0] * len(quality.STATISTICS)


def test_held_out_accuracy(spark):
    frame, labels = table(spark, ORACLE, "documents"), table(spark, ORACLE, "labels")
    model = quality.fit(quality.labelled(frame, labels, ~held_out(F.col("doc_id"), 4, 2), "doc_id", "text", "quality", 20_000))
    out = quality.score(frame, model).join(labels, F.col("id") == F.col("doc_id")).filter(held_out(F.col("doc_id"), 4, 2))
    rows = out.select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows) > 0
    assert 0 < len(model.weights) < 200
