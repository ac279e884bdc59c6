"""The pipeline's stages: columns, decisions, and awkward rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from finsieve.llm import op05_simhash, op06_decontaminate
from finsieve.llm.common import table
from finsieve.session import stage
from tests.conftest import SMALL
from tests.llm.helpers import AWKWARD, docs

STAGES = dict(corpus_pipeline.STAGES)


def test_order():
    assert list(STAGES) == ["quality", "line_dedup", "near_dedup", "decontaminate", "pack"]


@pytest.mark.parametrize("name", ["quality", "line_dedup", "near_dedup", "decontaminate"])
def test_columns_stay(spark, name):
    for texts in (AWKWARD, []):
        frame = docs(spark, texts)
        out = STAGES[name](spark, frame, SMALL)
        assert out.columns == frame.columns and [t for _, t in out.dtypes] == [t for _, t in frame.dtypes]
        out.count()


def test_near_dedup_keeps_one_of_each_group(spark):
    base = [f"w{i}" for i in range(400)]
    near = [*base[:200], "changed", *base[201:]]
    other = [f"v{i}" for i in range(400)]
    texts = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (9, " ".join(base)), (4, " ".join(other)), (6, None), (7, "")]
    kept = sorted(r.doc_id for r in STAGES["near_dedup"](spark, docs(spark, texts), SMALL).collect())
    assert kept == [3, 4, 6]


def test_every_stage_on_given_rows(spark):
    frame = table(spark, SMALL, "documents")
    judged = stage(STAGES["quality"](spark, frame, SMALL), "t")
    labels = table(spark, SMALL, "labels")
    seen = frame.join(labels, "doc_id").join(judged.select("doc_id", F.lit(1).alias("kept")), "doc_id", "left")
    wrong = seen.filter(F.coalesce("kept", F.lit(0)) != F.col("quality")).count()
    assert wrong <= 0.03 * seen.count()
    shorter = stage(STAGES["line_dedup"](spark, judged, SMALL), "t")
    assert shorter.count() == judged.count() and shorter.filter("n_chars != length(text)").count() == 0
    apart = stage(STAGES["near_dedup"](spark, shorter, SMALL), "t")
    assert apart.select("text").distinct().count() == apart.count() <= shorter.count()
    clean = stage(STAGES["decontaminate"](spark, apart, SMALL), "t")
    left = op06_decontaminate.decontaminate(clean, table(spark, SMALL, "benchmark"))
    assert left.filter("size(items) > 0").count() == 0
    packed = STAGES["pack"](spark, clean, SMALL)
    assert packed.select("doc_id").distinct().count() == clean.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_radius():
    assert op05_simhash.radius_for(1.0, 512) == 0
    assert op05_simhash.radius_for(0.8, 512, 0) == 77
