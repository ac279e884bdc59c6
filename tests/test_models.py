"""Splits, samples, classifiers, scoring and attribution on the signal fixture."""

import itertools
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from finsieve.constants import MODEL_FEATURES, SCORE_PARITY_TOLERANCE
from finsieve.functions.columns import row_hash
from finsieve.operators import attribution as at, features as ft, models as md, prep, ranking as rk, tree_attribution as ta
from finsieve.operators.tree_attribution import tree_attribution
from finsieve.plans import jobs


@pytest.fixture(scope="module")
def rows(spark, signal):
    return prep.split_by_hash(ft.build_features(signal)).cache()


@pytest.fixture(scope="module")
def folds(rows):
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


@pytest.fixture(scope="module")
def boosted(folds):
    return md.fit(folds[0], md.specs(15)["boosted_weighted"])


def test_features_ignore_the_target(signal):
    a = ft.model_features(signal.drop("is_laundering"))
    b = ft.model_features(signal.withColumn("is_laundering", 1 - F.col("is_laundering")))
    assert a.columns == ["row_id", *MODEL_FEATURES] and a.exceptAll(b).isEmpty() and a.count() == signal.count()


def test_narrow_types(signal):
    assert dict(ft.model_features(signal, narrow=True).dtypes) == {
        "row_id": "bigint", "payment_format": "string", "amount_paid": "float", "sender_previous_tx_count": "int",
        "is_business_hours": "tinyint", "same_account": "tinyint"}


@pytest.mark.parametrize("hour,flag", [(7, 0), (8, 1), (18, 1), (19, 0)])
def test_business_hours_are_inclusive(spark, hour, flag):
    df = spark.sql(f"select timestamp'2024-01-01 {hour:02d}:59:00' as ts")
    assert ft.add_temporal(df).first().is_business_hours == flag


def test_null_account_is_not_the_same(spark):
    df = spark.createDataFrame([("A", None), (None, None), ("A", "A")], "account string, counterparty string")
    assert [r.same_account for r in ft.add_same_account(df).collect()] == [0, 0, 1]


def test_exact_split_sizes(signal):
    out = prep.split_exact(signal)
    counts = {r.split: r for r in prep.split_manifest(out).collect()}
    positives = signal.filter("is_laundering = 1").count()
    assert counts["test"].n == math.ceil(0.3 * 60000) and counts["train"].n + counts["test"].n == 60000
    assert abs(counts["test"].n_positive - 0.3 * positives) <= 1
    assert counts["train"].n_positive + counts["test"].n_positive == positives


def test_draws_do_not_depend_on_layout(signal):
    shuffled = signal.repartition(13).orderBy(F.desc("row_id"))
    for draw in (lambda d: prep.seeded_sample(d, 777), lambda d: prep.undersample(d, 0.5),
                 lambda d: prep.split_exact(d).filter("split = 'test'").drop("split")):
        a, b = draw(signal), draw(shuffled)
        assert {r.row_id for r in a.select("row_id").collect()} == {r.row_id for r in b.select("row_id").collect()}


@pytest.mark.parametrize("n", [0, 1, 17, 5000, 59_999, 60_000, 70_000])
def test_hash_draw_equals_sorting(signal, n):
    got = {r.row_id for r in prep.seeded_sample(signal.select("row_id"), n).collect()}
    ordered = signal.select("row_id").orderBy(row_hash("row_id"), "row_id").limit(n)
    assert got == {r.row_id for r in ordered.collect()} and len(got) == min(n, 60_000)


def test_weights_need_positives(signal):
    w = prep.class_weights(signal).first()
    assert w.scale_pos_weight == pytest.approx(w.n_neg / w.n_pos) and w.balanced_pos == pytest.approx(w.n / 2 / w.n_pos)
    with pytest.raises(PySparkException, match="no positive rows"):
        prep.class_weights(signal.filter("is_laundering = 0")).collect()


def test_boosting_finds_the_signal(folds, boosted):
    test = folds[1]
    base = test.agg(F.avg("is_laundering")).first()[0]
    scored = md.scored(boosted, test, "b").unionByName(md.majority_scored(test))
    ap = {r.model: r.average_precision for r in rk.average_precision(scored).collect()}
    assert ap["majority"] == pytest.approx(base) and ap["b"] > 1.8 * base and ap["b"] > 0.03


def test_training_twice_gives_the_same_scores(folds, boosted):
    again = md.fit(folds[0].repartition(1), md.specs(15)["boosted_weighted"])
    twice = md.fit(folds[0].repartition(1), md.specs(15)["boosted_weighted"])
    out = md.score_parity(md.score_batch(again, folds[1]), md.score_batch(twice, folds[1]), 1e-12).first()
    assert out.within_tolerance and out.n_unmatched == 0


def test_saved_model_scores_alike(folds, boosted, tmp_path):
    boosted.write().overwrite().save(str(tmp_path / "m"))
    out = md.score_parity(md.score_batch(boosted, folds[1]), md.score_batch(PipelineModel.load(str(tmp_path / "m")), folds[1]),
                          SCORE_PARITY_TOLERANCE).first()
    assert out.within_tolerance and out.n_rows == folds[1].count()


def test_scoring_contract(folds, boosted):
    test = folds[1].limit(200)
    out = md.score_batch(boosted, test.withColumn("extra", F.lit(1)))
    assert out.columns == ["row_id", *md.OUTPUT_CONTRACT]
    score = out.orderBy(F.desc("risk_score")).first()
    for shift, flag in ((-1e-6, True), (1e-6, False)):
        got = md.score_batch(boosted, test, threshold=score.risk_score + shift).filter(F.col("row_id") == score.row_id).first()
        assert got.is_alert is flag
    with pytest.raises(md.MissingFeatureError, match="amount_paid, same_account"):
        md.score_batch(boosted, test.drop("amount_paid", "same_account"))
    assert md.score_batch(boosted, test.filter("false")).count() == 0
    one = out.filter(F.col("row_id") == score.row_id).first()
    assert one == md.score_batch(boosted, test.filter(F.col("row_id") == score.row_id)).first()


def test_fresh_models_score_after_staged_queries(folds):
    """A model with a training summary drags the session along; it must stay serializable."""
    rk.average_precision(md.majority_scored(folds[1])).collect()
    plain = md.fit(folds[0], md.specs(1)["logistic_plain"])
    assert md.score_batch(plain, folds[1]).agg(F.count("risk_score")).first()[0] == folds[1].count()


def test_unknown_and_null_formats_are_scored(folds, boosted):
    odd = folds[1].limit(2).withColumn("payment_format", F.when(F.col("row_id") % 2 == 0, "Barter"))
    assert md.score_batch(boosted, odd).filter("risk_score is not null").count() == 2


def test_shapley_is_additive_and_finds_the_format(folds, boosted):
    wide = tree_attribution(boosted, prep.seeded_sample(folds[1], 5000)).cache()
    out = at.additivity(wide, tolerance=1e-9).first()
    assert out.within_tolerance and out.n_rows == 5000
    scores = md.score_batch(boosted, folds[1]).withColumnRenamed("risk_score", "score")
    assert at.margin_checks(wide, scores).first().within_tolerance
    assert at.global_importance(at.to_long(wide)).first().feature == "payment_format"


def test_tree_shapley_equals_all_coalitions(folds):
    """Every subset of features, each tree walked by what is known and by training weight where not."""
    model = md.fit(folds[0].limit(3000), md.specs(4)["boosted_weighted"])
    rows = prep.seeded_sample(folds[1], 12).unionByName(folds[1].limit(1).withColumns({"payment_format": F.lit("Barter"), "row_id": F.lit(-1).cast("long")}))
    last, features = model.stages[-1], MODEL_FEATURES
    moved = model.transform(rows)
    groups = ta.slot_groups(model, features, moved.schema["features"].metadata)

    def read(node):
        if node.numDescendants() == 0:
            return node.prediction()
        split = node.split()
        if split.getClass().getSimpleName() == "ContinuousSplit":
            cut = split.threshold()
            left = lambda v: v <= cut
        else:
            lows = set(split.leftCategories())
            left = lambda v: v in lows
        share = node.leftChild().impurityStats().stats()[0] / node.impurityStats().stats()[0]
        return split.featureIndex(), left, share, read(node.leftChild()), read(node.rightChild())

    def expected(node, x, known):
        if isinstance(node, float):
            return node
        slot, goes_left, share, left, right = node
        if groups[slot] in known:
            return expected(left if goes_left(x[slot]) else right, x, known)
        return share * expected(left, x, known) + (1 - share) * expected(right, x, known)

    got = {r.row_id: r for r in tree_attribution(model, rows).collect()}
    roots = [read(t._java_obj.rootNode()) for t in last.trees]
    for r in moved.collect():
        x = r.features.toArray()
        value = {}
        for size in range(6):
            for known in itertools.combinations(range(5), size):
                value[known] = sum(2 * w * expected(root, x, known) for w, root in zip(last.treeWeights, roots))
        assert got[r.row_id].base == pytest.approx(value[()], abs=1e-9)
        for f, name in enumerate(features):
            phi = 0.0
            for known, v in value.items():
                if f not in known:
                    weight = math.factorial(len(known)) * math.factorial(4 - len(known)) / math.factorial(5)
                    phi += weight * (value[tuple(sorted((*known, f)))] - v)
            assert got[r.row_id][f"phi_{name}"] == pytest.approx(phi, abs=1e-9)


def test_only_boosted_trees_have_tree_attribution(folds):
    model = md.fit(folds[0].limit(500), md.specs(1)["logistic_plain"])
    with pytest.raises(at.NoMarginError):
        tree_attribution(model, folds[1])


def test_train_and_evaluate_jobs(spark, signal, tmp_path):
    out = jobs.train_job(signal, str(tmp_path / "run"), rounds=3)
    assert out.model == md.SELECTED and out.n_test > 0
    verdict = jobs.evaluate_job(spark, str(tmp_path / "run"), baseline=out.metrics)
    assert verdict.regression.first().passed
    report = spark.read.json(str(tmp_path / "run" / "report"))
    assert report.count() == 1 and "average_precision" in report.columns


def test_margin_stays_finite_and_forests_are_refused(spark):
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2) * 1000])) for i in range(40)], ["label", "features"])
    model = LogisticRegression(labelCol="label", regParam=0.0, maxIter=200).fit(rows)
    far = spark.createDataFrame([(Vectors.dense([1e6]),), (Vectors.dense([-1e6]),)], ["features"])
    out = [r.margin for r in at.margin(model)(far).collect()]
    assert all(abs(m) < float("inf") for m in out) and out[0] > 100 > -100 > out[1]
    with pytest.raises(at.NoMarginError):
        at.margin(RandomForestClassifier(numTrees=2, maxDepth=2).fit(rows))


def test_ablation_reports_the_loss(folds, boosted):
    """Without the format, which carries the signal, precision falls; without the flag it hardly moves."""
    full, spec = md.scored(boosted, folds[1], "b"), md.specs(15)["boosted_weighted"]
    moved = {}
    for f in ("payment_format", "same_account"):
        out = md.ablation(full, md.scored(md.fit(folds[0], spec, (f,)), folds[1], "b"), f).first()
        assert out.dropped == f and out.difference == pytest.approx(out.without - out.average_precision)
        moved[f] = out.difference
    assert moved["payment_format"] < -0.01 and abs(moved["same_account"]) < abs(moved["payment_format"]) / 2


def test_boosting_fits_cells_of_equal_bins(spark, folds):
    """A fit sees as many rows as there are cells, however many rows they hold, and all of their weight."""
    train = prep.add_weight(folds[0], "scale_pos").select("payment_format", "amount_paid", "is_laundering", "weight")
    tables = []
    for times in (1, 30, 60):
        many = train.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(times))))
        cuts = prep.bin_cuts(many, ["amount_paid"], "weight")
        assert len(cuts["amount_paid"]) == prep.BINS - 1
        binned = prep.binning(cuts).transform(many)
        keys = ["payment_format", "amount_paid_bin", "is_laundering"]
        table = prep.cells(binned, keys, "weight")
        want = {r[:3]: r[3:] for r in binned.groupBy(*keys).agg(F.count(F.lit(1)), F.sum("weight")).collect()}
        got = {r[:3]: r[3:] for r in table.groupBy(*keys).agg(F.count(F.lit(1)), F.sum("weight")).collect()}
        assert got.keys() == want.keys()
        for k, (n, weight) in want.items():
            assert got[k][0] == min(n, prep.CELL_ROWS) and got[k][1] == pytest.approx(weight)
        heavy = binned.groupBy("amount_paid_bin").agg(F.sum("weight").alias("w")).agg(F.max("w"), F.avg("w")).first()
        assert heavy[0] < 1.3 * heavy[1]
        tables.append(table.count())
    assert tables[1] == tables[2] <= 4 * prep.BINS * 2 * prep.CELL_ROWS


def test_boosting_reads_a_table_of_cells(folds, monkeypatch):
    """Twenty times the rows make no more rows for the trees to pass over."""
    seen, made = [], md.cells
    monkeypatch.setattr(md, "cells", lambda *a: seen.append(made(*a)) or seen[-1])
    rows = folds[0].withColumn("amount_paid", F.round("amount_paid", -2)).withColumn("sender_previous_tx_count", F.lit(0))
    for times in (20, 40):
        model = md.fit(rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(times)))), md.specs(2)["boosted_weighted"])
    assert seen[0].count() == seen[1].count() < rows.count()
    assert md.score_batch(model, folds[1]).filter("risk_score is null").count() == 0


def test_bins_part_values_as_trees_do(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (2.0, 1), (4.0, 1), (None, 0), (float("nan"), 1), (float("inf"), 1)], "v double, is_laundering int")
    cuts = prep.bin_cuts(df, ["v"])
    assert cuts == {"v": [1.5, 3.0]}
    got = [(r.v, r.v_bin) for r in prep.binning(cuts).transform(df).collect()]
    assert [b for _, b in got] == [0.0, 1.0, 1.0, 2.0, None, 2.0, 2.0]
    assert prep.bin_cuts(df.filter("v is null"), ["v"]) == {"v": []}
    assert [r.v_bin for r in prep.binning({"v": []}).transform(df.limit(2)).collect()] == [0.0, 0.0]


def test_rounds_of_boosting_are_checkpointed(spark, folds, monkeypatch, tmp_path):
    """A session without a folder gets one, or tasks of late rounds would carry all rounds before."""
    made = []
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: made[-1] if made else None)
    monkeypatch.setattr(type(spark.sparkContext), "setCheckpointDir", lambda self, path: made.append(path))
    md.fit(folds[0].limit(2000), md.specs(1)["boosted_weighted"])
    assert len(made) == 1 and made[0].endswith("/rounds")


def test_a_model_over_bins_scores_each_cell_once(folds, boosted, monkeypatch):
    """Trees pass over the cells that occur, not over rows; scores are those of the model itself."""
    few = folds[1].withColumn("sender_previous_tx_count", F.lit(0))
    rows = few.unionByName(few.limit(3).withColumn("payment_format", F.lit(None).cast("string")).withColumn("row_id", -F.col("row_id") - 1))
    seen, made = [], md.stage
    monkeypatch.setattr(md, "stage", lambda *a: seen.append(made(*a)) or seen[-1])
    out = {r.row_id: r.risk_score for r in md.score_batch(boosted, rows).collect()}
    assert len(seen) == 1 and seen[0].count() < rows.count() / 10
    want = boosted.transform(rows).select("row_id", "probability").collect()
    assert out == {r.row_id: r.probability[1] for r in want} and len(out) == rows.count()


def test_a_forest_is_fitted_on_cells(spark, folds):
    from pyspark.ml.feature import SQLTransformer

    spec = md.specs(1)["random_forest"]
    few = spec._replace(estimator=lambda rows, weighted: spec.estimator(rows, weighted).setNumTrees(5).setMaxDepth(4))
    rows = folds[0].limit(3000)
    model = md.fit(rows, few)
    assert isinstance(model.stages[0], SQLTransformer) and spec.cells * 0.25 > 20
    out = md.scored(model, rows, "forest").agg(F.count("score").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert out.n == 3000 and 0 <= out.low < out.high <= 1


def test_models_are_fitted_side_by_side(spark, sf, monkeypatch):
    from threading import Barrier

    from finsieve.plans import catalog_ranking as cr

    together = Barrier(len(md.specs()), timeout=60)
    monkeypatch.setattr(cr, "fitted", lambda spark, sf, name: together.wait() * 0)
    monkeypatch.setattr(md, "scored", lambda model, df, name: md.majority_scored(df, name))
    assert cr.model_comparison(spark, sf).count() == 1 + len(md.specs())
