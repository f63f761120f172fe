import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.models import ensemble as E
from riskflow.models import forest as I
from riskflow.models import prepare as P


@pytest.fixture(scope="module")
def rows(spark):
    """Positives lie apart in x and y; every 20th row is one."""
    return spark.range(4000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 20 == 0).cast("int").alias("is_fraud"),
        (F.col("id") * 37 % 101 / 10.0 + F.when(F.col("id") % 20 == 0, 8.0).otherwise(0.0)).alias("x"),
        (F.col("id") * 53 % 97 / 10.0 + F.when(F.col("id") % 20 == 0, 6.0).otherwise(0.0)).alias("y")).cache()


def test_split_keeps_class_shares_and_is_repeatable(rows):
    out = P.assign_split(rows)
    shares = {r["split"]: (r["n"], r["p"]) for r in out.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.avg("is_fraud").alias("p")).collect()}
    assert shares["test"][0] / 4000 == pytest.approx(0.15, abs=0.02)
    assert shares["validation"][0] / 4000 == pytest.approx(0.1275, abs=0.02)
    assert all(p == pytest.approx(0.05, abs=0.02) for _, p in shares.values())
    assert out.exceptAll(P.assign_split(rows.repartition(5))).isEmpty()


def test_standardize(rows):
    row = P.standardize(rows.withColumn("k", F.lit(3.0)), ["x", "k"]).agg(
        F.avg("x"), F.stddev_pop("x"), F.max("k")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 0.0


def test_oversampling_reaches_the_ratio_between_minority_rows(rows):
    out = P.oversample(rows, ["x", "y"], 0.15, rows_per_cell=60)
    n = {r["is_fraud"]: r["count"] for r in out.groupBy("is_fraud").count().collect()}
    assert n[0] == 3800 and n[1] == pytest.approx(570, abs=40)
    made, real = out.where("is_synthetic"), rows.where("is_fraud = 1")
    lo, hi = real.agg(F.min("x"), F.max("x")).first()
    assert made.where((F.col("x") < lo) | (F.col("x") > hi)).isEmpty()
    assert P.oversample(rows, ["x", "y"], 0.01).count() == 4000


def test_forest_ranks_an_outlier_first(spark, rows):
    table = rows.select("transaction_id", "x", "y").union(spark.sql("select 9999L, 500.0D, -300.0D"))
    forest = I.fit_forest(table, ["x", "y"], trees=40, sample=4096)
    assert len(forest.trees) == 40
    out = forest.transform(table).orderBy(F.col("anomaly_score").desc()).first()
    assert out["transaction_id"] == 9999 and 0.99 <= out["anomaly_score"] <= 1.0
    # The score of a row does not depend on the rows it is scored with.
    alone = forest.transform(table.where("transaction_id = 5")).first()["anomaly_score"]
    among = forest.transform(table).where("transaction_id = 5").first()["anomaly_score"]
    assert alone == pytest.approx(among)


def test_ensemble(rows):
    train, validation, test = [P.assign_split(rows).where(F.col("split") == s).drop("split")
                               for s in ("train", "validation", "test")]
    small = {"rounds": 4, "depth": 3}
    model = E.Ensemble(["x", "y"], options={"primary": small, "challenger": small, "forest": {"trees": 10}})
    with pytest.raises(E.NotFitted):
        model.score(test)
    model.fit(train, validation)
    scored = model.score(test)
    lo, hi = scored.agg(F.min("fraud_risk_score"), F.max("fraud_risk_score")).first()
    assert 0 <= lo < hi <= 100
    report = model.report(test).first()
    assert report["roc_auc"] > 0.95
    assert report["true_positives"] + report["false_negatives"] == test.where("is_fraud = 1").count()
    top = E.importance(model.primary, test, rows=200).collect()
    assert {r["feature"] for r in top} == {"x", "y"} and top[0]["importance"] >= top[1]["importance"] > 0


def test_calibration_is_skipped_without_enough_positives(rows):
    few = rows.where("is_fraud = 0").union(rows.where("is_fraud = 1").limit(3))
    assert E.calibrate(few, "x") is None
    a, _ = E.calibrate(rows, "x")
    assert a > 0 and np.isfinite(a)


def test_queries_run_the_operators_with_their_defaults(spark, monkeypatch):
    """The registered fits read all model features of the gold table and pass no smaller number of rounds, trees or trials."""
    from riskflow.catalog import models as Q
    from riskflow.catalog.registry import QUERIES
    from riskflow.schemas import MODEL_FEATURES

    class Reached(Exception):
        pass

    def reached(*args, **options):
        seen.append(([a for a in args if isinstance(a, list)], options))
        raise Reached

    seen = []
    gold = spark.range(10).selectExpr("id as transaction_id", "cast(id % 2 as int) as is_fraud", *[f"0D as {c}" for c in MODEL_FEATURES])
    monkeypatch.setattr(Q, "gold_rows", lambda spark, sf_dir: gold)
    for module, name in ((E, "fit_primary"), (E, "fit_challenger"), (E, "search"), (I, "fit_forest")):
        monkeypatch.setattr(module, name, reached)
    names = ["gbt_primary", "gbt_challenger", "iforest_score", "param_search", "ensemble_fit", "train_e2e", "batch_score", "top_features"]
    for name in names:
        with pytest.raises(Reached):
            QUERIES[name](spark, "")
    assert seen == [([MODEL_FEATURES], {})] * len(names)


def test_first_by_hash_is_exact(spark):
    from riskflow.models.prepare import bucket, first_by_hash

    df = spark.range(1000).withColumnRenamed("id", "_id")
    order = [r["_id"] for r in df.orderBy(bucket("_id", 5, 64), "_id").collect()]
    for n in (0, 1, 37, 999, 1000):
        assert sorted(r["_id"] for r in first_by_hash(df, "_id", n, 5, 64).collect()) == sorted(order[:n])


def test_gold_rows_are_built_from_stored_rules(spark, tmp_path, monkeypatch):
    """The frames read their rows about twenty times, so the rules must not be part of them."""
    from riskflow.catalog import models as Q

    seen = []
    build = Q.X.build_features
    monkeypatch.setattr(Q.X, "build_features", lambda df: (seen.append(df), build(df))[1])
    Q.gold_rows(spark, "/root/testdata/sf0.001")
    assert "Window" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_forest_walks_all_rows_at_once_as_one_by_one():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 4)), 1)
    x[7, 2] = np.nan
    nodes = I._grow(x[100:164], np.arange(4), 6, rng)
    tree = {c: np.array([n[i + 1] for n in nodes]) for i, c in enumerate(I.FIELDS)}
    for row, got in zip(x, I.IsolationForest(list("abcd"), [tree], 64).raw(x), strict=True):
        at = 0
        while tree["feature"][at] >= 0:
            at = tree["left"][at] if row[tree["feature"][at]] < tree["cut"][at] else tree["right"][at]
        assert got == np.exp2(-tree["path"][at] / I._expected_path(64))
    *_, steps = I._steps(tree)
    assert steps == 6


def test_fit_reads_stored_rows(rows, monkeypatch):
    """The passes of a fit must not contain the search for near rows."""
    seen = []
    fit = E.GBTClassifier.fit
    monkeypatch.setattr(E.GBTClassifier, "fit", lambda self, df: (seen.append(df), fit(self, df))[1])
    train, validation = [P.assign_split(rows).where(F.col("split") == s).drop("split") for s in ("train", "validation")]
    E.fit_primary(train, validation, ["x", "y"], rounds=2, depth=2)
    E.fit_challenger(train, validation, ["x", "y"], rounds=2, depth=2)
    for df in seen:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Join" not in plan


def test_search_fits_on_partitions_of_the_asked_size(rows, monkeypatch):
    """Each level of a tree starts a task per partition, so the folds must not be cut by the number of cores or files."""
    seen = []
    fit = E.GBTClassifier.fit
    monkeypatch.setattr(E.GBTClassifier, "fit", lambda self, df, params: (seen.append(df.rdd.getNumPartitions()), fit(self, df, params))[1])
    found = E.search(rows, ["x", "y"], trials=1, folds=2, max_rounds=2, parallelism=1, batch_rows=160).collect()
    assert set(seen) == {25} and len(found) == 1 and 0 <= found[0].pr_auc <= 1


def test_search_fits_every_fold_of_every_trial(rows, monkeypatch):
    """No trial may stop before its last fold, so that all scores are means over the same rows."""
    seen = []
    fit = E.GBTClassifier.fit
    monkeypatch.setattr(E.GBTClassifier, "fit", lambda self, df, params: (seen.append(1), fit(self, df, params))[1])
    found = E.search(rows, ["x", "y"], trials=4, folds=3, max_rounds=2, parallelism=4, batch_rows=4000).collect()
    assert len(seen) == 12 and [r.folds for r in found] == [3] * 4


class Weighted:
    """In place of a fitted model: a probability that is a plain sum of the columns."""

    columns = ["x", "y"]

    def probability(self, df, output):
        return df.withColumn(output, (F.col("x") * 3 + F.col("y")) / 1000)


def test_importance_equals_exchanging_values_by_hand(spark):
    """Also with ids that repeat or are missing; the rows are exchanged once and joined with nothing."""
    df = spark.range(90).selectExpr("if(id % 11 = 0, null, id div if(id < 20, 3, 1)) as transaction_id").selectExpr(
        "transaction_id", "coalesce(transaction_id * 7 % 23, 40) as x", "cast(coalesce(transaction_id * 5 % 19, 9) as double) as y")
    found = E.importance(Weighted(), df, group=30)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    groups = {}
    for r in df.selectExpr("transaction_id as k", "x", "y", "pmod(xxhash64(transaction_id, 42), 3) as g").collect():
        groups.setdefault(r.g, []).append(r)
    changes = {"x": [], "y": []}
    p = lambda x, y: (x * 3 + y) / 1000
    for rows in groups.values():
        rows.sort(key=lambda r: (r.k is not None, r.k, r.x, r.y))
        for i, r in enumerate(rows):
            w = rows[(i + len(rows) // 2) % len(rows)]
            for other in rows:
                if r.k is not None and other.k == r.k:
                    changes["x"].append(abs(p(w.x, r.y) - p(other.x, other.y)))
                    changes["y"].append(abs(p(r.x, w.y) - p(other.x, other.y)))
    got = {r.feature: r.importance for r in found.collect()}
    assert got == {c: pytest.approx(np.mean(v)) for c, v in changes.items()}


def scratch_tables(spark, label):
    from pathlib import Path

    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    return {p.name for p in root.iterdir() if p.name.startswith(f"{label}-")}


def test_a_fit_removes_the_rows_it_stored(spark, rows):
    train, validation = [P.assign_split(rows).where(F.col("split") == s).drop("split") for s in ("train", "validation")]
    before = scratch_tables(spark, "training")
    model = E.fit_primary(train, validation, ["x", "y"], rounds=2, depth=2)
    E.fit_challenger(train, validation, ["x", "y"], rounds=2, depth=2)
    assert scratch_tables(spark, "training") == before
    assert model.probability(validation, "p").where("p between 0 and 1").count() == validation.count()


def test_gold_rows_remove_the_ruled_rows(spark):
    from riskflow.catalog import models as Q

    before = scratch_tables(spark, "ruled")
    gold = Q.gold_rows(spark, "/root/testdata/sf0.001")
    assert scratch_tables(spark, "ruled") == before and gold.count() == 1000


def test_neighbours_are_looked_up_by_id(rows):
    """The exchanges by pairs of rows carry ids and distances; synthetic rows lie on lines between minority rows."""
    made = P.oversample(rows, ["x", "y"], 0.15, rows_per_cell=60).where("is_synthetic")
    assert "first(_x" not in made._jdf.queryExecution().optimizedPlan().toString()
    few = np.array([(r.x, r.y) for r in rows.where("is_fraud = 1").collect()])
    for r in made.collect():
        at = np.array([r.x, r.y])
        a, b = few[:, None] - at, few[None, :] - at
        between = np.abs(a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]) < 1e-6
        assert (between & ((a * b).sum(axis=2) <= 1e-6)).any()
