"""Keep-one rules, sources, sinks, splits and metrics on small tables."""

import random
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from staylens import schema as S
from staylens.operators import aggregates, arrays, checks, metrics, ranking, rows
from staylens.plans import train
from staylens.plans.features import FEATURE_STORE_COLUMNS
from staylens.sources import files, manifests, tables


def test_contract_tables(spark):
    assert len(S.FEATURE_SPECS) == 67 and len(FEATURE_STORE_COLUMNS) == 108
    assert manifests.feature_contract(spark).count() == 67
    assert manifests.feature_manifest(spark).count() == 32
    first = manifests.manifest_report(spark).first()
    assert first["include_in_current_xgboost"] and first["feature_name"] == "avg_prior_risk_score"
    assert manifests.null_rules(spark, "r").count() == 7
    assert {r["column_name"] for r in manifests.exclusion_report(spark, "r").collect()} == {"rhythm"}


def test_keep_rules(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, 1, None, None), (1, 2, "a", t), (1, 3, "b", None), (2, 4, None, t), (2, 5, None, t)],
        "k int, id int, x string, at timestamp_ntz",
    )
    pick = lambda d: sorted((r["k"], r["id"]) for r in d.collect())
    assert pick(rows.keep_best(df, "k", ["k", "id", "x", "at"], "at")) == [(1, 2), (2, 5)]
    assert pick(rows.keep_earliest(df, ["k"], "at", "id")) == [(1, 2), (2, 4)]
    assert pick(rows.keep_latest(df, ["k"], "at", "id")) == [(1, 3), (2, 5)]


def test_dedupe_treats_null_as_equal(spark):
    df = spark.createDataFrame(
        [(1, None, None), (1, None, datetime(2024, 1, 2)), (1, "a", datetime(2024, 1, 1))],
        "k int, x string, at timestamp_ntz",
    )
    assert rows.dedupe(df, ["k", "x"], "at").count() == 2
    assert rows.excess_duplicates(df, ["k", "x"]).first()[0] == 1


def test_slope_edges(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    data = [(1, t(1), "80"), (1, t(3), "90"), (1, t(2), None), (2, t(1), "80"), (3, t(1), "70"), (3, t(1), "99"), (4, t(1), None)]
    df = spark.createDataFrame(data, "k int, at timestamp_ntz, s string").withColumn("v", F.col("s").cast("decimal(6,2)"))
    out = aggregates.per_key(df, "k", *aggregates.first_last("v", "at", "v"))
    got = {r["k"]: r["s"] for r in out.select("k", aggregates.slope_per_hour("v").alias("s")).collect()}
    assert float(got[1]) == 5.0 and got[2] is None and got[3] is None and got[4] is None


def test_ragged_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        'a,b,c\n1,2,x\n3,4,x,,y, z\n5,6,"q, ""r"""\n7\n8,9,"p, q",r\n"1,0",2,"m ""n""" tail,o\n'
        + "9,9," + ",".join("w" * 300) + "\n"
    )
    got = [tuple(r) for r in files.read_ragged_csv(spark, str(path), ["a", "b", "c"]).collect()]
    assert got == [
        ("1", "2", "x"), ("3", "4", "x,,y, z"), ("5", "6", 'q, "r"'), ("7", None, None),
        ("8", "9", "p, q,r"), ("1,0", "2", 'm "n" tail,o'), ("9", "9", ",".join("w" * 300)),
    ]


def test_repair_triage(spark):
    cols = ["subject_id", "stay_id", *S.VITALS, "pain", "acuity", "chiefcomplaint"]
    df = spark.createDataFrame(
        [("1", "2", "986", "80", "x", "1980", "12080", "74810", "nan", "3", 'a "b"'), ("1", None, *["1"] * 9)],
        ", ".join(f"{c} string" for c in cols),
    )
    got = files.repair_triage(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["temperature"], r["heartrate"], r["resprate"], r["o2sat"]) == (98.6, 80.0, None, 100.0)
    assert (r["sbp"], r["dbp"], r["pain"], r["chiefcomplaint"]) == (120.8, 74.81, None, "a b")


def test_table_operators(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    empty = tables.ensure_table(spark, p("empty"), "a int, b string")
    assert empty.count() == 0 and empty.dtypes == [("a", "int"), ("b", "string")]
    df = spark.createDataFrame([("m", "1", 1), ("m", "2", 2)], "model_name string, model_version string, v int")
    keys = ["model_name", "model_version"]
    tables.replace_slice(df, p("slices"), keys)
    out = tables.replace_slice(df.where("v = 2").withColumn("v", F.lit(9)), p("slices"), keys)
    assert sorted(r["v"] for r in out.collect()) == [1, 9]
    text = spark.createDataFrame([("1", "5"), ("x", "5"), (None, "5"), ("2", "y")], "k string, v string")
    good, bad = tables.append_valid(text, p("good"), p("bad"), "k bigint, v int", ["k"])
    assert [(r["k"], r["v"]) for r in good.collect()] == [(1, 5)]
    assert sorted(r["failing_columns"] for r in bad.collect()) == [["k"], ["k"], ["v"]]


def test_catalog_tables(spark):
    df = spark.createDataFrame([("m", "1", 1), ("m", "2", 2)], "model_name string, model_version string, v int")
    keys = ["model_name", "model_version"]
    tables.replace_slice(df, "slices", keys)
    out = tables.replace_slice(df.where("v = 2").withColumn("v", F.lit(9)), "slices", keys)
    assert sorted(r["v"] for r in out.collect()) == [1, 9]
    assert tables.save_table(df, "kept").count() == 2
    assert tables.save_table(df.where("v = 1"), "kept").count() == 1
    tables.backup_if_absent({"kept": df})
    assert tables.backup_if_absent({"kept": df.where("v = 1")})["kept"].count() == 2
    assert tables.ensure_table(spark, "empty", "a int").columns == ["a"]


def test_contract_diff_and_top_k(spark):
    df = spark.createDataFrame([({"a": 1.0, "z": None},), ({"a": None, "b": 2.0},)], "f map<string,double>")
    missing, unknown = arrays.contract_diff(F.col("f"), ["b", "a"])
    got = [(r[0], r[1]) for r in df.select(missing, unknown).collect()]
    assert got == [(["b"], ["z"]), ([], [])]
    items = F.expr("array(named_struct('n','a','v',1.0D), named_struct('n','b','v',-3.0D), named_struct('n','c','v',1.0D))")
    top = spark.range(1).select(arrays.top_k_array(items, "v", 2).alias("t")).first()["t"]
    assert [x["n"] for x in top] == ["b", "a"]


def test_require_pass(spark):
    report = spark.createDataFrame([("a", True), ("b", False)], "check_name string, passes boolean")
    assert checks.require_pass(report.where("passes")).count() == 1
    with pytest.raises(checks.CheckFailed, match="b"):
        checks.require_pass(report)


def test_split_is_exact_and_disjoint(spark):
    df = spark.range(1003).selectExpr("id", "cast(id % 3 = 0 as int) as y")
    counts = {
        (r["y"], r["split"]): r["n"]
        for r in ranking.stratified_split(df, "y", "id").groupBy("y", "split").agg(F.count("*").alias("n")).collect()
    }
    for y, n in ((1, 335), (0, 668)):
        test, upto = ranking.split_cuts(n, 0.2, 0.2)
        assert counts[y, "test"] == test and counts[y, "validation"] == upto - test
        assert counts[y, "train"] == n - upto


def test_medians(spark):
    rnd = random.Random(3)
    data = [(rnd.random(), None if i % 3 else float(i % 7), None) for i in range(1001)]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(4)
    got = ranking.medians(df, ["a", "b", "c"])
    assert got["a"] == statistics.median(d[0] for d in data)
    assert got["b"] == statistics.median(d[1] for d in data if d[1] is not None)
    assert got["c"] is None and train.fit_medians(df, ["c"]) == {"c": 0.0}


def test_rows_of_array(spark):
    kind = "_pos int, a array<struct<_pos_:int,x:string>>"
    df = spark.createDataFrame([(1, [(5, "p"), (6, None)]), (2, []), (3, None), (4, [(None, None)])], kind)
    got = arrays.rows_of_array(df, "a", "_pos")
    assert got.columns == ["_pos", "_pos_", "x"]
    assert sorted(tuple(r) for r in got.collect() if r[1]) == [(1, 5, "p"), (1, 6, None)]
    assert [tuple(r) for r in got.collect() if not r[1]] == [(4, None, None)]


def test_metrics_without_rows_or_of_one_class(spark):
    none = metrics.evaluate(spark.createDataFrame([(None, 1), (0.5, None)], "s double, y int"), "s", "y", 0.4).first()
    assert none["brier_score"] is None and none["confusion_matrix_tp"] == 0 and none["accuracy"] == 0
    one = metrics.evaluate(spark.createDataFrame([(0.5, 1), (0.3, 1), (0.3, 1)], "s double, y int"), "s", "y", 0.4).first()
    assert (one["roc_auc"], one["pr_auc"], one["confusion_matrix_tp"], one["confusion_matrix_fn"]) == (0.0, 1.0, 1, 2)
    assert one["brier_score"] == pytest.approx((0.25 + 2 * 0.49) / 3)


def test_metrics_against_brute_force(spark):
    rnd = random.Random(4)
    data = [(round(rnd.random(), 2), rnd.randrange(2)) for _ in range(300)] + [(1.0, 1), (0.0, 0)]
    r = metrics.evaluate(spark.createDataFrame(data, "s double, y int"), "s", "y", 0.4).first()
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = sum(sum(p2 >= s for p2 in pos) / sum(x >= s for x, _ in data) for s in pos) / len(pos)
    assert abs(r["roc_auc"] - auc) < 1e-12 and abs(r["pr_auc"] - ap) < 1e-12
    assert r["confusion_matrix_tp"] == sum(s >= 0.4 for s in pos)


def test_bundle_checks():
    good = dict(model_name="m", model_version="1", classification_threshold=0.4, feature_names=["acuity"], medians={})
    train.check_metadata(good)
    for bad in ({**good, "model_name": "m_v2"}, {**good, "feature_names": ["x"]}, {k: v for k, v in good.items() if k != "medians"}):
        with pytest.raises(train.BundleError):
            train.check_metadata(bad)


def test_training_input_checks(spark):
    df = spark.createDataFrame([(1, 1.0)] * 4, "y int, a double")
    with pytest.raises(train.TrainingInputError, match="both classes"):
        train.check_training(df, "y", 0.2)
    with pytest.raises(train.TrainingInputError, match="missing"):
        train.load_matrix(df, ["b"], "y", [])
    with pytest.raises(train.TrainingInputError, match="excluded"):
        train.check_columns(spark.createDataFrame([("x",)], "race string"), ["race"])


def test_contract_entries():
    from staylens import schema as S

    assert list(S.FEATURE_SPECS) == list(S.MODEL_FEATURES) and len(S.FEATURE_SPECS) == 67
    for name, (category, kind, text, source) in S.FEATURE_SPECS.items():
        assert category in S.FEATURE_GROUPS and kind in ("binary", "numeric") and text.endswith(".") and source, name
    assert S.FEATURE_SPECS["triage_sbp"][2] == "Initial triage systolic blood pressure."
    assert S.FEATURE_SPECS["triage_dbp"][2] == "Initial triage diastolic blood pressure."


def test_replace_slice_keeps_all_other_slices(spark, tmp_path):
    from staylens.sources import tables

    schema = "model_name string, model_version string, stay_id int, score double"
    keys = ["model_name", "model_version"]
    one = lambda version, *ids: spark.createDataFrame([("m", version, i, i / 10) for i in ids], schema)
    versions = lambda df: sorted((r["model_version"], r["stay_id"]) for r in df.collect())
    spark.sql("CREATE DATABASE IF NOT EXISTS slices")
    for name in (f"{tmp_path}/predictions", "slices.predictions"):
        tables.ensure_table(spark, name, schema, keys)
        tables.replace_slice(one("007", 1, 2), name, keys)
        tables.replace_slice(one("2024", 3), name, keys)
        out = tables.replace_slice(one("007", 4), name, keys)
        assert versions(out) == [("007", 4), ("2024", 3)]
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for name in (f"{tmp_path}/old", "slices.old"):  # made without partitions, by an earlier release
            tables.save_table(one("v0", 1, 2, 3).drop("score"), name)
            tables.replace_slice(one("v1", 5), name, keys)
            tables.replace_slice(one("v2", 6), name, keys)
            out = tables.replace_slice(one("v0", 9), name, keys)
            assert versions(out) == [("v0", 9), ("v1", 5), ("v2", 6)]
            assert "score" in out.columns
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        spark.sql("DROP DATABASE slices CASCADE")


def test_broken_backup_is_made_anew(spark, tmp_path):
    import os

    from staylens.sources import tables

    df = spark.range(3)
    tables.backup_if_absent({"t": df}, str(tmp_path))
    assert tables.backup_if_absent({"t": spark.range(9)}, str(tmp_path))["t"].count() == 3
    os.remove(tmp_path / "t_raw_backup" / "_SUCCESS")
    assert tables.backup_if_absent({"t": spark.range(9)}, str(tmp_path))["t"].count() == 9


def test_failed_checks_are_all_named(spark):
    import pytest

    from staylens.operators import checks

    report = spark.createDataFrame([(f"c{i}", False) for i in range(45)], "check_name string, passes boolean")
    with pytest.raises(checks.CheckFailed) as error:
        checks.require_pass(report)
    assert all(f"'c{i}'" in str(error.value) for i in range(45))


def test_a_bad_tree_does_not_end_the_boosting():
    from staylens.plans import train

    assert train.best_iteration([0.9, 0.8, 0.85, 0.86, 0.7, 0.71], 3) == 5
    assert train.best_iteration([0.9, 0.8, 0.85, 0.86, 0.87, 0.7], 3) == 2
    assert train.best_iteration([0.5], 50) == 1 and train.best_iteration([0.5, 0.4, 0.3], 50) == 3


def test_boosting_keeps_the_best_trees_and_serves_as_it_trains(spark):
    import random

    from staylens.plans import train

    rng = random.Random(4)
    rows = [(i, rng.random(), rng.random()) for i in range(900)]
    rows = [(i, a, b, int(a + rng.gauss(0, 0.25) > 0.5)) for i, a, b in rows]
    store = spark.createDataFrame(rows, "stay_id bigint, f1 double, f2 double, risk_target int")
    result = train.train(store, "m", "v", train.Params(trees=25, patience=5, learning_rate=0.3), features=["f1", "f2"])
    facts = result.bundle.metadata
    assert facts["best_iteration"] == result.bundle.model.getNumTrees and 1 <= facts["best_iteration"] <= 25
    assert facts["train_rows"] + facts["validation_rows"] + facts["test_rows"] == 900 and facts["feature_count"] == 2
    odd = spark.createDataFrame([(1, None, 0.5), (2, float("nan"), 0.5), (3, float("inf"), 0.5)], "stay_id bigint, f1 double, f2 double")
    assert len({r["score"] for r in train.predict(result.bundle, odd, "score").collect()}) == 1


def test_registered_training_uses_the_default_trees(monkeypatch):
    from catalog import bind, modelling, storage
    from staylens.plans import pipeline, train

    seen = {}
    monkeypatch.setattr(storage, "work_dir", lambda spark, name: "unused")
    monkeypatch.setattr(bind, "raw_tables", lambda spark, sf: {})
    monkeypatch.setattr(bind, "once", lambda spark, sf, name, build: build())
    monkeypatch.setattr(pipeline, "run_pipeline", lambda *a, **options: seen.update(options))
    monkeypatch.setattr(storage.tables, "load_table", lambda *a: (_ for _ in ()).throw(LookupError))
    with pytest.raises(LookupError):
        storage.q_stage_runner(None, "unused")
    assert seen["params"] == modelling.PARAMS == train.Params() and train.Params().trees == 300
