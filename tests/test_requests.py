"""Request lines that are none, and duplicates by row digests."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from staylens.operators import rows
from staylens.plans import score
from staylens.sources import files


def test_every_line_is_a_request_or_an_error(spark, tmp_path):
    lines = [
        '{"request_id": "a", "subject": {"patient_id": 7, "extra": 1}, "features": {"x": 1, "y": null}, "more": []}',
        '{"request_id": "b", "features": {}}',
        '{"request_id": 3}',
        "  ",
        "",
        "{",
        "null",
        "[1]",
        '{"request_id": "c", "features": {"x": "1", "z": true, "y": 2}}',
        '{"request_id": ["d"], "subject": [1], "features": "none"}',
        '{"request_id": "e", "features": {"a.b": [1], "ok": 1e3}}',
        '{"features": null, "subject": null}',
    ]
    (tmp_path / "in.json").write_text("\n".join(lines))
    good, bad = files.read_requests_checked(spark, str(tmp_path))
    kept = {r["request_id"]: r for r in good.collect()}
    assert kept.keys() == {"a", "b", "3", None}
    assert kept["a"]["subject"]["patient_id"] == "7" and kept["a"]["subject"]["stay_id"] is None
    assert kept["a"]["features"] == {"x": 1.0, "y": None} and kept["b"]["features"] == {} and kept["3"]["features"] is None
    lost = {r["record"]: (r["request_id"], r["error_code"], r["paths"]) for r in bad.collect()}
    assert lost == {
        "{": (None, files.NOT_JSON, []), "null": (None, files.NOT_JSON, []), "[1]": (None, files.NOT_JSON, []),
        lines[8]: ("c", files.WRONG_TYPE, ["features.x", "features.z"]),
        lines[9]: ('["d"]', files.WRONG_TYPE, ["features", "request_id", "subject"]),
        lines[10]: ("e", files.WRONG_TYPE, ["features.a.b"]),
    }
    told = {r["record"]: r["error"] for r in score.unreadable(bad, ["x"]).collect()}
    assert told[lines[8]]["message"] == "Wrong type at features.x, features.z." and told["{"]["error_code"] == "not_json"
    assert told["{"]["required_features"] == ["x"] and told["{"]["missing_features"] == []


def test_an_empty_folder_of_requests(spark, tmp_path):
    (tmp_path / "in.json").write_text("")
    good, bad = files.read_requests_checked(spark, str(tmp_path))
    assert good.count() == 0 and bad.count() == 0


def test_digests_count_what_whole_rows_count(spark):
    when = datetime(2020, 1, 1)
    data = [
        (1, "a", 1.0, when, Decimal("1.50")), (1, "a", 1.0, when, Decimal("1.50")), (1, None, 1.0, when, None), (1, None, 1.0, when, None),
        (None, "a", 1.0, when, None), (1, "a", None, when, None), (None, None, None, None, None), (None, None, None, None, None),
        (None, None, None, None, None), (1, "", 0.0, None, None), (1, "", -0.0, None, None), (1, "", float("nan"), None, None), (1, "", float("nan"), None, None),
    ]
    df = spark.createDataFrame(data, "k int, s string, x double, t timestamp, d decimal(6,2)")
    whole = df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1)).first()[0]
    assert rows.excess_duplicates(df).first()[0] == whole == 6
    shifted = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("", "a"), ("a", "")], "p string, q string")
    assert rows.excess_duplicates(shifted).first()[0] == 0
    assert rows.excess_duplicates(df.limit(0)).first()[0] == 0
