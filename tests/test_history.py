"""History totals against a brute-force loop."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from staylens.operators import history

SCHEMA = (
    "stay_id bigint, subject_id bigint, hadm_id bigint, intime timestamp_ntz, disposition string"
)


def year_before(t):
    try:
        return t.replace(year=t.year - 1)
    except ValueError:  # 29 February
        return t.replace(year=t.year - 1, day=28)


def brute(stays, codes):
    out = {}
    for s in stays:
        prior = [p for p in stays if p[1] == s[1] and p[3] < s[3]]
        admitted = [p for p in prior if p[2] is not None or any(w in (p[4] or "").upper() for w in ("ADMIT", "TRANSFER"))]
        seen = {c for p in prior for c in codes.get(p[0], []) if c}
        out[s[0]] = (
            len(prior),
            sum(p[3] >= s[3] - timedelta(days=30) for p in prior),
            sum(p[3] >= s[3] - timedelta(days=90) for p in prior),
            len(admitted),
            sum(p[3] >= year_before(s[3]) for p in admitted),
            sum(any(w in (p[4] or "").upper() for w in ("ICU", "DECEASED", "EXPIRED", "DIED")) for p in prior),
            len(seen),
            sum(c[0] == "I" for p in prior for c in codes.get(p[0], []) if c),
        )
    return out


def check(spark, stays, codes):
    df = spark.createDataFrame(stays, SCHEMA)
    dx = spark.createDataFrame(
        [(s, c) for s, cs in codes.items() for c in cs], "stay_id bigint, icd_code string"
    )
    got = history.visit_history(df).join(history.diagnosis_history(df, dx), "stay_id").collect()
    want = brute(stays, codes)
    assert len(got) == len(want)
    for r in got:
        assert (
            r["prior_ed_visit_count"], r["prior_ed_visit_count_30d"], r["prior_ed_visit_count_90d"],
            r["prior_admission_count"], r["prior_admission_count_1y"], r["prior_icu_or_death_count"],
            r["prior_distinct_diagnosis_count"], r["prior_cardiovascular_dx_count"],
        ) == want[r["stay_id"]], r["stay_id"]


def test_edges(spark):
    t = datetime(2024, 2, 29, 12)
    us = timedelta(microseconds=1)
    times = [
        t, t, t - timedelta(days=30), t - timedelta(days=30) - us, t - timedelta(days=30) + us,
        t - timedelta(days=90), t - timedelta(days=90) - us, datetime(2023, 2, 28, 12),
        datetime(2023, 2, 28, 12) - us, t - us, t + us, datetime(1969, 12, 31, 23), datetime(1970, 1, 1),
    ]
    stays = [(i, 1, i if i % 2 else None, x, "ICU" if i % 3 else None) for i, x in enumerate(times)]
    check(spark, stays, {0: ["I10"], 2: ["I10", "J1"], 9: [None, "I11"]})


def test_random_with_a_hot_patient(spark):
    rnd = random.Random(5)
    places = ["Home", "Admitted", "transfer", "ICU", "Expired", None]
    stays, codes = [], {}
    for i in range(400):
        subject = 1 if rnd.random() < 0.4 else rnd.randrange(2, 30)
        t = datetime(2022, 1, 1) + timedelta(hours=rnd.randrange(0, 24 * 700))
        stays.append((i, subject, i if rnd.random() < 0.2 else None, t, rnd.choice(places)))
        codes[i] = rnd.sample(["I10", "I11", "J44", "E11", None], rnd.randrange(0, 4))
    check(spark, stays, codes)


def test_gap_and_first_visit(spark):
    stays = [(1, 1, None, datetime(2024, 1, 1), None), (2, 1, None, datetime(2024, 1, 2, 12), None)]
    rows = {r["stay_id"]: r for r in history.visit_history(spark.createDataFrame(stays, SCHEMA)).collect()}
    assert rows[1]["time_since_last_ed_visit_days"] is None
    assert float(rows[2]["time_since_last_ed_visit_days"]) == 1.5


def test_predictions(spark):
    stays = [(1, 1, None, datetime(2024, 1, 10), None), (2, 1, None, datetime(2024, 2, 10), None)]
    preds = [
        (1, 1, 1, "0.9", "HIGH", datetime(2024, 1, 11)), (2, 1, 1, "0.2", "LOW", datetime(2024, 1, 12)),
        (3, 5, 1, "0.8", "HIGH", datetime(2024, 2, 1)), (4, 6, 1, "0.7", "HIGH", None),
        (5, 7, 1, "0.7", "HIGH", datetime(2024, 2, 10)),
    ]
    p = spark.createDataFrame(
        preds, "risk_prediction_id bigint, stay_id bigint, subject_id bigint, s string, risk_label string, created_at timestamp_ntz"
    ).withColumn("risk_score", F.col("s").cast("decimal(6,5)"))
    rows = {
        r["stay_id"]: r for r in history.prediction_history(spark.createDataFrame(stays, SCHEMA), p).collect()
    }
    assert rows[1]["prior_high_risk_prediction_count"] == 0 and rows[1]["last_risk_score"] is None
    r = rows[2]
    assert r["prior_high_risk_prediction_count"] == 1
    assert [float(r[c]) for c in ("last_risk_score", "avg_prior_risk_score", "max_prior_risk_score")] == [0.8, 0.5, 0.8]


def test_rows_without_patient_or_time_stay(spark):
    t = datetime(2024, 5, 1)
    stays = [(1, 7, 5, t, "ADMITTED"), (2, 7, None, t + timedelta(days=1), None), (3, None, None, t, None), (4, 7, None, None, None)]
    got = {r["stay_id"]: r for r in history.visit_history(spark.createDataFrame(stays, SCHEMA)).collect()}
    assert got.keys() == {1, 2, 3, 4}
    assert [got[i]["prior_ed_visit_count"] for i in (1, 2, 3, 4)] == [0, 1, 0, 0]
