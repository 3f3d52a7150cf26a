"""Queries that write tables or files and return what is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bind
from catalog.cleaning import cleaned
from catalog.oracle import with_ctes
from catalog.shape import plain
from staylens import schema as S
from staylens.operators import checks
from staylens.plans import pipeline, train
from staylens.session import work_dir
from staylens.sources import files, ledger, quoted, tables

K = "o_orderkey"

# One CSV line per order. The complaint of some holds bare commas (too many
# fields), of others quotes, and some lines end early.
_LINE = f"""concat_ws(',', CAST(o_custkey AS STRING), CAST({K} AS STRING),
  CASE o_orderstatus
    WHEN 'F' THEN concat('pain, ', o_orderpriority, ',,late, ', CAST({K} % 7 AS STRING))
    WHEN 'P' THEN concat('"', o_orderpriority, ', ""quoted"" text"')
    ELSE o_orderpriority END)"""


def q_csv_repair(spark, sf):
    lines = bind.run_sql(
        spark, sf,
        f"SELECT CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_custkey AS STRING) ELSE {_LINE} END AS value FROM {{orders}}",
    )
    path = work_dir(spark, "ragged")
    # The header is on the first line of every file, as in a set of files.
    lines.sortWithinPartitions("value").select(
        F.monotonically_increasing_id().alias("_i"), "value"
    ).select(
        F.when(F.col("_i") % (1 << 33) == 0, F.concat(F.lit("subject_id,stay_id,chiefcomplaint\n"), "value"))
        .otherwise(F.col("value")).alias("value")
    ).write.text(path)
    return files.read_ragged_csv(spark, path, ["subject_id", "stay_id", "chiefcomplaint"])


O_CSV_REPAIR = f"""
SELECT CAST(o_custkey AS VARCHAR) AS subject_id, CASE WHEN NOT cut THEN CAST({K} AS VARCHAR) END AS stay_id,
  CASE WHEN NOT cut THEN CASE o_orderstatus WHEN 'F' THEN 'pain, ' || o_orderpriority || ',,late, ' || ({K} % 7)
    WHEN 'P' THEN o_orderpriority || ', "quoted" text' ELSE o_orderpriority END END AS chiefcomplaint
FROM (SELECT *, o_orderpriority = '5-LOW' AS cut FROM orders)
"""

_NOTE = """CASE o_orderstatus WHEN 'F' THEN concat('"first', chr(10), 'second, ""', o_orderpriority, '""', chr(10), '"') ELSE o_orderpriority END"""


def q_csv_quoted(spark, sf):
    """Quoted texts with line breaks, read by byte ranges."""
    path = work_dir(spark, "quoted")
    lines = bind.run_sql(spark, sf, f"SELECT concat_ws(',', CAST(o_custkey AS STRING), CAST({K} AS STRING), {_NOTE}) AS value FROM {{orders}}")
    head = F.lit("subject_id,stay_id,chiefcomplaint\n")
    numbered = lines.select(F.monotonically_increasing_id().alias("_i"), "value")
    numbered.select(F.when(F.col("_i") % (1 << 33) == 0, F.concat(head, "value")).otherwise(F.col("value")).alias("value")).write.text(path)
    return quoted.read_quoted_csv(spark, path, ["subject_id", "stay_id", "chiefcomplaint"])


O_CSV_QUOTED = f"""
SELECT CAST(o_custkey AS VARCHAR) AS subject_id, CAST({K} AS VARCHAR) AS stay_id,
  CASE o_orderstatus WHEN 'F' THEN 'first' || chr(10) || 'second, "' || o_orderpriority || '"' || chr(10) ELSE o_orderpriority END AS chiefcomplaint
FROM orders
"""

_TEXTS = f"""SELECT CAST({K} AS STRING) AS stay_id, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS subject_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN NULL ELSE CAST({K} % 200 AS STRING) END AS heartrate
FROM {{orders}}"""


def q_append_valid(spark, sf):
    folder = work_dir(spark, "append")
    df = bind.run_sql(spark, sf, _TEXTS)
    good, bad = tables.append_valid(
        df, f"{folder}/triage", f"{folder}/rejects",
        "stay_id bigint, subject_id bigint, heartrate decimal(6,2)", ["stay_id", "subject_id"],
    )
    kept = plain(good).withColumn("failing_columns", F.lit(None).cast("string"))
    lost = plain(bad).select(
        F.col("stay_id").cast("bigint").alias("stay_id"), F.lit(None).cast("bigint").alias("subject_id"),
        F.lit(None).cast("double").alias("heartrate"), "failing_columns",
    )
    return kept.unionByName(lost)


O_APPEND_VALID = f"""
SELECT stay_id, CASE WHEN f IS NULL THEN TRY_CAST(subject_id AS BIGINT) END AS subject_id,
  CASE WHEN f IS NULL THEN CAST(TRY_CAST(heartrate AS DECIMAL(6,2)) AS DOUBLE) END AS heartrate, f AS failing_columns
FROM (SELECT CAST(stay_id AS BIGINT) AS stay_id, subject_id, heartrate,
        nullif(concat_ws('|', CASE WHEN subject_id = 'n/a' THEN 'subject_id' END, CASE WHEN heartrate = 'high' THEN 'heartrate' END), '') AS f
      FROM ({_TEXTS.replace('{orders}', 'orders')}))
"""


# Offsets that come from the keys: eight batches, whatever the size.
_OFFSETS = "CAST(o_orderkey % 8000 AS BIGINT)"


def q_append_batches(spark, sf):
    """The first half is loaded, then all of it is offered again: rows, rejects and ledger."""
    root = work_dir(spark, "ledger")
    df = bind.run_sql(spark, sf, _TEXTS).withColumn("at", F.expr(_OFFSETS.replace("o_orderkey", "CAST(stay_id AS BIGINT)")))
    declared = ("at", 1000, "stay_id bigint, subject_id bigint, heartrate decimal(6,2)", ["stay_id", "subject_id"])
    ledger.append_in_batches(df.where("at < 4000"), root, *declared)
    ledger.append_in_batches(df, root, *declared)
    good, bad, lines = ledger.load(spark, root), ledger.load(spark, root, "rejects"), ledger.ledger(spark, root)
    none = F.lit(None).cast("bigint")
    kept = plain(good).select(F.lit("row").alias("kind"), "stay_id", "heartrate", none.alias("first"), none.alias("loaded"), none.alias("rejected"))
    lost = bad.select(F.lit("reject").alias("kind"), F.col("stay_id").cast("bigint").alias("stay_id"), F.lit(None).cast("double").alias("heartrate"), none.alias("first"), none.alias("loaded"), none.alias("rejected"))
    noted = lines.select(F.lit("batch").alias("kind"), F.col("batch").alias("stay_id"), F.lit(None).cast("double").alias("heartrate"), "first", "loaded", "rejected")
    return kept.unionByName(lost).unionByName(noted)


O_APPEND_BATCHES = f"""
WITH t AS (SELECT CAST(stay_id AS BIGINT) AS stay_id, CAST(TRY_CAST(heartrate AS DECIMAL(6,2)) AS DOUBLE) AS heartrate,
    {_OFFSETS.replace("o_orderkey", "CAST(stay_id AS BIGINT)")} // 1000 AS batch, coalesce(subject_id = 'n/a', false) OR coalesce(heartrate = 'high', false) AS bad
  FROM ({_TEXTS.replace('{orders}', 'orders')}))
SELECT CASE WHEN bad THEN 'reject' ELSE 'row' END AS kind, stay_id, CASE WHEN NOT bad THEN heartrate END AS heartrate,
  CAST(NULL AS BIGINT) AS first, CAST(NULL AS BIGINT) AS loaded, CAST(NULL AS BIGINT) AS rejected FROM t
UNION ALL
SELECT 'batch', batch, NULL, batch * 1000, COUNT(*) FILTER (WHERE NOT bad), COUNT(*) FILTER (WHERE bad) FROM t GROUP BY batch
"""


def q_replace_in_one_commit(spark, sf):
    """As replace_slice, over commits: the other slice's files stay as they are."""
    root = work_dir(spark, "commits")
    cols = ["stay_id", "model_name", "model_version", "risk_score"]
    first = bind.raw(spark, sf, "risk_predictions").select(*cols)
    ledger.replace_slice(first, root, ["model_name", "model_version"])
    renewed = first.where("model_version = 'v2'").withColumn("risk_score", F.lit(0.5).cast("decimal(6,5)"))
    ledger.replace_slice(renewed, root, ["model_name", "model_version"])
    return plain(ledger.load(spark, root))


def q_replace_slice(spark, sf):
    """Both model versions are stored; then one is scored again."""
    path = work_dir(spark, "slices")
    cols = ["stay_id", "model_name", "model_version", "risk_score"]
    first = bind.raw(spark, sf, "risk_predictions").select(*cols)
    tables.replace_slice(first, path, ["model_name", "model_version"])
    renewed = first.where("model_version = 'v2'").withColumn("risk_score", F.lit(0.5).cast("decimal(6,5)"))
    return plain(tables.replace_slice(renewed, path, ["model_name", "model_version"]))


O_REPLACE_SLICE = with_ctes("""
SELECT stay_id, model_name, model_version, CASE WHEN model_version = 'v2' THEN 0.5::DOUBLE ELSE CAST(risk_score AS DOUBLE) END AS risk_score
FROM raw_risk_predictions
""")


def q_backup_if_absent(spark, sf):
    """A second backup of a changed table leaves the first one as it is."""
    folder = work_dir(spark, "backup")
    raw = bind.raw(spark, sf, "triage").select("triage_id", "stay_id", "acuity")
    tables.backup_if_absent({"triage": raw}, folder)
    return tables.backup_if_absent({"triage": raw.where("acuity = 1")}, folder)["triage"]


O_BACKUP = with_ctes("SELECT triage_id, stay_id, acuity FROM raw_triage")


def _grown(spark, sf):
    """Raw tables after their backup was taken: some have lost or gained rows."""
    now = dict(bind.raw_tables(spark, sf))
    now["triage"] = now["triage"].where("acuity IS NOT NULL")
    now["vital_sign"] = now["vital_sign"].unionByName(now["vital_sign"].where("pain IS NULL"))
    return now


def q_backup_report(spark, sf):
    """Row counts of raw tables beside their backups, which a second backup leaves as they are."""
    folder, now = work_dir(spark, "backups"), _grown(spark, sf)
    tables.backup_if_absent(bind.raw_tables(spark, sf), folder)
    return checks.backup_report(now, tables.backup_if_absent(now, folder), "run")


_NOW = {
    "triage": "(SELECT COUNT(acuity) FROM raw_triage)",
    "vital_sign": "(SELECT COUNT(*) + COUNT(*) FILTER (WHERE pain IS NULL) FROM raw_vital_sign)",
}
O_BACKUP_REPORT = with_ctes(" UNION ALL ".join(
    f"SELECT 'run' AS run_id, '{t}' AS raw_table, '{t}_raw_backup' AS backup_table, a AS raw_row_count, b AS backup_row_count, a = b AS counts_match "
    f"FROM (SELECT {_NOW.get(t, f'(SELECT COUNT(*) FROM raw_{t})')} AS a, (SELECT COUNT(*) FROM raw_{t}) AS b)"
    for t in S.RAW_TABLES
))


def q_evolve_schema(spark, sf):
    """A table without the severity columns gets them as NULL, then new rows."""
    path = work_dir(spark, "evolve")
    tables.ensure_table(spark, path, "stay_id bigint, risk_score double")
    old = bind.raw(spark, sf, "risk_predictions").select("stay_id", F.col("risk_score").cast("double"))
    old.write.mode("append").parquet(path)
    return tables.add_missing_columns(
        tables.load_table(spark, path), "stay_id bigint, severity_index int, severity_label string"
    )


O_EVOLVE = with_ctes("""
SELECT stay_id, CAST(risk_score AS DOUBLE) AS risk_score, CAST(NULL AS INT) AS severity_index, CAST(NULL AS VARCHAR) AS severity_label
FROM raw_risk_predictions
""")


def q_save_table(spark, sf):
    """Replacing a table twice leaves the last rows only."""
    path = work_dir(spark, "save")
    stays = cleaned(spark, sf, "ed_stays").select("stay_id", "gender")
    tables.save_table(stays.withColumn("gender", F.lit("old")), path)
    return tables.save_table(stays, path)


O_SAVE_TABLE = with_ctes("SELECT stay_id, gender FROM cleaned_ed_stays")


def q_read_requests(spark, sf):
    """Requests written as JSON lines and read with the request schema."""
    path = work_dir(spark, "requests")
    bind.run_sql(spark, sf, f"""SELECT CAST({K} AS STRING) AS request_id,
      named_struct('patient_id', CAST(o_custkey AS STRING), 'source_system', 'orders') AS subject,
      map('acuity', CAST({K} % 5 + 1 AS DOUBLE), 'hr_min', CAST(o_custkey AS DOUBLE) / 4) AS features FROM {{orders}}""").write.json(path)
    r = files.read_requests(spark, path)
    return r.select(
        "request_id", F.col("subject.patient_id").alias("patient_id"), F.col("subject.stay_id").alias("stay_id"),
        F.col("features")["acuity"].alias("acuity"), F.col("features")["hr_min"].alias("hr_min"),
    )


O_READ_REQUESTS = f"""
SELECT CAST({K} AS VARCHAR) AS request_id, CAST(o_custkey AS VARCHAR) AS patient_id, CAST(NULL AS VARCHAR) AS stay_id,
  CAST({K} % 5 + 1 AS DOUBLE) AS acuity, CAST(o_custkey AS DOUBLE) / 4 AS hr_min FROM orders
"""


# One line per order; of every eight, four are requests.
_LINES = f"""SELECT {K}, CASE {K} % 8
    WHEN 0 THEN concat('{{{{"request_id": "', CAST({K} AS VARCHAR(30)), '", "features"')
    WHEN 1 THEN concat('{{{{"request_id": "', CAST({K} AS VARCHAR(30)), '", "features": {{{{"hr_min": 5, "acuity": "high"}}}}}}}}')
    WHEN 2 THEN concat('{{{{"request_id": "', CAST({K} AS VARCHAR(30)), '", "subject": "text", "features": [1, 2]}}}}')
    WHEN 3 THEN concat('{{{{"request_id": "', CAST({K} AS VARCHAR(30)), '", "subject": null}}}}')
    WHEN 4 THEN CAST({K} AS VARCHAR(30))
    ELSE concat('{{{{"request_id": "', CAST({K} AS VARCHAR(30)), '", "subject": {{{{"patient_id": ', CAST(o_custkey AS VARCHAR(30)), '}}}}, "features": {{{{"acuity": ',
      CAST({K} % 5 AS VARCHAR(30)), '.5, "hr_min": null}}}}}}}}') END AS value FROM {{orders}}"""


def q_request_errors(spark, sf):
    """Request lines, of which some are cut off, some no object and some of wrong types."""
    path = work_dir(spark, "lines")
    bind.run_sql(spark, sf, _LINES).select("value").write.text(path)
    good, bad = files.read_requests_checked(spark, path)
    none = F.lit(None).cast("string")
    kept = good.select(
        "request_id", F.col("subject.patient_id").alias("patient_id"), F.col("features")["acuity"].alias("acuity"),
        F.coalesce(F.size("features"), F.lit(-1)).alias("n_features"), none.alias("error_code"), none.alias("paths"), none.alias("record"),
    )
    lost = bad.select(
        "request_id", none.alias("patient_id"), F.lit(None).cast("double").alias("acuity"), F.lit(-1).alias("n_features"),
        "error_code", F.concat_ws("|", "paths").alias("paths"), "record",
    )
    return kept.unionByName(lost)


O_REQUEST_ERRORS = f"""
SELECT CASE WHEN {K} % 8 NOT IN (0, 4) THEN CAST({K} AS VARCHAR) END AS request_id,
  CASE WHEN {K} % 8 > 4 THEN CAST(o_custkey AS VARCHAR) END AS patient_id,
  CASE WHEN {K} % 8 > 4 THEN {K} % 5 + 0.5::DOUBLE END AS acuity,
  CAST(CASE WHEN {K} % 8 > 4 THEN 2 ELSE -1 END AS INT) AS n_features,
  CASE WHEN {K} % 8 IN (0, 4) THEN 'not_json' WHEN {K} % 8 IN (1, 2) THEN 'wrong_type' END AS error_code,
  CASE WHEN {K} % 8 IN (0, 4) THEN '' WHEN {K} % 8 = 1 THEN 'features.acuity' WHEN {K} % 8 = 2 THEN 'features|subject' END AS paths,
  CASE WHEN {K} % 8 IN (0, 1, 2, 4) THEN value END AS record
FROM ({_LINES.replace("{orders}", "orders").replace("{{", "{").replace("}}", "}").replace(f"SELECT {K},", f"SELECT {K}, o_custkey,")})
"""


def q_csv_round_trip(spark, sf):
    """A report written as CSV and read with its schema."""
    folder = work_dir(spark, "csv")
    df = bind.source(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("row_count"))
    path = files.write_report(df, folder, "run", "priorities")
    return files.read_csv(spark, path, "o_orderpriority string, row_count bigint")


O_CSV_ROUND_TRIP = "SELECT o_orderpriority, COUNT(*) AS row_count FROM orders GROUP BY 1"


def q_repair_vital_sign(spark, sf):
    from catalog.cleaning import _WILD

    df = bind.source(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", *[F.expr(e).alias(c) for c, e in _WILD.items()]
    ).distinct()
    return files.repair_vital_sign(df)


def _repair_sql() -> str:
    from catalog.cleaning import _WILD_SQL, _until

    z = ", ".join(f"nullif({c}, 0) AS {c}" for c in ("temperature", "heartrate", "resprate", "o2sat", "sbp", "dbp"))
    return f"""
SELECT l_partkey, l_suppkey, l_linenumber,
  CASE WHEN t BETWEEN 85 AND 110 THEN t END AS temperature, CASE WHEN heartrate BETWEEN 25 AND 250 THEN heartrate END AS heartrate,
  CASE WHEN resprate BETWEEN 5 AND 60 THEN resprate END AS resprate, CASE WHEN o2sat >= 50 THEN least(o2sat, 100) END AS o2sat,
  {_until('sbp')}, {_until('dbp')}
FROM (SELECT *, CASE WHEN temperature > 200 THEN temperature / 10 ELSE temperature END AS t
      FROM (SELECT l_partkey, l_suppkey, l_linenumber, {z} FROM ({_WILD_SQL})))
"""


_TRIAGE_TEXT = {
    "subject_id": "CAST(l_partkey AS VARCHAR(30))",
    "stay_id": "CASE WHEN l_linenumber = 6 THEN 'x' ELSE CAST(l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS VARCHAR(30)) END",
    "chiefcomplaint": "concat('\"pain', CAST(l_partkey AS VARCHAR(30)), '\"')",
    "pain": "CASE l_linenumber WHEN 1 THEN 'nan' WHEN 2 THEN 'None' WHEN 3 THEN '' ELSE CAST(l_partkey % 11 AS VARCHAR(30)) END",
    "acuity": "CASE WHEN l_linenumber = 4 THEN 'n/a' ELSE CAST(l_partkey % 5 + 1 AS VARCHAR(30)) END",
}


def q_repair_triage(spark, sf):
    """A triage file of text columns, with numbers out of scale, bad text and missing keys."""
    from catalog.cleaning import _WILD

    wild = bind.source(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", *[F.expr(e).alias(c) for c, e in _WILD.items()]
    ).distinct()
    raw = wild.select(
        *[F.expr(e).alias(c) for c, e in _TRIAGE_TEXT.items()],
        *[F.concat(F.lit(" "), F.col(c).cast("string")).alias(c) for c in _WILD],
    )
    return files.repair_triage(raw)


def _triage_sql() -> str:
    from catalog.cleaning import _WILD_SQL

    steps = {"temperature": "temperature", "heartrate": "heartrate", "resprate": "resprate", "o2sat": "o2sat", "sbp": "sbp", "dbp": "dbp"}
    steps["temperature"] = "CASE WHEN temperature > 200 THEN temperature / 10 ELSE temperature END"
    steps["o2sat"] = "CASE WHEN o2sat > 1000 THEN o2sat / 10 ELSE o2sat END"
    steps["sbp"] = "CASE WHEN sbp > 10000 THEN sbp / 10 / 10 WHEN sbp > 1000 THEN sbp / 10 ELSE sbp END"
    steps["dbp"] = (
        "CASE WHEN dbp > 10000 AND dbp / 1000 > 200 THEN dbp / 1000 / 10 WHEN dbp > 10000 THEN dbp / 1000 "
        "WHEN dbp > 1000 AND dbp / 100 > 200 THEN dbp / 100 / 10 WHEN dbp > 1000 THEN dbp / 100 "
        "WHEN dbp > 200 THEN dbp / 10 ELSE dbp END"
    )
    text = ", ".join(f"{e} AS {c}" for c, e in _TRIAGE_TEXT.items())
    scaled = ", ".join(f"{e} AS {c}" for c, e in steps.items())
    guard = lambda c, lo, hi: f"CASE WHEN {c} >= {lo}{f' AND {c} <= {hi}' if hi else ''} THEN {c} END"
    clip = lambda c, e, lo, hi: f"CASE WHEN {e} IS NOT NULL THEN greatest(least({e}, {hi}), {lo}) END AS {c}"
    values = [
        clip("temperature", guard("temperature", 85, 110), 85, 110), clip("heartrate", guard("heartrate", 25, 250), 25, 250),
        clip("resprate", guard("resprate", 5, 60), 5, 60), clip("o2sat", guard("o2sat", 50, None), 50, 100),
        clip("sbp", "sbp", 60, 300), clip("dbp", "dbp", 30, 200),
    ]
    return f"""
SELECT CAST(subject_id AS BIGINT) AS subject_id, TRY_CAST(stay_id AS BIGINT) AS stay_id, replace(chiefcomplaint, '"', '') AS chiefcomplaint,
  CASE WHEN pain NOT IN ('', 'nan', 'None') THEN pain END AS pain, TRY_CAST(acuity AS DOUBLE) AS acuity, {", ".join(values)}
FROM (SELECT {text}, {scaled} FROM ({_WILD_SQL})) WHERE TRY_CAST(stay_id AS BIGINT) IS NOT NULL
"""


def q_stage_runner(spark, sf):
    """All stages over stored raw tables; the predictions they leave behind."""

    def build():
        root = work_dir(spark, "pipeline")
        for t, df in bind.raw_tables(spark, sf).items():  # landed once, where the runner reads them
            tables.save_table(df, f"{root}/{t}")
        layout = pipeline.Layout(root, f"{root}/reports", "run")
        pipeline.run_pipeline(
            spark, layout, model_version="stage", params=train.Params(), stage="full"
        )
        return tables.load_table(spark, layout.table("risk_predictions"))

    return plain(bind.once(spark, sf, "stage_runner", build).drop("created_at"))


QUERIES = {
    "csv_repair": q_csv_repair,
    "csv_quoted": q_csv_quoted,
    "append_valid": q_append_valid,
    "replace_slice": q_replace_slice,
    "append_batches": q_append_batches,
    "replace_in_one_commit": q_replace_in_one_commit,
    "backup_if_absent": q_backup_if_absent,
    "backup_report": q_backup_report,
    "evolve_schema": q_evolve_schema,
    "save_table": q_save_table,
    "read_requests": q_read_requests,
    "request_errors": q_request_errors,
    "csv_round_trip": q_csv_round_trip,
    "repair_vital_sign": q_repair_vital_sign,
    "repair_triage": q_repair_triage,
    "stage_runner": q_stage_runner,
}
ORACLES = {
    "repair_triage": _triage_sql(),
    "csv_repair": O_CSV_REPAIR,
    "csv_quoted": O_CSV_QUOTED,
    "append_valid": O_APPEND_VALID,
    "replace_slice": O_REPLACE_SLICE,
    "append_batches": O_APPEND_BATCHES,
    "replace_in_one_commit": O_REPLACE_SLICE,
    "backup_if_absent": O_BACKUP,
    "backup_report": O_BACKUP_REPORT,
    "evolve_schema": O_EVOLVE,
    "save_table": O_SAVE_TABLE,
    "read_requests": O_READ_REQUESTS,
    "request_errors": O_REQUEST_ERRORS,
    "csv_round_trip": O_CSV_ROUND_TRIP,
    "repair_vital_sign": _repair_sql(),
}
