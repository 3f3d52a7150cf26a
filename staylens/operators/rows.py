"""Row-level operators: filters, keep-one rules, joins, small reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import numeric, text


# --- columns over a whole frame ---------------------------------------------

def clean_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: text.clean_text(F.col(c)) for c in cols})


def guard_ranges(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    return df.withColumns(
        {c: numeric.range_guard(F.col(c), *bounds) for c, bounds in ranges.items()}
    )


def add_missing_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_missing": F.col(c).isNull() for c in cols})


def one_hot(df: DataFrame, col: str, values: dict[str, str]) -> DataFrame:
    """``values`` maps an output column to the value it marks."""
    return df.withColumns({out: numeric.flag(F.col(col) == v) for out, v in values.items()})


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.fillna(0, subset=cols)


def held_together(df: DataFrame) -> DataFrame:
    """The same rows, for several passes in one statement. Each pass asks for columns and
    rows of its own, which Spark would push below the shuffles and do once per pass. The
    test holds for every row; it keeps the columns together and later filters above,
    so that the shuffles below are the same and their files serve all passes."""
    return df.where(F.xxhash64(*df.columns, F.monotonically_increasing_id()) <= F.lit(2**63 - 1))


# --- filters ----------------------------------------------------------------

def require_not_null(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def require_any(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=cols)


# --- one row per key --------------------------------------------------------

def _keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    # row_number <= 1 is reduced to one row per key inside every map task
    # before the shuffle (WindowGroupLimit), so a hot key stays small.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_best(df: DataFrame, key: str, cols: list[str], time: str) -> DataFrame:
    """Most filled row per key, then the latest, then by all values."""
    score = numeric.completeness(*[F.col(c) for c in cols])
    rest = [F.col(c).desc_nulls_last() for c in cols if c not in (key, time)]
    return _keep_first(df, [key], [score.desc(), F.col(time).desc_nulls_last(), *rest])


def keep_earliest(df: DataFrame, keys: list[str], time: str, tiebreak: str) -> DataFrame:
    return _keep_first(df, keys, [F.col(time).asc_nulls_last(), F.col(tiebreak).asc_nulls_last()])


def keep_latest(df: DataFrame, keys: list[str], time: str, tiebreak: str) -> DataFrame:
    """Latest per key. A missing time ranks as the latest, as in a descending
    sort that puts NULL first."""
    return _keep_first(df, keys, [F.col(time).desc_nulls_first(), F.col(tiebreak).desc_nulls_first()])


def dedupe(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """One row per business key with its earliest time; NULLs compare equal.

    All kept columns are keys or the time, so the first row of each group is
    fully given by ``min(time)``: a hash aggregate with map-side combine.
    """
    return df.groupBy(*keys).agg(F.min(time).alias(time))


# --- joins ------------------------------------------------------------------

def keep_children(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_semi")


def star_join(spine: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    return reduce(lambda left, part: left.join(part, key, "left"), parts, spine)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def pair_reports(
    before: DataFrame, after: DataFrame, keys: list[str], value: str, prefix: str = "cleaned_"
) -> DataFrame:
    """Before and after value per key; ``prefix`` is removed from the first key
    of the later report."""
    table, *rest = keys
    right = after.select(
        F.regexp_replace(table, f"^{prefix}", "").alias(table), *rest, F.col(value).alias("after_value")
    )
    left = before.select(*keys, F.col(value).alias("before_value"))
    return left.join(right, keys, "left")


def compare_counts(a: dict[str, DataFrame], b: dict[str, DataFrame]) -> DataFrame:
    """Row counts of same-named tables, side by side."""

    def counts(tables: dict[str, DataFrame], out: str) -> DataFrame:
        return union_all(
            [df.agg(F.count("*").alias(out)).select(F.lit(t).alias("table_name"), out) for t, df in tables.items()]
        )

    return counts(a, "left_rows").join(counts(b, "right_rows"), "table_name")


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row."""
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), dfs)


# --- small reports ----------------------------------------------------------

def inline_rows(one_row: DataFrame, entries: Column) -> DataFrame:
    """One output row per struct of the array ``entries``."""
    return one_row.select(entries.alias("_rows")).select(F.inline("_rows"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("row_count"))


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every value of each column, as (column_name, value_text)."""
    cast = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return cast.unpivot([], cols, "column_name", "value_text").distinct()


def duplicate_groups(df: DataFrame, keys: list[str], out: str = "duplicate_groups") -> DataFrame:
    return (
        df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").agg(F.count("*").alias(out))
    )


def row_digest(df: DataFrame, cols: list[str] | None = None) -> tuple[Column, Column]:
    """Two 64-bit hashes of a whole row, or of ``cols``. NULL has a mark of its own, so it
    is told from every value and from a shift of columns."""
    cells = [x for c in cols or df.columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*cells), F.xxhash64(F.lit("second"), *reversed(cells))


def excess_duplicates(
    df: DataFrame, keys: list[str] | None = None, out: str = "duplicate_count"
) -> DataFrame:
    """Rows beyond the first of every group; NULLs group together.

    Without ``keys``, whole rows are grouped by ``row_digest``, so that 16 bytes and a
    count travel per row. Two different rows count as equal with a chance of 2^-128.
    """
    if not keys:
        high, low = row_digest(df)
        df, keys = df.select(high.alias("_high"), low.alias("_low")), ["_high", "_low"]
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return grouped.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(out))


def key_marks(df: DataFrame, keys: list[str]) -> dict[str, Column]:
    """What stands for a key of several columns: the first, by which rows may be dealt
    already, and the digest of all."""
    first, *more = keys
    marks = zip(("_key_high", "_key_low"), row_digest(df, keys)) if more else ()
    return {first: F.col(first), **dict(marks)}


def counted_keys(df: DataFrame, keys: list[str], counts: dict[str, Column] | None = None) -> DataFrame:
    """One row per key, with its first column: ``_n`` rows, ``_exact`` of them repeats of a
    whole row, and the rows for which each condition of ``counts`` holds. NULLs group
    together; digests travel, not values (see ``excess_duplicates``)."""
    marks = key_marks(df, keys)
    high, low = row_digest(df)
    marked = df.select(
        *[c.alias(name) for name, c in marks.items()], high.alias("_high"), low.alias("_low"),
        *[cond.alias(name) for name, cond in (counts or {}).items()],
    )
    more = [F.count_if(F.col(name)).alias(name) for name in counts or {}]
    whole = marked.groupBy(*marks, "_high", "_low").agg(F.count("*").alias("_n"), *more)
    return whole.groupBy(*marks).agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_exact"), *[F.sum(name).alias(name) for name in counts or {}]
    )


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key and of each whole row, and keys of several rows, from one pass."""
    n, none = F.col("_n"), F.lit(0)
    return counted_keys(df, keys).agg(
        F.coalesce(F.sum(n - 1), none).alias("business_duplicates"), F.coalesce(F.sum("_exact"), none).alias("exact_duplicates"),
        F.count_if(n > 1).alias("duplicate_groups"),
    )


def summary_row(df: DataFrame, counts: dict[str, Column], total: str) -> DataFrame:
    return df.agg(
        F.count("*").alias(total), *[F.count_if(cond).alias(name) for name, cond in counts.items()]
    )


def order_report(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.orderBy(*order)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def sample_head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def columns_of(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")
