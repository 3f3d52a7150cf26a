"""Per-key summaries. All are plain partial/final aggregates, so a hot key is
combined inside every map task before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import numeric


def mean_min_max(measures: dict[str, str]) -> list[Column]:
    """``measures`` maps a decimal column to the prefix of its outputs."""
    out = []
    for col, prefix in measures.items():
        mean = numeric.exact_mean(F.sum(col), F.count(col))
        out += [
            numeric.to_decimal(mean, 8, 3).alias(f"{prefix}_mean"),
            F.min(col).alias(f"{prefix}_min"),
            F.max(col).alias(f"{prefix}_max"),
        ]
    return out


def nonnull_counts(cols: list[str]) -> list[Column]:
    return [F.count(c).alias(f"{c}_count") for c in cols]


def missing_rates(cols: list[str]) -> list[Column]:
    total = F.count("*").cast("decimal(20,0)")
    return [
        numeric.to_decimal(
            (total - F.count(c)).cast("decimal(38,18)") / total, 8, 4
        ).alias(f"{c}_missing_rate")
        for c in cols
    ]


def event_counts(events: dict[str, Column]) -> list[Column]:
    return [F.count_if(cond).alias(name) for name, cond in events.items()]


def ratio_stats(ratio: Column, mean_name: str, max_name: str) -> list[Column]:
    return [
        numeric.double_to_decimal(F.avg(ratio), 8, 4).alias(mean_name),
        numeric.double_to_decimal(F.max(ratio), 8, 4).alias(max_name),
    ]


def any_flags(flags: dict[str, Column]) -> list[Column]:
    return [F.max(numeric.flag(cond)).alias(name) for name, cond in flags.items()]


def null_counts(cols: dict[str, str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(out) for c, out in cols.items()]


def distinct_counts(cols: dict[str, str]) -> list[Column]:
    return [F.count_distinct(c).alias(out) for c, out in cols.items()]


def time_span(time: str, first: str, last: str) -> list[Column]:
    return [F.min(time).alias(first), F.max(time).alias(last)]


def first_last(value: str, time: str, name: str) -> list[Column]:
    """Earliest and latest reading that holds a value, as (time, value) structs
    ``<name>_lo`` and ``<name>_hi``; equal times are ordered by value."""
    reading = F.when(F.col(value).isNotNull(), F.struct(F.col(time).alias("t"), F.col(value).alias("v")))
    return [F.min(reading).alias(f"{name}_lo"), F.max(reading).alias(f"{name}_hi")]


def slope_per_hour(name: str) -> Column:
    """(last - first) per hour of a ``first_last`` pair; NULL at no elapsed time."""
    lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
    span = numeric.micros(hi["t"]) - numeric.micros(lo["t"])
    change = (hi["v"] - lo["v"]).cast("decimal(24,2)") * F.lit(3_600_000_000).cast("decimal(11,0)")
    slope = change.cast("decimal(38,12)") / span.cast("decimal(20,0)")
    return F.when(span != 0, numeric.to_decimal(slope, 8, 4))


def per_key(df: DataFrame, key: str, *columns: Column, distinct: dict[str, str] | None = None) -> DataFrame:
    """``distinct`` maps columns to the names of their numbers of different values.

    Spark copies every row once per column if several are counted, and deals the copies
    anew. So only the first is left to it; of the others, the first row of each value of
    a key is marked, where the rows of a key lie, and the marks are counted.
    """
    first, *more = (distinct or {}).items()  or [()]
    marks = {}
    for c, _ in more:
        nth = F.row_number().over(Window.partitionBy(key, c).orderBy(c))
        marks[f"_first_{c}"] = F.col(c).isNotNull() & (nth == 1)
    counts = distinct_counts(dict([first])) if first else []
    counts += [F.count_if(F.col(f"_first_{c}")).alias(out) for c, out in more]
    return (df.withColumns(marks) if marks else df).groupBy(key).agg(*columns, *counts)
