"""Projection, filtering and typing."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NA_TOKENS = ("", "-999", "-999.0", "Nan", "nan", "NaN", "?", "??", " ", "NULL", "None", "<NA>")


def null_tokens(column: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~F.trim(column).isin(*[t.strip() for t in tokens]), column)


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns cast to types; what does not convert becomes null."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in types.items() if c in df.columns})


def infer_types(df: DataFrame, columns: Sequence[str], *, levels: int = 10) -> DataFrame:
    """Logical type of each text column by its content, in one pass over the data: rows (column, logical_type).

    Two numeric values or fewer: binary; numeric; date (all midnight) or timestamp; many levels: cat_embedding; else cat_one_hot.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("string")
        ts = F.expr(f"try_cast(cast(`{c}` as string) as timestamp)")
        aggs.append(
            F.struct(
                F.count(x).alias("n"),
                F.count(F.expr(f"try_cast(cast(`{c}` as string) as double)")).alias("num"),
                F.count(ts).alias("dates"),
                F.coalesce(F.bool_and(ts == F.date_trunc("day", ts)), F.lit(False)).alias("midnight"),
                F.count_distinct(x).alias("levels"),
            ).alias(c)
        )
    stats = df.agg(*aggs).select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns))).alias("x")).select("x.column", "x.s.*")
    kind = F.when((F.col("num") == F.col("n")) & (F.col("levels") == 2), "binary").when((F.col("n") > 0) & (F.col("num") == F.col("n")), "float").when((F.col("n") > 0) & (F.col("dates") == F.col("n")), F.when(F.col("midnight"), "date").otherwise("timestamp"))
    return stats.select("column", kind.when(F.col("levels") > levels, "cat_embedding").otherwise("cat_one_hot").alias("logical_type"))


def sanitize(name: str) -> str:
    s = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    return re.sub(r"_+", "_", re.sub(r"[^0-9a-zA-Z]+", "_", s)).strip("_").lower()


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(sanitize, df.columns))


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add missing columns as nulls of a type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def coalesce_fields(df: DataFrame, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """First value that is not null of several columns, which then go."""
    gone = {c for cs in fields.values() for c in cs} - set(fields)
    return df.withColumns({name: F.coalesce(*cs) for name, cs in fields.items()}).drop(*gone)


def combine_date_time(date: Column, time: Column) -> Column:
    """Timestamp of a date and an HHMM time; without a time, midnight."""
    hhmm = F.lpad(F.coalesce(time.cast("string"), F.lit("0")), 4, "0")
    return F.to_timestamp(F.concat(date.cast("string"), F.lit(" "), F.substring(hhmm, 1, 2), F.lit(":"), F.substring(hhmm, 3, 2)), "yyyy-MM-dd HH:mm")


def date_censor(df: DataFrame, columns: Sequence[str], *, low: Column | None = None, high: Column | None = None, pick: str = "first", closed: bool = True) -> DataFrame:
    """Rows whose chosen date (first not null, max or min of the columns) lies in the bounds."""
    cols = [F.col(c) for c in columns]
    chosen = {"first": F.coalesce, "max": F.greatest, "min": F.least}[pick](*cols) if len(cols) > 1 else cols[0]
    keep = F.lit(True)
    if low is not None:
        keep = keep & ((chosen >= low) if closed else (chosen > low))
    if high is not None:
        keep = keep & ((chosen <= high) if closed else (chosen < high))
    return df.where(keep)


def clean_id(column: Column) -> Column:
    """Trailing digits of an id; ids that end in None or <NA> are null."""
    s = column.cast("string")
    digits = F.regexp_extract(s, r"([0-9]+)(?:\.0)?$", 1)
    return F.when(~s.rlike(r"(None|<NA>)$") & (digits != ""), digits)


def drop_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def id_token(column: Column, position: int, separator: str = "_") -> Column:
    """Part of an id by position, counted from one."""
    return F.try_element_at(F.split(column, re.escape(separator)), F.lit(position))


def window_filter(at: Column, low: Column | None, high: Column | None, *, before: str = "0 SECONDS", after: str = "0 SECONDS", dates: bool = False) -> Column:
    """Whether a time lies in [low - before, high + after]; a missing bound is open; ``dates`` compares days only."""
    fit = (lambda c: F.to_date(c)) if dates else (lambda c: c)
    keep = F.lit(True)
    if low is not None:
        keep = keep & (fit(at) >= fit(low - F.expr(f"INTERVAL {before}")))
    if high is not None:
        keep = keep & (fit(at) <= fit(high + F.expr(f"INTERVAL {after}")))
    return keep


def period_label(at: Column, start: Column, end: Column) -> Column:
    return F.when(at < start, "preop").when(at <= end, "intraop").when(at > end, "postop")


def indicators(column: Column, values: Sequence[str], prefix: str) -> list[Column]:
    """A 0/1 column for each value."""
    return [F.coalesce((column == v).cast("int"), F.lit(0)).alias(f"{prefix}_{sanitize(str(v))}") for v in values]


def map_values(column: Column, table: Mapping[str, str], *, default: str | None = None, other: str | None = None) -> Column:
    """Values by a map; null gives ``default``, unmapped ones ``other`` (or themselves)."""
    m = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    rest = F.lit(other) if other is not None else column
    return F.when(column.isNull(), F.lit(default)).otherwise(F.coalesce(F.try_element_at(m, column), rest))


def any_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)
