"""Data quality: audits, completeness, preflight, assertions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.operators.stats import quantiles


def audit(facts: DataFrame, *, variable: str, person: str, visit: str, value: str) -> DataFrame:
    """Per variable: persons, visits, observations, and the spread of values."""
    spread = quantiles(facts, [variable], value, [0.15, 0.85]).withColumnsRenamed({"q0": "p15", "q1": "p85"})
    counts = facts.groupBy(variable).agg(F.count_distinct(person).alias("persons"), F.count_distinct(visit).alias("visits"), F.count("*").alias("observations"), F.count(value).alias("with_value"), F.avg(value).alias("mean"))
    return counts.join(spread, variable, "left").select(variable, "persons", "visits", "observations", "with_value", "p15", "p85", "mean")


def completeness(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys that were not found."""
    return expected.join(found.select(*keys).distinct(), list(keys), "left_anti")


def preflight(spark: SparkSession, needed: Mapping[str, Sequence[str]]) -> list[str]:
    """Tables and columns that are missing from the catalog."""
    out = []
    for name, columns in needed.items():
        if not spark.catalog.tableExists(name):
            out.append(name)
        else:
            have = {c.lower() for c in spark.table(name).columns}
            out += [f"{name}.{c}" for c in columns if c.lower() not in have]
    return out


def unmapped(facts: DataFrame, lookup: DataFrame, concept: str) -> DataFrame:
    """Used concepts without a variable, with how often they occur."""
    known = lookup.select(concept).distinct()
    return facts.groupBy(concept).agg(F.count("*").alias("n")).join(known, concept, "left_anti")


def multiply_mapped(lookup: DataFrame, concept: str, variable: str) -> DataFrame:
    """Concepts of several variables."""
    return lookup.groupBy(concept).agg(F.count_distinct(variable).alias("n_variables"), F.array_join(F.array_sort(F.collect_set(variable)), ",").alias("variables")).where("n_variables > 1")


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """How many rows break each rule; a null outcome breaks it."""
    counts = df.agg(*(F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("broken")) for n in rules))).alias("x")).select("x.*")


def assert_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows themselves; reading a row that breaks a rule fails with the rule's name."""
    for name, rule in rules.items():
        df = df.where(F.when(F.coalesce(rule, F.lit(False)), True).otherwise(F.raise_error(F.lit(f"rule broken: {name}")).cast("boolean")))
    return df


def append_log(df: DataFrame, path: str, *, table: str, batch: int, key: str) -> None:
    """One row (table, batch, n, first_id, last_id) about a loaded batch, appended to a log of Parquet files."""
    df.agg(F.lit(table).alias("table"), F.lit(batch).cast("long").alias("batch"), F.count("*").alias("n"), F.min(key).alias("first_id"), F.max(key).alias("last_id")).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log with the number of rows of a table up to each batch."""
    return spark.read.parquet(path).withColumn("so_far", F.sum("n").over(Window.partitionBy("table").orderBy("batch")))
