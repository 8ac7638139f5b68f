"""All queries of the library and the SQL that states each one's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.plans.cdm import Tables, sql_with

FLAGSHIP = "w1_most_recent_measurement"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None, rounded: str = ""):
    """Register a plan (Tables -> DataFrame) with its SQL over views of the data model.

    ``rounded`` columns are rounded to six places on both sides; instants leave as timestamps without zone.
    """

    def add(plan: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        places = rounded.split()

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = plan(Tables(spark, sf_dir))
            out = [F.round(F.col(c).cast("double"), 6).alias(c) if c in places else F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes]
            return df.select(*out)

        _QUERIES[name] = run
        if sql is not None:
            text = sql_with(views, sql)
            if places:
                text = f"select * replace ({', '.join(f'round(cast({c} as double), 6) as {c}' for c in places)}) from ({text})"
            _SQL[name] = text
        return plan

    return add


def _load() -> None:
    from wardline.plans import catalogue_queries, clinical_queries, core_queries, organ_queries, prep_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
