"""Queries that must take all rows of their table."""

from pyspark.sql import functions as F

from wardline.plans import cdm, registry
from tests.test_queries import DATA


def test_all_visits_are_expanded(spark):
    visits = cdm.Tables(spark, DATA).visits.where("start_at <= end_at")
    assert "i5_expand_all_to_grid" in registry.oracle_sql()
    rows = registry.queries()["i5_expand_all_to_grid"](spark, DATA)
    assert rows.select("visit_id").distinct().count() == visits.select("visit_id").distinct().count()
    assert rows.select("visit_id").where(F.col("visit_id") % 5 != 0).count() > 0
