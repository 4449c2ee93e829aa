"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` with its DuckDB oracle SQL."""

from strata.plans.registry import QUERIES, ORACLE_SQL, load_all  # noqa: F401
