"""Where queries and their checks are put on record."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Registers ``build(tables)``; ``oracle`` is the body of the check, which
    may use every view of ``views.CHECK_VIEWS``."""
    def register(build: Callable[[views.Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(views.Tables(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = views.with_views(oracle)
        return build

    return register
