"""Registry of queries and of the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from innkeep.domain.views_sql import with_views
from innkeep.session import apply_defaults

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT and decimals as DOUBLE, as the SQL side has them."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(views: str, sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function's name.  ``views`` names the domain
    views its SQL uses."""

    def register(fn: Query) -> Query:
        name = fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(apply_defaults(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views.split(), sql)
        return fn

    return register
