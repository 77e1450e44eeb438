"""Staged publish.

Each load is written to a folder of its own and becomes visible by one log row, named
after its version, so readers see either the old or the new table, and a failed run
changes nothing.  Older versions stay for ``KEEP`` further publishes, for readers that
still have them open.  A publisher that another one has overtaken is refused.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from innkeep.functions.numbers import MONEY
from innkeep.operators.quality import gate_passed, judged
from innkeep.sinks.tables import read_evolved, read_if_exists, write_table

#: A replaced version stays readable until so many more have been published.
KEEP = 10

_LOG = "folder string, n_rows bigint"
_MEASURED = f"{_LOG}, sum_col string, amount decimal(28,2), columns array<string>"


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    path = f"{root}/log"
    return None if read_if_exists(spark, path) is None else read_evolved(spark, path)


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(version, folder) of the published table, None before the first publish."""
    log = _log(spark, root)
    if log is None:
        return None
    log = log.select("version", "folder")
    row = log.agg(F.max(F.struct("version", "folder")).alias("v")).select("v.*").first()
    return None if row["version"] is None else (row["version"], row["folder"])


def read_published(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published at {root}")
    return spark.read.parquet(f"{root}/{version[1]}")


def publish(df: DataFrame, root: str, keep: int = KEEP) -> bool:
    """Make ``df`` the published table.  An empty ``df`` leaves the table as it is
    and returns False.  Raises RuntimeError if another load was published meanwhile."""
    spark = df.sparkSession
    before = current_version(spark, root)
    version = before[0] + 1 if before else 1
    folder = f"data/v{version}-{uuid.uuid4().hex}"
    write_table(df, f"{root}/{folder}")
    rows = spark.read.schema(df.schema).parquet(f"{root}/{folder}").count()
    if rows == 0:
        return False
    if current_version(spark, root) != before:
        raise RuntimeError(f"{root}: another load was published during this one")
    entry = spark.createDataFrame([(folder, rows)], _LOG)
    # fails if the version has a log row by now
    write_table(entry.coalesce(1), f"{root}/log/version={version}", mode="error")
    _expire(spark, root, version - keep)
    return True


def _expire(spark: SparkSession, root: str, version: int) -> None:
    """Remove the data of ``version``, which nobody should be reading any more."""
    if version < 1:
        return
    old = _log(spark, root).where(F.col("version") == version).first()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{old['folder']}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Verdict:
    """What became of a load: the one-row gate, and whether it is published."""

    gate: DataFrame
    published: bool


def _measured_base(spark: SparkSession, root: str, sum_col: str) -> tuple[int, Decimal, list[str]]:
    """(rows, sum, columns) of the published table: from its log row, or, where a version
    was published without measures, from one read of that column."""
    version = current_version(spark, root)
    if version is None:
        return 0, Decimal(0), []
    log = _log(spark, root).where(F.col("version") == version[0])
    if {"sum_col", "amount"} <= set(log.columns):
        row = log.first()
        if row["sum_col"] == sum_col:
            return row["n_rows"], row["amount"], row["columns"]
    table = read_published(spark, root)
    row = table.agg(*_measures(table, sum_col)).first()
    return row["n_rows"], row["amount"], table.columns


def _measures(df: DataFrame, sum_col: str) -> list:
    amount = F.col(sum_col).try_cast(MONEY) if sum_col in df.columns else F.lit(0).cast(MONEY)
    total = F.coalesce(F.sum(amount), F.lit(0).cast("decimal(28,2)"))
    return [F.count(F.lit(1)).alias("n_rows"), total.cast("decimal(28,2)").alias("amount")]


def publish_checked(
    df: DataFrame, root: str, sum_col: str, keep: int = KEEP, bootstrap: bool = False, **limits: float
) -> Verdict:
    """Write the load, check it against the published table, publish it if it passes.

    The load is read once: rows and sum are observed by the tasks that write it.  The
    published table isn't read at all; its measures are in its log row.  The checks are
    those of ``quality_gate``; a first load needs ``bootstrap``.  A refused load leaves
    its folder behind, unseen.  An empty load leaves the table as it is."""
    spark = df.sparkSession
    before = current_version(spark, root)
    base_rows, base_sum, base_columns = _measured_base(spark, root, sum_col)
    version = before[0] + 1 if before else 1
    folder = f"data/v{version}-{uuid.uuid4().hex}"
    seen = Observation(f"load-{uuid.uuid4().hex}")
    write_table(df.observe(seen, *_measures(df, sum_col)), f"{root}/{folder}")
    rows, amount = seen.get["n_rows"], seen.get["amount"]
    totals = spark.createDataFrame(
        [(rows, base_rows, amount, base_sum)],
        "new_rows bigint, base_rows bigint, new_sum decimal(28,2), base_sum decimal(28,2)",
    )
    gate = judged(totals, before is None and bootstrap or set(df.columns) == set(base_columns), bootstrap=bootstrap, **limits)
    if rows == 0 or not gate_passed(gate):
        return Verdict(gate, False)
    if current_version(spark, root) != before:
        raise RuntimeError(f"{root}: another load was published during this one")
    entry = spark.createDataFrame([(folder, rows, sum_col, amount, df.columns)], _MEASURED)
    write_table(entry.coalesce(1), f"{root}/log/version={version}", mode="error")
    _expire(spark, root, version - keep)
    return Verdict(gate, True)


def publish_if(gate: DataFrame, df: DataFrame, root: str) -> bool:
    """Publish only when the gate passed."""
    return gate_passed(gate) and publish(df, root)
