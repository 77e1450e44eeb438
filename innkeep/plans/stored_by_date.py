"""By-date reservations as a stored table by arrival month, and its upkeep by change."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from innkeep.functions import dates as D
from innkeep.operators.changes import changed_groups
from innkeep.operators.rows import union_distinct
from innkeep.plans.reservations import reservations_by_date
from innkeep.session import stored
from innkeep.sinks.tables import overwrite_partitions

MONTH = "arrival_month"


@dataclass(frozen=True)
class ByDateSource:
    """One state of what by-date rows are made of."""

    reservations: DataFrame
    price_days: DataFrame
    mirrors: DataFrame
    booking_patches: DataFrame


def _dated(reservations: DataFrame) -> DataFrame:
    return reservations.withColumn(MONTH, D.month_start(D.as_date(reservations, "startdate")))


def _write(source: ByDateSource, path: str, months: DataFrame) -> int:
    dated = _dated(source.reservations)
    kept = dated.join(months.withColumnRenamed(MONTH, "_m"), F.col(MONTH).eqNullSafe(F.col("_m")), "left_semi")
    kept = stored(kept, "touched-reservations")
    prices = source.price_days.join(kept.select(F.col("id").alias("reservation_id")), "reservation_id", "left_semi")
    rows = reservations_by_date(kept, prices.select(*source.price_days.columns), source.mirrors, source.booking_patches)
    return overwrite_partitions(rows.repartition(MONTH, "id"), path, [MONTH], months)


def build_by_date(source: ByDateSource, path: str) -> int:
    """Store all by-date rows; returns the number of months."""
    return _write(source, path, stored(_dated(source.reservations).select(MONTH).distinct(), "months"))


def touched_months(old: ByDateSource, new: ByDateSource) -> DataFrame:
    """Arrival months whose rows may differ between two states: those, before and after,
    of reservations that changed, whose prices or booking date changed, or whose unit is
    mirrored otherwise."""
    both = _dated(old.reservations).select("id", "unit_id", MONTH).unionByName(_dated(new.reservations).select("id", "unit_id", MONTH))
    both = stored(both.distinct(), "reservation-months")
    prices = changed_groups(old.price_days, new.price_days, ["reservation_id"])
    ids = union_distinct(
        [
            changed_groups(old.reservations, new.reservations, ["id"]),
            prices.select(F.col("reservation_id").alias("id")),
            changed_groups(old.booking_patches, new.booking_patches, ["id"]),
        ]
    )
    moved = changed_groups(old.mirrors, new.mirrors, ["from_id"]).select(F.col("from_id").alias("unit_id"))
    changed = ids.withColumnRenamed("id", "_id")
    months = [
        both.join(changed, F.col("id").eqNullSafe(F.col("_id")), "left_semi").select(MONTH),
        both.join(moved, "unit_id", "left_semi").select(MONTH),
    ]
    return stored(union_distinct(months), "touched")


def refresh_by_date(old: ByDateSource, new: ByDateSource, path: str) -> int:
    """Bring the stored rows from the old state to the new one; only touched months are
    computed and replaced.  Returns how many there were."""
    return _write(new, path, touched_months(old, new))
