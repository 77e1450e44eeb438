"""Reference sheets: targets and lookups kept as spreadsheets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from innkeep.sinks.publish import publish
from innkeep.sources.sheets import read_grid


def reference_sheets(grids: Mapping[str, DataFrame], root: str) -> dict[str, bool]:
    """Replace one table per sheet, below ``root``; a sheet without data rows
    leaves its table as it is.  Returns which tables were replaced.

    ``grids`` are raw grids (row_no, cells) whose first row is the header."""
    done = {}
    for name, grid in grids.items():
        table = read_grid(grid)
        done[name] = table is not None and publish(table.drop("row_no"), f"{root}/{name}")
    return done
