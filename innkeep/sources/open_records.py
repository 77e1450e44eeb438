"""Landed records whose fields nobody declared.

Bodies are kept as VARIANT while they land, so no field is lost; the schema is then
found by one aggregation over all records, and the columns are cast from it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from innkeep.operators.cleaning import nested_to_json
from innkeep.operators.nested import flatten
from innkeep.session import stored


def land_pages(
    pages: DataFrame, body: str, paths: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """``(*keep, n, records)``: each page's records as VARIANTs, from the first of
    ``paths`` that holds a non-empty list, and their number.  Bodies that are no JSON or
    hold no list are pages without records.  Stored, so that a body is parsed once."""
    parsed = pages.select(*keep, F.try_parse_json(F.col(body)).alias("_v"))
    lists = {f"_list_{i}": F.try_variant_get("_v", path, "array<variant>") for i, path in enumerate(paths)}
    parsed = parsed.select(*keep, *[x.alias(name) for name, x in lists.items()])  # each is read once
    found = F.coalesce(*[F.when(F.size(name) > 0, F.col(name)) for name in lists], F.array().cast("array<variant>"))
    landed = parsed.select(*keep, found.alias("records"))
    return stored(landed.select(*keep, F.size("records").alias("n"), "records"), "landed-pages")


def until_short_page(landed: DataFrame, page: str, page_size: int, run: str | None = None) -> DataFrame:
    """Pages of each run up to its first page with fewer than ``page_size`` records: a
    reader stops asking there, so later pages belong to another request.  Ends are found
    by aggregation, one row per run; a run with very many pages is not gathered."""
    ends = landed.where(F.col("n") < page_size)
    if run is None:
        last = ends.agg(F.min(page).alias("_end")).first()["_end"]
        return landed if last is None else landed.where(F.col(page) <= last)
    ends = ends.groupBy(F.col(run).alias("_run")).agg(F.min(page).alias("_end"))
    joined = landed.join(ends, landed[run].eqNullSafe(F.col("_run")), "left")
    return joined.where(F.col("_end").isNull() | (F.col(page) <= F.col("_end"))).drop("_run", "_end")


def page_records(landed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(*keep, pos, record)``: one row per record; entries that are no objects drop out."""
    rows = landed.select(*keep, F.posexplode("records").alias("pos", "record"))
    return rows.where(F.try_variant_get("record", "$", "struct<>").isNotNull())


def _as_ddl(found: str) -> str:
    """The type text of ``schema_of_variant_agg`` as a column type.  Fields that were
    always null are text; so are those whose types disagree (``VARIANT``)."""
    quoted = re.split(r"(`(?:[^`]|``)*`)", found)
    quoted[::2] = [re.sub(r"\b(VOID|VARIANT)\b(?!:)", "STRING", part.replace("OBJECT<", "STRUCT<")) for part in quoted[::2]]
    return "".join(quoted)


def _settled(kind: T.DataType) -> T.DataType:
    """The type without what depends on the widest value seen: decimals as doubles."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settled(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in kind.fields])
    return kind


def found_schema(records: DataFrame, record: str = "record") -> T.StructType:
    """Every field that occurs in any record, with the type its values share."""
    found = records.agg(F.schema_of_variant_agg(record)).first()[0]
    kind = T.DataType.fromDDL(_as_ddl(found)) if found else None
    return _settled(kind) if isinstance(kind, T.StructType) else T.StructType()


def _ddl(kind: T.DataType) -> str:
    """The type's text, with names quoted whatever they hold."""
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.StructType):
        fields = [f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields]
        return f"struct<{', '.join(fields)}>"
    return kind.simpleString()


def typed_records(
    records: DataFrame,
    keep: Sequence[str] = (),
    as_text: Sequence[str] = (),
    schema: T.StructType | None = None,
    record: str = "record",
    sep: str = ".",
) -> DataFrame:
    """Records as columns: objects flattened to names joined by ``sep``, lists as JSON
    text.  Top-level fields in ``as_text`` come as text whatever they hold, and are there
    (NULL) even where no record has them.  Without ``schema`` it is found first, which
    reads the records once more: pass stored ones."""
    schema = found_schema(records, record) if schema is None else schema
    kinds: Mapping[str, T.DataType] = {f.name: f.dataType for f in schema.fields}
    text = T.StringType()
    columns = [T.StructField(c, text) for c in as_text]
    columns += [T.StructField(c, kind) for c, kind in kinds.items() if c not in as_text]
    aside = [F.col(c).alias(f"_kept_{i}") for i, c in enumerate(keep)]  # a field may have its name
    whole = records.select(F.try_variant_get(record, "$", _ddl(T.StructType(columns))).alias("_r"), *aside)  # one walk over a record
    rows = nested_to_json(flatten(whole.select("_r.*", *[f"_kept_{i}" for i in range(len(keep))]), sep))
    return rows.withColumnsRenamed({f"_kept_{i}": c for i, c in enumerate(keep)})
