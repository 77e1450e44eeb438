"""Operators on landed JSON documents and nested columns.

A document is one row with its text in ``body``.  Declared shapes are read with
``from_json``; where a value may be an object, a list or missing, VARIANT is
used, because ``from_json`` turns a shape mismatch into NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from innkeep import schemas
from innkeep.functions import as_col
from innkeep.functions.numbers import MONEY, to_number

# Status codes that mean success.
OK_CODES = ("0", "SUCCESS")


def status_code(body: Column | str) -> Column:
    """Status code carried inside a response body, NULL without one."""
    return F.get_json_object(as_col(body), "$.status.code")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often and in
    whichever branch ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def reject_reason(body: Column | str, required: str, shape: str | None = None) -> Column:
    """Why a document is unusable, NULL when it is fine.

    ``required`` is the path that must hold something: a ``list`` or ``object``
    with content, or, without ``shape``, either of them."""
    body = as_col(body)

    def judge(parsed: Column) -> Column:
        items = F.try_variant_get(parsed, required, "array<variant>")
        fields = F.try_variant_get(parsed, required, "map<string,variant>")
        found = {"list": [F.array_size(items)], "object": [F.array_size(F.map_keys(fields))]}
        sizes = found[shape] if shape else found["list"] + found["object"]
        filled = F.coalesce(*sizes, F.lit(0)) > 0
        code = F.try_variant_get(parsed, "$.status.code", "string")
        return (
            F.when(body.isNull() | (F.trim(body) == ""), "empty body")
            .when(parsed.isNull(), "invalid json")
            .when(code.isNotNull() & ~code.isin(*OK_CODES), F.concat(F.lit("status "), code))
            .when(~filled, "empty data")
        )

    return _once(F.try_parse_json(body), judge)


def split_documents(
    df: DataFrame, body: str, schema: str, required: str, shape: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Usable documents with their parsed ``doc``, and the others with ``reason``.

    Usable ones come out of a generator, not a filter: a filter would be moved
    below earlier joins and parse documents those joins drop."""
    reason = reject_reason(body, required, shape)
    good = df.withColumn(
        "doc", F.explode(F.when(reason.isNull(), F.array(F.from_json(body, schema))))
    )
    return good, df.withColumn("reason", reason).where("reason is not null")


def tally(df: DataFrame, body: str, required: str) -> DataFrame:
    """Documents per outcome: ``ok`` or the reason they are unusable."""
    reason = F.coalesce(reject_reason(body, required), F.lit("ok"))
    return df.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("documents"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


def unwrap(df: DataFrame, body: str, paths: Sequence[str], items: str, alias: str) -> DataFrame:
    """One row per list element, from the first path that holds a non-empty list
    (``items`` is the list type).  Documents without any give no rows."""
    parsed = df.withColumn("_v", F.try_parse_json(as_col(body)))
    filled = [
        _once(F.try_variant_get("_v", path, items), lambda found: F.when(F.size(found) > 0, found))
        for path in paths
    ]
    return parsed.withColumn(alias, F.explode(F.coalesce(*filled))).drop("_v")


def as_list(value: Column | str, item: str) -> Column:
    """VARIANT that is a list, one item or null, as an array of ``item``."""
    value = as_col(value)
    return F.coalesce(
        F.try_variant_get(value, "$", f"array<{item}>"),
        F.when(
            value.isNotNull() & ~F.is_variant_null(value),
            F.array(F.try_variant_get(value, "$", item)),
        ),
        F.array().cast(f"array<{item}>"),
    )


def explode_path(df: DataFrame, path: str, keep: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """One row per element of a nested list; the element's fields become columns
    next to the kept parent columns."""
    rows = df.select(*[F.col(c).alias(c.replace(".", sep)) for c in keep], F.explode(path).alias("_e"))
    parents = [c.replace(".", sep) for c in keep]
    return rows.select("_e.*", *parents)


def flatten(df: DataFrame, sep: str = ".", max_level: int | None = None) -> DataFrame:
    """Struct fields as columns named by their path.  Lists stay as they are;
    ``max_level`` limits how deep structs are opened."""

    def leaves(schema: T.StructType, path: tuple[str, ...], level: int):
        for field in schema.fields:
            here = (*path, field.name)
            opens = isinstance(field.dataType, T.StructType)
            if opens and (max_level is None or level < max_level):
                yield from leaves(field.dataType, here, level + 1)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))

    return df.select(*leaves(df.schema, (), 0))


def pick(df: DataFrame, path: str, fields: Sequence[str]) -> DataFrame:
    """Scalar fields of one nested object, NULL where the object lacks them."""
    return df.withColumns({f: F.col(f"{path}.{f}") for f in fields})


def field_rows(df: DataFrame, fields: str, field_id: int, keep: Sequence[str]) -> DataFrame:
    """Rows of a custom-field list that carry one field id."""
    wanted = F.filter(F.col(fields), lambda f: f.getField("field_id") == field_id)
    return df.select(*keep, F.explode(wanted).alias("_f")).select("_f.*", *keep)


def named_value(pairs: Column | str, name: str) -> Column:
    """Value of a name in a name/value list; the last duplicate wins."""
    hits = F.filter(as_col(pairs), lambda p: p.getField("name") == name)
    return F.try_element_at(hits, F.lit(-1)).getField("value")


def name_value_columns(df: DataFrame, pairs: str, names: Sequence[str]) -> DataFrame:
    """Name/value list as columns, without a shuffle."""
    return df.withColumns({n: named_value(pairs, n) for n in names}).drop(pairs)


def name_value_map(pairs: Column | str) -> Column:
    """Name/value list as a map; the last duplicate wins."""
    pairs = as_col(pairs)
    names = F.array_distinct(F.transform(pairs, lambda p: p.getField("name")))
    names = F.filter(names, lambda n: n.isNotNull())

    def last(name: Column) -> Column:
        hits = F.filter(pairs, lambda p: p.getField("name") == name)
        return F.try_element_at(hits, F.lit(-1)).getField("value")

    return F.map_from_arrays(names, F.transform(names, last))


def explode_price_days(df: DataFrame, body: str, load_time: Column, manager: Column) -> DataFrame:
    """Nightly prices of each document; documents without id or days drop out."""
    data = F.from_json(as_col(body), schemas.PRICE_DAYS_DOC).getField("data")
    known = F.coalesce(F.col("_d.reservation_id") != "", F.lit(False))
    return df.select(
        load_time.alias("data_price"), manager.alias("manager"), data.alias("_d")
    ).select(
        "_d.reservation_id",
        "data_price",
        "manager",
        F.inline(F.when(known, F.col("_d.reservation_days"))),
    )


_COMMISSION = (
    "management_commission_amount",
    "management_commission_percent",
    "owner_commission_amount",
    "owner_commission_percent",
)


def _fee_data(body: Column | str) -> Column:
    """Both sections of a fee document, whatever their shape."""
    return F.from_json(as_col(body), schemas.FEES_DOC).getField("data")


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _fee_reject(data: Column) -> Column:
    fees = data.getField("taxes_and_fees").getField("tax_fee")
    commission = data.getField("commission_information")
    is_list = F.try_variant_get(fees, "$", "array<variant>").isNotNull()
    is_object = F.try_variant_get(commission, "$", "map<string,variant>").isNotNull()
    return F.when(_present(fees) & ~is_list, "fees not a list").when(
        _present(commission) & ~is_object, "commission not an object"
    )


def fee_reject(body: Column | str) -> Column:
    """Reason a fee document fails: a section of the wrong shape."""
    return _once(_fee_data(body), _fee_reject)


def explode_fees(df: DataFrame, body: str = "body", key: str = "confirmation_id") -> DataFrame:
    """One row per fee, plus one commission row when that section has content;
    the commission columns repeat on every row.  Values stay text.  Documents
    with a section of the wrong shape give no rows."""
    text = F.lit(None).cast("string")
    fee_fields = ("id", "name", "value", "percent", "include_as_tax", "taxable")

    def row(kind: str, values: Sequence[Column]) -> Column:
        named = [v.alias("fee_id" if n == "id" else n) for n, v in zip(fee_fields, values)]
        return F.struct(F.lit(kind).alias("row_type"), *named)

    fees_path, commission_path = "_d.taxes_and_fees.tax_fee", "_d.commission_information"
    listed = F.try_variant_get(fees_path, "$", f"array<{schemas.FEE}>")
    fees = F.transform(listed, lambda f: row("tax_fee", [f.getField(n) for n in fee_fields]))
    summary = F.array(row("commission", [text, F.lit("Commission Summary"), text, text, text, text]))
    none = F.filter(summary, lambda _: F.lit(False))
    has_commission = F.size(F.try_variant_get(commission_path, "$", "map<string,variant>")) > 0
    rows = F.concat(F.coalesce(fees, none), F.when(has_commission, summary).otherwise(none))
    exploded = df.select(key, _fee_data(body).alias("_d")).select(
        key,
        F.col(commission_path).alias("commission"),
        F.inline(F.when(_fee_reject(F.col("_d")).isNull(), rows)),
    )
    return exploded.select(
        key,
        "row_type",
        "fee_id",
        *fee_fields[1:],
        *[F.try_variant_get("commission", f"$.{n}", "string").alias(n) for n in _COMMISSION],
    )


def type_fees(df: DataFrame, key: str = "confirmation_id") -> DataFrame:
    """Fee rows with the stored types; text that is no number becomes NULL."""
    amounts = ("value", "management_commission_amount", "owner_commission_amount")
    percents = ("percent", "management_commission_percent", "owner_commission_percent")
    return df.withColumns(
        {
            key: F.col(key).try_cast("int"),
            "fee_id": to_number("fee_id", "bigint"),
            **{c: to_number(c, MONEY) for c in amounts},
            **{c: to_number(c, "decimal(10,4)") for c in percents},
            **{c: to_number(c, "tinyint").cast("int") for c in ("include_as_tax", "taxable")},
        }
    )
