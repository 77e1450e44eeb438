"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm.common import COPIES_PER_BLOCK, WORD, hash_bits, id_text, maybe_broadcast, numbered_copies
from innkeep.session import stored

#: Cells by which a source's documents are summed in rank order.
CELLS = 4096


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Target size of each source: ``source, source_size, target``.

    Sources in code-point order, null last, have the given weights in turn.  They
    share ``share`` times the total; a target stops at ``most`` times its source's
    size and the excess goes to the others by weight.  With sources by size per
    weight, those below the level at which the rest is even are the ones that stop.
    The windows run over one row per source."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("weight", F.element_at(cycle, (place % len(weights) + 1).cast("int")))
    sources = sources.withColumn("most", most * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    sources = sources.withColumn("level", left / F.sum("weight").over(rest))
    open_ = F.col("most") / F.col("weight") > F.col("level")
    sources = sources.withColumn("level", F.min(F.when(open_, F.struct(F.col("most") / F.col("weight"), "level"))).over(whole)["level"])
    target = F.coalesce(F.least(F.col("most"), F.col("weight") * F.col("level")), F.col("most"))
    return sources.select("source", "source_size", target.alias("target"))


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 1,
    key: str = "doc_id",
    identity: tuple[str, ...] = (),
) -> DataFrame:
    """Words that the mix takes of each document: ``doc_id, size, source_size, target,
    taken, source, copy`` (and the ``identity`` columns).

    The expected copies of a document are its source's target over its source's size.
    Their whole part is certain.  The rest is the document's inclusion probability p in
    an order sample: with u uniform, documents rank by (u / (1 - u)) / (p / (1 - p)),
    and a source takes them in this order until its target is reached.  The document
    that crosses the target is taken in part.  u comes from the id and ``seed``, so
    reruns agree; equal rows are numbered and draw each for themselves.

    A source's rank order is cut without gathering the source: sizes are summed by
    cells of the rank, and only the cell that holds the cut is sorted.

    A null or blank text has size 0 and takes nothing.  Null sources form one source.
    An empty table gives no rows; further columns don't matter."""
    sizes = documents.select(
        F.col(key).alias("doc_id"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *identity
    )
    sizes = stored(numbered_copies(sizes, "doc_id", "source", "size", *identity), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, most), "mix-targets")
    both = sizes.join(targets.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    both = both.withColumn("whole", F.floor(copies)).withColumn("p", copies - F.floor(copies))
    both = both.withColumn("open", F.floor(F.col("target") - F.col("whole") * F.col("source_size")))
    label = F.concat_ws(":", F.lit(str(seed)), id_text("doc_id"))
    label = F.when(F.col("copy") == 0, label).otherwise(F.concat_ws(":", label, F.col("copy").cast("string")))
    u = (hash_bits(label, 13) + F.lit(0.5)) / F.lit(float(2**52))
    both = both.withColumn("u", u)
    rank = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    both = both.withColumn("rank", F.when(F.col("p") > 0, rank))
    both = both.withColumn("cell", F.least(F.floor(F.col("rank") / (1 + F.col("rank")) * CELLS), F.lit(CELLS - 1)))
    both = stored(both, "mix-ranked")
    summed = both.where("cell is not null").groupBy("source", "cell", "open").agg(F.sum("size").alias("cell_size"))
    up_to = Window.partitionBy("source").orderBy("cell")
    summed = summed.withColumn("end", F.sum("cell_size").over(up_to))
    cut = summed.where((F.col("end") > F.col("open")) & (F.col("end") - F.col("cell_size") <= F.col("open")))
    # an empty cell never holds the cut, so there is one such cell or none
    cut = cut.select(F.col("source").alias("source_"), F.col("cell").alias("cut"), (F.col("end") - F.col("cell_size")).alias("before"))
    cut = stored(cut, "mix-cuts")
    ranked = both.join(cut, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
    inside = ranked.where(F.col("cell") == F.col("cut"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size", "copy", *identity)
    reached = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    reached = F.coalesce(reached, F.col("before"))
    sampled = F.greatest(F.lit(0), F.least(F.col("size"), F.col("open") - reached))
    inside = inside.withColumn("sampled", sampled)
    outside = ranked.where(~F.coalesce(F.col("cell") == F.col("cut"), F.lit(False)))
    taken = F.col("cell").isNotNull() & (F.col("cut").isNull() | (F.col("cell") < F.col("cut")))
    outside = outside.withColumn("sampled", F.when(taken, F.col("size")).otherwise(F.lit(0)))
    out = inside.unionByName(outside)
    taken = (F.col("whole") * F.col("size") + F.col("sampled")).cast("long").alias("taken")
    return out.select("doc_id", "size", "source_size", "target", taken, "source", "copy", *identity)


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them, in the columns of ``documents``: a row for
    each copy, always with its whole text.  Of the copy at a source's cut, which ``mix``
    takes in part, a whole row stays if at least half of its words are taken, and none
    otherwise; at most one document a source.  Documents of size 0 take no part in a mix and go.

    Rows equal in all columns (maps aside) are listed from their number, in blocks, so
    that any number of them is spread over tasks."""
    plain = [F.col(f"`{f.name}`") for f in documents.schema.fields if "map<" not in f.dataType.simpleString()]
    hashed = F.xxhash64(*[x for c in plain for x in (c, c.isNull())]).alias("mix_hash_")
    taken = mix(documents.select("doc_id", "source", "text", hashed), identity=("mix_hash_",), **options).where("taken > 0")
    rows = F.expr("taken div size + if(2 * (taken % size) >= size, 1, 0)")
    taken = taken.groupBy("doc_id", "source", "mix_hash_").agg(F.sum(rows).alias("times")).where("times > 0")
    taken = stored(taken.select(F.struct("doc_id", "source", "mix_hash_").alias("key"), "times"), "mix-times")
    marked = documents.select(F.struct("*").alias("row"), F.struct("doc_id", "source", hashed).alias("key"))
    few, many = taken.where(F.col("times") <= COPIES_PER_BLOCK), taken.where(F.col("times") > COPIES_PER_BLOCK)
    blocks = marked.dropDuplicates(["key"]).join(few, "key").withColumn("block", F.lit(0).cast("long"))
    hot = many.count()
    if hot:  # few keys have so many rows: theirs are picked first, then one of each
        picked = marked.join(maybe_broadcast(many, hot), "key").dropDuplicates(["key"])
        picked = picked.withColumn("block", F.explode(F.expr(f"sequence(0L, (times - 1) div {COPIES_PER_BLOCK})")))
        blocks = blocks.unionByName(picked.repartition("key", "block"))
    left = F.expr(f"cast(least({COPIES_PER_BLOCK}, times - block * {COPIES_PER_BLOCK}) as int)")
    return blocks.withColumn("copy", F.explode(F.sequence(F.lit(1), left))).select(*[F.col(f"row.`{c}`") for c in documents.columns])
