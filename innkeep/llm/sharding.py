"""Sharding by extendible hashing, with DataFrame functions only.

A shard is the set of documents whose hash starts with the shard's bits.  A bucket
that exceeds the byte limit, and only such a bucket, splits on its next bit.  The
shards are therefore the leaves of the smallest prefix tree whose leaves all fit.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import hash_bits, id_text, numbered_copies
from innkeep.session import stored

#: Bits of the hash that the directory may use.
BITS = 60
#: Bits below the expected depth that one round looks at.
LOOKAHEAD = 6


def assign_shards(documents: DataFrame, limit_bytes: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, copy, n_bytes, shard, depth, shard_bytes``.

    ``shard`` holds the bits, most significant first ('' when everything fits in one
    shard); ``depth`` is their number.  Documents hash by id and size.  Rows equal in
    both are numbered by ``copy`` and hash one by one, so a third of all rows with one
    id, or without any, still spreads.  A null text has 0 bytes.  A bucket with a
    single document stays as it is, however large.  An empty table gives no rows;
    other columns are ignored, whatever their names.

    A round sums bytes by a prefix somewhat longer than needed and takes for each the
    shortest sufficient one.  Prefixes that are still too large go to the next round,
    alone, with more bits; the number of rounds depends on the hash, not on the data."""
    items = documents.select(F.col(key).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    label = F.concat_ws(":", id_text("doc_id"), F.col("n_bytes").cast("string"))
    label = F.when(F.col("copy") == 0, label).otherwise(F.concat_ws(":", label, F.col("copy").cast("string")))
    items = numbered_copies(items, "doc_id", "n_bytes").withColumn("hash", hash_bits(label, BITS // 4))
    items = stored(items, "shard-items")
    total = items.agg(F.sum("n_bytes")).first()[0] or 0
    base, deep = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit_bytes)))) + LOOKAHEAD)
    done, waiting = [], items
    while True:
        cells = waiting.groupBy(F.shiftright("hash", BITS - deep).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        leaves, large = _leaves(stored(cells, "shard-cells"), base, deep, limit_bytes)
        cell = F.shiftright("hash", BITS - deep).alias("cell")
        # merged: the cells of all shards are many rows that compress to a small file, which Spark would broadcast
        done.append(waiting.select("*", cell).join(leaves.hint("merge"), "cell").drop("cell"))
        if deep == BITS or large.isEmpty():
            break
        waiting = waiting.select("*", cell).join(large, "cell", "left_semi").drop("cell")
        base, deep = deep, min(BITS, deep + 2 * LOOKAHEAD)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    bits = F.lpad(F.conv(F.col("hash").cast("string"), 10, 2), BITS, "0")
    shard = F.expr("substring(bits_, 1, depth)").alias("shard")
    return out.withColumn("bits_", bits).select("doc_id", "copy", "n_bytes", shard, "depth", "shard_bytes")


def _leaves(cells: DataFrame, base: int, deep: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(cell -> depth and bytes of its shard, cells that are still too large).

    What a prefix adds up to only falls as it grows, so a shard is a prefix that fits while
    the one a bit shorter doesn't.  Prefixes that don't fit are few, about as many as the
    shards; they alone are joined, as a stored table whose size Spark knows."""
    first = base + 1 if base else 0
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(deep))))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {deep} - depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("rows"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("rows") <= 1)
    if deep == BITS:
        fits = fits | (F.col("depth") == deep)
    sums = stored(sums.select("depth", "prefix", "shard_bytes", fits.alias("fits")), "shard-sums")
    too_large = stored(sums.where("not fits").select("depth", "prefix"), "shard-large")
    parents = too_large.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    nodes = sums.where("fits").withColumn("parent", F.shiftright("prefix", 1))
    found = nodes.where(F.col("depth") > first).join(parents, ["depth", "parent"], "left_semi")
    found = found.unionByName(nodes.where(F.col("depth") == first)).select("depth", "prefix", "shard_bytes")
    beyond = F.expr(f"sequence(0L, shiftleft(1L, {deep} - depth) - 1)")
    cell = F.expr(f"shiftleft(prefix, {deep} - depth)") + F.col("beyond")
    leaves = stored(found, "shard-leaves").withColumn("beyond", F.explode(beyond)).select(cell.alias("cell"), "depth", "shard_bytes")
    return leaves, too_large.where(F.col("depth") == deep).select(F.col("prefix").alias("cell"))


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard: its bits, documents, bytes, and its number of slots in a
    directory as deep as the deepest shard."""
    shards = assigned.groupBy("shard", "depth").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n_bytes").alias("n_bytes"))
    deepest = assigned.agg(F.max("depth")).first()[0]
    return shards.withColumn("slots", F.expr(f"shiftleft(1L, {deepest or 0} - depth)"))
