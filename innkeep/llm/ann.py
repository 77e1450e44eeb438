"""Nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import small_batches
from innkeep.session import stored

#: Bits of a substring.
PART = 8
#: Vectors that the codes are learned from, at most, and rounds of learning.
FIT_ROWS, FIT_ROUNDS = 20_000, 30
#: Hamming radius searched, as a share of the bits.
RADIUS = 0.47
#: Vectors in one index segment and queries in one block, about.
SEGMENT, BLOCK = 8_192, 2_048


def learn_codes(sample: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(mean, rotation): codes are the signs of ``(x - mean) @ rotation``.  Principal
    directions, turned until the sample lies as near to the corners as can be."""
    mean = sample.mean(0)
    x = sample - mean
    _, _, directions = np.linalg.svd(x, full_matrices=False)
    bits = sample.shape[1] - sample.shape[1] % PART
    if len(directions) < bits:  # a sample smaller than the dimension
        directions = np.eye(sample.shape[1])
    basis = directions[:bits].T
    y = x @ basis
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(FIT_ROUNDS):
        u, _, v = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
        turn = (u @ v).T
    return mean, basis @ turn


def codes(x: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """The codes as bytes, one substring a byte."""
    return np.packbits((x - mean) @ rotation > 0, axis=1)


_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


class MultiIndex:
    """One index per substring: the vectors by the substring's value."""

    def __init__(self, own: np.ndarray):
        self.codes = own
        self.words = np.ascontiguousarray(np.pad(own, ((0, 0), (0, -own.shape[1] % 8)))).view(np.uint64)
        self.order = [np.argsort(own[:, j], kind="stable") for j in range(own.shape[1])]
        self.starts = [np.searchsorted(own[o, j], np.arange(257)) for j, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Numbers of all vectors whose code is at most ``radius`` bits away.  With the
        distance split over the substrings, one of them has its share of it or less, so
        probing each index to radius // parts finds them all; the first indices go one
        bit less where the radius leaves no full share."""
        parts = self.codes.shape[1]
        share, rest = divmod(radius, parts)
        seen = np.zeros(len(self.codes), bool)
        for j in range(parts):
            reach = share if j <= rest else share - 1
            if reach < 0:
                continue
            values = np.flatnonzero(_NEAR[code[j]] <= reach)
            first, last = self.starts[j][values], self.starts[j][values + 1]
            n = last - first
            total = int(n.sum())
            if total:
                at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
                seen[self.order[j][at]] = True
        found = np.flatnonzero(seen)
        word = np.pad(code, (0, -len(code) % 8)).view(np.uint64)
        return found[np.bitwise_count(self.words[found] ^ word).sum(1) <= radius]


def usable(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, x``: rows whose vector is neither null, empty nor zero and holds only
    finite numbers, as doubles."""
    x = F.col(vector).cast("array<double>")
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), x.alias("x"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(F.col("x").isNotNull() & ~bad & F.exists("x", lambda v: v != 0))


def nearest(
    embeddings: DataFrame,
    k: int = 20,
    every: int = 20,
    radius: float = RADIUS,
    fit_rows: int = FIT_ROWS,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``
    the ``k`` rows with the largest inner product found, ties to the smaller id.

    Vectors get one more coordinate, so that all are as long as the longest and the
    largest inner product is the smallest angle.  Binary codes (a learned rotation's
    signs) split into substrings of eight bits, each with an index of its own.  Every
    vector is indexed, in segments; queries come in blocks, and each block searches each
    segment.  Probing retrieves every code within the radius; these are ranked by exact
    inner products in double precision.  If a query finds fewer than ``k`` in a segment,
    it searches this segment whole.

    Null, zero, empty vectors and such with null or non-finite components take no part,
    nor do rows without id; of vectors of several lengths, those of the most frequent
    one do.  A query's own id is never its neighbour; rows of one id are each a candidate
    for others.  An empty table gives no rows; other columns don't matter."""
    spark = embeddings.sparkSession
    small_batches(spark, 10_000)
    rows = stored(usable(embeddings, key, vector).where("vec_id is not null"), "vectors")
    sizes = rows.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max(_square("x")).alias("longest"))
    largest = sizes.orderBy(F.desc("rows"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if largest is None:
        return spark.createDataFrame([], schema)
    size, total, longest = largest["n"], largest["rows"], largest["longest"]
    rows = rows.where(F.size("x") == size)
    sample = rows.select("x", F.xxhash64("vec_id", "x").alias("h")).orderBy("h").limit(fit_rows).select("x").collect()
    mean, rotation = learn_codes(_longer(np.array([r["x"] for r in sample]), longest))
    bits = rotation.shape[1]
    reach = int(radius * bits)
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    segments = max(1, math.ceil(total / SEGMENT))
    blocks = max(1, math.ceil(queries.count() / BLOCK))
    stored_in = rows.withColumn("segment", F.pmod(F.xxhash64("vec_id"), F.lit(segments)).cast("int"))
    stored_in = stored_in.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))

    def search(_: tuple, index: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(block):
            x, ids = np.stack(index["x"].to_list()), index["vec_id"].to_numpy(np.int64)
            order = np.argsort(ids, kind="stable")
            x, ids = x[order], ids[order]
            tables = MultiIndex(codes(_longer(x, longest), mean, rotation))
            q, q_ids = np.stack(block["x"].to_list()), block["vec_id"].to_numpy(np.int64)
            q_codes = codes(_flat(q), mean, rotation)
            for vector_, own, code in zip(q, q_ids.tolist(), q_codes):
                found = tables.within(code, reach)
                found = found[ids[found] != own]
                if len(found) < k:
                    found = np.flatnonzero(ids != own)
                scores = x[found] @ vector_
                if len(found) > k:
                    least = np.partition(scores, -k)[-k]
                    near = scores >= least
                    found, scores = found[near], scores[near]
                best = np.lexsort((ids[found], -scores))[:k]
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids[found][best], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    pairs = stored_in.groupBy("segment", "block").cogroup(asked.groupBy("segment", "block"))
    found = pairs.applyInPandas(search, "query_id long, vec_id long, score double")
    ranked = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k).alias("best"))
    ranked = ranked.select("query_id", F.posexplode("best").alias("rank", "b"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.minus")).alias("score"))


def _square(column: str):
    return F.aggregate(column, F.lit(0.0), lambda total, v: total + v * v)


def _longer(x: np.ndarray, longest: float) -> np.ndarray:
    """x with a coordinate that brings every squared length to ``longest``."""
    rest = np.sqrt(np.maximum(0.0, longest - (x * x).sum(1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def _flat(x: np.ndarray) -> np.ndarray:
    """Queries have nothing in the added coordinate."""
    return np.concatenate([x, np.zeros((len(x), 1))], axis=1)
