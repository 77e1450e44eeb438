"""Hard negatives by exact integer scores from residue-number-system products."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from innkeep.llm.common import packed, scratch
from innkeep.session import stored

#: Anchors and rows that meet in one tile of all scores, and scores held at once (8 MB).
TILE, CELLS = 16_384, 1 << 20
#: Components multiplied before their sums are reduced again.
WIDTH = 64
#: Whole numbers up to here are exact in float32, and products of moduli in 64-bit sums.
_FLOAT32, _INT64 = 1 << 24, 1 << 51
_LONG = (-(2**63), 2**63 - 1)
#: The largest finite number in single precision.
_LARGEST = 3.4028234663852886e38


def moduli(bound: int) -> list[int]:
    """The fewest of the largest usable primes whose product tells all whole numbers from
    -bound to bound apart.  Residues lie around zero, so WIDTH products of two of them
    stay exact in float32."""
    largest = 2 * math.isqrt((_FLOAT32 - 1) // WIDTH) + 1
    out, product, candidate = [], 1, largest
    while product <= 2 * bound:
        if all(candidate % d for d in range(2, math.isqrt(candidate) + 1)):
            out.append(candidate)
            product *= candidate
        candidate -= 1
    return out


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, the nearest to zero, in float32.  x holds whole numbers as doubles."""
    r = np.fmod(x, p)
    half = p // 2
    r[r > half] -= p
    r[r < -half] += p
    return r.astype(np.float32)


class Scorer:
    """Exact inner products of whole-number vectors with the rows of ``left``.

    The matrices are multiplied modulo several small primes in float32; the Chinese
    remainder theorem gives the signed products, in 64 bits where these hold them and
    in Python's whole numbers where not."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.largest = int(np.abs(left).max(initial=0))
        self.parts: dict[int, list[np.ndarray]] = {}

    def _left(self, p: int) -> list[np.ndarray]:
        if p not in self.parts:
            r = residues(self.left, p)
            self.parts[p] = [r[:, i : i + WIDTH] for i in range(0, r.shape[1], WIDTH)]
        return self.parts[p]

    def products(self, right: np.ndarray, p: int) -> np.ndarray:
        """``left @ right.T`` modulo p, nearest to zero."""
        whole = residues(right, p)
        total = np.zeros((len(self.left), len(right)), np.float32)
        for i, part in enumerate(self._left(p)):
            total += part @ whole[:, i * WIDTH : (i + 1) * WIDTH].T
            total -= p * np.rint(total / p)
        return total

    def scores(self, right: np.ndarray) -> np.ndarray:
        bound = self.left.shape[1] * self.largest * int(np.abs(right).max(initial=0))
        primes = moduli(max(1, bound))
        m = math.prod(primes)
        kind = np.int64 if m <= _INT64 else object
        total = np.zeros((len(self.left), len(right)), kind)
        for p in primes:
            rest = m // p
            weight = rest * pow(rest, -1, p) % m
            r = self.products(right, p).astype(np.int64)
            r[r < 0] += p
            # the weight is rest times a number below p: so is the product, modulo m
            total += (r * (weight // rest) % p).astype(kind) * rest
        total %= m
        total[total > m // 2] -= m
        return total if kind is np.int64 else np.clip(total, *_LONG)


def usable(embeddings: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, x``: rows that take part, components as they are."""
    x = F.col(vector).cast("array<double>")
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), x.alias("x"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > _LARGEST))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~bad)


def _matrix(table: pa.Table, scale: int, width: int) -> np.ndarray:
    """The vectors of a table as rows of whole numbers, with zeros up to ``width``."""
    column = table.column("x").combine_chunks()
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < ends[:, None]] = np.floor(flat * scale)
    return out


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores of each group, ties to smaller ids."""
    by_id = np.argsort(ids, kind="stable")
    by_score = by_id[np.argsort(-score[by_id], kind="stable")]
    order = by_score[np.argsort(group[by_score], kind="stable")]
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


class _Best:
    """The k best (score, id) of each of n groups, from any number of batches."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, _LONG[0], np.int64)
        self.group = self.score = self.ids = np.zeros(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        group, score, ids = (np.concatenate(pair) for pair in ((self.group, group), (self.score, score), (self.ids, ids)))
        chosen = _first(group, score, ids, self.k)
        self.group, self.score, self.ids = group[chosen], score[chosen], ids[chosen]
        full = np.flatnonzero(np.bincount(self.group, minlength=len(self.floor)) >= self.k)
        lowest = np.full(len(self.floor), _LONG[1], np.int64)
        np.minimum.at(lowest, self.group, self.score)
        self.floor[full] = lowest[full]


def tiles(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, tile: int, tasks: int):
    """Segments of rows and blocks of anchors: groups that meet in ``cogroup``."""
    segments = max(1, math.ceil(n_rows / tile), tasks if n_rows > tasks else 1)
    blocks = max(1, math.ceil(n_anchors / tile))
    dealt = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(n)).cast("int")
    left = anchors.withColumn("block", dealt(blocks, 1)).withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))
    right = rows.withColumn("segment", dealt(segments, 2)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("segment", "block").cogroup(right.groupBy("segment", "block"))


def _scored(left: pa.Table, right: pa.Table, scale: int, width: int) -> Iterator[tuple]:
    """``scores, labels, ids`` of the rows of ``right``, some at a time, against ``left``."""
    scorer = Scorer(_matrix(left, scale, width))
    step = max(1, CELLS // max(1, left.num_rows))
    for start in range(0, right.num_rows, step):
        some = right.slice(start, step)
        scores = scorer.scores(_matrix(some, scale, width)).astype(np.int64)
        yield scores, *(some.column(c).to_numpy() for c in ("label", "vec_id"))


def hard_negatives(
    embeddings: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
    scale: int = 256,
    tile: int = TILE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components x become floor(scale x); a row's score is its whole-number inner product
    with an anchor (a row for which ``anchor`` holds, on columns ``vec_id``, ``label``).  An anchor's
    positives are the best ``positives`` other ids of its label.  For each of them, the
    best ``negatives`` rows of other labels whose score lies in the window, in percent
    of the positive's, are its negatives.  Higher scores come first, ties by smaller id.

    Scores come from products modulo small primes in float32 and Chinese remaindering,
    so they are exact.  Every anchor meets every row, in tiles of ``tile`` by ``tile``
    at most; a tile keeps the best of each anchor, and these are cut again before and
    after one small shuffle.  The first pass finds positives, the second negatives.

    Rows without id, label or vector, or with a component that is null or not finite
    in single precision, take no part.  Shorter vectors count as filled up with zeros, an
    empty one scores 0.  Rows that share an id each take part; a repeated anchor gives
    its rows again, and no row of an anchor's own id is its positive.  Scores beyond 64
    bits count as the nearest long.  A negative positive score has an empty window.
    An empty table, or one without anchors, gives no rows; other columns don't matter."""
    spark = embeddings.sparkSession
    low, high = window
    with scratch(spark):
        rows = packed(usable(embeddings, key, vector, label).withColumn("row", F.monotonically_increasing_id()), "vectors")
        anchors = rows.where(anchor).select(*[F.col(c).alias(c) for c in rows.columns])
        sizes = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.count(F.when(anchor, 1))).first()
        n_rows, width, n_anchors = sizes[0], sizes[1] or 0, sizes[2]
        tasks = spark.sparkContext.defaultParallelism

        def near(left: pa.Table, right: pa.Table) -> pa.Table:
            best = _Best(left.num_rows, positives)
            own_label, own_id = (left.column(c).to_numpy() for c in ("label", "vec_id"))
            for scores, labels, ids in _scored(left, right, scale, width):
                a, r = np.nonzero((own_label[:, None] == labels) & (own_id[:, None] != ids) & (scores >= best.floor[:, None]))
                best.add(a, scores[a, r], ids[r])
            found = {"anchor": left.column("row").to_numpy()[best.group], "anchor_id": own_id[best.group], "positive_id": best.ids, "score": best.score}
            return pa.table(found)

        schema = "anchor long, anchor_id long, positive_id long, score long"
        met = tiles(rows, anchors, n_rows, n_anchors, tile, tasks).applyInArrow(near, schema)
        order = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id")
        chosen = packed(met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives")
        listed = chosen.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "score"))).alias("own"))
        wanted = anchors.join(listed.withColumnRenamed("anchor", "row"), "row")

        def hard(left: pa.Table, right: pa.Table) -> pa.Table:
            own = left.column("own").combine_chunks()
            counts, flat = own.value_lengths().to_numpy(), own.flatten()
            owner = np.repeat(np.arange(left.num_rows), counts)
            place, mate, top = (flat.field(i).to_numpy().astype(np.int64) for i in range(3))
            # low % of the positive's score, rounded up; beyond a long's hundredth in Python's numbers
            least = np.array([max(_LONG[0], -(-low * t // 100)) for t in top.tolist()], np.int64)
            most = np.array([min(_LONG[1], high * t // 100) for t in top.tolist()], np.int64)
            best = _Best(len(owner), negatives)
            own_label = left.column("label").to_numpy()
            for scores, labels, ids in _scored(left, right, scale, width):
                other = own_label[:, None] != labels
                for n in range(1, positives + 1):
                    which = np.flatnonzero(place == n)
                    s = scores[owner[which]]
                    inside = (s >= np.maximum(least[which], best.floor[which])[:, None]) & (s <= most[which][:, None])
                    p, r = np.nonzero(inside & other[owner[which]])
                    best.add(which[p], s[p, r], ids[r])
            g = best.group
            anchor_row, anchor_id = (left.column(c).to_numpy()[owner[g]] for c in ("row", "vec_id"))
            found = {"anchor": anchor_row, "place": place[g], "anchor_id": anchor_id, "positive_id": mate[g], "positive_score": top[g]}
            return pa.table(found | {"negative_id": best.ids, "negative_score": best.score})

        schema = "anchor long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
        met = tiles(rows, wanted, n_rows, n_anchors, tile, tasks).applyInArrow(hard, schema)
        order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
        ranked = met.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= negatives)
        names = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        return stored(ranked.select(*names), "hard-negatives")
