"""Line dedup by sharded minimal perfect hashes over line hashes."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import NO_ID, packed, scratch, small_batches
from innkeep.session import stored

BLANKS = " \t\n\x0b\x0c\r"
#: Line hashes indexed by one shard, and line references probed by one group.
KEYS_PER_SHARD, PROBES_PER_GROUP = 100_000, 100_000


def line_key(line: str) -> str:
    """A line's key: without ASCII blanks at both ends, A-Z lower-cased."""
    return line.strip(BLANKS).encode().lower().decode()


def _key_hashes(text: str, least: int) -> list[tuple[int, int]]:
    """(hash, position) of each line whose key is long enough, as signed longs."""
    out = []
    for i, line in enumerate(text.split("\n")):
        key = line.strip(BLANKS)
        if len(key) >= least:
            out.append((xxhash.xxh3_128_intdigest(key.encode().lower()), i))
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


_LOW = (1 << 64) - 1


class PerfectHash:
    """A minimal perfect hash over 64-bit keys, as rank over bit arrays.

    On each level a key sets a bit of its own or goes, with those that want the same
    bit, to the next level.  A key's index is the number of bits set before its own."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = [np.concatenate([[0], np.cumsum(bits)])[:-1] for bits in levels]
        self.sizes = np.concatenate([[0], np.cumsum([int(bits.sum()) for bits in levels])])

    @staticmethod
    def place(keys: np.ndarray, level: int, width: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (keys ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & _LOW)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(width)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` must be distinct."""
        levels, left = [], keys
        while len(left):
            width = 2 * len(left) + 1
            at = cls.place(left, len(levels), width)
            alone = np.bincount(at, minlength=width) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Each key's index, or -1; a foreign key may get any index."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = self.place(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = self.sizes[level] + self.before[level][at[hit]]
            left = left[~hit]
        return out

    def dump(self) -> list[bytes]:
        return [np.packbits(bits).tobytes() + len(bits).to_bytes(8, "little") for bits in self.levels]

    @classmethod
    def load(cls, levels: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(x[:-8], np.uint8), count=int.from_bytes(x[-8:], "little")).astype(bool) for x in levels])


def line_references(documents: DataFrame, least: int) -> DataFrame:
    """``hash, mark, id, row``: a row for each distinct long enough key of a text.
    hash and mark are the halves of its 128-bit hash, row is the text's hash."""

    def refer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for value in {h for h, _ in _key_hashes(text, least)}:
                    out.append((_signed(value & _LOW), _signed(value >> 64), doc, row))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["hash", "mark", "id", "row"])

    return documents.select("id", "row", "text").mapInArrow(refer, "hash long, mark long, id long, row long")


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values(["hash", "mark"]).drop_duplicates("hash")
    keys = shard["hash"].to_numpy(np.int64).view(np.uint64)
    perfect = PerfectHash.build(keys)
    order = np.argsort(perfect.index(keys))
    column = lambda name: shard[name].to_numpy(np.int64)[order].tobytes()
    return pd.DataFrame(
        {"shard": [int(shard["shard"].iloc[0])], "levels": [perfect.dump()], "marks": [column("mark")], "owners": [column("owner")], "counts": [column("n_rows")]}
    )


def line_index(references: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the perfect hash over the hashes of keys found in at least two
    documents, and by its index their fingerprints, smallest ids and numbers of rows."""
    found = references.groupBy("hash", "mark").agg(F.min("id").alias("owner"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n_rows"))
    found = found.where("owner < last").withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))
    schema = "shard int, levels array<binary>, marks binary, owners binary, counts binary"
    return found.groupBy("shard").applyInPandas(_build, schema)


def _probe(_: tuple, references: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    none = pd.DataFrame({"id": pd.Series(dtype="int64"), "row": pd.Series(dtype="int64"), "hash": pd.Series(dtype="int64")})
    if not len(references) or not len(index):
        return none
    entry = index.iloc[0]
    marks, owners = np.frombuffer(entry["marks"], np.int64), np.frombuffer(entry["owners"], np.int64)
    at = PerfectHash.load(list(entry["levels"])).index(references["hash"].to_numpy(np.int64).view(np.uint64))
    known = (at >= 0) & (marks[at] == references["mark"].to_numpy(np.int64))
    return references.loc[known & (owners[at] != references["id"].to_numpy(np.int64)), ["id", "row", "hash"]]


def line_drops(documents: DataFrame, least: int) -> DataFrame:
    """``id, row, drops``: hashes of the keys that a text loses."""
    references = packed(line_references(documents, least), "line-references")
    count = references.count()
    shards = max(1, math.ceil(count / KEYS_PER_SHARD))
    references = references.withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))
    index = packed(line_index(references.drop("shard"), shards), "line-index")
    # a shard with a very common line is probed by more groups, each with a copy of its arrays
    load = references.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    load = packed(load.select("shard", F.ceil(F.col("n") / PROBES_PER_GROUP).cast("int").alias("groups")), "line-load")
    probes = references.join(load, "shard")
    probes = probes.withColumn("salt", F.pmod(F.xxhash64("id", "row"), F.col("groups")).cast("int")).drop("groups")
    copies = index.join(load, "shard").withColumn("salt", F.explode(F.expr("sequence(0, groups - 1)"))).drop("groups")
    probed = probes.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
    dropped = probed.applyInPandas(_probe, "id long, row long, hash long")
    return dropped.groupBy("id", "row").agg(F.collect_set("hash").alias("drops"))


def _keep(least: int):
    @F.pandas_udf("n_lines long, n_dropped long, kept string")
    def keep(text: pd.Series, drops: pd.Series) -> pd.DataFrame:
        out = []
        for whole, gone in zip(text, drops):
            n = whole.count("\n") + 1
            if gone is None or not len(gone):
                out.append((n, 0, whole))
                continue
            gone = set(gone.tolist() if hasattr(gone, "tolist") else gone)
            bad = {i for value, i in _key_hashes(whole, least) if _signed(value & _LOW) in gone}
            out.append((n, len(bad), "\n".join(line for i, line in enumerate(whole.split("\n")) if i not in bad)))
        return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])

    return keep


def dedup_lines(documents: DataFrame, least: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``documents`` in a struct ``row``, with ``n_lines, n_dropped, kept``.

    A text is split at newlines; null or empty text is one empty line.  Lines with
    equal keys (see ``line_key``) of at least ``least`` code points, found in two or
    more documents, stay only in the smallest id; there every occurrence stays.

    Line hashes go to shards.  A shard indexes the hashes of shared keys by a minimal
    perfect hash; its index leads into arrays of fingerprints, owners and counts.  The
    documents' hashes probe the arrays; no lines are joined or moved.  A very common
    line makes its shard be probed by several groups.

    Rows with one id are one document (and null ids together one, after all others):
    they don't drop lines of one another.  An empty table gives no rows; extra columns
    are kept in ``row``, where no name can clash."""
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.select(
        F.struct("*").alias("row_"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("row", F.xxhash64("text"))
    with scratch(spark):
        drops = stored(line_drops(rows, least), "line-drops")
    joined = rows.join(drops, ["id", "row"], "left")
    return joined.select(F.col("row_").alias("row"), _keep(least)("text", "drops").alias("o")).select("row", "o.*")


def sha256_text(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
