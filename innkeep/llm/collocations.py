"""Frequent phrases and their cohesion, mined by SON partitioning."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from innkeep.llm.common import packed, scratch
from innkeep.session import stored

#: Slices of the corpus that are mined on their own, each by many tasks.  The support is a
#: fixed number, so every further slice lowers the local one towards one, where every
#: phrase is locally frequent, and leaves a task's chunks less to combine.
SHARDS = 2
#: Longest phrase, in words.
LONGEST = 4
#: Words a task gathers before it counts them, and bytes of a text split at once.
CHUNK_WORDS, WINDOW_BYTES = 1_000_000, 4 << 20
#: Bits of a filter per phrase, and its least and greatest number of bits (32 MB).
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28

_CUTS = b".,;:!?\n\x0b\x0c\r"
#: A-Z lower-cased, whatever ends a piece as a full stop.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _CUTS, b"abcdefghijklmnopqrstuvwxyz" + b"." * len(_CUTS))


def windows(text: bytes, most: int = WINDOW_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, and ``.`` between its pieces, in parts of about ``most`` bytes.

    Each part after the first starts with an empty word and as many of those before it as
    a phrase can reach back; no phrase ends in these a second time (``Chunk.fresh``)."""
    text = text.translate(_PLAIN)
    at, before = 0, [b"."] * (LONGEST - 1)
    while at < len(text) or not at:
        end = min((i for i in (text.find(b" ", at + most), text.find(b".", at + most)) if i >= 0), default=len(text))
        words = text[at:end].replace(b".", b" . ").split()
        yield [b"", *before, *words] if at else words
        before = (before + words)[-(LONGEST - 1) :]
        at = max(end, 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _longer(short: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases one word longer than those hashed in ``short``."""
    with np.errstate(over="ignore"):
        return _mixed(short * np.uint64(0x9E3779B97F4A7C15) + last)


class Chunk:
    """Words of one language and shard: numbers, and which places phrases can have."""

    def __init__(self, lang: str, parts: list[pa.Array]):
        coded = pa.chunked_array(parts).combine_chunks().dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary = coded.dictionary.to_pylist()
        stop, empty = (coded.dictionary.index(w).as_py() for w in (b".", b""))
        self.real = (self.ids != stop) & (self.ids != empty)
        # words repeated after an empty one were counted before: phrases may begin, not end there
        self.fresh = self.real.copy()
        resumed = np.flatnonzero(self.ids == empty) if empty >= 0 else np.zeros(0, np.int64)
        for back in range(1, LONGEST):
            at = resumed + back
            self.fresh[at[at < len(self.ids)]] = False
        hashed, seed = xxhash.xxh3_64_intdigest, xxhash.xxh3_64_intdigest(lang.encode())
        self.hashes = np.array([hashed(w, seed) for w in self.vocabulary], np.uint64)[self.ids]

    def places(self, n: int) -> np.ndarray:
        """Where phrases of n words are, as flags over all but the last n - 1 words."""
        size = max(0, len(self.ids) - n + 1)
        out = np.ones(size, bool)
        for i in range(n):
            out &= self.real[i : i + size]
        return out

    def counted(self, n: int) -> np.ndarray:
        """``places`` without those counted in the part of the text before."""
        return self.places(n) & self.fresh[n - 1 :] if len(self.ids) >= n else np.zeros(0, bool)

    def keys(self) -> Iterator[np.ndarray]:
        """The hashes of phrases of 1, 2, … words from every place on."""
        key = _mixed(self.hashes)
        yield key
        for n in range(2, LONGEST + 1):
            key = _longer(key[: max(0, len(self.ids) - n + 1)], self.hashes[n - 1 :])
            yield key


class KeyFilter:
    """A Bloom filter over 64-bit hashes, of four bits a key."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def bits(key: np.ndarray, size: int) -> Iterator[np.ndarray]:
        for turn in range(4):
            yield _mixed(key + np.uint64(turn)) & np.uint64(size - 1)

    def has(self, key: np.ndarray) -> np.ndarray:
        out = np.ones(len(key), bool)
        for bit in self.bits(key, len(self.words) * 64):
            at = np.flatnonzero(out)
            bit = bit[at]
            out[at] = self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1) == 1
        return out


def _with_shard(key: np.ndarray, shard: int) -> np.ndarray:
    return _mixed(key + np.uint64(shard * 0x51ED2701 + 1))


def key_filter(spark: SparkSession, keys: DataFrame, by_shard: bool) -> Broadcast:
    """A filter of ``keys`` (``shard, key``), at most ``MOST_BITS`` bits whatever their
    number: more keys let more phrases pass, which are then counted for nothing."""
    count = keys.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_KEY * count - 1).bit_length() if count else 0))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            key = key.astype(np.int64).view(np.uint64)
            if by_shard:
                for s in np.unique(shard):
                    key[shard == s] = _with_shard(key[shard == s], int(s))
            bit = np.concatenate(list(KeyFilter.bits(key, size)))
            word, mask = (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))
            order = np.argsort(word, kind="stable")
            starts = np.flatnonzero(np.diff(word[order], prepend=-1))
            merged = np.bitwise_or.reduceat(mask[order], starts) if len(starts) else mask
            yield pa.RecordBatch.from_arrays([pa.array(word[order][starts]), pa.array(merged.view(np.int64))], ["word", "mask"])

    rows = keys.select("shard", "key").mapInArrow(places, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    words = np.zeros(size // 64, np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(words)


def _per_chunk(documents: DataFrame, count: Callable, schema: str) -> DataFrame:
    """``count(lang, shard, chunk)`` of all words, in chunks of bounded size."""
    names = [part.split()[0] for part in schema.split(", ")]

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, shard), parts in held.items():
            for columns in count(lang, shard, Chunk(lang, parts)):
                yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0
        for batch in batches:
            for lang, shard, text in zip(*(batch.column(i) for i in range(3))):
                for words in windows(text.as_buffer().to_pybytes()):
                    held.setdefault((lang.as_py(), shard.as_py()), []).append(pa.array([*words, b"."], pa.binary()))
                    size += len(words) + 1
                    if size >= CHUNK_WORDS:
                        yield from flush(held)
                        held, size = {}, 0
        yield from flush(held)

    return documents.select("lang", "shard", "text").mapInArrow(run, schema)


def _counted(shard: int, keys: np.ndarray) -> list[pa.Array]:
    key, n = np.unique(keys, return_counts=True)
    return [pa.array(np.full(len(key), shard, np.int32)), pa.array(key.view(np.int64)), pa.array(n)]


def locally_frequent(documents: DataFrame, support: int, shards: int) -> DataFrame:
    """``shard, key``: hashes of the phrases that reach their shard's share of ``support``.

    A shard's share is that of its bytes of text.  Shares sum to one, so a phrase with
    ``support`` occurrences reaches its part of them in one shard at least.  Phrases of
    three or more words are counted where each two neighbours in them are frequent in
    that shard.  Equal hashes of unlike phrases add candidates, and lose none."""
    sizes = {r["shard"]: r["size"] for r in documents.groupBy("shard").agg(F.sum(F.octet_length("text") + 1).alias("size")).collect()}
    total = sum(sizes.values())
    least = [max(1, -(-support * sizes.get(s, 0) // total)) if total else 1 for s in range(shards)]
    enough = F.element_at(F.array(*[F.lit(n).cast("long") for n in least]), F.col("shard") + 1)

    def short(lang: str, shard: int, chunk: Chunk) -> Iterator[list[pa.Array]]:
        for n, key in zip((1, 2), chunk.keys()):
            yield _counted(shard, key[chunk.counted(n)])

    def frequent(count: Callable, name: str) -> DataFrame:
        local = _per_chunk(documents, count, "shard int, key long, n long").groupBy("shard", "key").agg(F.sum("n").alias("n"))
        return packed(local.where(F.col("n") >= enough).select("shard", "key"), name)

    pairs = frequent(short, "phrases-short")
    if LONGEST == 2:
        return pairs
    known = key_filter(documents.sparkSession, pairs, by_shard=True)

    def long(lang: str, shard: int, chunk: Chunk) -> Iterator[list[pa.Array]]:
        keys = list(chunk.keys())
        linked = chunk.places(2)
        linked[linked] = KeyFilter(known.value).has(_with_shard(keys[1][linked], shard))
        for n in range(3, LONGEST + 1):
            keep = chunk.counted(n)
            for i in range(n - 1):
                keep &= linked[i : i + len(keep)]
            yield _counted(shard, keys[n - 1][keep])

    return pairs.unionByName(frequent(long, "phrases-long"))


def phrase_counts(documents: DataFrame, candidates: DataFrame) -> DataFrame:
    """``lang, phrase, n``: exact numbers of occurrences of every candidate in all texts,
    and under a null phrase each language's number of words.  Phrases that the filter of
    candidates lets pass by chance are counted just as exactly."""
    known = key_filter(documents.sparkSession, candidates.select(F.lit(0).alias("shard"), "key").distinct(), by_shard=False)

    def count(lang: str, shard: int, chunk: Chunk) -> Iterator[list[pa.Array]]:
        chosen = KeyFilter(known.value)
        yield [pa.array([lang]), pa.array([None], pa.string()), pa.array([int(chunk.fresh.sum())], pa.int64())]
        at = np.arange(len(chunk.ids))
        numbers = np.zeros(len(at), np.int64)  # of the phrases one word shorter
        for n, key in enumerate(chunk.keys(), 1):
            # the first words of a candidate are a candidate, so other places drop out
            at, numbers = at[at < len(key)], numbers[at < len(key)]
            held = chunk.places(n)[at]
            held[held] = chosen.has(key[at[held]])
            at, numbers = at[held], numbers[held]
            _, first, numbers = np.unique((numbers << 32) | chunk.ids[at + n - 1], return_index=True, return_inverse=True)
            total = np.bincount(numbers[chunk.fresh[at + n - 1]], minlength=len(first))
            found = np.flatnonzero(total)
            ids = chunk.ids[at[first[found]][:, None] + np.arange(n)].tolist()
            texts = [b" ".join(map(chunk.vocabulary.__getitem__, x)).decode("utf-8", "replace") for x in ids]
            yield [pa.array([lang] * len(texts), pa.string()), pa.array(texts, pa.string()), pa.array(total[found].astype(np.int64))]

    # shards are one here, so that a chunk has fewer phrases of its own
    counted = _per_chunk(documents.withColumn("shard", F.lit(0)), count, "lang string, phrase string, n long")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _part(first: str, length: str):
    return F.expr(f"array_join(slice(words, {first}, {length}), ' ')")


def collocations(
    documents: DataFrame,
    support: int = 30,
    top: int = 2000,
    covered: int = 80,
    shards: int = SHARDS,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of two to
    four words that occur at least ``support`` times, by cohesion.

    Texts are lower-cased in A-Z and split into pieces at ``.,;:!?`` and line ends; a
    phrase lies within a piece, and its occurrences may overlap.  A phrase of ``a``
    occurrences, cut in two parts that occur ``l`` and ``r`` times, scores
    floor(2000000 a / (l + r)); the lowest cut counts, of equal ones the first.  Phrases
    inside a longer candidate that has ``covered`` percent of their occurrences go.
    ``n`` is the language's number of words.  Products are exact decimals.

    SON partitioning: shards are slices of the corpus, each mined completely by as many
    tasks as it needs, at its share of the support; the union of locally frequent phrases
    is counted over all texts exactly.  Tasks count chunks of bounded size; counts are
    combined before each shuffle, so neither a common phrase nor a large group of equal
    documents gathers in one task.  Only filters of bounded size are broadcast.

    A null language is ``und``; null and empty texts have no words; rows that repeat
    count as often as they are there, and the id serves only to deal out shards.  Equal
    score and a are ordered by the phrase's bytes.  Very long texts are split in windows.
    An empty table gives no rows; other columns don't matter."""
    chosen = documents.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64(F.col(key), F.octet_length(F.col(text))), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    with scratch(documents.sparkSession):
        counts = packed(phrase_counts(chosen, locally_frequent(chosen, support, shards)).where(F.col("phrase").isNull() | (F.col("n") >= support)), "phrase-counts")
        return stored(_ranked(counts, top, covered), "collocations")


def _ranked(counts: DataFrame, top: int, covered: int) -> DataFrame:
    phrases = counts.where(F.col("phrase").isNotNull()).withColumn("words", F.split("phrase", " "))
    candidates = phrases.where(F.size("words") >= 2).withColumnRenamed("n", "a")
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
    sides = cuts.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    sides = sides.withColumn("part", F.when(F.col("side") == 0, _part("1", "k")).otherwise(_part("k + 1", "size(words) - k")))
    joined = sides.join(parts, ["lang", "part"]).groupBy("lang", "phrase", "a", "k")
    cut = joined.agg(F.max(F.when(F.col("side") == 0, F.col("part_n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("part_n"))).alias("r"))
    exact = F.expr("cast(2000000 as decimal(8,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cut.withColumn("score", exact.cast("long")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inside = (
        candidates.where(F.size("words") > 2)
        .withColumn("length", F.explode(F.expr("sequence(2, size(words) - 1)")))
        .withColumn("start", F.explode(F.expr("sequence(1, size(words) - length + 1)")))
        .select("lang", _part("start", "length").alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    hidden = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {int(covered)}")
    open_ = best.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~hidden)
    totals = counts.where(F.col("phrase").isNull()).select("lang", F.col("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    first = open_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")
    )
