"""N-gram Jaccard join by rarest shingles and parity sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import WORD, maybe_broadcast, packed, release, scratch, small_batches
from innkeep.session import stored

#: Words whose hashes a worker remembers at once.
REMEMBERED = 200_000
#: Words of a folded sketch.
FOLD = 64
#: Bytes of a token.  Two that are equal by chance cost a comparison, nothing else.
TOKEN_BYTES = 6
#: Tokens that are counted by one task's group, and held at once where they are dealt, about.
COUNTED, HELD = 1_000_000, 400_000
#: Parts that are dealt in one round, and rounds at most.  With many parts nearly every
#: token is sent with a set of its own; rounds keep a share of that on disk at a time.
ROUND_PARTS, ROUNDS = 500, 4
#: Tokens that a part tells apart, at most 2**32; the others are equal by chance.
TOLD_APART = 2**32
#: Sets looked at, about, for tokens that very many have; more than this share of them
#: counts so, and more than this number.
LOOKED_AT, FREQUENT_SHARE, FREQUENT = 2000, 0.02, 20
#: Where the order puts frequent tokens, and the largest number of rows it tells apart.
LAST = 2**15 - 1
#: Buckets up to this size give all their pairs; larger ones are compared in blocks of
#: about so many sets, and so many rows make up one task's group.
SMALL, BLOCK, GROUP_ROWS = 16, 1000, 20_000

_U = np.uint64
_MULTIPLIERS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_hashes(text: str, width: int, known: dict | None = None) -> np.ndarray:
    """Hashes of the distinct shingles, ascending.  Words are runs without ASCII blanks,
    A-Z lower-cased; fewer than ``width`` of them are one shingle, no words are none."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map((known if known is not None else _Hashes()).__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    out = np.zeros(len(h) - span + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(span):
            out = _mix(out ^ h[i : len(h) - span + 1 + i]) * _MULTIPLIERS[i % 4]
        if span < width:
            out = _mix(out ^ _U(span))
    return np.unique(out)


def folded(hashes: np.ndarray) -> np.ndarray:
    """The parity sketch: every hash flips one bit.  Two sketches differ in at most as
    many bits as the sets have elements not in common."""
    out = np.zeros(FOLD, np.uint64)
    np.bitwise_xor.at(out, ((hashes >> _U(32)) % _U(FOLD)).astype(np.int64), _U(1) << ((hashes >> _U(16)) & _U(63)))
    return out


def token_bytes(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens, "<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def tokens_of(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // TOKEN_BYTES, 8), np.uint8)
    out[:, :TOKEN_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    return out.view("<u8").ravel()


def set_id(hashes: np.ndarray) -> int:
    """One number for the set, as a signed long; equal sets have equal numbers."""
    with np.errstate(over="ignore"):
        a = int(_mix(hashes ^ _MULTIPLIERS[2]).sum(dtype=np.uint64))
    return xxhash.xxh3_64_intdigest(hashes.tobytes() + a.to_bytes(8, "little")) - (1 << 63)


def sketched(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, hash, n, set, tokens``: the given hash of the text, set sizes, equal sets'
    number, and the shingles' hashes, shortened; the latter once for each set and task."""
    names = ["doc_id", "hash", "n", "set", "tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = _Hashes(), set()
        for batch in batches:
            sizes, sets, own = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_hashes(text, width, known)
                number = set_id(hashes)
                sizes.append(len(hashes))
                sets.append(number)
                own.append(b"" if number in seen else token_bytes(hashes >> _U(64 - 8 * TOKEN_BYTES)))
                seen.add(number)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(sets, pa.int64()), pa.array(own, pa.binary())], names)

    return documents.mapInArrow(work, "doc_id long, hash long, n long, set long, tokens binary")


def _agree(n: str) -> str:
    """How many tokens the prefix of a set of size ``n`` is to share with any similar one's."""
    return f"(1 + least(3, {n} div 20))"


def _frequent(sketches: DataFrame) -> np.ndarray:
    """Tokens that many of a bounded number of sets have.  They come last in the order,
    and need no counting; which ones are found has no influence on the result."""
    step = sketches.count() // LOOKED_AT + 1
    some = sketches.where(f"length(tokens) > 0 and pmod(set, {step}) = 0").select("tokens")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = tokens_of(b"".join(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], ["token"])

    by = some.mapInArrow(listed, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("rows"))
    least = max(FREQUENT, FREQUENT_SHARE * some.count())
    return np.array(sorted(r["token"] for r in by.where(F.col("rows") > least).collect()), np.int64).view(np.uint64)


def _lost(tokens: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The row of each token that is equal to another one in its row."""
    with np.errstate(over="ignore"):
        mixed = np.sort(tokens * _MULTIPLIERS[0] + row.astype(np.uint64) * _MULTIPLIERS[1])
    if not (mixed[1:] == mixed[:-1]).any():
        return row[:0]
    order = np.lexsort((tokens, row))
    tokens, row = tokens[order], row[order]
    return row[1:][(tokens[1:] == tokens[:-1]) & (row[1:] == row[:-1])]


def _dealt(sketches: DataFrame, parts: int, frequent: np.ndarray, turn: int = 0, rounds: int = 1) -> DataFrame:
    """``part, sets, firsts, tokens`` of the parts whose turn it is: the tokens by part,
    four bytes for each, with the sets they are from and a bit at the first token of each
    set.  What remains of a token in its part is its quotient.  Frequent tokens, as places
    in their list, are dealt by their sets to as many parts of their own.  One more part
    has a row for each token of a set that became equal to another one of the set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                held.append(row)
                count += len(row[1]) // TOKEN_BYTES
                if count >= HELD:
                    yield deal(held)
                    held, count = [], 0
        if held:
            yield deal(held)

    def deal(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        sets = np.array([r[0] for r in held], np.int64)
        tokens = tokens_of(b"".join(r[1] for r in held)) % _U(parts * TOLD_APART)
        row = np.repeat(np.arange(len(held)), [len(r[1]) // TOKEN_BYTES for r in held])
        lost = _lost(tokens, row)
        value, part = np.divmod(tokens, _U(parts))
        part = part.astype(np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
            often = frequent[at] == tokens
            value[often] = at[often]
            part[often] = parts + sets[row[often]] % parts
        if rounds > 1:
            now = part % rounds == turn
            value, row, part = value[now], row[now], part[now]
        order = np.argsort(part, kind="stable")
        value, row, part = value[order].astype("<u4"), row[order], part[order]
        out, starts = [], np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        for x, y in zip(starts, [*starts[1:], len(part)]):
            first = np.diff(row[x:y], prepend=-1) != 0
            out.append((int(part[x]), sets[row[x:y][first]].tobytes(), np.packbits(first).tobytes(), value[x:y].tobytes()))
        if len(lost) and 2 * parts % rounds == turn:
            out.append((2 * parts, sets[lost].tobytes(), np.packbits(lost >= 0).tobytes(), bytes(4 * len(lost))))
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i else pa.int32()) for i, c in enumerate(columns)], ["part", "sets", "firsts", "tokens"])

    rows = sketches.where("length(tokens) > 0").select("set", "tokens")
    return rows.mapInArrow(work, "part int, sets binary, firsts binary, tokens binary")


def _shared(dealt: DataFrame, parts: int, frequent: np.ndarray) -> DataFrame:
    """``set, place``: the tokens that several sets have.  A place holds a token and,
    above it, its rows, so that it is its place in the order, rarest first.  For each
    token that became equal to another one of its set there is a place of -1."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        tokens = np.frombuffer(b"".join(group["tokens"]), "<u4")
        bits = [np.unpackbits(np.frombuffer(f, np.uint8), count=len(t) // 4) for f, t in zip(group["firsts"], group["tokens"])]
        row = np.cumsum(np.concatenate(bits), dtype=np.int32) - 1
        sets = np.frombuffer(b"".join(group["sets"]), np.int64)[row]
        if part == 2 * parts:
            return pd.DataFrame({"set": sets, "place": np.full(len(sets), -1)})
        if part >= parts:
            return pd.DataFrame({"set": sets, "place": LAST << 8 * TOKEN_BYTES | frequent[tokens].view(np.int64)})
        order = np.argsort(tokens, kind="stable")
        tokens, sets = tokens[order], sets[order]
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        rows = np.diff(np.append(starts, len(tokens)))
        # copies of one set in several tasks don't make its tokens common
        several = np.repeat(np.minimum.reduceat(sets, starts) != np.maximum.reduceat(sets, starts), rows)
        rows = np.repeat(np.minimum(rows, LAST), rows)[several]
        tokens = tokens[several].astype(np.int64) * parts + part
        return pd.DataFrame({"set": sets[several], "place": rows.astype(np.int64) << 8 * TOKEN_BYTES | tokens})

    return dealt.groupBy("part").applyInPandas(count, "set long, place long")


def prefixes(sketches: DataFrame, percent: int) -> DataFrame:
    """``set, at, token``: for each set those of its first n - o + k tokens that another
    set has too.  The order is by the number of rows that have a token, rarest first, so
    that what many texts share comes last; ``at`` counts from 0.

    Similar sets share at least o = n * percent / 100 tokens, n being either's size, so
    that under any common order these first tokens have the smaller k in common.  A set
    left with fewer than k shared ones is similar to no other and gives no rows.  Of a
    set's tokens that are equal by chance one is left, and o is less by the others."""
    total = sketches.agg(F.sum(F.length("tokens"))).first()[0] or 0
    parts = total // TOKEN_BYTES // COUNTED + 1
    frequent = np.unique(_frequent(sketches) % _U(parts * TOLD_APART))
    rounds, found = min(ROUNDS, parts // ROUND_PARTS + 1), None
    for turn in range(rounds):
        some = packed(_shared(_dealt(sketches, parts, frequent, turn, rounds), parts, frequent), "shared-tokens")
        release(sketches.sparkSession)
        found = some if found is None else found.unionByName(some)
    sizes = sketches.where("length(tokens) > 0").select("set", F.lit(None).cast("long").alias("place"), "n")
    rows = found.withColumn("n", F.lit(None).cast("long")).unionByName(sizes)
    places = F.collect_list(F.when(F.col("place") >= 0, F.col("place")))
    per = rows.groupBy("set").agg(F.max("n").alias("n"), F.count_if(F.col("place") < 0).alias("lost"), F.array_distinct(F.sort_array(places)).alias("found"))
    per = per.withColumn("keep", F.expr(f"cast(size(found) - (n * {percent} + 99) div 100 + lost + {_agree('n')} as int)"))
    first = F.posexplode(F.expr("slice(found, 1, keep)")).alias("at", "place")
    kept = per.where(f"keep >= {_agree('n')}").select("set", first)
    token = F.col("place").bitwiseAND(2 ** (8 * TOKEN_BYTES) - 1).alias("token")
    return packed(kept.select("set", "at", token), "prefixes")


def buckets(prefix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where sets meet: ``a, b, times`` of the pairs that are alone in buckets, and
    ``token, set, size`` of the buckets with more sets."""
    seen = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("set").alias("a"), F.max("set").alias("b"))
    seen = packed(seen.where("size > 1"), "bucket-sizes")
    pairs = packed(seen.where("size = 2").groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")), "bucket-pairs")
    members = prefix.join(seen.where("size > 2").select("token", "size"), "token")
    return pairs, packed(members.select("token", "set", "size"), "buckets")


def _folds(sketches: DataFrame, prefix: DataFrame) -> DataFrame:
    """``set, n, fold`` of the sets that have a prefix."""
    wanted = prefix.where("at = 0").select("set")
    own = sketches.where("length(tokens) > 0").join(maybe_broadcast(wanted, wanted.count()), "set", "left_semi")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = [folded(tokens_of(data) << _U(64 - 8 * TOKEN_BYTES)).view(np.int64) for data in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(folds, pa.list_(pa.int64()))], ["set", "n", "fold"])

    out = own.select("set", "n", "tokens").mapInArrow(fold, "set long, n long, fold array<long>")
    return packed(out.dropDuplicates(["set"]), "folds")


def _close(a: str, b: str, percent: int) -> Column:
    """Whether two sets can be similar by their sizes and folded sketches, which differ
    in no more bits than the sets have elements not in common."""
    differ = f"aggregate(zip_with({a}.fold, {b}.fold, (p, q) -> bit_count(p ^ q)), 0, (total, x) -> total + cast(x as int))"
    bound = f"({100 - percent} * ({a}.n + {b}.n)) div {100 + percent}"
    return F.expr(f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n) and {differ} <= {bound}")


def _small_pairs(pairs: DataFrame, members: DataFrame, folds: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets that meet in enough small buckets and can be similar.  Similar sets
    meet in k buckets; if one of these is large, they are compared there."""
    small = members.where(f"size <= {SMALL}").select("token", F.col("set").alias("a"))
    met = small.join(small.withColumnRenamed("a", "b"), "token").where("a < b")
    met = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
    met = met.unionByName(pairs).groupBy("a", "b").agg(F.sum("times").alias("times"))
    detail = F.struct("n", "fold")
    met = met.join(folds.select(F.col("set").alias("a"), detail.alias("x")), "a")
    met = met.join(folds.select(F.col("set").alias("b"), detail.alias("y")), "b")
    enough = F.expr(f"times >= {_agree('least(x.n, y.n)')}")
    return met.where(enough & _close("x", "y", percent)).select("a", "b")


def _large_rows(members: DataFrame, folds: DataFrame) -> DataFrame:
    """Members of large buckets with their folded sketches, once for each two blocks of
    the bucket that a block with the set is part of."""
    rows = members.where(f"size > {SMALL}").join(folds, "set")
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod("set", F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    low, high = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    return packed(rows.select("token", low, high, "own", "set", "n", "fold", F.col("set").alias("component")), "large-buckets")


def _compared(rows: DataFrame, percent: int, every: bool) -> DataFrame:
    """Pairs in large buckets, of different components, that can be similar: as many as
    connect all of them within two blocks, or every one of them, in the first of the
    buckets that its sets share."""
    if every:
        rows = rows.join(rows.groupBy("set").agg(F.sort_array(F.collect_set("token")).alias("tokens")), "set")
    else:
        rows = rows.withColumn("tokens", F.lit(None).cast("array<long>"))
    groups = max(1, rows.count() // GROUP_ROWS + 1)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("token", "i", "j"), F.lit(groups)))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (token, i, j), block in group.groupby(["token", "i", "j"], sort=False):
            block = block.sort_values(["own", "set"])
            out += _block_pairs(block, int(token), i != j, percent, every)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("part").applyInPandas(compare, "a long, b long").distinct()


def _block_pairs(block: pd.DataFrame, token: int, across: bool, percent: int, every: bool) -> list[tuple[int, int]]:
    sets, n, own = (block[c].to_numpy(np.int64) for c in ("set", "n", "own"))
    folds = np.stack(block["fold"].to_list()).astype(np.int64).view(np.uint64)
    label, out = block["component"].to_numpy(np.int64).copy(), []
    tokens = block["tokens"].to_list()
    for r in range(len(sets) - 1):
        later = slice(r + 1, None)
        small, large = np.minimum(n[later], n[r]), np.maximum(n[later], n[r])
        can = (label[later] != label[r]) & (100 * small >= percent * large)
        if across:
            can &= own[later] != own[r]
        at = np.flatnonzero(can) + r + 1
        if not len(at):
            continue
        differ = np.bitwise_count(folds[at] ^ folds[r]).sum(1, dtype=np.int64)
        at = at[differ <= (100 - percent) * (n[at] + n[r]) // (100 + percent)]
        if every:
            at = [k for k in at if np.intersect1d(tokens[r], tokens[k]).min() == token]
        elif len(at):
            new, first = np.unique(label[at], return_index=True)
            at = at[first]
            label[np.isin(label, new)] = label[r]
        out += [(min(sets[r], sets[k]), max(sets[r], sets[k])) for k in at]
    return out


def _verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that reach the similarity, by their whole sets."""
    pairs = packed(pairs.distinct(), "near-pairs")
    sets = _shingle_sets(rows, docs, pairs.select(F.explode(F.array("a", "b")).alias("set")), width)
    left = sets.select(F.col("set").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("set").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("x", "y"))
    return packed(both.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """``set, component``: for each set in ``links`` (a, b) the smallest it is connected
    with.  Every node points to the smallest set in reach of its neighbours, and each
    edge is hung on these, until all are stars."""
    edges = packed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = edges.join(low.withColumnRenamed("u", "v"), "v").select("u", F.col("low").alias("v"))
        large = large.where("u > v").unionByName(low.where("u > low").select("u", F.col("low").alias("v")))
        large = large.unionByName(edges.join(low.withColumnRenamed("u", "v"), "v").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v")))
        small = large.groupBy("u").agg(F.min("v").alias("low"))
        hung = large.join(small, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = packed(hung.unionByName(small.select("u", F.col("low").alias("v"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    low = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "set")
    roots = edges.select("v").distinct().join(edges.select("u"), F.col("v") == F.col("u"), "left_anti")
    return packed(low.unionByName(roots.select(F.col("v").alias("set"), F.col("v").alias("component"))), "components")


def near_components(documents: DataFrame, width: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Two texts link when ``100 * intersection >= percent * union`` of their sets of
    ``width``-word shingles; the component is the smallest doc_id reachable by links.
    Texts without words (null, empty, blanks) link with nothing.  Rows with equal sets
    are one node, whatever their number; rows without id link too, but never name a
    component (theirs is null if nothing else is in it).  An empty table gives no rows;
    other columns don't matter.

    Sets meet in buckets of their rarest shingles (``prefixes``).  What parity sketches
    don't rule out is verified on whole sets.  A small bucket gives
    all its pairs.  A large one is compared block by block and gives, first, only as many
    pairs as connect its close sets; once these are verified, the close pairs that are
    still between different components.  So a group
    of many near copies gives pairs in proportion to its size, and no link between
    components is lost."""
    with scratch(documents.sparkSession):
        return stored(_named(*_grouped(documents, width, percent, key, text)), "near-components")


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _grouped(documents: DataFrame, width: int, percent: int, key: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """The sketches of all rows, and the components of those sets that link."""
    spark = documents.sparkSession
    small_batches(spark, 400)
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), _text_hash(text).alias("hash"))
    docs = packed(sketched(rows, width, percent), "sketches")
    prefix = prefixes(docs, percent)
    release(spark)
    folds = _folds(docs, prefix)

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, rows, docs, width, percent)

    alone, members = buckets(prefix)
    release(spark)
    large = _large_rows(members, folds)
    pairs = _small_pairs(alone, members, folds, percent).unionByName(_compared(large, percent, every=False))
    found = _joined(None, verified(pairs))
    release(spark)
    open_ = _still_open(large, found)
    return docs, _joined(found, verified(_compared(open_, percent, every=True)))


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """The components with further links."""
    if links.isEmpty():
        return found
    if found is not None:
        links = links.unionByName(found.select(F.col("set").alias("a"), F.col("component").alias("b")))
    return components(links)


def _still_open(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """The rows of buckets that still hold several components, with these."""
    if found is not None:
        rows = rows.drop("component").join(found, "set", "left").withColumn("component", F.coalesce("component", "set"))
    ends = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return packed(rows.join(ends.where("low < high").select("token"), "token", "left_semi"), "open-buckets")


def _shingle_sets(rows: DataFrame, docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``set, hashes`` of the wanted sets, each from one of its documents."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash")).alias("first")
    wanted = docs.join(wanted.distinct(), "set", "left_semi").groupBy("set").agg(first)
    wanted = packed(wanted.select("set", F.col("first.doc_id").alias("id_"), F.col("first.hash").alias("hash_")), "wanted-sets")
    picked = maybe_broadcast(wanted, wanted.count())
    # an id alone may have many rows and many sets; with the text's hash it has one set
    texts = rows.join(picked, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("hash") == F.col("hash_"))).select("set", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            sets, out = [], []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = shingle_hashes(text, width, known)
                if set_id(hashes) == number:
                    sets.append(number)
                    out.append(hashes.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["set", "hashes"])

    return packed(texts.mapInArrow(hashed, "set long, hashes array<long>").dropDuplicates(["set"]), "shingle-sets")


def _named(docs: DataFrame, found: DataFrame | None) -> DataFrame:
    docs = docs.select("doc_id", "n", "set")
    sets = docs.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("first"))
    if found is None:
        named = sets.withColumnRenamed("first", "component_id")
    else:
        sets = sets.join(found, "set", "left").withColumn("component", F.coalesce("component", "set"))
        names = sets.groupBy("component").agg(F.min("first").alias("component_id"))
        named = sets.join(names, "component").select("set", "component_id")
    out = docs.join(named, "set", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _first_rows(docs: DataFrame, found: DataFrame | None) -> DataFrame:
    """``near_id_, near_hash_, near_rows_``: per component its smallest doc_id (none comes
    last), the smallest text hash with that, and the number of rows that have both."""
    rows = docs.where("n > 0").groupBy("set", "doc_id", "hash").agg(F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "rows")).alias("first")
    sets = rows.groupBy("set").agg(first)
    if found is not None:
        sets = sets.join(found, "set", "left").select(F.coalesce("component", "set").alias("set"), "first")
        sets = sets.groupBy("set").agg(F.min("first").alias("first"))
    return sets.select(F.col("first.doc_id").alias("near_id_"), F.col("first.hash").alias("near_hash_"), F.col("first.rows").alias("near_rows_"))


def first_of_groups(documents: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """``documents`` with one row of each component: that of the smallest doc_id, rows
    without id coming last.  Of several texts with this id in the component the one with
    the smallest hash stays, and of rows equal in both any one.  Texts without words are
    no copies of anything and all stay."""
    with scratch(documents.sparkSession):
        kept = stored(_first_rows(*_grouped(documents, width, percent, "doc_id", "text")), "near-kept")
    docs = documents.withColumn("near_row_", _text_hash("text"))
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("near_id_")) & (F.col("near_row_") == F.col("near_hash_"))
    stay = docs.where(worded).join(maybe_broadcast(kept, kept.count()), same)
    many = stay.where("near_rows_ > 1").dropDuplicates(["near_id_", "near_hash_"])
    stay = stay.where("near_rows_ = 1").unionByName(many).select(*documents.columns)
    return stay.unionByName(documents.where(~worded))
