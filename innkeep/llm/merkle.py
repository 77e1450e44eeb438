"""Document fingerprints: Merkle trees over sections, paragraphs and pieces of them."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import small_batches

#: Rows sampled, about, for each of the ranges in which neighbours are found.
SAMPLED_PER_RANGE = 50
#: A piece ends after one word in so many, a section after one paragraph in so many.
PIECE, SECTION = 4, 8


def _digest(data: bytes, size: int) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def _pieces(paragraph: bytes) -> str:
    """Hashes of the paragraph's pieces, four characters each.  A word's own hash says
    whether a piece ends after it, so pieces beyond an edit are found again."""
    out, piece = [], []
    for word in paragraph.split(b" "):
        piece.append(word)
        if crc32(word) % PIECE == 0:
            out.append(crc32(b" ".join(piece)) & 0xFFFFFF)
            piece = []
    if piece:
        out.append(crc32(b" ".join(piece)) & 0xFFFFFF)
    return base64.b64encode(b"".join(x.to_bytes(3, "big") for x in out), b"-_").decode()


def fingerprint(text: str) -> str:
    """The tree as text: the root's hash, ':', and the sections, divided by ';'.  A
    section is its hash and its paragraphs, divided by '.'; a paragraph is its hash (8
    characters) and those of its pieces (4 each).

    Paragraphs are lines.  A section ends at an empty line, or where the paragraph's
    own hash says so.  Every node hashes its children's full digests, so equal roots
    mean equal texts.  The empty text is one empty paragraph."""
    sections, nodes, digests, parts = [], [], [], []
    lines = text.encode().split(b"\n")
    for i, line in enumerate(lines):
        own = _digest(line, 16)
        nodes.append(own)
        parts.append(base64.b64encode(own[:6], b"-_").decode() + _pieces(line))
        if not line or own[0] % SECTION == 0 or i == len(lines) - 1:
            whole = _digest(b"".join(nodes), 16)
            digests.append(whole)
            sections.append(base64.b64encode(whole[:6], b"-_").decode() + "." + ".".join(parts))
            nodes, parts = [], []
    return _digest(b"".join(digests), 16).hex() + ":" + ";".join(sections)


def _tree(print_: str) -> list[tuple[str, list[tuple[str, list[str]]]]]:
    out = []
    for section in print_.partition(":")[2].split(";"):
        own, *paragraphs = section.split(".")
        out.append((own, [(p[:8], [p[i : i + 4] for i in range(8, len(p), 4)]) for p in paragraphs]))
    return out


def _unmatched(a: list, b: list) -> tuple[list, list, list]:
    """(nodes of a with an equal in b, the rest of a, the rest of b), by hash."""
    there, same, rest = Counter(x[0] for x in b), [], []
    for x in a:
        if there[x[0]]:
            there[x[0]] -= 1
            same.append(x)
        else:
            rest.append(x)
    left = []
    for x in b:
        if there[x[0]]:
            there[x[0]] -= 1
            left.append(x)
    return same, rest, left


def likeness(a: str, b: str) -> float:
    """Share of pieces that two trees have in common, 0 to 1, from the root down: equal
    nodes count as a whole, only differing branches are opened."""
    if a == b:
        return 1.0
    x, y = _tree(a), _tree(b)
    total = sum(len(pieces) for tree in (x, y) for _, ps in tree for _, pieces in ps)
    same, x, y = _unmatched(x, y)
    common = sum(len(pieces) for _, ps in same for _, pieces in ps)
    same, p, q = _unmatched([p for _, ps in x for p in ps], [p for _, ps in y for p in ps])
    common += sum(len(pieces) for _, pieces in same)
    left, right = Counter(c for _, pieces in p for c in pieces), Counter(c for _, pieces in q for c in pieces)
    common += sum((left & right).values())
    return 2 * common / total


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) numbers in ``a`` of the branches that ``b`` lacks."""
    x, y = _tree(a), _tree(b)
    _, rest, left = _unmatched([(own, i, ps) for i, (own, ps) in enumerate(x)], y)
    _, gone, _ = _unmatched([(p[0], i, j) for _, i, ps in rest for j, p in enumerate(ps)], [p for _, ps in left for p in ps])
    return sorted((i, j) for _, i, j in gone)


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint``: one row per document; null text counts as empty."""
    small_batches(documents.sparkSession)
    own = F.pandas_udf(lambda texts: texts.map(fingerprint), "string")
    return documents.select(F.col(key).alias("doc_id"), own(F.coalesce(F.col(text), F.lit(""))).alias("fingerprint"))


_LAST = -(2**63)
_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(documents: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """Rows dealt to ranges of descending id, then ascending text, and sorted; a range's
    last row is followed by a copy (``guest``) of the first row of the next range, of the
    first range after the last.  Returns the rows and the number of ranges.

    There are as many ranges as shuffle partitions, whatever the number of rows.  Their
    bounds come from a sample, as (id, first bytes of the text): rows of one id, or
    without any, are dealt to several ranges if their texts begin differently.  The
    bounds and the ranges' first rows (ids and first bytes only) are a row per range."""
    spark = documents.sparkSession
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # seven bytes, filled up with zeros, as a number: ordered as the texts are
    head = F.conv(F.rpad(F.hex(F.substring(F.col("text").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    rows = rows.withColumn("down", -1 - F.coalesce("doc_id", F.lit(_LAST))).withColumn("head", head)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = rows.count()
    share = min(1.0, SAMPLED_PER_RANGE * most / max(1, count))
    sample = sorted(tuple(r) for r in rows.sample(fraction=share, seed=1).select("down", "head").collect())
    bounds = sorted({sample[len(sample) * i // most] for i in range(1, most)}) if sample else []
    ranges = len(bounds) + 1
    downs, heads = (np.array([b[k] for b in bounds], np.int64) for k in (0, 1))

    @F.pandas_udf("int")
    def range_of(down: pd.Series, head: pd.Series) -> pd.Series:
        d, h = down.to_numpy(np.int64), head.to_numpy(np.int64)
        low, high = np.searchsorted(downs, d, "left"), np.searchsorted(downs, d, "right")
        out = low.astype("int32")
        for i in np.flatnonzero(low < high):  # an id that is a bound: the texts decide
            out[i] += np.searchsorted(heads[low[i] : high[i]], h[i], "right")
        return pd.Series(out)

    placed = rows.withColumn("range", range_of("down", "head"))
    first = placed.groupBy("range").agg(F.min(F.struct("down", "head")).alias("f")).orderBy("range").collect()  # a row per range
    guests = [(*r["f"], first[i - 1]["range"]) for i, r in enumerate(first)]
    guests = spark.createDataFrame(guests, "g_down long, g_head long, guest_range int")
    here = (F.col("down") == F.col("g_down")) & (F.col("head") == F.col("g_head"))
    placed = placed.join(F.broadcast(guests), here, "left")  # a row per range
    place = F.struct(F.col("range"), F.lit(0).alias("guest"))
    both = F.array(place, F.struct(F.col("guest_range").alias("range"), F.lit(1).alias("guest")))
    placed = placed.withColumn("place", F.explode(F.when(F.col("guest_range").isNull(), F.array(place)).otherwise(both)))
    placed = placed.select("place.range", "place.guest", "down", "doc_id", "text")
    return placed.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "guest", "down", "text"), ranges


def edited_fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    The edited text has the last floor(n_chars / 3) code points replaced by the first
    as many of the next document in descending id.  Null text is empty; its edited text
    is empty too.  Null ids come last; rows with one id follow in order of their text,
    so that the next of a repeated row is its copy.  A single document is its own next.
    An empty table gives no rows; other columns are ignored.

    Neighbours meet by one shuffle into ranges of ids and texts; the rows then pass in order, two at a
    time, so no range is held in memory."""
    small_batches(documents.sparkSession, 200)
    placed, _ = with_next(documents, key, text)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, row, own = [], None, ""
        for following in stream(batches):
            if row is not None and not row[1] and row[0] == following[0]:
                own = own or fingerprint(row[3])
                then = fingerprint(following[3])
                out.append(_row(row[2], row[3], own, following[3], then))
                own = then
            else:
                own = ""
            row = following
            if len(out) == 500:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=_NAMES), schema=_ARROW)
                out = []
        yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=_NAMES), schema=_ARROW)

    return placed.mapInArrow(compute, _OUT)


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string())]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_NAMES = _ARROW.names


def _row(doc_id: int | None, text: str, own: str, following: str, then: str) -> tuple:
    third = len(text) // 3
    edited = text[: len(text) - third] + following[:third]
    other = own if edited == text else fingerprint(edited)
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, likeness(own, other), likeness(own, then)
