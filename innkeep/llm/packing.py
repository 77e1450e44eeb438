"""Best-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from functools import cache
from struct import pack as pack_ids
from unicodedata import is_normalized
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm.common import numbered_copies, small_batches
from innkeep.session import stored

#: Words whose ids a worker remembers, twice at most.
REMEMBERED = 200_000
#: Pieces ranked by one window, about.
RANKED = 100_000


#: Characters whose words are divided at once, about.
DIVIDED = 2_000_000

#: Kinds of characters by code point, filled in as they occur.  The tokenizer divides a
#: text in lower case into runs of letters, single digits and runs of others, of which an
#: apostrophe with some letters is one of its own: 's, 't, 're, 've, 'm, 'll, 'd.
_KINDS = np.full(0x110000, 255, np.uint8)
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_AFTER_APOSTROPHE = [ord(c) for c in "stmd"], [ord(c) << 32 | ord(d) for c, d in ("re", "ve", "ll")]

#: Its letters for the bytes of a word, in the order of the bytes.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: b if b in _PRINTABLE else 256 + b - sum(p < b for p in _PRINTABLE) for b in range(256)}


def _kind(character: str) -> int:
    if character.isalnum():
        return _DIGIT if character.isdecimal() else _LETTER
    return _SPACE if character.isspace() and not "\x1c" <= character <= "\x1f" else _OTHER


def _kinds(points: np.ndarray) -> np.ndarray:
    out = _KINDS[points]
    new = out == 255
    if new.any():
        for point in np.unique(points[new]).tolist():
            _KINDS[point] = _kind(chr(point))
        out = _KINDS[points]
    return out


def _divided(texts: list[str], encoding: str) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of the texts in a row, and the number of words before each text and in
    all.  The texts are in lower case, and each character has as many bytes."""
    points = np.frombuffer("\n".join(["", *texts, "", ""]).encode(encoding), "<u4" if encoding == "utf-32-le" else np.uint8)
    kinds = _kinds(points)
    inside = kinds != _SPACE
    first = inside.copy()
    first[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    at = np.flatnonzero(points == ord("'"))
    at = at[kinds[at - 1] != _OTHER]
    next_ = points[at + 1].astype(np.int64)
    one, two = np.isin(next_, _AFTER_APOSTROPHE[0]), np.isin(next_ << 32 | points[at + 2], _AFTER_APOSTROPHE[1])
    at, end = at[one | two] + 1, (at + 2 + two)[one | two]
    first[at] = False
    first[end] = inside[end]
    starts = np.cumsum([1] + [len(text) + 1 for text in texts])
    before = np.searchsorted(np.flatnonzero(first), starts)
    points = points[inside]
    bounds = np.append(np.flatnonzero(first[inside]), len(points)) * points.itemsize
    words = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(points)])
    return words.dictionary_encode(), before


@cache
def _simple(character: str) -> bool:
    """Whether Python's classes and lower case treat the character as the tokenizer does."""
    if character.isalpha():
        return len(character.lower()) == 1 and character != "Σ"
    if character.isalnum():
        return character.isdecimal()
    return not "\x1c" <= character <= "\x1f"


class Words:
    """The ids of texts as little-endian bytes, by way of their words.

    The tokenizer lower-cases, drops white space and never joins what it divides, so a
    text's ids are those of its words.  Many texts are divided at once, in arrays; each
    distinct word is looked up once, and the tokenizer's model encodes unknown ones.
    Texts on which Python and the tokenizer might divide differently are encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        out, held, sizes = [b""] * len(texts), {"ascii": [], "utf-32-le": []}, {"ascii": 0, "utf-32-le": 0}
        for i, text in enumerate(texts):
            encoding = self._encoding(text)
            if encoding is None:
                out[i] = self._encode(text)
                continue
            held[encoding].append(i)
            sizes[encoding] += len(text)
            if sizes[encoding] >= DIVIDED:
                self._put(out, texts, held[encoding], encoding)
                held[encoding], sizes[encoding] = [], 0
        for encoding, those in held.items():
            self._put(out, texts, those, encoding)
        return out

    @staticmethod
    def _encoding(text: str) -> str | None:
        """One with as many bytes for each character, if the text can be divided here."""
        if "<|" in text:  # may be a special token
            return None
        if text.isascii():
            return "ascii"
        return "utf-32-le" if all(map(_simple, set(text))) and is_normalized("NFC", text) else None

    def _put(self, out: list[bytes], texts: list[str], those: list[int], encoding: str) -> None:
        """Sets ``out`` to the ids of those texts."""
        if not those:
            return
        words, before = _divided([texts[i].lower() for i in those], encoding)
        known = self._known([word.decode(encoding) for word in words.dictionary.to_pylist()])
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts, word = np.cumsum(sizes) - sizes, words.indices.to_numpy()
        ends = np.cumsum(sizes[word])
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[word] - ends + sizes[word], sizes[word])
        ids = np.frombuffer(b"".join(known), "<u4")[at].tobytes()
        cuts = (4 * np.append(0, ends)[before]).tolist()
        for i, x, y in zip(those, cuts, cuts[1:]):
            out[i] = ids[x:y]

    def _known(self, words: list[str]) -> list[bytes]:
        out = []
        for word in words:
            ids = self.recent.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    ids = self._encode_word(word)
                self.recent[word] = ids
            out.append(ids)
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        return out

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        found = self.model.tokenize(letters)
        return pack_ids(f"<{len(found)}I", *[token.id for token in found])


@cache
def _words(path: str) -> Words:
    """One per worker, which keeps it from task to task."""
    return Words(path)


def pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each text's ids and ``end_id``, cut
    into pieces of ``capacity`` ids, the last one as long as is left."""
    small_batches(documents.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    last = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer)
        for batch in batches:
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), words.ids(batch.column(1).to_pylist())):
                ids += last
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    out.append((doc, piece, start // 4, len(part) // 4, crc32(part)))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Matches of pieces with gaps, as (length, first rank, number, first sequence, offset).

    One superstep per length, longest first.  Pieces of one length and gaps of one size
    are alike, so a run of them moves at once: the sweep matches the run of pieces with
    the smallest gaps that hold them.  Several pieces that want the same gaps are told
    apart by rank: the first ranks get these gaps, the next ranks the next larger ones,
    and those left open new sequences, as many as hold all of them.  Matched gaps shrink
    and take part in the rest of the step and in the next ones."""
    gaps: dict[int, deque] = {}
    sizes: list[int] = []
    opened, moves = 0, []

    def put(size: int, first: int, number: int) -> None:
        if not size:
            return
        runs = gaps.get(size)
        if not runs:
            gaps[size] = deque([(first, number)])
            insort(sizes, size)
        elif runs[-1][0] + runs[-1][1] == first:
            runs[-1] = (runs[-1][0], runs[-1][1] + number)
        else:
            runs.append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                new = math.ceil(left / (capacity // length))
                put(capacity, opened, new)
                opened += new
                continue
            size = sizes[at]
            first, there = gaps[size][0]
            number = min(there, left)
            if number == there:
                gaps[size].popleft()
                if not gaps[size]:
                    del gaps[size]
                    sizes.pop(at)
            else:
                gaps[size][0] = (first + number, there - number)
            moves.append((length, rank, number, first, capacity - size))
            put(size - length, first, number)
            rank, left = rank + number, left - number
    return moves


def pack(rows: DataFrame, capacity: int) -> DataFrame:
    """``rows`` (distinct, with ``length`` from 1 to ``capacity``) with ``sequence_id``
    and ``offset``.

    Pieces are range-sorted by length, and ranked within it by way of counts per length
    and bucket, so that a length that a third of all rows have needs no window of its
    own.  The supersteps work on runs of equal pieces and gaps, of which there are at
    most ``capacity`` sizes each, not on rows; every piece then looks up its run."""
    columns = rows.columns
    buckets = max(1, math.ceil(rows.count() / RANKED))
    rows = rows.withColumn("bucket_", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"))
    by = rows.groupBy("length", "bucket_").agg(F.count(F.lit(1)).alias("n_"))
    by = stored(by.withColumn("before_", F.sum("n_").over(Window.partitionBy("length").orderBy("bucket_")) - F.col("n_")), "pack-counts")
    counts = {r["length"]: r["n"] for r in by.groupBy("length").agg(F.sum("n_").alias("n")).collect()}  # a row per length
    moves = sorted(best_fit(counts, capacity))
    lengths, ranks, _, firsts, offsets = (np.array(x, np.int64) for x in (zip(*moves) if moves else [()] * 5))
    starts = lengths * (1 << 46) + ranks

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(starts, length.to_numpy(np.int64) * (1 << 46) + rank.to_numpy(np.int64), "right") - 1
        return pd.DataFrame({"sequence_id": firsts[at] + rank.to_numpy(np.int64) - ranks[at], "offset": offsets[at]})

    order = Window.partitionBy("length", "bucket_").orderBy(*columns)
    ranked = rows.join(by.drop("n_"), ["length", "bucket_"]).withColumn("rank_", F.row_number().over(order) - 1 + F.col("before_"))
    return ranked.withColumn("at_", look_up("length", F.col("rank_").cast("long"))).select(*columns, "at_.sequence_id", "at_.offset")


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``
    and ``copy``.

    Only documents of more than ``capacity`` ids are cut.  Null and empty texts are the
    end id alone.  Equal rows are packed each and numbered by ``copy``.  Null ids are
    kept.  An empty table gives no rows; other columns don't matter."""
    cut = pieces(documents, tokenizer, capacity, end_id, key, text)
    cut = stored(numbered_copies(cut, *cut.columns), "pack-pieces")
    packed = pack(cut, capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "copy")
