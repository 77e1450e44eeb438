"""Secret scans: trigram queries derived from rules, postings, verified candidates."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import small_batches

#: UTF-8 bytes that one index segment covers, about; a longer text is a segment itself.
SEGMENT_BYTES = 1 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost and not overlapping, whose
    ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The base rules, in the order in which equal starts are listed.  Fixed values.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further rules, on published token formats.
MORE = (
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}=*", any_case=True),
)

# A query is True (anything may match), a trigram, or ("and" | "or", queries).


def _both(kind: str, queries: list):
    """The queries joined by ``kind``; True drops out of "and" and decides "or"."""
    if kind == "and":
        queries = [q for q in queries if q is not True]
    elif any(q is True for q in queries):
        return True
    flat = []
    for q in queries:
        flat += q[1] if isinstance(q, tuple) and q[0] == kind else [q]
    flat = list(dict.fromkeys(flat))
    return True if not flat else flat[0] if len(flat) == 1 else (kind, tuple(flat))


def _literal(run: str):
    return _both("and", [run[i : i + 3] for i in range(len(run) - 2)])


def _sequence(items) -> object:
    """The query of a concatenation.  Runs of single characters give their trigrams;
    what may vary ends a run and brings its own query."""
    found, run = [], ""
    for op, value in items:
        if op is sre.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        if op is sre.MAX_REPEAT and value[0] == value[1] == 1:
            found.append(_sequence(value[2]))
        elif op is sre.MAX_REPEAT and value[0] >= 1:
            found.append(_sequence(value[2]))
        elif op is sre.SUBPATTERN:
            found.append(_sequence(value[3]))
        elif op is sre.BRANCH:
            found.append(_both("or", [_sequence(x) for x in value[1]]))
        found.append(_literal(run))
        run = ""
    return _both("and", [*found, _literal(run)])


def trigram_query(pattern: str):
    """A Boolean query over lower-cased trigrams that every match's text satisfies;
    True if the pattern has no trigram that must occur.

    An optional part adds nothing, a part repeated at least once adds its own query,
    alternatives are joined by "or", anything else by "and".  Classes, sets and long
    characters end a run."""
    return _sequence(_parser.parse(pattern))


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(q) for q in query[1]))


def search(query, postings: dict[str, np.ndarray], everything: np.ndarray) -> np.ndarray:
    """Numbers of the texts that satisfy the query: postings intersected and united."""
    if query is True:
        return everything
    if isinstance(query, str):
        return postings.get(query, everything[:0])
    found = [search(q, postings, everything) for q in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(found))
    out = found[0]
    for more in sorted(found[1:], key=len):
        out = np.intersect1d(out, more, assume_unique=True)
    return out


class Index:
    """The inverted index of one segment, over the trigrams that the rules ask for."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(rule, rule.compiled(), trigram_query(rule.pattern)) for rule in rules]
        self.terms = sorted(set().union(*(trigrams(q) for _, _, q in self.rules)))
        self.number = np.zeros(1 << 24, np.uint16)
        for i, term in enumerate(self.terms):
            a, b, c = term.encode()
            self.number[a << 16 | b << 8 | c] = i + 1
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def postings(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """Each trigram's texts, ascending."""
        whole = np.frombuffer(b"\0\0".join(texts) + b"\0\0", np.uint8)
        low = self.fold[whole].astype(np.uint32)
        term = self.number[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        at = np.flatnonzero(term)
        ends = np.cumsum([len(t) + 2 for t in texts])
        pairs = np.unique(term[at].astype(np.int64) * len(texts) + np.searchsorted(ends, at, "right"))
        terms, numbers = pairs // len(texts), pairs % len(texts)
        starts = np.searchsorted(terms, np.arange(1, len(self.terms) + 2))
        return {x: numbers[starts[i] : starts[i + 1]] for i, x in enumerate(self.terms) if starts[i] < starts[i + 1]}

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text the spans found, as (start, number of the rule, end), sorted."""
        postings = self.postings([t.encode() for t in texts])
        everything, out = np.arange(len(texts)), [[] for _ in texts]
        for number, (rule, pattern, query) in enumerate(self.rules):
            for i in search(query, postings, everything).tolist():
                for m in pattern.finditer(texts[i]):
                    if len(m[rule.group]) >= rule.least:
                        out[i].append((m.start(), number, m.end()))
        return [sorted(spans) for spans in out]


def _segments(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SEGMENT_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def scan_secrets(documents: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, base: int = len(BASE), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_<kind>`` for the first ``base`` rules, ``base_sha256, spans``.

    Texts are indexed in segments of about a megabyte: a rule's trigram query intersects
    the segment's postings, and the rule's expression runs on the texts left; rules
    without a query run on all.  A segment is searched where it was indexed, so texts
    aren't shuffled and a lost task is simply run again.

    Spans are ``kind:start:end`` in code points, by start and then in the rules' order,
    joined by commas.  Null text is empty and has none, an empty table gives no rows,
    repeated rows are scanned each, and other columns don't matter."""
    small_batches(documents.sparkSession)
    kinds = [rule.kind for rule in rules]
    names = ["doc_id", *(f"n_{k}" for k in kinds[:base]), "base_sha256", "spans"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            spans = [found for part in _segments(texts) for found in index.scan(part)]
            columns: list[list] = [[] for _ in names[1:]]
            for found in spans:
                for k in range(base):
                    columns[k].append(sum(x[1] == k for x in found))
                told = [f"{kinds[k]}:{start}:{end}" for start, k, end in found]
                own = ",".join(x for x, (_, k, _) in zip(told, found) if k < base)
                columns[-2].append(hashlib.sha256(own.encode()).hexdigest())
                columns[-1].append(",".join(told))
            types = [pa.int64()] * base + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, types))], names)

    schema = "doc_id long, " + "".join(f"n_{k} long, " for k in kinds[:base]) + "base_sha256 string, spans string"
    return documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(scan, schema)
