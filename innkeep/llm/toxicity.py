"""Toxicity scores from a learned lexicon, matched by Levenshtein automata."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import packed, scratch, small_batches

#: Labelled rows that the lexicon and the weights are fitted on, at most.
FIT_ROWS = 20_000
#: Terms in the lexicon at most, and the least evidence for one (log-likelihood ratio).
TERMS, EVIDENCE = 256, 20.0
#: Letters of the word beginnings that may become terms.
STEMS = range(3, 9)
#: Letters from which a whole word is also found with one error, and with two.
FUZZY, LONG = 5, 8
#: What a hit counts for by its errors, in a quotation, and near an address.
BY_ERRORS, IN_QUOTES, ADDRESSED = (1.0, 0.8, 0.6), 0.6, 1.25
#: States of a lexicon's automaton kept at once.
STATES = 200_000
#: Words to either side that make up a hit's context.
WINDOW = 4
#: Words whose matches a worker remembers at once.
REMEMBERED = 200_000

#: Words that report speech, and that address the reader.  Fixed values.
REPORTING = frozenset("said says wrote writes quote quoted quotes called word term insult sagte schrieb wort dit écrit mot dijo escribió palabra".split())
ADDRESSING = frozenset("you your you're yourself he she they du dein ihr tu toi vous tú usted".split())
QUOTES = "\"“”„«»‘’'`"

_WORD = re.compile(r"[^\W\d_]+")
_JOINED = re.compile(r"[^\W\d_]+(?:[\d_@$!*+#]{1,2}[^\W\d_]+)*")


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.lower())


def joined_words_of(text: str) -> list[str]:
    """As ``words_of``, with digits and symbols that stand between letters kept inside."""
    return _JOINED.findall(text.lower())


def errors_allowed(term: str) -> int:
    return 0 if term.endswith("*") or len(term) < FUZZY else 1 if len(term) < LONG else 2


class Lexicon:
    """A trie of terms, walked by Levenshtein automata.

    A term is a whole word, or a stem (ending in '*') that begins a word.  A state is
    the set of (trie node, errors made, letter due) that an input can lead to; states and
    moves are made when first needed and kept, so the intersection of trie and automata
    becomes one deterministic automaton that reads a word once and mostly gives up after a
    few letters.  Whole words of at least FUZZY letters match with one letter inserted,
    lost, replaced or swapped with the next, those of at least LONG letters with two such
    errors; stems match exactly."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.allowed: list[int] = [0]  # errors with which some term below can be reached
        for number, term in enumerate(terms):
            node, letters, errors = 0, term.rstrip("*"), errors_allowed(term)
            self.allowed[0] = max(self.allowed[0], errors)
            for c in letters:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                    self.allowed.append(0)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], errors)
            (self.stem if term.endswith("*") else self.word)[node] = number
        self._clear()

    def _clear(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.stems_at: list[tuple[tuple[int, int], ...]] = []  # stems that end in a state
        self.ends_at: list[tuple[tuple[int, int], ...]] = []  # what a word that ends there is
        self.start = self._state({(0, 0, "")})

    def _state(self, found: set[tuple[int, int, str]]) -> int:
        todo = list(found)
        while todo:  # a lost letter moves on in the trie without reading
            node, errors, due = todo.pop()
            if due:
                continue
            for child in self.children[node].values():
                lost = (child, errors + 1, "")
                if self.allowed[child] > errors and lost not in found:
                    found.add(lost)
                    todo.append(lost)
        key = frozenset((n, e, due) for n, e, due in found if not any((n, less, due) in found for less in range(e)))
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            self.stems_at.append(tuple((self.stem[n], 0) for n, e, _ in key if not e and self.stem[n] >= 0))
            self.ends_at.append(self._ends(key))
        return self.states[key]

    def _ends(self, key: frozenset) -> tuple[tuple[int, int], ...]:
        ends: dict[int, int] = {}
        for node, errors, due in key:
            term = self.word[node]
            if term >= 0 and not due and errors <= errors_allowed(self.terms[term]):
                ends[term] = min(errors, ends.get(term, errors))
        least = min(ends.values(), default=0)
        return tuple((t, e) for t, e in ends.items() if e == least)

    def _move(self, state: int, letter: str) -> int:
        out: set[tuple[int, int, str]] = set()
        for node, errors, due in self.sets[state]:
            if due:
                if due == letter:
                    out.add((node, errors, ""))
                continue
            child = self.children[node].get(letter)
            if child is not None:
                out.add((child, errors, ""))
            if self.allowed[node] > errors:
                out.add((node, errors + 1, ""))  # inserted
                for first, c in self.children[node].items():
                    if self.allowed[c] > errors:
                        out.add((c, errors + 1, ""))  # replaced
                        second = self.children[c].get(letter)
                        if second is not None and first != letter and self.allowed[second] > errors:
                            out.add((second, errors + 1, first))  # swapped
        to = self._state({(n, e, due) for n, e, due in out if e <= self.allowed[n]})
        self.moves[state][letter] = to
        return to

    def match(self, word: str) -> tuple[tuple[int, int], ...]:
        """(term, errors) of the terms that match; whole words with the fewest errors hide
        those with more."""
        if len(self.sets) >= STATES:
            self._clear()
        state, found = self.start, ()
        moves, sets, stems_at = self.moves, self.sets, self.stems_at
        for letter in word:
            to = moves[state].get(letter)
            state = self._move(state, letter) if to is None else to
            if not sets[state]:
                return found
            if stems_at[state]:
                found += stems_at[state]
        return found + self.ends_at[state]


def matches_by_distance(terms: list[str], word: str) -> set[tuple[int, int]]:
    """What ``Lexicon.match`` finds, by comparing the word with every term."""

    def distance(a: str, b: str) -> int:
        before, row = [], list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y)))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    now[j] = min(now[j], before[j - 2] + 1)
            before, row = row, now
        return row[-1]

    stems = {(i, 0) for i, t in enumerate(terms) if t.endswith("*") and word.startswith(t[:-1])}
    whole = {(i, distance(t, word)) for i, t in enumerate(terms) if not t.endswith("*")}
    whole = {(i, d) for i, d in whole if d <= errors_allowed(terms[i])}
    least = min((d for _, d in whole), default=0)
    return stems | {(i, d) for i, d in whole if d == least}


@dataclass
class Model:
    """A lexicon, words that only look like its terms, the weights of the features and
    the constant."""

    terms: list[str] = field(default_factory=list)
    usual: frozenset[str] = frozenset()
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0


class Scorer:
    """Features and scores of texts, with the words' matches remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.lexicon = Lexicon(model.terms)
        self.known: set[str] = set()  # words read, those that match, and what they match
        self.matching: set[str] = set()
        self.matched: dict[str, tuple[tuple[int, int], ...]] = {}

    def hits(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(place, term, errors)."""
        if not self.model.terms:
            return []
        own = set(words)
        new = own - self.known
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            self.matching.clear()
            self.matched.clear()
            new = own
        for word in new:
            found = self._match(word)
            if found:
                self.matched[word] = found
                self.matching.add(word)
        self.known |= new
        if own.isdisjoint(self.matching):
            return []
        matched = self.matched
        return [(i, t, e) for i, word in enumerate(words) if word in matched for t, e in matched[word]]

    def _match(self, word: str) -> tuple[tuple[int, int], ...]:
        found = self.lexicon.match(word)
        if not _WORD.fullmatch(word):  # joined by digits or symbols: exact parts tell more
            parts = [x for part in _WORD.findall(word) for x in self.lexicon.match(part) if part not in self.model.usual or not x[1]]
            found = tuple(x for x in parts if not x[1]) or found or tuple(parts)
        return tuple(x for x in found if not x[1]) if word in self.model.usual else found

    def features(self, text: str) -> dict[int, float]:
        """Sparse features: per term what its hits count for, then all words' and stems'.

        A hit is evidence for its own term, less with errors or quoted, more near an
        address, by fixed factors."""
        words = joined_words_of(text)
        hits = self.hits(words)
        if not hits:
            return {}
        n, terms = len(self.model.terms), self.model.terms
        places = {i for i, _, _ in hits}
        spans, context = self._spans(text, places), {}
        for i in places:
            around = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
            if spans.get(i) or not REPORTING.isdisjoint(around):
                context[i] = IN_QUOTES
            else:
                context[i] = 1.0 if ADDRESSING.isdisjoint(around) else ADDRESSED
        per_term, whole, stems, out = Counter(), {}, {}, {}
        for i, t, e in hits:
            counts = BY_ERRORS[e] * context[i]
            per_term[t] += counts
            kind = stems if terms[t].endswith("*") else whole
            kind[i] = max(counts, kind.get(i, 0.0))
        for t, counts in per_term.items():
            # whole words tell by being there, stems by how much of the text they are
            out[t] = math.log1p(counts) if not terms[t].endswith("*") else math.log1p(200 * counts / (len(words) + 20))
        if whole:
            out[n] = math.log1p(sum(whole.values()))
        if stems:
            out[n + 1] = math.log1p(200 * sum(stems.values()) / (len(words) + 20))
        return out

    @staticmethod
    def _spans(text: str, places: set[int]) -> dict[int, bool]:
        """Whether the words at these places stand between quotes, close by."""
        out = {}
        low = text.lower()
        if not places or not any(q in low for q in QUOTES):
            return out
        for i, m in enumerate(_JOINED.finditer(low)):
            if i in places:
                left, right = low[max(0, m.start() - 2) : m.start()], low[m.end() : m.end() + 2]
                out[i] = any(q in left for q in QUOTES) and any(q in right for q in QUOTES)
        return out

    def score(self, text: str) -> float:
        weights = self.model.weights
        z = self.model.bias + sum(weights[k] * x for k, x in self.features(text).items())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


EXTRA_FEATURES = 2


def fold(key: str) -> Column:
    """crc32 of the id as text, modulo 5; the held-out fold is 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``text, toxic``: one text each of at most ``most`` labelled ids outside the held-out
    fold, chosen by the hash of the id.  Of several rows with an id the text with the
    smallest hash stands for it, found before the shuffle, so that an id with very many
    rows neither adds to the sample nor gathers in a task."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(fold("doc_id") != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    known = packed(known.withColumnRenamed("doc_id", "label_id"), "toxic-labels")
    chosen = documents.where("doc_id is not null").join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))  # at most ``most`` rows
    one = chosen.groupBy("label_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    return packed(one.select("first.text", "toxic"), "toxic-sample")


def learn_terms(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """Words and stems found in more toxic texts than chance explains, strongest first."""

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad, good = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(words_of(text))
                counts = bad if label else good
                counts.update(words)
                # a stem is present where it begins several different words, as chance seldom does
                stems = Counter(w[:k] + "*" for w in words for k in STEMS if len(w) > k)
                counts.update(s for s, c in stems.items() if c >= 2)
            terms = list(bad.keys() | good.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([bad[t] for t in terms], pa.int64()), pa.array([good[t] for t in terms], pa.int64())], ["term", "bad", "good"]
            )

    counted = sample.mapInArrow(present, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    rate = (F.col("bad") + F.col("good")) / F.lit(float(toxic + clean))
    seen = F.col("bad") * F.log(F.col("bad") / (rate * F.lit(float(toxic))))
    seen = seen + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (rate * F.lit(float(clean))))).otherwise(0.0)
    usual = counted.where(f"bad >= 4 and bad * {clean} > 4.0 * good * {toxic}").withColumn("evidence", 2 * seen)
    best = usual.where(F.col("evidence") >= EVIDENCE).orderBy(F.desc("evidence"), "term").limit(4 * TERMS).collect()
    kept: list[str] = []
    for row in best:  # a longer stem, or a word with a known stem, says nothing new
        bare = row["term"].rstrip("*")
        if any(k.endswith("*") and bare.startswith(k[:-1]) for k in kept) or len(kept) == TERMS:
            continue
        kept.append(row["term"])
    return kept


def usual_variants(sample: DataFrame, terms: list[str], toxic: int, clean: int) -> frozenset[str]:
    """Words like a term but for errors that clean texts hold as well, and toxic ones not
    clearly more often: words of their own, not misspelled terms."""

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(terms=terms))
        for batch in batches:
            bad, good = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = joined_words_of(text)
                words = set(words) | {part for w in words if not _WORD.fullmatch(w) for part in _WORD.findall(w)}
                (bad if label else good).update(w for w in words if any(e for _, _, e in scorer.hits([w])))
            found = list(bad.keys() | good.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array([bad[w] for w in found], pa.int64()), pa.array([good[w] for w in found], pa.int64())], ["word", "bad", "good"]
            )

    counted = sample.mapInArrow(present, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    usual = counted.where(f"good > 0 and bad * {clean} <= 4.0 * good * {toxic}")
    return frozenset(r["word"] for r in usual.select("word").collect())  # words of the sample within two errors of a term


def fit(documents: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Model:
    """Lexicon and logistic weights, learned from the sample.  Without labels of either
    kind there is nothing to learn, and every text gets the share of toxic labels."""
    sample = labelled_sample(documents, labels, most).withColumn("text", F.coalesce("text", F.lit("")))
    sizes = {int(r["toxic"] > 0): r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    base = math.log((toxic + 0.5) / (clean + 0.5)) if toxic + clean else math.log(0.05 / 0.95)
    if not toxic or not clean:
        return Model(bias=base)
    sample = sample.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    model = Model(terms=learn_terms(sample, toxic, clean))
    model.usual = usual_variants(sample, model.terms, toxic, clean)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = [scorer.features(text) for text in batch.column(0).to_pylist()]
            arrays = [pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(1)], ["at", "value", "toxic"])

    rows = sample.mapInArrow(work, "at array<int>, value array<double>, toxic int").collect()  # at most ``most`` rows
    rows.sort(key=lambda r: (r["toxic"], r["at"], r["value"]))
    x = np.zeros((len(rows), len(model.terms) + EXTRA_FEATURES + 1))
    for i, r in enumerate(rows):
        x[i, r["at"]] = r["value"]
    x[:, -1] = 1
    weights = evidence_only(x, np.array([r["toxic"] for r in rows], float))
    model.weights, model.bias = weights[:-1].tolist(), float(weights[-1])
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last column, the
    constant, isn't shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + shrink * w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def evidence_only(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """As ``logistic``, with features of negative weight left out until there are none:
    a hit never speaks for a text, so what it counts for acts in one direction."""
    out, used = np.zeros(x.shape[1]), np.arange(x.shape[1])
    while True:
        w = logistic(x[:, used], y)
        keep = (w >= 0) | (used == x.shape[1] - 1)
        if keep.all():
            out[used] = w
            return out
        used = used[keep]


def toxicity(documents: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents``.

    Terms and weights are learned from at most ``most`` labelled rows outside the
    held-out fold; every whole text is scored.  Only the text enters a score.  A text
    without terms (also a null or empty one) gets the score of having none.  Several
    labels of one id count as toxic if one is; null labels don't count.  Repeated rows
    get equal scores, a null id belongs to the fold of the empty text, an empty table
    gives no rows, and other columns don't matter."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id"), "text")
    with scratch(documents.sparkSession):
        model = fit(rows, labels, most)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.score(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), batch.column(2)], ["doc_id", "score", "held_out"])

    rows = rows.withColumn("held_out", fold("doc_id") == 0)
    scored = rows.mapInArrow(work, "doc_id long, score double, held_out boolean")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(documents: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """The rows of ``documents`` whose score is below 0.5."""
    small_batches(documents.sparkSession)
    with scratch(documents.sparkSession):
        model = fit(documents.select("doc_id", "text"), labels, most)
    scorers: list[Scorer] = []

    @F.pandas_udf("double")
    def score(texts):
        if not scorers:
            scorers.append(Scorer(model))
        return texts.map(lambda t: scorers[0].score(t or "")).astype("float64")

    return documents.where(score("text") < 0.5)
