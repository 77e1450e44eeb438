"""Hard negatives, chat examples and phrases against brute force, on odd inputs too."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("innkeep.llm")

from innkeep.llm import chat, collocations, negatives  # noqa: E402

# -- hard negatives -----------------------------------------------------------


def test_products_modulo_small_primes_are_exact():
    rng = np.random.default_rng(3)
    for width, size in ((1, 3), (64, 256), (200, 40_000), (65, 2**40), (3, 2**100)):
        left, right = (np.floor(rng.uniform(-size, size, (n, width))) for n in (7, 5))
        want = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in right] for x in left]
        want = [[min(2**63 - 1, max(-(2**63), v)) for v in row] for row in want]
        got = negatives.Scorer(left).scores(right)
        assert got.tolist() == want


def test_moduli_are_primes_that_float32_can_hold():
    for bound in (1, 1 << 20, 1 << 60, 1 << 270):
        found = negatives.moduli(bound)
        assert np.prod([int(p) for p in found], dtype=object) > 2 * bound
        assert all(p % d for p in found for d in range(2, p))
        assert all(negatives.WIDTH * (p // 2) ** 2 < 2**24 for p in found)


def brute_negatives(rows, every=4, n=5, low=80, high=100):
    good = []
    for i, x, label in rows:
        if i is None or x is None or label is None or any(v is None or not np.isfinite(np.float32(v)) for v in x):
            continue
        good.append((i, [int(np.floor(256 * float(np.float32(v)))) for v in x], label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, x, label in good:
        if i % every:
            continue
        mates = sorted((-score(x, y), j) for j, y, k in good if k == label and j != i)[:n]
        for s, j in mates:
            near = sorted((-score(x, y), k) for k, y, m in good if m != label and low * -s <= 100 * score(x, y) <= high * -s)
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(near[:n], 1)]
    return out


VECTORS = "vec_id long, embedding array<float>, label int, row string, score int, anchor long"


def vector_rows(rng, n, width=70):
    centre = [rng.gauss(0, 1) for _ in range(width)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in centre], rng.randint(0, 2)) for i in range(n)]
    rows += [(n + 4 * i, list(rows[0][1]), rows[0][2]) for i in range(9)]  # ties
    rows += [(1000, None, 1), (1004, [1.0, None], 1), (1008, [float("nan")] * width, 1), (1012, [float("inf")] * width, 1)]
    rows += [(1016, rows[1][1], None), (None, rows[1][1], 1), (1020, [], 1), (1024, [1.0, 2.0], 2), (1028, [0.0] * width, 0)]
    return rows


@pytest.mark.parametrize("tile", [16_384, 16])
def test_hard_negatives(spark, rows, tile):
    data = vector_rows(random.Random(11), 90)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in data], VECTORS)
    got = negatives.hard_negatives(df, F.col("vec_id") % 4 == 0, tile=tile)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(data)
    assert len(want) > 200 and rows(got) == sorted(want, key=repr)


def test_huge_components_and_equal_rows(spark, rows):
    rng = random.Random(2)
    data = [(i, [rng.choice((-1, 1)) * 10.0 ** rng.randint(0, 4) for _ in range(8)], i % 2) for i in range(40)]
    data += [(100 + i, data[0][1], 0) for i in range(60)]  # a third of the rows alike
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in data], VECTORS)
    assert rows(negatives.hard_negatives(df, F.col("vec_id") % 4 == 0)) == sorted(brute_negatives(data), key=repr)
    df = spark.createDataFrame([(i, [3e38, 1.0], i % 2, "x", 1, 2) for i in range(8)], VECTORS)
    assert {r["negative_score"] for r in negatives.hard_negatives(df, F.col("vec_id") == 0).collect()} == {2**63 - 1}


def test_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 4 == 0).collect() == []
    one = spark.createDataFrame([(1, [1.0], 1, "x", 1, 2)], VECTORS)
    assert negatives.hard_negatives(one, F.col("vec_id") % 4 == 0).collect() == []


# -- chat examples ------------------------------------------------------------

ODD = [
    r"\### Assistant: </turn> ok", "", None, "\n</turn>\n", "</turn>", "\\</turn", "\\\\### x", "#### y", "a\\", "### ### ", "ends\n",
    "### user:\nsaid\n</turn>\n", "ä ß 𝒳 日本", "\r\n\t",
]
TALK = "conv_id long, turn long, role string, text string, example int, part int, last string"


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(4)
    out = []
    for conv in [*range(12), None]:
        for turn in range(rng.randint(1, 30)):
            role = rng.choice(["user", "assistant", "system", None, "as\nsist:ant\\l", "### "])
            text = rng.choice(ODD) if rng.random() < 0.5 else "word " * rng.randint(0, 40)
            out.append((conv, rng.choice([turn, turn, turn, 3, None]), role, text))
    out += [out[5]] * 4 + [(77, 0, "user", "no reply")] + [(78, 1, "assistant", "alone")]
    out += [(500, i, ("user", "assistant")[i % 2], ODD[i % len(ODD)]) for i in range(len(out) // 2)]  # a third
    return out


def brute_talk(talk):
    by = collections.defaultdict(list)
    for conv, turn, role, text in talk:
        role, text = role or "", text or ""
        by[conv].append((turn is None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text))
    out = []
    for conv, turns in by.items():
        turns = [(t[2], t[4]) for t in sorted(turns)]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), digest(said), len(loss), digest(loss)))
    return out


@pytest.mark.parametrize("most, part", [(1 << 20, 1 << 18), (600, 300), (0, 1)])
def test_chat_digest(spark, rows, talk, most, part):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in talk], TALK)
    got = chat.chat_digest(df, most=most, part_bytes=part)
    assert rows(got.drop("formatted_chars")) == sorted(brute_talk(talk), key=repr)
    whole = chat.chat_digest(df)
    assert rows(got.select("conv_id", "formatted_chars")) == rows(whole.select("conv_id", "formatted_chars"))


@pytest.mark.parametrize("most, part", [(1 << 20, 1 << 18), (600, 300), (0, 1)])
def test_chat_examples(spark, talk, most, part):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in talk], TALK)
    found = chat.examples(df, most=most, part_bytes=part).collect()
    texts, spans = collections.defaultdict(list), {}
    for r in sorted(found, key=lambda r: (r["example"], r["part"])):
        at = (r["conv_id"], r["example"])
        if r["loss_start"] is not None:
            assert at not in spans and r["trainable"]
            spans[at] = (sum(map(len, texts[at])) + r["loss_start"], sum(map(len, texts[at])) + r["loss_end"])
        texts[at].append(r["text"])
    texts = {at: "".join(parts) for at, parts in texts.items()}
    read = {at: turns_of(text) for at, text in texts.items()}
    for (conv, n), turns in read.items():
        longest = max(e for c, e in read if c == conv)
        assert turns == read[conv, longest][: n + 1]  # all turns before, then the target
        assert (turns[-1][0] == "assistant") == ((conv, n) in spans)
        if (conv, n) in spans:
            first, last = spans[conv, n]
            assert re.sub(r"\\(### |</turn)", r"\1", texts[conv, n][first:last]) == turns[-1][1]
    replies = collections.Counter(c for c, _, role, _ in talk if role == "assistant")
    assert collections.Counter(c for c, _ in spans) == replies


def turns_of(text):
    parts = text.split("\n</turn>\n")
    assert parts.pop() == ""
    out = []
    for part in parts:
        line, body = part.split("\n", 1)
        assert line.startswith("### ") and line.endswith(":")
        plain = [re.sub(r"\\(### |</turn)", r"\1", x) for x in (line[4:-1], body)]
        out.append((plain[0].replace("\\l", "\n").replace("\\b", "\\"), plain[1]))
    return out


def test_escaping_marks_only_controls(spark):
    df = spark.createDataFrame([(t or "",) for t in ODD], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and "\n</turn>" not in r["e"] and not re.search(r"(?<!\\)(### |</turn)", r["e"])
        assert r["e"] == r["t"] or "### " in r["t"] or "</turn" in r["t"]


def test_no_conversations(spark):
    empty = spark.createDataFrame([], TALK)
    assert chat.chat_digest(empty).collect() == [] and chat.examples(empty).collect() == []


# -- phrases ------------------------------------------------------------------


def brute_phrases(docs, support, top, covered):
    found, words = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                found[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        hidden = set()
        for p, b in candidates.items():
            for n in range(2, len(p)):
                hidden |= {s for i in range(len(p) - n + 1) if 100 * b >= covered * f[s := p[i : i + n]]}
        rows = []
        for p, a in candidates.items():
            if p in hidden:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        rows.sort()
        out += [(lang, i, p.decode(), -a, left, right, words[lang], -s) for i, (s, a, p, left, right) in enumerate(rows[:top], 1)]
    return out


TEXTS = "doc_id long, text string, lang string, words int, phrase string, n string, shard string"


def phrase_docs(rng, n):
    words = "the of And inn key é ß night a b c d stay\x00 x\xa0y".split(" ")
    out = [("en", None), ("en", ""), (None, " \t\n"), ("und", "the inn, the inn"), ("xx", "one")]
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", None, "de", "und"])
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "\r\n", "?!", "\x0b"]) for _ in range(rng.randint(0, 60)))
        out.append((lang, text))
    return out + [("en", "hot the same line of words; again and again")] * (n // 2)


@pytest.mark.parametrize("support, window", [(30, 4 << 20), (5, 16), (1, 50)])
def test_phrases(spark, rows, monkeypatch, support, window):
    docs = phrase_docs(random.Random(support), 150)
    monkeypatch.setattr(collocations.windows, "__defaults__", (window,))
    df = spark.createDataFrame([(i % 100 or None, t, lang, 1, "p", "n", "s") for i, (lang, t) in enumerate(docs)], TEXTS)
    got = collocations.collocations(df, support, 40, 80)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_phrases(docs, support, 40, 80)
    assert len(want) >= (4 if support == 30 else 60) and rows(got) == sorted(want, key=repr)


def test_windows_miss_and_repeat_no_phrase():
    rng = random.Random(8)
    text = "".join(rng.choice(["aa", "B", "c" * 30, "."]) + rng.choice("  \t.") for _ in range(400)).encode()
    for most in (1, 7, 64, 10_000):
        import pyarrow as pa

        found = collections.Counter()
        chunk = collocations.Chunk("en", [pa.array([*w, b"."], pa.binary()) for w in collocations.windows(text, most)])
        for n in range(1, 5):
            for i in np.flatnonzero(chunk.counted(n)):
                found[tuple(chunk.vocabulary[j] for j in chunk.ids[i : i + n])] += 1
        want = collections.Counter()
        for piece in text.lower().split(b"."):
            w = piece.split()
            want.update(tuple(w[i : i + n]) for n in range(1, 5) for i in range(len(w) - n + 1))
        assert found == want


def test_a_common_phrase_over_small_chunks(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 50)
    docs = [("en", "good morning from the inn. " * 9)] * 40 + phrase_docs(random.Random(1), 40)
    df = spark.createDataFrame([(1, t, lang, 1, "p", "n", "s") for lang, t in docs], TEXTS)
    assert rows(collocations.collocations(df, 30, 100, 80)) == sorted(brute_phrases(docs, 30, 100, 80), key=repr)


def test_phrases_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], TEXTS)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None, 1, "p", "n", "s")], TEXTS)).collect() == []
