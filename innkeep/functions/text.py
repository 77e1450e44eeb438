"""Text expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from innkeep.functions import as_col

# Spaces of every kind, not only ASCII.
_SPACE = r"(?U)\s+"


# Accented Latin letters and their base letters; combining marks have none.
_ACCENTED = {
    ch: base[0]
    for ch in map(chr, range(0xE0, 0x250))
    if len(base := unicodedata.normalize("NFD", ch)) > 1 and base[0].isascii() and ch.islower()
}
_MARKS = "".join(map(chr, range(0x300, 0x370)))


def norm_key(c: Column | str) -> Column:
    """Join key that ignores case, accents and trailing blanks."""
    lower = F.lower(F.rtrim(as_col(c)))
    return F.translate(lower, "".join(_ACCENTED) + _MARKS, "".join(_ACCENTED.values()))


#: Compares text without case, accents and trailing blanks, in every script.
COLLATION = "UNICODE_CI_AI_RTRIM"


def collated(c: Column | str) -> Column:
    """Text under ``COLLATION``: joins, distinct, grouping, sorting and comparisons of the
    column then ignore case, accents and trailing blanks by Unicode's rules, with the
    spelling kept.  Unlike ``norm_key`` this covers Vietnamese, Greek, Cyrillic and other
    scripts, and letters that fold to several (``ß``)."""
    return F.collate(as_col(c), COLLATION)


def norm_id(c: Column | str) -> Column:
    """Identifier as trimmed text: ``123.0`` becomes ``123``, NULL becomes ``''``."""
    text = F.trim(as_col(c).cast("string"))
    return F.coalesce(F.regexp_replace(text, r"^(\d+)\.0$", "$1"), F.lit(""))


def id_text(c: Column | str) -> Column:
    """All-digit ids without leading zeros, others unchanged, NULL as ``''``."""
    text = as_col(c).cast("string")
    number = text.try_cast("decimal(38,0)").cast("string")
    return F.coalesce(F.when(text.rlike("^[0-9]+$"), number), text, F.lit(""))


def squeeze(c: Column | str) -> Column:
    """Line breaks and runs of blanks to one blank, trimmed."""
    return F.trim(F.regexp_replace(as_col(c), _SPACE, " "))


def non_blank(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(as_col(c), _SPACE, " ")) != ""


def phrase_pattern(phrases: Sequence[str]) -> str:
    """One case-insensitive pattern matching any of the literal phrases."""
    return "(?i)" + "|".join(re.escape(p) for p in phrases)


def excludes_phrases(c: Column | str, phrases: Sequence[str]) -> Column:
    """True where no phrase occurs, ignoring case (NULL text holds none)."""
    if not phrases:
        return F.lit(True)
    return ~F.coalesce(as_col(c).rlike(phrase_pattern(phrases)), F.lit(False))


def contains_ci(c: Column | str, piece: str) -> Column:
    return F.lower(as_col(c)).contains(piece.lower())


def trailing_tag(c: Column | str) -> Column:
    """Lower-cased text of a parenthesised tag at the end, NULL without one."""
    tag = F.regexp_extract(as_col(c), r"\(([^)]+)\)\s*$", 1)
    return F.lower(F.nullif(tag, F.lit("")))


def area(
    tag: Column | str,
    processor: Column | str,
    categories: Mapping[str, str],
    fallbacks: Sequence[tuple[Sequence[str], str]] = (),
) -> Column:
    """Category of a tag, else the first fallback rule naming the processor,
    else ``''``.  ``categories`` and ``fallbacks`` are small rule tables."""
    tag, processor = as_col(tag), as_col(processor)
    parts = []
    if categories:
        pairs = [F.lit(v) for kv in categories.items() for v in kv]
        parts.append(F.nullif(F.try_element_at(F.create_map(*pairs), tag), F.lit("")))
    parts += [F.when(processor.isin(*names), F.lit(value)) for names, value in fallbacks]
    return F.coalesce(*parts, F.lit(""))


def flag_text(name: Column | str, comment: Column | str) -> Column:
    """``name (comment)``, or the bare name when the comment is blank."""
    name, comment = as_col(name), as_col(comment)
    name = F.coalesce(name, F.lit(""))
    has = F.coalesce(F.trim(comment) != "", F.lit(False))
    return F.when(has, F.concat(name, F.lit(" ("), comment, F.lit(")"))).otherwise(name)


def size_label(beds: Column | str, baths: Column | str) -> Column:
    """``5br/4ba``; NULL when either number is."""
    return F.concat(
        as_col(beds).cast("string"), F.lit("br/"), as_col(baths).cast("string"), F.lit("ba")
    )


def unit_label(name: Column | str, size: Column | str) -> Column:
    """``name (size)``; the bare name when the size is unknown."""
    name = as_col(name)
    return F.coalesce(F.concat(name, F.lit(" ("), as_col(size), F.lit(")")), name)


def full_name(first: Column | str, last: Column | str) -> Column:
    blank = F.lit("")
    return F.trim(
        F.concat(F.coalesce(as_col(first), blank), F.lit(" "), F.coalesce(as_col(last), blank))
    )


def fix_labels(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Regular-expression corrections, applied in order."""
    out = as_col(c)
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    return out
