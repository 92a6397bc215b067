"""Text columns: trimming, blank handling, keyword rules, display labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import lexicon

Rule = tuple[str, Sequence[str]]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: Column | str) -> Column:
    return col(c).cast("string")


def trim_text(c: Column | str) -> Column:
    """Spaces only, like SQL ``trim``."""
    return F.trim(as_text(c))


def nullif_trim_text(c: Column | str) -> Column:
    return F.nullif(trim_text(c), F.lit(""))


def lower_trim_text(c: Column | str) -> Column:
    return F.lower(trim_text(c))


def upper_trim_text(c: Column | str) -> Column:
    return F.upper(trim_text(c))


def strip_text(c: Column | str) -> Column:
    """Every kind of whitespace off both ends; only the ends are scanned."""
    return F.btrim(as_text(c), F.lit(lexicon.STRIP_CHARACTERS))


def blank_markers_to_null(c: Column | str) -> Column:
    """For text that is already stripped."""
    return F.when(~col(c).isin(*lexicon.BLANK_MARKERS), col(c))


def clean_text(c: Column | str) -> Column:
    return blank_markers_to_null(strip_text(c))


def is_blank(c: Column | str) -> Column:
    return col(c).isNull() | (strip_text(c) == "")


def sentinel_to_null(c: Column | str, sentinel: str) -> Column:
    return F.when(col(c) != sentinel, col(c))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    test = c.contains(words[0])
    for word in words[1:]:
        test = test | c.contains(word)
    return test


def classify(c: Column | str, rules: Sequence[Rule], default: str) -> Column:
    """First matching rule wins; NULL text gets the default.

    The caller passes text in the case it wants compared.
    """
    labelled: Column | None = None
    for label, words in rules:
        test = contains_any(col(c), words)
        labelled = F.when(test, F.lit(label)) if labelled is None else labelled.when(test, F.lit(label))
    return F.lit(default) if labelled is None else labelled.otherwise(F.lit(default))


def mentions(c: Column | str, word: str) -> Column:
    """Case-insensitive occurrence; NULL text counts as no."""
    return F.coalesce(F.lower(col(c)).contains(word), F.lit(False))


def mention_count_flag(c: Column | str, word: str) -> Column:
    return mentions(c, word).cast("int")


def is_present(c: Column | str) -> Column:
    return col(c).isNotNull()


def extract_or_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.trim(F.regexp_extract(col(c), pattern, group)), F.lit(""))


def title_case(c: Column | str) -> Column:
    """Display form of a label: stripped, every word start upper-cased; NULL becomes ''.

    A word is a run of letters, so a letter after an apostrophe, digit or
    hyphen starts a new word.
    """
    lowered = F.lower(strip_text(c))
    pieces = F.regexp_extract_all(lowered, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.coalesce(F.array_join(F.transform(pieces, F.initcap), ""), F.lit(""))


def display_label(c: Column | str, labels: Mapping[str, str]) -> Column:
    """Mapped label, else the title-cased text; NULL becomes ''."""
    stripped = strip_text(c)
    mapped: Column | None = None
    for value, label in labels.items():
        test = stripped == value
        mapped = F.when(test, F.lit(label)) if mapped is None else mapped.when(test, F.lit(label))
    fallback = title_case(c)
    return fallback if mapped is None else mapped.otherwise(fallback)
