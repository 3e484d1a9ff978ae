"""Text and duration expressions. All are column expressions; none needs a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.functions import fixed

_WORD = r"[\p{L}\p{N}_]"
_SPACE = r"(?U)\s+"
# Separators and the characters an item line may keep.
LINE_BREAKS = r"[\n;]+"
LINE_BREAKS_COMMAS = r"[\n;,|]+"
_NOT_KEPT = r"[^\p{L}\p{N}_\s./%-]"


def squeeze(c: Column) -> Column:
    """Collapse every run of Unicode white space to one blank and trim."""
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def clean_text(c: Column) -> Column:
    """White-space cleanup that keeps case; blank becomes NULL."""
    return F.nullif(squeeze(c), F.lit(""))


def duration_minutes(c: Column) -> Column:
    """``1 hr 30 mins`` -> 90.0; digits alone are minutes; anything else is NULL, never 0."""
    text = F.lower(squeeze(c))
    hours = F.regexp_extract(text, r"(\d+)\s*hr", 1).try_cast("double")
    minutes = F.regexp_extract(text, r"(\d+)\s*min", 1).try_cast("double")
    plain = F.when(text.rlike(r"^\d+$"), text.try_cast("double"))
    either = hours.isNotNull() | minutes.isNotNull()
    total = F.coalesce(hours, F.lit(0.0)) * 60.0 + F.coalesce(minutes, F.lit(0.0))
    return F.when(either, total).otherwise(plain)


def normalize_line(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.lower(c), _NOT_KEPT, " "))


def split_lines(c: Column, breaks: str = LINE_BREAKS) -> Column:
    """Split a blob into normalised lines without empties; NULL gives an empty list."""
    lines = F.filter(F.transform(F.split(c, breaks), normalize_line), lambda x: x != "")
    return F.coalesce(lines, F.array().cast("array<string>"))


def join_lines(lines: Column, sep: str = "|") -> Column:
    return F.array_join(lines, sep)


def unjoin_lines(c: Column, sep: str = "|") -> Column:
    parts = F.filter(F.split(c, "\\Q" + sep + "\\E"), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def distinct_words(lines: Column) -> Column:
    """Number of distinct blank-separated words over all lines."""
    words = F.split(F.array_join(lines, " "), _SPACE)
    return F.size(F.array_distinct(F.filter(words, lambda w: w != "")))


def per_item(total: Column, count: Column) -> Column:
    return F.coalesce(total / F.nullif(count, F.lit(0)), F.lit(0.0)).cast("double")


def model_text(c: Column, drop_words: Sequence[str] = tuple(fixed.UNIT_WORDS)) -> Column:
    """Lower case, standalone numbers and unit words removed, white space collapsed; NULL becomes ''."""
    start, end = f"(?<!{_WORD})", f"(?!{_WORD})"
    text = F.lower(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(text, start + r"\p{Nd}+(?:\.\p{Nd}+)?" + end, " ")
    text = F.regexp_replace(text, start + "(?:" + "|".join(drop_words) + ")" + end, " ")
    return squeeze(text)


def words(c: Column) -> Column:
    """Lower-case tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All n-grams of ``low..high`` tokens, joined by one blank.

    The token list is bound once as a lambda variable; used directly inside the inner lambda it would be
    computed again for every n-gram.
    """
    def of(toks: Column, n: int) -> Column:
        if n == 1:
            return toks
        starts = F.when(F.size(toks) >= n, F.sequence(F.lit(0), F.size(toks) - n)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(toks, i + j) for j in range(n)]))

    return F.flatten(F.transform(
        F.array(tokens), lambda toks: F.concat(*[of(toks, n) for n in range(low, high + 1)])
    ))


def padded_words(c: Column) -> Column:
    """Lower-case words with one blank on both sides."""
    return F.transform(
        F.filter(F.split(squeeze(F.lower(c)), " "), lambda w: w != ""),
        lambda w: F.concat(F.lit(" "), w, F.lit(" ")),
    )


def word_windows(w: Column, low: int, high: int) -> Column:
    """Character n-grams of one padded word of length L: every window shorter than L, and itself once when L <= ``high``."""
    none = F.array().cast("array<string>")

    def of(n: int) -> Column:
        last = F.char_length(w) - n + 1
        return F.when(last > 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(w, i, n))).otherwise(none)

    whole = F.when(F.char_length(w) <= high, F.array(w)).otherwise(none)
    return F.concat(*[of(n) for n in range(low, high + 1)], whole)


def char_ngrams(c: Column, low: int, high: int) -> Column:
    """Character n-grams inside the words of a text."""
    return F.flatten(F.transform(padded_words(c), lambda w: word_windows(w, low, high)))
