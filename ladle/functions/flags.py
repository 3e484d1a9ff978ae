"""Keyword flags, tags, time buckets and safe ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions import fixed


def _any_word(text: Column, keywords: Sequence[str]) -> Column:
    found = F.lit(False)
    for k in keywords:
        found = found | text.contains(k)
    return found


def has_any(lines: Column, keywords: Sequence[str]) -> Column:
    """True when any line contains any keyword as a substring (``ham`` is found in ``graham``)."""
    return F.coalesce(F.exists(lines, lambda x: _any_word(x, keywords)), F.lit(False))


def text_has_any(text: Column, keywords: Sequence[str]) -> Column:
    return F.coalesce(_any_word(text, keywords), F.lit(False))


def keyword_flags(
    df: DataFrame, lines: str, groups: Mapping[str, Sequence[str]] = fixed.PROTEIN_GROUPS, prefix: str = "has_"
) -> DataFrame:
    """One 0/1 column per keyword group; the table is returned as it is when ``lines`` is absent."""
    if lines not in df.columns:
        return df
    return df.withColumns({f"{prefix}{g}": has_any(F.col(lines), ws).cast("int") for g, ws in groups.items()})


def absence_flags(
    df: DataFrame,
    lines: str,
    meat: Sequence[str] = tuple(fixed.MEAT_WORDS),
    animal: Sequence[str] = tuple(fixed.ANIMAL_WORDS),
    gluten: Sequence[str] = tuple(fixed.GLUTEN_WORDS),
) -> DataFrame:
    """Diet flags: 1 when no keyword of the list occurs. A heuristic, not a verified claim."""
    if lines not in df.columns:
        return df
    c = F.col(lines)
    return df.withColumns({
        "is_likely_vegetarian": (~has_any(c, meat)).cast("int"),
        "is_likely_vegan": (~has_any(c, [*meat, *animal])).cast("int"),
        "is_likely_gluten_free": (~has_any(c, gluten)).cast("int"),
    })


def derived_tags(
    text: Column,
    explicit: Column | None = None,
    meat: Sequence[str] = tuple(fixed.MEAT_WORDS),
    animal: Sequence[str] = tuple(fixed.ANIMAL_WORDS),
    gluten: Sequence[str] = tuple(fixed.GLUTEN_WORDS),
) -> Column:
    """Sorted set of explicit tags and the tags the text allows; vegan only together with vegetarian."""
    text = F.lower(F.coalesce(text, F.lit("")))
    veg = ~text_has_any(text, meat)
    found = F.array(
        F.when(veg, F.lit("vegetarian")),
        F.when(veg & ~text_has_any(text, animal), F.lit("vegan")),
        F.when(~text_has_any(text, gluten), F.lit("gluten_free")),
    )
    given = F.array().cast("array<string>") if explicit is None else F.coalesce(
        explicit, F.array().cast("array<string>"))
    return F.array_sort(F.array_union(given, F.filter(found, lambda t: t.isNotNull())))


def detected_groups(text: Column, groups: Mapping[str, Sequence[str]] = fixed.PROTEIN_GROUPS) -> Column:
    """Names of the keyword groups found in the text, in the order of ``groups``."""
    text = F.lower(F.coalesce(text, F.lit("")))
    named = [F.when(text_has_any(text, ws), F.lit(g)) for g, ws in groups.items()]
    return F.filter(F.array(*named), lambda g: g.isNotNull())


def bucket_left_closed(
    c: Column, edges: Sequence[float] = tuple(fixed.TIME_EDGES), labels: Sequence[str] = tuple(fixed.TIME_LABELS)
) -> Column:
    """``[e0,e1) -> l0`` ... ``[e_last, inf) -> l_last``; below the first edge or NULL gives NULL."""
    out = None
    for edge, label in sorted(zip(edges, labels), reverse=True):
        hit = c >= F.lit(float(edge))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def bucket_right_closed(
    c: Column,
    steps: Sequence[tuple[float, str]] = tuple(fixed.TIME_STEPS),
    above: str = fixed.TIME_ABOVE,
    unknown: str = fixed.TIME_UNKNOWN,
) -> Column:
    out = F.when(c.isNull(), F.lit(unknown))
    for top, label in steps:
        out = out.when(c <= F.lit(float(top)), F.lit(label))
    return out.otherwise(F.lit(above))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with a zero denominator or an infinite result as NULL."""
    ratio = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return F.when(F.abs(ratio) != F.lit(float("inf")), ratio)


def binary_label(c: Column, at_least: float = fixed.POSITIVE_RATING) -> Column:
    """1 when the value reaches the threshold; NULL and NaN count as 0."""
    return F.coalesce((c >= F.lit(at_least)) & ~F.isnan(c.cast("double")), F.lit(False)).cast("int")
