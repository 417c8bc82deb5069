"""Numeric and formatting expressions on statements and images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of each past rating of a speaker.
HISTORY_WEIGHTS = {
    "mostly_true": 0.75,
    "half_true": 0.5,
    "barely_true": 0.25,
    "false": 0.0,
    "pants_on_fire": -0.5,
}


def count_or_zero(c: Column) -> Column:
    """A count read as DOUBLE, as INT: NULL and NaN become 0, fractions are cut."""
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(None).cast("double")).cast("int"), F.lit(0))


def speaker_total(history: dict[str, Column]) -> Column:
    """Sum of the five history counts."""
    names = list(HISTORY_WEIGHTS)
    total = history[names[0]]
    for name in names[1:]:
        total = total + history[name]
    return total


def reliability_score(history: dict[str, Column]) -> Column:
    """Weighted mean rating of a speaker; NULL without history."""
    weighted = None
    for name, weight in HISTORY_WEIGHTS.items():
        term = F.lit(weight) * history[name]
        weighted = term if weighted is None else weighted + term
    total = speaker_total(history)
    return F.when(total > 0, weighted / total)


def aspect_ratio(width: Column, height: Column) -> Column:
    return F.when(height > 0, width / height)


def size_text(width: Column, height: Column) -> Column:
    """``WxH``."""
    return F.concat_ws("x", width.cast("string"), height.cast("string"))


def two_decimals(c: Column) -> Column:
    """A non-negative DOUBLE with two decimals, rounded from its exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal form half up instead (1.125 to 1.13, 1.005 to 1.01). Here the rounding
    error of ``100 * c`` is recovered by splitting ``c`` into two halves of its mantissa.
    """
    scaled = c * 100
    split = c * F.lit(float(2**27 + 1))
    high = split - (split - c)
    error = (high * 100 - scaled) + (c - high) * 100
    whole = F.floor(scaled)
    rest = scaled - whole
    odd = whole % 2 == 1
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & odd)))
    cents = whole + up.cast("bigint")
    return F.when(c.isNotNull(), F.format_string("%d.%02d", F.floor(cents / 100), cents % 100))


def has_tags(tags: Column) -> Column:
    """True when a tag map holds at least one entry."""
    return F.coalesce(F.size(tags) > 0, F.lit(False))
