"""Label standardization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw label of a statement -> standard label.
STATEMENT_LABELS = {
    "pants-fire": "false", "false": "false", "barely-true": "false",
    "half-true": "mixed",
    "mostly-true": "true", "true": "true",
}

# Numeric form of an annotation label.
LABEL_CODES = {"false": 0, "true": 1, "unverified": 2}

#: Labels that take part in splits.
SPLIT_LABELS = ("true", "false", "mixed")


def statement_label(c: Column) -> Column:
    """Six-way truth rating to ``true``, ``false`` or ``mixed``; anything else is ``unknown``."""
    by_target: dict[str, list[str]] = {}
    for raw, target in STATEMENT_LABELS.items():
        by_target.setdefault(target, []).append(raw)
    out = F
    for target, raws in by_target.items():
        out = out.when(c.isin(*raws), target)
    return out.otherwise("unknown")


def annotation_label(misinformation: Column, true: Column, has_misinformation: Column, has_true: Column) -> Column:
    """Veracity from the two annotation flags; NULL where they say nothing or contradict each other.

    Flags are integers or their string form; ``has_*`` tells whether the key was there at all.
    """
    misinfo, verified = misinformation.try_cast("int"), true.try_cast("int")
    both = (
        F.when((misinfo == 0) & (verified == 0), "unverified")
        .when((misinfo == 0) & (verified == 1), "true")
        .when((misinfo == 1) & (verified == 0), "false")
    )
    only_misinfo = F.when(misinfo == 0, "unverified").when(misinfo == 1, "false")
    return F.when(has_misinformation & has_true, both).when(has_misinformation & ~has_true, only_misinfo)


def label_code(label: Column) -> Column:
    """Numeric form of an annotation label (0 false, 1 true, 2 unverified); NULL stays NULL."""
    out = F
    for name, code in LABEL_CODES.items():
        out = out.when(label == name, code)
    return out


def known_label(label: Column) -> Column:
    """NULL becomes ``unknown``."""
    return F.coalesce(label, F.lit("unknown"))


def thread_label(kind: Column, annotated: Column) -> Column:
    """Threads that carry no rumour are true; the others keep their annotated label."""
    return F.when(kind == "non-rumours", "true").otherwise(known_label(annotated))


def article_label(c: Column) -> Column:
    """``fake`` becomes ``false``, every other label ``true``."""
    return F.when(c == "fake", "false").otherwise("true")


def annotation_bucket(c: Column) -> Column:
    """Directory of an image annotation: ``fake``, ``real`` or ``unknown``, whatever the case."""
    low = F.lower(c)
    return F.when(low.isin("fake", "real"), low).otherwise("unknown")


def splittable(label: Column) -> Column:
    """True for the labels that take part in splits."""
    return F.coalesce(label.isin(*SPLIT_LABELS), F.lit(False))
