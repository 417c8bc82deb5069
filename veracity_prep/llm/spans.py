"""Places of regular-expression matches as native column expressions, in code points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements summed in one piece: running sums cost n * CHUNK steps, not n * n.
CHUNK = 500
#: Characters of context kept on either side of a match.
CONTEXT = 24


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def running_sums(numbers: Column) -> Column:
    """Sums of an array of longs up to and including each element."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def of_chunk(whole: Column, chunk: Column) -> Column:
        start = (chunk * CHUNK).cast("int")
        bound = F.struct(total(F.slice(whole, F.lit(1), start)).alias("base"), F.slice(whole, start + 1, F.lit(CHUNK)).alias("part"))
        return let(bound, lambda b: F.transform(b["part"], lambda _, i: b["base"] + total(F.slice(b["part"], F.lit(1), i + 1))))

    chunks = lambda a: F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int"))
    return let(numbers, lambda a: F.flatten(F.transform(chunks(a), lambda c: of_chunk(a, c))))


def cuts(text: Column, pattern: str, if_: Column | None = None) -> Column:
    """What is between the matches, and the matches; null where ``if_`` is false."""
    found = F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return found if if_ is None else F.when(if_, found)


def places(found: Column) -> Column:
    """Array of ``start, end, hit, before, after`` from what ``cuts`` gives, in order; empty without matches."""
    kind = "array<struct<start:bigint,end:bigint,hit:string,before:string,after:string>>"

    def of(f: Column) -> Column:
        n = F.size(f["hits"])
        steps = F.zip_with(F.slice(f["pieces"], F.lit(1), n), F.concat(F.array(F.lit("")), F.slice(f["hits"], F.lit(1), n - 1)), lambda p, h: (F.length(p) + F.length(h)).cast("long"))
        before = F.transform(F.slice(f["pieces"], F.lit(1), n), lambda p: F.substring(p, -CONTEXT, CONTEXT))
        after = F.transform(F.slice(f["pieces"], F.lit(2), n), lambda p: F.substring(p, 1, CONTEXT))
        rows = F.arrays_zip(running_sums(steps).alias("start"), f["hits"].alias("hit"), before.alias("before"), after.alias("after"))
        return F.transform(rows, lambda r: F.struct(r["start"].alias("start"), (r["start"] + F.length(r["hit"])).alias("end"), r["hit"].alias("hit"), r["before"].alias("before"), r["after"].alias("after")))

    return F.when(F.coalesce(F.size(found["hits"]), F.lit(0)) > 0, let(found, of)).otherwise(F.array().cast(kind)).cast(kind)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
