"""Spans of patterns in texts, in column expressions only.

A span is (start, end, rank, kind) in code points, end exclusive; ``rank`` is
the kind's place in its list. Positions come from what lies between matches:
``split`` gives the gaps, ``regexp_extract_all`` the matches, and the running
sum of their lengths the places.

Patterns must be written so that Java's matcher neither recurses nor backtracks
over a long text: repeated groups are possessive, and a pattern that begins
with a run of a class may begin only at the run's start or where the last match
ended (``\\G``), which are the only places where a leftmost match can begin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,rank:int,kind:string>>"
BLOCK = 256  # spans of a text that are walked together
FOUND = "array<struct<start:int,end:int,match:string,part:string>>"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_blocks(items: Column) -> Column:
    """An array as an array of arrays of ``BLOCK`` items, so that running sums copy a block and not all items."""
    def cut(these: Column) -> Column:
        last = F.floor((F.size(these) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(these, b * BLOCK + 1, F.lit(BLOCK)))

    return F.filter(once(items, cut), lambda x: F.size(x) > 0)


def running(blocks: Column, start: Column, of: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> Column:
    """``blocks`` as structs (at, block): ``at`` is what ``join`` makes of ``start`` and ``of`` all blocks before."""
    def step(acc: Column, x: Column) -> Column:
        return F.struct(join(acc["at"], of(x)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def zipped(these: Column) -> Column:
        ats = F.aggregate(these, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")), step, lambda a: a["out"])
        return F.arrays_zip(ats.alias("at"), these.alias("block"))

    return once(blocks, zipped)


def matches_in(c: Column, pattern: str, group: int | None = None) -> Column:
    """Leftmost non-overlapping matches of a pattern in a text expression with their places, as ``FOUND``."""
    p = F.lit(pattern)
    gaps = F.split(c, pattern, -1)

    def zipped_with(every: Column) -> Column:
        part = F.regexp_extract_all(c, p, F.lit(group)) if group else every
        return F.arrays_zip(every.alias("match"), part.alias("part"), F.slice(gaps, F.lit(1), F.size(every)).alias("gap"))

    zipped = once(F.regexp_extract_all(c, p, F.lit(0)), zipped_with)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        one = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), x["part"].alias("part"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def length(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["match"]))

    empty = F.array().cast(FOUND)
    blocks = running(in_blocks(zipped), F.lit(0), length, lambda at, n: at + n)
    return F.flatten(F.transform(blocks, lambda z: F.aggregate(z["block"], F.struct(z["at"].alias("at"), empty.alias("out")), step, lambda a: a["out"])))


def found(text: str, pattern: str, group: int | None = None, gate: Column | None = None) -> Column:
    """``matches_in`` of a column; ``gate`` is a cheap test that every matching text passes."""
    c = F.col(text)
    test = c.rlike(pattern) if gate is None else gate & c.rlike(pattern)
    return F.when(test, matches_in(c, pattern, group)).otherwise(F.array().cast(FOUND))


def walked(text: Column, sorted_spans: Column, make: Callable[[Column, Column, Column], Column], kind: str) -> Column:
    """``make(span, at, gap)`` for every span, as an array of ``kind``: ``gap`` is the text from ``at``, where the spans
    before end, to the span (empty where they overlap)."""
    def end(block: Column) -> Column:
        return F.array_max(F.transform(block, lambda x: x["end"]))

    def one(z: Column) -> Column:
        here = F.substr(text, z["at"] + 1, F.greatest(end(z["block"]) - z["at"], F.lit(0)))

        def step(acc: Column, x: Column) -> Column:
            gap = F.substr(acc["here"], acc["at"] - z["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
            return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["here"].alias("here"),
                            F.concat(acc["out"], F.array(make(x, acc["at"], gap))).alias("out"))

        return F.aggregate(z["block"], F.struct(z["at"].alias("at"), here.alias("here"), F.array().cast(f"array<{kind}>").alias("out")), step, lambda a: a["out"])

    blocks = running(in_blocks(sorted_spans), F.lit(0), end, lambda a, b: F.greatest(a, b))
    return F.flatten(F.transform(blocks, one))


def behind(text: Column, spans: Column) -> tuple[Column, Column]:
    """(where the last span ends, the text from there)."""
    at = F.coalesce(F.array_max(F.transform(spans, lambda x: x["end"])), F.lit(0))
    return at, F.substr(text, at + 1, F.length(text))


def as_spans(matches: Column, kind: str, rank: int, valid=None) -> Column:
    """``FOUND`` as ``SPAN``, without the matches that ``valid`` turns down."""
    kept = F.filter(matches, valid) if valid is not None else matches
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"),
                                                F.lit(rank).alias("rank"), F.lit(kind).alias("kind")))


def merged(*spans: Column) -> Column:
    """All spans by start, then rank, then end."""
    return F.array_sort(F.concat(*[F.transform(s, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"),
                                                                      x["end"].alias("end"), x["kind"].alias("kind")))
                                   for s in spans]))


def listed(sorted_spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(sorted_spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def replaced(text: Column, sorted_spans: Column, by: Callable[[Column], Column]) -> Column:
    """The text with every span replaced by ``by(span)``; where spans overlap, the first to begin is replaced up to its end,
    and a later one only beyond that."""
    pieces = walked(text, sorted_spans, lambda x, at, gap: F.concat(gap, F.when(x["start"] >= at, by(x)).otherwise(F.lit(""))), "string")
    return F.concat(F.array_join(pieces, ""), behind(text, sorted_spans)[1])
