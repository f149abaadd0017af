"""Places of regular expressions in texts, as arrays of spans. DataFrame functions only.

Spark has functions for the matches of a pattern and for the text between them, but none for their
places. Both lists come from the same leftmost, non-overlapping search, so a match begins where the lengths of
all that stands before it add up. Lengths are added up in blocks, so that a text with very many matches costs
in proportion to them. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(lengths: Column) -> Column:
    """``total`` of an array, and the sums ``before`` each element."""
    empty = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<bigint>").alias("before"))
    return F.aggregate(lengths, empty, lambda held, x: F.struct(
        (held["total"] + x).alias("total"), F.concat(held["before"], F.array(held["total"])).alias("before")
    ))


def sums_before(lengths: Column) -> Column:
    """For each element of an array of bigint, the sum of those before it."""

    def blocks(values: Column) -> Column:
        last = F.greatest(F.floor((F.size(values) - 1) / BLOCK).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda b: _running(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))

    def shifted(cut: Column) -> Column:
        return bind(_running(F.transform(cut, lambda b: b["total"]))["before"], lambda at: F.flatten(
            F.transform(cut, lambda b, k: F.transform(b["before"], lambda x: x + F.get(at, k)))
        ))

    return bind(lengths, lambda values: bind(blocks(values), shifted))


def find(text: Column, pattern: str, make: Callable[[Column, Column, Column, Column], Column], kind: str) -> Column:
    """Per match of ``pattern`` in ``text``, ``make(start, end, match, text before it back to the last match)``.

    ``kind`` is the SQL type of what ``make`` gives. ``text`` is not null; without a match the array is empty.
    """

    def placed(matches: Column, gaps: Column) -> Column:
        size = lambda x: F.char_length(x).cast("bigint")
        lengths = F.transform(matches, lambda m, i: size(m) + size(F.get(gaps, i)))
        return bind(sums_before(lengths), lambda at: F.transform(matches, lambda m, i: bind(
            F.get(at, i) + size(F.get(gaps, i)), lambda start: make(start, start + size(m), m, F.get(gaps, i))
        )))

    empty = F.array().cast(f"array<{kind}>")
    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda matches: F.when(
        F.size(matches) > 0, bind(F.split(text, pattern, -1), lambda gaps: placed(matches, gaps))
    ).otherwise(empty))


SPAN = "struct<start:bigint,kind:int,end:bigint>"


def base_spans(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans ``start, kind, end`` of the matches that ``keep`` holds true for."""
    made = find(
        text, pattern, lambda start, end, match, _: F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), match.alias("match")
        ), "struct<start:bigint,kind:int,end:bigint,match:string>",
    )
    kept = F.filter(made, lambda s: keep(s["match"])) if keep else made
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (start < s["end"]))


def written(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of spans in their order, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
