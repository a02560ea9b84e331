"""Spans of regular expressions as native columns.

``find`` marks every match with a separator, splits at it and adds up lengths, so
the start and end of each match come out in code points without Python. Java's
possessive quantifiers keep the patterns linear on very long texts. Nothing here
copies a text or a list of spans once per span: places are added up in groups
(``running``), and stretches are cut from chunks of a text (``cut``).

Where an argument must be a stored column, an expression given instead would be
evaluated once per element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands between pieces; in the searched copy of a text it is replaced by another control character.
_SEP, _STAND_IN = "\x01", "\x02"
SPAN = "struct<start:int,rank:int,end:int,kind:string,text:string>"


def searchable(text: Column) -> Column:
    """A copy of the same length in which no character can be taken for the separator."""
    return F.translate(F.coalesce(text, F.lit("")), _SEP, _STAND_IN)


def pieces(clean: Column, pattern: str) -> Column:
    """Text between and in the matches, in turn: even places lie between, odd ones match."""
    return F.split(F.regexp_replace(clean, pattern, f"{_SEP}$0{_SEP}"), _SEP, -1)


def running(values: Column, start: Column, step) -> Column:
    """For each value what ``step`` makes of ``start`` and the values before it; ``values`` must be a stored column.

    Adding to an array copies it, so the values are taken in groups of about the root of their number:
    a group adds to a short array, and only one value for each group to another.
    """
    n = F.size(values)
    width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    groups = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / width).cast("int") - 1, F.lit(0))),
                         lambda k: F.slice(values, k * width + 1, width))

    def scan(items: Column, first: Column, step_) -> Column:
        begin = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(items, begin, lambda acc, x: F.struct(
            step_(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    def total(at: Column, group: Column) -> Column:
        return F.aggregate(group, at, step)

    firsts = scan(groups, start, total)
    return F.flatten(F.transform(F.arrays_zip(groups.alias("g"), firsts.alias("f")),
                                 lambda z: scan(z["g"], z["f"], step)))


def find(parts: Column, kind: str, rank: int) -> Column:
    """Spans ``(start, rank, end, kind, text)`` of the matches in ``pieces``; ``parts`` must be a stored column."""
    none = F.array().cast(f"array<{SPAN}>")
    starts = running(parts, F.lit(0), lambda at, part: at + F.length(part))
    placed = F.filter(F.arrays_zip(parts.alias("part"), starts.alias("at")), lambda z, i: i % 2 == 1)
    spans = F.transform(placed, lambda z: F.struct(
        z["at"].alias("start"), F.lit(rank).alias("rank"), (z["at"] + F.length(z["part"])).alias("end"),
        F.lit(kind).alias("kind"), z["part"].alias("text")))
    return F.when(F.size(parts) > 1, spans).otherwise(none)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


#: Code points in a chunk of ``chunks``.
CHUNK = 1024


def chunks(text: Column) -> Column:
    """``text`` cut into chunks of ``CHUNK`` code points, from which ``cut`` takes stretches without counting from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(parts: Column, start: Column, length: Column) -> Column:
    """``length`` code points (none if negative) from place ``start`` (from 0) of a text in ``chunks``, a stored column."""
    first = F.floor(start / CHUNK).cast("int")
    last = F.least(F.floor((start + F.greatest(length, F.lit(1)) - 1) / CHUNK).cast("int") + 1, F.size(parts))
    own = F.array_join(F.slice(parts, first + 1, F.greatest(last - first, F.lit(0))), "")
    return F.when(length > 0, F.substring(own, start - first * CHUNK + 1, length)).otherwise(F.lit(""))


def _rewritten(parts: Column, length: Column, spans: Column, instead) -> Column:
    """A text in ``chunks`` with the stretches covered by sorted spans rewritten.

    ``instead(start, end, fresh)`` stands for what a span covers beyond the ones before it; ``fresh`` tells
    that it begins outside them. ``spans`` must be a stored column.
    """
    done = running(spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
    placed = F.arrays_zip(spans.alias("s"), done.alias("done"))

    def piece(z: Column) -> Column:
        begin = F.greatest(z["done"], z["s"]["start"])
        gap = cut(parts, z["done"], begin - z["done"])
        return F.concat(gap, instead(begin, z["s"]["end"], z["s"]["start"] >= z["done"]))

    end = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0))
    return F.concat(F.array_join(F.transform(placed, piece), ""), cut(parts, end, length - end))


def masked(parts: Column, length: Column, spans: Column, mask: str) -> Column:
    """The text with every stretch covered by sorted spans replaced by ``mask``, overlapping ones by one."""
    return _rewritten(parts, length, spans, lambda begin, end, fresh: F.when(fresh, F.lit(mask)).otherwise(F.lit("")))


def blanked(parts: Column, length: Column, spans: Column, filler: str) -> Column:
    """The text with every character covered by sorted spans replaced by ``filler``."""
    return _rewritten(parts, length, spans,
                      lambda begin, end, fresh: F.repeat(F.lit(filler), F.greatest(end - begin, F.lit(0))))
