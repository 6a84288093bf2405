"""Where a pattern matches, with built-in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches per run when match positions are summed up.
RUN = 256


def match_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches, in
    code points, end exclusive; ``value`` is the match's ``group``.

    The text between matches comes from splitting at the same pattern, so the
    starts are running sums of piece and match lengths. Texts without a match
    are searched once. The pattern must not match the empty text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.zip_with(F.slice(between, 1, F.size(found)), found,
                   lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("len"))),
        value, lambda a, v: F.struct(a["gap"].alias("gap"), a["len"].alias("len"), v.alias("value")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def place(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.struct(begin.alias("start"), (begin + x["len"]).alias("end"),
                        x["value"].alias("value"))
        return F.struct((begin + x["len"]).alias("at"),
                        F.concat(acc["out"], F.array(span)).alias("out"))

    # In runs of RUN matches, as appending to one long array would copy it each time.
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int")),
                       lambda k: F.slice(steps, k * RUN + 1, RUN))
    lengths = F.transform(runs, lambda run: F.aggregate(
        run, F.lit(0), lambda a, x: a + x["gap"] + x["len"]))
    offsets = F.aggregate(
        lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda a, n: F.struct((a["at"] + n).alias("at"),
                              F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]
    spans = F.flatten(F.zip_with(runs, offsets, lambda run, at: F.aggregate(
        run, F.struct(at.alias("at"), empty.alias("out")), place)["out"]))
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(empty)


def tagged(spans: Column, kind: str, order: int) -> Column:
    """``spans`` as (start, order, end, kind), which sorts by start, then kind."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
        F.lit(kind).alias("kind")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
