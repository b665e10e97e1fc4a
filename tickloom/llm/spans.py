"""Spans of regular-expression matches as DataFrame columns.

Spark's functions return what matched but not where. The pieces between the matches (``split``) and the
matches (``regexp_extract_all``) alternate, so their lengths give every position, in code points.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


#: Matches that are put together at a time: appending to a list costs as much as the list is long.
GROUP = 256


def spans(text: Column, regex: str, kind: int, holds: Callable[[Column], Column], likely: Column, around: int = 0) -> Column:
    """array<struct<start,kind,end,value>> of the leftmost non-overlapping matches for which ``holds(match)``;
    computed only for texts that are ``likely`` to have one. Matches must not be empty. With ``around`` a match also has
    ``before`` and ``after``: as many characters of the gaps to its neighbours or the text's ends."""
    pieces, found = F.split(text, regex, -1), F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    context = ",before:string,after:string" if around else ""
    kinds = f"array<struct<start:int,kind:int,end:int,value:string{context}>>"
    none = F.array().cast(kinds)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["value"])
        fields = [start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["value"].alias("value")]
        fields += [pair[c].alias(c) for c in ("before", "after")] if around else []
        return F.struct(end.alias("at"), F.when(holds(pair["value"]), F.concat(state["out"], F.array(F.struct(*fields)))).otherwise(state["out"]).alias("out"))

    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("piece"), found.alias("value"))
    if around:
        near = F.transform(pieces, lambda p: F.struct(F.right(p, F.lit(around)).alias("before"), F.substring(p, 1, around).alias("after")))
        zipped = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("piece"), found.alias("value"), F.slice(near, 1, F.size(found))["before"].alias("before"), F.slice(near, 2, F.size(found))["after"].alias("after"))

    def part(state: Column, g: Column) -> Column:
        inner = F.aggregate(F.slice(state["all"], g * GROUP + 1, GROUP), F.struct(state["at"].alias("at"), none.alias("out")), step)
        return F.struct(inner["at"].alias("at"), state["all"].alias("all"), F.concat(state["out"], F.array(inner["out"])).alias("out"))

    groups = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / GROUP).cast("int"))
    whole = F.aggregate(groups, F.struct(F.lit(0).alias("at"), zipped.alias("all"), F.array().cast(f"array<{kinds}>").alias("out")), part, lambda s: F.flatten(s["out"]))
    return F.when(likely & (F.size(found) > 0), whole).otherwise(none)


def joined(found: Column, names: Sequence[str]) -> Column:
    """``kind:start:end`` of the spans by start, then kind, comma-joined."""
    label = F.array(*(F.lit(n) for n in names))
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(label, s["kind"] + 1), s["start"], s["end"])), ",")


def of_kind(found: Column, kind: int) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def apart(found: Column, base: Column) -> Column:
    """The spans of ``found`` that overlap none of ``base``."""
    return F.filter(found, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def uncovered(found: Column, base: Column, least: int) -> Column:
    """What ``base`` leaves of the spans of ``found``: the parts of ``least`` characters or more outside all base spans."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def parts(s: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            own = F.struct(start.alias("start"), s["kind"].alias("kind"), end.alias("end"), F.substring(s["value"], start - s["start"] + 1, end - start).alias("value"))
            return F.when(end - start >= least, F.array(own)).otherwise(none)

        def step(state: Column, b: Column) -> Column:
            return F.struct(F.greatest(state["at"], b["end"]).alias("at"), F.concat(state["out"], part(state["at"], b["start"])).alias("out"))

        inside = F.array_sort(F.filter(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
        zero = F.struct(s["start"].alias("at"), none.alias("out"))
        return F.when(F.size(inside) == 0, F.array(s)).otherwise(F.aggregate(inside, zero, step, lambda x: F.concat(x["out"], part(x["at"], s["end"]))))

    return F.flatten(F.transform(found, parts))


def masked(text: Column, found: Column, mask: str) -> Column:
    """``text`` with each stretch covered by spans replaced by ``mask``.

    Spans are taken in groups: a group's stretch is cut from the text once, and its spans from that, so the cost grows with the text
    and the spans, not with their product."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    none = F.array().cast("array<string>")

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        piece = F.when(fresh, F.concat(F.substring(state["part"], state["at"] - state["from"] + 1, s["start"] - state["at"]), F.lit(mask))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["from"].alias("from"), state["part"].alias("part"), F.concat(state["out"], F.array(piece)).alias("out"))

    def group(state: Column, g: Column) -> Column:
        own = F.slice(state["all"], g * GROUP + 1, GROUP)
        last = F.greatest(F.array_max(F.transform(own, lambda s: s["end"])), state["at"])
        zero = F.struct(state["at"].alias("at"), state["at"].alias("from"), F.substring(text, state["at"] + 1, last - state["at"]).alias("part"), none.alias("out"))
        inner = F.aggregate(own, zero, step, lambda x: F.struct(x["at"].alias("at"), F.array_join(x["out"], "").alias("out")))
        return F.struct(inner["at"].alias("at"), state["all"].alias("all"), F.concat(state["out"], F.array(inner["out"])).alias("out"))

    groups = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / GROUP).cast("int"))
    whole = F.aggregate(groups, F.struct(F.lit(0).alias("at"), ordered.alias("all"), none.alias("out")), group, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)
