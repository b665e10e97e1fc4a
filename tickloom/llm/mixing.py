"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed pseudo-random order, are cut into blocks of ``BLOCK_ROWS``. Time runs in slots of one
block. Block j of a source with weight w (parts of all weights) is released at floor(j / w) and due at
ceil((j + 1) / w); in each slot the released block with the earliest deadline goes next. Since the
weights add up to one, every block meets its deadline, so at any time a source has had less than one
block more or less than its weight's share. When a source has no more blocks its slots fall to the others: time
jumps over slots in which nothing is released. No document is dropped or repeated.

A block lies within its own window of time, whatever the other sources have. At a time when every source's share is a whole
number of blocks, those blocks are done and no later one is released; such times come every ``period`` slots, PARTS at most, about. So the
stretches between them are scheduled by many tasks, each from counts that are known beforehand; a task holds one entry for each source.
Documents get their place by their block's place and their number in the block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain, islice
from math import gcd

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .ranking import numbered
from .storage import written

#: Rows of a block (the last block of a source may be shorter): a larger table has more blocks, not larger ones.
BLOCK_ROWS = 100
#: Weights are whole parts of this.
PARTS = 1_000_000
#: The least share of all sources without a given weight together.
LEFT_OVER = 0.01
#: Rows of the schedule that are sent on at a time.
SENT_ROWS = 10_000


def period(parts: dict[str, int]) -> int:
    """Slots after which each source's share is a whole number of blocks."""
    return sum(parts.values()) // gcd(*parts.values())


def pfair(blocks: dict[str, int], parts: dict[str, int], start: int = 0, stop: int | None = None) -> Iterable[tuple[str, int, int, int, int]]:
    """(source, block, time, release, deadline) in the order of slots. Weights are whole ``parts``; ties go to the earlier
    source name. Each block costs a step of a heap of the sources. ``start`` and ``stop``: only this stretch of time, both multiples
    of ``period``."""
    total = sum(parts[s] for s, n in blocks.items() if n)
    ends = {s: n if stop is None else min(n, stop * parts[s] // total) for s, n in blocks.items()}
    begins = {s: min(n, start * parts[s] // total) for s, n in blocks.items()}
    waiting, ready = sorted((begins[s] * total // parts[s], s, begins[s]) for s in blocks if begins[s] < ends[s]), []
    t = start
    while waiting or ready:
        if not ready and waiting[0][0] > t:
            t = waiting[0][0]
        while waiting and waiting[0][0] <= t:
            release, s, j = heappop(waiting)
            heappush(ready, (-(-(j + 1) * total // parts[s]), s, j, release))
        deadline, s, j, release = heappop(ready)
        yield s, j, t, release, deadline
        t += 1
        if j + 1 < ends[s]:
            heappush(waiting, ((j + 1) * total // parts[s], s, j + 1))


def _nothing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield from ()


def _schedule(blocks: dict[str, int], parts: dict[str, int], n: dict[str, int], block_rows: int):
    """Slots of the stretches whose numbers a task gets."""
    length, total = period(parts), sum(parts.values())

    def slots(stretch: int) -> Iterator[tuple]:
        done = {s: min(b, stretch * length * parts[s] // total) for s, b in blocks.items()}
        slot, rows = sum(done.values()), sum(min(n[s], d * block_rows) for s, d in done.items())
        for s, j, *times in pfair(blocks, parts, stretch * length, (stretch + 1) * length):
            yield s, j, *times, slot, rows
            slot, rows = slot + 1, rows + min(block_rows, n[s] - j * block_rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = chain.from_iterable(slots(i) for batch in batches for i in batch["id"].tolist())
        while part := list(islice(made, SENT_ROWS)):
            yield pd.DataFrame(part, columns=["source_key", "block", "time", "release", "deadline", "slot", "begins"])

    return run


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS, temperature: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (doc_id, source) with their place in the mixture, in columns ``mix_*``: position (0, 1, ...
    over all rows), block (of the source), slot, time, release, deadline, weight.

    ``weights`` gives sources' target weights as shares of the mixture; the rest of it, LEFT_OVER at least, is divided among
    the others by the power ``temperature`` of their rows. Weights are scaled to add up to one over the sources that have
    rows. ``carry``: the columns of ``docs`` to keep (default all).

    A null source is a source of its own. Null ids and repeated rows are rows like others. An empty
    table gives an empty result. Columns of ``docs`` that start with ``mix_`` would clash and are dropped.
    ``docs`` is read three times, so it should be a table rather than a costly plan.
    """
    names = [c for c in (docs.columns if carry is None else carry) if not c.startswith("mix_")]
    key = F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("source")))
    rows = docs.select(*names, key.alias("__source_key"), F.col("doc_id").alias("__id"))
    given = F.lit(None).cast("double")
    for s, w in sorted((weights or {}).items()):
        given = F.when(F.col("source_key") == f"={s}", F.lit(float(w))).otherwise(given)
    n_rows = rows.count()
    counts = rows.groupBy(F.col("__source_key").alias("source_key")).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy("one")  # one row for each source
    power = F.when(F.col("given").isNull(), F.pow(F.col("n").cast("double"), F.lit(temperature)))
    left = F.greatest(F.lit(LEFT_OVER), 1 - F.coalesce(F.sum("given").over(every), F.lit(0.0)))
    weighed = counts.withColumn("given", given).withColumn("one", F.lit(1)).withColumn("w", F.coalesce("given", power / F.sum(power).over(every) * left))
    shares = weighed.withColumn("share", F.col("w") / F.sum("w").over(every))
    sources = written(shares.select("source_key", "n", "share", F.greatest(F.lit(1), F.round(F.col("share") * PARTS)).cast("long").alias("parts"), F.ceil(F.col("n") / block_rows).cast("long").alias("blocks")), "mix-sources")
    held = sources.collect()  # one row for each source
    blocks, parts, n = ({r.source_key: r[c] for r in held} for c in ("blocks", "parts", "n"))
    length = period(parts) if held else 1
    stretches = max((-(-b * sum(parts.values()) // (parts[s] * length)) for s, b in blocks.items()), default=0)
    plan = docs.sparkSession.range(stretches).mapInPandas(_schedule(blocks, parts, n, block_rows) if held else _nothing, "source_key string, block long, time long, release long, deadline long, slot long, begins long")
    plan = written(plan.join(sources.select("source_key", "share"), "source_key"), "mix-plan")
    placed = numbered(rows, "__source_key", [F.xxhash64("__id", F.lit("mix")), F.col("__id")], n_rows, "mix_rank")
    placed = placed.withColumn("mix_block", F.floor(F.col("mix_rank") / block_rows)).join(plan, (F.col("__source_key") == F.col("source_key")) & (F.col("mix_block") == F.col("block")))
    position = F.col("begins") + F.col("mix_rank") - F.col("mix_block") * block_rows
    return placed.select(*names, position.alias("mix_position"), "mix_block", *(F.col(c).alias(f"mix_{c}") for c in ("slot", "time", "release", "deadline")), F.col("share").alias("mix_weight"))
