"""Near-duplicate documents by MinHash with tensored banding.

A plain banding scheme with L tables of k hashes computes L * k minhashes for each document. Here two
small collections of ``SIDE`` tuples of ``ROWS`` minhashes are computed, and the key of table (i, j)
is the pair of tuple i of the first and tuple j of the second collection: SIDE ** 2 tables of
2 * ROWS hashes from 2 * SIDE * ROWS minhashes. At a similarity s a pair shares no key with
probability below 2 * (1 - s ** ROWS) ** SIDE: 2e-4 at 0.8 for the values here, 4e-6 at 0.87.

Work follows the links, not the pairs. Documents with one set of shingles are one node. In each key's bucket every
member is paired with the most central one (a star), the pairs are verified on full sets, and links form
components. Where a bucket still holds several components, its documents are compared across components by an
exact join on prefixes: shingles are put in one order, the rare ones first, so that two sets of the wanted similarity
share one of their first few, at places that leave enough of both. Frequent shingles, such as a template's, come
last and make no candidates unless they make up a link's share of both sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components, joined_by
from .storage import small_batches, written
from .textkernel import Words, mixed, slices, window_hashes, words_of

SIDE, ROWS = 9, 2
SHINGLE, PERCENT = 5, 80
#: Slots of the table of shingle counts that gives the order of prefixes.
SLOTS = 1 << 17
#: Nodes (24 bytes each) that are sent to all tasks to pick documents; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_SEEDS = mixed(np.arange(1, 2 * 2 * SIDE * ROWS + 1, dtype=np.uint64)).reshape(2, 2 * SIDE * ROWS)


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by document) of the sorted distinct shingles of ``n`` words; a document with fewer
    words has its whole sequence as one shingle, one without words has none."""
    docs, per = len(words.first) - 1, np.diff(words.first)
    hashes = words.hashes()
    grams = window_hashes(hashes, n)
    whole = words.doc[: len(grams)] == words.doc[n - 1 :] if len(grams) else np.zeros(0, bool)
    short = np.flatnonzero((per > 0) & (per < n))
    alone = np.array([window_hashes(hashes[words.first[d] : words.first[d + 1]], int(per[d]))[0] for d in short.tolist()], np.uint64)
    values = np.concatenate([grams[whole], alone])
    owner = np.concatenate([words.doc[: len(grams)][whole], short]).astype(np.int64)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(docs + 1))


def _sign(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, off = shingle_sets(words_of(part.column("text"), lower=True), n)
                size = np.diff(off)
                full = size > 0
                sketch = np.zeros((len(size), 2 * SIDE * ROWS), np.uint64)
                ids = np.zeros((2, len(size)), np.int64)
                if full.any():
                    heads = off[:-1][full]
                    for k in range(2 * SIDE * ROWS):
                        h = (values ^ _SEEDS[0, k]) * (_SEEDS[1, k] | np.uint64(1))
                        sketch[full, k] = np.minimum.reduceat(h ^ (h >> np.uint64(32)), heads)
                    for k in range(2):  # two independent sums name the set
                        ids[k, full] = mixed(np.add.reduceat(mixed(values ^ _SEEDS[k, 0]), heads)).view(np.int64)
                halves = mixed(sketch.reshape(len(size), 2 * SIDE, ROWS) * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(halves.ravel()), 2 * SIDE).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("version"), pa.array(size, pa.int64()), pa.array(ids[0]), pa.array(ids[1]), lists], names=["doc_id", "version", "n_shingles", "set_a", "set_b", "halves"])

    return run


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                texts = pa.concat_arrays([part.column("text_a"), part.column("text_b")])
                values, off = shingle_sets(words_of(texts, lower=True), n)
                k, size = part.num_rows, np.diff(off)
                pair = np.repeat(np.arange(2 * k) % k, size)
                order = np.lexsort((values, pair))
                values, pair = values[order], pair[order]
                both = (values[1:] == values[:-1]) & (pair[1:] == pair[:-1])
                common = np.bincount(pair[1:][both], minlength=k)
                union = size[:k] + size[k:] - common
                linked = (100 * common >= percent * union) & (union > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked)], names=["a", "b", "linked"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (``a, b``) that are linked."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    told = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return written(told.mapInArrow(_verify(n, percent), "a long, b long, linked boolean"), "verified").where("linked").select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id, text).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a document's set has its distinct shingles of
    ``shingle`` words, or its whole sequence if it has fewer. Documents are linked if
    100 * intersection >= ``percent`` * union on the full sets. component_id is the smallest doc_id
    reachable over links, kept is doc_id = component_id.

    Null or empty texts have no shingles and are linked with nothing. Repeated rows are linked like any
    copies (a repeated doc_id gives a row for each); rows that share a doc_id with different texts are one document's, so
    all of them are in one component. Rows with a null doc_id take no part in links and are kept, with a null
    component_id. Other columns are ignored.
    """
    rows = small_batches(docs).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("version"))
    signed = written(rows.mapInArrow(_sign(shingle), "doc_id long, version long, n_shingles long, set_a long, set_b long, halves array<long>"), "minhash")
    told = F.expr("n_shingles > 0 and doc_id is not null")
    sets = signed.where(told).groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "version")).alias("row"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves"))
    reps = written(sets.select(F.monotonically_increasing_id().alias("id"), "set_a", "set_b", "row.*", "n", "halves"), "representatives")
    owners = written(signed.where(told).select("doc_id", "n_shingles", "set_a", "set_b").join(reps.select("set_a", "set_b", "id", F.col("doc_id").alias("first_doc")), ["set_a", "set_b"]).select("doc_id", "n_shingles", "id", "first_doc"), "owners")
    # a representative becomes SIDE ** 2 rows: small partitions keep the sums by key small
    spread = reps.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    first = spread.select("id", "n", "halves", F.posexplode(F.slice("halves", 1, SIDE)).alias("i", "g"))
    paired = first.select("id", "n", "i", "g", F.posexplode(F.slice("halves", SIDE + 1, SIDE)).alias("j", "h"))
    keys = paired.select("id", "n", F.xxhash64("i", "g", "j", "h").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("last"), F.count(F.lit(1)).alias("size")).where("least < last")
    members = written(keys.join(shared.select("key", "size"), "key"), "buckets")
    # the original of many copies is in more and fuller buckets than any copy: it is linked with those that are not linked with each other
    central = members.groupBy("id").agg(F.sum("size").alias("rank"))
    ranked = written(members.join(central, "id").select("key", "id", "n", "rank"), "ranked")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("rank", F.col("id").alias("pivot"), F.col("n").alias("pivot_n"))).alias("p")).select("key", "p.pivot", "p.pivot_n")
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent  # noqa: E731  sizes alone rule the rest out
    stars = ranked.join(pivots, "key").where(F.col("id") != F.col("pivot")).where(fits(F.col("n"), F.col("pivot_n"))).select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    texts = _texts_of(rows, reps, members)
    several = owners.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a < last").select("doc_id", "a")
    same_doc = owners.join(several, "doc_id").where("id <> a").select("a", F.col("id").alias("b"))
    found = written(components(_verified(stars, texts, shingle, percent).unionByName(same_doc)), "components")
    # buckets that hold several components, and their documents
    known = reps.select("id", "n").join(found, "id", "left").select("id", "n", F.coalesce("component_id", "id").alias("c"))
    split = members.select("key", "id").join(known, "id").groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    unsettled = members.join(split, "key", "left_semi").select("id").distinct()
    open_docs = written(known.join(unsettled, "id").join(texts, "id"), "open")
    across = _verified(_across(open_docs, percent, shingle), texts, shingle, percent)
    of_a, of_b = (known.select(F.col("id").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
    joins = across.join(of_a, "a").join(of_b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = components(joins).select(F.col("id").alias("c"), F.col("component_id").alias("into"))
    # the smallest doc_id goes from components to what they merge into and back before it meets the nodes, by then one row a component
    parts = known.join(reps.select("id", "doc_id"), "id").groupBy("c").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("sets"))
    parts = written(parts.join(merged, "c", "left").withColumn("into", F.coalesce("into", "c")), "parts")
    whole = parts.groupBy("into").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("parts"), F.sum("sets").alias("all")).where("all > 1").drop("all")
    n_nodes = reps.count()
    named = written(joined_by(parts.select("into", "c", "sets"), whole, "into", "parts", n_nodes).select("c", "component_id", "sets"), "named")
    placed = joined_by(known.select("id", "c"), named, "c", "sets", n_nodes).select("id", "component_id")
    linked = owners.join(placed, "id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "first_doc").alias("component_id"))
    alone = signed.where(~told).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _counts(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                values, _ = shingle_sets(words_of(part.column("text"), lower=True), n)
                counts += np.bincount((values & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["slot", "k"])

    return run


def prefix_lengths(size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of a set's first shingles must be looked at to meet every partner that is not smaller, and every partner."""
    least = -(-2 * percent * size // (100 + percent))
    return size - least + 1, size - -(-percent * size // 100) + 1


#: A set's 256 parities of its shingles by hash, as four numbers: two sets differ in a parity only by a shingle that one of
#: them lacks, so as many shingles at least as parities.
_BITS = ("bits_0", "bits_1", "bits_2", "bits_3")


def _prefixes(n: int, percent: int, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, off = shingle_sets(words_of(part.column("text"), lower=True), n)
                size = np.diff(off)
                owner = np.repeat(np.arange(len(size)), size)
                order = np.lexsort((values, counts[(values & np.uint64(SLOTS - 1)).astype(np.int64)], owner))
                place = np.arange(len(values)) - np.repeat(off[:-1], size)
                short, long = prefix_lengths(size, percent)
                used = place < long[owner]
                of, at = owner[used], place[used]
                parity = np.bincount(owner * 256 + ((values >> np.uint64(40)) & np.uint64(255)).astype(np.int64), minlength=256 * len(size)) & 1
                bits = np.packbits(parity.astype(np.uint8)).view(np.int64).reshape(-1, 4)[of]
                fixed = [pa.array(part.column(c).to_numpy()[of]) for c in ("id", "n", "c")] + [pa.array(np.ascontiguousarray(bits[:, k])) for k in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array(values[order][used].view(np.int64)), *fixed, pa.array(at.astype(np.int32)), pa.array(at < short[of])], names=["token", "id", "n", "c", *_BITS, "place", "short"])

    return run


def _across(docs: DataFrame, percent: int, n: int) -> DataFrame:
    """Pairs ``a, b`` of ``docs`` (id, n, c, text) of different components c that can be linked: every linked pair is among them.

    A prefix's shingle brings together the sets that have it. Those of the component that has most of them are not paired
    with each other, so a component of any size costs no more than the pairs with other components. A pair
    must leave enough shingles behind the common one in both sets, and differ in no more parities than it may in shingles.
    """
    counted = docs.select("text").mapInArrow(_counts(n), "slot long, k long").groupBy("slot").agg(F.sum("k").alias("k")).where("k > 1").toArrow()  # at most SLOTS rows
    counts = np.zeros(SLOTS, np.int64)
    counts[counted.column("slot").to_numpy()] = counted.column("k").to_numpy()
    heads = written(docs.mapInArrow(_prefixes(n, percent, counts), "token long, id long, n long, c long, " + "".join(f"{b} long, " for b in _BITS) + "place int, short boolean"), "prefixes")
    by_component = heads.groupBy("token", "c").agg(F.count(F.lit(1)).alias("k"), F.bool_or("short").alias("short"))
    # a shingle that no set has among its very first makes no pair: a template's come later than a set's own, if those are enough to rule a link out
    mixed_tokens = by_component.groupBy("token").agg(F.max_by("c", F.struct("k", "c")).alias("most"), F.count(F.lit(1)).alias("cs"), F.bool_or("short").alias("short")).where("cs > 1 and short").select("token", "most")
    met = written(heads.join(mixed_tokens, "token").withColumn("in_most", F.expr("c = most")).drop("most"), "met")
    x, y = (met.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "c", *_BITS, "place", "short", "in_most"))) for s in "xy")
    x = x.where("short_x")
    need = F.ceil(F.lit(percent) * (F.col("n_x") + F.col("n_y")) / (100 + percent))
    apart = sum((F.bit_count(F.col(f"{b}_x").bitwiseXOR(F.col(f"{b}_y"))) for b in _BITS[1:]), F.bit_count(F.col("bits_0_x").bitwiseXOR(F.col("bits_0_y"))))
    fits = F.expr("(n_x < n_y or (n_x = n_y and id_x < id_y)) and c_x <> c_y") & (100 * F.col("n_x") >= percent * F.col("n_y")) & (F.col("n_x") - F.col("place_x") >= need) & (F.col("n_y") - F.col("place_y") >= need) & (apart <= F.col("n_x") + F.col("n_y") - 2 * need)
    pairs = [p.join(q, "token").where(fits).select(F.col("id_x").alias("a"), F.col("id_y").alias("b")) for p, q in ((x.where("in_most_x"), y.where("not in_most_y")), (x.where("not in_most_x"), y))]
    return pairs[0].unionByName(pairs[1]).distinct()


def _texts_of(rows: DataFrame, reps: DataFrame, members: DataFrame) -> DataFrame:
    """``id, text`` of the nodes that share a bucket, one row each, written once."""
    ids = reps.join(members.select("id").distinct(), "id", "left_semi").select("id", "doc_id", "version")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return written(rows.join(wanted, ["doc_id", "version"]).select("id", "text").dropDuplicates(["id"]), "texts")
