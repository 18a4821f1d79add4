"""Exact Jaccard similarity join of word-shingle sets in a metric space.

Jaccard distance d = 1 - J is a metric, so pivots prune: with e the largest distance of a link,

* documents nearest to pivot q form q's Voronoi region; a document y is replicated to q's region when
  d(y, q) <= d(y, its nearest pivot) + 2e, and then no link crosses regions unseen;
* documents within e of the same pivot are in one component and need no pair of their own.

Pivots alone cannot start on a whole corpus: unrelated texts all lie at a distance near 1 from every
pivot, so that each is a boundary document of each region (README has figures). The first regions are
therefore balls that unrelated sets seldom share. The empty set is the first pivot: linked sets differ
little in size, so sizes are cut into classes, with the sets near a boundary in both. Two linked sets of a class differ in at
most D shingles; a hash cuts the shingle space into T > D parts, so that they agree wholly on at least
T - D of them, and every part of a set that is not empty is a region. Where a set has T - D empty parts
or more, all agreement could be on empty ones: such a set also joins the regions of its first
n - ceil(n p / 100) + 1 shingles, of which two linked sets share one.

Sets that share such a region are few, but among them are those that share a long passage and no link.
The second regions are therefore their rarest shingles: of n shingles ordered by the number of these sets
that hold them, two linked sets share one of the first n - ceil(n p / 100) + 1, and what a passage brings
to many sets stands at the end of that order. Regions are then joined recursively and exactly:

1. Equal sets are one node. A region of a single node is done.
2. Each node is compared with the smallest pivot of its regions; links make components. A region
   whose nodes are in one component is done; in the others, all nodes are compared with its own pivot.
3. A region that still holds several components and is small is a leaf: its sets move once, and one
   task counts what each node outside the largest component has in common with the others.
4. Larger ones draw more pivots (eight times as many a round), split into Voronoi regions with
   replicated boundaries wherever that separates them, and go on without the pivots until each has one
   component or is a leaf. Nothing is capped: a region of g unrelated nodes that no pivot separates ends
   with all of them compared.

Shingles are compared as 64-bit hashes, on whole sets. Skew: copies are collapsed before regions are
built; rows in regions are two numbers; components and minima are pre-aggregated, and the rows of a hot
region or pivot meet one row in a join, which AQE splits.

Disk: regions and shingles are many times the rows that remain of them, so large tables of them are
shuffled in turns, each stored before the next begins: regions by their hash, sets by their doc_id. The regions of single
sets are deleted when those that sets share are known, and the sets of other texts when the rarest shingles
are. A node is in many regions and pairs, each of which moves its set: distances are taken and leaves are
joined in as many turns as keep what one of them moves to about half of all sets. What no later step
reads is deleted.

A node is a distinct set, known by the number of one of its rows, so neither null nor repeated doc_ids
lose a set; doc_ids come in again when components are named.

Defined results: null, empty and wordless texts have an empty set and link with nothing; a text of
fewer words than a shingle has its whole word sequence as one shingle; equal sets always link; null
doc_ids take part, link nothing by themselves and are never the smallest unless a component has no other;
rows repeated under one doc_id are one document if their sets are equal, else ``linked_components`` links
them through their doc_id; an empty table gives an empty result. ``drop_near_duplicates`` goes by texts
alone, so a text without a near copy stays whatever else its doc_id holds; it keeps all columns whatever
their names.
"""

from __future__ import annotations

import bisect
import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tickflow.functions.sides import known_bytes
from tickflow.llm import common
from tickflow.llm.common import forget, forget_all, in_turns, map_in_arrow, read_table, shared_table
from tickflow.llm.components import components

#: Sizes of one class differ by less than this factor.
CLASS_RATIO = 1.4
#: Pivots of a region in the first round of the recursion; each round has eight times as many.
PIVOTS = 16
#: A region of at most so many nodes and shingles in all is joined within one task.
LEAF_NODES, LEAF_SHINGLES = 2_000, 1_000_000
#: Word hashes that a worker keeps; above, it starts afresh.
WORDS_KEPT = 400_000
#: A stored table from so many bytes on is shuffled in so many turns.
TURN_BYTES, TURNS = 16_000_000, 4
#: A split into Voronoi regions is used when it replicates rows by less than this factor.
SPLIT_GAIN = 1.5

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hash of each word."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, k: int, words: _Words) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles (A-Z lowered, split at ASCII white space)."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    size = min(k, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        out = _mix(out * _A + h[j:len(out) + j] * _B + _C)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


@functools.cache
def size_classes(percent: int) -> list[tuple[int, int, int]]:
    """(smallest size, D, T) of each class; D = 0 means that only equal sets link."""
    ratio, out, low = max(CLASS_RATIO, 100 / percent), [], 1
    while low < 1 << 40:
        following = max(low + 1, math.ceil(low * ratio))
        differ = 2 * (following - 1) * (100 - percent) // (100 + percent)
        # about twice as many spare parts as a set of this class has empty ones
        out.append((low, differ, differ + math.ceil(2 * (differ + 1) * math.exp(-low / (differ + 1)))))
        low = following
    return out


@functools.lru_cache(maxsize=100_000)
def own_classes(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(class, D, T) of a set of size n: its own, and the next where a larger partner can be."""
    classes = size_classes(percent)
    own = bisect.bisect_right(classes, n, key=lambda c: c[0]) - 1
    return [(c, *classes[c][1:]) for c in (own, own + 1) if classes[c][1] > 0 and (c == own or 100 * n >= percent * classes[c][0])]


def first_regions(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Regions of which any linked, different set has at least one too."""
    n = len(hashes)
    found = own_classes(n, percent) if n else []
    if not found:
        return np.empty(0, np.int64)
    places = (hashes >> np.uint64(32)).astype(np.int64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(hashes * _C), dtype=np.uint64)))
    out = []
    for c, differ, parts in found:
        # parts are ranges of the sorted hashes
        number = np.arange(parts + 1, dtype=np.int64)
        ends = np.searchsorted(places, ((number << 32) + parts - 1) // parts)
        filled = ends[1:] > ends[:-1]
        inside = (sums[ends[1:]] - sums[ends[:-1]])[filled]
        out.append(_mix(inside * _A + _mix(number[:-1][filled].astype(np.uint64) + np.uint64(c << 32))))
        if len(inside) <= differ:
            out.append(_mix(hashes[:n + (-n * percent // 100) + 1] * _B + np.uint64(c)))
    return np.concatenate(out).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays], dtype=np.int64)))
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))


def _each_set(docs: DataFrame, k: int, fields: list[T.StructField], make) -> DataFrame:
    """``docs`` without text, with the columns that ``make(sets)`` gives for each batch."""
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                if len(words) > WORDS_KEPT:
                    words.clear()
                sets = [shingle_set(t, k, words) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + make(sets), names=[f.name for f in kept + fields])

    return map_in_arrow(docs, run, T.StructType(kept + fields))


def _digests(sets: list[np.ndarray]) -> pa.Array:
    import xxhash
    return pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())


def describe(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n, digest, regions) of every row; digest is null for empty sets."""
    def make(sets: list[np.ndarray]) -> list[pa.Array]:
        return [pa.array([len(s) for s in sets], pa.int64()), _digests(sets), _lists([first_regions(s, percent) for s in sets])]
    fields = [T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("regions", T.ArrayType(T.LongType()))]
    return _each_set(docs, k, fields, make)


def _sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, n, shingles) of the wanted ``nodes`` (node, id, digest); a node may come more than once."""
    def make(sets: list[np.ndarray]) -> list[pa.Array]:
        return [pa.array([len(s) for s in sets], pa.int64()), _digests(sets), _lists([s.view(np.int64) for s in sets])]
    fields = [T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))]
    wanted = docs.join(nodes.select("id").distinct(), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    found = _each_set(wanted, k, fields, make).withColumnRenamed("digest", "_digest")
    return (found.join(nodes, (F.col("_digest") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("id")))
            .select("node", "n", "shingles"))


def _distances(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, pivot, d, linked) of every pair, by whole sets."""
    a = sets.select("node", F.col("n").alias("_na"), F.col("shingles").alias("_a"))
    b = sets.select(F.col("node").alias("pivot"), F.col("n").alias("_nb"), F.col("shingles").alias("_b"))
    common = F.size(F.array_intersect("_a", "_b")).cast("long")
    return (pairs.join(a, "node").join(b, "pivot").select("node", "pivot", common.alias("_c"), (F.col("_na") + F.col("_nb")).alias("_sum"))
            .select("node", "pivot", (1 - F.col("_c") / (F.col("_sum") - F.col("_c"))).alias("d"),
                    (F.col("_c") * 100 >= (F.col("_sum") - F.col("_c")) * percent).alias("linked")))


def _split(rows: DataFrame, far: DataFrame, e: float) -> DataFrame:
    """Voronoi regions with replicated boundaries of every region in ``rows``, without its pivots.

    ``far``: (region, node, pivot, d). A region that would be replicated by SPLIT_GAIN or more stays whole.
    """
    near = far.withColumn("_least", F.min("d").over(Window.partitionBy("region", "node"))).filter(F.col("d") <= F.col("_least") + 2 * e + 1e-9)
    before = rows.groupBy("region").agg(F.count(F.lit(1)).alias("_before"))
    after = near.groupBy("region").agg(F.count(F.lit(1)).alias("_after"), F.min("pivot").alias("_first"), F.max("pivot").alias("_last"))
    splits = (after.join(before, "region").filter((F.col("_after") < F.lit(SPLIT_GAIN) * F.col("_before")) & (F.col("_first") < F.col("_last")))
              .select("region", F.lit(True).alias("_splits")))
    whole = rows.join(splits, "region", "left_anti").select("region", "node")
    # a pivot has met the nodes of its own region only: elsewhere it stays
    done = far.select("region", F.col("pivot").alias("node")).distinct()
    parts = near.join(splits, "region").join(done, ["region", "node"], "left_anti").select(F.xxhash64("region", "pivot").alias("region"), "node")
    return whole.join(done, ["region", "node"], "left_anti").unionByName(parts)


def _turns(table: DataFrame) -> int:
    return 1 if known_bytes(table) < TURN_BYTES else TURNS


def _its_turn(key: str, turn: int, turns: int):
    """Rows whose ``key`` is of this turn; shuffles deal by another hash."""
    return F.lit(True) if turns == 1 else F.pmod(F.xxhash64(F.lit(turns), key), F.lit(turns)) == turn


def _rare_regions(sets: DataFrame, percent: int) -> DataFrame:
    """(region, node, pivot), stored: the sets that share one of their rarest shingles, with the smallest of them.

    Of n shingles in one common order, linked sets share one of their first n - ceil(n p / 100) + 1;
    the order here is by how many of the sets hold a shingle, then by its hash.
    """
    turns = _turns(sets)
    each = sets.select("node", F.col("n").alias("_n"), F.explode("shingles").alias("region"))
    several = in_turns(turns, lambda turn: each.filter(_its_turn("region", turn, turns)).groupBy("region")
                       .agg(F.count(F.lit(1)).alias("_sets")).filter("_sets > 1"), "several")
    by_set = Window.partitionBy("node")
    place = F.row_number().over(by_set.orderBy("_sets", "region"))
    # a set's shingles that no other set holds come first and need no region
    alone = F.col("_n") - F.count(F.lit(1)).over(by_set)
    first = F.col("_n") - F.expr(f"(_n * {percent} + 99) div 100") + 1
    kept = in_turns(turns, lambda turn: each.filter(_its_turn("node", turn, turns)).join(several, "region")
                    .withColumn("_place", place + alone).filter(F.col("_place") <= first).select("region", "node"), "rare-shingles")
    pivots = kept.groupBy("region").agg(F.min("node").alias("pivot"), F.max("node").alias("_last")).filter("pivot < _last").select("region", "pivot")
    found = shared_table(kept.join(pivots, "region").filter("pivot < node").select("region", "node", "pivot"), "rare")
    forget_all(several, kept)
    return found


def _sets_of(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``sets`` of the nodes and pivots of ``rows``, stored."""
    turns = _turns(sets)
    wanted = shared_table(rows.select("node").union(rows.select("pivot")).distinct(), "near-nodes")
    return common.in_turns(turns, lambda turn: sets.filter(_its_turn("node", turn, turns)).join(wanted, "node", "left_semi"), "near-sets")


class Join:
    """Distances taken so far, the links found and the components that they make."""

    def __init__(self, sets: DataFrame, percent: int, room: int | None = None):
        #: bytes of sets that one turn moves
        self.room = room or known_bytes(sets)
        self.sets, self.percent, self.e = sets, percent, (100 - percent) / 100
        self.known = None
        self.roots = sets.sparkSession.createDataFrame([], "node bigint, root bigint")

    def _stored(self, rows: DataFrame, key: str, make, name: str) -> DataFrame:
        """``make`` of ``rows`` (node, ...), stored in turns by ``key``, in each of which the rows move about ``room`` bytes or less."""
        moved = 8 * (rows.join(self.sets.select("node", "n"), "node").agg(F.sum("n")).first()[0] or 0)
        if moved <= max(self.room / TURNS, TURN_BYTES):
            return shared_table(make(rows), name)
        turns = max(TURNS, math.ceil(moved / max(self.room, TURN_BYTES)))
        rows = shared_table(rows, "asked")
        found = common.in_turns(turns, lambda turn: make(rows.filter(_its_turn(key, turn, turns))), name)
        forget_all(rows)
        return found

    def compare(self, pairs: DataFrame) -> None:
        """Distances of the pairs (node > pivot) that are not known yet; new links join components."""
        if self.known is not None:
            pairs = pairs.join(self.known.select("node", "pivot"), ["node", "pivot"], "left_anti")
        fresh = self._stored(pairs, "node", lambda some: _distances(some, self.sets, self.percent), "distances")
        self.known = fresh if self.known is None else self.known.unionByName(fresh)
        links = fresh.filter("linked").select(F.col("node").alias("u"), F.col("pivot").alias("v"))
        if not links.isEmpty():
            self.roots = components(links.union(self.roots))

    def both_ways(self) -> DataFrame:
        return self.known.select("node", "pivot", "d").union(self.known.select("pivot", "node", "d"))

    def unresolved(self, rows: DataFrame) -> DataFrame:
        """The rows (region, node, ...) of regions that hold more than one component."""
        labelled = rows.join(self.roots, "node", "left").withColumn("_root", F.coalesce("root", "node"))
        several = labelled.groupBy("region").agg(F.min("_root").alias("_a"), F.max("_root").alias("_b")).filter("_a < _b").select("region")
        return shared_table(rows.join(several, "region", "left_semi"), "open")

    def join_leaves(self, rows: DataFrame) -> None:
        """Find the links between components inside each small region (region, node) of ``rows``."""
        # regions of the very same nodes are one
        nodes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("_c"), F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("_y"))
        once = nodes.groupBy("_c", "_x", "_y").agg(F.min("region").alias("region")).select("region")
        labelled = rows.join(once, "region", "left_semi").join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        percent = self.percent

        def run(region: pa.Table) -> pa.Table:
            region = region.combine_chunks()
            node, root, n = (region[c].to_numpy() for c in ("node", "root", "n"))
            owner = np.repeat(np.arange(len(n)), n)
            # a shingle of one set alone is common to none
            _, number, held = np.unique(region["shingles"].combine_chunks().flatten().to_numpy(), return_inverse=True, return_counts=True)
            by_shingle = owner[np.argsort(number, kind="stable")]
            first = np.cumsum(held) - held
            ends = np.cumsum(n)
            roots, sizes = np.unique(root, return_counts=True)
            u, v, part = [], [], root.copy()
            for i in np.flatnonzero(root != roots[sizes.argmax()]).tolist():
                own = number[ends[i] - n[i]:ends[i]]
                own = own[held[own] > 1]
                count = held[own]
                places = np.arange(count.sum()) + np.repeat(first[own] - (np.cumsum(count) - count), count)
                common = np.bincount(by_shingle[places], minlength=len(n))
                found = np.flatnonzero((100 * common >= percent * (n[i] + n - common)) & (part != part[i]))
                found = found[np.unique(part[found], return_index=True)[1]]  # one link to each component, which is then one with this
                part[np.isin(part, part[found])] = part[i]
                u += [node[i]] * len(found)
                v += node[found].tolist()
            return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

        def joined(some: DataFrame) -> DataFrame:
            members = some.join(self.sets, "node").select("region", "node", "root", "n", "shingles")
            return members.groupBy("region").applyInArrow(run, "u bigint, v bigint")

        links = self._stored(labelled, "region", joined, "leaf-links")
        if not links.isEmpty():
            self.roots = components(links.union(self.roots))

    def search(self, rows: DataFrame) -> None:
        """Join every region of ``rows`` (region, node), recursively, until each holds one component."""
        pivots_each = PIVOTS
        while not rows.isEmpty():
            weight = rows.join(self.sets.select("node", "n"), "node").groupBy("region").agg(F.count(F.lit(1)).alias("_nodes"), F.sum("n").alias("_shingles"))
            large = weight.filter((F.col("_nodes") > LEAF_NODES) | (F.col("_shingles") > LEAF_SHINGLES)).select("region")
            large = shared_table(large, "large")
            self.join_leaves(rows.join(large, "region", "left_anti"))
            rows = rows.join(large, "region", "left_semi")
            if large.isEmpty():
                return
            salt = F.pmod(F.xxhash64("node", F.lit(pivots_each)), F.lit(pivots_each)).alias("_salt")
            chosen = rows.groupBy("region", salt).agg(F.min("node").alias("pivot")).select("region", "pivot")
            asked = shared_table(rows.join(chosen, "region").filter("node <> pivot"), "asked")
            self.compare(asked.select(F.greatest("node", "pivot").alias("node"), F.least("node", "pivot").alias("pivot")).distinct())
            still = self.unresolved(rows)
            far = (asked.join(still.select("region").distinct(), "region", "left_semi")
                   .join(self.both_ways(), ["node", "pivot"]).select("region", "node", "pivot", "d"))
            rows = self.unresolved(shared_table(_split(still, far, self.e).distinct(), "regions"))
            pivots_each *= 8


def _linked_sets(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, n, digest) and distinct sets (digest, node, n_copies, least, root), linked by their texts alone.

    ``least``: the smallest doc_id of the set; ``root``: the smallest node of its component.
    """
    described = shared_table(describe(docs, k, percent).withColumn("row", F.monotonically_increasing_id()), "shingles")
    found = shared_table(described.select("row", "doc_id", "n", "digest"), "rows")
    thin = found.filter("digest is not null").select("row", "doc_id", "digest")
    same = shared_table(thin.groupBy("digest").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("least")), "equal")
    # one row per distinct set: only the numbers of the other rows meet the table with the regions
    others = shared_table(thin.join(same.filter("n_copies > 1"), "digest").filter("row <> node").select("row", "doc_id", "digest"), "copies")
    nodes = described.filter("digest is not null").join(others.select("row"), "row", "left_anti").select(F.col("row").alias("node"), F.explode("regions").alias("region"))
    turns = _turns(described)

    def in_regions(turn: int) -> DataFrame:
        mine = nodes.filter(_its_turn("region", turn, turns))
        shared = shared_table(mine.groupBy("region").agg(F.min("node").alias("pivot"), F.max("node").alias("_last")).filter("pivot < _last").select("region", "pivot"), "pivots")
        return mine.join(shared, "region").filter("pivot < node").select("region", "node", "pivot")

    rows = in_turns(turns, in_regions, "regions")
    forget(described)
    wanted = rows.select("node").union(rows.select("pivot")).distinct()
    members = shared_table(thin.join(wanted, F.col("row") == F.col("node"), "left_semi").select(F.col("row").alias("node"), F.col("doc_id").alias("id"), "digest"), "nodes")
    forget_all(rows)
    twice = others.withColumnRenamed("digest", "_digest").join(members, (F.col("_digest") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    repeated = not twice.isEmpty()

    def in_sets(turn: int) -> DataFrame:
        # rows under one doc_id, null too, are of one turn, and so are those of a node
        sets = _sets(docs.filter(_its_turn("doc_id", turn, turns)), members.filter(_its_turn("id", turn, turns)), k)
        return sets.dropDuplicates(["node"]) if repeated else sets

    sets = in_turns(turns, in_sets, "sets")
    rows = _rare_regions(sets, percent)
    shared = shared_table(rows.select("region", "pivot").distinct(), "pivots")
    near = _sets_of(rows, sets)
    room = known_bytes(sets) // 2
    forget_all(sets)
    join = Join(near, percent, room)
    join.compare(rows.groupBy("node").agg(F.min("pivot").alias("pivot")))
    both = rows.select("region", "node").union(shared.select("region", F.col("pivot").alias("node")))
    left = join.unresolved(both)
    join.compare(rows.join(left.select("region").distinct(), "region", "left_semi").select("node", "pivot").distinct())
    join.search(join.unresolved(left.select("region", "node")))
    named = same.join(join.roots, "node", "left").select("digest", "node", "n_copies", "least", F.coalesce("root", "node").alias("root"))
    named = shared_table(named, "linked")
    forget_all(near, rows, shared, join.known, left, members, others, same)
    return found, named


def linked_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_copies (rows with its very set).

    ``docs``: doc_id (integer), text. Two documents link when 100 * intersection >= percent * union.
    """
    found, named = _linked_sets(docs.select("doc_id", "text"), k, percent)
    # sets of several components under one doc_id make these one
    held = found.filter("digest is not null and doc_id is not null").join(named.select("digest", "root"), "digest").select("doc_id", "root")
    several = held.groupBy("doc_id").agg(F.min("root").alias("v"), F.max("root").alias("_last")).filter("v < _last").select("doc_id", "v")
    edges = shared_table(held.join(several, "doc_id").select(F.col("root").alias("u"), "v").distinct(), "ids")
    if not edges.isEmpty():
        named = (named.join(components(edges).select(F.col("node").alias("root"), F.col("root").alias("_root")), "root", "left")
                 .withColumn("root", F.coalesce("_root", "root")))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("digest", "n_copies", "component_id")
    return (found.join(named, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.expr("if(digest is null, doc_id, component_id)").alias("component_id"),
                    F.coalesce("n_copies", F.lit(0)).alias("n_copies")))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component of texts one row with the smallest doc_id, and all empty ones."""
    found, named = _linked_sets(docs.select("doc_id", "text"), k, percent)
    first = named.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "digest")).alias("_first"))
    stays = shared_table(first.select(F.col("_first.least").alias("_id"), F.col("_first.digest").alias("_digest")), "near")
    full = found.filter("digest is not null").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    same = stays["_id"].eqNullSafe(full["_id"]) & (stays["_digest"] == full["_digest"])
    gone = shared_table(full.join(stays, same, "left_anti").select("_id").distinct(), "near")
    # a doc_id of one row says which row it is; the rows of others are told apart by their sets
    unclear = shared_table(found.groupBy(F.col("doc_id").alias("_id")).count().filter("count > 1 or _id is null").select("_id"), "near")
    kept = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
    if unclear.isEmpty():
        return kept
    kept = kept.join(unclear, docs["doc_id"].eqNullSafe(unclear["_id"]), "left_anti")
    asked = docs.join(unclear, docs["doc_id"].eqNullSafe(unclear["_id"]), "left_semi").select(F.struct("*").alias("row"), "doc_id", "text")
    sets = shared_table(_each_set(asked, k, [T.StructField("digest", T.BinaryType())], lambda sets: [_digests(sets)]), "near")
    same = sets["doc_id"].eqNullSafe(stays["_id"]) & (sets["digest"] == stays["_digest"])
    told = sets.join(stays, same, "left_semi").dropDuplicates(["doc_id", "digest"]).unionByName(sets.filter("digest is null"))
    return kept.unionByName(told.select("row.*"))


def op7_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return linked_components(read_table(spark, sf_dir, "documents"), 3, 90).select("doc_id", "n_shingles", "component_id")


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common, any_value(a.n + b.n) AS total
  FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90 GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs WHERE 100 * common >= 90 * (total - common)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.c AS component_id
FROM sets s JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) m ON m.x = s.doc_id
"""
