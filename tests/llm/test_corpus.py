"""Operators over the whole corpus: exact dedup, sharding, mixing, Jaccard join, nearest neighbours, pipeline."""

import math
import os
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.llm import ann, common, exact_dedup, jaccard_join, mixing, sharding
from tickflow.llm import components as components_module
from tickflow.llm.components import components

SCHEMA = "doc_id bigint, text string, source string, keep_id int"
LONG = " ".join(f"word{i}" for i in range(6000))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)


ROWS = [(5, "a  b", "s"), (3, "a\tb", None), (9, None, "s"), (8, "", "t"), (7, LONG, "s"), (4, LONG.replace(" ", "\n"), "t"), (6, LONG + "x", "s"), (1, "c", "u"), (1, "c", "u"), (None, "d", "s")]


def test_exact_dedup(spark):
    docs = frame(spark, ROWS)
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.group_equal(docs).collect()}
    keep = {k[0]: (r.keep_id, r.group_size, r.kept) for k, r in got.items()}
    assert keep == {5: (3, 2, False), 3: (3, 2, True), 9: (8, 2, False), 8: (8, 2, True), 7: (4, 2, False), 4: (4, 2, True), 6: (6, 1, True), 1: (1, 2, True), None: (None, 1, True)}
    left = exact_dedup.deduplicate(docs)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 3, 4, 6, 8]
    assert exact_dedup.group_equal(docs.limit(0)).count() == 0


def test_chunks_cover_the_text_and_collisions_are_found(spark):
    docs = frame(spark, ROWS)
    norm = exact_dedup.normalised(F.col("text"))
    joined = docs.select(norm.alias("n"), F.array_join(exact_dedup.chunks(norm), "").alias("c"), F.size(exact_dedup.chunks(norm)).alias("k")).collect()
    assert all(r.n == r.c for r in joined) and max(r.k for r in joined) > 5

    def weak(draw, chunk):  # collides in the first draw
        return exact_dedup.identifier(draw, chunk) if draw else [F.length(chunk).cast("bigint") % 2, F.lit(0).cast("bigint")]
    assert exact_dedup.verified_draw(docs, identify=weak) == 1
    assert exact_dedup.group_equal(docs, identify=weak).filter("kept").count() == 7


def test_sharding_law(spark):
    rows = spark.range(1003).select(F.col("id").alias("doc_id"), F.lit("x").alias("shard"), (F.col("id") % 3).alias("v"))
    for blocks in (1000, 5):  # one level of the tree, and several
        got = sharding.shuffle_to_shards(rows, ["doc_id"], 8, fan_out=4, rows_a_block=blocks).toPandas()
        sizes = got.groupby("shard").size()
        assert len(got) == 1003 == got.doc_id.nunique() and sizes.max() - sizes.min() <= 1 and len(sizes) == 8
        assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    again = sharding.shuffle_to_shards(rows.repartition(7), ["doc_id"], 8, fan_out=4, rows_a_block=5).toPandas()
    assert again.sort_values("doc_id")[["shard", "slot"]].to_numpy().tolist() == got.sort_values("doc_id")[["shard", "slot"]].to_numpy().tolist()
    assert sharding.shuffle_to_shards(rows.limit(0), ["doc_id"]).count() == 0
    edge = spark.createDataFrame([(None, None), (1, "a"), (1, "a")], "doc_id bigint, text string")
    assert sharding.shuffle_to_shards(edge, ["doc_id", "text"], 2).groupBy("shard").count().count() == 2


def test_hypergeometric_draws_have_their_law(spark):
    total, good, draws, n = 40, 15, 12, 6000
    got = spark.range(n).select(sharding.hypergeometric(F.lit(total).cast("long"), F.lit(good).cast("long"), F.lit(draws).cast("long"),
                                                        (F.col("id") + 0.5) / n).alias("v")).groupBy("v").count().collect()
    for r in got:  # evenly spaced uniforms reproduce the law up to rounding
        exact = math.comb(good, r.v) * math.comb(total - good, draws - r.v) / math.comb(total, draws)
        assert abs(r["count"] / n - exact) < 2 / n
    sure = spark.range(1).select(*[sharding.hypergeometric(*[F.lit(x).cast("long") for x in a], F.lit(0.7)).alias(f"c{i}") for i, a in enumerate([(5, 0, 3), (5, 5, 3), (5, 2, 5), (5, 2, 0)])]).first()
    assert tuple(sure) == (0, 3, 2, 0)


def test_sharding_query(spark):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in sharding.op2_sharding(spark, sf).collect():
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "rows" and r.grown_shard is None


def brute_targets(sizes, weights=(5, 2, 1), bound=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest, share = total - sum(fixed.values()), sum(w[s] for s in names if s not in fixed)
        out = {**fixed, **{s: rest * w[s] / share for s in free}}
        over = [s for s in free if out[s] > bound * sizes[s]]
        if not over:
            return out
        fixed |= {s: bound * sizes[s] for s in over}


def test_mixing(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), ["hot", "a", "b", "é", None, "tiny"][min(5, int(rng.integers(0, 12)) // 2)] if i else "tiny") for i in range(700)]
    rows += [(1000, None, "a"), (1001, "  ", None), (1002, "q q", "a"), (1002, "q q", "a")]
    docs = frame(spark, rows)
    got = mixing.plan(docs).toPandas()
    got["source"] = got.source.where(got.source.notna(), None)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(sizes)
    for s, n in sizes.items():
        own = got[got.source.isna()] if s is None else got[got.source == s]
        assert own["size"].sum() == n == own.source_size.iloc[0] and abs(own.target.iloc[0] - want[s]) < 1e-6 * n
        assert abs((own.copies * own["size"]).sum() - want[s]) <= own["size"].max()
    assert len(got) == len(rows) and got.copies.between(0, 3).all()
    again = mixing.plan(docs.repartition(5)).toPandas()
    order = ["doc_id", "size", "copies"]
    assert got.sort_values(order)[order].to_numpy().tolist() == again.sort_values(order)[order].to_numpy().tolist()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == got.copies.sum()
    assert mixing.plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def brute_components(texts, k, percent):
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("k,percent,leaf", [(3, 90, 1), (5, 80, 1), (3, 90, 2000), (5, 80, 2000)])
def test_jaccard_join_equals_brute_force(spark, k, percent, leaf, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PIVOTS", 2)
    monkeypatch.setattr(jaccard_join, "LEAF_NODES", leaf)  # 1: all by pivots
    rng = np.random.default_rng(k)
    passage = [f"passage{i}" for i in range(30)]
    texts = [None, "", "One two", "one TWO", "x", " \n"]
    for _ in range(12):
        base = [f"w{int(x)}" for x in rng.integers(0, 4000, int(rng.integers(5, 150)))]
        if rng.random() < 0.6:
            base[3:3] = passage
        for _ in range(int(rng.integers(1, 9))):  # drifting copies, so that links chain
            for at in rng.integers(0, len(base), int(rng.integers(0, 4))):
                base[at] = f"v{int(rng.integers(0, 9999))}"
            texts.append(" ".join(base))
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(texts)])
    sizes, roots = brute_components(texts, k, percent)
    got = {r.doc_id: r for r in jaccard_join.linked_components(docs, k, percent).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == roots
    left = jaccard_join.drop_near_duplicates(docs, k, percent)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [i for i, r in enumerate(roots) if r == i]


@pytest.mark.parametrize("leaf", [1, 5, 2000])
def test_jaccard_join_pivots_of_other_regions(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard_join, "LEAF_NODES", leaf)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 2)
    monkeypatch.setattr(jaccard_join, "SPLIT_GAIN", 1e9)  # every region splits
    rng = np.random.default_rng(11)
    sets = []
    for _ in range(30):  # two near copies each, unrelated to the others
        base = rng.integers(0, 1 << 40, 40).tolist()
        sets += [base, base[:-1] + [int(rng.integers(0, 1 << 40))]]
    home = [[2 * c, 2 * c + 1] + [int(x) for x in rng.choice(60, 6, replace=False)] for c in range(30)]
    small = [[int(x) for x in rng.choice(60, 2, replace=False)] for _ in range(60)]
    rows = [(r, n) for r, ns in enumerate(home + small) for n in set(ns)]
    table = spark.createDataFrame([(i, len(s), s) for i, s in enumerate(sets)], "node bigint, n bigint, shingles array<bigint>").cache()
    join = jaccard_join.Join(table, 90)
    join.search(spark.createDataFrame(rows, "region bigint, node bigint").cache())
    assert {r.node: r.root for r in join.roots.collect()} == {2 * c + 1: 2 * c for c in range(30)}


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_join_of_a_group_at_the_threshold(spark, k, percent):
    """Many copies of one text, each edited about as much as a link allows, and a passage that many other texts share."""
    rng = np.random.default_rng(percent)
    base, passage = [f"w{i}" for i in range(120)], [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"o{i}x{j}" for j in range(int(rng.integers(3, 60)))]) for i in range(80)]
    for i in range(120):
        own = list(base)
        for at in rng.choice(120, int(rng.integers(0, 5 if percent == 90 else 8)), replace=False):
            own[at] = f"v{int(rng.integers(0, 10))}"
        texts.append(" ".join(own))
    sizes, roots = brute_components(texts, k, percent)
    got = {r.doc_id: r for r in jaccard_join.linked_components(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), k, percent).collect()}
    assert [got[i].component_id for i in range(len(texts))] == roots and len(set(roots)) > 3


def test_jaccard_join_shuffles_large_tables_in_turns(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(60):
        base = [f"w{int(x)}" for x in rng.integers(0, 3000, 60)]
        texts += [" ".join(base), " ".join(base[:-1] + ["end"]), " ".join(base)]
    rows = [(None if i % 7 == 0 else i // 2, t, "s") for i, t in enumerate(texts)]
    in_turns, parts = jaccard_join.in_turns, {}

    def counted(turns, make, name):
        parts[name] = [make(turn).count() for turn in range(turns)]
        return in_turns(turns, make, name)

    whole = sorted(map(str, jaccard_join.linked_components(frame(spark, rows), 5, 80).collect()))
    forget, gone = jaccard_join.forget, []
    monkeypatch.setattr(jaccard_join, "forget", lambda table: (gone.append(table.inputFiles()[0].removeprefix("file:")), forget(table)))
    monkeypatch.setattr(jaccard_join, "in_turns", counted)
    monkeypatch.setattr(jaccard_join, "TURN_BYTES", 0)
    assert sorted(map(str, jaccard_join.linked_components(frame(spark, rows), 5, 80).collect())) == whole
    assert set(parts) == {"regions", "sets", "several", "rare-shingles"}
    for name, counts in parts.items():
        assert len(counts) == jaccard_join.TURNS and max(counts) < 0.6 * sum(counts), name
    assert len(gone) == 1 and gone[0].startswith("/") and not os.path.exists(gone[0])


def test_jaccard_join_leaves_give_a_link_a_component(spark, monkeypatch):
    near = [(i, 50, [*range(48), 100 + 2 * i, 101 + 2 * i]) for i in range(20)]
    chain = [(30 + i, 50, list(range(1000 + 3 * i, 1050 + 3 * i))) for i in range(6)]
    sets = spark.createDataFrame([*near, *chain, (40, 50, list(range(5000, 5050)))], "node bigint, n bigint, shingles array<bigint>")
    links, store = [], jaccard_join.shared_table
    monkeypatch.setattr(jaccard_join, "shared_table", lambda df, name: (found := store(df, name), links.append(found.count()))[0])
    join = jaccard_join.Join(sets, 80)
    join.join_leaves(sets.select(F.lit(1).cast("long").alias("region"), "node"))
    roots = {r.node: r.root for r in join.roots.collect()}
    assert roots == {**dict.fromkeys(range(1, 20), 0), **dict.fromkeys(range(31, 36), 30)}
    assert links == [19 + 5]  # a link each pair of the near ones before


def test_jaccard_join_moves_sets_of_many_regions_in_turns(spark, monkeypatch):
    """Each node is in six regions, so that its set would move six times at once."""
    monkeypatch.setattr(jaccard_join, "TURN_BYTES", 1)
    values = np.random.default_rng(3).integers(-2 ** 63, 2 ** 63 - 1, 3000).tolist()
    chain = [(i, 50, values[3 * i:3 * i + 50]) for i in range(20)]
    apart = [(100 + i, 50, values[1000 + 60 * i:1050 + 60 * i]) for i in range(20)]
    size = {node: n for node, n, _ in chain + apart}
    sets = common.shared_table(spark.createDataFrame(chain + apart, "node bigint, n bigint, shingles array<bigint>"), "test")
    regions = [(r, node) for r in range(6) for node in size if node != 100 + r]  # no two of the same nodes
    made, in_turns = {}, common.in_turns

    def counted(turns, make, name):
        made[name] = turns
        return in_turns(turns, make, name)
    monkeypatch.setattr(common, "in_turns", counted)
    join = jaccard_join.Join(sets, 80)
    join.join_leaves(spark.createDataFrame(regions, "region bigint, node bigint"))
    whole = dict.fromkeys(range(1, 20), 0)
    assert {r.node: r.root for r in join.roots.collect()} == whole
    moved = 8 * sum(size[node] for _, node in regions)
    assert made["leaf-links"] >= max(jaccard_join.TURNS, moved // jaccard_join.known_bytes(sets))
    pairs = [(x, y) for x in size for y in size if x - 9 < y < x]
    join = jaccard_join.Join(sets, 80)
    join.compare(spark.createDataFrame(pairs, "node bigint, pivot bigint"))
    assert {r.node: r.root for r in join.roots.collect()} == whole
    assert made["distances"] >= max(jaccard_join.TURNS, 8 * 50 * len(pairs) // jaccard_join.known_bytes(sets))
    assert join.known.count() == len(pairs)


def test_jaccard_join_leaves_no_large_tables_behind(spark, monkeypatch):
    base = " ".join(f"w{i}" for i in range(80))
    docs = frame(spark, [(i, f"{base} end{i}", "s") for i in range(8)] + [(20 + i, " ".join(f"x{i}y{j}" for j in range(60)), "s") for i in range(8)])
    stored, store = [], common._store
    monkeypatch.setattr(common, "_store", lambda df, name: (stored.append((name, path := store(df, name))), path)[1])
    got = {r.doc_id: r.component_id for r in jaccard_join.linked_components(docs, 5, 80).collect()}
    assert got == {**dict.fromkeys(range(8), 0), **{20 + i: 20 + i for i in range(8)}}
    left = {name for name, path in stored if os.path.exists(path.removeprefix("file:"))}
    assert "rows" in left and "linked" in left
    assert not left & {"shingles", "regions", "sets", "several", "rare-shingles", "rare", "near-sets", "distances", "nodes", "equal"}


def test_jaccard_join_edges(spark):
    docs = frame(spark, [(1, "a b c d", "s"), (1, "a b c d", "s"), (None, "a b c d", "s"), (2, None, "s")])
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.linked_components(docs, 3, 90).collect())
    assert got == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)]
    assert sorted(r.doc_id for r in jaccard_join.drop_near_duplicates(docs, 3, 90).collect()) == [1, 2]
    assert jaccard_join.linked_components(docs.limit(0), 3, 90).count() == 0


def test_jaccard_join_sets_under_shared_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    docs = frame(spark, [(3, b, "s"), (5, a, "s"), (5, b, "s"), (6, a + " z", "s"), (None, c, "s"), (None, c + " z", "s"),
                         (None, d, "s"), (8, d + " z", "s"), (None, None, "s"), (9, None, "s"), (9, "one two", "s")])
    docs = docs.withColumnRenamed("source", "_id")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_join.linked_components(docs, 3, 90).collect())
    assert got == [(0, 0, 0), (0, 38, 0), (0, 38, 8), (0, 39, 0), (3, 38, 3), (5, 38, 3), (5, 38, 3), (6, 39, 3), (8, 39, 8), (9, 0, 9), (9, 1, 9)]
    left = jaccard_join.drop_near_duplicates(docs, 3, 90)
    rows = [(r.doc_id, r.text) for r in left.collect()]
    assert left.columns == docs.columns and len(rows) == 7 and {(3, b), (5, a), (8, d + " z"), (None, None), (9, None), (9, "one two")} < set(rows)
    assert len({(None, c), (None, c + " z")} & set(rows)) == 1


def leaves(df):
    return df._jdf.queryExecution().analyzed().collectLeaves().size()


def test_components_plans_do_not_multiply(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(9)], "u bigint, v bigint")
    for i in range(4):
        edges = edges.union(spark.createDataFrame([(20 + i, i)], "u bigint, v bigint"))
    stored, store = [], common.shared_table
    monkeypatch.setattr(components_module, "shared_table", lambda df, name: (stored.append(leaves(df)), store(df, name))[1])
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == dict.fromkeys([*range(1, 10), *range(20, 24)], 0)
    assert max(stored) <= leaves(edges) + 1  # 12 times those of the edges, were they not stored


def test_turns_are_read_as_one_table(spark):
    found = common.in_turns(4, lambda turn: spark.range(turn * 10, turn * 10 + turn), "turns")
    assert leaves(found) == 1
    assert sorted(r.id for r in found.collect()) == [10, 20, 21, 30, 31, 32]


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory is read from /proc")
def test_a_stored_step_gives_back_native_memory_of_the_driver(spark, monkeypatch):
    jvm = spark._jvm
    own = f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup"

    def held():
        with open(own) as lines:
            return sum(int(line.split()[1]) for line in lines if line.startswith("Pss_Anon")) >> 10

    monkeypatch.setattr(common, "GIVE_BACK_S", 0)
    common.shared_table(spark.range(10), "warm")
    before = held()
    made = [jvm.java.util.zip.Deflater() for _ in range(2500)]  # about 0.1 MB each of the JVM's native memory
    full = held()
    for i, each in enumerate(made):
        if i % 10:
            each.end()
    common.shared_table(spark.range(10), "step")
    after = held()
    for each in made:
        each.end()
    assert full - before > 100
    assert after - before < (full - before) / 2


def test_a_heap_of_the_driver_that_has_grown_is_shrunk(monkeypatch):
    heap, done = {"total": 300, "after": 300}, []

    def gc():
        done.append("gc")
        heap["total"] = heap["after"]

    runtime = SimpleNamespace(totalMemory=lambda: heap["total"], maxMemory=lambda: 750)
    java = SimpleNamespace(lang=SimpleNamespace(Runtime=SimpleNamespace(getRuntime=lambda: runtime), System=SimpleNamespace(gc=gc)))
    spark = SimpleNamespace(_jvm=SimpleNamespace(java=java), sparkContext=SimpleNamespace(applicationId="heap"))
    monkeypatch.setattr(common, "_trim_jvm", lambda jvm: done.append("trim"))
    monkeypatch.setattr(common, "GIVE_BACK_S", 0)
    for total, after, expected in ((300, 300, ["trim"]), (700, 400, ["gc", "trim"]), (400, 400, ["trim"]), (410, 390, ["gc", "trim"]), (360, 360, ["trim"])):
        heap.update(total=total, after=after)
        done.clear()
        common.give_back_jvm(spark)
        assert done == expected and heap["total"] == after
    monkeypatch.setattr(common, "GIVE_BACK_S", 1e9)
    heap["total"] = 750
    done.clear()
    common.give_back_jvm(spark)
    assert not done


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (60, 61), (61, 62), (62, 60), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 0, 61: 60, 62: 60}


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 1, (1, 16)) + rng.normal(0, 0.3, (150, 16)) for _ in range(8)]).astype(np.float32)
    x[100:400] = x[100]  # a quarter are one vector
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    odd = [(5000, None, 1), (5020, [0.0] * 16, 1), (5040, [float("nan")] * 16, 1), (5060, [None] * 16, 1), (5080, [1.0], 1), (None, [1.0] * 16, 1), (20, rows[20][1], 1)]
    vectors = ann.usable(spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, rank int"))
    got = ann.search(vectors, vectors.filter("vec_id % 20 = 0"), 20, parts=8, probes=4).toPandas()
    assert set(got.query_id) == set(range(0, 1200, 20)) and (got.groupby("query_id").size() == 20).all()
    exact, hit = x.astype(float) @ x.T.astype(float), 0
    for q, g in got.sort_values("rank").groupby("query_id"):
        s = exact[q].copy()
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(s)), -np.round(s, 9)))[:20]
        hit += len(set(best) & set(g.vec_id))
        assert np.allclose(g.score, s[g.vec_id]) and q not in set(g.vec_id) and list(g.score) == sorted(g.score, reverse=True)
    assert hit / (20 * 60) >= 0.9
    assert ann.search(vectors.limit(0), vectors.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 15, 25, 60])
def test_nearest_neighbours_of_small_tables_and_repeated_ids(spark, n):
    """One probe asked for: partitions go on until k are found; repeated ids are rows of their own."""
    rng = np.random.default_rng(n)
    rows = [(int(i) % 7, [float(v) for v in rng.integers(-3, 4, 4)]) for i in rng.permutation(n)]
    rows += rows[:4] + [(0, [1e6, 1e6, 1e-3, 0.0]), (20, [3.0, 0.0, 0.0, 0.0]), (20, [2.0, 0.0, 0.0, 0.0])]
    sent = [r for r in rows if any(r[1])]
    rows = [(q, list(v)) for q, v in sorted({(q, tuple(v)) for q, v in sent})]
    vectors = ann.usable(spark.createDataFrame(sent, "vec_id bigint, embedding array<double>"))
    got = ann.search(vectors, vectors.filter("vec_id % 20 = 0"), 20, parts=8, probes=1).collect()
    want = []
    for i, (q, v) in enumerate(rows):
        if q % 20 == 0:
            near = sorted((-float(np.add.reduce(np.array(w) * np.array(v))), j) for k, (j, w) in enumerate(rows) if k != i)[:20]
            want.append([(q, rank, j, -s) for rank, (s, j) in enumerate(near, 1)])
    lists = sorted(x for one in want for x in one)
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert len(found) == len(lists) and {x[:2] for x in found} == {x[:2] for x in lists}
    if len(rows) <= 20:  # all are returned
        assert found == lists
    assert all(any(np.isclose(s, np.dot(v, w)) for j, w in rows if j == b for q, v in rows if q == a) for a, _, b, s in found)


def test_nearest_neighbours_whole_when_all_are_probed(spark):
    rng = np.random.default_rng(4)
    rows = [(i // 2, [float(v) for v in rng.integers(-2, 3, 5)]) for i in range(300)]
    sent = [r for r in rows if any(r[1])] + [(40, [2.0, 2.0, 2.0, 2.0, 2.0])] * 30
    rows = [(q, list(v)) for q, v in sorted({(q, tuple(v)) for q, v in sent})]
    vectors = ann.usable(spark.createDataFrame(sent, "vec_id bigint, embedding array<double>"))
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(vectors, vectors.filter("vec_id % 20 = 0"), 20, parts=4, probes=4).collect())
    want = Counter()
    for i, (q, v) in enumerate(rows):
        if q % 20 == 0:
            near = sorted((-float(np.dot(v, w)), j) for k, (j, w) in enumerate(rows) if k != i)[:20]
            want.update((q, rank, j, -s + 0.0) for rank, (s, j) in enumerate(near, 1))
    assert got == want


def test_nearest_neighbours_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.array(e.embedding.tolist(), float), e.vec_id.to_numpy()
    hit = total = 0
    for q, g in ann.op9_nearest_neighbours(spark, sf).toPandas().groupby("query_id"):
        i = int(np.searchsorted(ids, q))
        s = x @ x[i]
        s[i] = -np.inf
        hit, total = hit + len(set(ids[np.lexsort((ids, -s))[:20]]) & set(g.vec_id)), total + 20
    assert total and hit / total >= 0.9


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing", "byte-level BPE"]
    clean = p.drop_toxic(spark, docs, sf)
    assert clean.columns == docs.columns
    rows = sorted(clean.collect(), key=lambda r: r.doc_id)
    seen, kept = set(), []
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        if key not in seen:
            seen.add(key)
            kept.append(r)
    _, roots = brute_components([r.text for r in kept], 5, 80)
    kept = [r for i, r in enumerate(kept) if roots[i] == i]
    out = Counter(r.doc_id for r in p.run(spark, sf).collect())
    assert set(out) <= {r.doc_id for r in kept} and max(out.values()) <= 3
    want = {r.doc_id: r.copies for r in mixing.plan(spark.createDataFrame(kept, docs.schema)).collect() if r.copies}
    assert out == Counter(want)
