"""Uniform shuffle into shards of exact size by a communication matrix (DataFrame functions only).

1. Rows fall into blocks by a hash; each block's rows are counted.
2. The matrix says how many rows each block sends to each shard. It has the law that a uniform
   permutation of all rows would give it (multivariate hypergeometric with the shard sizes as
   margins), drawn without looking at a row: a tree over the blocks splits the shards' capacities
   among ``FAN_OUT`` children a level, one exact hypergeometric draw per child and shard.
3. Each block permutes its rows and deals them out by its line of the matrix.
4. Each shard permutes again: rows fall into the shard's sub-blocks by a second hash, are ordered by it
   there, and take slots from the sub-block's offset on.

So shard sizes are exact (equal, or one apart), every row is equally likely anywhere, and the largest
group that a task holds is a block of about ``ROWS_A_BLOCK`` rows, never a shard. Every draw is a
function of the seed and the row's key, so a recomputed task decides the same.

Defined results: null text has size 1 and checksum 0; null doc_ids are hashed like a value; rows that
are repeated with all key columns equal may share a block and take different slots; an empty table
gives an empty result; other columns pass through, whatever their names (result columns replace
columns of the same name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickflow.llm.common import let, read_table, shared_table, uniform

FAN_OUT = 32
ROWS_A_BLOCK = 100_000


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Number of good ones among ``draws`` from ``total`` of which ``good`` are good; ``u`` in [0, 1).

    Exact inversion: weights relative to the mode's, added up from the mode to the upper end and then
    from the mode to the lower end, over all values that a double of 53 bits can reach (16 standard
    deviations; the whole support where that is smaller).
    """
    def drawn(x: Column) -> Column:
        n, k, m = x["total"], x["good"], x["draws"]
        low, high = F.greatest(F.lit(0).cast("long"), m - (n - k)), F.least(m, k)
        mode = F.least(high, F.greatest(low, F.floor((m + 1.0) * (k + 1.0) / (n + 2.0)).cast("long")))
        sd = F.sqrt(m * (k / n) * ((n - k) / n) * ((n - m) / F.greatest(n - 1, F.lit(1))))
        reach = F.ceil(16 * sd).cast("long") + 16
        return F.struct(n.alias("n"), k.alias("k"), m.alias("m"), mode.alias("mode"), x["u"].alias("u"),
                        F.greatest(low, mode - reach).alias("first"), F.least(high, mode + reach).alias("last"))

    def up(x: Column, v: Column) -> Column:  # weight(v + 1) / weight(v)
        return (x["k"] - v) * (x["m"] - v).cast("double") / ((v + 1.0) * (x["n"] - x["k"] - x["m"] + v + 1))

    def down(x: Column, v: Column) -> Column:  # weight(v - 1) / weight(v)
        return v * (x["n"] - x["k"] - x["m"] + v).cast("double") / ((x["k"] - v + 1.0) * (x["m"] - v + 1))

    none = F.lit(None).cast("long")

    def search(x: Column, ratio, to: str, step: int, target: Column) -> Column:
        """Weights summed from the mode on, and the first value at which they pass the target."""
        return F.aggregate(
            F.sequence(x["mode"], x[to], F.lit(step).cast("long")), F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), none.alias("v")),
            lambda a, v: F.struct((a["w"] * ratio(x, v)).alias("w"), (a["s"] + a["w"]).alias("s"),
                                  F.when(a["v"].isNull() & (a["s"] + a["w"] > target), v).otherwise(a["v"]).alias("v")))

    def picked(x: Column) -> Column:
        never = F.lit(float("inf"))

        def by_sums(t: Column) -> Column:  # the mode is in both sums
            target = x["u"] * (t["up"] + t["down"] - 1.0)
            above = search(x, up, "last", 1, target)["v"]
            below = search(x, down, "first", -1, target - t["up"] + 1.0)["v"]
            return F.when(target < t["up"], F.coalesce(above, x["last"])).otherwise(F.coalesce(below, x["first"]))

        return let(F.struct(search(x, up, "last", 1, never)["s"].alias("up"), search(x, down, "first", -1, never)["s"].alias("down")), by_sums)

    given = F.struct(total.alias("total"), good.alias("good"), draws.alias("draws"), u.alias("u"))
    sure = F.when((draws == 0) | (good == 0), F.lit(0).cast("long")).when(good == total, draws).when(draws == total, good)
    return F.coalesce(sure, let(given, lambda x: let(drawn(x), picked)))


def split_capacities(capacities: Column, children: Column, seed: int) -> Column:
    """Deal the shards' capacities out to the children (array of struct(child, n)) of one node.

    Returns array<struct(child, capacities)>; the children's sizes add up to the capacities.
    """
    empty = F.array().cast("array<struct<child:bigint,capacities:array<bigint>>>")

    def one_child(acc: Column, kid: Column) -> Column:
        rest = acc["rest"]
        line = F.aggregate(
            F.sequence(F.lit(0), F.size(rest) - 1),
            F.struct(kid["n"].alias("left"), F.aggregate(rest, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
                     F.array().cast("array<bigint>").alias("sent")),
            lambda a, j: let(
                F.struct(hypergeometric(a["total"], rest[j], a["left"], uniform(F.lit(seed), kid["child"], j)).alias("v")),
                lambda d: F.struct((a["left"] - d["v"]).alias("left"), (a["total"] - rest[j]).alias("total"),
                                   F.concat(a["sent"], F.array(d["v"])).alias("sent"))))["sent"]
        return let(F.struct(line.alias("line")), lambda s: F.struct(
            F.zip_with(rest, s["line"], lambda r, v: r - v).alias("rest"),
            F.concat(acc["out"], F.array(F.struct(kid["child"].alias("child"), s["line"].alias("capacities")))).alias("out")))

    return F.aggregate(children, F.struct(capacities.alias("rest"), empty.alias("out")), one_child)["out"]


def communication_matrix(counts: DataFrame, n_rows: int, n_shards: int, levels: int, seed: int, fan_out: int = FAN_OUT) -> DataFrame:
    """(block, capacities): rows that each block sends to each shard; ``counts`` has (block, n)."""
    sizes = [n_rows // n_shards + (1 if j < n_rows % n_shards else 0) for j in range(n_shards)]
    whole = F.array(*[F.lit(s).cast("long") for s in sizes])
    nodes = None
    for level in range(1, levels + 1):
        width = fan_out ** (levels - level)
        kids = (counts.groupBy(F.expr(f"block div {width}").alias("child")).agg(F.sum("n").alias("n"))
                .groupBy(F.expr(f"child div {fan_out}").alias("node")).agg(F.array_sort(F.collect_list(F.struct("child", "n"))).alias("children")))
        nodes = kids.withColumn("capacities", whole) if nodes is None else nodes.join(kids, "node")
        nodes = (nodes.select(F.explode(split_capacities(F.col("capacities"), F.col("children"), seed * 64 + level)).alias("c"))
                 .select(F.col("c.child").alias("node"), "c.capacities"))
    return nodes.withColumnRenamed("node", "block")


def shuffle_to_shards(rows: DataFrame, key: list[str], n_shards: int = 8, seed: int = 20_240_125, fan_out: int = FAN_OUT,
                      rows_a_block: int = ROWS_A_BLOCK) -> DataFrame:
    """``rows`` with ``shard`` (0 to n_shards - 1) and ``slot`` (0, 1, ... within the shard).

    ``key``: columns that tell rows apart; together with the seed they decide everything.
    """
    rows = rows.drop("shard", "slot")
    rows = rows.select(F.struct("*").alias("row"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)])
    key, columns = [f"_key{i}" for i in range(len(key))], rows.columns
    n_rows = rows.count()
    levels = 1
    while fan_out ** levels * rows_a_block < n_rows:
        levels += 1
    blocks = fan_out ** levels
    keys = [F.col(k) for k in key]
    dealt = rows.withColumns({
        "_block": F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(blocks)).cast("long"),
        "_first": F.xxhash64(F.lit(seed + 1), *keys),
    })
    counts = shared_table(dealt.groupBy(F.col("_block").alias("block")).agg(F.count(F.lit(1)).alias("n")), "blocks")
    matrix = shared_table(communication_matrix(counts, n_rows, n_shards, levels, seed, fan_out), "matrix")

    place = F.row_number().over(Window.partitionBy("_block").orderBy("_first", *key))
    ends = F.transform(F.sequence(F.lit(1), F.lit(n_shards)),
                       lambda j: F.aggregate(F.slice("capacities", 1, j), F.lit(0).cast("long"), lambda a, x: a + x))
    sent = (dealt.withColumn("_place", place).join(matrix, F.col("_block") == F.col("block"))
            .withColumn("shard", F.size(F.filter(ends, lambda e: e < F.col("_place"))))
            .select(*columns, "shard"))

    subs = max(1, blocks // n_shards)
    arrived = shared_table(sent.withColumn("_second", F.xxhash64(F.lit(seed + 2), *keys))
                           .withColumn("_sub", F.pmod("_second", F.lit(subs)).cast("long")), "exchange")
    offsets = arrived.groupBy(F.col("shard").alias("_s"), F.col("_sub").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_s", "_b", (F.sum("_n").over(Window.partitionBy("_s").orderBy("_b")) - F.col("_n")).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("shard", "_sub").orderBy(F.shiftright("_second", 7), "_second", *key))
    return (arrived.withColumn("_within", within).join(offsets, (F.col("shard") == F.col("_s")) & (F.col("_sub") == F.col("_b")))
            .select("row.*", "shard", (F.col("_offset") + F.col("_within") - 1).alias("slot")))


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 8 shards; law ``rows``: counts at most one apart."""
    docs = read_table(spark, sf_dir, "documents")
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    return shuffle_to_shards(rows, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
