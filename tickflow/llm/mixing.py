"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Every source has a target share of all words, at most ``MAX_REPEAT`` times its own. A document of a
source with target / size = 2.3 is to be taken 2.3 times: twice for sure, and once more with
probability 0.3. Drawing those documents one by one would let the taken words drift by chance, so
fractional documents are paired: mass moves from one to the other, in a random direction whose odds
keep both expectations, until one of them is integral; the other goes on to the next pair. Mass is
weighted by size, so the words of a pair stay the same. A bucket of about ``BUCKET`` documents ends
with one residual document; residuals are paired in buckets again (a reduction tree), until one per
source is left, which is drawn alone. So the taken words of a source differ from its target by less
than that document's size, whatever the source's size. Buckets are folded from the largest document to
the smallest, so that the residual is a small one.

A hot source is spread over its buckets; a task holds one bucket. All draws are functions of the seed
and the documents, so reruns agree. Sources are ranked by a distributed sort, never in one task.

Defined results: null or wordless text has size 0 and takes 0 words; null is a source of its own, the
last in order; rows repeated under one doc_id are rounded each on their own; an empty table gives an
empty result; ``mix`` returns the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickflow.llm.common import WORD, let, read_table, shared_table, uniform

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3.0
BUCKET = 64
SEED = 41
#: Probabilities nearer than this to 0 or 1 count as integral.
NEAR = 1e-9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def units_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, source, size, mark): all that rounding needs of a document."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(docs[text]).alias("size"), F.xxhash64(docs[text]).alias("mark"))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place`` (0, 1, ... by code point, null last), without a single-task sort."""
    dealt = shared_table(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()), "sources")
    parts = dealt.groupBy(F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last()))
    return (dealt.withColumn("_within", within).join(parts, F.col("_part") == F.col("_p"))
            .withColumn("place", F.col("_before") + F.col("_within") - 1).drop("_part", "_p", "_n", "_before", "_within"))


def targets(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, n_docs, place, weight, target) for every source.

    Targets share all sizes by weight. Those above their bound stop there, and the rest is shared
    again by weight, until none is above; each round is one aggregation of the source table.
    """
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    cycle = F.array(*[F.lit(w) for w in weights])
    table = shared_table(ranked(sources).withColumn("weight", cycle[(F.col("place") % len(weights)).cast("int")]), "ranked")
    bound = F.col("source_size") * F.lit(max_repeat)
    level = 0.0
    while True:
        stopped = bound <= F.col("weight") * F.lit(level)
        r = table.agg(F.sum("source_size").alias("all"), F.sum(F.when(stopped, bound)).alias("used"),
                      F.sum(F.when(~stopped, F.col("weight"))).alias("free")).first()
        if not r["free"] or not r["all"]:
            break
        higher = (r["all"] - (r["used"] or 0.0)) / r["free"]
        if higher <= level * (1 + 1e-15):
            break
        level = higher
    return table.withColumn("target", F.least(bound, F.col("weight") * F.lit(level)))


_UNIT = "struct<size:bigint,doc_id:{id},mark:bigint,p:double>"


def _fold(items: Column, seed: int, id_type: str) -> Column:
    """Sequential pivotal rounding of one bucket: struct(open: the residual or null, done: the rounded ones)."""
    unit = _UNIT.format(id=id_type)

    def made(x: Column, p: Column) -> Column:
        p = F.when(p < NEAR, 0.0).when(p > 1 - NEAR, 1.0).otherwise(p)
        return F.struct(x["size"].alias("size"), x["doc_id"].alias("doc_id"), x["mark"].alias("mark"), p.alias("p"))

    def pair(i: Column, j: Column, done: Column) -> Column:
        ratio = i["size"] / j["size"]  # what j gives for one unit of i
        amounts = F.struct(
            F.least(1 - i["p"], j["p"] / ratio).alias("rise"), F.least(i["p"], (1 - j["p"]) / ratio).alias("fall"),
            ratio.alias("ratio"), uniform(F.lit(seed), i["doc_id"], i["mark"], j["doc_id"], j["mark"]).alias("u"))

        def moved(a: Column) -> Column:
            by = F.when(a["u"] * (a["rise"] + a["fall"]) < a["fall"], a["rise"]).otherwise(-a["fall"])
            return F.struct(made(i, i["p"] + by).alias("i"), made(j, j["p"] - by * a["ratio"]).alias("j"))

        def settle(m: Column) -> Column:
            i_open, j_open = (m["i"]["p"] > 0) & (m["i"]["p"] < 1), (m["j"]["p"] > 0) & (m["j"]["p"] < 1)
            return F.struct(
                F.when(i_open, m["i"]).when(j_open, m["j"]).alias("open"),
                F.concat(done, F.when(i_open, F.array(m["j"])).when(j_open, F.array(m["i"])).otherwise(F.array(m["i"], m["j"]))).alias("done"))

        return let(amounts, lambda a: let(moved(a), settle))

    start = F.struct(F.lit(None).cast(unit).alias("open"), F.array().cast(f"array<{unit}>").alias("done"))
    return F.aggregate(items, start, lambda acc, x: F.when(
        acc["open"].isNull(), F.struct(x.alias("open"), acc["done"].alias("done"))).otherwise(pair(acc["open"], x, acc["done"])))


def copies(units: DataFrame, shares: DataFrame, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """``units`` with source_size, target and ``copies``: how often each document is taken."""
    id_type = units.schema["doc_id"].dataType.simpleString()
    known = shares.select(F.col("source").alias("_source"), "source_size", "n_docs", "target")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.when(F.abs(ratio - F.round(ratio)) < NEAR, F.round(ratio)).otherwise(ratio)
    rows = (units.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("_whole", F.floor(near).cast("long")).withColumn("_p", near - F.floor(near)))
    rows = shared_table(rows, "units")
    open_ = (F.col("_p") > 0) & (F.col("size") > 0)
    keep = ["doc_id", "source", "size", "mark", "source_size", "target"]
    sure = rows.filter(~open_).select(*keep, F.col("_whole").alias("copies"))

    head = ["source", "source_size", "target", "_whole"]
    buckets = F.ceil(F.col("n_docs") / bucket).cast("long")
    level = (rows.filter(open_)
             .withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "mark", "size"), buckets).cast("long"))
             .groupBy(*head, "_bucket")
             .agg(F.sort_array(F.collect_list(F.struct("size", "doc_id", "mark", F.col("_p").alias("p"))), asc=False).alias("items")))
    left = rows.agg(F.max("n_docs")).first()[0] or 0
    rounded, depth = [], 0
    while True:
        folded = shared_table(level.withColumn("f", _fold(F.col("items"), seed + depth, id_type)).select(*head, "_bucket", "f.open", "f.done"), "level")
        rounded.append(folded.select(*head, F.explode("done").alias("u")))
        left = -(-left // bucket)
        if left <= 1:
            break
        depth += 1
        level = (folded.filter("open is not null").withColumn("_bucket", F.expr(f"_bucket div {bucket}"))
                 .groupBy(*head, "_bucket").agg(F.sort_array(F.collect_list("open"), asc=False).alias("items")))
    last = folded.filter("open is not null").select(*head, "open")
    drawn = F.when(uniform(F.lit(seed + 1000), "open.doc_id", "open.mark") < F.col("open.p"), 1.0).otherwise(0.0)
    rounded.append(last.select(*head, F.struct(*[F.col(f"open.{c}").alias(c) for c in ("size", "doc_id", "mark")], drawn.alias("p")).alias("u")))
    out = sure
    for part in rounded:
        out = out.unionByName(part.select(F.col("u.doc_id").alias("doc_id"), "source", F.col("u.size").alias("size"), F.col("u.mark").alias("mark"),
                                          "source_size", "target", (F.col("_whole") + F.round(F.col("u.p")).cast("long")).alias("copies")))
    return out


def plan(docs: DataFrame, text: str = "text", weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, mark, source_size, target, copies."""
    units = shared_table(units_of(docs, text), "sizes")
    return copies(units, targets(units, weights, max_repeat), seed)


def mix(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken.

    Rows that share doc_id, source, size and content are interchangeable; their copies are dealt out in order.
    """
    key = ["_id", "_source", "_size", "_mark"]
    twin = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    taken = (plan(docs, text, **options).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
                                                F.col("mark").alias("_mark"), "copies")
             .groupBy(*key).agg(F.sort_array(F.collect_list("copies"), asc=False).alias("_copies")))
    left = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), F.col("source").cast("string").alias("_source"),
                       n_words(docs[text]).alias("_size"), F.xxhash64(docs[text]).alias("_mark"))
    left = left.withColumn("_twin", twin)
    right = taken.select(*[F.col(k).alias(f"{k}2") for k in key], "_copies")
    same = [F.col(k).eqNullSafe(F.col(f"{k}2")) for k in key]
    times = F.element_at("_copies", F.col("_twin")).cast("int")
    return (left.join(right, same).withColumn("_times", times).filter("_times > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("row.*"))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return plan(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
