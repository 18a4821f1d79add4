"""Filter interaction audit: what each filter removes in each possible order, by higher-order SQL folds.

Five filters give every document a mask of the ones it fails. Documents with one mask in one part are a
mask cell, and a cell's fate under an order of the filters depends on its mask alone. So the corpus is
reduced to at most 32 cells a part; each cell folds across the constant array of all 120 orders
(``aggregate`` along an order, ``transform`` over the orders) into 600 structs weighted by its counts,
and a part's cells are merged by elementwise sums. Nothing of a document but 32 bytes of digest, its id,
part, mask and two labels ever moves.

The fifth filter asks for a smaller doc_id with the same text anywhere in the table. Texts are compared
by SHA-256. Rows are summed per text, part, mask and labels before their shuffle, keeping the smallest
doc_id and how many rows carry it, so that a text that a third of all rows share comes down to a few
rows per task; a window over what is left of a text gives its smallest doc_id.

Defined results: null text is empty (it fails A and, when another empty text has a smaller doc_id, E);
a null part is the part ''; null labels, and documents without labels, are neither good nor toxic, and
several label rows of one doc_id count as one that has all their marks; repeated rows are rows of their
own, rows of equal doc_id are not smaller than each other; a null doc_id is larger than any other and
has no labels; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import WORD, let, read_table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: A filter's bit in the mask.
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """Bits of the four filters that a text fails by itself."""
    words = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
                lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")

    def bits(w: Column) -> Column:
        fails = {"A": w["n"] < 50, "B": w["distinct"].cast("long") * 100 < w["n"].cast("long") * 65,
                 "C": capitals * 100 > F.length(text).cast("long") * 5, "D": text.rlike("[#$%&*|]")}
        return reduce(lambda a, b: a + b, [F.when(c, F.lit(BIT[f])).otherwise(F.lit(0)) for f, c in fails.items()])
    return let(words, bits)


def mask_cells(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): the documents of each part and mask, with those labelled good and toxic."""
    body = F.coalesce(F.col(text), F.lit(""))
    thin = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_mask(body).alias("mask"),
                       F.unhex(F.sha2(body, 256)).alias("digest"))
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # null ids have no labels: they stay out of the join, which would send them all to one task
    known = thin.filter("doc_id is not null").join(marks, "doc_id", "left").na.fill(False, ["good", "toxic"])
    nameless = thin.filter("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    key = ["digest", "part", "mask", "good", "toxic"]
    per_id = known.groupBy("doc_id", *key).agg(F.count(F.lit(1)).alias("n"))
    per_null = nameless.groupBy("doc_id", *key).agg(F.count(F.lit(1)).alias("n"))
    per_text = per_id.unionByName(per_null).groupBy(*key).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("first"))
    smallest = F.min("least").over(Window.partitionBy("digest"))
    # of a text's rows, those with its smallest doc_id are no copies (all, where every doc_id is null)
    own = per_text.withColumn("_least", smallest).withColumn(
        "originals", F.when(F.col("_least").isNull(), F.col("n")).when(F.col("least") == F.col("_least"), F.col("first")).otherwise(F.lit(0)))
    both = own.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("originals").alias("n")),
        F.struct((F.col("mask") + BIT["E"]).alias("mask"), (F.col("n") - F.col("originals")).alias("n")))).alias("c"))
    return (both.select("part", "c.mask", "c.n", "good", "toxic").filter("n > 0").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.expr("if(good, n, 0L)")).alias("good"), F.sum(F.expr("if(toxic, n, 0L)")).alias("toxic")))


def _counts(n: Column | int, alive: Column | None = None, fails: Column | None = None, only: Column | None = None,
            good: Column | None = None, toxic: Column | None = None) -> Column:
    """The measures of one cell at one step; of none without conditions."""
    zero = F.lit(0).cast("long")
    pick = lambda c, x: zero if c is None else F.when(c, x).otherwise(zero)
    gone = None if alive is None else alive & fails
    values = (pick(None if alive is None else alive & ~fails, n), pick(gone, n), pick(None if alive is None else ~alive & fails, n),
              pick(only, n), pick(gone, good), pick(gone, toxic))
    return F.struct(*[v.alias(m) for v, m in zip(values, MEASURES)])


def _fold(cell: Column, orders: Column) -> Column:
    """The cell's 600 structs: for each order, the filters one after the other."""
    def step(state: Column, bit: Column) -> Column:
        fails = cell["mask"].bitwiseAND(bit) > 0
        made = _counts(cell["n"], state["alive"], fails, cell["mask"] == bit, cell["good"], cell["toxic"])
        return F.struct((state["alive"] & ~fails).alias("alive"), F.concat(state["steps"], F.array(made)).alias("steps"))

    start = F.struct(F.lit(True).alias("alive"), F.array_repeat(_counts(0), 0).alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step)["steps"]))


def audit(cells: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: the measures and the filter's ``shapley`` sum over all orders."""
    # constants of the plan, so every executor has them
    orders = F.array(*[F.array(*[F.lit(BIT[f]) for f in order]) for order in ORDERS])
    names = F.array(*[F.lit(o) for o in ORDERS])
    filters = F.flatten(orders)
    none = F.array_repeat(_counts(0), len(ORDERS) * len(FILTERS))
    add = lambda x, y: F.struct(*[(x[m] + y[m]).alias(m) for m in MEASURES])
    merged = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")).select(
        "part", F.aggregate("cells", none, lambda sums, cell: F.zip_with(sums, _fold(cell, orders), add)).alias("sums"))

    def removed_by(bit: int) -> Column:
        own = F.zip_with("sums", filters, lambda s, f: F.when(f == bit, s["removed"]).otherwise(F.lit(0).cast("long")))
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x)

    worth = F.array(*[removed_by(bit) for bit in BIT.values()])
    rows = merged.withColumn("worth", worth).select("part", "worth", F.posexplode("sums").alias("place", "s"))
    steps = len(FILTERS)
    order, at = F.element_at(names, (F.floor(F.col("place") / steps) + 1).cast("int")), (F.col("place") % steps + 1).cast("int")
    placed = rows.select("part", order.alias("filter_order"), at.alias("step"), "s.*", "worth")
    letter = F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1)))
    return placed.withColumn("shapley", F.element_at("worth", letter)).drop("worth")


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(mask_cells(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fs
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
cells AS (SELECT part, fs, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, s AS step, substr(filter_order, s, 1) AS cur, substr(filter_order, 1, s - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
hit AS (
  SELECT part, filter_order, step, cur, n, good, toxic, contains(fs, cur) AS fails,
         translate(fs, before, '') = fs AS alive, fs = cur AS single
  FROM cells, steps),
sums AS (
  SELECT part, filter_order, step, cur,
         sum(CASE WHEN alive AND NOT fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN alive AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN NOT alive AND fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN single THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN alive AND fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN alive AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM hit GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, cur)::BIGINT AS shapley
FROM sums
"""
