"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A normalised text is cut where its own characters say so, thus equal passages of different texts give
equal chunks. The chunk store holds every distinct chunk once under a 128-bit identifier, and is
verified: no identifier may stand for two different chunks, or all are drawn anew. A document then is
its recipe, the ordered list of its chunks' identifiers (16 bytes for about a thousand characters),
and equal texts are those with equal recipes. Only distinct chunks move once; no text does.

Hot groups: the distinct and the count of a group are pre-aggregated before their shuffles; the join
back has one row per recipe on one side, so that a hot recipe on the other can be split by AQE.

Defined results: null text counts as empty, and all empty texts are one group; repeated rows belong
to one group and ``kept`` holds for each row that carries the smallest doc_id (``deduplicate`` keeps
one of them); null doc_ids are never the smallest unless a group has no other; an empty table gives an
empty result; ``deduplicate`` returns the input's columns whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import SPACE_RUN, shared_table

MIN_CHARS, MAX_CHARS = 1024, 8192
#: A chunk ends after such a pair of characters, as soon as it has MIN_CHARS.
CUT = "[a-dk-mA-D0-4,;][ e-hn-q.E-H5-9]"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE_RUN, " ")


def chunks(norm: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """The text's chunks in order; their concatenation is the text."""
    pattern = f"(?s).{{{min_chars},{max_chars}}}?{CUT}|.{{1,{max_chars + 2}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def identifier(draw: int, chunk: Column) -> list[Column]:
    """Two independent 64-bit halves."""
    return [F.xxhash64(F.lit(2 * draw + k), chunk) for k in (0, 1)]


def chunk_store(docs: DataFrame, text: str = "text", draw: int = 0,
                identify: Callable[[int, Column], list[Column]] = identifier) -> DataFrame:
    """Distinct chunks with their identifiers (id_a, id_b, chunk)."""
    each = docs.select(F.explode(chunks(normalised(docs[text]))).alias("chunk"))
    a, b = identify(draw, F.col("chunk"))
    return each.select(a.alias("id_a"), b.alias("id_b"), "chunk").distinct()


def verified_draw(docs: DataFrame, text: str = "text", identify: Callable[[int, Column], list[Column]] = identifier) -> int:
    """The first draw under which no identifier stands for two chunks (checked on the chunks themselves)."""
    for draw in itertools.count():  # a second draw is needed once in 10^17 corpora of 10^10 chunks
        shared = chunk_store(docs, text, draw, identify).groupBy("id_a", "id_b").count().filter("count > 1")
        if shared.isEmpty():
            return draw


def recipes(docs: DataFrame, draw: int, text: str = "text", identify: Callable[[int, Column], list[Column]] = identifier) -> DataFrame:
    """(doc_id, recipe, text_sha256) for every row."""
    cut = docs.select(F.col("doc_id"), normalised(docs[text]).alias("norm"))
    ids = F.flatten(F.transform(chunks(F.col("norm")), lambda c: F.array(*identify(draw, c))))
    return cut.select("doc_id", ids.alias("recipe"), F.sha2("norm", 256).alias("text_sha256"))


def group_equal(docs: DataFrame, text: str = "text", identify: Callable[[int, Column], list[Column]] = identifier) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chunks."""
    draw = verified_draw(docs, text, identify)
    listed = shared_table(recipes(docs, draw, text, identify), "recipes")
    groups = listed.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        (F.size("recipe") / 2).cast("int").alias("n_chunks"))


def deduplicate(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group, all columns.

    Only ids of dropped rows meet the documents. Rows repeated under one doc_id are rare; they alone
    are told apart by content.
    """
    found = shared_table(group_equal(docs, text), "dedup")
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc"), F.sha2(normalised(docs[text]), 256).alias("_sha_of"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_sha_of") == F.col("_sha"))
    kept = marked.join(gone, same, "left_anti")
    repeated = found.filter("kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).count().filter("count > 1").select("_id", "_sha")
    if repeated.isEmpty():
        return kept.select("row.*")
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["_doc", "_sha_of"])
    return kept.join(repeated, same, "left_anti").unionByName(once).select("row.*")


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_equal(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP5_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""
