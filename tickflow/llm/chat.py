"""Chat formatting with collapse of cumulative snapshots (DataFrame functions only).

A chat log often holds the same conversation many times, once after each turn. Every turn gets the
rolling hash of all turns up to it; a conversation whose last hash is the hash of an inner turn of
another one is a prefix of that longer one, and an anti-join drops it. Of equal conversations the one
with the smallest conv_id stays. What stays is rendered with a chat template.

The rolling hash is SHA-256 over the hash before and the turn's role and text (both with their
lengths), so that equal hashes mean equal turns.

Hot groups: conversation ends are pre-aggregated by hash to one row before the anti-join, and inner
turns to distinct hashes, so a first turn that a third of all conversations share is one row a task.
A conversation itself is one value of the result and is built whole.

Defined results: turns are ordered by turn number, then role and text (nulls first), so ties and
repeated rows are kept in a fixed order; null role renders as "unknown" and null text as empty, and
they equal nothing but null; a null conv_id is a conversation of its own; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import read_table, shared_table

# fixed values: the turn template
TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"

#: Turns whose hashes are appended to one list.
BLOCK = 128


def _step(before: Column, turn: Column) -> Column:
    def told(x: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
    return F.sha2(F.concat(before, F.lit("|"), told(turn["role"]), F.lit("|"), told(turn["text"])), 256)


def _rolling(turns: Column) -> Column:
    """The rolling hash after each turn.

    A fold that appends copies its list with every step, so turns go in blocks of ``BLOCK``: the hashes of a
    block form one list, lists are appended to a list of lists, and the last hash of a list starts the next.
    """
    none = F.array().cast("array<string>")

    def last(hashes: Column, other: Column) -> Column:
        return F.coalesce(F.try_element_at(hashes, F.lit(-1)), other)

    def block(start: Column, at: Column) -> Column:
        return F.aggregate(F.slice(turns, at, BLOCK), none, lambda acc, t: F.concat(acc, F.array(_step(last(acc, start), t))))

    starts = F.sequence(F.lit(1), F.greatest(F.size(turns), F.lit(1)), F.lit(BLOCK))
    whole = F.aggregate(starts, F.array().cast("array<array<string>>"),
                        lambda acc, at: F.concat(acc, F.array(block(F.coalesce(F.try_element_at(F.try_element_at(acc, F.lit(-1)), F.lit(-1)), F.lit("")), at))))
    return F.flatten(whole)


def snapshots(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, turns (ordered), prefix_hashes (one per turn)."""
    row = F.struct("turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    convs = turns.select("conv_id", row.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return convs.withColumn("prefix_hashes", _rolling(F.col("turns")))


def collapse(turns: DataFrame) -> DataFrame:
    """The maximal conversations: conv_id, turns, prefix_hashes, n_equal (conversations with the same turns)."""
    convs = shared_table(snapshots(turns), "snapshots")
    last = F.element_at("prefix_hashes", -1)
    ends = convs.groupBy(last.alias("_end")).agg(F.min("conv_id").alias("_keep"), F.count(F.lit(1)).alias("n_equal"))
    inner = convs.select(F.explode(F.slice("prefix_hashes", 1, F.size("prefix_hashes") - 1)).alias("_end")).distinct()
    maximal = ends.join(inner, "_end", "left_anti")
    kept = convs.withColumn("_last", last).join(maximal, (F.col("_last") == F.col("_end")) & F.col("conv_id").eqNullSafe(F.col("_keep")))
    return kept.select("conv_id", "turns", "prefix_hashes", "n_equal")


def render(turns: Column) -> Column:
    head, rest = TURN.split("{role}")
    middle, tail = rest.split("{text}")
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(head), F.coalesce(t["role"], F.lit("unknown")), F.lit(middle), F.coalesce(t["text"], F.lit("")), F.lit(tail))), "")


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal, rendered: one row per maximal conversation."""
    return collapse(turns).select("conv_id", F.size("turns").cast("long").alias("n_turns"), "n_equal", render(F.col("turns")).alias("rendered"))


def op10_chat_formatting(spark, sf_dir: str) -> DataFrame:
    return format_chats(read_table(spark, sf_dir, "conversations"))


# the same by comparing the turns themselves: every proper prefix of every conversation, as a list
OP10_SQL = r"""
WITH convs AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations GROUP BY conv_id),
said AS (
  SELECT conv_id, turns, list_transform(turns, lambda t: {'role': t.role, 'text': t.text}) AS body FROM convs),
inner_prefixes AS (
  SELECT DISTINCT list_slice(body, 1, k) AS body FROM said, unnest(range(1, len(body))) AS r(k)),
ends AS (
  SELECT body, min(conv_id) AS conv_id, count(*) AS n_equal FROM said GROUP BY body),
maximal AS (SELECT e.* FROM ends e WHERE NOT EXISTS (SELECT 1 FROM inner_prefixes p WHERE p.body = e.body))
SELECT conv_id, len(body)::BIGINT AS n_turns, n_equal,
       array_to_string(list_transform(body, lambda t: '<|im_start|>' || coalesce(t.role, 'unknown') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10)), '') AS rendered
FROM maximal
"""
