"""Columns of any name come through unchanged."""

import glob
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickflow.llm import exact_dedup, jaccard_join, mixing, sharding, token_counts

# every quoted name in the operators' sources that could be a column
NAMES = sorted({n for f in glob.glob(str(Path(__file__).parents[2] / "tickflow" / "llm" / "*.py"))
                for n in re.findall(r'"(_?[a-z][a-z0-9_]{0,14})"', Path(f).read_text())} - {"doc_id", "text", "source", "shard", "slot", "edits"})


def apply(name, docs):
    if name == "shards":
        return sharding.shuffle_to_shards(docs, ["doc_id", "text"], 2)
    if name == "edits":
        edits = docs.sparkSession.createDataFrame([(1, 0, 0, 1, "x"), (2, 0, None, None, "y")], "doc_id bigint, seq int, start int, stop int, insert string")
        return token_counts.attach_edits(docs, edits)
    return {"dedup": exact_dedup.deduplicate, "mix": mixing.mix, "near": lambda d: jaccard_join.drop_near_duplicates(d, 3, 90)}[name](docs)


@pytest.mark.parametrize("name", ["shards", "dedup", "mix", "edits", "near"])
def test_columns_by_any_name(spark, name):
    rows = [(1, "a b c d e", "s"), (2, "a b c d e", "t"), (2, "a b c d e", "t"), (3, None, None), (None, "x y " * 300, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert len(NAMES) > 100
    docs = docs.select("*", *[F.lit(7).alias(n) for n in NAMES])
    got = apply(name, docs)
    assert [c for c in got.columns if c in docs.columns] == docs.columns
    found = got.select(F.array_distinct(F.array(*NAMES)).alias("v")).collect()
    assert found and all(r.v == [7] for r in found)
