"""Lexicon sentiment score and the per symbol-day sentiment aggregate.

The lexicon and the modifiers are tables of any size. Tokens with the token before them are exploded
and hash-joined with the lexicon, which drops nearly all of them, then with the modifiers; what is
left is summed per text. A lexicon too large to broadcast is not met by every token: texts are dealt into
chunks, a chunk's distinct words are looked up once, and their values go back to the chunk, which holds its
texts as numbers of words. Only keys, sums and counts are shuffled: a text is known by a 128-bit hash,
so its body stays where it is unless the caller selects it from the result. Equal texts have equal
scores; their sums combine in each task, so a text that a third of all rows share is one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions.sides import join_side, known_bytes, stored, threshold
from tickflow.functions.text import SENTIMENT_TOKEN, tokens

#: Tokens after which a chunk of texts is closed (a longer text is a chunk of its own).
CHUNK_TOKENS = 2_000_000

TERM_DECIMAL = "decimal(18,6)"
SUM_DECIMAL = "decimal(38,12)"

# Default modifiers applied to the next token - negators halve
# and flip the polarity, intensifiers scale it (in the style of public
# lexicon scorers).
DEFAULT_MODIFIERS = [
    ("not", -0.5), ("never", -0.5), ("no", -0.5), ("hardly", -0.5),
    ("very", 1.3), ("really", 1.3), ("extremely", 1.5), ("slightly", 0.5),
]


def _terms(table: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """A two-column table by lower-cased term (largest value per term), stored."""
    known = table.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    return stored(known.groupBy(F.lower(F.col(key)).alias(name)).agg(F.max(F.col(value).cast(TERM_DECIMAL)).alias(f"{name}_value")), name)


def text_scores(df: DataFrame, lexicon: DataFrame, modifiers: DataFrame, text: str = "content") -> DataFrame:
    """(k0, k1, total, hits) of every text with lexicon tokens: hash of the text, summed token scores, their number.

    A text that occurs on several rows has both multiplied alike, so the mean is that of one.
    """
    terms, factors = _terms(lexicon, "term", "polarity", "tok"), _terms(modifiers, "term", "factor", "prev")
    toks = df.filter(F.col(text).isNotNull()).select(
        F.xxhash64(F.lit(0), text).alias("k0"), F.xxhash64(F.lit(1), text).alias("k1"), tokens(F.col(text), SENTIMENT_TOKEN).alias("toks"))
    if known_bytes(terms) > threshold(df.sparkSession):
        found = _chunk_scores(toks, terms, factors)
        return found.groupBy("k0", "k1").agg(F.sum("total").cast(SUM_DECIMAL).alias("total"), F.sum("hits").alias("hits"))
    pairs = toks.select("k0", "k1", F.explode(F.transform("toks", lambda t, i: F.struct(
        t.alias("tok"), F.get(F.col("toks"), i - 1).alias("prev")))).alias("p")).select("k0", "k1", "p.tok", "p.prev")
    found = join_side(join_side(pairs, terms, ["tok"]), factors, ["prev"], "left")
    value = (F.col("tok_value") * F.coalesce(F.col("prev_value"), F.lit(1).cast(TERM_DECIMAL))).cast(SUM_DECIMAL)
    # sums are exact decimals, so a score that is truly 0 stays 0 (its sign decides
    # positive / negative / neutral downstream)
    return found.groupBy("k0", "k1").agg(F.sum(value).cast(SUM_DECIMAL).alias("total"), F.count(F.lit(1)).alias("hits"))


def _chunk_scores(toks: DataFrame, terms: DataFrame, factors: DataFrame) -> DataFrame:
    """(k0, k1, total, hits) of the texts of each chunk of ``toks`` (k0, k1, toks); equal texts of a chunk are one."""
    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))

        def close(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            keys = np.stack([table["k0"].to_numpy(), table["k1"].to_numpy()], axis=1)
            table = table.take(pa.array(np.sort(np.unique(keys, axis=0, return_index=True)[1]))).combine_chunks()
            lists = pa.concat_arrays(table["toks"].chunks)
            coded = lists.flatten().dictionary_encode()
            # bytes of equal weight together, compressed: most numbers are small
            codes = np.ascontiguousarray(coded.indices.to_numpy().astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), one(table["k0"].to_numpy(), pa.int64()), one(table["k1"].to_numpy(), pa.int64()),
                 one(lists.value_lengths().to_numpy(), pa.int32()), pa.array([pa.compress(codes, codec="zstd", asbytes=True)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)],
                names=["chunk", "k0", "k1", "lens", "codes", "words"])

        held, size = [], 0
        for batch in batches:
            start = 0
            for k, n in enumerate(batch.column("toks").value_lengths().to_pylist()):
                if size and size + n > CHUNK_TOKENS:
                    held.append(batch.slice(start, k - start))
                    yield close(held)
                    held, size, start, number = [], 0, k, number + 1
                size += n
            held.append(batch.slice(start))
        if size:
            yield close(held)

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        from decimal import Context, Decimal

        import numpy as np
        import pyarrow as pa
        row = {c: left[c][0] for c in left.column_names}
        k0, k1, lens = (row[c].values.to_numpy() for c in ("k0", "k1", "lens"))
        planes = pa.decompress(row["codes"].as_py(), decompressed_size=4 * int(lens.sum()), codec="zstd", asbytes=True)
        codes = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()
        place = right["place"].to_numpy()
        known, values, factor = np.zeros(row["n_words"].as_py(), bool), np.zeros(row["n_words"].as_py(), np.int64), np.full(row["n_words"].as_py(), 10 ** 6, np.int64)
        known[place] = right["value"].is_valid().to_numpy()
        values[place] = right["value"].fill_null(0).to_numpy()
        factor[place] = right["factor"].fill_null(10 ** 6).to_numpy()
        ends = np.cumsum(lens)
        starts = ends - lens
        before = np.concatenate(([10 ** 6], factor[codes[:-1]]))
        before[starts[lens > 0]] = 10 ** 6
        if int(abs(values).max()) * int(abs(factor).max()) * len(codes) >= 1 << 62:
            values, before = values.astype(object), before.astype(object)
        total = np.concatenate(([0], np.cumsum(values[codes] * before)))
        hits = np.concatenate(([0], np.cumsum(known[codes])))
        total, hits = total[ends] - total[starts], hits[ends] - hits[starts]
        some = np.flatnonzero(hits)
        digits = Context(prec=60)
        return pa.table({"k0": k0[some], "k1": k1[some], "total": pa.array([Decimal(x).scaleb(-12, digits) for x in total[some].tolist()], pa.decimal128(38, 12)),
                         "hits": pa.array(hits[some], pa.int64())})

    chunks = stored(toks.mapInArrow(chunked, "chunk bigint, k0 array<bigint>, k1 array<bigint>, lens array<int>, codes binary, words array<string>"), "chunks")
    millionths = lambda c: (F.col(c) * 1000000).cast("bigint")
    answers = (chunks.select("chunk", F.posexplode("words").alias("place", "tok"))
               .join(terms, "tok", "left").join(factors, F.col("tok") == F.col("prev"), "left")
               .select("chunk", "place", millionths("tok_value").alias("value"), millionths("prev_value").alias("factor"))
               .filter("value is not null or factor is not null"))
    own = chunks.select(F.col("chunk").alias("of"), "k0", "k1", "lens", "codes", F.size("words").alias("n_words"))
    return own.groupBy("of").cogroup(answers.groupBy("chunk")).applyInArrow(summed, f"k0 bigint, k1 bigint, total {SUM_DECIMAL}, hits bigint")


def score(df: DataFrame, lexicon: DataFrame, modifiers: DataFrame, text: str = "content",
          out: str = "sentiment_score") -> DataFrame:
    """Add ``sentiment_score`` FLOAT in [-1, 1] to every row (U1 with the J4 lexicon lookup).

    Tokens are ``[a-z']+`` of the lower-cased text. Each lexicon token scores
    ``polarity x factor`` where ``factor`` comes from the previous token's
    modifier (1 when none); polarities and factors count to 6 decimals.
    Score = mean of the token scores, clipped to [-1, 1]; no lexicon token ->
    0.0; null text -> null. Empty tables give 0.0.
    """
    scores = text_scores(df, lexicon, modifiers, text).select(
        F.struct("k0", "k1").alias("_text"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("total").cast("double") / F.col("hits"))).alias("_mean"))
    keyed = df.withColumns({"_text": F.struct(F.xxhash64(F.lit(0), text).alias("k0"), F.xxhash64(F.lit(1), text).alias("k1")),
                            "_some": F.col(text).isNotNull()})
    value = F.when(F.col("_some"), F.coalesce("_mean", F.lit(0.0))).cast("float")
    return keyed.join(scores, "_text", "left").withColumn(out, value).drop("_text", "_some", "_mean")


def aggregate(enriched: DataFrame, keys=("symbol", "day"), col: str = "sentiment_score") -> DataFrame:
    """Sentiment aggregate per key (A1).

    Counts of positive (> 0), negative (< 0) and neutral (= 0) scores, their
    share of *all* rows of the key (null scores included) in percent, and the
    mean positive and negative score. Plain aggregates, combined map-side.
    """
    s = F.col(col)
    pos, neg = s > 0, s < 0
    agg = enriched.groupBy(*keys).agg(
        F.count(F.when(pos, True)).alias("positive_count"),
        F.avg(F.when(pos, s)).alias("positive_avg_score"),
        F.count(F.when(neg, True)).alias("negative_count"),
        F.avg(F.when(neg, s)).alias("negative_avg_score"),
        F.count(F.when(s == 0, True)).alias("neutral_count"),
        F.count(F.lit(1)).alias("total_count"),
    )
    return agg.select(
        *keys,
        "positive_count",
        (F.col("positive_count") / F.col("total_count") * 100).alias("positive_percentage"),
        "positive_avg_score",
        "negative_count",
        (F.col("negative_count") / F.col("total_count") * 100).alias("negative_percentage"),
        "negative_avg_score",
        "neutral_count",
    )
