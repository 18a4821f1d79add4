"""Toxicity by a classifier chain.

The chain predicts categories one after another. Each link is a linear (logistic) model over the
document's words and word beginnings, plus the probabilities of all categories before it. A later model
must not learn from probabilities that its own labels leaked into: for training, earlier probabilities
are out-of-fold predictions, each row's by a model fitted on the other folds. For scoring, each link
uses the model fitted on all training rows.

Fitting takes a bounded sample of labelled rows (``SAMPLE`` rows, the smallest hashes of doc_id, so that
reruns fit the same); features and folds of it are made in Spark, the small linear models on the
driver. Scoring covers every document and every word of its text, in Arrow batches on the executors,
with models of fixed size (``DIM`` weights per category).

Defined results: null and empty texts have no features and get the probability of the intercepts;
labels that are null count as absent; repeated labels of one doc_id count as its largest; a category
without both classes in the sample gets its (smoothed) base rate; documents need no label; an empty
table gives an empty result; extra columns pass through, result columns replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.common import give_back, map_in_arrow, read_table

#: Labelled rows that models are fitted on, at most.
SAMPLE = 12_000
DIM = 1 << 17
FOLDS = 3
#: Features whose weight of evidence is not this many standard errors from none are left out.
EVIDENCE = 6.0
#: Features of fewer training rows are left out.
SEEN = 5
THRESHOLD = 0.6
WORDS_KEPT = 200_000
#: Documents whose features a task holds at once.
BATCH = 500
PREFIXES = (4, 5)


class _Features(dict):
    """Feature numbers of each lower-case word: the word itself and its beginnings."""

    def __missing__(self, word: str) -> list[int]:
        import xxhash
        core = word.strip(".,;:!?\"'()[]<>|*#-_")
        names = {core, *[f"{core[:k]}~" for k in PREFIXES if len(core) >= k]} if core else set()
        value = self[word] = [xxhash.xxh3_64_intdigest(n) % DIM for n in names]
        return value


def document_features(text: str | None, known: _Features) -> np.ndarray:
    """Sorted distinct feature numbers of the whole text."""
    if len(known) > WORDS_KEPT:
        known.clear()
    words = set((text or "").lower().split())
    return np.unique(np.fromiter((f for w in words for f in known[w]), np.int64))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, rows), np.int64, len(rows))
    return (np.concatenate(rows) if rows else np.empty(0, np.int32)), np.repeat(np.arange(len(rows), dtype=np.int32), lens)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Linear:
    """Logistic model over binary features and a few dense inputs; features without evidence have weight 0."""

    def __init__(self, rows: list[np.ndarray], dense: np.ndarray, y: np.ndarray, rounds: int = 150, penalty: float = 1e-2):
        flat, owner = _flat(rows)
        n, positive = len(y), y.sum()
        rate = (positive + 1) / (n + 2)
        self.bias, self.weights, self.dense = float(np.log(rate / (1 - rate))), np.zeros(DIM), np.zeros(dense.shape[1])
        if positive == 0 or positive == n:
            return
        seen, hit = np.bincount(flat, minlength=DIM), np.bincount(flat[(y > 0)[owner]], minlength=DIM)
        spread = np.sqrt(np.maximum(seen * rate * (1 - rate), 1e-12))
        keep = (np.abs(hit - seen * rate) > EVIDENCE * spread) & (seen >= SEEN)
        index = np.cumsum(keep) - 1
        mask = keep[flat]
        f, o = index[flat[mask]], owner[mask]
        size = int(keep.sum())
        w, v, b = np.zeros(size), np.zeros(dense.shape[1]), self.bias
        scale = 1 / np.sqrt(np.maximum(np.bincount(f, minlength=size) / n, 1e-4))  # rare features move as fast as common ones
        balance = np.where(y > 0, 0.5 / max(rate, 1e-6), 0.5 / max(1 - rate, 1e-6))
        gw, gv, gb = np.zeros(size), np.zeros(len(v)), 0.0
        for step in range(rounds):
            p = _sigmoid(np.bincount(o, weights=w[f], minlength=n) + dense @ v + b)
            err = (p - y) * balance / n
            dw = np.bincount(f, weights=err[o], minlength=size) * scale + penalty * w / scale
            dv, db = dense.T @ err + penalty * v, err.sum()
            gw, gv, gb = 0.9 * gw + dw, 0.9 * gv + dv, 0.9 * gb + db
            w, v, b = w - 0.3 * gw * scale, v - 0.3 * gv, b - 0.3 * gb
        self.weights[keep], self.dense, self.bias = w, v, float(b)

    def predict(self, rows: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        flat, owner = _flat(rows)
        return _sigmoid(np.bincount(owner, weights=self.weights[flat], minlength=len(rows)) + dense @ self.dense + self.bias)


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model per column of ``labels``; earlier columns enter the later ones as out-of-fold probabilities."""
    before, chain = np.zeros((len(rows), 0)), []
    for c in range(labels.shape[1]):
        y, out = labels[:, c].astype(float), np.zeros(len(rows))
        for fold in range(FOLDS):
            inside, outside = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            if len(outside):
                model = Linear([rows[i] for i in inside], before[inside], y[inside])
                out[outside] = model.predict([rows[i] for i in outside], before[outside])
        chain.append(Linear(rows, before, y))
        before = np.column_stack((before, out))
    return chain


def chain_predict(chain: list[Linear], rows: list[np.ndarray]) -> np.ndarray:
    before = np.zeros((len(rows), 0))
    for model in chain:
        before = np.column_stack((before, model.predict(rows, before)))
    return before


def training_rows(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE) -> DataFrame:
    """(doc_id, fold, features, one 0/1 column per category) of at most ``sample`` labelled documents, one row per doc_id."""
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(*[F.max(F.coalesce(F.col(c), F.lit(0))).cast("int").alias(f"_c{k}") for k, c in enumerate(categories)])
    order = F.xxhash64(F.lit(7), "doc_id")
    chosen = known.orderBy(order, "doc_id").limit(sample)
    names = [f"_c{k}" for k in range(len(categories))]
    # at most ``sample`` rows: a doc_id of many rows is one, that of the smallest text hash
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", *names).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
            .repartition(tasks, "doc_id")  # AQE would leave the few rows in one task
            .withColumn("fold", F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(FOLDS)).cast("int")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Features()
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                b = whole.slice(start, BATCH)
                found = [document_features(t, memory).astype(np.int32) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("fold"), *[b.column(n) for n in names], pa.array(found, pa.list_(pa.int32()))],
                                                 names=["doc_id", "fold", *names, "features"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("fold", T.IntegerType()), *[T.StructField(n, T.IntegerType()) for n in names],
                           T.StructField("features", T.ArrayType(T.IntegerType()))])
    return map_in_arrow(rows, run, schema)


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE) -> list[Linear]:
    chain = _fitted(docs, labels, categories, sample)
    give_back()  # the training rows: the driver goes on for long
    return chain


def _fitted(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int) -> list[Linear]:
    got = training_rows(docs, labels, categories, sample).toArrow().sort_by("doc_id").combine_chunks()
    features = got["features"].combine_chunks()
    flat, ends = np.asarray(features.values), np.asarray(features.offsets)
    seen = np.bincount(flat, minlength=DIM)  # a row's features are distinct
    rows = [f[seen[f] >= SEEN] for f in (flat[i:j] for i, j in zip(ends[:-1], ends[1:]))]
    given = np.column_stack([np.asarray(got[f"_c{k}"]) for k in range(len(categories))])
    return fit_chain(rows, given, np.asarray(got["fold"]))


def score(docs: DataFrame, chain: list[Linear], categories: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``p_<category>`` for every category and ``flagged``: the last category reaches the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    fields = [T.StructField(f"p_{c}", T.DoubleType()) for c in categories] + [T.StructField("flagged", T.BooleanType())]
    kept = [f for f in docs.schema.fields if f.name not in {x.name for x in fields}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Features()
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                b = whole.slice(start, BATCH)
                p = chain_predict(sent.value, [document_features(t, memory) for t in b.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(f.name) for f in kept] + [pa.array(p[:, k]) for k in range(p.shape[1])] + [pa.array(p[:, -1] >= threshold)],
                                                 names=[f.name for f in kept + fields])

    return map_in_arrow(docs, run, T.StructType(kept + fields))


CATEGORIES = ["low_quality", "toxic"]


def label_table(spark, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = fit(docs, label_table(spark, sf_dir), CATEGORIES)
    return score(docs, chain, CATEGORIES).select(
        "doc_id", F.round("p_low_quality", 6).alias("p_low_quality"), F.round("p_toxic", 6).alias("p_toxic"), F.col("flagged").alias("toxic"))
