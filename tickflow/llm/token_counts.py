"""Edit-aware token counts on pre-token segment trees.

The leaves of a document's tree are runs of pre-tokens, every node holds the sums of characters and
tokens below it. An edit (replace the characters from start to stop) finds its leaves on the way down
the tree, cuts anew only the text that it touches with the context that pre-tokens can look at, stops
where the new cut meets an old boundary, and adds the differences along the paths to the root. The rest
of the document is never encoded again.

Why the context suffices: whether a pre-token ends at e depends on the text from its start to at most
the two characters after e; so pre-tokens that end two characters before an edit stay, and from the
first common boundary after an edit on, the cut is the old one.

Defined results: null text counts as empty; null edits are no edits; edits are applied in order, each
to the text as the edits before it left it; positions are clipped to the text, a stop before its start
counts as the start, a null insert is empty; repeated rows give repeated results; an empty table gives
an empty result; extra columns pass through, result columns replace those of the same name.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.bpe import _ranks, vocabulary_on_executors
from tickflow.llm.common import map_in_arrow, read_table

#: Pre-tokens in a leaf when a tree is built.
LEAF = 32
#: Characters after a pre-token's end that its cut can depend on.
CONTEXT = 2
WORDS_KEPT = 500_000


class Counter(dict):
    """Token count of each pre-token, by the tiktoken library."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken
        super().__init__()
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})
        self.pattern = regex.compile(pattern)

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        value = self[word] = len(self.encoding.encode_ordinary(word))
        return value


@functools.lru_cache(maxsize=2)
def _counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


class Tree:
    """Segment tree over a text's pre-tokens: sums of characters and of tokens."""

    def __init__(self, text: str, counter: Counter):
        self.counter, self.encoded = counter, 0
        words = counter.pattern.findall(text)
        self.leaves = [words[i:i + LEAF] for i in range(0, len(words), LEAF)] or [[]]
        width = 1
        while width < len(self.leaves):
            width *= 2
        self.width = width
        self.chars, self.tokens = [0] * (2 * width), [0] * (2 * width)
        for i, leaf in enumerate(self.leaves):
            self.chars[width + i], self.tokens[width + i] = sum(map(len, leaf)), sum(map(counter.__getitem__, leaf))
        for i in range(width - 1, 0, -1):
            self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]

    def text(self) -> str:
        return "".join("".join(leaf) for leaf in self.leaves)

    def find(self, position: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds the character at ``position``, else the last leaf."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if position >= before + self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        leaf = node - self.width
        return (leaf, before) if leaf < len(self.leaves) else (len(self.leaves) - 1, before - self.chars[self.width + len(self.leaves) - 1])

    def put(self, leaf: int, words: list[str], encoded: list[str]) -> None:
        """Replace a leaf and add the differences on the way to the root."""
        self.encoded += len(encoded)
        old_chars, old_tokens = self.chars[self.width + leaf], self.tokens[self.width + leaf]
        chars, tokens = sum(map(len, words)) - old_chars, sum(map(self.counter.__getitem__, words)) - old_tokens
        self.leaves[leaf] = words
        node = self.width + leaf
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def edit(self, start: int, stop: int, insert: str) -> None:
        size = self.chars[1]
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        if start == stop and not insert:
            return
        # pre-tokens before the first one that ends later than CONTEXT characters before the edit
        first, at = self.find(max(0, start - CONTEXT - 1))
        while first and at > max(0, start - CONTEXT):
            first -= 1
            at -= self.chars[self.width + first]
        keep = []
        for w in self.leaves[first]:
            if at + len(w) > start - CONTEXT:
                break
            keep.append(w)
            at += len(w)
        # old text and boundaries from there on, a leaf more at a time, until the cuts meet
        old = self.leaves[first][len(keep):]
        last, begin = first, at
        while True:
            end = begin + sum(map(len, old))
            complete = last == len(self.leaves) - 1
            if end >= stop or complete:
                window = "".join(old)
                new = self.counter.pattern.findall(window[:start - begin] + insert + window[stop - begin:])
                meeting = self._meeting(old, new, begin, stop, start + len(insert) - stop, end, complete)
                if meeting:
                    break
            last += 1
            old = old + self.leaves[last]
        n_old, n_new = meeting
        fresh = new[:n_new]
        tail = old[n_old:]
        for leaf in range(first + 1, last + 1):
            self.put(leaf, [], [])
        self.put(first, keep + fresh + tail, fresh)

    def _meeting(self, old, new, begin, stop, shift, end, complete) -> tuple[int, int] | None:
        """(old, new) pre-tokens before the first boundary at or after the edit that both cuts have."""
        ends, at = {}, begin
        if at >= stop:
            ends[at] = 0
        for i, w in enumerate(old):
            at += len(w)
            if at >= stop:
                ends[at] = i + 1
        at = begin
        if at - shift in ends and shift >= 0 and not stop > begin and not shift:
            return ends[at], 0
        for i, w in enumerate(new):
            at += len(w)
            # the last cuts of a window that goes on may look at text beyond it
            if at - shift in ends and at - shift >= stop and (complete or at - shift + CONTEXT < end):
                return ends[at - shift], i + 1
        return (len(old), len(new)) if complete else None


def count_edits(docs: DataFrame, vocab: str, pattern: str, edits: str = "edits", text: str = "text") -> DataFrame:
    """``docs`` with n_tokens (before), n_tokens_after, n_pretokens, n_reencoded (pre-tokens encoded for the edits) and n_edits.

    ``edits``: a column array<struct<start, stop, insert>>.
    """
    name = vocabulary_on_executors(docs.sparkSession, vocab)
    fields = [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_tokens_after", "n_pretokens", "n_reencoded", "n_edits")]
    kept = [f for f in docs.schema.fields if f.name not in {x.name for x in fields}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(SparkFiles.get(name), pattern)
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch, out = whole.slice(a, 256), []
                for t, es in zip(batch.column(text).to_pylist(), batch.column(edits).to_pylist()):
                    tree = Tree(t or "", counter)
                    before, words = tree.tokens[1], sum(map(len, tree.leaves))
                    for e in es or []:
                        if e is not None:
                            tree.edit(e["start"] or 0, e["stop"] or 0, e["insert"] or "")
                    out.append((before, tree.tokens[1], words, tree.encoded, len(es or [])))
                cols = list(zip(*out)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(c, pa.int64()) for c in cols], names=[f.name for f in kept + fields])

    return map_in_arrow(docs, run, T.StructType(kept + fields))


def attach_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with the column edits, from rows (doc_id, seq, start, stop, insert); a null start or stop counts as 0."""
    listed = (edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "insert"))).alias("_e"))
              .select(F.col("doc_id").alias("_id"), F.transform("_e", lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"), e["insert"].alias("insert"))).alias("edits")))
    rows = docs.drop("edits").select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc"))
    return rows.join(listed, F.col("_doc").eqNullSafe(F.col("_id")), "left").select("row.*", "edits")


# fixed values: personal data that redaction replaces, and what it puts there
PERSONAL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+|\+?\d[\d ()-]{7,}\d|\b(?:\d{1,3}\.){3}\d{1,3}\b")
REDACTED = "<redacted>"


def redaction_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column edits: every piece of personal data replaced, from the end of the text to its start."""
    kept = [f for f in docs.schema.fields if f.name != "edits"]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("insert", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"start": m.start(), "stop": m.end(), "insert": REDACTED} for m in PERSONAL.finditer(t or "")][::-1] for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(found, kind)], names=[f.name for f in kept] + ["edits"])

    edits = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("insert", T.StringType())]))
    return map_in_arrow(docs, run, T.StructType([*kept, T.StructField("edits", edits)]))


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after personal data is redacted."""
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_edits(redaction_edits(docs), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).drop("text", "edits")
