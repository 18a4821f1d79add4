"""Alignment of two tokenizers' tokens over the same bytes, by divide and conquer at shared cuts.

A encodes space + text by a byte-level BPE, B the text by a sentence-piece model (which adds the
space itself), so both cover the same bytes. A byte offset where tokens of both end is a cut; the
tokens between two cuts are a group. Cuts are found by dividing: each interval looks for a shared end
near its middle, bisecting B's ends for the A ends around the middle from the inside out, and both
halves go on with what is left to look at; an interval without a cut is a leaf group. Intervals of a
few ends bisect all of them at once. All intervals of many documents take each step together in numpy,
and no A end is looked up twice.

The first division needs no search: a blank between two characters that are no white space starts a
token of A (no pre-token crosses it) and one of B (unless some piece holds a blank after another
character, or B rewrites characters: then a text stays whole). So a text is cut into units there, and
of a chunk each distinct unit is encoded, divided on and written out once; documents are put together
from their units' groups and links.

Linked tokens (an A and a B token whose byte ranges overlap) are counted over the corpus as id pairs,
by the documents that hold them. Documents are taken in chunks of about ``CHUNK_BYTES`` of text: a
chunk holds each of its pairs once with the number of its documents, and only these dictionaries are
exploded, summed per pair, joined with the sums and sent back to their chunk; the documents' own pairs
are numbers into the dictionary, a little over a byte each. So no task holds more than a chunk or one
document, and a pair that every document holds costs one row a chunk. The highest count of each A id
is one row per vocabulary entry at most, which bounds the only broadcast.

Defined results: texts that are null or empty, or whose tokens of A or B do not spell space + text
(where B's model rewrites characters), have no tokens: all counts 0, no groups, the digest an empty
string; they hold no pair. Repeated rows count as documents of their own, null or repeated doc_ids
too. Special tokens' strings inside texts are plain text. An empty table gives an empty result. Other
columns are kept whatever their names, except the text itself and columns called like a result
column, which these replace.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.common import _shipped, keep, map_in_arrow, read_table, shared_table

#: Bytes of text after which a chunk is closed (a longer document is a chunk of its own).
CHUNK_BYTES = 4_000_000
#: Entries in each of the two generations of a worker's memory of encoded units.
WORDS_KEPT = 150_000
#: Units encoded in one call of a tokenizer.
RUN = 100
#: An interval with at most so many A ends left bisects them all at once instead of dividing further.
SHORT = 16
#: B ids fit into this many bits (the model's size is checked); a pair is A id << B_BITS | B id.
B_BITS = 15

# fixed values: Unicode White_Space, on which A's pre-token pattern splits
_WS = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_BORDER = re.compile(f" (?<=[^{_WS}] )(?=[^{_WS}])")
_WHITE = {c for c in map(chr, range(0x3001)) if re.match(f"[{_WS}]", c)}
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")

_COUNTS = [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
_DIGEST = T.StructField("groups_sha256", T.StringType())
_SCORES = [T.StructField(n, T.LongType()) for n in ("n_best", "count_sum")]
_ARROW = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 stands
    for itself, the other bytes follow from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers in one Python worker."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        if self.b.get_piece_size() > 1 << B_BITS:
            raise ValueError(f"model B has more than {1 << B_BITS} pieces")
        byte = _byte_level()
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            one = _BYTE_PIECE.fullmatch(piece)
            self.b_bytes.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        model = sentencepiece_model_pb2.ModelProto.FromString(self.b.serialized_model_proto())
        spec = model.normalizer_spec
        self.cuts_at_blanks = (spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
                               and not model.trainer_spec.treat_whitespace_as_suffix
                               and not any(re.search("[^▁ ][▁ ]", p.piece) for p in model.pieces))
        # units met lately, each with its numbers (little-endian int32: how many ids of A, these, ids of B): a new and an old generation
        self.words: list[dict[str, bytes]] = [{}, {}]
        # decimal ids with the sign that follows: next token, end of A's side, end of the group
        self.signs = [f"{i}{s}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for s in ",|;"]

    def units(self, text: str | None) -> list[str]:
        """The text cut at the blanks that start a token of A and of B, without these; none of an empty text."""
        if not text:
            return []
        return _BORDER.split(text) if self.cuts_at_blanks else [text]

    def _one_by_one(self, units: list[str]) -> dict[str, bytes]:
        """As ``_fresh``, where some units are not spelled by their tokens: these have none."""
        out = {}
        for u, e, b in zip(units, self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False), self.b.encode(units, num_threads=1)):
            whole, a = b" " + u.encode(), e.ids
            if b"".join(map(self.b_bytes.__getitem__, b)) != whole or b"".join(map(self.a_bytes.__getitem__, a)) != whole:
                a = b = []
            out[u] = np.array([len(a), *a, *b], "<i4").tobytes()
        return out

    def _fresh(self, units: list[str]) -> dict[str, bytes]:
        """Numbers of some units: how many ids of A, these, ids of B. Units are encoded in runs, joined by the blanks
        that would divide them in a text; if tokens do not spell the units, each is encoded alone."""
        apart = [u for u in units if u[0] in _WHITE or u[-1] in _WHITE or "▁" in u or not self.cuts_at_blanks]
        runs = list(units)
        if len(apart) < len(units):
            odd = set(apart)
            plain = [u for u in units if u not in odd]
            units = plain + apart
            runs = [" ".join(plain[k:k + RUN]) for k in range(0, len(plain), RUN)] + apart
        whole = [(" " + u).encode() for u in units]
        ends = np.cumsum(np.fromiter(map(len, whole), np.int64, len(whole)))
        coded = ([e.ids for e in self.a.encode_batch_fast([" " + r for r in runs], add_special_tokens=False)], self.b.encode(runs, num_threads=1))
        ids, counts = [], []
        for lists, pieces, size in zip(coded, (self.a_bytes, self.b_bytes), (self.a_len, self.b_len)):
            flat = list(itertools.chain.from_iterable(lists))
            at = np.cumsum(size[flat]) if flat else np.zeros(1, np.int64)
            place = np.minimum(np.searchsorted(at, ends), len(at) - 1)
            if (at[place] != ends).any() or b"".join(map(pieces.__getitem__, flat)) != b"".join(whole):
                return self._one_by_one(units)
            ids.append(np.array(flat, "<i4"))
            counts.append(np.diff(place, prepend=-1))
        n_a, n_b = counts
        stop = np.cumsum(1 + n_a + n_b)
        first = stop - (1 + n_a + n_b)
        mixed = np.empty(stop[-1], "<i4")
        mixed[first] = n_a
        for own, n, before in ((ids[0], n_a, first + 1), (ids[1], n_b, first + 1 + n_a)):
            mixed[np.arange(len(own)) + np.repeat(before - (np.cumsum(n) - n), n)] = own
        raw = mixed.tobytes()
        return {u: raw[i:j] for u, i, j in zip(units, (first * 4).tolist(), (stop * 4).tolist())}

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of space + unit for all (distinct) units one after the other and, per unit, where they start:
        (a, a_starts, b, b_starts). A unit that its tokens do not spell has none."""
        if len(self.words[0]) > WORDS_KEPT:
            self.words = [{}, self.words[0]]
        new, old = self.words
        known, missing = {}, []
        for u in units:
            numbers = new.get(u) or old.get(u)
            if numbers is None:
                missing.append(u)
            else:
                known[u] = new[u] = numbers
        for k in range(0, len(missing), 16 * RUN):
            fresh = self._fresh(missing[k:k + 16 * RUN])
            known.update(fresh)
            new.update(fresh if max(map(len, fresh)) <= 64 else {u: x for u, x in fresh.items() if len(u) <= 64})
        found = [known[u] for u in units]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        mixed = np.frombuffer(b"".join(found), "<i4")
        n_a = mixed[first].astype(np.int64)
        side = np.zeros(len(mixed), np.int8)
        side[first] = 2
        a_starts, b_starts = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, size - 1 - n_a))
        side[np.arange(a_starts[-1]) + np.repeat(first + 1 - a_starts[:-1], n_a)] = 1
        return mixed[side == 1], a_starts, mixed[side == 0], b_starts


@functools.lru_cache(maxsize=2)
def _pair(a_path: str, b_path: str) -> Pair:
    keep("token_align", _pair.cache_clear)
    return Pair(a_path, b_path)


def shared_cuts(a_ends: np.ndarray, a_starts: np.ndarray, b_ends: np.ndarray, b_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which A ends and which B ends are cuts. Ends rise through all texts; a text's last ends agree."""
    cut_a, cut_b = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    some = a_starts[1:] > a_starts[:-1]
    cut_a[a_starts[1:][some] - 1] = True
    cut_b[b_starts[1:][some] - 1] = True
    # an interval: the A ends lo..hi that are not looked up yet, the B ends b_lo..b_hi inside it
    todo = np.stack([a_starts[:-1][some], a_starts[1:][some] - 2, b_starts[:-1][some], b_starts[1:][some] - 2])
    fresh, old = todo, np.empty((6, 0), np.int64)
    while True:
        fresh = fresh[:, (fresh[0] <= fresh[1]) & (fresh[2] <= fresh[3])]
        small = fresh[1] - fresh[0] < SHORT
        if small.any():
            lo, hi = fresh[0, small], fresh[1, small]
            size = hi - lo + 1
            k = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
            p = np.searchsorted(b_ends, a_ends[k])
            same = b_ends[p] == a_ends[k]
            cut_a[k[same]], cut_b[p[same]] = True, True
            fresh = fresh[:, ~small]
        now = np.concatenate([old, np.concatenate([fresh, [(fresh[0] + fresh[1]) // 2, np.zeros(fresh.shape[1], np.int64)]])], axis=1)
        if not now.shape[1]:
            return cut_a, cut_b
        lo, hi, b_lo, b_hi, mid, off = now

        def find(k: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            end = a_ends[np.clip(k, lo, hi)]
            p = np.clip(np.searchsorted(b_ends, end), b_lo, b_hi)
            return there & (b_ends[p] == end), p

        left, right = mid - off, mid + off
        hit_l, p_l = find(left, left >= lo)
        hit_r, p_r = find(right, (right <= hi) & (off > 0))
        hit = hit_l | hit_r
        at, p = np.where(hit_l, left, right)[hit], np.where(hit_l, p_l, p_r)[hit]
        cut_a[at], cut_b[p] = True, True
        halves = [np.stack([lo[hit], left[hit] - 1, b_lo[hit], p - 1]),
                  np.stack([np.where(hit_l & (off > 0), right, right + 1)[hit], hi[hit], p + 1, b_hi[hit]])]
        fresh = np.concatenate(halves, axis=1)
        old = now[:, ~hit]
        old[5] += 1
        old = old[:, (old[4] - old[5] >= old[0]) | (old[4] + old[5] <= old[1])]


class Aligned:
    """The groups and links of a list of texts: those of their distinct units, put together."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        self.pair = pair
        number = defaultdict(itertools.count().__next__)
        of = [list(map(number.__getitem__, pair.units(t))) for t in texts]
        # of the distinct units
        self.a, self.a_starts, self.b, self.b_starts = pair.encode(list(number))
        self.a_ends, self.b_ends = np.cumsum(pair.a_len[self.a]), np.cumsum(pair.b_len[self.b])
        self.cut_a, self.cut_b = shared_cuts(self.a_ends, self.a_starts, self.b_ends, self.b_starts)
        self.a_last, self.b_last = np.flatnonzero(self.cut_a), np.flatnonzero(self.cut_b)
        self.g_starts = np.concatenate(([0], np.cumsum(self.cut_a)))[self.a_starts]
        # inside a group only its last ends agree
        self.l_starts = self.a_starts + self.b_starts - self.g_starts
        # the units of each text, one text after the other; none if one of them has no tokens
        wrong = set(np.flatnonzero(np.diff(self.a_starts) == 0).tolist())
        self.of = [us if wrong.isdisjoint(us) else [] for us in of] if wrong else of
        sizes = np.fromiter(map(len, self.of), np.int64, len(of))
        self.flat = np.fromiter(itertools.chain.from_iterable(self.of), np.int64, sizes.sum())
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.n_a, self.n_b, self.n_groups, self.n_links = (self.total(np.diff(x)) for x in (self.a_starts, self.b_starts, self.g_starts, self.l_starts))

    def total(self, values: np.ndarray) -> np.ndarray:
        """Per text, the sum of its units' values."""
        done = np.concatenate(([0], np.cumsum(values[self.flat])))
        return np.diff(done[self.starts])

    def spread(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each unit of each text in turn, its values (``starts``: where those of the distinct units start)."""
        first, size = starts[self.flat], np.diff(starts)[self.flat]
        return values[np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)]

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, n_a, n_b) of every group, ``end`` in bytes of space + text."""
        before = np.concatenate(([0], self.a_ends))
        ends = before[self.a_last + 1] - np.repeat(before[self.a_starts[:-1]], np.diff(self.g_starts))
        size = np.diff(before[self.a_starts])[self.flat]
        done = np.concatenate(([0], np.cumsum(size)))
        base = done[:-1] - np.repeat(done[self.starts[:-1]], np.diff(self.starts))
        return (self.spread(ends, self.g_starts) + np.repeat(base, np.diff(self.g_starts)[self.flat]),
                self.spread(np.diff(self.a_last, prepend=-1), self.g_starts), self.spread(np.diff(self.b_last, prepend=-1), self.g_starts))

    def digests(self) -> list[str]:
        """SHA-256 of `a1,a2|b1;a3|b2,b3` per text; empty without tokens."""
        group_a, group_b = np.cumsum(self.cut_a) - self.cut_a, np.cumsum(self.cut_b) - self.cut_b
        b_before = np.concatenate(([0], self.b_last + 1))
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + b_before[group_a]] = self.a.astype(np.int64) * 3 + self.cut_a
        order[np.arange(len(self.b)) + (self.a_last + 1)[group_b]] = self.b.astype(np.int64) * 3 + 2 * self.cut_b
        # a unit's end ends a group, so its line ends with ;
        signs, at = list(map(self.pair.signs.__getitem__, order.tolist())), (self.a_starts + self.b_starts).tolist()
        lines = ["".join(signs[i:j]) for i, j in zip(at[:-1], at[1:])]
        out = []
        for us in self.of:
            line = "".join(map(lines.__getitem__, us))[:-1]
            out.append(hashlib.sha256(line.encode()).hexdigest() if line else "")
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, id pair) of every link: one for each stretch of bytes between neighbouring ends."""
        ends = np.concatenate((self.a_ends, self.b_ends[~self.cut_b]))
        ends.sort(kind="stable")
        i, j = np.searchsorted(self.a_ends, ends), np.searchsorted(self.b_ends, ends)
        code = (self.a[i].astype(np.int64) << B_BITS) | self.b[j]
        return np.repeat(np.arange(len(self.n_links)), self.n_links), self.spread(code, self.l_starts)


def _sent(spark, a_path: str, b_path: str) -> tuple[str, str]:
    """Both vocabulary files (a few MB) go to every executor."""
    for p in (a_path, b_path):
        spark.sparkContext.addFile(p)
    return os.path.basename(a_path), os.path.basename(b_path)


def token_groups(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``a_ids``, ``b_ids`` and ``groups``: (end, n_a, n_b) of each group in order, ``end`` in bytes of space + text."""
    a_file, b_file = _sent(docs.sparkSession, a_path, b_path)
    ints = T.ArrayType(T.IntegerType())
    made = [T.StructField("a_ids", ints), T.StructField("b_ids", ints),
            T.StructField("groups", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("end", "n_a", "n_b")])))]
    kept = [f for f in docs.schema.fields if f.name not in {m.name for m in made}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(SparkFiles.get(a_file), SparkFiles.get(b_file))
        for whole in batches:
            for start, stop in _runs(whole.column(text)):
                batch = whole.slice(start, stop - start)
                got = Aligned(pair, batch.column(text).to_pylist())
                starts = [pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()) for n in (got.n_a, got.n_b, got.n_groups)]
                a_lists = pa.ListArray.from_arrays(starts[0], pa.array(got.spread(got.a, got.a_starts), pa.int32()))
                b_lists = pa.ListArray.from_arrays(starts[1], pa.array(got.spread(got.b, got.b_starts), pa.int32()))
                groups = pa.ListArray.from_arrays(starts[2], pa.StructArray.from_arrays(list(map(pa.array, got.groups())), ["end", "n_a", "n_b"]))
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [a_lists, b_lists, groups], names=[f.name for f in kept + made])

    return map_in_arrow(docs, run, T.StructType(kept + made), "token_align")


def _runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most CHUNK_BYTES of text (one row at least)."""
    start = size = 0
    for k, n in enumerate(np.asarray(pa.compute.binary_length(column).fill_null(0))):
        if size + n > CHUNK_BYTES and k > start:
            yield start, k
            start, size = k, 0
        size += int(n)
    if len(column) > start:
        yield start, len(column)


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, bytes of equal weight together, compressed: small numbers take about a byte."""
    return pa.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=4 * count, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _chunks(docs: DataFrame, a_path: str, b_path: str, text: str) -> DataFrame:
    """One row per chunk: its documents, its dictionary of pairs, its documents' pairs as numbers into that."""
    a_file, b_file = _sent(docs.sparkSession, a_path, b_path)
    made = [*_COUNTS, _DIGEST]
    kept = [f for f in docs.schema.fields if f.name not in {text, *(m.name for m in made + _SCORES)}]
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("rows", T.ArrayType(T.StructType(kept + made))),
        T.StructField("lens", ints), T.StructField("steps", T.BinaryType()), T.StructField("times", T.BinaryType()),
        T.StructField("pairs", ints), T.StructField("n_docs", ints)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(SparkFiles.get(a_file), SparkFiles.get(b_file))
        number = TaskContext.get().partitionId() << 32

        def close(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            got = Aligned(pair, table.column(text).to_pylist())
            doc, code = got.links()
            key, times = np.unique((doc << 31) | code, return_counts=True)
            pairs, place, n_docs = np.unique(key & ((1 << 31) - 1), return_inverse=True, return_counts=True)
            lens = np.bincount(key >> 31, minlength=table.num_rows)
            first = np.cumsum(lens) - lens
            steps = np.diff(place, prepend=0)
            steps[first[lens > 0]] = place[first[lens > 0]]
            values = [got.n_a, got.n_b, got.n_groups, got.n_links, got.digests()]
            columns = [table.column(f.name).combine_chunks() for f in kept] + [pa.array(v, _ARROW[f.name]) for v, f in zip(values, made)]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            rows = pa.StructArray.from_arrays(columns, [f.name for f in kept + made])
            one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t) if t else x)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), one(rows, None), one(lens, pa.int32()), pa.array([_packed(steps)], pa.binary()),
                 pa.array([_packed(times)], pa.binary()), one(pairs, pa.int32()), one(n_docs, pa.int32())], names=schema.names)

        held, size = [], 0
        for whole in batches:
            for start, stop in _runs(whole.column(text)):
                part = whole.slice(start, stop - start)
                n = pa.compute.sum(pa.compute.binary_length(part.column(text))).as_py() or 0
                if held and size + n > CHUNK_BYTES:
                    yield close(held)
                    held, size, number = [], 0, number + 1
                held.append(part)
                size += n
        if held:
            yield close(held)

    return map_in_arrow(docs, run, schema, "token_align")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Per document: its other columns, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum.

    A pair's count is the number of documents that hold it linked; ``n_best`` is how many of a
    document's links have the highest count of their A id, ``count_sum`` the sum of its links' counts.
    """
    chunks = shared_table(_chunks(docs, a_path, b_path, text), "aligned")
    entries = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("place", "e")).select(
        "chunk", "place", F.col("e.pairs").alias("pair"), F.col("e.n_docs").alias("n"))
    totals = shared_table(entries.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    # one row per A id at most
    best = totals.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("total").alias("most"))
    valued = totals.join(F.broadcast(best), F.shiftright("pair", B_BITS) == F.col("a")).select(
        "pair", (F.col("total") * 2 + (F.col("total") == F.col("most")).cast("int")).alias("value"))
    answers = entries.select("chunk", "place", "pair").join(valued, "pair").select("chunk", "place", "value")

    row = chunks.schema["rows"].dataType.elementType
    result = T.StructType([*row.fields, *_SCORES])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        value = np.zeros(right.num_rows, np.int64)
        value[right["place"].to_numpy()] = right["value"].to_numpy()
        for c in left.combine_chunks().to_batches(max_chunksize=1):
            lens = c["lens"].values.slice(c["lens"].offsets[0].as_py(), c["lens"].value_lengths()[0].as_py()).to_numpy()
            n, ends = int(lens.sum()), np.cumsum(lens)
            steps, times = _unpacked(c["steps"][0].as_py(), n), _unpacked(c["times"][0].as_py(), n)
            # numbers rise within a document: sums of its steps
            run = np.cumsum(steps)
            place = run - np.repeat(np.concatenate(([0], run))[ends - lens], lens)
            of = value[place]
            sums = [np.concatenate(([0], np.cumsum(x))) for x in ((of & 1) * times, (of >> 1) * times)]
            rows = c["rows"].flatten()
            parts.append(pa.table([*rows.flatten(), *[pa.array(s[ends] - s[ends - lens]) for s in sums]], names=[f.name for f in result.fields]))
        return pa.concat_tables(parts)

    _shipped(docs.sparkSession.sparkContext.applicationId)
    own = chunks.select(F.col("chunk").alias("of"), "rows", "lens", "steps", "times")
    return own.groupBy("of").cogroup(answers.groupBy("chunk")).applyInArrow(finish, result)


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
