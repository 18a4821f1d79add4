"""Byte-level BPE encoding and decoding with DuckDB inside each Spark task.

Texts never leave their task. Each batch is cut into units (a word with the space before it, or a
run of white space) and its distinct units into pre-tokens; DuckDB encodes the pre-tokens that this worker
has not seen lately:

* every pre-token starts as rows (word, position, next position, token), one row a byte;
* a recursive query joins neighbouring rows with the merge table, finds each word's leftmost pair of
  minimum rank and contracts it, until no pair joins;
* decoding joins the token rows with the vocabulary and aggregates the pieces in order of position.

Words of over ``LONG_WORD`` bytes go through a second recursive query that contracts, in each round,
all occurrences of the word's minimum rank from the left without overlap. That is what contracting
the leftmost one again and again comes to (a contraction never creates a pair of a lower rank than
its own), and takes about as many rounds as the word has different ranks.

Defined results: null text is encoded as empty (no ids); empty text gives 0 tokens and an empty list;
repeated rows give repeated results; extra columns are kept, a column called like a result column is
replaced by it; lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickflow.llm.common import keep, map_in_arrow

#: Pre-tokens of one run of the recursive query: bounds its memory, not what is encoded.
WORDS_A_RUN = 10_000
#: Pre-tokens of more bytes than this are encoded by the query for long words.
LONG_WORD = 64
#: Pre-tokens kept in each of the two generations of a worker's memory; older ones are encoded anew.
WORDS_KEPT = 150_000
#: Bytes of text handled at once; a longer text is handled alone.
BYTES_A_BATCH = 2_000_000
#: Bytes of rows that Spark sends to a worker at once (a row at least). Spark's own 64 MB are held by the JVM and by the worker.
BYTES_SENT = 4_000_000

#: Spark's setting of the bytes of an Arrow batch.
SENT = "spark.sql.execution.arrow.maxBytesPerBatch"

# fixed values: Unicode White_Space, on which the pre-token pattern splits
_WS = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_UNIT = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")

_ENCODE = """
WITH RECURSIVE state(step, w, i, j, tok) AS (
  SELECT 0, w, i, j, tok FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT a.w, a.j, b.j AS jj, m.rank::BIGINT * 4294967296 + a.i AS k
     FROM state a JOIN state b ON a.j = b.i JOIN merges m ON m.pair = a.tok::BIGINT * 4294967296 + b.tok),
   best AS (SELECT w, min(k) AS k, arg_min(j, k) AS gone, arg_min(jj, k) AS jj FROM pairs GROUP BY w)
   SELECT s.step + 1, s.w, s.i,
          CASE WHEN s.j = b.gone THEN b.jj ELSE s.j END,
          CASE WHEN s.j = b.gone THEN (b.k >> 32)::INT ELSE s.tok END
   FROM state s JOIN best b ON s.w = b.w WHERE s.i <> b.gone)
)
SELECT s.w, list(s.tok ORDER BY s.i) AS toks
FROM state s JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) last ON s.w = last.w AND s.step = last.step
GROUP BY s.w
"""

_ENCODE_LONG = """
WITH RECURSIVE state(step, w, i, tok) AS (
  SELECT 0, w, i, tok FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT step, w, i, tok, lead(tok) OVER (PARTITION BY w ORDER BY i) AS nxt FROM state),
   ranked AS (
     SELECT p.step, p.w, p.i, p.tok, m.rank, min(m.rank) OVER (PARTITION BY p.w) AS best
     FROM pairs p LEFT JOIN merges m ON m.pair = p.tok::BIGINT * 4294967296 + p.nxt),
   hits AS (
     SELECT step, w, i, tok, best, coalesce(rank = best, false) AS hit,
            i - row_number() OVER (PARTITION BY w, coalesce(rank = best, false) ORDER BY i) AS run
     FROM ranked WHERE best IS NOT NULL),
   taken AS (
     SELECT step, w, i, tok, best,
            hit AND row_number() OVER (PARTITION BY w, hit, run ORDER BY i) % 2 = 1 AS take FROM hits),
   left_over AS (
     SELECT step, w, i, CASE WHEN take THEN best ELSE tok END AS tok,
            coalesce(lag(take) OVER (PARTITION BY w ORDER BY i), false) AS gone FROM taken)
   SELECT step + 1, w, row_number() OVER (PARTITION BY w ORDER BY i), tok FROM left_over WHERE NOT gone)
)
SELECT w, list(tok ORDER BY i) AS toks
FROM (SELECT *, max(step) OVER (PARTITION BY w) AS last FROM state) WHERE step = last GROUP BY w
"""

# pieces travel as text, one character per byte (byte 0 as U+0100), which string_agg can join in order
_DECODE = """
SELECT s.u, string_agg(v.piece, '' ORDER BY s.i) AS body
FROM ids s JOIN vocab v ON s.tok = v.tok GROUP BY s.u
"""


@functools.lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as fh:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}


class _Codec:
    """One worker's DuckDB connection with the merge table, and the pre-tokens it has met lately."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        ranks = _ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.ranks = ranks
        pair, rank = [], []
        for piece, r in ranks.items():
            for k in range(1, len(piece)):
                a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
                if a is not None and b is not None:
                    pair.append(a << 32 | b)
                    rank.append(r)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self.con.execute("SET preserve_insertion_order=false")
        merges = pa.table({"pair": pa.array(pair, pa.int64()), "rank": pa.array(rank, pa.int32())})
        vocab = pa.table({"tok": pa.array(list(ranks.values()), pa.int32()), "piece": [_as_text(p) for p in ranks]})
        self.con.register("merges_in", merges)
        self.con.register("vocab_in", vocab)
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM vocab_in")
        # (ids, decoded bytes) of the pre-tokens met lately: a new and an old generation
        self.memory: list[dict[str, tuple[bytes, bytes]]] = [{}, {}]

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids (little-endian uint32) of pre-tokens, by the recursive queries."""
        out: dict[bytes, bytes] = {}
        rest: list[bytes] = []
        long: list[bytes] = []
        for w in words:
            whole = self.ranks.get(w)
            if whole is not None:
                out[w] = whole.to_bytes(4, "little")
            else:
                (long if len(w) > LONG_WORD else rest).append(w)
        for query, ws in ((_ENCODE, rest), (_ENCODE_LONG, long)):
            start = 0
            while start < len(ws):
                stop, size = start, 0
                while stop < len(ws) and stop - start < WORDS_A_RUN and (size < 16 * WORDS_A_RUN or stop == start):
                    size += len(ws[stop])
                    stop += 1
                self._encode_run(query, ws[start:stop], out)
                start = stop
        return out

    def _encode_run(self, query: str, run: list[bytes], out: dict[bytes, bytes]) -> None:
        lens = np.fromiter(map(len, run), np.int64, len(run))
        ends = np.cumsum(lens)
        nxt = np.arange(1, ends[-1] + 1)
        nxt[ends - 1] = -1
        start = pa.table({
            "w": np.repeat(np.arange(len(run), dtype=np.int32), lens),
            "i": np.arange(ends[-1]),
            "j": nxt,
            "tok": self.byte[np.frombuffer(b"".join(run), np.uint8)],
        })
        self.con.register("start", start)
        got = self.con.sql(query).to_arrow_table().combine_chunks()
        self.con.unregister("start")
        toks = got["toks"].combine_chunks()
        flat = np.asarray(toks.values, dtype="<u4").tobytes()
        offs = np.asarray(toks.offsets, dtype=np.int64) * 4
        for w, a, b in zip(got["w"].to_pylist(), offs[:-1].tolist(), offs[1:].tolist()):
            out[run[w]] = flat[a:b]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids (little-endian uint32), by ordered aggregation."""
        lens = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        ends = np.cumsum(lens)
        if not len(ids) or not ends[-1]:
            return [b""] * len(ids)
        rows = pa.table({
            "u": np.repeat(np.arange(len(ids), dtype=np.int32), lens),
            "i": np.arange(ends[-1], dtype=np.int64) - np.repeat(ends - lens, lens),
            "tok": np.frombuffer(b"".join(ids), "<u4").astype(np.int32),
        })
        self.con.register("ids", rows)
        got = self.con.sql(_DECODE).to_arrow_table()
        self.con.unregister("ids")
        out = [b""] * len(ids)
        for u, body in zip(got["u"].to_pylist(), got["body"].to_pylist()):
            out[u] = _as_bytes(body)
        return out

    def _words(self, wanted: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """(ids, decoded bytes) of each pre-token, from memory or by the queries."""
        if len(self.memory[0]) > WORDS_KEPT:
            self.memory = [{}, self.memory[0]]
        new, old = self.memory
        found, missing = {}, []
        for x in wanted:
            hit = new.get(x) or old.get(x)
            if hit is None:
                missing.append(x)
            else:
                found[x] = new[x] = hit
        raw = [w.encode() for w in missing]
        coded = self._encode_words(raw)
        ids = [coded[w] for w in raw]
        for x, value in zip(missing, zip(ids, self.decode(ids))):
            found[x] = value
            if len(x) <= LONG_WORD:
                new[x] = value
        return found

    def units(self, wanted: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """(ids, decoded bytes) of each unit."""
        single = {u for u in wanted if u.isalpha() or u[0] == " " and u[1:].isalpha()}
        cut = {u: self.pattern.findall(u) for u in wanted - single}
        found = self._words(single.union(*cut.values()))
        for u, ps in cut.items():
            if len(ps) > 1:
                pairs = [found[p] for p in ps]
                found[u] = b"".join([p[0] for p in pairs]), b"".join([p[1] for p in pairs])
        return found


def _as_text(piece: bytes) -> str:
    return piece.decode("latin-1").replace("\0", "Ā")


def _as_bytes(text: str) -> bytes:
    return text.replace("Ā", "\0").encode("latin-1")


@functools.lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> _Codec:
    keep("bpe", _codec.cache_clear)
    return _Codec(path, pattern)


def vocabulary_on_executors(spark, path: str) -> str:
    """Send the rank file (under 1 MB) to every executor; returns its name for ``SparkFiles``."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def _batches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BYTES_A_BATCH bytes."""
    start = size = 0
    for k, n in enumerate(sizes):
        size += n
        if size >= BYTES_A_BATCH:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _cut(texts: list[str]) -> tuple[list[list[str]], set[str]]:
    """The units of each text, equal ones held once, and the distinct units."""
    seen: dict[str, str] = {}
    cut = []
    for t in texts:
        us = _UNIT.findall(t)
        cut.append(list(map(seen.setdefault, us, us)))
    return cut, set(seen)


def _bytes(size: str) -> int:
    """Bytes of a setting such as 67108864b or 64m."""
    number, unit = re.fullmatch(r"(-?[0-9]+)\s*([a-z]*)", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit.rstrip("b") or " ")


def _send_less(spark) -> None:
    """Set the session's Arrow batches to BYTES_SENT at most: the plan that reads the setting runs after this module returned it."""
    if _bytes(spark.conf.get(SENT)) > BYTES_SENT or _bytes(spark.conf.get(SENT)) <= 0:
        spark.conf.set(SENT, str(BYTES_SENT))


def _map_texts(df: DataFrame, vocab: str, pattern: str, text: str, fields: list[T.StructField], make, keep_text: bool = True) -> DataFrame:
    """Append columns that ``make(ids, decoded)`` computes for each row from its text."""
    path = vocabulary_on_executors(df.sparkSession, vocab)
    _send_less(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in {x.name for x in fields} and (keep_text or f.name != text)]
    schema = T.StructType(kept + fields)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(SparkFiles.get(path), pattern)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
            for a, b in _batches(sizes):
                cut, wanted = _cut([t or "" for t in batch.column(text).slice(a, b - a).to_pylist()])
                known = codec.units(wanted)
                made = [[] for _ in fields]
                for us in cut:
                    pairs = [known[u] for u in us]
                    for out, v in zip(made, make(b"".join([p[0] for p in pairs]), b"".join([p[1] for p in pairs]))):
                        out.append(v)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(m, _ARROW[f.dataType.simpleString()]) for m, f in zip(made, fields)],
                    names=names + [f.name for f in fields])

    return map_in_arrow(df, run, schema, "bpe")


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "binary": pa.binary()}


def encode(docs: DataFrame, vocab: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of token ids) and ``n_tokens``."""
    return _map_texts(docs, vocab, pattern, text, [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))],
                      lambda ids, _: (len(ids) // 4, np.frombuffer(ids, "<u4").astype(np.int32)))


def decode(df: DataFrame, vocab: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes of each row's token ids (null ids: empty)."""
    path = vocabulary_on_executors(df.sparkSession, vocab)
    kept = [f for f in df.schema.fields if f.name != "decoded"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(SparkFiles.get(path), pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                coded = [np.asarray(x or [], dtype="<u4").tobytes() for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(codec.decode(coded), pa.binary())], names=[*names, "decoded"])

    return map_in_arrow(df, run, T.StructType([*kept, T.StructField("decoded", T.BinaryType())]), "bpe")


def digests(docs: DataFrame, vocab: str, pattern: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Row digests of encoding and decoding: n_tokens, ids_sha256, decoded_sha256.

    The ids of a row are decoded unit by unit; only digests leave the task, and the text itself unless ``keep_text`` is false.
    """
    def make(ids: bytes, body: bytes):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(body).hexdigest()
    return _map_texts(docs, vocab, pattern, text, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                                                   T.StructField("decoded_sha256", T.StringType())], make, keep_text)
