"""News articles: flattening, cleaning, de-duplication, symbol matching and language
(P7 P8 F4 F6 J3 W4 T5 U2; S6 lives in ``tickflow.streaming``)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.sides import join_side, stored
from tickflow.functions.text import WORD_TOKEN, clean_text, tokens
from tickflow.session import work_path

MESSAGE_COLUMNS = ["symbol", "title", "publishedAt", "description", "url", "source_name", "content"]


def normalize(df: DataFrame, keep=()) -> DataFrame:
    """Raw article (+ ``symbol``) -> news message columns (P8 + P7).

    Missing fields become ''; ``source.name`` becomes ``source_name``;
    description and content are cleaned, the title is kept as it is.
    ``keep`` names extra columns (ids) passed through unchanged.
    """
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    if "source_name" in df.columns:
        source = text("source_name")
    elif "source" in df.columns:
        source = F.coalesce(F.col("source").getField("name"), F.lit(""))
    else:
        source = F.lit("")
    return df.select(
        *keep,
        "symbol",
        text("title").alias("title"),
        (F.col("publishedAt") if "publishedAt" in df.columns else F.lit("")).alias("publishedAt"),
        clean_text("description").alias("description"),
        text("url").alias("url"),
        source.alias("source_name"),
        clean_text("content").alias("content"),
    )


def _row_key(cols) -> list:
    """128-bit identity of a row's values."""
    return [F.xxhash64(F.lit(k), *cols).alias(f"_r{k}") for k in (0, 1)]


def first_titles(df: DataFrame, keys=("symbol",), title: str = "title", order=("publishedAt", "url")) -> DataFrame:
    """Thin half of the title de-duplication: (_r0, _r1, title) of the earliest article per ``keys`` and lower-case title.

    An aggregate of keys, title and order columns only, combined in each task before the
    shuffle, so a title copied a million times costs one row per task.
    """
    thin = df.select(*keys, F.coalesce(F.col(title), F.lit("")).alias("_title"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *_row_key(df.columns))
    first = F.min(F.struct(*[f"_o{i}" for i in range(len(order))], "_r0", "_r1", "_title"))
    best = thin.groupBy(*keys, F.lower("_title").alias("_title_key")).agg(first.alias("_b"))
    return best.select("_b._r0", "_b._r1", F.col("_b._title").alias(title))


def fetch_rows(df: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``df`` named by ``found`` (_r0, _r1), each once: bodies move in this join only."""
    named = df.withColumns({"_r0": _row_key(df.columns)[0], "_r1": _row_key(df.columns)[1]})
    kept = named.join(found.select("_r0", "_r1"), ["_r0", "_r1"], "left_semi")
    # rows equal in all columns share a name; the join has them side by side already
    w = Window.partitionBy("_r0", "_r1").orderBy("_r0")
    return kept.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(*df.columns)


def dedupe(df: DataFrame, keys=("symbol",), title: str = "title",
           order=("publishedAt", "url")) -> DataFrame:
    """Keep the earliest article per ``keys`` and lower-case title.

    Ties on ``publishedAt`` go to the smaller ``url``, then to the smaller row hash; of rows
    equal in all columns one stays. The survivors are chosen on thin rows, then fetched.
    """
    return fetch_rows(df, first_titles(df, keys, title, order))


def match_symbols(df: DataFrame, companies: DataFrame, id_cols=("url",), suffix: str = "inc",
                  text_cols=("title", "description")) -> DataFrame:
    """Articles that mention a symbol (F6 with the J3 company lookup).

    An article matches a symbol when its ticker occurs as a whole token, or
    when every token of the company name and the ``suffix`` token occur, in
    title and description (case-insensitive). One output row per
    (article, symbol); a company missing from ``companies`` matches by ticker only.

    An article is its ``id_cols`` and its text, so articles that share an id, or have none, are
    not taken for one. The terms are a stored side; counts per article and symbol are one
    aggregate with map-side combine.
    """
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    art = df.select(*id_cols, *_row_key([*id_cols, *text_cols]), F.array_distinct(tokens(text, WORD_TOKEN)).alias("_toks"))
    art = art.withColumn("_has_suffix", F.array_contains("_toks", suffix.lower()))
    comp = companies.groupBy("symbol").agg(F.max("company").alias("company")).select(
        "symbol", F.array_distinct(tokens(F.coalesce(F.col("company"), F.lit("")), WORD_TOKEN)).alias("_ct"))
    terms = (comp.select("symbol", F.lower("symbol").alias("term"), F.lit(True).alias("is_ticker"),
                         F.size("_ct").alias("n_company"))
             .unionByName(comp.select("symbol", F.explode("_ct").alias("term"),
                                      F.lit(False).alias("is_ticker"), F.size("_ct").alias("n_company"))))
    hits = join_side(art.select(*id_cols, "_r0", "_r1", "_has_suffix", F.explode(F.array_distinct("_toks")).alias("term")), stored(terms, "terms"), ["term"])
    # equal rows are one article: distinct terms are counted
    per = hits.groupBy(*id_cols, "_r0", "_r1", "symbol", "term", "is_ticker", "n_company", "_has_suffix").agg(F.lit(1).alias("_one")).groupBy(
        *id_cols, "_r0", "_r1", "symbol").agg(
        F.max(F.col("is_ticker").cast("int")).alias("_ticker"),
        F.sum((~F.col("is_ticker")).cast("int")).alias("_company_tokens"),
        F.max("n_company").alias("_n_company"),
        F.max(F.col("_has_suffix").cast("int")).alias("_suffix"),
    )
    ok = (F.col("_ticker") == 1) | ((F.col("_n_company") > 0)
                                    & (F.col("_company_tokens") == F.col("_n_company"))
                                    & (F.col("_suffix") == 1))
    return per.filter(ok).select(*id_cols, "symbol")


# --------------------------------------------------------------------------- language

def _trigrams(text_col) -> "F.Column":
    """All overlapping character trigrams of the lower-cased text, in one regex pass.

    A zero-width lookahead captures the three characters at every position,
    so the cost is linear in the text (indexing a UTF-8 string by character
    position would make it quadratic).
    """
    t = F.lower(F.coalesce(text_col, F.lit("")))
    return F.regexp_extract_all(t, F.lit("(?s)(?=(.{3}))"), 1)


def train_language_profiles(docs: DataFrame, text: str = "text", lang: str = "lang",
                            path: str | None = None):
    """Multinomial naive Bayes on character trigrams, add-one smoothing (U2 training).

    Returns ``(weights, languages)``: ``weights(gram, v)``, one row per trigram with an array
    that holds ``ln(count + 1)`` for each language (0 where it was not seen), and
    ``languages(lang, prior, log_denom)`` with the log prior and
    ``ln(total grams of lang + vocabulary size)``; array slots follow the languages in order.
    Whole texts are used. Counting is a plain ``groupBy(lang, gram)`` with map-side combine;
    counts and tables are stored (under ``path`` when given - the trained model).
    """
    labelled = docs.filter(F.col(lang).isNotNull())
    path = path or work_path(docs.sparkSession, "language-profiles")
    grams = labelled.select(F.col(lang).alias("lang"), F.explode(_trigrams(F.col(text))).alias("gram"))
    counts = stored(grams.groupBy("gram", "lang").agg(F.count(F.lit(1)).alias("n")), path=f"{path}/counts")
    # vocabulary size and document total are single values: scalar subqueries
    vocab = counts.select("gram").distinct().agg(F.count(F.lit(1))).scalar()
    all_docs = labelled.agg(F.count(F.lit(1))).scalar()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    n_docs = labelled.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("docs"))
    languages = stored(n_docs.join(totals, "lang", "left").select(
        "lang", F.log(F.col("docs") / all_docs).alias("prior"),
        F.log(F.coalesce(F.col("total"), F.lit(0)) + vocab).alias("log_denom")), path=f"{path}/languages")
    slots = languages.agg(F.sort_array(F.collect_list("lang"))).scalar()
    per_gram = counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("m"))
    weights = stored(per_gram.withColumn("_slots", slots).select("gram", F.transform("_slots", lambda l: F.log(
        F.coalesce(F.try_element_at("m", l), F.lit(0)) + 1.0)).alias("v")), path=f"{path}/weights")
    return weights, languages


def detect_language(df: DataFrame, weights: DataFrame, languages: DataFrame,
                    text: str = "title", out: str = "language") -> DataFrame:
    """Most likely language of ``text`` (U2); empty text -> null; ties -> smallest code.

    score(text, lang) = prior + sum over its trigrams of ``ln((count + 1) / (total + V))``. The
    trigrams of each distinct text (known by a 128-bit hash of its lower-case form, so rows need no id)
    are joined once with the stored ``weights`` and their vectors summed slot by slot; unseen
    trigrams only contribute the denominator.
    """
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    key = F.struct(F.xxhash64(F.lit(0), low).alias("k0"), F.xxhash64(F.lit(1), low).alias("k1"))
    ordered = languages.agg(F.sort_array(F.collect_list(F.struct("lang", "prior", "log_denom")))).scalar()
    slots = range(languages.count())  # one sum per language
    # each text once; its sums then need no further exchange where the weights are broadcast
    texts = df.select(key.alias("_text"), low.alias("_low")).groupBy("_text").agg(F.max("_low").alias("_low"))
    grams = texts.select("_text", F.explode(_trigrams(F.col("_low"))).alias("gram"))
    sums = join_side(grams, weights, ["gram"]).groupBy("_text").agg(F.array(*[F.sum(F.col("v")[i]) for i in slots]).alias("_sums"))
    n = F.greatest(F.char_length(low) - 2, F.lit(0))
    scores = F.transform("_ordered", lambda l, i: F.struct(
        (l["prior"] - n * l["log_denom"] + F.coalesce(F.get(F.col("_sums"), i), F.lit(0.0))).alias("score"), l["lang"].alias("lang")))
    # best = highest score; among equal scores the smallest language code
    best = F.aggregate(
        scores, F.struct(F.lit(-math.inf).alias("score"), F.lit(None).cast("string").alias("lang")),
        lambda acc, x: F.when((x["score"] > acc["score"])
                              | ((x["score"] == acc["score"]) & (x["lang"] < acc["lang"])),
                              F.struct(x["score"].alias("score"), x["lang"].alias("lang")))
        .otherwise(acc))
    return (df.withColumns({"_text": key, "_ordered": ordered}).join(sums, "_text", "left")
            .withColumn(out, F.when(n > 0, best["lang"])).drop("_text", "_sums", "_ordered"))


def keep_language(df: DataFrame, lang_col: str = "language", lang: str = "en") -> DataFrame:
    """Language filter (F4): keep rows detected as ``lang``; undetected rows are dropped."""
    return df.filter(F.col(lang_col) == lang)
