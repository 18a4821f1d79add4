"""News: normalise, dedupe, symbol matching, language, sentiment score and aggregate."""

import datetime as dt

from tickflow.operators import news as N
from tickflow.operators import sentiment as SE
from tickflow.sources import schemas as SC


def test_normalize_defaults(spark):
    rows = [("A", "T1", "2024-01-01T00:00:00Z", "d  http://x y\n", "u", "c\\d", {"name": "src"}),
            ("A", None, None, None, None, None, None)]
    df = spark.createDataFrame([(r[0],) + r[1:] for r in rows],
                               "symbol string, " + SC.ARTICLE.simpleString()[len("struct<"):-1].replace(":", " "))
    got = N.normalize(df).collect()
    assert (got[0].title, got[0].description, got[0].content, got[0].source_name) == ("T1", "d y", "cd", "src")
    assert (got[1].title, got[1].description, got[1].url, got[1].source_name, got[1].content) == ("", "", "", "", "")


def test_dedupe_earliest_then_url(spark):
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [("A", "Same Title", t0, "b"), ("A", "same title", t0, "a"), ("A", "SAME TITLE", t0 - dt.timedelta(1), "z"),
            ("B", "same title", t0, "c"), ("A", "other", t0, "d")]
    df = spark.createDataFrame(rows, "symbol string, title string, publishedAt timestamp_ntz, url string")
    got = sorted((r.symbol, r.url) for r in N.dedupe(df).collect())
    assert got == [("A", "d"), ("A", "z"), ("B", "c")]


def test_match_symbols(spark):
    arts = spark.createDataFrame(
        [("1", "AAPL rises", ""), ("2", "Apple Inc results", None), ("3", "apple pie", "no suffix"),
         ("4", "Micro soft", "inc"), ("5", "nothing", "here")],
        "url string, title string, description string")
    comps = spark.createDataFrame([("AAPL", "Apple"), ("MSFT", "Micro Soft"), ("X", None)], "symbol string, company string")
    got = sorted((r.url, r.symbol) for r in N.match_symbols(arts, comps).collect())
    assert got == [("1", "AAPL"), ("2", "AAPL"), ("4", "MSFT")]


def test_language_detection_small(spark):
    train = spark.createDataFrame(
        [("the cat and the dog are in the house with the other things", "en"),
         ("der hund und die katze sind in dem haus mit den anderen dingen", "de"),
         ("the weather is nice and the sun is shining on the hill", "en")],
        "text string, lang string")
    w, langs = N.train_language_profiles(train)
    none = spark.createDataFrame([(None, "die katze und der hund"), ("", "the sun and the hill"), ("", "der hund"), (None, "the dog"), (None, "the dog")], "url string, title string")
    assert sorted((r.title, r.language) for r in N.detect_language(none, w, langs).collect()) == [
        ("der hund", "de"), ("die katze und der hund", "de"), ("the dog", "en"), ("the dog", "en"), ("the sun and the hill", "en")]
    titles = spark.createDataFrame([("1", "the house and the sun"), ("2", "die katze und der hund"), ("3", "ab"),
                                    ("4", None)], "url string, title string")
    got = {r.url: r.language for r in N.detect_language(titles, w, langs).collect()}
    assert got == {"1": "en", "2": "de", "3": None, "4": None}


def test_sentiment_of_a_large_lexicon_is_looked_up_once_a_chunk(spark, monkeypatch):
    """Same scores as with a broadcast lexicon; a chunk's distinct words meet the lexicon, not every token."""
    from decimal import Decimal
    texts = [None, "", "!!", "not good", "good not good", "Very good good bad", "bad", "x y z"] + ["good bad very good"] * 50 + [f"good w{chr(97 + i)} not bad" for i in range(20)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    lexicon = spark.createDataFrame([("good", 0.123457), ("bad", -0.5), ("GOOD", 0.1), ("wa", 1e9)], "term string, polarity double")
    modifiers = spark.createDataFrame([("not", -0.333333), ("very", 1.3)], "term string, factor double")
    small = {(r.k0, r.k1): (r.total, r.hits) for r in SE.text_scores(d.dropDuplicates(["text"]), lexicon, modifiers, "text").collect()}
    rounded = lambda df: sorted((r.doc_id, r.sentiment_score) for r in df.collect())
    score = rounded(SE.score(d, lexicon, modifiers, text="text"))
    old, tables, stored = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), {}, SE.stored
    monkeypatch.setattr(SE, "stored", lambda df, name: tables.setdefault(name, stored(df, name)))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        for size in (1, 25, 2_000_000):
            monkeypatch.setattr(SE, "CHUNK_TOKENS", size)
            tables.clear()
            assert {(r.k0, r.k1): (r.total, r.hits) for r in SE.text_scores(d.dropDuplicates(["text"]), lexicon, modifiers, "text").collect()} == small
            tables.clear()
            assert rounded(SE.score(d, lexicon, modifiers, text="text")) == score
            assert (tables["chunks"].count() == 1) == (size == 2_000_000)
        assert sum(len(r.words) for r in tables["chunks"].collect()) == 4 + 3 + 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert Decimal("-0.041152292181") in {t for t, _ in small.values()}


def test_sentiment_score_rules(spark):
    lex = spark.createDataFrame([("good", 0.8), ("bad", -0.6), ("Great", 1.0)], "term string, polarity double")
    mods = spark.createDataFrame([("not", -0.5), ("very", 1.5)], "term string, factor double")
    rows = [("1", "good"), ("2", "not good"), ("3", "very great day"), ("4", "nothing here"), ("5", None),
            ("6", "good bad"), ("7", "")]
    df = spark.createDataFrame(rows, "id string, content string")
    got = {r.id: r.sentiment_score for r in SE.score(df, lex, mods).collect()}
    assert abs(got["1"] - 0.8) < 1e-6 and abs(got["2"] + 0.4) < 1e-6
    assert got["3"] == 1.0                      # 1.5 clipped to 1
    assert got["4"] == 0.0 and got["7"] == 0.0 and got["5"] is None
    assert abs(got["6"] - 0.1) < 1e-6


def test_sentiment_aggregate_counts_null_scores(spark):
    rows = [("A", 0.5), ("A", -0.5), ("A", 0.0), ("A", None)]
    df = spark.createDataFrame(rows, "symbol string, sentiment_score float")
    r = SE.aggregate(df, keys=("symbol",)).first()
    assert (r.positive_count, r.negative_count, r.neutral_count) == (1, 1, 1)
    assert r.positive_percentage == 25.0 and r.negative_percentage == 25.0
    assert r.positive_avg_score == 0.5 and r.negative_avg_score == -0.5


def test_matching_tells_articles_of_one_url_apart(spark):
    rows = [("u", "Micro news", ""), ("u", "Soft inc", ""), (None, "MSFT up", ""), (None, "apple", "Inc"), ("", "AAPL", ""), ("", "AAPL", "")]
    arts = spark.createDataFrame(rows, "url string, title string, description string")
    comps = spark.createDataFrame([("AAPL", "Apple"), ("MSFT", "Micro Soft")], "symbol string, company string")
    got = sorted((r.url or "-", r.symbol) for r in N.match_symbols(arts, comps).collect())
    assert got == [("-", "AAPL"), ("-", "AAPL"), ("-", "MSFT")]


def test_dedupe_keeps_one_of_equal_rows(spark):
    rows = [("A", "T", "2024-01-01", None), ("A", "t", "2024-01-01", None), ("A", "t", "2024-01-01", None), ("A", None, "2024-01-02", "u"), ("A", "", "2024-01-01", "u")]
    df = spark.createDataFrame(rows, "symbol string, title string, publishedAt string, url string")
    got = N.dedupe(df.repartition(4)).collect()
    assert len(got) == 2 and {(r.title or "").lower() for r in got} == {"t", ""}


def test_lexicons_of_any_size_and_repeated_texts(spark):
    terms = spark.range(20000).selectExpr("concat('w', translate(cast(id as string), '0123456789', 'abcdefghij')) as term", "double(id % 3 - 1) as polarity")
    mods = spark.createDataFrame([], "term string, factor double")
    df = spark.createDataFrame([(i, "wab wac wad x") for i in range(50)] + [(99, "wab"), (100, None)], "id int, content string")
    small = {r.id: r.sentiment_score for r in SE.score(df, terms, mods).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        large = {r.id: r.sentiment_score for r in SE.score(df, terms, mods).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # a = 0 ... so wab, wac, wad are 1, 2, 3: polarities 0, 1, -1
    assert small == large == {**{i: 0.0 for i in range(50)}, 99: 0.0, 100: None}
