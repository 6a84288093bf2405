from pyspark.sql import functions as F

import pandas as pd
import pytest

from strata.operators import language
from strata.operators.language import (
    add_language, detect_language, detection_sql, fit_profiles, load_profiles, register_profiles,
    stopword_language, text_ngrams, with_language,
)
from strata.operators.recommend import hash_split
from tests.conftest import SF_MID


def test_word_ngrams(spark):
    df = spark.createDataFrame([(1, "Ab, c!"), (2, None), (3, "  ")], "id int, t string")
    grams = text_ngrams(df, ["id"], "t", 3, outer=True).collect()
    by_id = {}
    for r in grams:
        by_id.setdefault(r["id"], []).append(r["gram"])
    assert sorted(by_id[1]) == sorted([" ab", "ab ", " c "])
    assert by_id[2] == [None] and by_id[3] == [None]


def test_detect_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    train, held = hash_split(docs, ["doc_id"], 50, 7)
    model = fit_profiles(train, "text", "lang")
    out = detect_language(model, held, "doc_id", "text").join(held.select("doc_id", "lang"),
                                                               "doc_id")
    total = out.count()
    right = out.where(F.col("language") == F.col("lang")).count()
    assert total == held.count()
    assert right / total >= 0.95
    conf = out.agg(F.min("confidence"), F.max("confidence")).first()
    assert 0.0 < conf[0] <= conf[1] <= 1.0


def test_detect_unknown_for_empty_text(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr")],
                                  "text string, lang string")
    model = fit_profiles(train, "text", "lang")
    df = spark.createDataFrame([(1, None), (2, "!!"), (3, "the dog and the cat")],
                               "id int, text string")
    out = {r["id"]: (r["language"], r["confidence"]) for r in
           detect_language(model, df, "id", "text").collect()}
    assert out[1] == ("Unknown", 0.0) and out[2] == ("Unknown", 0.0)
    assert out[3][0] == "en"


def test_add_language_keeps_columns(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr")],
                                  "text string, lang string")
    df = spark.createDataFrame([(1, "the dog", "x"), (2, None, "y"), (None, "le chien", "z"),
                                (3, "!!", None)], "id int, text string, other string")
    out = add_language(fit_profiles(train, "text", "lang"), df, "id", "text")
    assert out.columns == ["id", "text", "other", "language", "confidence"]
    rows = {r["other"]: (r["id"], r["text"], r["language"]) for r in out.collect()}
    assert rows == {"x": (1, "the dog", "en"), "y": (2, None, "Unknown"),
                    "z": (None, "le chien", "fr"), None: (3, "!!", "Unknown")}


def test_stopword_detector():
    got = stopword_language(pd.Series([None, "xyz", "The cat and the dog der", ""]))
    assert got["language"].tolist() == ["Unknown", "Unknown", "en", "Unknown"]
    assert got["confidence"].tolist() == [0.0, 0.0, 0.75, 0.0]


def test_with_language_struct(spark):
    df = spark.createDataFrame([(1, "the and of"), (2, None)], "id int, t string")
    out = with_language(df, "t", stopword_language, batch=True)
    assert out.schema["confidence"].dataType.simpleString() == "float"
    rows = {r["id"]: (r["language"], r["confidence"]) for r in out.collect()}
    assert rows == {1: ("en", 1.0), 2: ("Unknown", 0.0)}


def test_with_language_of_one_text(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "id int, t string")
    out = with_language(df, "t", lambda t: ("none", 0.0) if t is None else (t, len(t) / 4))
    assert {r["id"]: (r["language"], r["confidence"]) for r in out.collect()} == \
        {1: ("ab", 0.5), 2: ("none", 0.0)}


def test_stored_model_opens_again(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    fitted = fit_profiles(docs.where("doc_id % 2 = 1"), "text", "lang", n=2, path=str(tmp_path / "m"))
    again = load_profiles(spark, str(tmp_path / "m"))
    assert again.n == 2
    held = docs.where("doc_id % 20 = 0")
    a, b = (sorted(map(tuple, detect_language(m, held, "doc_id", "text").collect()))
            for m in (fitted, again))
    assert a == b and len(a) == held.count()


def test_sql_form_equals_dataframe_form_without_python(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 !!"), (-4, "ωx"), (-5, "a")],
                                "doc_id long, text string")
    model = fit_profiles(spark.read.parquet(f"{SF_MID}/documents.parquet").where("doc_id % 2 = 1"),
                         "text", "lang")
    held = docs.where("doc_id % 4 = 0").union(odd)
    held.createOrReplaceTempView("held_texts")
    sql = spark.sql(detection_sql(model, register_profiles(model, "held_model"), "held_texts",
                                  "doc_id", "text"))
    assert "ArrowEvalPython" not in sql._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(tuple, detect_language(model, held, "doc_id", "text").collect()))
    assert sorted(map(tuple, sql.collect())) == want
    assert {r[1] for r in want if r[0] in (-1, -2, -3)} == {"Unknown"}
    with pytest.raises(ValueError):
        detection_sql(model, "m", "x; DROP", "doc_id", "text")


def test_citation_sql_runs_without_python(spark):
    from strata.plans import queries
    from tests.conftest import SF_SMALL

    for name in ("citation_language_csv", "citation_language_view"):
        plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_queries_share_one_model(spark, monkeypatch):
    from strata.plans import queries
    from tests.conftest import SF_SMALL

    queries._LANGUAGE_MODELS.clear()
    fits = []
    fit = language.fit_profiles
    monkeypatch.setattr(language, "fit_profiles", lambda *a, **k: fits.append(1) or fit(*a, **k))
    for name in ("detect_language", "detect_and_store", "citation_language"):
        queries.QUERIES[name](spark, SF_SMALL)
    assert len(fits) == 1


def test_very_many_labels(spark):
    """Labels are rows, not columns: 100,000 of them fit and detect as a few do."""
    spoken = spark.range(100_000).selectExpr("'l' || id AS lang", "'word' || translate(hex(id * 7919), '0123456789', 'GHIJKLMNOP') AS t")
    model = fit_profiles(spoken, "t", "lang", n=6)
    df = spoken.where("lang = 'l4242'").selectExpr("1 AS id", "t")
    out = detect_language(model, df, "id", "t").first()
    assert out["language"] == "l4242" and 0 < out["confidence"] < 1


def test_full_vocabulary_model(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    train, held = hash_split(docs, ["doc_id"], 50, 7)
    model = fit_profiles(train, "text", "lang")
    out = detect_language(model, held, "doc_id", "text").join(held.select("doc_id", "lang"),
                                                               "doc_id")
    right = out.where(F.col("language") == F.col("lang")).count()
    assert right / out.count() >= 0.95


@pytest.mark.parametrize("name", ["detect_language", "detect_and_store"])
def test_every_language_is_a_candidate(spark, tmp_path, name):
    """A text that one language alone has heard still weighs all of them; a language
    without n-grams is none. Nine languages fill more than one block."""
    import duckdb
    from strata.plans import oracles, queries

    rows = [(2 * i + 1, f"{w} {w}s ab", f"l{i}") for i, w in enumerate(
        ("lumo", "trak", "bezi", "goru", "fyna", "kepo", "dwil", "shuz", "vomp"))]
    rows += [(101, "12 !!", "none"), (2, "lumo", None), (4, "trak traks bezi zz", None), (6, "??", None),
             (8, None, None), (103, "lumo " * 30, "l0"), (12, "vomp", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.sql("SELECT id AS o_orderkey, timestamp'1995-01-02' AS o_orderdate FROM range(110)") \
        .coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    con = duckdb.connect()
    for table in ("documents", "orders"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.execute(oracles.SQL[name]).fetchall()
    got = list(map(tuple, queries.QUERIES[name](spark, str(tmp_path)).collect()))
    key = lambda r: (r[:-1], round(r[-1], 4))
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
    confidence = {r[0]: r[-1] for r in got}
    assert 0 < confidence[12] < 1 and confidence[6] == 0
