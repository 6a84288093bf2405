"""The query catalogue: every operator of the reference run on the driver's
tables. Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match its DuckDB oracle in ``strata.plans.oracles``.

Round-trip queries (CSV, JSON, XML, text, parquet writers) write a copy of a
driver table into a fresh folder of the shared scratch area
(``strata.session.scratch_path``) and read it back through the format.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.strings import java_split, literal_regex, parse_double, split_quoted
from strata.operators import (
    aggregates, als, catalog, fold, language, links, merge, merge_store, panel, recommend, search,
    text,
)
from strata.plans import params as P
from strata.plans.tables import StandIns
from strata.session import exists, fingerprint, scratch_path, shuffles_removed
from strata.sources import csv_records, published, readers, writers
from strata.sources.frames import conform, create_empty_df, parse_as
from strata.sources.scratch import RunScratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- B1, B2, B3: panel, steady venues, citation table ------------------------------------

@query
def venue_year_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return panel.entity_period_counts(s.venues(), s.host(), s.works(), s.years())


def _steady(s: StandIns) -> DataFrame:
    years = s.years()
    counts = panel.entity_period_counts(s.venues(), s.host(), s.works(), years, sort=False)
    return panel.steady_entity_periods(counts, years, P.STEADY_THRESHOLD)


@query
def steady_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steady(StandIns(spark, sf_dir))


@query
def steady_venues_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 as a job: the table is stored, its count rides on the write, and the
    shape of what was stored comes back."""
    path = scratch_path(spark, "steady-venues")
    written = writers.write_with_count(_steady(StandIns(spark, sf_dir)), path)
    rows, columns = writers.shape(readers.read_parquet(spark, path))
    return spark.range(1).select(F.lit(written).cast("bigint").alias("n_written"),
                                 F.lit(rows).cast("bigint").alias("n_rows"),
                                 F.lit(columns).alias("n_columns"))


_LANGUAGE_MODELS: dict[tuple[str, str], str] = {}


def _language_model(s: StandIns) -> language.LanguageModel:
    """The model of the documents' languages, fitted on its training half: fitted
    and stored once per state of the table, and read by every query that detects."""
    state = fingerprint(s.spark, f"{s.sf_dir.rstrip('/')}/documents.parquet")
    key = (s.spark.sparkContext.applicationId, state)
    path = _LANGUAGE_MODELS.get(key)
    if path is None or not exists(s.spark, f"{path}/settings/_SUCCESS"):
        path = scratch_path(s.spark, "language-model")
        train, _ = recommend.modulo_split(s.texts("documents"), "doc_id", P.LANGUAGE_FOLDS)
        with shuffles_removed(s.spark):
            language.fit_profiles(train, "text", "lang", path=path)
        _LANGUAGE_MODELS[key] = path
    return language.load_profiles(s.spark, path)


def _citations(s: StandIns, detect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    works = s.works().select(F.col("work_id").alias("id"), "publication_year")
    return panel.citation_table(_steady(s), s.host().distinct(), works, s.references(),
                                detect=detect, cited_works=s.works_titled())


@query
def citation_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 with the fitted language model."""
    s = StandIns(spark, sf_dir)
    model = _language_model(s)
    return _citations(s, lambda works: language.add_language(model, works, "id", "title"))


CITATION_SCHEMA = ("venue_id bigint, year int, id bigint, referenced_work_id bigint, "
                   "title string, language string, confidence float")


def _citation_inputs(s: StandIns) -> dict[str, DataFrame]:
    return {"works": s.works_titled(), "steady": _steady(s), "host": s.host().distinct(),
            "refs": s.references()}


# CSV as the reference writes it for this job: header, every field quoted,
# quotes doubled, whitespace and line breaks inside texts kept.
CSV_OPTIONS = {"header": True, "quoteAll": True, "escape": '"',
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@query
def citation_language_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 on all-string CSV copies of its inputs, joined in SQL text with the stored
    language model: the join keys compare as strings; the result is parsed into
    the typed schema at the end. Plain text is large: a copy is written when the shuffles
    that made its rows are gone, and goes when its records stand in columns."""
    s = StandIns(spark, sf_dir)
    model = _language_model(s)
    with RunScratch(spark, "citation-csv") as run:
        for name, df in _citation_inputs(s).items():
            copy = run.path(f"{name}-csv")
            with shuffles_removed(spark):
                rows = run.store(df, f"{name}-rows", compression="zstd")
                writers.write_table(rows, copy, fmt="csv", **CSV_OPTIONS)
                run.drop(f"{name}-rows")
                strings = csv_records.read_csv_records(spark, copy, store=run.path(name))
            strings.createOrReplaceTempView(f"strata_csv_{name}")
            run.drop(f"{name}-csv")
        out = panel.citation_table_sql(spark, "strata_csv_steady", "strata_csv_host",
                                       "strata_csv_works", "strata_csv_refs", model)
        run.keep("refs")  # of the copies, the citation table reads these only
    for gone in ("steady", "host", "works"):
        spark.catalog.dropTempView(f"strata_csv_{gone}")
    return parse_as(out, CITATION_SCHEMA)


@query
def citation_language_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 over file-backed views created in SQL (``CREATE TEMPORARY VIEW ...
    USING parquet``) on parquet copies of its inputs, with the stored language model."""
    s = StandIns(spark, sf_dir)
    for name, df in _citation_inputs(s).items():
        path = scratch_path(spark, f"citation-view-{name}")
        writers.write_table(df, path)
        readers.register_view(spark, f"strata_view_{name}", "parquet", path)
    return panel.citation_table_sql(spark, "strata_view_steady", "strata_view_host",
                                    "strata_view_works", "strata_view_refs", _language_model(s))


@query
def detect_and_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detect the language of every work title with the fitted model,
    write the table (overwrite, count riding on the write), read it back."""
    s = StandIns(spark, sf_dir)
    detected = language.add_language(_language_model(s), s.works_titled(), "id", "title",
                                     every_language=True)
    path = scratch_path(spark, "works-detected")
    writers.write_with_count(detected, path, mode="overwrite")
    return readers.read_parquet(spark, path)


# --- L1, U1: language detection --------------------------------------------------------

@query
def language_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any Python detector, here an example that works on whole Arrow batches."""
    docs = StandIns(spark, sf_dir).texts("documents").select("doc_id", "text")
    return language.with_language(docs, "text", language.stopword_language, batch=True).drop("text")


@query
def detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return language.detect_language(_language_model(s), s.texts("documents"), "doc_id", "text",
                                    every_language=True)


# --- B4: merges ------------------------------------------------------------------------

def customer_delta(s: StandIns) -> DataFrame:
    """An all-string update file for ``customer``, derived from the data: new
    balance and segment for customers with an urgent order, and one new
    customer per supplier."""
    updates = (s.t("orders").where(F.col("o_orderpriority") == "1-URGENT")
               .groupBy("o_custkey").agg(F.max("o_totalprice").alias("bal"))
               .select(F.col("o_custkey").cast("string").alias("c_custkey"),
                       F.lit(None).cast("string").alias("c_name"),
                       F.lit(None).cast("string").alias("c_nationkey"),
                       F.col("bal").cast("string").alias("c_acctbal"),
                       F.lit("PRIORITY").alias("c_mktsegment")))
    inserts = s.t("supplier").select(
        (F.col("s_suppkey") + 10_000_000).cast("string").alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").cast("string").alias("c_nationkey"),
        F.col("s_acctbal").cast("string").alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"))
    return updates.unionByName(inserts)


@query
def merge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    base = s.t("customer")
    return merge.merge_upsert(base, customer_delta(s), "c_custkey")


def _yearly_counts_base(s: StandIns) -> DataFrame:
    return (s.t("orders").groupBy(F.col("o_custkey").alias("author_id"),
                                  F.year("o_orderdate").alias("year"))
            .agg(F.count(F.lit(1)).alias("works_count"),
                 F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("cited_by_count")))


def _yearly_counts_delta(s: StandIns) -> DataFrame:
    lines = s.t("lineitem").select("l_orderkey", "l_shipdate")
    orders = s.t("orders").select("o_orderkey", "o_custkey")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", F.year("l_shipdate").alias("ship_year"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("o_custkey").cast("string").alias("author_id"),
                    F.col("ship_year").cast("string").alias("year"),
                    F.col("n").cast("string").alias("works_count"),
                    F.lit(None).cast("string").alias("cited_by_count")))


@query
def merge_counts_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return merge.merge_upsert(_yearly_counts_base(s), _yearly_counts_delta(s),
                              ["author_id", "year"])


def _ids_base(s: StandIns) -> DataFrame:
    return s.t("customer").select(F.col("c_custkey").alias("author_id"),
                                  F.col("c_name").alias("openalex"),
                                  F.col("c_mktsegment").alias("orcid"))


def _ids_delta(s: StandIns) -> DataFrame:
    return (s.t("orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("last"))
            .select((F.col("o_custkey") * 2).cast("string").alias("author_id"),
                    F.lit(None).cast("string").alias("openalex"),
                    F.concat(F.lit("order-"), F.col("last")).alias("orcid")))


@query
def merge_authors_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 as a pipeline: three update files (string CSV) are merged into the
    authors, their yearly counts and their ids; each result is stored (an
    existing table is an error) and read back, and all rows are returned."""
    s = StandIns(spark, sf_dir)
    jobs = (("authors", s.t("customer"), customer_delta(s), ["c_custkey"]),
            ("counts", _yearly_counts_base(s), _yearly_counts_delta(s), ["author_id", "year"]),
            ("ids", _ids_base(s), _ids_delta(s), ["author_id"]))
    out = None
    for name, base, delta, keys in jobs:
        delta_path = scratch_path(spark, f"merge-delta-{name}")
        writers.write_table(delta, delta_path, fmt="csv", **CSV_OPTIONS)
        delta = readers.read_csv(spark, delta_path, infer=False, escape='"')
        path = scratch_path(spark, f"merge-{name}")
        writers.write_with_count(merge.merge_upsert(base, delta, keys), path,
                                 mode="errorifexists")
        stored = readers.read_parquet(spark, path)
        values = [c for c in stored.columns if c not in keys]
        rows = stored.select(
            F.lit(name).alias("part"), F.col(keys[0]).cast("bigint").alias("key"),
            (F.col("year") if "year" in keys else F.lit(None)).cast("int").alias("year"),
            *[F.col(c).cast("string").alias(f"value_{i}") if stored.schema[c].dataType.simpleString()
              != "double" else F.round(c, 2).cast("decimal(18,2)").cast("string").alias(f"value_{i}")
              for i, c in enumerate(values)],
            *[F.lit(None).cast("string").alias(f"value_{i}") for i in range(len(values), 4)])
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def merge_customers_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6, J7 on a stored base: the update file is merged in two halves, each rewriting
    only the partitions that its keys fall into."""
    s = StandIns(spark, sf_dir)
    table = f"strata_customers_{uuid.uuid4().hex}"
    merge_store.create_store(s.t("customer"), table, scratch_path(spark, "customer-store"), "c_custkey",
                             P.STORE_PARTS, P.STORE_BUCKETS)
    delta = customer_delta(s)
    for half in (0, 1):
        own = F.pmod(F.xxhash64("c_custkey"), F.lit(2)) == half
        merge_store.merge_into_store(spark, table, delta.where(own), "c_custkey", P.STORE_PARTS)
    return merge_store.read_store(spark, table)


# --- B5-B8: ratings, titles, retail reports --------------------------------------------

@query
def mean_rating_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return catalog.mean_rating_by_title(s.ratings(), s.movies(), method="fold")


@query
def mean_rating_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return catalog.mean_rating_by_title(s.ratings(), s.movies(), method="join")


@query
def mean_rating_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return catalog.mean_rating_by_title(s.ratings(), s.movies(), method="pandas")


def _add_rating(state: tuple, rating: float | None) -> tuple:
    return state if rating is None else (state[0] + rating, state[1] + 1)


@query
def fold_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, U5 as the general fold: the state is (sum, count)."""
    return fold.fold_by(
        StandIns(spark, sf_dir).ratings(), "item_id", ["rating"],
        create=lambda r: _add_rating((0.0, 0), r), merge=_add_rating,
        combine=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda s: s[0] / s[1] if s[1] else None, result_type="double", name="mean_rating")


@query
def fold_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state is a pair, the lowest and the highest rating."""
    found = fold.fold_by(
        _user_ratings(StandIns(spark, sf_dir)).where(F.col("rating").isNotNull()), "user_id", ["rating"],
        create=lambda r: (r, r), merge=lambda s, r: (min(s[0], r), max(s[1], r)),
        combine=lambda a, b: (min(a[0], b[0]), max(a[1], b[1])),
        finish=lambda s: {"lowest": s[0], "highest": s[1]},
        result_type="struct<lowest: double, highest: double>", name="e")
    return found.select("user_id", "e.lowest", "e.highest")


@query
def fold_item_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state is a set, the items that a user rated."""
    return fold.fold_by(
        _user_ratings(StandIns(spark, sf_dir)), "user_id", ["item_id"], create=lambda i: {i},
        merge=lambda s, i: s | {i} if i not in s else s, combine=lambda a, b: a | b,
        finish=lambda s: ",".join(map(str, sorted(s))), result_type="string", name="items")


@query
def ratings_per_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.ratings_per_item(StandIns(spark, sf_dir).ratings())


@query
def most_rated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return catalog.most_rated(s.ratings(), s.movies(), P.TOP_TITLES)


@query
def tags_exceed_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return catalog.tags_exceed_genres(s.tags(), s.movies(), "title", separator=" ")


@query
def tag_counts_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return catalog.tag_counts_by_title(s.tags(), s.movies())


@query
def genre_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.genre_ranking(StandIns(spark, sf_dir).movies(), "title", separator=" ")


@query
def orders_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.hourly_counts(StandIns(spark, sf_dir).t("events"), "ts", "event_id")


@query
def orders_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = StandIns(spark, sf_dir).t("orders").withColumn("dow", F.dayofweek("o_orderdate"))
    return catalog.weekday_counts(spark, orders, "dow", "o_orderkey")


@query
def orders_by_weekday_base0(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = StandIns(spark, sf_dir).t("orders").withColumn(
        "dow", F.dayofweek("o_orderdate") - 1)
    return catalog.weekday_counts(spark, orders, "dow", "o_orderkey")


def _departments(s: StandIns, share: bool) -> DataFrame:
    out = catalog.group_ratio(s.t("customer"), s.t("nation"), "c_custkey", "c_nationkey",
                              "n_nationkey", "n_name", share=share)
    return out.withColumnRenamed("n_name", "department")


@query
def group_id_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _departments(StandIns(spark, sf_dir), share=False)


@query
def group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _departments(StandIns(spark, sf_dir), share=True).drop("procent")


@query
def filter_sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/part.parquet"
    readers.register_view(spark, "strata_part", "parquet", path)
    rows = spark.sql(f"SELECT * FROM strata_part WHERE p_partkey > {P.FILTER_MIN_KEY} "
                     "ORDER BY p_partkey DESC")
    return conform(rows, readers.read_parquet(spark, path).schema)


@query
def filter_sort_desc_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    path = scratch_path(spark, "part-json")
    writers.write_table(part, path, fmt="json")
    readers.read_json(spark, path).createOrReplaceTempView("strata_part_json")
    typed = parse_as(spark.sql(f"SELECT * FROM strata_part_json WHERE p_partkey > "
                               f"{P.FILTER_MIN_KEY} ORDER BY p_partkey DESC"), part.schema)
    return typed


@query
def eligible_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.eligible_items(StandIns(spark, sf_dir).ratings(), "item_id", "rating",
                                    P.ELIGIBLE_MIN_RATINGS)


# --- B9: words ------------------------------------------------------------------------

def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.lines_of(StandIns(spark, sf_dir).texts("documents"), "text")


@query
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(_lines(spark, sf_dir))


@query
def word_count_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_totals(text.word_count(_lines(spark, sf_dir), sort=False))


@query
def word_count_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count_filtered(_lines(spark, sf_dir), separators=P.WORD_SEPARATORS,
                                    stop_words=P.STOP_WORDS)


RATINGS_HEADER = "userId,movieId,rating"


@query
def mean_rating_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 the way the reference reads ratings: raw CSV lines from a text file,
    split with JVM rules, fields taken by position, the rating parsed with a
    bad-number fallback; the header line is never counted (Q1)."""
    raw = _ratings_lines(spark, StandIns(spark, sf_dir))
    fields = raw.select(java_split(F.col("value"), literal_regex(",")).alias("f"))
    ratings = fields.select(F.col("f")[1].cast("bigint").alias("item_id"),
                            F.col("f")[2].alias("rating"))
    return aggregates.mean_by(ratings, "item_id", "rating", method="fold", name="mean_rating")


def _ratings_lines(spark: SparkSession, s: StandIns) -> DataFrame:
    """Ratings as raw CSV text lines (header first), read back from a text file."""
    lines = (s.t("lineitem").join(s.t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
             .select(F.concat_ws(",", F.col("o_custkey").cast("string"),
                                 F.col("l_partkey").cast("string"),
                                 F.col("l_quantity").cast("string")).alias("value")))
    header = spark.createDataFrame([(RATINGS_HEADER,)], "value string")
    path = scratch_path(spark, "ratings-text")
    writers.write_table(header.union(lines), path, fmt="text")
    return readers.read_text(spark, path).where(F.col("value") != RATINGS_HEADER)


@query
def mean_rating_titled_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 to the end on raw lines: ratings and movies both from text files, the mean
    rating of each movie with its title."""
    s = StandIns(spark, sf_dir)
    fields = _ratings_lines(spark, s).select(java_split(F.col("value"), literal_regex(",")).alias("f"))
    ratings = fields.select(F.col("f")[1].cast("bigint").alias("item_id"), F.col("f")[2].alias("rating"))
    means = aggregates.mean_by(ratings, "item_id", "rating", method="fold", name="mean_rating")
    return means.join(_movie_lines(spark, s).select("item_id", "title"), "item_id")


@query
def ratings_per_item_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5a from raw lines: the movie id is field 1 of each line; the header
    line is never counted (Q1)."""
    raw = _ratings_lines(spark, StandIns(spark, sf_dir))
    items = raw.select(java_split(F.col("value"), literal_regex(","))[1].cast("bigint")
                       .alias("item_id"))
    return catalog.ratings_per_item(items)


MOVIES_HEADER = "movieId,title,genres"


def _movie_lines(spark: SparkSession, s: StandIns) -> DataFrame:
    """Movies as raw CSV text lines: the title quoted (it holds a comma), the
    genres joined by '|'."""
    part = s.t("part")
    lines = part.select(F.concat(F.col("p_partkey").cast("string"), F.lit(',"'),
                                 F.col("p_name"), F.lit(", "), F.col("p_brand"), F.lit('",'),
                                 F.regexp_replace("p_name", " ", "|")).alias("value"))
    header = spark.createDataFrame([(MOVIES_HEADER,)], "value string")
    path = scratch_path(spark, "movies-text")
    writers.write_table(header.union(lines), path, fmt="text")
    raw = readers.read_text(spark, path).where(F.col("value") != MOVIES_HEADER)
    fields = raw.select(split_quoted(F.col("value")).alias("f"))
    return fields.select(F.col("f")[0].cast("bigint").alias("item_id"),
                         F.col("f")[1].alias("title"), F.col("f")[2].alias("genres"))


@query
def genre_ranking_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 from raw movie lines: quote-aware split, genres split on '|'."""
    return catalog.genre_ranking(_movie_lines(spark, StandIns(spark, sf_dir)), "genres", "|")


@query
def tags_exceed_genres_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 from raw lines: tag lines counted by their movie id (field 1),
    joined to the genre count of each movie line, filtered, titled."""
    s = StandIns(spark, sf_dir)
    movies = _movie_lines(spark, s)
    tag_lines = s.tags().join(s.t("part"), F.col("item_id") == F.col("p_partkey")).select(
        F.concat(F.lit("0,"), F.col("item_id").cast("string"), F.lit(',"'), F.col("p_type"),
                 F.lit('",0')).alias("value"))
    path = scratch_path(spark, "tags-text")
    writers.write_table(tag_lines, path, fmt="text")
    tags = readers.read_text(spark, path).select(
        split_quoted(F.col("value"))[1].cast("bigint").alias("item_id"))
    return catalog.tags_exceed_genres(tags, movies, "genres", separator="|")


@query
def word_count_text_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9 as the reference runs it: the texts written as a text file, read
    back line by line (S9), counted."""
    docs = StandIns(spark, sf_dir).texts("documents").select("text")
    path = scratch_path(spark, "book-text")
    writers.write_table(docs, path, fmt="text")
    return text.word_count(readers.read_text(spark, path))


@query
def word_count_whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9, B9 with one row per file (``wholetext``): each file's text is cut into pieces
    that spread over the tasks, and their lines are counted."""
    docs = StandIns(spark, sf_dir).texts("documents").select("text")
    path = scratch_path(spark, "book-whole")
    writers.write_table(docs, path, fmt="text")
    pieces = text.spread_texts(readers.read_text(spark, path, whole_text=True), "value",
                               piece_bytes=P.PIECE_BYTES)
    return text.word_count(text.lines_of(pieces, "value"))


# --- E4, E7, E12: parsing --------------------------------------------------------------

@query
def split_quoted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    lines = part.select(F.concat(F.col("p_partkey").cast("string"), F.lit(',"'), F.col("p_name"),
                                 F.lit(", "), F.col("p_brand"), F.lit('",'), F.col("p_type"),
                                 F.lit("|"), F.col("p_size").cast("string")).alias("line"))
    fields = lines.select(split_quoted(F.col("line")).alias("f"))
    return fields.select(F.col("f")[0].cast("bigint").alias("item_id"),
                         F.col("f")[1].alias("title_field"), F.col("f")[2].alias("rest"),
                         F.size("f").alias("n_fields"))


@query
def parse_double_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = StandIns(spark, sf_dir).t("events").select(
        "event_type", F.regexp_extract("props", r":\s*([^}]*)\}", 1).alias("k"))
    return (events.select("event_type", parse_double(F.col("k")).alias("k"))
            .groupBy("event_type")
            .agg(F.avg("k").alias("k_mean"),
                 (F.sum("k") / F.count(F.lit(1))).alias("k_mean_all_rows"),
                 F.count_if(F.col("k").isNull()).alias("k_bad")))


# --- S1-S13, K1, K2: sources and sinks round trips --------------------------------------

def _round_trip(spark: SparkSession, df: DataFrame, fmt: str, name: str, **options) -> str:
    path = scratch_path(spark, name)
    writers.write_table(df, path, fmt=fmt, **options)
    return path


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    return readers.read_table(spark, _round_trip(spark, part, "parquet", "part-parquet"))


@query
def scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    path = _round_trip(spark, part, "csv", "part-csv", header=True)
    strings = readers.read_csv(spark, path, infer=False)
    return parse_as(strings, part.schema)


@query
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    path = _round_trip(spark, part, "csv", "part-csv-infer", header=True)
    return parse_as(readers.read_csv(spark, path, infer=True), part.schema)


@query
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    path = _round_trip(spark, part, "json", "part-json-scan")
    return parse_as(readers.read_json(spark, path), part.schema)


@query
def scan_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    pages = part.select(
        F.col("p_partkey").alias("title"),
        F.struct(F.struct(F.col("p_name").alias("_VALUE"),
                          F.length("p_name").cast("bigint").alias("_bytes")).alias("text"))
        .alias("revision"))
    path = _round_trip(spark, pages, "xml", "part-xml", rowTag="page")
    back = readers.read_xml(spark, path, row_tag="page")
    return back.select(F.col("title").cast("bigint").alias("item_id"),
                       F.col("revision.text._VALUE").alias("title"))


@query
def scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part").select("p_name")
    return readers.read_text(spark, _round_trip(spark, part, "text", "part-text"))


@query
def create_empty_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = StandIns(spark, sf_dir).t("nation")
    return create_empty_df(spark, nation.schema).unionByName(nation)


@query
def read_or_empty_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = StandIns(spark, sf_dir).t("nation")
    missing = readers.read_or_empty(spark, scratch_path(spark, "never-written"), nation.schema)
    present = readers.read_or_empty(spark, f"{sf_dir.rstrip('/')}/nation.parquet", nation.schema)
    return missing.unionByName(present)


@query
def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    path = scratch_path(spark, "part-overwrite")
    writers.write_table(part, path, mode="overwrite")
    writers.write_table(part, path, mode="overwrite")
    return readers.read_parquet(spark, path)


@query
def write_error_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = StandIns(spark, sf_dir).t("part")
    path = scratch_path(spark, "part-errorifexists")
    writers.write_with_count(part, path, mode="errorifexists")
    try:
        writers.write_table(part, path, mode="errorifexists")
    except Exception as exc:  # the second write must be refused
        if "already exists" not in str(exc).lower() and "PATH_ALREADY_EXISTS" not in str(exc):
            raise
    else:
        raise AssertionError("errorifexists wrote over an existing table")
    return readers.read_parquet(spark, path)


@query
def write_recoverable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 without a moment without a table: published, replaced from itself, read."""
    part = StandIns(spark, sf_dir).t("part")
    path = scratch_path(spark, "part-published")
    published.publish(part, path)
    smaller = published.read_published(spark, path).where(F.col("p_size") > P.PUBLISH_MIN_SIZE)
    version = published.publish(smaller, path)
    published.vacuum(spark, path, keep=1)
    return published.read_published(spark, path).withColumn("version", F.lit(version.number)) \
        .withColumn("stored_rows", F.lit(version.rows).cast("bigint"))


# --- B10: links, graph, PageRank --------------------------------------------------------

# Fixed value: our stand-in turns each page's anchors into wiki links [[target|label]].
ANCHOR = r'<a href="/?([^"]*)">([^<]*)</a>'


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = StandIns(spark, sf_dir).texts("pages")
    return pages.select(F.col("url").alias("title"),
                        F.regexp_replace("html", ANCHOR, "[[$1|$2]]").alias("text"))


@query
def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extract_links(wiki_pages(spark, sf_dir), "title", "text")


@query
def link_edges_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extract_links(wiki_pages(spark, sf_dir), "title", "text", raw=True)


@query
def link_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = StandIns(spark, sf_dir).texts("pages")
    return links.extract_links(pages, "url", "html", pattern=r'href="([^"]*)"',
                               skip_prefixes=(), separator=None)


def _part_supplier_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return StandIns(spark, sf_dir).t("lineitem").select(F.col("l_partkey").alias("src"),
                                                        F.col("l_suppkey").alias("dst"))


@query
def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.graph_vertices(_part_supplier_edges(spark, sf_dir))


@query
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = links.pagerank(_part_supplier_edges(spark, sf_dir), P.PAGERANK_ITERATIONS,
                           P.PAGERANK_RESET)
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank"))


@query
def wiki_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = links.extract_links(wiki_pages(spark, sf_dir), "title", "text")
    ranks = links.pagerank(edges, P.PAGERANK_ITERATIONS, P.PAGERANK_RESET)
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank"))


@query
def wiki_pagerank_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B10 from the file: XML pages (rowTag) -> nested text -> links -> ranks."""
    pages = wiki_pages(spark, sf_dir).select("title", F.struct(F.struct(
        F.lit("preserve").alias("_space"), F.col("text").alias("_VALUE")).alias("text"))
        .alias("revision"))
    path = scratch_path(spark, "wiki-xml")
    writers.write_table(pages, path, fmt="xml", rowTag="page", rootTag="mediawiki")
    nested = readers.read_xml(spark, path, row_tag="page", schema=pages.schema)
    edges = links.extract_links(nested.select("title", F.col("revision.text._VALUE").alias("text")),
                                "title", "text")
    ranks = links.pagerank(edges, P.PAGERANK_ITERATIONS, P.PAGERANK_RESET)
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank"))


# --- B11: recommendations -------------------------------------------------------------

def _user_ratings(s: StandIns) -> DataFrame:
    lines = s.t("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = s.t("orders").select("o_orderkey", "o_custkey")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                    (F.col("l_quantity") / 10).alias("rating")))


def _fit(s: StandIns):
    ratings = _user_ratings(s)
    train, test = recommend.hash_split(ratings, ["user_id", "item_id"], P.ALS_TRAIN_PERCENT,
                                       P.ALS_SEED)
    model = recommend.fit_recommender(train, "user_id", "item_id", "rating",
                                      max_iter=P.ALS_MAX_ITER, reg_param=P.ALS_REG_PARAM,
                                      seed=P.ALS_SEED)
    return ratings, test, model


@query
def als_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fit(StandIns(spark, sf_dir))
    return recommend.rmse(model, test, "user_id", "item_id", "rating")


@query
def als_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    ratings, _, model = _fit(s)
    items = recommend.eligible_items(ratings, "item_id", "rating", P.ELIGIBLE_MIN_RATINGS)
    recs = recommend.recommend_users_for_items(model, items, P.ALS_TOP_K, "item_id")
    return recommend.titled(recs, s.movies(), "item_id")


_ALS_FACTORS: dict[tuple[str, str, str], als.Factors] = {}


def _fit_two_factors(s: StandIns) -> tuple[als.Factors, DataFrame, DataFrame]:
    """ALS by normal equations with two factors: (factors, ratings, held-out part). The
    factors are fitted and stored once per state of the two tables."""
    ratings = _user_ratings(s)
    train, test = recommend.modulo_split(
        ratings.withColumn("_pair", F.col("user_id") * 7 + F.col("item_id")), "_pair")
    key = (s.spark.sparkContext.applicationId, *[
        fingerprint(s.spark, f"{s.sf_dir.rstrip('/')}/{name}.parquet") for name in ("lineitem", "orders")])
    factors = _ALS_FACTORS.get(key)
    if factors is None or not exists(s.spark, factors.path):
        start = train.select(F.col("item_id").alias("id")).distinct().select(
            "id", F.array(F.lit(1.0), F.pmod(F.col("id") * P.ALS_START, F.lit(1000)) / 1000.0)
            .alias("features"))
        factors = als.fit_als(train, rank=2, iterations=P.ALS_SQL_ITERATIONS, reg=P.ALS_REG_PARAM,
                              start=start)
        _ALS_FACTORS[key] = factors
    return factors, ratings, test


@query
def als_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 by our own normal equations: the items' factors."""
    factors, _, _ = _fit_two_factors(StandIns(spark, sf_dir))
    return factors.items.select(F.col("id").alias("item_id"), *[
        F.round(F.col("features")[i], 5).alias(f"factor_{i + 1}") for i in range(2)])


@query
def als_heldout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error on held-out ratings; cold starts drop out."""
    factors, _, test = _fit_two_factors(StandIns(spark, sf_dir))
    return recommend.rmse_of(als.predict(factors, test), "rating").select(
        F.round("rmse", 5).alias("rmse"), "n_scored")


@query
def als_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5, M6, M7: the users with the highest predictions of each eligible item, by
    the exact inner-product search."""
    s = StandIns(spark, sf_dir)
    factors, ratings, _ = _fit_two_factors(s)
    items = recommend.eligible_items(ratings, "item_id", "rating", P.ELIGIBLE_MIN_RATINGS)
    top = recommend.top_users_by_factors(factors.users, factors.items, items, P.ALS_TOP_K, "item_id",
                                         "user_id")
    return top.join(s.movies(), "item_id").select("item_id", "title", "user_id", "rank",
                                                  F.round("score", 5).alias("score"))


@query
def max_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6's search on its own: for every embedding of label 0 the three embeddings with
    the largest inner product, of all; whole-number vectors, so that sums are exact."""
    vectors = StandIns(spark, sf_dir).t("embeddings").select("vec_id", "label", F.transform(
        "embedding", lambda c: F.floor(c.cast("double") * 1024).cast("double")).alias("v"))
    found = search.max_inner_products(vectors.where(F.col("label") == 0), vectors, P.ALS_TOP_K,
                                      id_col="vec_id", vector_col="v")
    return found.matches.select(F.col("query").alias("vec_id"), "rank",
                                F.col("base").alias("other_id"), F.col("score").cast("long").alias("score"))


@query
def item_mean_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M3, M4 on a predictor that SQL can state."""
    train, test = recommend.modulo_split(_user_ratings(StandIns(spark, sf_dir)), "user_id")
    predicted = recommend.item_mean_predictions(train, test, "item_id", "rating")
    return recommend.rmse_of(predicted, "rating").select(
        F.round("rmse", 6).alias("rmse"), "n_scored")


@query
def top_users_per_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5, M6, M7: the users with the highest mean rating of each eligible item."""
    s = StandIns(spark, sf_dir)
    ratings = _user_ratings(s)
    scores = ratings.groupBy("item_id", "user_id").agg(F.max("rating").alias("score"))
    items = recommend.eligible_items(ratings, "item_id", "rating", P.ELIGIBLE_MIN_RATINGS)
    top = recommend.top_k_users(scores, items, "item_id", "user_id", "score", P.ALS_TOP_K)
    return top.join(s.movies(), "item_id").select("item_id", "title", "user_id", "rank", "score")


def queries() -> dict[str, Query]:
    return dict(QUERIES)
