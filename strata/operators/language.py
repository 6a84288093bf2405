"""Language detection of a text column.

The reference calls a native per-row library from a Python UDF. Here the
detector is a Spark job over a stored model:

* ``fit_profiles`` learns a character n-gram model from labelled text and writes it
  as tables in long form: ``grams(gram, lang, gain)``, how much an n-gram speaks
  for a language (a row without a language marks that the n-gram is known), and
  ``languages(lang, prior, unseen, place)``, and the gains once more by blocks of
  languages, ``blocks``. Every n-gram that was seen is in the model; n-grams are never
  collected, languages (one row each) only where all are candidates.
  ``load_profiles`` opens a stored model, ``register_profiles`` makes SQL views of it.
* ``detect_language`` counts each text's words, scores every distinct word once
  (its n-grams joined with the model) and joins the word scores to the texts'
  word counts. ``detection_sql`` is the same as SQL text over the model's views.
  Joins carry no hints; AQE broadcasts or splits.

Scoring is multinomial naive Bayes with Laplace smoothing over the union of
the languages' n-grams; others carry no evidence. A text's candidates are the
languages that have seen one of its n-grams or more, or all (``every_language``). The confidence is a softmax
over the candidates' per-n-gram mean log likelihoods, rounded half-up to 4 digits
and stored as a 32-bit float. ``Unknown`` with 0.0 when a text has no known n-gram
(NULL, blank or too short).

``with_language`` runs any Python detector as an Arrow-batched pandas UDF returning
a struct, the reference's UDF surface: a detector of one text, or (``batch=True``)
one of a whole pandas Series, which need not loop over rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StringType, StructField, StructType

from strata.functions.strings import round_to_float
from strata.session import scratch_path, workers_can_import

DETECTION_SCHEMA = StructType([StructField("language", StringType(), False),
                               StructField("confidence", FloatType(), False)])
UNKNOWN = "Unknown"
SLOTS = 4  # languages whose gains stand in one row


def normalized(c: Column) -> Column:
    """Lower case; runs of non-letters become one space; no outer spaces."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}]+", " "))


def word_ngrams(word: Column, n: int = 3) -> Column:
    """Character n-grams of one word padded with a space on each side.

    Applied to an exploded word column, so the n-gram lambda only ever reads
    a short word: the text itself is normalized once per row.
    """
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    count = F.length(word) + F.lit(3 - n)
    grams = F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(padded, i, n))
    return F.when((word != "") & (count >= 1), grams).otherwise(F.array().cast("array<string>"))


def text_ngrams(df: DataFrame, keys: list[str], text_col: str, n: int = 3,
                outer: bool = False) -> DataFrame:
    """``keys + [gram]``: one row per n-gram of every word of the text. With
    ``outer=True`` a text without any n-gram keeps one row with a NULL gram."""
    explode = F.explode_outer if outer else F.explode
    words = df.select(*keys, explode(F.split(normalized(F.col(text_col)), " ")).alias("_w"))
    return words.select(*keys, explode(word_ngrams(F.col("_w"), n)).alias("gram"))


@dataclass
class LanguageModel:
    grams: DataFrame      # gram, lang (NULL: the gram is known), gain
    languages: DataFrame  # lang, prior, unseen, place (from 0; NULL: without n-grams)
    blocks: DataFrame     # gram, block of languages, g0.. (their gains), known (1 once a gram)
    n: int


def fit_profiles(labelled: DataFrame, text_col: str, label_col: str, n: int = 3,
                 alpha: float = 1.0, path: str | None = None) -> LanguageModel:
    """Learn per-language n-gram profiles from labelled text and store them in
    ``path`` (default: the scratch folder).

    The vocabulary is every n-gram seen; each language gets Laplace-smoothed log
    probabilities over it. A seen n-gram gains ``ln(1 + count / alpha)`` over an
    unseen one, whatever the language, so the two tables need no join.
    """
    spark = labelled.sparkSession
    path = path or scratch_path(spark, "language-model")
    docs = labelled.select(F.col(label_col).alias("lang"), F.col(text_col).alias("t")) \
        .where(F.col("lang").isNotNull())
    # Count words first (partial aggregate: texts repeat their words), then
    # spread each distinct word's count over its n-grams.
    words = (docs.select("lang", F.explode(F.split(normalized(F.col("t")), " ")).alias("_w"))
             .where(F.col("_w") != "")
             .groupBy("lang", "_w").agg(F.count(F.lit(1)).alias("_wc")))
    counts = (words.select("lang", "_wc", F.explode(word_ngrams(F.col("_w"), n)).alias("gram"))
              .groupBy("lang", "gram").agg(F.sum("_wc").alias("c")))
    counts.write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    known = counts.select("gram", F.lit(None).cast("string").alias("lang"),
                          F.lit(0.0).alias("gain")).distinct()
    counts.select("gram", F.col("lang").cast("string").alias("lang"),
                  F.log1p(F.col("c") / F.lit(float(alpha))).alias("gain")) \
        .unionByName(known).write.parquet(f"{path}/grams")
    size = counts.select(F.countDistinct("gram")).scalar()
    per_lang = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    all_docs = per_lang.select(F.sum("docs")).scalar()
    # One row a language goes through the window.
    totals = counts.groupBy("lang").agg(F.sum("c").alias("total")).withColumn(
        "place", F.row_number().over(Window.orderBy("lang")) - 1)
    (per_lang.join(totals, "lang", "left")
     .select(F.col("lang").cast("string").alias("lang"), F.log(F.col("docs") / all_docs).alias("prior"),
             F.log(F.lit(float(alpha)) / (F.coalesce("total", F.lit(0)) + F.lit(float(alpha)) * size))
             .alias("unseen"), "place")
     .write.parquet(f"{path}/languages"))
    places = spark.read.parquet(f"{path}/languages").select("lang", "place")
    placed = spark.read.parquet(f"{path}/grams").join(places, "lang").select(
        "gram", F.floor(F.col("place") / SLOTS).cast("int").alias("block"),
        (F.col("place") % SLOTS).alias("slot"), "gain")
    firsts = placed.groupBy("gram").agg(F.min("block").alias("block"), F.lit(1).alias("known"))
    (placed.groupBy("gram", "block").agg(*[
        F.sum(F.when(F.col("slot") == i, F.col("gain")).otherwise(0.0)).alias(f"g{i}")
        for i in range(SLOTS)])
     .join(firsts, ["gram", "block"], "left").fillna(0, ["known"]).write.parquet(f"{path}/blocks"))
    spark.range(1).select(F.lit(n).alias("n")).write.parquet(f"{path}/settings")
    return load_profiles(spark, path)


def load_profiles(spark: SparkSession, path: str) -> LanguageModel:
    """The model stored in ``path``."""
    return LanguageModel(spark.read.parquet(f"{path}/grams"),
                         spark.read.parquet(f"{path}/languages"),
                         spark.read.parquet(f"{path}/blocks"),
                         spark.read.parquet(f"{path}/settings").first()["n"])


def register_profiles(model: LanguageModel, name: str) -> str:
    """Temporary views ``{name}_grams``, ``{name}_blocks`` and ``{name}_languages`` for SQL."""
    model.grams.createOrReplaceTempView(f"{name}_grams")
    model.blocks.createOrReplaceTempView(f"{name}_blocks")
    model.languages.createOrReplaceTempView(f"{name}_languages")
    return name


def detect_language(model: LanguageModel, df: DataFrame, id_col: str, text_col: str,
                    every_language: bool = False) -> DataFrame:
    """``(id, language, confidence)`` for every row of ``df`` (ids unique). With
    ``every_language`` all languages of the model are a text's candidates, also
    those that have seen none of its n-grams."""
    words = (df.select(F.col(id_col).alias("_id"),
                       F.explode_outer(F.split(normalized(F.col(text_col)), " ")).alias("_w"))
             .groupBy("_id", "_w").agg(F.count(F.lit(1)).alias("_k")))
    gains = [f"g{i}" for i in range(SLOTS)]
    known = (words.select("_w").distinct()
             .select("_w", F.explode(word_ngrams(F.col("_w"), model.n)).alias("gram"))
             .join(model.blocks, "gram").groupBy("_w", "block")
             .agg(*[F.sum(g).alias(g) for g in gains], F.sum("known").alias("_g")))
    # A row per text and block of languages; a language that has seen nothing gains 0.
    heard = (words.join(known, "_w", "left").groupBy("_id", "block")
             .agg(*[F.sum(F.col("_k") * F.col(g)).alias(g) for g in gains],
                  F.sum(F.col("_k") * F.col("_g")).alias("_n")))
    per_lang = (heard.select("_id", "_n", "block", F.posexplode_outer(F.array(*gains)).alias("_at", "_gain"))
                .where((F.col("_at") == 0) | (F.col("_gain") > 0))
                .select("_id", "_gain", F.when(F.col("_at") == 0, F.col("_n")).alias("_n"),
                        (F.col("block") * SLOTS + F.col("_at")).alias("place"))
                .join(model.languages.select("place", "lang", "prior", "unseen"), "place", "left"))
    candidate = F.when(F.col("_gain") > 0, F.struct("lang", "prior", "unseen", "_gain"))
    texts = per_lang.groupBy("_id").agg(F.sum("_n").cast("double").alias("_n"),
                                        F.collect_list(candidate).alias("_of"))

    def loss(c: Column, gain: Column) -> Column:
        return -(c["prior"] + F.col("_n") * c["unseen"] + gain)

    every = F.array().cast("array<struct<lang:string,prior:double,unseen:double>>")
    if every_language:  # one row a language, in every task
        spoken = model.languages.where(F.col("place").isNotNull())
        every = spoken.select(F.sort_array(F.collect_list(F.struct("lang", "prior", "unseen")))).scalar()
    # A heard language's loss without its gain is larger than its own: never the best.
    losses = F.concat(
        F.transform("_of", lambda c: F.struct(loss(c, c["_gain"]).alias("loss"), c["lang"].alias("lang"))),
        F.transform("_every", lambda c: F.struct(loss(c, F.lit(0.0)).alias("loss"), c["lang"].alias("lang"))))
    scored = (texts.withColumn("_every", F.when(F.size("_of") > 0, every))
              .withColumn("_best", F.when(F.size("_of") > 0, F.array_min(losses))))
    weight = lambda c, gain: F.exp((F.col("_best.loss") - loss(c, gain)) / F.col("_n"))
    mass = F.aggregate("_every", F.lit(0.0), lambda total, c: total + weight(c, F.lit(0.0)))
    mass = F.aggregate("_of", mass, lambda total, c: total + weight(c, c["_gain"]) - (
        weight(c, F.lit(0.0)) if every_language else F.lit(0.0)))
    known = F.size("_of") > 0
    return scored.select(
        F.col("_id").alias(id_col),
        F.when(known, F.col("_best.lang")).otherwise(F.lit(UNKNOWN)).alias("language"),
        F.when(known, round_to_float(F.lit(1.0) / mass, 4))
        .otherwise(F.lit(0.0).cast(FloatType())).alias("confidence"))


WORDS_SQL = """
  SELECT {key} AS id, w, count(*) AS k
  FROM {source} LATERAL VIEW OUTER explode(split(lower({text}), '[^\\\\p{{L}}]+')) AS w
  GROUP BY {key}, w"""

DETECTION_SQL = """
WITH word AS ({words}),
piece AS (
  SELECT w, explode(transform(sequence(1, length(w) + 3 - {n}),
                              i -> substring(concat(' ', w, ' '), i, {n}))) AS gram
  FROM (SELECT DISTINCT w FROM word WHERE length(w) >= greatest(1, {n} - 2))),
known AS (
  SELECT w, block, {known}, sum(known) AS g
  FROM piece JOIN {model}_blocks USING (gram) GROUP BY w, block),
heard AS (
  SELECT id, block, {heard}, sum(k * g) AS n
  FROM word LEFT JOIN known USING (w) GROUP BY id, block),
gained AS (
  SELECT id, CASE WHEN at = 0 THEN n END AS n, gain, block * {slots} + at AS place
  FROM heard LATERAL VIEW OUTER posexplode(array({gains})) AS at, gain
  WHERE at = 0 OR gain > 0),
size AS (
  SELECT id, CAST(sum(n) AS DOUBLE) AS n,
         collect_list(CASE WHEN gain > 0 THEN struct(lang, prior, unseen, gain) END) AS spoken
  FROM gained LEFT JOIN {model}_languages USING (place) GROUP BY id),
score AS (
  SELECT id, n, transform(spoken, c -> struct(-(c.prior + n * c.unseen + c.gain) AS loss, c.lang))
         AS losses FROM size),
best AS (SELECT *, array_min(losses) AS best FROM score)
SELECT id AS {key}, coalesce(best.lang, 'Unknown') AS language,
       CAST(round(CASE WHEN best IS NULL THEN 0D ELSE
                  1 / aggregate(losses, 0D, (m, c) -> m + exp((best.loss - c.loss) / n)) END, 4)
            AS FLOAT) AS confidence
FROM best
"""


def _identifiers(*names: str) -> None:
    for name in names:
        if not name.replace("_", "").isalnum():
            raise ValueError(f"bad identifier {name!r}")


def words_sql(source: str, key: str, text: str) -> str:
    """``(id, w, k)``: how often each text of the table ``source`` has each of its words."""
    _identifiers(source, key, text)
    return WORDS_SQL.format(source=source, key=key, text=text)


def detection_sql(model: LanguageModel, registered: str, source: str, key: str, text: str,
                  words: str | None = None) -> str:
    """``detect_language`` as Spark SQL text: ``(key, language, confidence)`` for
    every row of the table ``source`` (keys unique), by the model whose views
    ``register_profiles`` made. The word counts are read twice: ``words`` may name a
    stored table of what ``words_sql`` gives."""
    _identifiers(registered, source, key, text, *([words] if words else []))
    counts = f"SELECT id, w, k FROM {words}" if words else words_sql(source, key, text)
    gains = [f"g{i}" for i in range(SLOTS)]
    return DETECTION_SQL.format(
        words=counts, key=key, n=model.n, model=registered, slots=SLOTS, gains=", ".join(gains),
        known=", ".join(f"sum({g}) AS {g}" for g in gains),
        heard=", ".join(f"sum(k * {g}) AS {g}" for g in gains))


def add_language(model: LanguageModel, df: DataFrame, id_col: str, text_col: str,
                 every_language: bool = False) -> DataFrame:
    """``df`` with all its columns plus ``language`` and ``confidence`` (ids unique).
    Rows without text are ``Unknown`` and take no part in the detection."""
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), text_col)
    found = detect_language(model, texts, "_id", text_col, every_language)
    return (df.join(found, df[id_col].eqNullSafe(found["_id"]), "left")
            .select(*[df[c] for c in df.columns],
                    F.coalesce("language", F.lit(UNKNOWN)).alias("language"),
                    F.coalesce("confidence", F.lit(0.0).cast(FloatType())).alias("confidence")))


# The stop words of an example detector, by language code (our own lists).
STOP_WORDS = {
    "de": ("der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "auf", "für",
           "ist", "nicht", "dem", "ein"),
    "en": ("the", "of", "and", "to", "a", "is", "that", "for", "it", "was", "on", "with",
           "be", "as", "by"),
    "es": ("el", "y", "los", "se", "del", "las", "por", "no", "con", "su", "una", "es",
           "para", "al", "que"),
    "fr": ("le", "et", "les", "des", "un", "du", "une", "est", "qui", "dans", "pour", "par",
           "pas", "au", "sur"),
}


def stopword_language(texts: pd.Series) -> pd.DataFrame:
    """An example of a batch detector: the language with most stop-word hits (ties:
    first code in alphabetical order); confidence = its share of all hits, cut to 4
    decimals; ``Unknown`` with 0.0 without any hit. Works on the whole batch."""
    listed = {word: lang for lang, words in STOP_WORDS.items() for word in words}
    if len(listed) != sum(map(len, STOP_WORDS.values())):
        raise ValueError("a stop word of two languages")
    langs = sorted(STOP_WORDS)
    tokens = pa.array(texts, pa.large_string(), from_pandas=True)
    pieces = pc.split_pattern_regex(pc.utf8_lower(tokens), "[ \\t\\n]+")
    row = pc.list_parent_indices(pieces).to_numpy()
    at = pc.index_in(pc.list_flatten(pieces), pa.array(list(listed), pa.large_string()))
    hit = at.is_valid().to_numpy(zero_copy_only=False)
    lang = np.array([langs.index(code) for code in listed.values()])[
        pc.fill_null(at, 0).to_numpy(zero_copy_only=False)[hit]]
    hits = np.bincount(row[hit] * len(langs) + lang, minlength=len(texts) * len(langs)).reshape(
        len(texts), len(langs))
    total, best = hits.sum(1), hits.argmax(1)
    share = (10000 * hits.max(1, initial=0) // np.maximum(total, 1)) / 10000
    return pd.DataFrame({"language": np.where(total > 0, np.array(langs, object)[best], UNKNOWN),
                         "confidence": np.where(total > 0, share, 0.0)})


def language_udf(detector: Callable, batch: bool = False):
    """A Python detector as an Arrow-batched pandas UDF returning
    ``struct<language, confidence>``: ``text -> (language, confidence)``, or with
    ``batch`` ``Series -> DataFrame(language, confidence)``."""
    active = SparkSession.getActiveSession()
    if active is not None:
        workers_can_import(active)

    @F.pandas_udf(DETECTION_SCHEMA)
    def detect(texts: pd.Series) -> pd.DataFrame:
        if batch:
            return detector(texts).astype({"confidence": "float64"})
        pairs = [detector(None if t is None or (isinstance(t, float) and math.isnan(t)) else t)
                 for t in texts]
        return pd.DataFrame({"language": [p[0] for p in pairs],
                             "confidence": [float(p[1]) for p in pairs]})

    return detect


def with_language(df: DataFrame, text_col: str, detector: Callable, out_col: str = "detection",
                  expand: bool = True, batch: bool = False) -> DataFrame:
    """Apply a Python detector through ``language_udf``; ``expand`` spreads
    the struct into ``language`` and ``confidence`` columns."""
    out = df.withColumn(out_col, language_udf(detector, batch)(F.col(text_col)))
    if not expand:
        return out
    keep = [c for c in out.columns if c != out_col]
    return out.select(*keep, F.col(f"{out_col}.language").alias("language"),
                      F.col(f"{out_col}.confidence").alias("confidence"))
