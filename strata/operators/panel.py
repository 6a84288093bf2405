"""Entity-period panels (B1), "steady in every period" filters (B2) and the
citation table (B3).

Plan notes for scale:

* The reference builds the panel as (venues x years) joined to every hosted
  work of the venue, which multiplies the host table by the number of years.
  Here the counts come from one ``host ⋈ works`` join on the work id and a
  distinct count per (entity, period); the zero rows come from a grid of the
  hosting entities and the period list.
* The grid is made with ``explode`` over the period array (a Generate on each
  entity row; the array is a scalar subquery), never a cross join.
* In the citation table the hot key of ``papers ⟕ references`` may sit on
  the right side, where AQE cannot split a left join; an inner join and the papers
  that cite nothing give the same rows. The last left join (to the cited work) has its
  hot key, a much-cited work, on the left side, which AQE splits.
* ``count(distinct)`` runs as Spark's two-level aggregate where the join left its
  rows, by work, so one hot entity spreads over many tasks; a shuffle carries only
  partial counts. The join has a task per million hosted works: what a task holds
  does not grow with the table (packed well, a partition of a size in bytes would
  hold many more rows).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.language import (
    LanguageModel, detection_sql, register_profiles, words_sql,
)
from strata.session import shuffles_removed
from strata.sources.scratch import RunScratch

TASK_ROWS = 1_000_000  # hosted works of one task


def period_table(spark: SparkSession, periods, column: str = "year") -> DataFrame:
    """The distinct non-NULL periods as a one-column table: from a list, or a
    DataFrame column."""
    if isinstance(periods, DataFrame):
        return periods.select(F.col(column)).where(F.col(column).isNotNull()).distinct()
    values = sorted({p for p in periods if p is not None})
    if not values:
        return spark.range(0).select(F.col("id").alias(column))
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(column))


def explode_periods(df: DataFrame, periods, column: str = "year") -> DataFrame:
    """Every row of ``df`` once per period: a Generate over the sorted period
    array, which is a scalar subquery of the period table."""
    table = period_table(df.sparkSession, periods, column)
    values = table.agg(F.sort_array(F.collect_set(column)))
    return df.withColumn(column, F.explode(values.scalar()))


def entity_period_counts(entities: DataFrame, host: DataFrame, works: DataFrame, periods,
                         entity: str = "venue_id", work: str = "work_id",
                         work_period: str = "publication_year", period: str = "year",
                         count_col: str = "counts", sort: bool = True) -> DataFrame:
    """Distinct works per (entity, period) for entities that host at least one
    work, with 0 for periods without any (B1).

    ``entities(entity)``, ``host(entity, work)``, ``works(work, work_period)``.
    Hosted works missing from ``works`` and works outside the period list count
    for nothing, as in the reference's left join.
    """
    values = period_table(host.sparkSession, periods, period)
    hosted = host.select(entity, work)
    dated = works.select(F.col(work), F.col(work_period).alias(period)).join(
        values, period, "left_semi")
    parts = max(1, -(-host.count() // TASK_ROWS))  # of a stored table: from its footers
    counted = (hosted.repartition(parts, work).join(dated.repartition(parts, work), work, "inner")
               .groupBy(entity, period)
               .agg(F.countDistinct(work).alias(count_col)))
    hosting = hosted.select(entity).distinct()
    grid = explode_periods(
        entities.select(entity).distinct().join(hosting, entity, "inner"), values, period)
    panel = (grid.join(counted, [entity, period], "left")
             .select(entity, period, F.coalesce(F.col(count_col), F.lit(0)).cast("bigint")
                     .alias(count_col)))
    return panel.orderBy(entity, period) if sort else panel


def steady_entities(panel: DataFrame, threshold: int, entity: str = "venue_id",
                    count_col: str = "counts") -> DataFrame:
    """Entities whose count is above ``threshold`` in every period (B2:
    ``group by entity having min(counts) > threshold``)."""
    return (panel.groupBy(entity).agg(F.min(count_col).alias("_min"))
            .where(F.col("_min") > threshold).select(entity))


def steady_entity_periods(panel: DataFrame, periods, threshold: int,
                          entity: str = "venue_id", period: str = "year",
                          count_col: str = "counts") -> DataFrame:
    """Steady entities with every period attached (the table B2 writes)."""
    return explode_periods(steady_entities(panel, threshold, entity, count_col), periods, period)


def citation_table(steady_periods: DataFrame, host: DataFrame, works: DataFrame,
                   references: DataFrame,
                   detect: Callable[[DataFrame], DataFrame] | None = None,
                   cited_works: DataFrame | None = None,
                   entity: str = "venue_id", period: str = "year",
                   work: str = "work_id", referenced: str = "referenced_work_id",
                   work_id: str = "id", work_period: str = "publication_year") -> DataFrame:
    """Papers of steady venues in their steady years, each with every work
    it cites (or one NULL row), and the cited work's title and language.

    ``works(id, publication_year, title[, language, confidence])``. With
    ``detect`` (a DataFrame -> DataFrame step adding ``language`` and
    ``confidence``) the detector runs only on works that are cited somewhere,
    once per work; otherwise ``works`` must already carry the two columns.
    Either way the citing side reads no detection column. ``cited_works``
    (default ``works``) supplies the cited side's titles, so the citing side
    need not carry a title join it never reads.
    """
    spark = works.sparkSession
    cited_works = works if cited_works is None else cited_works
    refs = references.select(F.col(work).alias("_ref_src"), F.col(referenced))
    # Parts that a later one reads are stored in columns, and the shuffle files of each go
    # before the next: the disk holds the largest step, not the sum of all.
    with RunScratch(spark, "citations") as run:
        with shuffles_removed(spark):
            steady = run.store(steady_periods.select(entity, period), "steady")
            # One row a work on either side, so no hot key: whether it cites at all.
            sources = refs.select("_ref_src").distinct()
            citing = run.store(
                works.join(sources, F.col(work_id) == F.col("_ref_src"), "left").select(
                    F.col(work_id).alias("_citing"), F.col(work_period).alias("_citing_period"),
                    F.col("_ref_src").isNotNull().alias("_cites")), "citing-works")
            # The hosted works get their period first: joined by entity alone, each would
            # come once per period of its entity.
            dated = host.select(entity, work).join(citing, F.col(work) == F.col("_citing"))
            papers = run.store(steady.join(dated, entity).where(
                F.col(period) == F.col("_citing_period")).select(
                entity, period, "_citing", "_cites"), "citing-papers")
            if detect is not None:
                found = detect(run.store(cited_only(cited_works, references, work_id, referenced),
                                         "cited-works"))
                cited_works = run.store(found.select(work_id, "title", "language", "confidence"),
                                        "cited-languages")
        run.keep("citing-papers")
        run.keep("cited-languages")
    cited = cited_works.select(F.col(work_id).alias("_cited"), "title", "language", "confidence")
    # One paper may cite a great deal: an inner join, which AQE splits on both
    # sides. Papers that cite nothing need no join for titles at all.
    citing_some = (papers.where("_cites").join(refs, F.col("_citing") == F.col("_ref_src"), "inner")
                   .join(cited, F.col(referenced) == F.col("_cited"), "left"))
    types = {f.name: f.dataType for f in (*refs.schema, *cited.schema)}
    rest = [referenced, "title", "language", "confidence"]
    return (citing_some.select(entity, period, F.col("_citing").alias(work_id), *rest)
            .unionByName(papers.where(~F.col("_cites")).select(
                entity, period, F.col("_citing").alias(work_id),
                *[F.lit(None).cast(types[c]).alias(c) for c in rest])))


def cited_only(works: DataFrame, references: DataFrame, work_id: str = "id",
               referenced: str = "referenced_work_id") -> DataFrame:
    """The works that some reference points at: run a costly detector on
    these only, not on every work."""
    targets = references.select(F.col(referenced).alias(work_id)).distinct()
    return works.join(targets, work_id, "left_semi")


# The works that some reference points at, the papers of steady venues (and whether they
# cite: the counts have one row a work, so no hot key), and the citation table over them.
CITED_SQL = "SELECT id, title FROM {works} LEFT SEMI JOIN {refs} ON id = referenced_work_id"
PAPERS_SQL = """
WITH citing AS (SELECT work_id, count(*) AS n FROM {refs} GROUP BY work_id)
SELECT venue_id, year, w.id, c.n IS NOT NULL AS cites
FROM {works} w JOIN {host} h ON h.work_id = w.id LEFT JOIN citing c ON c.work_id = w.id
     JOIN {steady} s USING (venue_id)
WHERE w.publication_year = s.year
"""
TARGET_SQL = "SELECT id, title, language, confidence FROM {cited} JOIN {detected} USING (id)"
CITATION_SQL = """
SELECT p.venue_id, p.year, p.id, r.referenced_work_id, t.title, t.language, t.confidence
FROM {papers} p JOIN {refs} r ON r.work_id = p.id
     LEFT JOIN {target} t ON t.id = r.referenced_work_id
UNION ALL
SELECT venue_id, year, id, NULL, NULL, NULL, NULL FROM {papers} WHERE NOT cites
"""


def citation_table_sql(spark, steady: str, host: str, works: str, refs: str,
                       model: LanguageModel) -> DataFrame:
    """B3 as SQL text over registered views (the reference's SQL entry point): the
    stored language model and the works' languages are views too, so that no Python
    runs. As in the DataFrame form, detection sees only works some reference cites (a
    semi join) and never the citing side. What several steps read (the cited works, their
    word counts, the papers, the cited works with languages) is stored in columns, so that
    each text is taken apart once; the result reads ``refs``, the papers and the languages."""
    for name in (steady, host, works, refs):
        if not name.replace("_", "").isalnum():
            raise ValueError(f"bad identifier {name!r}")
    views = {"steady": steady, "host": host, "works": works, "refs": refs}
    with RunScratch(spark, "citations-sql") as run:
        def view(part: str, query: str) -> str:
            """The rows of ``query`` written once, as a view: SQL runs a subquery anew for
            every place that reads it."""
            run.store(spark.sql(query), part).createOrReplaceTempView(f"{works}_{part}")
            return f"{works}_{part}"

        with shuffles_removed(spark):  # of each step before the next
            cited = view("cited", CITED_SQL.format(**views))
            papers = view("papers", PAPERS_SQL.format(**views))
            words = view("words", words_sql(cited, "id", "title"))
            registered, detected = register_profiles(model, f"{works}_model"), f"{works}_detected"
            spark.sql(detection_sql(model, registered, cited, "id", "title", words)) \
                .createOrReplaceTempView(detected)
            target = view("target", TARGET_SQL.format(cited=cited, detected=detected))
        run.keep("papers")
        run.keep("target")
    for gone in (cited, words, detected):
        spark.catalog.dropTempView(gone)
    return spark.sql(CITATION_SQL.format(papers=papers, target=target, **views))
