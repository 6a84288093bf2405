from strata.operators.panel import (
    citation_table, entity_period_counts, explode_periods, period_table, steady_entity_periods,
)


def _inputs(spark):
    venues = spark.createDataFrame([(1,), (2,), (3,), (9,)], "venue_id long")
    host = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 10), (3, 99), (1, 10)],
                                 "venue_id long, work_id long")
    works = spark.createDataFrame([(10, 2000), (11, 2000), (12, 2001), (13, 2001)],
                                  "work_id long, publication_year int")
    return venues, host, works


def test_panel_counts_with_zeros(spark):
    venues, host, works = _inputs(spark)
    years = spark.createDataFrame([(2000,), (2001,)], "year int")
    rows = [tuple(r) for r in entity_period_counts(venues, host, works, years).collect()]
    # Venue 9 hosts nothing and vanishes; venue 3 hosts an unknown work: zeros.
    assert rows == [(1, 2000, 2), (1, 2001, 1), (2, 2000, 1), (2, 2001, 0),
                    (3, 2000, 0), (3, 2001, 0)]


def test_steady_entities(spark):
    venues, host, works = _inputs(spark)
    counts = entity_period_counts(venues, host, works, [2000, 2001], sort=False)
    steady = sorted(tuple(r) for r in steady_entity_periods(counts, [2000, 2001], 0).collect())
    assert steady == [(1, 2000), (1, 2001)]
    assert steady_entity_periods(counts, [2000, 2001], 1).count() == 0


def test_period_values_and_explode(spark):
    years = spark.createDataFrame([(2001,), (2000,), (2001,), (None,)], "year int")
    assert sorted(r[0] for r in period_table(spark, years).collect()) == [2000, 2001]
    df = spark.createDataFrame([(1,)], "x int")
    assert sorted(r["year"] for r in explode_periods(df, [5, 6]).collect()) == [5, 6]


def test_citation_table(spark):
    steady = spark.createDataFrame([(1, 2000)], "venue_id long, year int")
    host = spark.createDataFrame([(1, 10), (1, 11), (1, 12)], "venue_id long, work_id long")
    works = spark.createDataFrame(
        [(10, 2000, "a", "en", 1.0), (11, 2000, "b", "fr", 0.5), (12, 2001, "c", "de", 1.0),
         (20, 1999, "z", "es", 0.25)],
        "id long, publication_year int, title string, language string, confidence float")
    refs = spark.createDataFrame([(10, 20), (10, 21)], "work_id long, referenced_work_id long")
    rows = sorted(tuple(r) for r in citation_table(steady, host, works, refs).collect())
    assert rows == [(1, 2000, 10, 20, "z", "es", 0.25), (1, 2000, 10, 21, None, None, None),
                    (1, 2000, 11, None, None, None, None)]


def test_left_join_hot_right_equals_left_join(spark):
    from strata.operators.joins import left_join_hot_right

    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (1, "c")], "k long, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 30)], "rk long, y long")
    got = sorted(map(tuple, left_join_hot_right(left, right, "k", "rk").collect()),
                 key=str)
    want = sorted(map(tuple, left.join(right, left.k == right.rk, "left").collect()), key=str)
    assert got == want


def test_tasks_of_the_count_follow_the_rows(spark, monkeypatch):
    """The distinct count runs in tasks of a bounded number of hosted works."""
    from strata.operators import panel

    monkeypatch.setattr(panel, "TASK_ROWS", 100)
    host = spark.range(2000).selectExpr("id % 7 AS venue_id", "id % 500 AS work_id")
    works = spark.range(500).selectExpr("id AS work_id", "int(1990 + id % 3) AS publication_year")
    venues = spark.range(9).selectExpr("id AS venue_id")
    out = panel.entity_period_counts(venues, host, works, [1990, 1991, 1992, 1993])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(work_id" in plan and ", 20), REPARTITION_BY_NUM" in plan
    want = {}
    for i in range(2000):
        want.setdefault((i % 7, 1990 + i % 500 % 3), set()).add(i % 500)
    got = {tuple(r)[:2]: r["counts"] for r in out.collect()}
    assert got == {(v, y): len(want.get((v, y), ())) for v in range(7) for y in range(1990, 1994)}


def test_citing_papers_are_stored_in_columns(spark):
    """The papers that both branches read are a columnar copy, not a row checkpoint."""
    _, host, works = _inputs(spark)
    steady = spark.createDataFrame([(1, 2000), (1, 2001)], "venue_id long, year int")
    refs = spark.createDataFrame([(10, 11), (10, 77)], "work_id long, referenced_work_id long")
    titled = works.selectExpr("work_id AS id", "publication_year", "'t' AS title", "'en' AS language",
                              "cast(1 AS float) AS confidence")
    out = citation_table(steady, host.distinct(), titled, refs)
    assert any("citing-papers" in f and f.endswith(".parquet") for f in out.inputFiles())
    assert sorted((r.venue_id, r.id, r.referenced_work_id, r.title) for r in out.collect() if r.id == 10) == \
        [(1, 10, 11, "t"), (1, 10, 77, None)]
    assert sorted(r.id for r in out.collect()) == [10, 10, 11, 12]


def test_sql_form_reads_its_inputs_once(spark, tmp_path):
    """The cited works, their word counts and the papers are stored: the citation table
    itself reads none of the works, hosts and steady venues again."""
    from strata.operators.language import fit_profiles
    from strata.operators.panel import citation_table_sql

    tables = {
        "steady": spark.sql("SELECT * FROM VALUES (1L, 2000), (1L, 2001) AS t(venue_id, year)"),
        "host": spark.sql("SELECT * FROM VALUES (1L, 10L), (1L, 11L), (1L, 12L), (2L, 10L) AS t(venue_id, work_id)"),
        "works": spark.sql("SELECT * FROM VALUES (10L, 2000, 'citing'), (11L, 2000, 'lumo lumo'), "
                           "(12L, 2001, NULL), (13L, 1999, '12 !!') AS t(id, publication_year, title)"),
        "refs": spark.sql("SELECT * FROM VALUES (10L, 11L), (10L, 11L), (10L, 12L), (10L, 13L), (10L, 77L), "
                          "(99L, 10L) AS t(work_id, referenced_work_id)")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        spark.read.parquet(f"{tmp_path}/{name}").createOrReplaceTempView(f"once_{name}")
    model = fit_profiles(spark.sql("SELECT * FROM VALUES ('x', 'lumo'), ('y', 'trak') AS t(lang, t)"), "t", "lang")
    out = citation_table_sql(spark, "once_steady", "once_host", "once_works", "once_refs", model)
    rows = sorted(map(tuple, out.collect()), key=str)
    assert rows == [
        (1, 2000, 10, 11, "lumo lumo", "x", 1.0), (1, 2000, 10, 11, "lumo lumo", "x", 1.0),
        (1, 2000, 10, 12, None, "Unknown", 0.0), (1, 2000, 10, 13, "12 !!", "Unknown", 0.0),
        (1, 2000, 10, 77, None, None, None), (1, 2000, 11, None, None, None, None),
        (1, 2001, 12, None, None, None, None)]
    read = {f.rsplit("/", 2)[-2] for f in out.inputFiles()}
    assert "refs" in read and not read & {"steady", "host", "works"}


def shuffle_files(spark) -> int:
    """Of the local session: files of shuffles on disk. They go in the background."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager() \
        .getAllBlocks().mkString(" ")
    return blocks.count("shuffle_")


def settles_at(spark, most: int) -> bool:
    import time

    for _ in range(100):
        if shuffle_files(spark) <= most:
            return True
        time.sleep(0.1)
    return False


def test_shuffle_files_go_with_a_write(spark, tmp_path):
    from strata.session import shuffles_removed

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(key, None), shuffle_files(spark)
    rows = spark.range(5000).selectExpr("id % 999 AS k").groupBy("k").count()
    with shuffles_removed(spark):
        rows.write.parquet(str(tmp_path / "a"))
    assert spark.conf.get(key, None) == before and settles_at(spark, files)
    assert spark.read.parquet(str(tmp_path / "a")).count() == rows.count() == 999


def test_citation_table_leaves_no_shuffles_of_its_steps(spark, capsys, monkeypatch):
    """The disk holds one step's shuffles, not all; venues and their works meet by year,
    not once per year of the venue; parts that only later parts read are gone."""
    from strata.session import checkpoint_dir
    from strata.sources.scratch import RunScratch, list_names

    plans, original = {}, RunScratch.store

    def recording(self, df, part, **options):
        capsys.readouterr()
        df.explain()
        plans[part] = capsys.readouterr().out
        return original(self, df, part, **options)

    monkeypatch.setattr(RunScratch, "store", recording)
    root = f"{checkpoint_dir(spark)}/strata-scratch"
    _, host, works = _inputs(spark)
    steady = spark.createDataFrame([(1, 2000), (1, 2001), (2, 2000), (2, 2000)], "venue_id long, year int")
    titled = works.selectExpr("work_id AS id", "publication_year", "'t' AS title")
    refs = spark.createDataFrame([(10, 11), (10, 77), (None, 12), (12, None)],
                                 "work_id long, referenced_work_id long")
    before, files = set(list_names(spark, root)), shuffle_files(spark)
    out = citation_table(steady, host.distinct(), titled, refs,
                         detect=lambda df: df.selectExpr("*", "'en' AS language", "float(1) AS confidence"))
    assert settles_at(spark, files)
    kept = [list_names(spark, f"{root}/{name}") for name in set(list_names(spark, root)) - before]
    assert kept == [["cited-languages", "citing-papers"]]
    join = next(line for line in plans["citing-papers"].splitlines() if "venue_id" in line and "Join" in line)
    assert "year" in join and "_citing_period" in join
    none = (None, None, None, None)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        (1, 2000, 10, 11, "t", "en", 1.0), (1, 2000, 10, 77, None, None, None), (1, 2000, 11, *none),
        (1, 2001, 12, *none), *2 * [(2, 2000, 10, 11, "t", "en", 1.0)],
        *2 * [(2, 2000, 10, 77, None, None, None)]], key=str)
