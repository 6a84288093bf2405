"""The general fold, published tables, the merge in place, long texts in pieces, and
scratch data that goes with its run."""

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import links, merge_store, text
from strata.operators.fold import fold_by
from strata.operators.merge import merge_upsert
from strata.sources import published
from strata.sources.scratch import RunScratch, list_names


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- fold_by

@pytest.mark.parametrize(("held", "salts"), [(50_000, 16), (2, 1), (3, 4)])
def test_fold_any_state(spark, held, salts):
    rng = random.Random(held)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([1, 2, None]),
             rng.randrange(100)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, j int, v long").repartition(7)
    got = fold_by(df, ["k", "j"], ["v"], create=lambda v: {v}, merge=lambda s, v: s | {v},
                  combine=lambda a, b: a | b, finish=lambda s: sorted(s), result_type="array<bigint>",
                  name="seen", held=held, salts=salts)
    want = defaultdict(set)
    for k, j, v in rows:
        want[k, j].add(v)
    assert got.columns == ["k", "j", "seen"]
    assert {(r["k"], r["j"]): r["seen"] for r in got.collect()} == {k: sorted(s) for k, s in want.items()}


def test_fold_partial_states_before_the_shuffle(spark):
    """A hot key reaches the shuffles as one state per task, not as its rows."""
    df = spark.range(0, 10_000, 1, 4).selectExpr("0 AS k", "id AS v")
    calls = spark.sparkContext.accumulator(0)

    def combine(a, b):
        calls.add(1)
        return a + b

    got = fold_by(df, "k", ["v"], create=lambda v: v, merge=lambda s, v: s + v, combine=combine,
                  result_type="bigint", name="total")
    assert [tuple(r) for r in got.collect()] == [(0, sum(range(10_000)))]
    assert calls.value == 3


def test_fold_odd_keys_and_nothing(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("nan"), 2), (None, 3), (0.0, 4)],
                               "k double, v int").repartition(3)
    got = fold_by(df, "k", ["v"], create=lambda v: v, merge=lambda s, v: s + v,
                  combine=lambda a, b: a + b, result_type="int")
    assert sorted((str(r["k"]), r["value"]) for r in got.collect()) == [("0.0", 4), ("None", 3), ("nan", 3)]
    assert fold_by(df.where("v > 9"), "k", ["v"], create=lambda v: v, merge=lambda s, v: s,
                   combine=lambda a, b: a, result_type="int").count() == 0


# --- published tables

def test_publish_replaces_and_keeps_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path)
    assert published.publish(spark.range(5), path).rows == 5
    own = published.read_published(spark, path)
    assert published.publish(own.where("id > 2"), path).number == 2  # it may read itself
    assert rows_of(published.read_published(spark, path)) == [(3,), (4,)]
    assert published.read_published(spark, path, 1).count() == 5
    removed = published.vacuum(spark, path, keep=1)
    assert len(removed) == 1 and [v.number for v in published.versions(spark, path)] == [2]
    assert published.read_published(spark, path).count() == 2


def test_a_job_killed_half_way_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(spark.range(5), path)

    def fails(batches):
        for batch in batches:
            yield batch
        raise RuntimeError("killed")

    half = spark.range(0, 1000, 1, 4).mapInArrow(fails, "id long")
    with pytest.raises(Exception, match="killed"):
        published.publish(half, path)
    assert published.read_published(spark, path).count() == 5
    assert [v.number for v in published.versions(spark, path)] == [1]
    assert published.vacuum(spark, path, older_than=3600) == []  # it may still be written
    published.vacuum(spark, path, older_than=0)
    assert len(list_names(spark, f"{path}/_versions")) == 1
    assert published.publish(spark.range(7), path).number == 2


def test_two_writers_of_one_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    published.publish(spark.range(5), path)
    seen = published.versions(spark, path)
    published.publish(spark.range(6), path)
    monkeypatch.setattr(published, "versions", lambda *a: seen)
    with pytest.raises(FileExistsError):
        published.publish(spark.range(9), path)
    monkeypatch.undo()
    assert published.read_published(spark, path).count() == 6


# --- the merge in place

DELTA = "id string, name string, n string"


@pytest.fixture
def store(spark, tmp_path):
    base = spark.createDataFrame([*[(i, f"b{i}", i) for i in range(200)], (None, "none", 1)],
                                 "id long, name string, n long")
    table = f"store_{tmp_path.name.replace('-', '_')}"
    merge_store.create_store(base, table, str(tmp_path / "store"), "id", parts=8, buckets=4)
    yield table, base, tmp_path / "store"
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_merge_in_place_equals_merge(spark, store):
    table, base, _ = store
    first = spark.createDataFrame([("3", None, "30"), ("500", "new", None), (None, "x", "2")], DELTA)
    second = spark.createDataFrame([("3", "again", None), ("7", "seven", "70")], DELTA)
    want = merge_upsert(merge_upsert(base, first, "id"), second, "id")
    merge_store.merge_into_store(spark, table, first, "id", parts=8)
    merge_store.merge_into_store(spark, table, second, "id", parts=8)
    got = merge_store.read_store(spark, table)
    assert got.schema == base.schema and rows_of(got) == rows_of(want)


def test_small_delta_rewrites_its_partitions_only(spark, store):
    table, _, folder = store
    files = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    touched = merge_store.merge_into_store(
        spark, table, spark.createDataFrame([("3", "x", None)], DELTA), "id", parts=8)
    assert len(touched) == 1
    now = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    for path in files.keys() | now.keys():
        own = f"_part={touched[0]}" in str(path)
        assert own or files.get(path) == now.get(path)
    assert not any(p in now for p in files if f"_part={touched[0]}" in str(p))
    empty = spark.createDataFrame([], DELTA)
    assert merge_store.merge_into_store(spark, table, empty, "id", parts=8) == []


def test_the_base_does_not_move(spark, store):
    table, _, _ = store
    delta = spark.createDataFrame([(3, "x", 1)], "id long, name string, n long")
    merged = merge_store.merged_parts(spark, table, delta, ["id"], 8, [0, 1])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the delta's
    assert "PartitionFilters: [_part" in plan.replace("cast(", "") or "_part#" in plan


def test_repeated_key_raises(spark, store):
    table, _, _ = store
    twice = spark.createDataFrame([("3", "x", "1"), ("3", "y", "2")], DELTA)
    with pytest.raises(ValueError, match="dedupe_by"):
        merge_store.merge_into_store(spark, table, twice, "id", parts=8)
    merge_store.merge_into_store(spark, table, twice, "id", parts=8, dedupe_by="n")
    assert merge_store.read_store(spark, table).where("id = 3").first()["name"] == "y"


# --- long texts in pieces

@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab  \nc", max_size=60), min_size=1, max_size=4),
       st.integers(min_value=1, max_value=20))
def test_pieces_count_as_the_whole(spark, texts, size):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pieces = text.spread_texts(df, "t", piece_bytes=size)
    got = {r["word"]: r["n"] for r in text.word_count(text.lines_of(pieces, "value"), sort=False).collect()}
    lines = {r["word"]: r["n"] for r in text.word_count(text.lines_of(df, "t"), sort=False).collect()}
    assert got == lines


def test_a_huge_text_counts_in_many_tasks(spark):
    unit = "the quick brown fox\njumps over été\n"
    df = spark.range(1).select(F.repeat(F.lit(unit), 500_000).alias("t"))  # 20 MB
    pieces = text.spread_texts(df, "t", piece_bytes=1 << 20)
    held = pieces.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(held) > 4 and sum(r["count"] for r in held) > 15
    got = {r["word"]: r["n"] for r in text.word_count(text.lines_of(pieces, "value")).collect()}
    assert got == {w: 500_000 for w in unit.split()}


def test_pieces_of_odd_texts(spark):
    df = spark.createDataFrame([(None,), ("",), ("x" * 100,), ("  \n" * 50,)], "t string")
    assert sorted(r["value"] for r in text.spread_texts(df, "t", piece_bytes=10).collect()) == \
        sorted(["", "x" * 100, "  \n" * 50])
    with pytest.raises(ValueError):
        text.spread_texts(df, "t", separators=("é",))


# --- scratch data

def test_scratch_goes_with_its_run(spark):
    with RunScratch(spark, "t") as run:
        run.store(spark.range(3), "a")
        kept = run.store(spark.range(4), "b")
        placed = run.place(spark.range(100), "c", 3, ["id"])
        assert placed.count() == 100
        run.keep("b")
    assert list_names(spark, run.root) == ["b"] and kept.count() == 4
    with pytest.raises(RuntimeError), RunScratch(spark, "t") as run:
        run.store(spark.range(3), "a")
        run.keep("a")
        raise RuntimeError
    assert list_names(spark, run.root) == []


def test_pagerank_leaves_its_ranks_only(spark, monkeypatch):
    runs = []

    class Seen(RunScratch):
        def __init__(self, *a):
            super().__init__(*a)
            runs.append(self)

    monkeypatch.setattr(links, "RunScratch", Seen)
    before = spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    edges = spark.range(50).selectExpr("id AS src", "(id * 7) % 11 AS dst")
    tables = spark.catalog.listTables()
    ranks = links.pagerank(edges, 3)
    assert list_names(spark, runs[0].root) == ["round-2"]
    assert abs(ranks.agg(F.sum("pagerank")).first()[0] - ranks.count()) < 1e-6
    assert spark.catalog.listTables() == tables
    assert spark.conf.get("spark.sql.sources.bucketing.maxBuckets") == before


