"""Plan shapes: pushdown, pruning, broadcast of literal dimensions, no cross
joins, one Arrow UDF evaluation in the citation table."""

import re

import pytest

from strata.plans.queries import queries
from tests.conftest import SF_SMALL


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_filter_pushed_to_scan(spark, capsys):
    text = plan(queries()["filter_sort_desc"](spark, SF_SMALL), capsys)
    assert "PushedFilters: [IsNotNull(p_partkey), GreaterThan(p_partkey,50)]" in text


def test_scan_reads_only_needed_columns(spark, capsys):
    text = plan(queries()["mean_rating_fold"](spark, SF_SMALL), capsys)
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text


@pytest.mark.parametrize("name", ["venue_year_panel", "steady_venues", "citation_language",
                                  "merge_customers", "pagerank"])
def test_no_cross_join(spark, capsys, name):
    text = plan(queries()[name](spark, SF_SMALL), capsys)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_weekday_list_is_broadcast(spark, capsys):
    assert "BroadcastHashJoin" in plan(queries()["orders_by_weekday"](spark, SF_SMALL), capsys)


def test_citation_stays_in_the_jvm(spark, capsys):
    text = plan(queries()["citation_language"](spark, SF_SMALL), capsys)
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text


def test_python_detector_runs_once(spark, capsys):
    text = plan(queries()["language_udf"](spark, SF_SMALL), capsys)
    assert len(re.findall(r"^\(\d+\) ArrowEvalPython", text, flags=re.M)) == 1
    assert "BatchEvalPython" not in text


def test_merge_small_delta_never_shuffles_base(spark, capsys):
    text = plan(queries()["merge_customers"](spark, SF_SMALL), capsys)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_pagerank_round_never_moves_edges(spark, capsys, monkeypatch):
    """The per-round join reads the bucketed edge table directly: no exchange
    between the edge scan and the join."""
    from strata.operators.links import pagerank
    from strata.sources.scratch import RunScratch

    plans = []
    original = RunScratch.store

    def recording(self, df, part):
        capsys.readouterr()
        df.explain()
        plans.append(capsys.readouterr().out)
        return original(self, df, part)

    monkeypatch.setattr(RunScratch, "store", recording)
    edges = spark.createDataFrame([(i % 13, (i * 7) % 17) for i in range(300)],
                                  "src long, dst long")
    pagerank(edges, 2, partitions=4).collect()
    round_plans = [p for p in plans if "Bucketed: true" in p]
    assert len(round_plans) == 2
    for text in round_plans:
        lines = text.splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        # The lines between the join and the bucketed scan hold no exchange.
        join = max(i for i in range(scan) if "Join" in lines[i])
        assert not any("Exchange" in line for line in lines[join:scan])
