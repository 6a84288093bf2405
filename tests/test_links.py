import re

import pytest
from pyspark.sql import functions as F

from strata.operators.links import extract_links, graph_vertices, pagerank

PAGE = "x [[B|b]] y [[C]] [[Category:Z]] [[File:q]] [[Image:i]]"


def test_links_clean_and_raw(spark):
    pages = spark.createDataFrame([("A", PAGE), ("N", None)], "title string, text string")
    clean = [r["dst"] for r in extract_links(pages, "title", "text").collect()]
    raw = [r["dst"] for r in extract_links(pages, "title", "text", raw=True).collect()]
    assert sorted(clean) == ["B", "C", "File:q"]
    assert sorted(raw) == ["[[B", "[[C]]", "[[File:q]]"]


def test_graph_vertices(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (2, 3)], "src long, dst long")
    assert sorted(r["id"] for r in graph_vertices(edges).collect()) == [1, 2, 3]


# Golden values (GraphX static PageRank, reset 0.15, scaled to |V|).
GOLDEN = {
    1: {1: 1.6296296296, 2: 0.7301587302, 3: 1.4497354497, 4: 0.1904761905},
    5: {1: 1.1228603638, 2: 0.9186104579, 3: 1.5119358422, 4: 0.4465933360},
}


@pytest.mark.parametrize("iterations", [1, 5])
def test_pagerank_golden(spark, iterations):
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 1), (2, 3), (2, 3), (4, 1)],
                                  "src long, dst long")
    ranks = {r["id"]: r["pagerank"] for r in pagerank(edges, iterations, 0.15).collect()}
    assert ranks.keys() == GOLDEN[iterations].keys()
    for vertex, value in GOLDEN[iterations].items():
        assert ranks[vertex] == pytest.approx(value, abs=1e-9)
    assert sum(ranks.values()) == pytest.approx(4.0)


def test_pagerank_string_ids(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "src string, dst string")
    ranks = pagerank(edges, 3).agg(F.sum("pagerank")).first()[0]
    assert ranks == pytest.approx(3.0)


def pagerank_model(edges, iterations, reset=0.15):
    vertices = sorted({v for e in edges for v in e})
    out = {}
    for s, _ in edges:
        out[s] = out.get(s, 0) + 1
    rank = {v: 1.0 for v in vertices}
    for _ in range(iterations):
        inc = {v: 0.0 for v in vertices}
        for s, d in edges:
            inc[d] += rank[s] / out[s]
        rank = {v: reset + (1 - reset) * inc[v] for v in vertices}
    total = sum(rank.values())
    return {v: r * len(vertices) / total for v, r in rank.items()}


def test_pagerank_hot_source_is_salted_and_exact(spark):
    # Vertex 0 owns most edges: with 4 partitions it gets several salts.
    edges = [(0, d) for d in range(1, 200)] + [(d, (d * 7) % 50) for d in range(1, 60)]
    edges += [(0, 5)] * 3
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["id"]: r["pagerank"] for r in pagerank(df, 4, partitions=4).collect()}
    want = pagerank_model(edges, 4)
    assert got.keys() == want.keys()
    for v in want:
        assert got[v] == pytest.approx(want[v], rel=1e-9)


def test_pagerank_round_moves_data_twice(spark):
    from strata.operators.links import next_ranks
    from strata.sources.scratch import RunScratch

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with RunScratch(spark, "test-round") as run:
            edges = run.place(spark.range(400).selectExpr(
                "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 40 END AS src", "id % 57 AS dst", "0.5D AS w",
                "cast(id % 2 AS int) AS salt"), "edges", 4, ["src", "salt"])
            salted = F.broadcast(spark.range(1).selectExpr("id AS src", "2 AS _salts"))
            none = spark.range(0).select("id")

            def per_round(pattern):
                found = []
                for rounds in (2, 3):
                    ranks = spark.range(57).selectExpr("id", "1.0D AS rank")
                    for _ in range(rounds):
                        ranks = next_ranks(ranks, edges, salted, none, 0.15, 4)
                    plan = ranks._jdf.queryExecution().executedPlan().toString()
                    found.append(len(re.findall(pattern, plan)))
                return found[1] - found[0]
            # The ranks move to the edges, the contributions to their targets; the
            # placed edges and the salts (a broadcast of bounded size) do not move.
            assert per_round("REPARTITION_BY_NUM") == 1
            assert per_round("ShuffledHashJoin") == 1
            assert per_round(r"hashpartitioning\(dst#\d+L, \d+\), ENSURE") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
