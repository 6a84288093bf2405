"""DuckDB SQL that states, independently of the Spark code, what each query of
``strata.plans.queries`` must return on the driver's tables.

Written from the meaning of each result, not from the plans that the Spark
code runs, so the two are genuinely different computations. Queries that SQL cannot
state (ALS) have no entry and get the driver's
rows-only check; their tests compare them with brute force instead.
"""

from __future__ import annotations

from strata.operators.language import STOP_WORDS
from strata.plans import params as P

_PANEL_CTES = """
dated AS (SELECT o_orderkey AS work, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
hosted AS (SELECT DISTINCT l_suppkey AS venue, l_orderkey AS work FROM lineitem),
tally AS (SELECT venue, y, count(*) AS c FROM hosted JOIN dated USING (work) GROUP BY venue, y),
grid AS (
  SELECT venue, y
  FROM (SELECT s_suppkey AS venue FROM supplier WHERE s_suppkey IN (SELECT venue FROM hosted)),
       (SELECT DISTINCT y FROM dated)),
filled AS (
  SELECT venue AS venue_id, y AS year, coalesce(c, 0) AS counts
  FROM grid LEFT JOIN tally USING (venue, y)),
steady AS (
  SELECT venue_id, year FROM filled
  WHERE venue_id NOT IN (SELECT venue_id FROM filled WHERE counts <= {threshold}))
"""


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def stopword_detection_sql(source: str, text_col: str, key: str) -> str:
    """The example stop-word detector in SQL: ``(key, language, confidence)``."""
    langs = sorted(STOP_WORDS)
    hits = ",\n    ".join(
        f"coalesce(len(list_filter(tk, lambda x: x IN ({_sql_list(STOP_WORDS[lang])}))), 0) "
        f"AS h_{lang}"
        for lang in langs)
    total = " + ".join(f"h_{lang}" for lang in langs)
    cases = []
    for i, lang in enumerate(langs):
        rest = langs[i + 1:]
        cond = " AND ".join(f"h_{lang} >= h_{other}" for other in rest) or "TRUE"
        cases.append(f"WHEN {cond} THEN '{lang}'")
    best = "greatest(" + ", ".join(f"h_{lang}" for lang in langs) + ")"
    return f"""(
  SELECT {key},
    CASE WHEN ({total}) = 0 THEN 'Unknown' {' '.join(cases)} END AS language,
    CAST(CASE WHEN ({total}) = 0 THEN 0.0
         ELSE ((10000 * {best}) // ({total})) / 10000.0 END AS FLOAT) AS confidence
  FROM (
    SELECT {key},
    {hits}
    FROM (SELECT {key}, regexp_split_to_array(lower({text_col}), '[ \\t\\n]+') AS tk
          FROM {source}) t0) t1)"""


def model_detection_sql(source: str, text_col: str, key: str, every_language: bool = False) -> str:
    """The n-gram model, learnt from the documents and applied to ``source``:
    ``(key, language, confidence)``. Candidates are the languages that have seen one
    of a text's n-grams, or all."""
    grams = """
  SELECT {key}, substring(' ' || w || ' ', CAST(i AS INTEGER), 3) AS g
  FROM (SELECT {key}, unnest(string_split(trim(regexp_replace(
          lower({text}), '[^\\p{{L}}]+', ' ', 'g')), ' ')) AS w FROM {source}),
       unnest(range(1, length(w) + 1)) t(i)
  WHERE w <> ''"""
    training = (f"(SELECT lang, text FROM documents WHERE doc_id % {P.LANGUAGE_FOLDS} <> 0 "
                "AND lang IS NOT NULL)")
    heard = "CROSS JOIN tongue" if every_language else "JOIN learnt USING (g)"
    return f"""(
WITH learnt AS (
  SELECT lang, g, count(*) AS c
  FROM ({grams.format(key="lang", text="text", source=training)}) GROUP BY lang, g),
known AS (SELECT DISTINCT g FROM learnt),
tongue AS (
  SELECT lang, ln(docs / sum(docs) OVER ()) AS prior, total + (SELECT count(*) FROM known) AS denom
  FROM (SELECT lang, count(*) AS docs FROM {training} GROUP BY lang)
  JOIN (SELECT lang, sum(c) AS total FROM learnt GROUP BY lang) USING (lang)),
own AS (
  SELECT {key}, g, count(*) AS k
  FROM ({grams.format(key=key, text=text_col, source=source)}) JOIN known USING (g)
  GROUP BY {key}, g),
candidate AS (SELECT DISTINCT {key}, lang FROM own {heard}),
score AS (
  SELECT {key}, lang, sum(k) AS n,
         any_value(prior) + sum(k * ln((coalesce(c, 0) + 1) / denom)) AS s
  FROM candidate JOIN tongue USING (lang) JOIN own USING ({key})
       LEFT JOIN learnt USING (lang, g)
  GROUP BY {key}, lang),
best AS (
  SELECT {key}, arg_max(lang, s) AS language, 1 / sum(exp((s - top) / n)) AS confidence
  FROM (SELECT *, max(s) OVER (PARTITION BY {key}) AS top FROM score) GROUP BY {key})
SELECT {key}, coalesce(language, 'Unknown') AS language,
       CAST(round(coalesce(confidence, 0), 4) AS FLOAT) AS confidence
FROM {source} LEFT JOIN best USING ({key}))"""


def panel_ctes(threshold: int = P.STEADY_THRESHOLD) -> str:
    return "WITH " + _PANEL_CTES.format(threshold=threshold)


SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    SQL[name] = text


sql("venue_year_panel", panel_ctes() + """
SELECT venue_id, year, counts FROM filled ORDER BY venue_id, year""")

sql("steady_venues", panel_ctes() + """
SELECT venue_id, year FROM steady""")

sql("steady_venues_store", panel_ctes() + """
SELECT count(*) AS n_written, count(*) AS n_rows, 2 AS n_columns FROM steady""")


def citation_sql(detection: str) -> str:
    return panel_ctes() + f""",
titled AS (SELECT work, text AS title FROM dated LEFT JOIN documents ON doc_id = work),
spoken AS {detection},
paper AS (
  SELECT venue_id, year, work AS id
  FROM hosted JOIN dated USING (work) JOIN steady ON venue_id = venue AND year = y),
cites AS (SELECT l_orderkey AS id, l_partkey * 8 AS referenced_work_id FROM lineitem),
target AS (SELECT work AS referenced_work_id, title, language, confidence
           FROM titled JOIN spoken USING (work))
SELECT venue_id, year, id, referenced_work_id, title, language, confidence
FROM paper JOIN cites USING (id) LEFT JOIN target USING (referenced_work_id)
UNION ALL
SELECT venue_id, year, id, NULL, NULL, NULL, NULL
FROM paper WHERE id NOT IN (SELECT id FROM cites)"""


for _form in ("citation_language", "citation_language_csv", "citation_language_view"):
    sql(_form, citation_sql(model_detection_sql("titled", "title", "work")))

sql("detect_and_store", """
WITH works_t AS (
  SELECT o.o_orderkey AS id, CAST(year(o.o_orderdate) AS INTEGER) AS publication_year,
         d.text AS title
  FROM orders o LEFT JOIN documents d ON d.doc_id = o.o_orderkey),
detected AS """ + model_detection_sql("works_t", "title", "id", True) + """
SELECT w.id, w.publication_year, w.title, d.language, d.confidence
FROM works_t w JOIN detected d ON w.id = d.id""")

sql("language_udf", "SELECT * FROM " + stopword_detection_sql("documents", "text", "doc_id")
    + " q")

sql("merge_customers", """
WITH delta AS (
  SELECT CAST(o_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS VARCHAR) AS c_name,
         CAST(NULL AS VARCHAR) AS c_nationkey, CAST(max(o_totalprice) AS VARCHAR) AS c_acctbal,
         'PRIORITY' AS c_mktsegment
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
  UNION ALL
  SELECT CAST(s_suppkey + 10000000 AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR),
         CAST(s_acctbal AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM supplier),
b AS (SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name,
             CAST(c_nationkey AS INTEGER) AS c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal,
             c_mktsegment FROM delta)
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
       coalesce(b.c_name, a.c_name) AS c_name,
       coalesce(b.c_nationkey, a.c_nationkey) AS c_nationkey,
       coalesce(b.c_acctbal, a.c_acctbal) AS c_acctbal,
       coalesce(b.c_mktsegment, a.c_mktsegment) AS c_mktsegment
FROM customer a FULL OUTER JOIN b ON a.c_custkey = b.c_custkey""")

sql("merge_customers_in_place", SQL["merge_customers"])

sql("merge_counts_two_keys", """
WITH a AS (
  SELECT o_custkey AS author_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         count(*) AS works_count, count(*) FILTER (WHERE o_orderstatus = 'F') AS cited_by_count
  FROM orders GROUP BY 1, 2),
delta AS (
  SELECT CAST(o_custkey AS VARCHAR) AS author_id, CAST(year(l_shipdate) AS VARCHAR) AS year,
         CAST(count(*) AS VARCHAR) AS works_count, CAST(NULL AS VARCHAR) AS cited_by_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, year(l_shipdate)),
b AS (SELECT CAST(author_id AS BIGINT) AS author_id, CAST(year AS INTEGER) AS year,
             CAST(works_count AS BIGINT) AS works_count,
             CAST(cited_by_count AS BIGINT) AS cited_by_count FROM delta)
SELECT coalesce(a.author_id, b.author_id) AS author_id, coalesce(a.year, b.year) AS year,
       coalesce(b.works_count, a.works_count) AS works_count,
       coalesce(b.cited_by_count, a.cited_by_count) AS cited_by_count
FROM a FULL OUTER JOIN b ON a.author_id = b.author_id AND a.year = b.year""")

sql("merge_authors_store", f"""
WITH authors AS ({SQL["merge_customers"]}), counts AS ({SQL["merge_counts_two_keys"]}),
last AS (SELECT o_custkey * 2 AS author_id, 'order-' || max(o_orderkey) AS orcid
         FROM orders GROUP BY o_custkey),
ids AS (
  SELECT coalesce(c_custkey, author_id) AS author_id, c_name AS openalex,
         coalesce(orcid, c_mktsegment) AS orcid
  FROM customer FULL OUTER JOIN last ON c_custkey = author_id)
SELECT 'authors' AS part, c_custkey AS key, CAST(NULL AS INTEGER) AS year, c_name AS value_0,
       CAST(c_nationkey AS VARCHAR) AS value_1,
       CAST(CAST(round(c_acctbal, 2) AS DECIMAL(18, 2)) AS VARCHAR) AS value_2,
       c_mktsegment AS value_3 FROM authors
UNION ALL
SELECT 'counts', author_id, year, CAST(works_count AS VARCHAR), CAST(cited_by_count AS VARCHAR),
       NULL, NULL FROM counts
UNION ALL
SELECT 'ids', author_id, NULL, openalex, orcid, NULL, NULL FROM ids""")

sql("detect_language", "SELECT * FROM " + model_detection_sql("documents", "text", "doc_id", True)
    + " q")

_USER_RATINGS = """
SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity / 10 AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

sql("item_mean_rmse", f"""
WITH r AS ({_USER_RATINGS}),
m AS (SELECT item_id, avg(rating) AS p FROM r WHERE user_id % 5 <> 0 GROUP BY item_id)
SELECT round(sqrt(avg((p - rating) * (p - rating))), 6) AS rmse, count(*) AS n_scored
FROM r JOIN m USING (item_id) WHERE user_id % 5 = 0""")

sql("top_users_per_item", f"""
WITH r AS ({_USER_RATINGS}),
best AS (
  SELECT item_id, user_id, max(rating) AS score FROM r
  WHERE item_id IN (SELECT item_id FROM r GROUP BY item_id
                    HAVING count(*) > {P.ELIGIBLE_MIN_RATINGS})
  GROUP BY item_id, user_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, user_id)
                 AS INTEGER) AS rank
  FROM best)
SELECT item_id, p_name AS title, user_id, rank, score
FROM ranked JOIN part ON p_partkey = item_id WHERE rank <= {P.ALS_TOP_K}""")



def _als_ctes(iterations: int = P.ALS_SQL_ITERATIONS, reg: float = P.ALS_REG_PARAM) -> str:
    """ALS of two factors as chained CTEs: every system of two equations is solved by
    Cramer's rule. ``users`` and ``items`` (id, a, b) are the last factors."""
    def half(name: str, fixed: str, by: str, to: str) -> str:
        return f"""{name} AS (
  SELECT id, (s22 * t1 - s12 * t2) / (s11 * s22 - s12 * s12) AS a,
         (s11 * t2 - s12 * t1) / (s11 * s22 - s12 * s12) AS b
  FROM (SELECT {to} AS id, sum(a * a) + {reg} * count(*) AS s11, sum(a * b) AS s12,
               sum(b * b) + {reg} * count(*) AS s22, sum(a * rating) AS t1, sum(b * rating) AS t2
        FROM train JOIN {fixed} ON id = {by} GROUP BY {to}))"""

    steps = [half(f"{side}{i}", fixed.format(i - 1 if side == "u" else i), by, to)
             for i in range(1, iterations + 1)
             for side, fixed, by, to in (("u", "i{}", "item_id", "user_id"),
                                         ("i", "u{}", "user_id", "item_id"))]
    return f"""
WITH r AS ({_USER_RATINGS}),
train AS (SELECT * FROM r WHERE (user_id * 7 + item_id) % 5 <> 0),
i0 AS (SELECT DISTINCT item_id AS id, 1.0::DOUBLE AS a,
              (item_id * {P.ALS_START} % 1000) / 1000.0::DOUBLE AS b FROM train),
{", ".join(steps)},
users AS (SELECT * FROM u{iterations}), items AS (SELECT * FROM i{iterations})"""


sql("als_factors", _als_ctes() + """
SELECT id AS item_id, round(a, 5) AS factor_1, round(b, 5) AS factor_2 FROM items""")

sql("als_heldout", _als_ctes() + """
SELECT round(sqrt(avg((u.a * i.a + u.b * i.b - rating) * (u.a * i.a + u.b * i.b - rating))), 5)
       AS rmse, count(*) AS n_scored
FROM r JOIN users u ON u.id = user_id JOIN items i ON i.id = item_id
WHERE (user_id * 7 + item_id) % 5 = 0""")

sql("als_recommend", _als_ctes() + f""",
wanted AS (SELECT item_id AS id FROM r GROUP BY item_id
           HAVING count(rating) > {P.ELIGIBLE_MIN_RATINGS}),
ranked AS (
  SELECT i.id AS item_id, u.id AS user_id, u.a * i.a + u.b * i.b AS score,
         CAST(row_number() OVER (PARTITION BY i.id ORDER BY u.a * i.a + u.b * i.b DESC, u.id)
              AS INTEGER) AS rank
  FROM items i JOIN wanted USING (id) CROSS JOIN users u)
SELECT item_id, p_name AS title, user_id, rank, round(score, 5) AS score
FROM ranked JOIN part ON p_partkey = item_id WHERE rank <= {P.ALS_TOP_K}""")

sql("max_inner_products", f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor(c::DOUBLE * 1024)) AS v
           FROM embeddings),
ranked AS (
  SELECT q.vec_id, b.vec_id AS other_id, list_dot_product(q.v, b.v)::BIGINT AS score,
         CAST(row_number() OVER (PARTITION BY q.vec_id
              ORDER BY list_dot_product(q.v, b.v) DESC, b.vec_id) AS INTEGER) AS rank
  FROM v q CROSS JOIN v b WHERE q.label = 0)
SELECT vec_id, rank, other_id, score FROM ranked WHERE rank <= {P.ALS_TOP_K}""")

_MEAN = """
SELECT p_partkey AS item_id, p_name AS title, avg(l_quantity) AS mean_rating
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_name"""
sql("mean_rating_fold", _MEAN)
sql("mean_rating_join", _MEAN)
sql("mean_rating_pandas", _MEAN)

sql("fold_mean", """
SELECT l_partkey AS item_id, avg(l_quantity) AS mean_rating FROM lineitem GROUP BY l_partkey""")

sql("fold_extremes", f"""
SELECT user_id, min(rating) AS lowest, max(rating) AS highest FROM ({_USER_RATINGS}) GROUP BY user_id""")

sql("fold_item_sets", f"""
SELECT user_id, string_agg(item_id, ',' ORDER BY item_id) AS items
FROM (SELECT DISTINCT user_id, item_id FROM ({_USER_RATINGS})) GROUP BY user_id""")

sql("mean_rating_text_lines", """
SELECT l_partkey AS item_id, avg(l_quantity) AS mean_rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey""")

sql("mean_rating_titled_text_lines", """
SELECT p_partkey AS item_id, '"' || p_name || ', ' || p_brand || '"' AS title,
       avg(l_quantity) AS mean_rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY p_partkey, p_name, p_brand""")

sql("ratings_per_item_text_lines", """
SELECT l_partkey AS item_id, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey""")

sql("genre_ranking_text_lines", """
SELECT genre, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS genre FROM part)
GROUP BY genre""")

sql("tags_exceed_genres_text_lines", f"""
WITH t AS (SELECT l_partkey AS item_id, count(*) AS tag_count
           FROM lineitem JOIN part ON l_partkey = p_partkey
           WHERE l_discount >= {P.TAG_MIN_DISCOUNT} GROUP BY l_partkey)
SELECT p_partkey AS item_id, '"' || p_name || ', ' || p_brand || '"' AS title
FROM t JOIN part ON t.item_id = p_partkey
WHERE t.tag_count > len(string_split(p_name, ' '))""")

sql("ratings_per_item", """
SELECT l_partkey AS item_id, count(*) AS n FROM lineitem GROUP BY l_partkey
ORDER BY n DESC, item_id""")

sql("most_rated_titles", f"""
SELECT p_partkey AS item_id, p_name AS title, count(l_quantity) AS rating_count
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_name
ORDER BY rating_count DESC, item_id LIMIT {P.TOP_TITLES}""")

_TAGS = f"""
WITH t AS (SELECT l_partkey AS item_id, count(*) AS tag_count FROM lineitem
           WHERE l_discount >= {P.TAG_MIN_DISCOUNT} GROUP BY l_partkey)"""

sql("tags_exceed_genres", _TAGS + """
SELECT p_partkey AS item_id, p_name AS title
FROM t JOIN part ON t.item_id = p_partkey
WHERE t.tag_count > len(string_split(p_name, ' '))""")

sql("tag_counts_by_title", _TAGS + """
SELECT p_partkey AS item_id, p_name AS title, t.tag_count
FROM t JOIN part ON t.item_id = p_partkey""")

sql("genre_ranking", """
SELECT genre, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS genre FROM part)
GROUP BY genre ORDER BY n DESC, genre""")

sql("orders_by_hour", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(event_id) AS n FROM events
GROUP BY 1 ORDER BY 1""")

_DAYS = """
WITH days(day_id, day_name) AS (VALUES (1, 'Sunday'), (2, 'Monday'), (3, 'Tuesday'),
  (4, 'Wednesday'), (5, 'Thursday'), (6, 'Friday'), (7, 'Saturday'))"""

# DuckDB numbers days 0 = Sunday, Spark 1 = Sunday.
sql("orders_by_weekday", _DAYS + """
SELECT day_name, count(o_orderkey) AS order_count
FROM orders JOIN days ON dayofweek(o_orderdate) + 1 = day_id GROUP BY day_name""")

sql("orders_by_weekday_base0", _DAYS + """
SELECT day_name, count(o_orderkey) AS order_count
FROM orders JOIN days ON dayofweek(o_orderdate) = day_id GROUP BY day_name""")

sql("group_id_ratio", """
SELECT n_name AS department, count(c_custkey) AS count,
       CAST(count(c_custkey) AS DOUBLE) / sum(c_custkey) AS procent
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")

sql("group_share", """
SELECT n_name AS department, count(c_custkey) AS count,
       CAST(count(c_custkey) AS DOUBLE)
         / (SELECT count(c_custkey) FROM customer JOIN nation ON c_nationkey = n_nationkey)
         AS share
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")

_FILTER = f"SELECT * FROM part WHERE p_partkey > {P.FILTER_MIN_KEY} ORDER BY p_partkey DESC"
sql("filter_sort_desc", _FILTER)
sql("filter_sort_desc_json", _FILTER)

sql("eligible_items", f"""
SELECT l_partkey AS item_id FROM lineitem GROUP BY l_partkey
HAVING count(l_quantity) > {P.ELIGIBLE_MIN_RATINGS}""")

_LINES = """
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"""

# JVM split on one space: trailing empty pieces dropped, "" gives [""].
_WORDS = _LINES + """,
words AS (
  SELECT unnest(CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines),
counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)"""

sql("word_count", _WORDS + "\nSELECT word, n FROM counts ORDER BY n DESC, word")
sql("word_count_text_file", SQL["word_count"])
sql("word_count_whole_files", SQL["word_count"])

sql("word_count_totals", _WORDS + """
SELECT count(*) AS distinct_words, CAST(sum(n) AS BIGINT) AS total_words FROM counts""")

_SEPARATORS = "".join(P.WORD_SEPARATORS)
sql("word_count_filtered", _LINES + f"""
SELECT word, count(*) AS n FROM (
  SELECT lower(regexp_replace(t, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) AS word
  FROM (SELECT unnest(regexp_split_to_array(line, '[{_SEPARATORS}]')) AS t FROM lines) s) w
WHERE word <> '' AND word NOT IN ({_sql_list(P.STOP_WORDS)})
GROUP BY word""")

sql("split_quoted_fields", """
SELECT p_partkey AS item_id, '"' || p_name || ', ' || p_brand || '"' AS title_field,
       p_type || '|' || CAST(p_size AS VARCHAR) AS rest, 3 AS n_fields
FROM part""")

sql("parse_double_props", """
SELECT event_type, avg(k) AS k_mean, sum(k) / count(*) AS k_mean_all_rows,
       count(*) FILTER (WHERE k IS NULL) AS k_bad
FROM (SELECT event_type, try_cast(regexp_extract(props, ':\\s*([^}]*)\\}', 1) AS DOUBLE) AS k
      FROM events) e
GROUP BY event_type""")

for _name in ("scan_parquet", "scan_csv_strings", "scan_csv_inferred", "scan_json",
              "write_overwrite", "write_error_if_exists"):
    sql(_name, "SELECT * FROM part")
sql("write_recoverable", f"""
SELECT *, 2 AS version, (SELECT count(*) FROM part WHERE p_size > {P.PUBLISH_MIN_SIZE}) AS stored_rows
FROM part WHERE p_size > {P.PUBLISH_MIN_SIZE}""")
sql("scan_xml", "SELECT p_partkey AS item_id, p_name AS title FROM part")
sql("scan_text", "SELECT p_name AS value FROM part")
sql("create_empty_union", "SELECT * FROM nation")
sql("read_or_empty_union", "SELECT * FROM nation")

_WIKI = """
WITH w AS (
  SELECT url AS src,
         regexp_replace(html, '<a href="/?([^"]*)">([^<]*)</a>', '[[\\1|\\2]]', 'g') AS wiki
  FROM pages),
m AS (
  SELECT src, unnest(regexp_extract_all(wiki, '\\[\\[([^\\]]+)\\]\\]', 0)) AS whole,
         unnest(regexp_extract_all(wiki, '\\[\\[([^\\]]+)\\]\\]', 1)) AS inner_text
  FROM w),
kept AS (
  SELECT src, whole, inner_text FROM m
  WHERE NOT (starts_with(whole, '[[Site:') OR starts_with(whole, '[[Image:')
             OR starts_with(whole, '[[Category:')))"""

sql("link_edges", _WIKI + "\nSELECT src, split_part(inner_text, '|', 1) AS dst FROM kept")
sql("link_edges_raw", _WIKI + "\nSELECT src, split_part(whole, '|', 1) AS dst FROM kept")
sql("link_hrefs", """
SELECT url AS src, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst FROM pages""")

sql("graph_vertices", """
SELECT l_partkey AS id FROM lineitem UNION SELECT l_suppkey AS id FROM lineitem""")


def pagerank_sql(edges: str, iterations: int = P.PAGERANK_ITERATIONS,
                 reset: float = P.PAGERANK_RESET) -> str:
    """Static PageRank as chained CTEs over ``edges(src, dst)``."""
    parts = [f"e AS ({edges})",
             "v AS (SELECT src AS id FROM e UNION SELECT dst AS id FROM e)",
             "deg AS (SELECT src, count(*) AS outdeg FROM e GROUP BY src)",
             "r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM v)"]
    for i in range(1, iterations + 1):
        parts.append(
            f"r{i} AS (SELECT v.id, {reset} + {1 - reset} * coalesce(c.s, 0.0) AS rank FROM v "
            f"LEFT JOIN (SELECT e.dst AS id, sum(r.rank / deg.outdeg) AS s FROM e "
            f"JOIN deg ON e.src = deg.src JOIN r{i - 1} r ON e.src = r.id GROUP BY e.dst) c "
            f"ON v.id = c.id)")
    last = f"r{iterations}"
    return ("WITH " + ",\n".join(parts) +
            f"\nSELECT id, round(rank * (SELECT count(*) FROM {last}) / "
            f"(SELECT sum(rank) FROM {last}), 6) AS pagerank FROM {last}")


sql("pagerank", pagerank_sql("SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem"))
sql("wiki_pagerank", pagerank_sql(
    "SELECT src, dst FROM (" + _WIKI.strip()
    + "\nSELECT src, split_part(inner_text, '|', 1) AS dst FROM kept) q"))


SQL["wiki_pagerank_xml"] = SQL["wiki_pagerank"]


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
