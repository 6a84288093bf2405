"""Format equivalence: the citation table on JSON copies of its inputs (SQL
text over views, the stored language model in SQL) equals the DataFrame form on
the parquet tables."""

from strata.operators import panel
from strata.plans import queries as Q
from strata.plans.tables import StandIns
from strata.session import scratch_path
from strata.sources import parse_as, read_json, write_table
from tests.conftest import SF_SMALL


def test_citation_on_json_copies_equals_parquet(spark):
    s = StandIns(spark, SF_SMALL)
    inputs = Q._citation_inputs(s)
    for name, df in inputs.items():
        path = scratch_path(spark, f"test-citation-json-{name}")
        write_table(df, path, fmt="json")
        read_json(spark, path).createOrReplaceTempView(f"strata_json_{name}")
    out = panel.citation_table_sql(spark, "strata_json_steady", "strata_json_host",
                                   "strata_json_works", "strata_json_refs",
                                   Q._language_model(s))
    json_rows = sorted(map(tuple, parse_as(out, Q.CITATION_SCHEMA).collect()), key=str)
    frame = Q.citation_language(spark, SF_SMALL)
    parquet_rows = sorted(map(tuple, frame.collect()), key=str)
    assert json_rows == parquet_rows and len(parquet_rows) > 0


def test_csv_copies_go_when_their_records_are_stored(spark, monkeypatch):
    """Of the copies the result keeps the references in columns; the text and the rows
    that it was written from are gone, and so are the shuffles of all steps before."""
    from strata.session import checkpoint_dir
    from strata.sources import writers
    from strata.sources.scratch import list_names
    from tests.test_panel import settles_at, shuffle_files

    s = StandIns(spark, SF_SMALL)
    Q._language_model(s)
    inputs = Q._citation_inputs(s)  # counts rows, whose small shuffle is not a step's
    monkeypatch.setattr(Q, "_citation_inputs", lambda _: inputs)
    root, original, seen = f"{checkpoint_dir(spark)}/strata-scratch", writers.write_table, []
    files, before = shuffle_files(spark), set(list_names(spark, root))

    def recording(df, path, **options):
        assert settles_at(spark, files)
        seen.append(list_names(spark, path.rsplit("/", 1)[0]))
        original(df, path, **options)

    monkeypatch.setattr(writers, "write_table", recording)
    out = Q.citation_language_csv(spark, SF_SMALL)
    assert settles_at(spark, files)
    new = set(list_names(spark, root)) - before
    assert sorted(part for name in new for part in list_names(spark, f"{root}/{name}")) == \
        ["papers", "refs", "target"]
    # No copy's text is there any more when the next is written.
    assert len(seen) == 4 and not [n for names in seen for n in names if n.endswith("-csv")]
    rows = sorted(map(tuple, out.collect()), key=str)
    assert rows == sorted(map(tuple, Q.citation_language(spark, SF_SMALL).collect()), key=str)
    assert len(rows) > 0
