"""Every query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry_module
import tapewright as tw
from checks import queries as catalogue
from checks.compare import differences, duckdb_over
from checks.oracles import oracle_sql
from checks.queries import queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.count() > 0
    assert "last_mov_avg_pr" in result.columns


def test_feed_lines_are_made_once(spark, monkeypatch):
    """Lines that come out anew at each evaluation are the same in all folders."""
    new = "java_method('java.util.UUID', 'randomUUID')"
    made = spark.range(50).selectExpr(
        f"CASE WHEN id % 5 > 0 THEN concat(if(id % 5 < 3, '{{', ''), {new}) END AS value"
    )
    monkeypatch.setattr(catalogue, "event_lines", lambda *_: made)
    root = catalogue._stored_lines(spark, "")
    texts = tw.read_raw_lines(spark, root, "*.txt").where("value <> ''")
    decoys = tw.read_raw_lines(spark, root, "*.csv")
    assert (texts.count(), decoys.count()) == (60, 20)
    assert texts.union(decoys).distinct().count() == 40
    for name in ("read_lines_by_prefix_and_suffix", "read_lines_of_part_files"):
        found = catalogue.queries()[name](spark, "")
        assert found.count() == found.where("value <> ''").count() == 40
