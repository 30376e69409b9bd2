"""Queries against their SQL twins. The full set runs with WORDLOOM_ALL=1; by default the long ones of each family are one each."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect

from wordloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
LONG = {
    "refine_edges", "refine_edges_capped", "connected_keywords", "node_sufficiency", "node_sample", "components", "nested_keywords",
    "shortest_paths", "simple_paths_sampled", "nested_sequences_sampled", "network_json", "match_keywords", "match_sequences_sampled", "check_sufficiency_sampled", "match_substrings",
    "match_sequences_ordered", "match_counts", "pattern_similarity", "score_description", "row_report", "sufficiency_summary",
    "keyword_scores", "keywords_union", "retrieval_report", "query_prompts", "maximal_cliques",
}
NAMES = [n for n in QUERIES if os.environ.get("WORDLOOM_ALL") or n not in LONG]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, SF, entry.queries(), entry.oracle_sql()) == ""


def test_every_query_has_its_sql():
    assert QUERIES.keys() <= entry.oracle_sql().keys() and QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.total_rows == row.sufficient_count + row.insufficient_count == 200
