"""Queries against their SQL at the smallest scale."""

import pytest
from check_oracles import check, connect

from regfacts import queries as catalog

SF = "/root/testdata/sf0.001"
# the quick ones; tests/check_oracles.py runs all of them at any scale
NAMES = (
    "silver_facts", "institutions", "normalize_lei", "validate_records", "ffill", "keep_first",
    "coverage_gaps", "split_incremental", "upsert_ignore", "upsert_replace", "upsert_columns",
    "stream_append_events", "metadata_coverage", "flatten_responses", "flatten_tables",
    "normalize_export", "run_status", "code_functions", "date_functions", "flatten_responses_data_sets",
    "scan_quoted_files", "scan_rejected_files", "stream_append_keyed_events",
    "bucketed_entities", "bucketed_dimensions", "validation_document", "scan_grid_files",
    "detect_layout_of_mixed_files",
)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    rows, problem = check(spark, con, SF, name)
    assert problem is None
    assert rows > 0
