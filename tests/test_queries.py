"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pollfold.queries import ORACLES, QUERIES
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "attach_sky_catalog",
    "chunk_pull",
    "cohort_months",
    "concentration_curve",
    "current_subjects",
    "derive_annotations",
    "export_to_responses",
    "filter_rare_answers",
    "filter_then_reduce",
    "flatten_and_reduce",
    "histogram",
    "keep_first_row",
    "predict_answers",
    "predict_survey_dictionary",
    "publish_survey_catalog",
    "random_sample",
    "rare_feature_maps",
    "rare_feature_table",
    "raw_to_reduced",
    "rejected_annotations",
    "response_ids",
    "responses_to_votes",
    "running_flag_count",
    "sky_match_nearest",
    "stream_derived_to_flat",
    "stream_three_arrivals",
    "time_buckets_fortnights",
    "volunteer_profiles",
    "votes_to_predictions",
]
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the provided tables are not here")


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES)


@needs_tables
def test_entry(spark):
    assert entry(spark).count() == 200


@needs_tables
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_its_sql(spark, name):
    df = queries()[name](spark, SF_DIR)
    problem, rows = compare(df, connect(SF_DIR), oracle_sql()[name])
    assert not problem
    assert rows > 0
