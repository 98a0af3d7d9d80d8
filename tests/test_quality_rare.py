import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pollfold.plans import publish, quality, rare
from tests.conftest import rows_of

SCHEMA = "user_id string, subject_id string, task string, value string, created_at timestamp"
Q = "smooth-or-featured"


def votes(user, n, problems, when, subject="s"):
    answers = ["problem"] * problems + ["smooth"] * (n - problems)
    return [(user, f"{subject}{i}", Q, a, when) for i, a in enumerate(answers)]


def test_quality_rule(spark):
    late, early = datetime(2024, 9, 1), datetime(2024, 8, 1)
    data = votes("good", 150, 10, late) + votes("bad", 101, 26, late) + votes("few", 100, 100, late)
    data += votes("edge", 200, 50, late) + votes("left", 3, 0, early) + [("other", "s", "bar", "no", early), (None, "s", Q, "smooth", late)]
    df = spark.createDataFrame(data, SCHEMA)
    rule = quality.QualityRule()
    assert rows_of(quality.unreliable_volunteers(df, rule)) == [("bad",), ("left",)]
    kept = quality.without_unreliable(df, rule)
    # a volunteer without answers to the key question stays, and so do responses without volunteer
    assert {r[0] for r in kept.select("user_id").distinct().collect()} == {"good", "few", "edge", "other", None}
    report = quality.quality_report(df, rule).first()
    assert tuple(report) == (5, 2, 1, 1, 0.2)


def test_early_votes_of_test_subjects_go(spark):
    early, late = datetime(2024, 8, 1), datetime(2024, 12, 2)
    data = [(f"u{i}", "hot", Q, "smooth", early if i < 15 else late) for i in range(20)]
    data += [(f"u{i}", "cold", Q, "smooth", early) for i in range(19)] + [("u", "hot", "bar", "no", early), ("u", None, Q, "smooth", early)]
    df = spark.createDataFrame(data, SCHEMA)
    kept = quality.without_early_test_votes(df, "2024-12-01", Q)
    assert rows_of(kept.groupBy("subject_id").count()) == sorted([("hot", 5), ("cold", 19), (None, 1)], key=repr)
    assert rows_of(quality.intensive_subjects(df, Q, strict=True)) == []


def test_rare_features(spark):
    data = [
        ("a", json.dumps(["![x](y) Lens or Arc", "Ring"])),
        ("a", json.dumps(["Ring"])),
        ("b", json.dumps([])),
        ("c", json.dumps(["Ring"])),
        (None, json.dumps(["Ring"])),
    ]
    chosen = rare.chosen_features(spark.createDataFrame(data, "id_str string, value string"), "id_str")
    assert chosen.filter("feature is null").count() == 1
    counts = rare.feature_counts(chosen, "id_str")
    assert counts.columns == ["id_str", "lens_or_arc", "ring"]
    assert rows_of(counts) == [("a", 1, 2), ("c", 0, 1)]
    reduced = spark.createDataFrame([("a", 4), ("c", 0)], "id_str string, `smooth-or-featured_total-votes` int")
    merged = rare.with_feature_fractions(reduced, counts, "id_str")
    assert rows_of(merged, "id_str", "ring_fraction") == [("a", 0.5), ("c", None)]


def test_open_vocabulary_makes_no_columns(spark):
    data = [(f"s{k % 50}", json.dumps([f"odd {k}", "Ring"])) for k in range(3000)]
    chosen = rare.chosen_features(spark.createDataFrame(data, "id_str string, value string"), "id_str")
    table = rare.feature_table(chosen, "id_str")
    maps = {r["id_str"]: r["features"] for r in rare.feature_maps(table, "id_str").collect()}
    assert len(maps) == 50 and maps["s0"]["ring"] == 60 and maps["s0"]["odd_50"] == 1 and len(maps["s0"]) == 61
    reduced = spark.createDataFrame([("s0", 120), ("s1", 0)], "id_str string, `smooth-or-featured_total-votes` int")
    shares = {(r[0], r[1]): r[3] for r in rare.feature_shares(reduced, table, "id_str").collect()}
    assert shares["s0", "ring"] == 0.5 and shares["s1", "ring"] is None and len(shares) == 122
    with pytest.raises(ValueError, match="more than 2000"):
        rare.feature_counts(chosen, "id_str")
    assert rare.feature_counts(chosen, "id_str", ["ring"]).columns == ["id_str", "ring"]


def test_publish_catalog_split(spark):
    ids = range(10)
    reduced = spark.createDataFrame([(i, i + 1) for i in ids], "id_str int, votes int")
    locations = spark.createDataFrame([(i, f"https://h/x/{i}.png?a=1") for i in ids], "id_str int, locations string")
    coords = spark.createDataFrame([(i, float(i), 0.0) for i in ids], "id_str int, ra double, dec double")
    out = publish.publish_catalog(reduced, locations, coords, "data").orderBy("id_str").collect()
    # the 0.7 quantile of 0..9 is 6.3
    assert [r.in_test for r in out] == [False] * 7 + [True] * 3
    assert out[4].file_loc == "data/4.png"


def test_cohort_shares(spark):
    when = datetime(2024, 9, 1)
    df = spark.createDataFrame(votes("u", 12, 3, when, "")[0:12], SCHEMA).withColumn("subject_id", F.lit("s"))
    cohort = F.lit("all")
    assert rows_of(quality.cohort_shares(df, cohort, "problem", 11)) == [("all", "s", 0.25, 12)]
    assert rows_of(quality.cohort_shares(df, cohort, "problem", 12)) == []
