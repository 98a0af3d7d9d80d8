import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pollfold.operators import aggregates as agg
from pollfold.operators import checks, curves, joins, ranking, sets, shaping
from tests.conftest import rows_of


@pytest.mark.parametrize("q", [0.0, 0.3, 0.7, 0.9, 1.0])
def test_exact_quantile(spark, q):
    rng = random.Random(4)
    for values in (
        [rng.gauss(0, 1) for _ in range(1001)],
        [7.0] * 500 + [rng.random() for _ in range(700)] + [1e300, -1e300],
        [1.0, float(np.nextafter(1.0, 2))] * 3,
        [3.0],
    ):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        assert agg.exact_quantile(df, "v", q) == pytest.approx(float(np.quantile(values, q)), rel=1e-12)
    assert agg.exact_quantile(spark.createDataFrame([], "v double"), "v", q) is None


def test_exact_quantile_keeps_whole_and_infinite_values(spark):
    def found(values, kind, q=0.5):
        return agg.exact_quantile(spark.createDataFrame([(v,) for v in values], f"v {kind}"), "v", q)

    odd = [9007199254740993, 9007199254740995, 9007199254740997]
    assert found(odd, "long") == 9007199254740995
    assert found([-(2**63), 2**63 - 1, 3], "long") == 3
    assert found([Decimal(n) / 100 for n in odd], "decimal(20,2)") == Decimal("90071992547409.95")
    inf = float("inf")
    assert found([1.0, 2.0, inf], "double") == 2.0
    assert [found([-inf, -inf, 1.0, 2.5, inf], "double", q) for q in (0.0, 0.5, 0.75, 1.0)] == [-inf, 1.0, 2.5, inf]
    assert found([1.7e308, -1.7e308, 3.0], "double") == 3.0


def test_rows_without_key_stay_and_are_spread(spark):
    rows = spark.range(2000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN id END AS k", "map('a', id) AS m")
    ids = spark.createDataFrame([(4,), (8,), (None,)], "k long")
    kept = joins.remove_ids(rows, ids, "k")
    assert kept.columns == ["id", "k", "m"] and kept.count() == 1998
    joined = joins.attach(rows, ids.selectExpr("k", "'x' AS found"), "k", required=False)
    assert joined.count() == 2000 and joined.where("found = 'x'").count() == 2


def test_histogram_like_numpy(spark):
    values = [0.0, 0.1, 0.25, 0.5, 0.5, 0.99, 1.0, 1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    counts, edges = np.histogram(values, bins=4)
    found = agg.histogram(df, "v", 4).orderBy("bin").collect()
    assert [r.n for r in found] == counts.tolist()
    assert [r.bin_low for r in found] == pytest.approx(edges[:-1].tolist())
    counts, _ = np.histogram(values, bins=5, range=(0.2, 0.6))
    assert [r.n for r in agg.histogram(df, "v", 5, 0.2, 0.6).orderBy("bin").collect()] == counts.tolist()
    constant = spark.createDataFrame([(2.0,)] * 3, "v double")
    assert sum(r.n for r in agg.histogram(constant, "v", 3).collect()) == 3


def moments(n, seed, ties=True):
    rng = random.Random(seed)
    start = datetime(2024, 3, 1)
    span = rng.choices(range(40 * 86400), k=n)
    return [start + timedelta(seconds=s, microseconds=0 if ties else rng.randrange(10**6)) for s in span]


def test_time_buckets_like_resampling(spark):
    times = moments(60, 1)
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(times)], "created_at timestamp, workflow int")
    expected = pd.Series(1, index=pd.DatetimeIndex(times)).resample("2h").sum()
    found = agg.time_buckets(df, 7200).orderBy("bucket").collect()
    assert [(r.bucket, r.n) for r in found] == [(k.to_pydatetime(), n) for k, n in expected.items()]
    fortnights = pd.Series(1, index=pd.DatetimeIndex(times)).resample("2W").sum()
    first = int(fortnights.index[0].timestamp())
    found = agg.time_buckets(df, 14 * 86400, anchor=first + 86400, right=True).orderBy("bucket").collect()
    # pandas labels a fortnight by its last day, whose end is the right edge here
    assert [r.n for r in found] == fortnights.tolist()
    assert found[0].bucket == (fortnights.index[0] + pd.Timedelta(days=1)).to_pydatetime()
    by = agg.time_buckets(df, 86400, "workflow").groupBy("workflow").agg(F.count("bucket"), F.sum("n")).collect()
    assert {r[0]: r[2] for r in by} == {0: 30, 1: 30} and by[0][1] == by[1][1]


@pytest.mark.parametrize("ties", [True, False])
def test_running_count_like_cumsum(spark, ties):
    times = moments(500, 2, ties) + [datetime(2024, 3, 2)] * 200
    rng = random.Random(3)
    flags = [rng.random() < 0.3 for _ in times]
    df = spark.createDataFrame(list(zip(times, flags)), "created_at timestamp, flag boolean")
    pdf = pd.DataFrame({"t": times, "f": flags}).groupby("t")["f"].agg(["count", "sum"]).cumsum()
    found = curves.running_count(df, F.col("flag")).orderBy("time").collect()
    assert [(r.time, r.rows_so_far, r.flagged_so_far) for r in found] == [
        (k.to_pydatetime(), a, b) for k, a, b in pdf.itertuples()
    ]


def test_concentration_like_cumsum(spark, monkeypatch):
    monkeypatch.setattr(curves, "_CHUNK", 7)
    rng = random.Random(6)
    users = [f"u{int(rng.paretovariate(0.8))}" for _ in range(600)]
    df = spark.createDataFrame([(u,) for u in users] + [(None,)], "user_id string")
    y = pd.Series(users).value_counts().sort_values(ascending=False).cumsum().to_numpy()
    found = curves.concentration_curve(df).orderBy("rank").collect()
    assert [r.rank for r in found] == list(range(1, len(y) + 1))
    assert [r.cumulative for r in found] == y.tolist()
    inverse = y.max() - y
    assert [r.remaining for r in found] == inverse.tolist()
    assert [r.remaining_share for r in found] == pytest.approx((inverse / inverse.max()).tolist())


def test_keep_first_and_uniqueness(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, t int, v string")
    assert rows_of(agg.keep_first(df, ["k"], ["t"])) == [("a", 1, "y"), ("b", 5, "z")]
    with pytest.raises(ValueError, match="repeat"):
        checks.assert_unique(df, ["k"])
    assert checks.assert_unique(df, ["k", "t"]) is df
    other = spark.createDataFrame([("a", 1)], "k string, w int")
    with pytest.raises(Exception, match="key repeats"):
        joins.one_to_one(df, other, "k").collect()
    assert rows_of(joins.one_to_one(df.filter("t <> 2"), other, "k")) == [("a", 1, "y", 1)]


def test_duplicate_groups(spark):
    df = spark.createDataFrame([(1, "J1"), (2, "J1"), (3, "J2"), (4, None), (5, None)], "subject_id int, iauname string")
    assert rows_of(checks.duplicate_group_ids(df)) == [("1",), ("2",)]


def test_vocabulary(spark):
    left = spark.createDataFrame([("a-0",), ("a-1",), (None,)], "q string")
    right = spark.createDataFrame([("a-0",), ("a-2",)], "q string")
    assert rows_of(checks.vocabulary_gap(left, right, ["q"])) == [("q", "a-1", "left"), ("q", "a-2", "right")]
    with pytest.raises(ValueError):
        checks.assert_same_vocabulary(left, right, ["q"])
    checks.assert_same_vocabulary(left, left, ["q"])


def test_null_keys_in_joins_and_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "person_id string")
    ids = spark.createDataFrame([("a",), (None,)], "person_id string")
    assert rows_of(joins.remove_ids(df, ids, "person_id")) == [("b",), (None,)]
    assert rows_of(joins.remove_people(df, ["a"])) == [("b",), (None,)]
    assert rows_of(joins.keep_ids(df, ids, "person_id")) == [("a",)]
    assert rows_of(shaping.without_tasks(df, ["a"], "person_id")) == [("b",), (None,)]
    yes, no = sets.split_cohorts(df, F.col("person_id") == "a")
    assert (yes.count(), no.count()) == (1, 2)


def test_columns_and_names(spark, tree):
    df = spark.createDataFrame([(1, None, "x")], "a int, `b-c.d` string, e string")
    assert shaping.without_empty_columns(df).columns == ["a", "e"]
    assert shaping.without(df, ["a", "nothing"]).columns == ["b-c.d", "e"]
    wide = spark.createDataFrame([(1, 2)], "`question-9_yes` int, `question-9_total-votes` int")
    renamed = shaping.with_survey_suffix(wide, tree, "sky")
    assert renamed.columns == ["question-9-sky_yes", "question-9-sky_total-votes"]
    assert shaping.without_survey_suffix(renamed, "sky").columns == wide.columns
    with pytest.raises(ValueError, match="missing"):
        shaping.with_survey_suffix(wide, tree, "sky", required=["question-2-sky_no"])


def test_ends_and_fold(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "t int, v string")
    assert rows_of(ranking.first_and_last(df, ["t"])) == [("first", 1, "a"), ("last", 3, "c")]
    other = spark.createDataFrame([(1, 10), (9, 90)], "t int, n int")
    third = spark.createDataFrame([(3, 5)], "t int, m int")
    assert rows_of(joins.fold_outer([other, third], ["t"])) == [(1, 10, 0), (3, 0, 5), (9, 90, 0)]


def test_samples_depend_on_keys_and_seed_alone(spark):
    rows = spark.range(4000).withColumn("name", F.concat(F.lit("n"), F.col("id")))
    dealt = rows.repartition(13).orderBy(F.desc("id"))
    for options in ({"fraction": 0.3}, {"fraction": 1.7, "replacement": True}, {"fraction": 0.3, "seed": 4}):
        first = sorted(r["id"] for r in shaping.random_sample(rows, **options).collect())
        assert first == sorted(r["id"] for r in shaping.random_sample(dealt, **options).collect())
        assert abs(len(first) / 4000 - options["fraction"]) < 0.08
    once = {r["id"] for r in shaping.random_sample(rows, 0.3, keys=["id"]).collect()}
    assert once != {r["id"] for r in shaping.random_sample(rows, 0.3, seed=4, keys=["id"]).collect()}
    picked = shaping.sample_rows(dealt, 100, keys=["id"])
    assert picked.count() == 100 and {r["id"] for r in picked.collect()} <= once
    assert shaping.sample_rows(rows, 0).count() == 0 and shaping.sample_rows(rows, 10**6).count() == 4000
    assert shaping.poisson_steps(0.75)[0] == pytest.approx(0.4723665527410147) and shaping.poisson_steps(0.0) == []
