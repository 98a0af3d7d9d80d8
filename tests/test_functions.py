import json
import zlib
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from pollfold.functions import ids, jsons, text, times, votes
from tests.conftest import rows_of

TAG = "![x.png](https://host/x.png =60x)"


@pytest.mark.parametrize(
    "raw, clean",
    [
        (f"{TAG} Features or Disk", "features or disk"),
        (f"{TAG} Can't tell", "can't tell"),
        (f"{TAG} Both (Merger & Tidal Debris)", "both (merger & tidal debris)"),
        (f"{TAG} Neither (No Merger & No Tidal Debris) ", "neither (no merger & no tidal debris)"),
        ("![x.png](https://host/x.png) Features or Disk", "features or disk"),
        (f"{TAG} no bar", "no bar"),
        ("hello world", "hello world"),
        ("'Hello' ", "hello' "[:-1]),
        ("round [sic]", None),
        (f"{TAG} Two\nlines", "two\nlines"),
        ("   ", ""),
        (None, None),
    ],
)
def test_sanitise(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "value string")
    assert df.select(text.sanitise(F.col("value"))).first()[0] == clean


def test_blank_and_labels(spark):
    df = spark.createDataFrame([("  ",), ("",), (" a b ",)], "v string")
    assert [r[0] for r in df.select(text.is_blank(F.col("v"))).collect()] == [True, True, False]
    assert df.select(text.underscored(F.col("v"))).collect()[2][0] == "_a_b_"


def test_url_names(spark):
    df = spark.createDataFrame([("https://h/a/b/c.jpg?x=1#y",), ("not a url",)], "u string")
    assert [r[0] for r in df.select(text.url_file_name(F.col("u"))).collect()][0] == "c.jpg"
    assert df.select(text.rerooted(F.col("u"), "data/")).first()[0] == "data/c.jpg"


def test_times(spark):
    df = spark.createDataFrame([("2018-02-20 10:44:42 UTC", "2019-07-18T20:25:12.394Z", "2024-12-30")], "a string, b string, c string")
    row = df.select(
        times.api_time(F.col("a")).alias("api"),
        F.unix_millis(times.to_utc(F.col("b"))).alias("millis"),
        times.week_key(F.col("c").cast("timestamp")).alias("week"),
        times.month_key(F.col("c").cast("timestamp")).alias("month"),
    ).first()
    assert tuple(row) == ("2018-02-20T10:44:42Z", 1563481512394, "2025-1", "2024-12")


def test_adler_ids(spark):
    data = [("1", "smooth", "yes"), ("ü1", "q€", None), (None, None, None), ("", "", "")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    found = [r[0] for r in df.select(ids.response_id(F.col("a"), F.col("b"), F.col("c"), "adler32")).collect()]
    marks = ("error_x", "error_y", "error_z")
    expected = [str(zlib.adler32("".join(m if v is None else v for v, m in zip(row, marks)).encode())) for row in data]
    assert found == expected
    wide = df.select(ids.response_id(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert len({r[0] for r in wide}) == 4


def test_person_ids(spark):
    data = [("290475.0", "1.1.1.1"), ("12", None), (None, "2.2.2.2"), (None, None), ("0", "3.3.3.3")]
    df = spark.createDataFrame(data, "u string, ip string")
    found = df.select(ids.person_id(F.col("u"), F.col("ip")), ids.account_or_address(F.col("u"), F.col("ip"))).collect()
    assert [r[0] for r in found] == ["290475", "12", "ip_2.2.2.2", None, "0"]
    assert [r[1] for r in found] == ["290475", "12", "2.2.2.2", None, "3.3.3.3"]


def test_arg_max_ties_zero_null_and_single(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 0, 0), (None, 2, 1), (0, 1, 3)], "a int, b int, c int")
    counts = [F.col(n) for n in "abc"]
    best = [r[0] for r in df.select(votes.arg_max(["x", "y", "z"], counts)).collect()]
    assert best == ["x", "x", "y", "z"]
    sure = [r[0] for r in df.select(votes.confidence(counts)).collect()]
    assert sure == pytest.approx([0.5, 1 / 3, 2 / 3, 0.75])
    alone = df.select(votes.arg_max(["x"], counts[:1]), votes.confidence(counts[:1])).collect()
    assert [tuple(r) for r in alone] == [("x", 1.0), ("x", 1.0), ("x", 1.0), ("x", 1.0)]


def test_label_code(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "p string")
    assert [r[0] for r in df.select(votes.label_code(F.col("p"), ["b", "a"])).collect()] == [1, 0, None]
    with pytest.raises(Exception, match="unknown answer"):
        df.select(votes.label_code(F.col("p"), ["a"])).collect()


def test_wilson_interval(spark):
    cases = [(k, 20) for k in range(21)] + [(0, 40), (40, 40), (0, 0)]
    df = spark.createDataFrame(cases, "k int, n int")
    for interval in (0.8, 0.9, 0.95):
        low, high = votes.wilson_interval(F.col("k"), F.col("n"), interval)
        width = votes.wilson_width(F.col("k"), F.col("n"), interval)
        z = NormalDist().inv_cdf(0.5 + interval / 2)
        for (k, n), row in zip(cases, df.select(low, high, width).collect()):
            if n == 0:
                assert tuple(row) == (None, None, None)
                continue
            # the bounds are the roots of (p - k/n)^2 = z^2 p (1-p) / n
            for bound in row[:2]:
                assert (bound - k / n) ** 2 == pytest.approx(z * z * bound * (1 - bound) / n, abs=1e-12)
            assert -1e-12 <= row[0] <= k / n + 1e-12 and k / n - 1e-12 <= row[1] <= 1 + 1e-12
            assert row[2] == pytest.approx(row[1] - row[0])
    assert df.select(votes.wilson_interval(F.lit(1), F.lit(2))[0]).first()[0] == pytest.approx(0.16425, abs=1e-5)


def test_bernoulli_and_vectors(spark):
    df = spark.createDataFrame([(1, 4)], "k int, n int")
    k, n = F.col("k"), F.col("n")
    row = df.select(votes.bernoulli_mean(k, n), votes.bernoulli_variance(k, n), votes.vote_vector(k, n)).first()
    assert tuple(row) == (0.25, 0.25 * 0.75 / 4, [1, 0, 0, 0])


def test_first_member_and_keys(spark):
    cell = json.dumps({"77": {"!iauname": "J1", "ra": "1.5", "deep": {"id": 3}}})
    df = spark.createDataFrame([(cell,)], "s string")
    member = jsons.first_member(F.col("s"))
    row = df.select(
        jsons.first_present(member, ["iauname", "!iauname"]),
        jsons.first_present(member, ["none"]),
        jsons.first_present_nested(member, "deep", ["!id", "id"]),
    ).first()
    assert tuple(row) == ("J1", None, "3")


def test_first_member_without_its_key(spark):
    cells = [' { "5" : {"a":"1"},"0":{"a":"2"}}', '{"0":{"a":"9"},"0":{"b":"3"}}', '{"a\\"b":{"x":"$1"}}', "{'5':{'a':'1'}}", '{"5":null}', None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cells)], "i int, s string")
    found = df.select("i", jsons.first_member(F.col("s")).alias("m"))
    assert [r.m for r in found.orderBy("i").collect()] == [{"a": "1"}, {"a": "9"}, {"x": "$1"}, {"a": "1"}, None, None]
    # names differ from row to row, and every new one makes the parser copy its table of names
    renamed = df.select("i", F.regexp_replace("s", jsons.FIRST_KEY, '$1"0"').alias("s")).orderBy("i").first()
    assert renamed.s == ' { "0" : {"a":"1"},"0":{"a":"2"}}'
    assert "regexp_replace" in found._jdf.queryExecution().analyzed().toString()


def test_whole_numbers_with_a_point(spark):
    cells = ["12.0", " 12 ", "+.5", "a.b", "1e3", "9007199254740993", "9007199254740993.0", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cells)], "i int, s string")
    found = df.select("i", ids.whole_number(F.col("s")).alias("n"))
    assert [r.n for r in found.orderBy("i").collect()] == ["12", "12", "0", None, "1000", "9007199254740993", "9007199254740992", None, None]
    assert "Contains(s" in found._jdf.queryExecution().analyzed().toString()


def test_export_annotations(spark):
    cell = json.dumps(
        [
            {"task": "T0", "task_label": "Smooth?", "value": "yes"},
            {"task": "T10", "task_label": "Do you see any of these rare features in the image?", "value": ["ring"]},
            {"task": "T5", "value": None},
        ]
    )
    df = spark.createDataFrame([(cell,)], "s string")
    parsed = jsons.export_annotations(F.col("s"), ["Do you see any of these rare features"])
    rows = df.select(F.inline(parsed)).select("task_id", "value", "multiple_choice")
    assert rows_of(rows) == [("T0", "yes", False), ("T10", '["ring"]', True), ("T5", None, False)]


@pytest.mark.parametrize(
    "parse, good, bad",
    [
        (jsons.string_map, '{"a": "1"}', '{"a": "1'),
        (jsons.first_member, '{"5": {"a": "1"}}', '{"5": {"a"'),
        (jsons.browser_metadata, '{"source": "api"}', '{"source": '),
        (lambda cell: jsons.export_annotations(cell, []), '[{"task": "T0", "value": "x"}]', '[{"task": "T0", "val'),
    ],
)
def test_damaged_cells_raise(spark, parse, good, bad):
    cells = lambda *texts: spark.createDataFrame([(t,) for t in texts], "cell string").select(parse(F.col("cell")).alias("x"))
    assert [r.x is None for r in cells(good, None).collect()] == [False, True]
    with pytest.raises(Exception, match="(?i)malformed"):
        cells(good, bad).collect()


def test_damaged_lists_raise(spark):
    strings = F.create_map(*[F.lit(x) for pair in (("T0.question", "q"), ("T0.answers.0.label", "a")) for x in pair])
    labelled = lambda value: spark.createDataFrame([([("T0", value)],)], "x array<struct<task:string,value:string>>").select(
        jsons.labelled_annotations(F.col("x"), strings).alias("y")
    )
    assert [labelled(v).first().y[0].value for v in ("0", "[0]")] == ["a", '["a"]']
    with pytest.raises(Exception, match="(?i)malformed"):
        labelled("[0, ").collect()
