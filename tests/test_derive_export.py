import csv
import json

import pytest
from pyspark.sql import functions as F

from pollfold.operators.joins import lookup_join, with_version
from pollfold.functions.jsons import labelled_annotations
from pollfold.plans.derive import derive
from pollfold.plans.export import export_to_classifications, export_to_responses
from pollfold.sources import readers
from tests.conftest import rows_of

STRINGS = {
    "T0.question": "Smooth?",
    "T0.answers.0.label": "Smooth",
    "T0.answers.1.label": "Features",
    "T10.question": "Rare?",
    "T10.answers.0.label": "Ring",
    "T10.answers.2.label": "Lens",
}


@pytest.fixture
def versions(spark):
    data = [("1", "2", ("9",), STRINGS), ("1", "3", ("9",), {**STRINGS, "T0.answers.0.label": "Round"})]
    return readers.workflow_versions(spark.createDataFrame(data, readers.WORKFLOW_VERSION), expected=2)


def record(number, version, annotations, workflow="9"):
    return json.dumps(
        {
            "id": str(number),
            "created_at": "2019-07-18T20:25:12.394Z",
            "annotations": annotations,
            "metadata": {"workflow_version": version, "session": "x"},
            "links": {
                "project": "5733",
                "user": "7",
                "workflow": workflow,
                "subject": {"id": "s1", "metadata": {"!iauname": "J1"}, "locations": [{"image/png": "https://h/1.png"}]},
            },
        }
    )


def raw(spark, tmp_path, *records):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(records))
    return readers.read_json(spark, str(folder))


def test_labels_by_version(spark, tmp_path, versions):
    df = raw(
        spark,
        tmp_path,
        record(1, "1.2", [{"task": "T0", "value": 0}, {"task": "T10", "value": [0, 2]}]),
        record(2, "1.3", [{"task": "T0", "value": 0}]),
        record(3, "1.3", [{"task": "T0", "value": 0}], workflow="8"),
    )
    out = derive(df, versions, ["9"])
    assert out.select("workflow_major_version", "workflow_minor_version", "iauname", "person_id").first() == ("1", "2", "J1", "7")
    rows = rows_of(out.select("classification_id", F.inline("annotations")))
    assert rows == [
        ("1", "T0", "Smooth", "Smooth?", "T0", "0", False),
        ("1", "T10", '["Ring","Lens"]', "Rare?", "T10", "[0,2]", True),
        ("2", "T0", "Round", "Smooth?", "T0", "0", False),
    ]


def test_null_values(spark, tmp_path, versions):
    df = raw(
        spark,
        tmp_path,
        record(1, "1.2", [{"task": "T0", "value": None}, {"task": "T0", "value": 1}]),
        record(2, "1.2", [{"task": "T0"}]),
        record(3, "1.2", [{"task": "T10", "value": []}]),
    )
    lenient = {r[0]: r[1] for r in derive(df, versions).select("classification_id", F.size("annotations")).collect()}
    assert lenient == {"1": 1, "2": 0, "3": 1}
    strict = {r[0]: r[1] for r in derive(df, versions, strict=True).select("classification_id", "annotations").collect()}
    assert strict["1"] is None and strict["2"] is None and strict["3"][0]["value"] == "[]"


def test_missing_versions_and_labels(spark, tmp_path, versions):
    df = raw(spark, tmp_path, record(1, "1.2", [{"task": "T0", "value": 0}]), record(2, "5.5", [{"task": "T0", "value": 0}]))
    with pytest.raises(Exception, match="no workflow version 9.5.5"):
        derive(df, versions).collect()
    assert rows_of(derive(df, versions, on_missing_version="drop"), "classification_id") == [("1",)]
    with pytest.raises(Exception, match="no label for T0.answers.7.label"):
        (tmp_path / "raw" / "part.json").write_text(record(1, "1.2", [{"task": "T0", "value": 7}]))
        derive(df, versions).collect()
    with pytest.raises(Exception, match="key repeats"):
        with_version(
            spark.createDataFrame([("c", "9", "1", "2")], "classification_id string, workflow_id string, workflow_major_version string, workflow_minor_version string"),
            versions.union(versions),
        ).collect()


def test_large_dimensions_join_by_salted_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("classification_id"), (F.col("id") % 7 % 3).alias("k"))
    dimension = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    for how in ("inner", "left"):
        small = lookup_join(df, dimension, ["k"], how, "classification_id")
        large = lookup_join(df, dimension, ["k"], how, "classification_id", max_rows=1)
        assert "__part" not in large.columns
        assert rows_of(small, "classification_id", "k", "name") == rows_of(large, "classification_id", "k", "name")
    assert "__part" in large._jdf.queryExecution().optimizedPlan().toString()


HEADER = [part.split()[0] for part in readers.CLASSIFICATION_EXPORT.split(", ")]


def write_export(path, rows):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(HEADER)
        writer.writerows(rows)


def export_row(number, user_id, ip, created, annotations, subject):
    return [
        number, "name", user_id, ip, "6122", "tree", "66.425", created, "", "",
        json.dumps({"source": "api", "viewport": {"width": 1, "height": 2}, "started_at": "2018-05-01T10:00:00.000Z",
                    "live_project": True, "interventions": {"opt_in": True}, "user_language": "en"}),
        json.dumps(annotations), json.dumps({"55": subject}), "55",
    ]


def test_export_scan_and_flatten(spark, tmp_path):
    tag = '![a "b".png](https://h/x.png =60x) '
    annotations = [
        {"task": "T0", "task_label": "Smooth?", "value": tag + "Smooth"},
        {"task": "T4", "task_label": "Bar?", "value": "No Bar"},
        {"task": "T10", "task_label": "Do you see any of these rare features?", "value": ["Ring"]},
        {"task": "T11", "task_label": "Merging?", "value": None},
    ]
    path = str(tmp_path / "export.csv")
    write_export(path, [
        export_row(1, "290475.0", "", "2018-03-20 12:00:00 UTC", annotations, {"iauname": "J1", "!iauname": "J2"}),
        export_row(2, "", "9.9.9.9", "2018-03-20 00:00:00 UTC", annotations, {"!IAUNAME": "J3"}),
    ])
    export = readers.read_classification_export(spark, path)
    classifications = export_to_classifications(export)
    assert rows_of(classifications, "person_id", "iauname", "project_id", "created_at") == [
        ("290475", "J1", "5733", "2018-03-20T12:00:00Z"),
        ("ip_9.9.9.9", "J3", "5733", "2018-03-20T00:00:00Z"),
    ]
    browser = classifications.select("metadata.*").first()
    assert browser["interventions"] == '{"opt_in":true}' and browser["viewport"]["width"] == "1"
    # the second one is not after the launch
    assert rows_of(export_to_responses(export), "classification_id", "question", "response") == [
        ("1", "bar", "no"),
        ("1", "smooth-or-featured", "smooth"),
    ]


def test_export_times_are_not_written_and_read_again(spark, tmp_path):
    answers = [{"task": "T0", "task_label": "Smooth?", "value": "Smooth"}]
    path = str(tmp_path / "export.csv")
    write_export(path, [export_row(1, "", "", "2018-03-20 12:00:00.75 UTC", answers, {"iauname": "J1"})])
    responses = export_to_responses(readers.read_classification_export(spark, path))
    assert rows_of(responses.select(F.col("created_at").cast("string"))) == [("2018-03-20 12:00:00",)]
    assert "date_format" not in responses._jdf.queryExecution().analyzed().toString()


def test_malformed_export_fails(spark, tmp_path):
    path = str(tmp_path / "export.csv")
    write_export(path, [["1", "2", "3", "4", "5", "6"]])
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_classification_export(spark, path).collect()


def test_index_lists_are_parsed_once(spark):
    strings = {"T0.question": "q", "T0.answers.0.label": "A", "T0.answers.12.label": 'B "b"'}
    values = [" [0, 12] ", "[]", " 12 ", None]
    rows = spark.createDataFrame([([("T0", v) for v in values], strings)], "a array<struct<task:string,value:string>>, s map<string,string>")
    labelled = rows.select(labelled_annotations(F.col("a"), F.col("s")).alias("l"))
    found = [(x.value, x.value_index, x.multiple_choice) for x in labelled.first().l]
    assert found == [('["A","B \\"b\\""]', "[0,12]", True), ("[]", "[]", True), ('B "b"', "12", False)]
    assert labelled._jdf.queryExecution().analyzed().toString().count("from_json") == 1
