import json
from datetime import datetime, timedelta, timezone

import pytest

from pollfold.plans.subjects import current_subjects, subjects_from_export, subjects_from_raw
from pollfold.sources import chunks, readers, rejects, writers
from tests.conftest import rows_of


def chunk(path, first, last):
    path.write_text("\n".join(json.dumps({"id": str(i)}) for i in range(first, last + 1)))


def test_chunk_files_and_cursor(spark, tmp_path):
    chunk(tmp_path / "api_chunk_first.txt", 25810000, 25810020)
    chunk(tmp_path / "api_chunk_second.txt", 25810021, 25810095)
    chunk(tmp_path / "api_chunk_derived_first.txt", 1, 3)
    chunk(tmp_path / "other.txt", 99999999, 99999999)
    raw = readers.read_chunks(spark, str(tmp_path), "api_chunk")
    assert rows_of(readers.chunk_ids(raw), "first_id", "last_id") == [(25810000, 25810020), (25810021, 25810095)]
    assert readers.last_id(raw).first()[0] == 25810095
    derived = readers.read_chunks(spark, str(tmp_path), "api_chunk", derived=True)
    assert readers.last_id(derived).first()[0] == 3
    assert readers.last_id(raw.filter("false")).first()[0] == readers.FIRST_ID
    following = readers.next_records(raw, 25810090, 3)
    assert rows_of(following, "id") == [("25810091",), ("25810092",), ("25810093",)]
    assert readers.next_records(raw, 25810090).count() == 5
    assert readers.next_records(raw, 25810090, 0).count() == 0
    assert readers.next_records(raw, 25810090, 10**10).count() == 5


@pytest.mark.parametrize("most, found", [(1, 2), (2, 2), (3, 5), (5, 5), (6, 6), (7, 6)])
def test_next_records_keep_repeated_ids(spark, most, found):
    ids = [9007199254740993] * 2 + [9007199254740994] * 3 + [9007199254740996, 5, None]
    records = spark.createDataFrame([(i, "x") for i in ids], "id long, v string")
    assert readers.next_records(records, 100, most).count() == found


def test_announced_version_count(spark):
    raw = spark.createDataFrame([("1", "2", ("9",), {})], readers.WORKFLOW_VERSION)
    with pytest.raises(ValueError, match="2 announced"):
        readers.workflow_versions(raw, expected=2)


def test_bounded_files_are_complete(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_bounded_json(spark.range(1000).coalesce(1), path, per_file=300)
    files = list((tmp_path / "out").glob("*.json"))
    assert sorted(len(f.read_text().splitlines()) for f in files) == [100, 300, 300, 300]


def test_json_sink_refuses_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_json(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_json(spark.range(3), path)
    writers.write_json(spark.range(5), path, mode="overwrite")
    assert spark.read.json(path).count() == 5


def test_csv_round_trip_with_json_cells(spark, tmp_path):
    df = spark.createDataFrame([("007", '{"a":"x, \\"y\\""}')], "id string, cell string")
    writers.write_csv(df, str(tmp_path / "csv"))
    assert rows_of(readers.read_csv(spark, str(tmp_path / "csv"))) == rows_of(df)
    writers.write_csv(df, None)


def test_compressed_text_is_small_and_in_bounded_files(spark, tmp_path, monkeypatch):
    """Compressed files are not split by readers, so that each holds a bounded number of rows."""
    monkeypatch.setattr(writers, "PER_FILE", 300)
    rows = spark.range(1000).coalesce(1).selectExpr("cast(id AS string) AS id", "repeat('a, \"b\"', 20) AS cell")
    for write, read, kind in (
        (writers.write_csv, lambda path: readers.read_csv(spark, path), "csv"),
        (writers.write_json, lambda path: readers.read_json(spark, path, "id string, cell string"), "json"),
    ):
        size = {}
        for compression in (None, "snappy"):
            path = tmp_path / f"{kind}-{compression}"
            write(rows, str(path), compression=compression)
            files = [f for f in path.iterdir() if f.name.startswith("part-")]
            size[compression] = sum(f.stat().st_size for f in files)
            assert rows_of(read(str(path))) == rows_of(rows)
        assert sorted(f.suffix for f in files) == [".snappy"] * 4
        assert 5 * size["snappy"] < size[None]


def test_damaged_csv_stops_or_is_set_aside(spark, tmp_path):
    path = tmp_path / "damaged.csv"
    path.write_text('id,n,note\n1,2,"a, b"\nabc,3,x\n4,5\n6,7,y,z\n8,,\n')
    schema = "id bigint, n int, note string"
    for read in (readers.read_csv, lambda *a, **k: readers.read_csv(*a, **k).select("note")):  # whatever columns are asked for
        with pytest.raises(Exception, match="(?i)malformed"):
            read(spark, str(path), schema=schema).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_subject_export(spark, str(path)).collect()
    headless = tmp_path / "headless.csv"
    headless.write_text("1,2,x\nabc,3,x\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_shards(spark, str(headless), schema).collect()
    found = rejects.routed(readers.csv_records(spark, str(path), schema), str(tmp_path / "routed"), "export")
    assert rows_of(found.accepted) == [(1, 2, "a, b"), (8, None, None)]
    assert rows_of(found.rejected, "file_name", "record") == [("damaged.csv", "4,5"), ("damaged.csv", "6,7,y,z"), ("damaged.csv", "abc,3,x")]
    assert (found.n_accepted, found.n_rejected) == (2, 3)


def test_damaged_cells_leave_with_their_row(spark, tmp_path):
    rows = [("a", '[{"task":"T0"}]', '{"x":1}'), ("b", '[{"task":', '{"x":1}'), ("c", None, "{"), ("d", " ", "null"), ("e", "[{", "nope")]
    cells = spark.createDataFrame(rows, "id string, annotations string, metadata string")
    checked = rejects.checked_cells(cells, {"annotations": "array<struct<task:string>>", "metadata": "struct<x:int>"})
    assert rows_of(rejects.accepted(checked), "id") == [("a",), ("d",)]
    assert rows_of(rejects.rejected(checked, "t"), "reason") == [("annotations",), ("annotations, metadata",), ("metadata",)]
    assert rejects.accepted(checked).columns == cells.columns


def test_chunk_index_opens_new_files_only(spark, tmp_path):
    folder, index, schema = tmp_path / "raw", str(tmp_path / "index"), "id string"
    folder.mkdir()
    assert chunks.index_cursor(spark, index) == readers.FIRST_ID
    chunk(folder / "api_a.json", 100, 199)
    chunk(folder / "api_b.json", 200, 299)
    chunk(folder / "api_derived_a.json", 1, 9)
    assert chunks.update_index(spark, str(folder), index, "api", schema=schema) == 2
    assert chunks.update_index(spark, str(folder), index, "api", schema=schema) == 0
    chunk(folder / "api_c.json", 250, 320)
    assert chunks.update_index(spark, str(folder), index, "api", schema=schema) == 1
    assert rows_of(chunks.read_index(spark, index), "file_name", "first_id", "last_id", "records") == [
        ("api_a.json", 100, 199, 100),
        ("api_b.json", 200, 299, 100),
        ("api_c.json", 250, 320, 71),
    ]
    found = chunks.pull(spark, index, 199, schema=schema)
    assert sorted(name.rsplit("/", 1)[1] for name in found.inputFiles()) == ["api_b.json", "api_c.json"]
    assert found.count() == 171
    assert rows_of(chunks.pull(spark, index, 199, 2, schema)) == [("200",), ("201",)]
    assert chunks.pull(spark, index, chunks.index_cursor(spark, index), schema=schema).count() == 0


def test_freshness_gate(spark, tmp_path):
    runs = []

    def compute():
        runs.append(1)
        return spark.range(len(runs))

    folder, start = str(tmp_path / "gate"), datetime(2024, 1, 1, tzinfo=timezone.utc)
    gate = lambda hours, age=timedelta(hours=1): writers.fresh_or_recomputed(
        spark, folder, compute, age, now=start + timedelta(hours=hours)
    ).count()
    assert gate(0) == 1
    assert gate(0.5) == 1
    assert gate(2) == 2
    assert gate(2.1) == 2
    assert gate(2.2, None) == 3
    assert len(list((tmp_path / "gate").glob("table-*"))) == 3
    assert gate(30) == 4  # the table before may still be read, those replaced a day ago go
    assert len(list((tmp_path / "gate").glob("table-*"))) == 2
    assert gate(30.1) == 4


def subject(number, metadata, locations, workflow="6122"):
    return (str(number), "5733", workflow, "60", json.dumps(metadata), json.dumps(locations), 3, None, None)


def test_subject_export(spark):
    data = [
        subject(1, {"!iauname": "J013703.16+004648.0", "#uploader": "team", "plain": "x"}, {"0": "https://h/1.png"}),
        subject(1, {"!iauname": "J013703.16+004648.0", "#uploader": "team", "plain": "x"}, {"0": "https://h/1.png"}),
        subject(2, {"!iauname": "old", "#iauname": "new"}, {"0": "https://h/2.png", "1": "https://h/2b.png"}, "7"),
    ]
    export = spark.createDataFrame(data, readers.SUBJECT_EXPORT)
    assert rows_of(subjects_from_export(export), "subject_id", "subject_url", "iauname", "uploader") == [
        ("1", "https://h/1.png", "J013703.16+004648.0", "team"),
        ("2", "https://h/2.png", "new", None),
    ]
    current = current_subjects(export, workflow="6122")
    assert current.select("iauname", "locations", "plain").first() == ("J013703.16+004648.0", "https://h/1.png", "x")
    assert "retired_at" not in current.columns and "!iauname" not in current.columns
    odd = spark.createDataFrame([*data, subject(1, {}, {"0": "https://h/other.png"})], readers.SUBJECT_EXPORT)
    with pytest.raises(Exception, match="different rows: 1"):
        subjects_from_export(odd).collect()
    imageless = spark.createDataFrame([subject(3, {}, {})], readers.SUBJECT_EXPORT)
    with pytest.raises(Exception, match="without image"):
        subjects_from_export(imageless).collect()


def test_subjects_from_raw_keep_one_row(spark):
    links = lambda i, url: ("p", "u", "w", (i, [{"image/png": url}], {"!iauname": f"J{i}"}))
    data = [(str(n), "t", [], ("1.1",), links(i, url)) for n, (i, url) in enumerate([("a", "x"), ("a", "x"), ("b", "y")])]
    raw = spark.createDataFrame(data, readers.API_RECORD)
    assert rows_of(subjects_from_raw(raw, ["w"]), "subject_id", "iauname", "subject_url") == [("a", "Ja", "x"), ("b", "Jb", "y")]
    assert subjects_from_raw(raw, ["other"]).count() == 0
