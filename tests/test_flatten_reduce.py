import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pollfold.dictionary import MASK_BITS, QuestionSet
from pollfold.functions.columns import c
from pollfold.plans.flatten import clean_annotations, flatten
from pollfold.plans.predict import predict, votes_to_predictions
from pollfold.plans.reduce import reduce_responses, reduce_votes
from pollfold.plans.votes import one_hot_votes, remove_rare_answers, responses_to_votes
from pollfold.operators.shaping import rename_raw_counts
from tests.conftest import rows_of

TAG = "![x.png](https://host/x.png =60x) "
KEEP = ["classification_id", "created_at", "user_id", "subject_id"]
ANNOTATION = "array<struct<task:string,value:string,task_label:string,task_id:string,value_index:string,multiple_choice:boolean>>"
SCHEMA = f"classification_id string, created_at string, user_id string, subject_id string, workflow_version string, annotations {ANNOTATION}"


def annotation(task, value, many=False):
    return (task, value, "label", task, None, many)


def golden(spark):
    first = [annotation("T0", TAG + "Features or Disk"), annotation("T2", "No"), annotation("T9", "Yes")]
    second = [
        annotation("T1", TAG + "Completely Round"),
        annotation("T2", "No"),
        annotation("T9", "No"),
        annotation("T9", ""),
        annotation("T0", None),
    ]
    data = [
        ("c1", "2019-01-01 00:00:00 UTC", "a", "s1", "70.1", first),
        ("c2", "2019-01-02 00:00:00 UTC", "b", "s1", "70.1", second),
    ]
    return spark.createDataFrame(data, SCHEMA)


def flat(df, tree, **options):
    return flatten(df, tree, keep=KEEP, **{"id_kind": None, **options})


EXPECTED = [
    ("c1", "question-0", "features-or-disk"),
    ("c1", "question-2", "no"),
    ("c1", "question-9", "yes"),
    ("c2", "question-1", "round"),
    ("c2", "question-2", "no"),
    ("c2", "question-9", "no"),
]


def test_golden_responses_votes_and_reduction(spark, tree):
    responses = flat(golden(spark), tree)
    assert rows_of(responses, "classification_id", "question", "response") == EXPECTED
    votes = responses_to_votes(responses, tree)
    found = {r["classification_id"]: tuple(r[n] for n in tree.count_columns) for r in votes.collect()}
    assert found == {"c1": (1, 0, 1, 0, 1), "c2": (0, 1, 1, 1, 0)}
    row = reduce_responses(responses, tree).first()
    assert [row[n] for n in tree.count_columns] == [1, 1, 2, 1, 1]
    assert row["question-9_total-votes"] == 2 and row["question-9_yes_fraction"] == 0.5
    # the two routes to the reduced table agree
    by_votes = reduce_votes(votes, tree).first()
    assert by_votes.asDict() == row.asDict()


def test_start_date_is_exclusive(spark, tree):
    df = golden(spark)
    assert {r[0] for r in flat(df, tree, start="2019-01-01").select("classification_id").collect()} == {"c2"}
    kept = flat(df, tree, start="2019-01-01", start_inclusive=True)
    assert {r[0] for r in kept.select("classification_id").collect()} == {"c1", "c2"}


def test_unknown_answers(spark, tree):
    df = golden(spark).withColumn(
        "annotations", F.array_append("annotations", F.struct(*[F.lit(v).alias(n) for n, v in zip(
            ["task", "value", "task_label", "task_id", "value_index", "multiple_choice"],
            ["T9", "perhaps", "l", "T9", "0", False],
        )]))
    )
    with pytest.raises(Exception, match="not in the dictionary: T9 / perhaps"):
        flat(df, tree).collect()
    assert rows_of(flat(df, tree, on_unknown="drop"), "classification_id", "question", "response") == EXPECTED
    assert flat(df, tree, on_unknown="keep").filter("response is null").count() == 2
    with pytest.raises(ValueError):
        flat(df, tree, on_unknown="ignore")


def test_multiple_choice_excluded_tasks_and_malformed_tags(spark, tree):
    rows = [
        annotation("T9", "yes"),
        annotation("T2", '["no"]', True),
        annotation("T2", "no", None),
        annotation("T1", "completely round [odd]"),
        annotation("T0", "features or disk"),
    ]
    df = spark.createDataFrame([("c", "2020-01-01", "u", "s", "1.0", rows)], SCHEMA)
    found = flat(df, tree, exclude_tasks=["T0"])
    assert rows_of(found, "question", "response") == [("question-9", "yes")]


def test_old_wording_goes_before_its_answers_are_looked_up(spark):
    merging = QuestionSet.build(("T11", "merging", {"none": "none"}), ("T0", "first", {"none": "none"}))
    data = [
        (v, "2020-01-01", "u", "s", v, [annotation("T11", a), annotation("T0", "none")])
        for v, a in [("66.424", "tidal debris"), ("66.425", "None"), ("66.5", "None"), ("7.1", "neither")]
    ]
    df = spark.createDataFrame(data, SCHEMA)
    found = flatten(df, merging, keep=[*KEEP, "workflow_version"], id_kind=None)
    assert rows_of(found.filter("question = 'merging'"), "classification_id") == [("66.425",), ("66.5",)]
    assert found.filter("question = 'first'").count() == 4


def test_clean_annotations_on_exports(spark, tree):
    df = spark.createDataFrame([("c", "T9", " Yes"), ("c", "T9", "  "), ("c", None, "x"), ("c", "T9", None)], "classification_id string, task string, value string")
    assert rows_of(clean_annotations(df, tree), "question", "response") == [("question-9", "yes")]


def brute_force(rows, dictionary):
    """rows of (subject, classification, question, response)."""
    counts = defaultdict(Counter)
    for subject, classification, question, response in {r for r in rows if r[0] is not None}:
        counts[subject][f"{question}_{response}"] += 1
    return {s: [n[col] for col in dictionary.count_columns] for s, n in counts.items()}


@pytest.mark.parametrize("answers", [3, MASK_BITS + 7])
def test_reduce_against_brute_force(spark, answers):
    """Hot subject, copies, null subjects and unknown answers; also a dictionary of more than one mask word."""
    dictionary = QuestionSet.build(
        ("T0", "q", {str(i): f"a{i}" for i in range(answers)}), ("T1", "r", {"x": "x", "never": "never"})
    )
    rng = random.Random(5)
    rows = []
    for i in range(2000):
        subject = rng.choice(["hot"] * 5 + [f"s{j}" for j in range(40)] + [None])
        rows.append((subject, f"c{i}", "q", f"a{rng.randrange(answers + 1)}"))
        if rng.random() < 0.5:
            rows.append((subject, f"c{i}", "r", "x"))
    rows += rows[:700]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "subject_id string, classification_id string, question string, response string")
    found = {r["subject_id"]: r for r in reduce_responses(df, dictionary).collect()}
    expected = brute_force(rows, dictionary)
    assert {s: [r[n] for n in dictionary.count_columns] for s, r in found.items()} == expected
    for row in found.values():
        for q in dictionary.questions:
            total = row[q.total_votes]
            assert total == sum(row[n] for n in q.count_columns)
            assert sum(row[n] for n in q.fraction_columns) == pytest.approx(1.0 if total else 0.0)
    other = df.orderBy(F.rand(3)).dropDuplicates()
    assert {r["subject_id"]: r for r in reduce_responses(other, dictionary).collect()} == found
    empty = reduce_responses(df.filter("question = 'r'"), dictionary, null_fraction=True).first()
    assert empty["q_a0_fraction"] is None and empty["r_never_fraction"] == 0.0


def test_drop_people(spark, tree):
    data = [("s", f"c{p}", p, "question-9", "yes") for p in "abc"] + [("s", "c0", None, "question-9", "yes")]
    df = spark.createDataFrame(data, "subject_id string, classification_id string, person_id string, question string, response string")
    count = lambda people: reduce_responses(df, tree, drop_people=people).first()["question-9_yes"]
    assert count(()) == 4 and count(["a", "b"]) == 2
    assert count(spark.createDataFrame([("a",), ("b",)], "person_id string")) == 2


CODED = QuestionSet.build(
    ("T12", "question-12", {"a-0": "answer-0", "a-1": "answer-1"}),
    ("T13", "question-13", {"b-0": "answer-b", "b-1": "answer-a", "b-2": "answer-c"}),
)


def test_sum_reduce_and_predictions(spark):
    names = CODED.count_columns
    data = [("one", 1, 0, 1, 0, 0), ("one", 0, 1, 0, 0, 0), ("two", 0, 1, None, 0, 0)]
    votes = spark.createDataFrame(data, ", ".join(["subject_id string"] + [f"`{n}` int" for n in names]))
    reduced = {r["subject_id"]: r for r in reduce_votes(votes, CODED).collect()}
    assert [reduced["one"][n] for n in names] == [1, 1, 1, 0, 0]
    assert [reduced["two"][n] for n in names] == [0, 1, 0, 0, 0]
    predicted = {r["subject_id"]: r for r in votes_to_predictions(votes, CODED, interval=0.8).collect()}
    one, two = predicted["one"], predicted["two"]
    assert (one["question-12_prediction"], one["question-12_prediction-conf"]) == ("answer-0", 0.5)
    assert (one["question-13_prediction"], one["question-13_prediction-conf"]) == ("answer-b", 1.0)
    assert (two["question-12_prediction"], two["question-12_prediction-conf"]) == ("answer-1", 1.0)
    assert two["question-13_prediction"] == "answer-b" and two["question-13_prediction-conf"] == pytest.approx(1 / 3)
    # codes are alphabetical, predictions follow the listed order
    assert [one["question-12_prediction-encoded"], one["question-13_prediction-encoded"]] == [0, 1]
    assert two["question-12_prediction-encoded"] == 1
    assert one["question-12_answer-0_min"] == pytest.approx(0.16425, abs=1e-5)
    assert two["question-13_answer-a_min"] is None


def test_predict_keeps_other_columns(spark):
    df = spark.createDataFrame([("s", 1, 2, 0, 0, 0)], ", ".join(["id string"] + [f"`{n}` int" for n in CODED.count_columns]))
    assert predict(df, CODED).select("id", c("question-12_prediction")).first() == ("s", "answer-1")


def test_one_hot_and_rename(spark):
    df = spark.createDataFrame([("a-0", None), (None, "b-1"), (None, "b-0")], "T12 string, T13 string")
    votes = one_hot_votes(df, CODED)
    assert [tuple(r) for r in votes.select(*[c(n) for n in CODED.raw_count_columns]).collect()] == [
        (1, 0, 0, 0, 0),
        (0, 0, 0, 1, 0),
        (0, 0, 1, 0, 0),
    ]
    assert rename_raw_counts(votes, CODED).columns[2:] == CODED.count_columns


def test_rare_answers_follow_the_sequence(spark):
    data = [("a-0", "b-0")] * 80 + [("a-1", None)] * 15 + [("a-9", "b-1")] * 3 + [(None, "b-2")] * 3 + [("a-8", "b-0")] * 3
    df = spark.createDataFrame(data, "T12 string, T13 string")

    def sequence(rows, share):
        for i in (0, 1):
            counts = Counter(r[i] for r in rows if r[i] is not None)
            rarest = min(counts, key=lambda a: (counts[a], a))
            if counts[rarest] < len(rows) * share:
                rows = [r for r in rows if r[i] != rarest]
        return Counter(rows)

    for share in (0.0001, 0.02, 0.04, 0.5):
        found = remove_rare_answers(df, CODED, share)
        assert Counter(tuple(r) for r in found.collect()) == sequence(data, share), share
    everything = remove_rare_answers(df, CODED, 0.04, all_rare=True)
    assert Counter(tuple(r) for r in everything.collect()) == Counter([("a-0", "b-0")] * 80 + [("a-1", None)] * 15)
