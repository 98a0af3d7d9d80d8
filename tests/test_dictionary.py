from pollfold.dictionaries import BUILT_IN, COSMIC_DAWN, DR2, EUCLID, UKIDSS
from pollfold.dictionary import MASK_BITS, QuestionSet


def test_column_names(tree):
    assert tree.count_columns == [
        "question-0_features-or-disk",
        "question-1_round",
        "question-2_no",
        "question-9_no",
        "question-9_yes",
    ]
    assert tree.raw_count_columns[-1] == "T9_yes"
    question = tree.question("question-9")
    assert question is tree.question_from_raw("T9")
    assert question.total_votes == "question-9_total-votes"
    answer = question.answer("yes")
    assert question.fraction_column(answer) == "question-9_yes_fraction"
    assert (question.min_column(answer), question.max_column(answer)) == ("question-9_yes_min", "question-9_yes_max")
    assert question.answer_from_count_column("question-9_yes") is answer
    assert question.answer_from_raw("yes") is answer
    assert question.prediction_conf == "question-9_prediction-conf"
    assert question.prediction_encoded == "question-9_prediction-encoded"


def test_built_in_dictionaries():
    assert {k: len(d.questions) for k, d in BUILT_IN.items()} == {
        "dr5": 10,
        "cosmic_dawn": 13,
        "euclid": 13,
        "jwst_ceers": 12,
        "jwst_cosmos": 12,
        "ukidss": 10,
        "dr2": 10,
        "judges": 1,
        "judges_v2": 1,
    }
    assert set(EUCLID.count_columns) - set(COSMIC_DAWN.count_columns) == {"artifact_ghost"}
    assert UKIDSS.question("bulge-size").answer_from_raw("a-3").name == "dominant"
    assert DR2.question_from_raw("decals-9").answer_names == ["merger", "tidal-debris", "both", "neither"]
    for dictionary in BUILT_IN.values():
        assert len(set(dictionary.count_columns)) == len(dictionary.count_columns)


def test_lookup_has_one_bit_per_answer(spark):
    rows = EUCLID.lookup(spark).collect()
    assert len(rows) == len(EUCLID.count_columns)
    assert len({(r.word, r.mask) for r in rows}) == len(rows)
    assert [r.raw_task for r in rows if r.value == "ghost"] == ["T15"]


def test_repeated_question_name_is_rejected():
    import pytest

    with pytest.raises(ValueError):
        QuestionSet.build(("T0", "q", {"a": "a"}), ("T1", "q", {"a": "a"}))


def test_mask_words():
    many = QuestionSet.build(("T0", "q", {str(i): str(i) for i in range(MASK_BITS + 5)}))
    assert many.mask_words == 2
    assert many.mask_bit(many.count_columns[-1]) == (1, 4)
