"""JSON text cells and nested API records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ANNOTATION_TEXT = "array<struct<task:string,task_label:string,value:string>>"
DERIVED_ANNOTATIONS = (
    "array<struct<task:string,value:string,task_label:string,task_id:string,"
    "value_index:string,multiple_choice:boolean>>"
)
# the members that are objects stay JSON text
BROWSER_METADATA = (
    "source string, session string, viewport struct<width:string,height:string>, started_at timestamp, "
    "user_agent string, utc_offset string, finished_at timestamp, live_project boolean, interventions string, "
    "user_language string, subject_dimensions string, subject_selection_state string, "
    "workflow_translation_id string"
)

# the first key of an object, if it is written without escapes
FIRST_KEY = r'^([ \t\r\n]*\{[ \t\r\n]*)"[^"\\\x00-\x1F]*"'

# a damaged cell fails the job; permissive parsing would make it null and lose what it holds
STRICT = {"mode": "FAILFAST"}


def string_map(text: Column) -> Column:
    """JSON object as ``map<string,string>``; nested members stay JSON text."""
    return F.from_json(text, "map<string,string>", STRICT)


def first_member(text: Column) -> Column:
    """First value of a JSON object whose values are objects, as ``map<string,string>``.

    Subject data is an object with one member, keyed by the subject id. That key is not asked for and gets a fixed name, since
    the parser keeps a table of all names it meets and copies it whenever a new one comes.
    """
    named = F.regexp_replace(text, FIRST_KEY, '$1"0"')
    return F.element_at(F.map_values(F.from_json(named, "map<string,map<string,string>>", STRICT)), 1)


def first_present(members: Column, keys: Sequence[str]) -> Column:
    """Value of the first key that is present and not null."""
    return F.coalesce(*[F.try_element_at(members, F.lit(k)) for k in keys])


def first_present_nested(members: Column, outer: str, keys: Sequence[str]) -> Column:
    """Same, below a member that is itself an object."""
    return first_present(string_map(F.try_element_at(members, F.lit(outer))), keys)


def frame_url(locations: Column, frame: int = 0) -> Column:
    """URL of one image frame: locations is ``{"0": url, "1": url}`` as text."""
    return F.get_json_object(locations, f"$.{frame}")


def browser_metadata(text: Column) -> Column:
    return F.from_json(text, BROWSER_METADATA, STRICT)


def export_annotations(text: Column, multiple_choice_labels: Sequence[str]) -> Column:
    """Annotation cell of an export, in the shape of derived API annotations.

    A question is multiple choice when its label starts with one of ``multiple_choice_labels``; list
    values land as JSON text. A label that is missing counts as single choice.
    """
    parsed = F.from_json(text, ANNOTATION_TEXT, STRICT)

    def member(a: Column) -> Column:
        label = a["task_label"]
        flagged = F.lit(False)
        for start in multiple_choice_labels:
            flagged = flagged | F.coalesce(F.startswith(label, F.lit(start)), F.lit(False))
        return F.struct(
            a["task"].alias("task"),
            a["value"].alias("value"),
            label.alias("task_label"),
            a["task"].alias("task_id"),
            F.lit(None).cast("string").alias("value_index"),
            flagged.alias("multiple_choice"),
        )

    return F.transform(parsed, member)


def labelled_annotations(annotations: Column, strings: Column, strict: bool = False) -> Column:
    """Replace answer indices of API annotations by label text.

    ``annotations`` is ``array<struct<task, value>>`` with the value as JSON text: an index, a list of
    indices, or null. ``strings`` is the label map of the workflow version in force, with keys such as
    ``T0.question`` and ``T0.answers.0.label``.

    An annotation without task or value is dropped. With ``strict`` it voids the whole classification
    (null array) instead. A label that the version does not define raises.
    """

    def label(key: Column) -> Column:
        return F.coalesce(
            F.try_element_at(strings, key), F.raise_error(F.concat(F.lit("no label for "), key)).cast("string")
        )

    def answer(task: Column, index: Column) -> Column:
        return label(F.concat(task, F.lit(".answers."), index.cast("string"), F.lit(".label")))

    # what a member uses several times comes first, since nothing is shared inside a lambda
    def read(a: Column) -> Column:
        text = F.btrim(a["value"])
        indices = F.from_json(F.when(F.startswith(text, F.lit("[")), a["value"]), "array<int>", STRICT)
        return F.struct(a["task"].alias("task"), text.alias("text"), indices.alias("indices"))

    def member(a: Column) -> Column:
        task, text, indices = a["task"], a["text"], a["indices"]
        many = F.startswith(text, F.lit("["))
        numbers = F.array_join(F.transform(indices, lambda i: i.cast("string")), ",", "null")
        return F.struct(
            task.alias("task"),
            F.when(many, F.to_json(F.transform(indices, lambda i: answer(task, i)))).otherwise(answer(task, text)).alias("value"),
            label(F.concat(task, F.lit(".question"))).alias("task_label"),
            task.alias("task_id"),
            F.when(many, F.concat(F.lit("["), numbers, F.lit("]"))).otherwise(text).alias("value_index"),
            many.alias("multiple_choice"),
        )

    def incomplete(a: Column) -> Column:
        return a["task"].isNull() | a["value"].isNull()

    kept = F.transform(F.transform(F.filter(annotations, lambda a: ~incomplete(a)), read), member)
    if strict:
        return F.when(~F.exists(annotations, incomplete), kept)
    return kept
