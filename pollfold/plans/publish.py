"""Reduced tables to catalogues: subjects, sky positions, file locations, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.functions.columns import c
from pollfold.functions.text import rerooted
from pollfold.operators.aggregates import exact_quantile
from pollfold.operators.joins import natural_join
from pollfold.operators.skymatch import sky_match


def fully_classified(
    predictions: DataFrame,
    question: str = "smooth-or-featured",
    unwanted: str = "artifact",
    more_than: int = 35,
) -> DataFrame:
    """Predictions that are not the unwanted answer and rest on more than ``more_than`` votes."""
    wanted = ~c(f"{question}_prediction").eqNullSafe(F.lit(unwanted))
    return predictions.filter(wanted & (c(f"{question}_total-votes") > more_than))


def attach_catalog(
    predictions: DataFrame,
    subjects: DataFrame,
    catalog: DataFrame,
    max_sep_deg: float,
    question: str = "smooth-or-featured",
    unwanted: str = "artifact",
    more_than: int = 35,
) -> DataFrame:
    """Fully classified predictions joined with their subjects, then with the nearest catalogue source."""
    chosen = fully_classified(predictions, question, unwanted, more_than).join(subjects, "subject_id", "inner")
    return sky_match(chosen, catalog, max_sep_deg, galaxy_suffix="_reduced", catalog_suffix="")[0]


def compare_surveys(
    calibration_subjects: DataFrame,
    other_subjects: DataFrame,
    expert_subjects: DataFrame,
    predictions: DataFrame,
    other_predictions: DataFrame,
    max_sep_deg: float,
    other: str = "_dr2",
    expert: str = "_nair",
) -> tuple[DataFrame, DataFrame]:
    """Predictions of two surveys for the subjects they share with an expert catalogue: ``(this survey, other one)``.

    Every calibration subject must have a counterpart in the other survey.
    """
    shared, unmatched = sky_match(calibration_subjects, other_subjects, max_sep_deg, "", other)
    if not unmatched.isEmpty():
        raise ValueError("calibration subjects without counterpart in the other survey")
    with_expert, _ = sky_match(shared.drop("sky_separation"), expert_subjects, max_sep_deg, "", expert)
    theirs = other_predictions.withColumnRenamed("subject_id", f"subject_id{other}")
    return (
        predictions.join(with_expert, "subject_id", "inner"),
        theirs.join(with_expert, f"subject_id{other}", "inner"),
    )


def with_file_locations(reduced: DataFrame, locations: DataFrame, root: str, key: str = "id_str", url: str = "locations") -> DataFrame:
    """Attach the local file of each subject's image."""
    files = locations.select(c(key), rerooted(c(url), root).alias("file_loc"))
    return reduced.join(files, key, "inner")


def with_sky_split(coords: DataFrame, q: float = 0.7, ra: str = "ra") -> DataFrame:
    """Flag ``in_test``: right ascension at or above its exact q quantile. Neighbours stay on one side."""
    bound = exact_quantile(coords, ra, q)
    return coords.withColumn("in_test", c(ra) >= F.lit(bound))


def publish_catalog(
    reduced: DataFrame,
    locations: DataFrame,
    coords: DataFrame,
    root: str,
    key: str = "id_str",
    q: float = 0.7,
    coord_columns: Sequence[str] = ("in_test", "ra", "dec"),
) -> DataFrame:
    """Reduced table with file locations, coordinates and the fixed train/test split."""
    located = with_file_locations(reduced, locations, root, key)
    split = with_sky_split(coords, q).select(c(key), *[c(n) for n in coord_columns])
    return natural_join(located, split)
