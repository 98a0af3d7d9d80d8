"""Question dictionaries of the supported surveys.

Fixed values: the raw and published question and answer names below are the vocabulary that exported
classifications and downstream catalogues use; results are only comparable when they are spelled exactly so.
"""

from __future__ import annotations

from pollfold.dictionary import QuestionSet


# --- fixed values: decision tree shared by all image surveys, T0 to T11 ---
_HOW_ROUNDED = ("T1", "how-rounded", {"completely round": "round", "in between": "in-between", "cigar-shaped": "cigar-shaped"})
_EDGE_ON = ("T2", "disk-edge-on", {"yes -  edge on disk": "yes", "no - something else": "no"})
_EDGE_ON_BULGE = ("T3", "edge-on-bulge", {"rounded": "rounded", "boxy": "boxy", "no bulge": "none"})
_BAR = ("T4", "bar", {"strong bar": "strong", "weak bar": "weak", "no bar": "no"})
_SPIRAL = ("T5", "has-spiral-arms", {"yes": "yes", "no": "no"})
_WINDING = ("T6", "spiral-winding", {"tight": "tight", "medium": "medium", "loose": "loose"})
_ARM_COUNT = (
    "T7",
    "spiral-arm-count",
    {"1": "1", "2": "2", "3": "3", "4": "4", "more than 4": "more-than-4", "can't tell": "cant-tell"},
)
_BULGE_SIZE = (
    "T8",
    "bulge-size",
    {"no bulge": "none", "small": "small", "moderate": "moderate", "large": "large", "dominant": "dominant"},
)
_MERGING = (
    "T11",
    "merging",
    {
        "merging": "merger",
        "major disturbance": "major-disturbance",
        "minor disturbance": "minor-disturbance",
        "none": "none",
    },
)
_MIDDLE = (_HOW_ROUNDED, _EDGE_ON, _EDGE_ON_BULGE, _BAR, _SPIRAL, _WINDING, _ARM_COUNT, _BULGE_SIZE, _MERGING)


def _first(raw_third: str, third: str):
    answers = {"smooth": "smooth", "features or disk": "featured-or-disk", raw_third: third}
    return ("T0", "smooth-or-featured", answers)


DR5 = QuestionSet.build(_first("star or artifact", "artifact"), *_MIDDLE)

# --- fixed values: questions added by the deep-field surveys ---
_CLUMPS = ("T13", "clumps", {"bright clumps": "yes", "none": "no"})
_PROBLEM = ("T14", "problem", {"star": "star", "non-star artifact": "artifact", "bad image zoom": "zoom"})
_ARTIFACT = {
    "non-star artifact": "non-star",
    "satellite trail": "satellite",
    "scattered light": "scattered",
    "diffraction spike": "diffraction",
    "cosmic ray": "ray",
    "saturation feature (bleed trail)": "saturation",
    "other / not sure": "other",
}
_DEEP_FIRST = _first("star, artifact, or bad zoom", "problem")

COSMIC_DAWN = QuestionSet.build(_DEEP_FIRST, *_MIDDLE, _CLUMPS, _PROBLEM, ("T15", "artifact", _ARTIFACT))
EUCLID = QuestionSet.build(_DEEP_FIRST, *_MIDDLE, _CLUMPS, _PROBLEM, ("T15", "artifact", {**_ARTIFACT, "ghost": "ghost"}))

JWST_CEERS = QuestionSet.build(
    _first("star, artifact, or bad zoom", "star-artifact-zoom"),
    *_MIDDLE,
    ("T12", "clumps", {"yes": "yes", "no": "no"}),
    ("T19", "problem", {"star": "star", "non-star artifact": "artifact", "bad image zoom": "bad-zoom"}),
)
JWST_COSMOS = JWST_CEERS

# --- fixed values: coded dictionaries of the older platform ---
UKIDSS = QuestionSet.build(
    ("ukidss-0", "smooth-or-featured", {"a-0": "smooth", "a-1": "featured-or-disk", "a-2": "artifact"}),
    ("ukidss-7", "how-rounded", {"a-0": "round", "a-1": "in-between", "a-2": "cigar"}),
    ("ukidss-1", "disk-edge-on", {"a-0": "yes", "a-1": "no"}),
    ("ukidss-8", "bulge-shape", {"a-0": "round", "a-1": "boxy", "a-2": "no-bulge"}),
    ("ukidss-2", "bar", {"a-0": "yes", "a-1": "no"}),
    ("ukidss-3", "has-spiral-arms", {"a-0": "yes", "a-1": "no"}),
    ("ukidss-9", "spiral-winding", {"a-0": "tight", "a-1": "medium", "a-2": "loose"}),
    (
        "ukidss-10",
        "spiral-arm-count",
        {
            "a-0": "1",
            "a-1": "2",
            "a-2": "3",
            "a-3": "4",
            "a-4": "more-than-4",
            "a-5": "cant-tell",
        },
    ),
    ("ukidss-4", "bulge-size", {"a-0": "no", "a-1": "just-noticeable", "a-2": "obvious", "a-3": "dominant"}),
    ("ukidss-5", "something-odd", {"a-0": "yes", "a-1": "no"}),
)
DR2 = QuestionSet.build(
    ("decals-0", "smooth-or-featured", {"a-0": "smooth", "a-1": "featured-or-disk", "a-2": "artifact"}),
    ("decals-8", "how-rounded", {"a-0": "completely", "a-1": "in-between", "a-2": "cigar-shaped"}),
    ("decals-1", "disk-edge-on", {"a-0": "yes", "a-1": "no"}),
    ("decals-7", "edge-on-bulge", {"a-0": "rounded", "a-1": "boxy", "a-2": "none"}),
    ("decals-2", "bar", {"a-0": "yes", "a-1": "no"}),
    ("decals-3", "has-spiral-arms", {"a-0": "yes", "a-1": "no"}),
    ("decals-5", "spiral-winding", {"a-0": "tight", "a-1": "medium", "a-2": "loose"}),
    ("decals-6", "spiral-arm-count", {"a-0": "1", "a-1": "2", "a-2": "3", "a-3": "4", "a-4": "more-than-4"}),
    ("decals-4", "bulge-size", {"a-0": "none", "a-1": "obvious", "a-2": "dominant"}),
    ("decals-9", "merging", {"a-0": "merger", "a-1": "tidal-debris", "a-2": "both", "a-3": "neither"}),
)

# --- fixed values: expert lens grading ---
_GRADES = {
    "grade a (confidently a lens)": "grade_a",
    "grade b (probably a lens, additional info needed)": "grade_b",
    "grade c (lens-like features could have other explanation)": "grade_c",
    "not a lens, but otherwise interesting": "not_lens_but_interesting",
    "not a lens, not interesting": "not_lens_not_interesting",
}
JUDGES = QuestionSet.build(("T0", "expert", _GRADES))
JUDGES_V2 = QuestionSet.build(
    ("T0", "expert", {"grade a+ (lens of individual science value)": "grade_a_plus", **_GRADES})
)

BUILT_IN = {
    "dr5": DR5,
    "cosmic_dawn": COSMIC_DAWN,
    "euclid": EUCLID,
    "jwst_ceers": JWST_CEERS,
    "jwst_cosmos": JWST_COSMOS,
    "ukidss": UKIDSS,
    "dr2": DR2,
    "judges": JUDGES,
    "judges_v2": JUDGES_V2,
}

# Fixed value: questions whose old wording is void, with the first workflow version of the new wording.
QUESTION_SINCE_VERSION = {"merging": 66.425}
# Fixed value: the day the main workflow went public; earlier classifications are tests.
PUBLIC_LAUNCH = "2018-03-20"
# Fixed value: label that marks a question with several allowed answers in old exports.
MULTIPLE_CHOICE_LABEL = "Do you see any of these rare features?"
