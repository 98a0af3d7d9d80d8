"""Nearest neighbour on the sphere: match every galaxy to the closest catalogue source within a radius.

Positions become points on the unit sphere. There, nearest by angle is nearest by straight line, and neither the
0/360 seam nor the poles need care. Space is cut into cubes with the search radius as edge, so the match lies in
the galaxy's cube or a touching one, and the search is an equi-join on cubes.

Crowding. A cube with more than ``leaf`` sources is never paired with its galaxies. It is cut into smaller cubes, and
only occupied ones that can still hold the nearest source are kept: the nearest one lies no further than the far corner of
some occupied cube, so cubes whose near corner is beyond that are out. This repeats, on crowded cubes only, until
every remaining cube is small; sources at the very same position count once. Results are exact.

Density. Where the radius spans many sources, most galaxies have one in their own cube of a far smaller edge. Its distance
bounds the search, so each galaxy enters at the level of its bound and meets a few cubes, however dense the catalogue is.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollfold.functions.columns import c
from pollfold.sources.storage import cut_lineage

_FAN = 2  # a power of two, so that smaller cubes nest exactly in larger ones
_AXES = ("x", "y", "z")
_CUBE = ("cube_x", "cube_y", "cube_z")
_SLACK = 1e-14  # rounding of unit vectors
_FINEST = 1e-13  # edge below which double precision no longer tells positions apart


def separation_deg(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance in degrees (haversine)."""
    dra, ddec = F.radians(ra2 - ra1), F.radians(dec2 - dec1)
    h = F.pow(F.sin(ddec / 2), 2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(dra / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(h, F.lit(1.0)))))


def sky_match(
    galaxies: DataFrame,
    catalog: DataFrame,
    max_sep_deg: float,
    galaxy_suffix: str = "",
    catalog_suffix: str = "_catalog",
    ra: str = "ra",
    dec: str = "dec",
    prefer: str | None = None,
    leaf: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """``(matched, unmatched)`` galaxies.

    ``matched`` has the columns of both tables and ``sky_separation`` in degrees; columns that both tables have get
    the suffixes. Of several catalogue rows at one position the smallest (by ``prefer``, else by all columns in order)
    stands for all. ``unmatched`` are the galaxies with no source within ``max_sep_deg``.
    """
    # found once, whatever reads the two results and however often
    nearest = cut_lineage(
        nearest_positions(
            galaxies.select(c(ra).alias("g_ra"), c(dec).alias("g_dec")),
            catalog.select(c(ra).alias("c_ra"), c(dec).alias("c_dec")),
            max_sep_deg,
            leaf,
        )
    )
    shared = set(galaxies.columns) & set(catalog.columns)
    left = galaxies.withColumns({"g_ra": c(ra), "g_dec": c(dec)})
    left = left.withColumnsRenamed({name: name + galaxy_suffix for name in shared})
    # one catalogue row per position: the partial minimum keeps crowds of copies off the shuffle
    order = [prefer] if prefer else catalog.columns
    row = F.min(F.struct(F.struct(*[c(n) for n in order]), F.struct(*[c(n) for n in catalog.columns]).alias("row")))
    right = catalog.groupBy(c(ra).alias("c_ra"), c(dec).alias("c_dec")).agg(row.alias("first"))
    right = right.select("c_ra", "c_dec", "first.row.*")
    right = right.withColumnsRenamed({name: name + catalog_suffix for name in shared})
    matched = left.join(_shuffled(nearest), ["g_ra", "g_dec"]).join(_shuffled(right), ["c_ra", "c_dec"]).drop("g_ra", "g_dec", "c_ra", "c_dec")
    unmatched = galaxies.join(
        _shuffled(nearest.select(F.col("g_ra").alias(ra), F.col("g_dec").alias(dec))), [ra, dec], "left_anti"
    ).select(*[c(name) for name in galaxies.columns])
    return matched, unmatched


def nearest_positions(galaxies: DataFrame, catalog: DataFrame, max_sep_deg: float, leaf: int = 64) -> DataFrame:
    """``g_ra, g_dec, c_ra, c_dec, sky_separation``: the nearest source position of every distinct galaxy position.

    Equal distances are settled by the smaller (ra, dec).
    """
    radius = 2 * math.sin(math.radians(min(max_sep_deg, 180.0)) / 2)
    edge = radius * (1 + 1e-9) + _SLACK
    points = cut_lineage(_on_sphere(catalog.dropna().distinct(), "c_ra", "c_dec"))
    searching = _on_sphere(galaxies.dropna().distinct(), "g_ra", "g_dec").withColumn("bound", F.lit(radius + _SLACK))
    levels = _levels(points.count(), edge)
    candidates = cut_lineage(_entered(_narrowed(searching, points, edge, levels), edge, levels))
    found, level = None, 0
    while True:
        # cubes of one edge at a time: galaxies enter at the level of their bound, or come from a crowded cube of the level above
        here = candidates.where(F.col("level") == level) if level <= levels else None
        here = inside if here is None else here.drop("level") if level == 0 else inside.unionByName(here.drop("level"))
        placed = points.withColumns(_cube_of(edge))
        counted = placed.groupBy(*_CUBE).agg(F.count(F.lit(1)).alias("n"))
        inseparable = edge < _FINEST
        # keys only: the sources of a cube join those galaxies that it can still be nearest to
        reachable = _bounded(here.join(_shuffled(counted), list(_CUBE)), edge).where(_distance_to_cube(edge, near=True) <= F.col("bound"))
        reachable = cut_lineage(reachable)
        few = reachable if inseparable else reachable.where(F.col("n") <= leaf)
        listed = placed.join(_shuffled(few.select(*_CUBE).distinct()), list(_CUBE), "left_semi")
        cubes = _inseparable(listed, leaf) if inseparable else listed.groupBy(*_CUBE).agg(_listed())
        closest = _closest(few.drop("n").join(_shuffled(cubes), list(_CUBE)))
        found = closest if found is None else found.unionByName(closest)
        crowded = reachable.where(F.col("n") > leaf).drop("n")
        if inseparable or (level >= levels and crowded.isEmpty()):
            break
        # crowded cubes are cut finer, and their galaxies meet the occupied parts
        below = placed.join(_shuffled(crowded.select(*_CUBE).distinct()), list(_CUBE), "left_semi")
        cut = _FAN if level < levels else _cut(below, edge)
        finer = edge / cut
        children = below.select(*_CUBE, *[col.alias(f"child_{n}") for n, col in _cube_of(finer).items()]).distinct()
        inside = crowded.join(_shuffled(children), list(_CUBE))
        inside = inside.drop(*_CUBE).withColumnsRenamed({f"child_{n}": n for n in _CUBE})
        inside = inside.where(_distance_to_cube(finer, near=True) <= F.col("bound"))
        if level >= levels:  # no galaxy enters below, so that sources outside of crowded cubes have done their part
            inside, points = cut_lineage(inside), cut_lineage(below.drop(*_CUBE))
        edge, level = finer, level + 1
    best = found.groupBy("g_ra", "g_dec").agg(F.min("nearest").alias("nearest"))
    pairs = best.select("g_ra", "g_dec", F.col("nearest.c_ra").alias("c_ra"), F.col("nearest.c_dec").alias("c_dec"))
    away = separation_deg(F.col("g_ra"), F.col("g_dec"), F.col("c_ra"), F.col("c_dec"))
    return pairs.withColumn("sky_separation", away).filter(F.col("sky_separation") <= max_sep_deg)


def _shuffled(side: DataFrame) -> DataFrame:
    """A side that is never broadcast: of a search with many levels, as many tables would be in the driver's memory at once."""
    return side.hint("merge")


def _levels(sources: int, edge: float) -> int:
    """How often cubes are cut until their edge is the mean distance of so many sources spread over the whole sphere."""
    return max(0, round(math.log(edge * math.sqrt(max(sources, 1) / (4 * math.pi)), _FAN)))


def _narrowed(searching: DataFrame, points: DataFrame, edge: float, levels: int) -> DataFrame:
    """Search bounds narrowed to the distance of one source in the galaxy's own cube, if any, of every level."""
    cube = lambda: F.explode(F.array(*[F.struct(F.lit(k).alias("level"), *[v.alias(n) for n, v in _cube_of(edge / _FAN**k).items()]) for k in range(levels + 1)]))
    place = F.struct(*[F.col(a).alias(f"near_{a}") for a in _AXES])
    one = points.select(cube().alias("at"), place.alias("place")).groupBy("at").agg(F.min("place").alias("place"))
    gaps = [F.col(a) - F.col(f"place.near_{a}") for a in _AXES]
    away = F.sqrt(gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2]) + F.lit(_SLACK)
    found = searching.select("g_ra", "g_dec", *_AXES, cube().alias("at")).join(_shuffled(one), "at").groupBy("g_ra", "g_dec").agg(F.min(away).alias("away"))
    return searching.join(_shuffled(found), ["g_ra", "g_dec"], "left").withColumn("bound", F.least("bound", "away")).drop("away")


def _entered(searching: DataFrame, edge: float, levels: int) -> DataFrame:
    """Each galaxy with the cubes that its search sphere touches, at the finest ``level`` whose edge is not below its bound."""
    fits = [F.when(F.col("bound") <= F.lit(edge / _FAN**k), F.lit(k)) for k in range(levels, 0, -1)]
    placed = searching.withColumn("level", F.coalesce(*fits, F.lit(0)))
    parts = [_touching(placed.where(F.col("level") == k), edge / _FAN**k) for k in range(levels + 1)]
    return reduce(DataFrame.unionByName, parts)


def _on_sphere(df: DataFrame, ra: str, dec: str) -> DataFrame:
    lon, lat = F.radians(c(ra)), F.radians(c(dec))
    return df.withColumns({"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)})


def _cube_of(edge: float) -> dict[str, Column]:
    return {f"cube_{a}": F.floor(c(a) / F.lit(edge)).cast("bigint") for a in _AXES}


def _listed() -> Column:
    """Aggregate: the sources of a cube. Callers make sure that they are few."""
    return F.collect_list(F.struct("c_ra", "c_dec", *_AXES)).alias("sources")


def _inseparable(placed: DataFrame, leaf: int) -> DataFrame:
    """All sources of cubes that cannot be cut finer, in several rows of about ``leaf`` each.

    Sources at the very same point are equally far from every galaxy, so the one with the smallest (ra, dec) wins for all."""
    points = placed.groupBy(*_CUBE, *_AXES).agg(F.min(F.struct("c_ra", "c_dec")).alias("first"))
    points = points.select(*_CUBE, *_AXES, "first.*")
    rows = points.groupBy(*_CUBE).agg(F.ceil(F.count(F.lit(1)) / leaf).cast("bigint").alias("rows"))
    part = F.pmod(F.xxhash64(*_AXES), F.col("rows")).alias("part")
    return points.join(_shuffled(rows), list(_CUBE)).select("*", part).groupBy(*_CUBE, "part").agg(_listed()).drop("part")


def _touching(galaxies: DataFrame, edge: float) -> DataFrame:
    """Each galaxy with the cubes that its search sphere touches (27 at most)."""
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    out = galaxies.withColumns(_cube_of(edge))
    for a in _AXES:
        out = out.withColumn("step", F.explode(steps))
        out = out.withColumn(f"cube_{a}", c(f"cube_{a}") + F.col("step")).drop("step")
    return out.filter(_distance_to_cube(edge, near=True) <= F.col("bound"))


def _cut(points: DataFrame, edge: float) -> int:
    """Into how many parts per edge crowded cubes are cut: more when their contents are packed closely."""
    sides = points.groupBy(*_CUBE).agg(*[(F.max(a) - F.min(a)).alias(a) for a in _AXES])
    widest = sides.agg(F.max(F.greatest(*_AXES))).first()[0]
    parts = _FAN
    while edge / (parts * _FAN) > widest and edge / parts > _FINEST:
        parts *= _FAN
    return parts


def _distance_to_cube(edge: float, near: bool) -> Column:
    """Distance from the galaxy to the nearest or farthest point of a cube."""
    squares = F.lit(0.0)
    for a in _AXES:
        low = c(f"cube_{a}") * F.lit(edge)
        high = low + F.lit(edge)
        if near:
            gap = F.greatest(low - c(a), c(a) - high, F.lit(0.0))
        else:
            gap = F.greatest(F.abs(c(a) - low), F.abs(high - c(a)))
        squares = squares + gap * gap
    return F.sqrt(squares)


def _bounded(reachable: DataFrame, edge: float) -> DataFrame:
    """Search bounds narrowed to the far corner of the closest occupied cube."""
    limits = reachable.groupBy("g_ra", "g_dec").agg(F.min(_distance_to_cube(edge, near=False)).alias("limit"))
    narrowed = reachable.join(_shuffled(limits), ["g_ra", "g_dec"])
    return narrowed.withColumn("bound", F.least("bound", F.col("limit") + F.lit(_SLACK))).drop("limit")


def _closest(reachable: DataFrame) -> DataFrame:
    """Per galaxy the closest source among the listed ones."""

    def candidate(s: Column) -> Column:
        # squared straight-line distance: orders like the angle, without trigonometry per pair
        gaps = [F.col(a) - s[a] for a in _AXES]
        squared = gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2]
        return F.struct(squared.alias("squared"), s["c_ra"].alias("c_ra"), s["c_dec"].alias("c_dec"))

    per_cube = F.array_min(F.transform("sources", candidate)).alias("nearest")
    listed = reachable.filter("sources is not null").select("g_ra", "g_dec", per_cube)
    return listed.groupBy("g_ra", "g_dec").agg(F.min("nearest").alias("nearest"))
