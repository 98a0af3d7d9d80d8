import math
import random

import pytest

from pollfold.operators import skymatch
from pollfold.operators.skymatch import nearest_positions, sky_match
from tests.conftest import rows_of


def unit(ra, dec):
    ra, dec = math.radians(ra), math.radians(dec)
    return math.cos(dec) * math.cos(ra), math.cos(dec) * math.sin(ra), math.sin(dec)


def separation(a, b):
    chord = math.dist(unit(*a), unit(*b))
    return math.degrees(2 * math.asin(min(1.0, chord / 2)))


def frame(spark, points, key):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], f"{key} int, ra double, dec double")


def check(spark, galaxies, catalog, radius, leaf):
    found = nearest_positions(
        spark.createDataFrame(galaxies, "g_ra double, g_dec double"),
        spark.createDataFrame(catalog, "c_ra double, c_dec double"),
        radius,
        leaf,
    ).collect()
    best = {(r.g_ra, r.g_dec): r.sky_separation for r in found}
    for galaxy in set(galaxies):
        nearest = min(separation(galaxy, source) for source in catalog)
        if nearest <= radius * (1 - 1e-9):
            assert best[galaxy] == pytest.approx(nearest, abs=1e-9), galaxy
        elif nearest > radius * (1 + 1e-9):
            assert galaxy not in best
    assert len(best) == len(found)
    return best


def test_swapped_pair(spark):
    points = [(116.448, 25.8621), (323.319, 11.6901)]
    matched, unmatched = sky_match(frame(spark, points, "galaxy"), frame(spark, points[::-1], "source"), 1 / 3600)
    assert rows_of(matched, "galaxy", "source") == [(0, 1), (1, 0)]
    assert unmatched.count() == 0
    assert {"ra", "ra_catalog", "dec_catalog", "sky_separation"} <= set(matched.columns)


def test_seam_and_poles(spark):
    galaxies = [(359.9999, 0.0), (0.0, 90.0), (10.0, -89.9999), (180.0, 45.0)]
    catalog = [(0.0001, 0.0), (123.0, 89.9999), (190.0, -89.9999), (180.1, 45.0)]
    best = check(spark, galaxies, catalog, 0.001, 64)
    assert set(best) == set(galaxies[:3])


@pytest.mark.parametrize("radius", [0.5, 8.0])
def test_random_sky(spark, radius):
    rng = random.Random(1)
    place = lambda: (rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1))))
    check(spark, [place() for _ in range(200)], [place() for _ in range(300)], radius, 64)


def test_crowded_cubes_are_cut_finer(spark):
    """A third of the sources in one spot, galaxies inside and beside it, copies, and a leaf size of 4."""
    rng = random.Random(2)
    spot = lambda size: (40 + rng.gauss(0, size), 20 + rng.gauss(0, size))
    catalog = [spot(0.01) for _ in range(150)] + [(40.0, 20.0)] * 50 + [spot(5) for _ in range(200)]
    galaxies = [spot(0.01) for _ in range(40)] + [spot(0.5) for _ in range(40)] + [(40.0, 20.0)] * 20
    check(spark, galaxies, catalog, 3.0, 4)


def test_positions_closer_than_double_precision(spark):
    """At the pole every right ascension is the same place, so cutting finer would never end."""
    catalog = [(float(ra), 90.0) for ra in range(40)]
    best = check(spark, [(5.0, 89.9)], catalog, 1.0, 4)
    assert len(best) == 1


def test_inseparable_sources_are_all_compared(spark):
    """Many different points inside the finest cube: the nearest one wins, not the one with the smallest coordinates."""
    rng = random.Random(5)
    spot = lambda: (30.0 + rng.randrange(40) * 2e-13, rng.randrange(40) * 1e-13)
    catalog = sorted({spot() for _ in range(150)})
    check(spark, [(30.0 + 3e-12, 2e-12), (30.0, 0.0), (30.001, 0.0), (29.999, -0.001)], catalog, 1.0, 4)


def test_one_catalogue_row_per_galaxy(spark):
    galaxies = spark.createDataFrame([(1, 10.0, 5.0), (2, 10.0, 5.0), (3, None, 5.0)], "id int, ra double, dec double")
    catalog = spark.createDataFrame([(9, 10.0, 5.0, "b"), (8, 10.0, 5.0, "c")], "id int, ra double, dec double, name string")
    matched, unmatched = sky_match(galaxies, catalog, 0.1, "_g", "_c", prefer="name")
    assert rows_of(matched, "id_g", "id_c", "name") == [(1, 9, "b"), (2, 9, "b")]
    assert rows_of(unmatched, "id") == [(3,)]


def test_dense_catalogues_are_met_in_few_cubes(spark, monkeypatch):
    """A radius that spans hundreds of sources: a galaxy is compared with a few dozen, not with all within the radius."""
    compared, closest = [], skymatch._closest
    monkeypatch.setattr(skymatch, "_closest", lambda rows: (compared.append(rows.selectExpr("coalesce(sum(size(sources)), 0)").first()[0]), closest(rows))[1])
    sky = lambda n, seed, p: spark.range(n).selectExpr(f"360 * rand({seed}) AS {p}_ra", f"degrees(asin(2 * rand({seed + 1}) - 1)) AS {p}_dec")
    assert nearest_positions(sky(50, 1, "g"), sky(20_000, 3, "c"), 8.0).count() == 50
    assert 0 < sum(compared) < 50 * 100


def test_the_search_broadcasts_no_table(spark):
    galaxies = spark.createDataFrame([(i, float(i % 50), float(i % 7)) for i in range(300)], "id long, ra double, dec double")
    catalog = spark.createDataFrame([(i, i % 50 + 0.1, float(i % 7)) for i in range(300)], "id long, ra double, dec double")
    before = _broadcasts(spark)
    matched, unmatched = sky_match(galaxies, catalog, 0.5)
    assert matched.count() == 300 and unmatched.isEmpty()
    assert _broadcasts(spark) == before


def _broadcasts(spark):
    """How many joins of all plans so far had a broadcast side."""
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    return sum(done.apply(i).physicalPlanDescription().count("BroadcastExchange") for i in range(done.size()))
