"""Tiles, pyramids and pressure on fields with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isallobar.operators import kernels, pressure, pyramid, tiling
from isallobar.operators.grid import Grid
from isallobar.plans.manifest import Model, on, single


def test_tile_starts_end_at_the_edge():
    assert tiling.tile_starts(736, 256, 32) == [0, 224, 448, 480] and tiling.tile_starts(256, 256, 32) == [0] and tiling.tile_starts(100, 256, 0) == [0]
    for bad in ((736, 250, 32), (736, 256, 256), (736, 256, -1)):
        with pytest.raises(ValueError):
            tiling.tile_starts(*bad)


def test_ramps_follow_real_gaps_and_never_meet():
    table = tiling.ramps(tiling.tile_starts(1440, 256, 32), 256)
    assert table[0][1] == 0 and table[-1][2] == 0 and table[-1][1] == 128
    assert all(a + b <= 256 for _, a, b in table)


class Constant:
    def __init__(self, value):
        self.value = value

    def predict_batch(self, patches):
        out = np.zeros((*patches.shape[:3], 3))
        out[..., 1] = self.value
        out[..., 2] = patches[..., 0]
        return out


TWO = Model("two", "", single("surface_pressure", "10m_v_component_of_wind"), classes=("background", "cold", "warm"), served=("cold", "warm"))


@pytest.mark.parametrize("shape", [(24, 48), (17, 32)])
def test_constant_and_identity_predictions_come_back(spark, shape):
    grid = Grid(*shape)
    inputs = grid.cells(spark).select(F.lit(3).alias("step"), "r", "c", F.array((F.col("r") * 100 + F.col("c")).cast("double"), F.lit(1.0)).alias("channels"))
    rows = tiling.tiled_inference(inputs, ["step"], grid, TWO, Constant(0.5), patch=16, overlap=6, batch=4).collect()
    assert len(rows) == 2 * shape[0] * shape[1]
    for x in rows:
        assert abs(x.p - (0.5 if x.cls == "cold" else x.r * 100 + x.c)) < 1e-6


def test_volumes_repeat_single_levels():
    m = Model("v", "", on((850, 700), "temperature", "specific_humidity") + single("surface_pressure"), volumetric=True)
    seen = []
    tiling.Volumetric(type("P", (), {"predict_batch": lambda self, x: seen.append(x) or x})(), m).predict_batch(np.arange(5.0).reshape(1, 1, 1, 5))
    assert seen[0].shape == (1, 1, 1, 2, 3) and seen[0][0, 0, 0].tolist() == [[0, 1, 4], [2, 3, 4]]


def test_softmax_predictor_sums_to_one():
    p = tiling.LinearSoftmax(np.eye(2, 3), np.zeros(3), 0.5).predict_batch(np.random.default_rng(0).normal(size=(2, 4, 4, 2)))
    assert np.allclose(p.sum(axis=-1), 1)


def test_pyramid_halves_and_keeps_partial_blocks(spark):
    cells = Grid(5, 8).cells(spark).select(F.lit("cold").alias("cls"), "r", "c", F.col("r").cast("double").alias("p"))
    levels = {x.level: x.n for x in pyramid.mean_pyramid(cells, ["cls"], 3).groupBy("level").agg(F.count("*").alias("n")).collect()}
    assert levels == {0: 40, 1: 12, 2: 4}
    assert {x.r: x.p for x in pyramid.mean_pyramid(cells, ["cls"], 2).where("level = 1 AND c = 0").collect()} == {0: 0.5, 1: 2.5, 2: 4.0}
    with pytest.raises(ValueError):
        pyramid.mean_pyramid(cells, ["cls"], 0)


def test_packing_ends_and_error(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (float("nan"),), (None,), (-3.0,), (2.0,), (0.123,)], "p double").select("p", pyramid.packed(F.col("p")).alias("q"), pyramid.unpacked(pyramid.packed(F.col("p"))).alias("u")).collect()
    assert [x.q for x in rows] == [0, 254, 127, 255, 255, 0, 254, 31]
    assert rows[3].u is None and rows[4].u is None and abs(rows[7].u - 0.123) < 0.004


def test_stores_packed_or_not(spark, tmp_path, monkeypatch):
    cells = Grid(4, 8).cells(spark).select(F.lit("cold").alias("cls"), "r", "c", (F.col("c") / 8).alias("p"))
    tree = pyramid.mean_pyramid(cells, ["cls"], 2)
    for name, pack in (("plain", False), ("packed", True)):
        pyramid.write_pyramid(tree, f"{tmp_path}/{name}", pack)
        back = pyramid.read_level0(spark, f"{tmp_path}/{name}")
        assert pyramid.is_packed(spark.read.parquet(f"{tmp_path}/{name}")) == pack and back.count() == 32
        assert back.where(F.abs(F.col("p") - F.col("c") / 8) > 0.004).count() == 0
    assert pyramid.is_packed(pyramid.requantized(spark.read.parquet(f"{tmp_path}/plain")))
    for text, wanted in (("1", True), ("Yes", True), ("off", False), ("", False)):
        monkeypatch.setenv(pyramid.PACK_VARIABLE, text)
        assert pyramid.packing_wanted() == wanted and pyramid.packing_wanted(False) is False
    with pytest.raises(ValueError):
        pyramid.level0(cells, TWO)


GRID = Grid(91, 180)


def bumps(spark, *parts, grid=GRID):
    """1013 hPa and Gaussian bumps (lon, lat, hPa, width)."""
    v = F.lit(1013.0)
    for lon, lat, amp, width in parts:
        dlon = F.pmod(grid.lon() - lon + 180.0, F.lit(360.0)) - 180.0
        v = v + amp * F.exp(-(dlon * dlon + (grid.lat() - lat) * (grid.lat() - lat)) / (2.0 * width * width))
    return grid.cells(spark).select(F.lit(0).alias("f"), "r", "c", v.alias("v"))


def test_a_low_and_a_high(spark):
    field = bumps(spark, (200, 50, -30, 8), (330, 30, 20, 8))
    found = pressure.centres(field, ["f"], "v", GRID, sigma=1.0).collect()
    assert [(x.kind, abs(x.lon - lon) <= 2, abs(x.lat - lat) <= 2) for x, (lon, lat) in zip(sorted(found, key=lambda x: x.kind, reverse=True), ((-160, 50), (-30, 30)), strict=True)] == [("L", True, True), ("H", True, True)]
    lines = pressure.isobars(field, ["f"], "v", GRID, sigma=1.0, stride=1).collect()
    assert {x.hpa for x in lines} == set(range(988, 1032, 4)) and all(x.major == (x.hpa % 20 == 0) for x in lines)
    ring = [x for x in lines if x.hpa == 1000]
    assert len(ring) == 1 and ring[0].coordinates[0] == ring[0].coordinates[-1]
    assert all(-180 <= x.coordinates[0][0] < 180 for x in lines)


def test_a_low_on_the_seam_comes_once(spark):
    field = bumps(spark, (0, 40, -30, 8))
    assert pressure.centres(field, ["f"], "v", GRID, sigma=1.0).count() == 1
    rings = [x for x in pressure.isobars(field, ["f"], "v", GRID, sigma=1.0, stride=1).collect() if x.hpa == 1000]
    assert len(rings) == 1


def test_flat_fields_have_nothing_and_bad_ones_are_refused(spark):
    flat = bumps(spark)
    assert pressure.centres(flat, ["f"], "v", GRID).count() == 0 and pressure.isobars(flat, ["f"], "v", GRID).count() == 0
    pressure.checked_field(flat, ["f"], "v", GRID)
    with pytest.raises(ValueError):
        pressure.checked_field(flat.withColumn("v", F.when(F.col("r") == 3, float("nan")).otherwise(F.col("v"))), ["f"], "v", GRID)
    with pytest.raises(ValueError):
        pressure.checked_field(flat.where("r > 0"), ["f"], "v", GRID)


def test_high_ground_hides_centres(spark):
    field = bumps(spark, (200, 50, -30, 8))
    ground = GRID.cells(spark).select(F.lit(0).alias("f"), "r", "c", F.when(GRID.lat() > 40, 700.0).otherwise(1000.0).alias("surface"))
    assert pressure.centres(field, ["f"], "v", GRID, ground, sigma=1.0).where("kind = 'L'").count() == 0


def test_shallow_dips_do_not_stand_out():
    x = np.hypot(*np.mgrid[-20:21, -20:21])
    field = 1000 - 10 * np.exp(-(x**2) / 30)
    assert kernels.stands_out(field, 20, 20, True, 4.0)
    field[20, 32] -= 1.0
    assert not kernels.stands_out(field, 20, 32, True, 4.0)
    assert kernels.stands_out(-field, 20, 20, False, 4.0)


def test_spacing_takes_the_strongest_first():
    lon, lat = np.array([0.0, 5.0, 40.0]), np.zeros(3)
    assert kernels.spaced_out(lon, lat, np.array([1.0, 2.0, 0.5]), 1500) == [1, 2]


def test_labels_touch_at_corners():
    mask = np.array([[1, 0, 0, 1], [0, 1, 0, 1], [0, 0, 0, 0], [1, 1, 0, 1]], bool)
    labels, count = kernels.labelled(mask)
    assert count == 4 and labels[0, 0] == labels[1, 1] and labels[0, 3] == labels[1, 3] != labels[3, 3]


def test_simplifying_keeps_corners():
    line = np.array([[0, 0], [1, 0.001], [2, 0], [2, 1], [2, 2.0]])
    assert kernels.simplified(line, 0.03).tolist() == [[0, 0], [2, 0], [2, 2]]
    assert len(kernels.simplified(np.array([[0.0, 0], [1, 1], [0, 0]]), 0.1)) == 3
