"""Derivations, grids and channels on analytic inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isallobar.functions import geo, names, physics
from isallobar.operators import assemble, derive
from isallobar.operators import grid as g
from isallobar.plans.manifest import MODELS, Model, check_sources, get_model, on, single
from isallobar.sources.fields import SyntheticSource, read_arrays, stage


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


def test_dry_air_has_equal_potential_temperatures(spark):
    row = one(spark, dry=physics.equivalent_potential_temperature(F.lit(280.0), F.lit(0.0), F.lit(850.0)), theta=physics.potential_temperature(F.lit(280.0), F.lit(850.0)), same=physics.potential_temperature(F.lit(280.0), F.lit(1000.0)), wet=physics.equivalent_potential_temperature(F.lit(280.0), F.lit(0.005), F.lit(850.0)))
    assert abs(row.dry - row.theta) < 0.01 and row.same == 280.0 and row.wet > row.theta + 5


def test_missing_values_stay_missing(spark):
    none, nan = F.lit(None).cast("double"), F.lit(float("nan"))
    row = one(spark, q=physics.clamped_humidity(none), km=geo.haversine_km(none, none, F.lit(1.0), F.lit(2.0)), zero=physics.nan_to_zero(nan), gone=physics.nan_to_null(nan))
    assert row.q is None and row.km is None and row.zero == 0.0 and row.gone is None


def winds(spark, grid, u, v):
    return grid.cells(spark).select(F.lit(0).alias("f"), "r", "c", u(grid).alias("u"), v(grid).alias("v"))


def test_uniform_wind_has_only_curvature_free_shear(spark):
    grid = g.Grid(19, 36)
    still = derive.relative_vorticity(winds(spark, grid, lambda _: F.lit(7.0), lambda _: F.lit(0.0)), ["f"], grid)
    assert still.agg(F.max(F.abs("vorticity"))).first()[0] == 0.0


def test_shear_and_the_seam(spark):
    grid = g.Grid(19, 36)
    sheared = derive.relative_vorticity(winds(spark, grid, lambda x: x.lat() * 2, lambda x: F.sin(F.radians(x.lon()))), ["f"], grid).where("r = 9").orderBy("c").collect()
    slope = 2.0 / (physics.EARTH_RADIUS_M * math.radians(1))
    step = math.radians(10)
    for row in sheared:
        wave = math.cos(math.radians(row.c * 10)) * math.sin(step) / (physics.EARTH_RADIUS_M * step)
        assert abs(row.vorticity - (wave - slope)) < 1e-12


def test_stable_air_has_positive_vorticity_in_the_north(spark):
    grid = g.Grid(9, 9)
    rows = [(p, t) for p, t in ((1000, 290.0), (850, 300.0), (700, 315.0))]
    air = grid.cells(spark).join(spark.createDataFrame(rows, "level int, theta double").hint("broadcast")).select(F.lit(0).alias("f"), "level", "r", "c", "theta", F.lit(0.0).alias("u"), F.lit(0.0).alias("v"))
    found = derive.potential_vorticity(air, ["f"], grid)
    assert found.where("r < 4 AND pv <= 0").count() == 0 and found.where("r > 4 AND pv >= 0").count() == 0
    middle = found.where("r = 2 AND c = 0 AND level = 850").first().pv
    wanted = -physics.GRAVITY * 2 * physics.ROTATION * math.sin(math.radians(45)) * (290 - 315) / 30000 * 1e6
    assert abs(middle - wanted) < 1e-9


def test_padding_takes_columns_from_the_other_edge(spark):
    grid = g.Grid(2, 12)
    rows = g.circular_pad(grid.cells(spark).withColumn("v", F.col("c")), 12, 3).where("r = 0").orderBy("c").collect()
    assert [x.v for x in rows] == [9, 10, 11, *range(12), 0, 1, 2] and [x.c for x in rows] == list(range(18))
    assert g.circular_pad(grid.cells(spark), 12, 0).count() == 24
    with pytest.raises(ValueError):
        g.circular_pad(grid.cells(spark), 12, 13)


def test_rolling_keeps_values(spark):
    grid = g.Grid(3, 16)
    rows = g.rolled_to_signed(grid.cells(spark).withColumn("v", grid.lon()), 16).where("r = 1").orderBy("c").collect()
    assert [x.lon for x in rows] == [-180 + 22.5 * k for k in range(16)] and all(x.lon % 360 == x.v for x in rows)
    with pytest.raises(ValueError):
        g.rolled_to_signed(grid.cells(spark), 15)


def test_ranges_cross_the_seam(spark):
    axis = spark.range(36).select((F.col("id") * 10.0).alias("lon"))
    pick = lambda a, b: [x.lon for x in axis.where(g.in_periodic_range(F.col("lon"), a, b)).orderBy("lon").collect()]
    assert pick(-20, 10) == [0, 10, 340, 350] and pick(20, 40) == [20, 30, 40] and pick(40, 20) == []


def test_only_southern_meridional_winds_turn(spark):
    grid = g.Grid(5, 2)
    rows = grid.cells(spark).select("r", g.channels_negated(F.array(F.lit(1.0), F.lit(1.0), F.lit(1.0)), ["u_component_of_wind_850", "v_component_of_wind_850", "10m_v_component_of_wind"], grid.lat()).alias("x")).collect()
    assert all(x.x == ([1.0, -1.0, -1.0] if x.r > 2 else [1.0, 1.0, 1.0]) for x in rows)


def test_channel_order_is_by_level(spark):
    assert get_model("theta-e_uv_q").channel_names()[:5] == [f"{n}_{p}" for p, n in ((1000, "equivalent_potential_temperature"), (1000, "u_component_of_wind"), (1000, "v_component_of_wind"), (1000, "specific_humidity"), (925, "equivalent_potential_temperature"))]
    assert [len(m.channels()) for m in MODELS.values()] == [24, 25, 28, 28]
    assert get_model("model_1702").channel_names()[-5:] == [v for v, levels in get_model("model_1702").inputs if not levels]
    assert get_model("nbs_square_dilation_trof_tt_no_inst").served_indices() == [1, 2, 3, 4, 5, 6, 7]


@pytest.mark.parametrize(
    "make",
    [
        lambda: on((), "x"),
        lambda: Model("m", "", on((850, 850), "x")),
        lambda: Model("m", "", ()),
        lambda: Model("m", "", single("x", "x")),
        lambda: Model("m", "", single("x"), served=("hail",)),
        lambda: Model("m", "", on((850,), "x") + on((700,), "y")),
        lambda: check_sources(Model("m", "", single("odd"))),
    ],
)
def test_bad_manifests_are_refused(make):
    with pytest.raises(ValueError):
        make()
    with pytest.raises(KeyError, match="theta-e_uv_q"):
        get_model("nothing")


def test_assembly_from_a_synthetic_source(spark, tmp_path):
    grid = g.Grid(7, 12)
    source = SyntheticSource(spark, grid, seed=3)
    staged = stage(source, str(tmp_path), ["temperature", "specific_humidity", "u_component_of_wind", "v_component_of_wind", "10m_u_component_of_wind", "10m_v_component_of_wind", "2m_dewpoint_temperature"], [1000, 925, 850, 700, 500, 300], [0, 6], ["geopotential_at_surface"])
    assert staged.steps().count() == 14
    manifest = get_model("spix_wce_loss_modified_dilation")
    fields = staged.fields(["temperature", "specific_humidity", "u_component_of_wind", "v_component_of_wind", "10m_u_component_of_wind", "10m_v_component_of_wind", "2m_dewpoint_temperature"], manifest.levels, [0, 6])
    rows = assemble.assemble(fields, manifest, ["step"], grid, staged.static(["geopotential_at_surface"])).collect()
    assert len(rows) == 2 * 7 * 12 and all(len(x.channels) == 28 and None not in x.channels for x in rows)
    u = {(x.r, x.c): x.v for x in source.at_level("u_component_of_wind", 925, 6).collect()}
    assert all(x.channels[5] == u[x.r, x.c] for x in rows if x.step == 6)
    t = np.array([x.v for x in source.at_level("temperature", 1000, 0).collect()])
    assert abs(t.mean() - 288) < 3 and 2 < t.std() < 8
    with pytest.raises(ValueError, match="static"):
        assemble.assemble(fields, manifest, ["step"], grid)


def test_array_files(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(6.0).reshape(2, 3))
    (tmp_path / "b.npy").write_bytes(b"not an array")
    rows = read_arrays(spark, str(tmp_path)).collect()
    assert sorted((x.r, x.c, x.v) for x in rows if x.file == "a.npy") == [(k // 3, k % 3, float(k)) for k in range(6)]
    assert [x.error is not None for x in rows if x.file == "b.npy"] == [True]


def test_data_source_reads_by_format(spark):
    from isallobar.sources.fields import GridDataSource

    spark.dataSource.register(GridDataSource)
    found = spark.read.format("isallobar_grid").options(rows="4", cols="6", steps="0,6", variables="temperature,surface_pressure").load()
    assert found.count() == 2 * 2 * 24 and found.where("variable = 'surface_pressure' AND v < 90000").count() == 0


def test_impossible_names(spark):
    rows = spark.createDataFrame([("2026-08-20T18Z_f006.zarr",), ("2026-13-45T00Z_f000.zarr",), ("x",), (None,)], "n string")
    got = rows.select(names.embedded_date(F.col("n"), names.STORE).alias("d")).collect()
    assert [x.d is not None for x in got] == [True, False, False, False]
    with pytest.raises(Exception, match="not a store name"):
        rows.where("n = 'x'").select(names.side_name(F.col("n"), "fronts")).collect()
