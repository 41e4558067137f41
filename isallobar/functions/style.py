"""Display rules: probability bins, colours, symbols, and clean GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Colours and labels of the classes.
CLASS_STYLE = {
    "cold": ("#3987e5", "Cold"),
    "warm": ("#d62728", "Warm"),
    "stationary": ("#199e70", "Stationary"),
    "occluded": ("#9085e9", "Occluded"),
    "dryline": ("#c98500", "Dryline"),
    "trough": ("#8c8c8c", "Trough"),
    "tropical_trough": ("#8c8c8c", "Tropical trough"),
}
OTHER_COLOUR = "#888888"
# Colours of the pressure layer.
PRESSURE_COLOURS = {"H": "#1f5fbf", "L": "#c0392b", "other": "#39424f"}
# Probability bins.
DISCARD_BELOW, BIN_WIDTH, BINS = 0.05, 0.1, 10
# Symbols along a line as (class, period, shape, colour class, place, side).
SYMBOLS = (
    ("cold", 26, "triangle", "cold", 0.5, "same"),
    ("warm", 26, "semicircle", "warm", 0.5, "same"),
    ("occluded", 52, "triangle", "occluded", 0.25, "same"),
    ("occluded", 52, "semicircle", "occluded", 0.75, "same"),
    ("stationary", 52, "triangle", "cold", 0.25, "same"),
    ("stationary", 52, "semicircle", "warm", 0.75, "opposite"),
)
DASHED = ("dryline", "trough")
#: Classes whose line itself is drawn in two colours.
TWO_COLOURED = ("stationary",)
LINE_CLASSES = {
    "cold_front": "cold",
    "warm_front": "warm",
    "stationary_front": "stationary",
    "occluded_front": "occluded",
    "dryline": "dryline",
    "trough": "trough",
    "tropical_trough": "tropical_trough",
}


def band_opacity(bin_: Column) -> Column:
    return (bin_ + 1) / F.lit(float(BINS))


def bin_of_opacity(opacity: Column) -> Column:
    """The bin that an opacity stands for: halves round up, ends are clamped."""
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), (F.floor(opacity * BINS + 0.5) - 1).cast("int")))


def bin_label(bin_: Column) -> Column:
    low = F.when(bin_ == 0, F.lit(DISCARD_BELOW)).otherwise(bin_ * BIN_WIDTH)
    return F.concat(F.format_string("%.2f", low), F.lit("–"), F.format_string("%.1f", (bin_ + 1) * BIN_WIDTH))


def bin_boundaries(spark: SparkSession) -> DataFrame:
    """(index, value, label, labelled) of the edges between bins; every second one is labelled."""
    edges = spark.range(BINS + 1).select(F.col("id").cast("int").alias("index"), F.when(F.col("id") == 0, F.lit(DISCARD_BELOW)).otherwise(F.round(F.col("id") * BIN_WIDTH, 10)).alias("value"))
    return edges.select("index", "value", tick_label(F.col("value")).alias("label"), (F.col("index") % 2 == 0).alias("labelled"))


def tick_label(value: Column) -> Column:
    return F.when(value < BIN_WIDTH, F.format_string("%.2f", value)).otherwise(F.format_string("%.1f", value))


def rgb(hex_: Column) -> Column:
    """``#rrggbb`` as three shares."""
    return F.array(*(F.conv(F.substring(hex_, k, 2), 16, 10).cast("double") / 255 for k in (2, 4, 6)))


def class_alpha(pixel: Column, colour: Column) -> Column:
    """Least-squares opacity of a class colour over white that gives a pixel; 0 for white."""
    pairs = F.arrays_zip(pixel.alias("p"), colour.alias("c"))
    total = F.aggregate(
        pairs,
        F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("d")),
        lambda a, x: F.struct((a["n"] + (1 - x["p"]) * (1 - x["c"])).alias("n"), (a["d"] + (1 - x["c"]) * (1 - x["c"])).alias("d")),
    )
    return F.when(total["d"] == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(total["n"], total["d"]))))


def line_colour(cls: Column) -> Column:
    """Colour of a front line; stationary fronts share the cold colour."""
    out = F.when(cls == "stationary", CLASS_STYLE["cold"][0])
    for name, (colour, _) in CLASS_STYLE.items():
        if name != "stationary":
            out = out.when(cls == name, colour)
    return out.otherwise(OTHER_COLOUR)


def centre_colour(kind: Column) -> Column:
    return F.when(kind == "H", PRESSURE_COLOURS["H"]).when(kind == "L", PRESSURE_COLOURS["L"]).otherwise(PRESSURE_COLOURS["other"])


def symbol_image(cls: Column, side: Column) -> Column:
    """Name of the symbol image of a class, null for classes without symbols."""
    known = sorted({s[0] for s in SYMBOLS})
    return F.when(cls.isin(*known), F.concat(F.lit("front-sym-"), cls, F.when(side == "right", "-right").otherwise("-left")))


def symbol_table(spark: SparkSession) -> DataFrame:
    """The symbol patterns as rows (cls, period, shape, colour, place, side)."""
    rows = [(c, p, s, CLASS_STYLE[k][0], a, side) for c, p, s, k, a, side in SYMBOLS]
    return spark.createDataFrame(rows, "cls string, period int, shape string, colour string, place double, side string")


def is_dashed(cls: Column) -> Column:
    return cls.isin(*DASHED)


def shown_dashed(cls: Column, visible: list[str]) -> Column:
    return cls.isin(*visible) & is_dashed(cls)


def shown_solid(cls: Column, oriented: Column, visible: list[str]) -> Column:
    """Lines drawn solid: not dashed, and not two-coloured ones that are oriented."""
    return cls.isin(*visible) & ~is_dashed(cls) & ~(cls.isin(*TWO_COLOURED) & oriented)


def shown_symbols(cls: Column, oriented: Column, period: int, visible: list[str]) -> Column:
    own = sorted({s[0] for s in SYMBOLS if s[1] == period} & set(visible))
    return (cls.isin(*own) if own else F.lit(False)) & oriented


def shown_label(kind: Column, major: Column, zoom: Column, least_zoom: float) -> Column:
    """Isobar labels: major ones always, others from a zoom on."""
    return (kind == "isobar") & (major | (zoom >= least_zoom))


def line_features(collections: DataFrame) -> DataFrame:
    """Front lines that can be drawn, from GeoJSON texts.

    ``collections`` has ``step`` and ``geojson``.  Of each MultiLineString with a known name, every part of
    two or more points becomes a row; the side of a part that names none is left.
    """
    shape = "oriented boolean, features array<struct<geometry:struct<type:string,coordinates:array<array<array<double>>>>,properties:struct<event_id:string,name:string,summary:struct<symbol_sides:array<string>>>>>"
    read = collections.select("step", F.from_json("geojson", shape).alias("j"))
    each = read.select("step", F.coalesce("j.oriented", F.lit(False)).alias("oriented"), F.explode("j.features").alias("f"))
    known = F.create_map(*(F.lit(x) for pair in LINE_CLASSES.items() for x in pair))
    named = each.withColumn("cls", known[F.col("f.properties.name")]).where(F.col("cls").isNotNull() & (F.col("f.geometry.type") == "MultiLineString"))
    parts = named.select("step", "oriented", "cls", F.col("f.properties.event_id").alias("event_id"), F.col("f.properties.name").alias("name"), F.col("f.properties.summary.symbol_sides").alias("sides"), F.posexplode("f.geometry.coordinates").alias("part", "coordinates"))
    side = F.when(F.get("sides", F.col("part")) == "right", "right").otherwise("left")
    return parts.where(F.size("coordinates") >= 2).select("step", "event_id", "name", "cls", "part", side.alias("side"), "oriented", "coordinates")


def pressure_features(collections: DataFrame) -> DataFrame:
    """Pressure features of a known kind, with its geometry and a finite pressure, from GeoJSON texts."""
    shape = "features array<struct<geometry:struct<type:string>,properties:struct<kind:string,hpa:string,major:boolean>>>"
    each = collections.select("step", F.explode(F.from_json("geojson", shape)["features"]).alias("f"))
    flat = each.select("step", F.col("f.properties.kind").alias("kind"), F.col("f.geometry.type").alias("geometry"), F.expr("try_cast(trim(f.properties.hpa) AS DOUBLE)").alias("hpa"), F.coalesce("f.properties.major", F.lit(False)).alias("major"))
    fits = F.when(F.col("kind") == "isobar", F.col("geometry") == "LineString").when(F.col("kind").isin("H", "L"), F.col("geometry") == "Point").otherwise(False)
    finite = F.col("hpa").isNotNull() & ~F.isnan("hpa") & (F.abs("hpa") < float("inf"))
    return flat.where(fits & finite).select("step", "kind", "hpa", "major")


def missing_kinds(kinds: Column, want_centres: bool = True, want_isobars: bool = True) -> Column:
    """Status text naming the pressure kinds that a step lacks, empty if none."""
    lacks = [F.when(~F.array_contains(kinds, "isobar"), "isobars")] if want_isobars else []
    lacks += [F.when(~F.array_contains(kinds, "H") & ~F.array_contains(kinds, "L"), "centres")] if want_centres else []
    text = F.array_join(F.array(*lacks), " or ") if lacks else F.lit("")
    return F.when(text == "", "").otherwise(F.concat(F.lit("("), text, F.lit(" for this step)")))
