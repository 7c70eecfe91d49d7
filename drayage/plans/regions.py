"""Named regions as latitude and longitude boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.scratch import stage

# Lowest and highest latitude, lowest and highest longitude, edges included.
REGIONS: dict[str, tuple[float, float, float, float]] = {
    "EUROPE": (35.0, 72.0, -25.0, 45.0),
    "NORTH_AMERICA": (7.0, 72.0, -168.0, -60.0),
    "SOUTH_AMERICA": (-56.0, 15.0, -90.0, -30.0),
    "ASIA": (-10.0, 82.0, 45.0, 180.0),
    "AUSTRALIA": (-50.0, -10.0, 110.0, 180.0),
    "AFRICA": (-35.0, 37.0, -20.0, 52.0),
    "GLOBAL": (-90.0, 90.0, -180.0, 180.0),
}
DEFAULT_REGION = "NORTH_AMERICA"


def in_region(region: str, latitude: Column, longitude: Column) -> Column:
    """A plain range predicate, so it reaches the scan."""
    name = region.upper()
    if name not in REGIONS:
        raise ValueError(f"no region is called '{region}'; there are {', '.join(REGIONS)}")
    south, north, west, east = REGIONS[name]
    return latitude.between(south, north) & longitude.between(west, east)


def regions_of(latitude: Column, longitude: Column) -> Column:
    """The names of all regions a point lies in; boxes overlap.  No join is needed for seven boxes."""
    return F.array_compact(
        F.array(*[F.when(in_region(name, latitude, longitude), F.lit(name)) for name in REGIONS])
    )


def with_regions(points: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """One row per point and region it lies in."""
    return points.withColumn("region", F.explode(regions_of(F.col(latitude), F.col(longitude))))


FINEST_LEVEL = 20
SALTS = 16


def in_boxes(
    points: DataFrame, boxes: DataFrame, latitude: str = "latitude", longitude: str = "longitude", salts: int = SALTS
) -> DataFrame:
    """One row per point and box it lies in, for any table of boxes.

    ``boxes`` has ``south``, ``north``, ``west`` and ``east``, edges included, and whatever else is wanted from it;
    names of columns must not clash.  A box whose west is larger than its east reaches over the date line;
    one whose south is larger than its north, or with a null, holds nothing.  Points without a
    latitude or longitude are in no box.

    The sphere is cut into square cells, half as wide on every further level.  A box is listed on the
    level whose cells are at least half its size, under the nine cells at most that cover it; a point is
    asked for once on every level that has a box.  The join is one of equal cells, so no point meets
    boxes far away, and the exact test follows.  Cells that hold more points than half a shuffle
    partition, such as the few of the coarse levels, are counted first; their points are spread by a
    salt, and only boxes listed there are copied for each salt.

    Boxes under their cells are many times the table of boxes, which Spark's estimate does not know; so
    both sides are shuffled and merged, whatever the estimate, and neither is gathered anywhere.
    """
    parts = F.when(
        F.col("west") > F.col("east"),
        F.array(
            F.struct(F.col("west").alias("w"), F.lit(180.0).alias("e")),
            F.struct(F.lit(-180.0).alias("w"), F.col("east").alias("e")),
        ),
    ).otherwise(F.array(F.struct(F.col("west").cast("double").alias("w"), F.col("east").cast("double").alias("e"))))
    one = boxes.withColumn("_part", F.explode(parts)).where("south <= north")
    extent = F.greatest(F.col("north") - F.col("south"), F.col("_part.e") - F.col("_part.w"), F.lit(1e-9))
    level = F.greatest(F.lit(0), F.least(F.lit(FINEST_LEVEL), F.floor(F.log2(F.lit(720.0) / extent)))).cast("int")
    listed = one.withColumn("_level", level)

    def cell(degrees: str) -> Column:
        return F.floor(F.col(degrees) * F.pow(F.lit(2.0), F.col("_level")) / 360)

    listed = listed.withColumn("_y", F.explode(F.sequence(cell("south"), cell("north")))).withColumn(
        "_x", F.explode(F.sequence(cell("_part.w"), cell("_part.e")))
    )
    # At most one number for each level, whatever the number of boxes.
    levels = sorted(row[0] for row in one.select(level.alias("l")).distinct().collect())
    asked = points.where(F.col(latitude).isNotNull() & F.col(longitude).isNotNull())
    asked = asked.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    asked = asked.withColumns({"_y": cell(latitude), "_x": cell(longitude)})
    place = ["_level", "_y", "_x"]
    counts = stage(asked.groupBy(*place).agg(F.count("*").alias("_n")), "cells")
    shares = 2 * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    # Fewer than ``shares`` cells, by arithmetic, so they can be broadcast.
    crowded = F.broadcast(counts.where(F.col("_n") * shares > total).select(*place, F.lit(True).alias("_crowded")))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    asked = asked.withColumn("_spread", spread).join(crowded, place, "left")
    asked = asked.withColumn("_salt", F.when(F.col("_crowded"), F.col("_spread")).otherwise(0)).drop("_crowded", "_spread")
    copies = F.when(F.col("_crowded"), salts - 1).otherwise(0)
    listed = listed.join(crowded, place, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), copies)))
    listed = listed.drop("_crowded")
    inside = F.col(latitude).between(F.col("south"), F.col("north")) & F.col(longitude).between(
        F.col("_part.w"), F.col("_part.e")
    )
    found = asked.join(listed.hint("merge"), [*place, "_salt"]).where(inside)
    return found.drop(*place, "_salt", "_part")
