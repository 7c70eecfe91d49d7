"""Aircraft states: positional arrays of mixed type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.functions.convert import epoch_to_timestamp, safe_boolean, safe_double, safe_int
from drayage.landed import parsed
from drayage.plans.regions import in_region

STATES_DDL = "time BIGINT, states ARRAY<ARRAY<STRING>>"
STATE_LENGTH = 17
# The slots without which a state is dropped - address, longitude and latitude.
MANDATORY_SLOTS = (0, 5, 6)

# What the service allows.
MINIMUM_GAP_SECONDS = 5.0
DAILY_QUOTA = {"anonymous": 100, "authenticated": 4000}

SCHEMA = (
    "time_ingest timestamp, icao24 string, callsign string, origin_country string, time_position timestamp, "
    "last_contact timestamp, longitude double, latitude double, geo_altitude double, on_ground boolean, "
    "velocity double, true_track double, vertical_rate double, sensors array<int>, baro_altitude double, "
    "squawk string, spi boolean, category int"
)


def aircraft_states(landed: DataFrame, region: str | None = None, on_error: str = "fail") -> DataFrame:
    """18 typed columns per valid state; a field that cannot be read is null, the state stays."""
    states = parsed(landed, STATES_DDL, on_error).select(
        F.col("doc.time").alias("polled"), F.explode("doc.states").alias("s")
    )

    def slot(i: int) -> Column:
        return F.get("s", F.lit(i))

    valid = F.size("s") >= STATE_LENGTH
    for i in MANDATORY_SLOTS:
        valid = valid & slot(i).isNotNull()
    rows = states.where(valid).select(
        epoch_to_timestamp(F.col("polled")).alias("time_ingest"),
        slot(0).alias("icao24"),
        slot(1).alias("callsign"),
        slot(2).alias("origin_country"),
        epoch_to_timestamp(slot(3)).alias("time_position"),
        epoch_to_timestamp(slot(4)).alias("last_contact"),
        safe_double(slot(5)).alias("longitude"),
        safe_double(slot(6)).alias("latitude"),
        safe_double(slot(7)).alias("geo_altitude"),
        safe_boolean(slot(8)).alias("on_ground"),
        safe_double(slot(9)).alias("velocity"),
        safe_double(slot(10)).alias("true_track"),
        safe_double(slot(11)).alias("vertical_rate"),
        F.from_json(slot(12), "ARRAY<INT>").alias("sensors"),
        safe_double(slot(13)).alias("baro_altitude"),
        slot(14).alias("squawk"),
        safe_boolean(slot(15)).alias("spi"),
        safe_int(slot(16)).alias("category"),
    )
    return rows if region is None else rows.where(in_region(region, F.col("latitude"), F.col("longitude")))
