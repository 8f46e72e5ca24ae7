"""Days and windows in each store's own time zone; order times are zone-less UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.times import micros
from basketloom.schema import require_columns

UTC = "UTC"


def local_time(when: Column, zone: Column) -> Column:
    """Zone-less local time of a zone-less UTC time; doesn't depend on the session's zone."""
    return F.convert_timezone(F.lit(UTC), zone, when)


def utc_time(when: Column, zone: Column) -> Column:
    """Zone-less UTC time of a zone-less local time; a local time that a clock change skips becomes the one after it."""
    return F.convert_timezone(zone, F.lit(UTC), when)


def with_zone(orders: DataFrame, zones: DataFrame) -> DataFrame:
    """Orders with the ``zone`` of their store from (kiosk_id, zone); stores that aren't listed are in UTC."""
    require_columns(zones, ["kiosk_id", "zone"])
    return orders.join(zones.select("kiosk_id", "zone").dropDuplicates(["kiosk_id"]), "kiosk_id", "left").withColumn(
        "zone", F.coalesce("zone", F.lit(UTC)))


def local_daily_totals(orders: DataFrame, zones: DataFrame) -> DataFrame:
    """(kiosk_id, zone, day, lines, quantity, hours): totals of each local day, and how long that day is (23 to 25 hours)."""
    day = local_time(F.col("order_dt"), F.col("zone")).cast("date")
    totals = with_zone(orders, zones).where("order_dt IS NOT NULL").groupBy("kiosk_id", "zone", day.alias("day")).agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))
    begin, end = (utc_time(d.cast("timestamp_ntz"), F.col("zone")) for d in (F.col("day"), F.date_add("day", 1)))
    return totals.withColumn("hours", ((micros(end) - micros(begin)) / 3_600_000_000).cast("double"))


def inference_window_local(orders: DataFrame, zones: DataFrame, last_n_days: int = 90) -> DataFrame:
    """The lines of each store's last ``last_n_days`` calendar days, up to the local day of the newest order of all.

    The cut is a local midnight: one UTC time for each zone, of which there are a few hundred at most.
    """
    newest = orders.agg(F.max("order_dt")).scalar()
    placed = with_zone(orders, zones)
    first = F.date_sub(local_time(newest, F.col("zone")).cast("date"), last_n_days - 1)
    cuts = placed.select("zone").distinct().withColumn("_from", utc_time(first.cast("timestamp_ntz"), F.col("zone")))
    return placed.join(F.broadcast(cuts), "zone").where(F.col("order_dt") >= F.col("_from")).select(*orders.columns, "zone")


def split_by_local_day(orders: DataFrame, zones: DataFrame, val_from: str, test_from: str) -> DataFrame:
    """Orders with ``split``: train, val or test by the calendar day in the store's zone; no line of a local day is parted."""
    placed = with_zone(orders, zones)
    day = local_time(F.col("order_dt"), F.col("zone")).cast("date")
    part = F.when(day < F.lit(val_from).cast("date"), "train").when(day < F.lit(test_from).cast("date"), "val").when(day.isNotNull(), "test")
    return placed.withColumn("split", part)
