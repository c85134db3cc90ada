"""Holiday calendar and calendar joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from faremill.functions.basics import flag


# Base entries for 2022 as (date, name, type, major), in list order.
BASE_ENTRIES = (
    ("2022-01-01", "New Year's Day", "federal", True),
    ("2022-01-17", "Martin Luther King Jr. Day", "federal", False),
    ("2022-02-21", "Presidents' Day", "federal", False),
    ("2022-05-30", "Memorial Day", "federal", True),
    ("2022-06-20", "Juneteenth", "federal", False),
    ("2022-07-04", "Independence Day", "federal", True),
    ("2022-09-05", "Labor Day", "federal", True),
    ("2022-10-10", "Columbus Day", "federal", False),
    ("2022-11-11", "Veterans Day", "federal", False),
    ("2022-11-24", "Thanksgiving", "federal", True),
    ("2022-12-25", "Christmas Day", "federal", True),
    ("2022-12-26", "Christmas (Observed)", "federal", True),
    ("2022-01-31", "Chinese New Year (Lunar)", "cultural", False),
    ("2022-03-17", "St. Patrick's Day", "cultural", True),
    ("2022-03-17", "St. Patrick's Day Parade", "parade", True),
    ("2022-04-15", "Good Friday", "religious", False),
    ("2022-04-17", "Easter Sunday", "religious", False),
    ("2022-06-12", "Puerto Rican Day Parade", "parade", True),
    ("2022-11-06", "NYC Marathon", "sporting", True),
    ("2022-11-24", "Macy's Thanksgiving Day Parade", "parade", True),
    ("2022-12-31", "New Year's Eve", "celebration", True),
    ("2022-11-25", "Black Friday", "shopping", True),
    ("2022-11-28", "Cyber Monday", "shopping", False),
    ("2022-12-24", "Christmas Eve", "holiday_week", True),
    ("2022-12-23", "Christmas Week", "holiday_week", False),
    ("2022-12-27", "Christmas Week", "holiday_week", False),
    ("2022-12-28", "Christmas Week", "holiday_week", False),
    ("2022-12-29", "Christmas Week", "holiday_week", False),
    ("2022-12-30", "New Year's Eve Week", "holiday_week", False),
)


def base_calendar(spark: SparkSession, entries=BASE_ENTRIES) -> DataFrame:
    """The entries as a literal table in list order."""
    quoted = [(i, day, name.replace("'", "\\'"), kind, major) for i, (day, name, kind, major) in enumerate(entries)]
    rows = ", ".join(f"({i}, date'{day}', '{name}', '{kind}', {str(major).lower()})" for i, day, name, kind, major in quoted)
    return spark.sql(f"select * from values {rows} as t(list_order, date, name, type, major)")


def surrounding_days(base: DataFrame) -> DataFrame:
    """The day before and after each major entry, named after the first entry of that date.

    Entries are taken by date and list order; order_no repeats that order for later tie-breaks.
    """
    first_name = F.first("name").over(Window.partitionBy("date").orderBy("list_order"))
    sides = F.array(
        F.struct(F.lit(-1).alias("shift"), F.lit("Day Before ").alias("prefix")),
        F.struct(F.lit(1).alias("shift"), F.lit("Day After ").alias("prefix")),
    )
    return (
        base.withColumn("first_name", first_name)
        .where("major")
        .select("date", "list_order", "first_name", F.inline(sides))
        .select(
            F.date_add("date", F.col("shift")).alias("date"),
            F.concat("prefix", "first_name").alias("name"),
            F.lit("surrounding").alias("type"),
            F.lit(False).alias("major"),
            F.col("date").alias("source_date"),
            "list_order",
            "shift",
        )
    )


def holiday_calendar(base: DataFrame) -> DataFrame:
    """One row per date: base entries first, then surrounding days, each in list order."""
    listed = base.select("date", "name", "type", "major", F.lit(0).alias("tier"), F.col("date").alias("source_date"), "list_order", F.lit(0).alias("shift"))
    extra = surrounding_days(base).select("date", "name", "type", "major", F.lit(1).alias("tier"), "source_date", "list_order", "shift")
    first = Window.partitionBy("date").orderBy("tier", "source_date", "list_order", "shift")
    return (
        listed.unionByName(extra)
        .withColumn("place", F.row_number().over(first))
        .where("place = 1")
        .select("date", "name", "type", "major", F.date_format("date", "EEEE").alias("day_of_week"))
    )


def holiday_flags(trips: DataFrame, calendar: DataFrame, date: str = "pickup_date") -> DataFrame:
    """Calendar membership and membership among the major dates."""
    side = calendar.select(F.col("date").alias(date), F.col("major").alias("_major")).groupBy(date).agg(F.bool_or("_major").alias("_major"))
    return (
        trips.join(side, date, "left")
        .withColumns({"is_holiday": flag(F.col("_major").isNotNull()), "is_major_holiday": flag(F.col("_major"))})
        .drop("_major")
    )


def holiday_week_flag(trips: DataFrame, calendar: DataFrame, date: str = "pickup_date", reach: int = 3) -> DataFrame:
    """Within reach days of a major date: the range is laid out as dates and joined by equality."""
    near = calendar.where("major").select(F.explode(F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda s: F.date_add("date", s))).alias(date))
    side = near.distinct().withColumn("_near", F.lit(True))
    return trips.join(side, date, "left").withColumn("is_holiday_week", flag(F.col("_near"))).drop("_near")


def days_around(trips: DataFrame, calendar: DataFrame, date: str = "pickup_date", reach: int = 3) -> DataFrame:
    """Days to the strictly next and since the strictly previous holiday; 0 beyond reach."""
    for name, sign in (("days_to_holiday", -1), ("days_from_holiday", 1)):
        offsets = calendar.select("date", F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("gap"))
        side = offsets.groupBy(F.date_add("date", F.col("gap") * sign).alias(date)).agg(F.min("gap").alias(name))
        trips = trips.join(side, date, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return trips


def attach_holidays(trips: DataFrame, calendar: DataFrame, date: str = "pickup_date") -> DataFrame:
    """Holiday, major holiday and holiday week in a single join on the date."""
    listed = calendar.select(F.col("date").alias(date), F.lit(1).alias("h"), F.col("major").cast("int").alias("m"), F.lit(0).alias("w"))
    near = calendar.where("major").select(
        F.explode(F.transform(F.sequence(F.lit(-3), F.lit(3)), lambda s: F.date_add("date", s))).alias(date),
        F.lit(0).alias("h"), F.lit(0).alias("m"), F.lit(1).alias("w"),
    )
    side = listed.unionByName(near).groupBy(date).agg(
        F.max("h").alias("is_holiday"), F.max("m").alias("is_major_holiday"), F.max("w").alias("is_holiday_week")
    )
    names = ("is_holiday", "is_major_holiday", "is_holiday_week")
    return trips.join(side, date, "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in names})
