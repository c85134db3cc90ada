"""Weather labels, units, severity scores and climate defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from faremill.functions.basics import flag

# WMO weather codes with their group and wording.
WMO_CODES = {
    0: ("Clear", "clear sky"),
    1: ("Clear", "mainly clear"),
    2: ("Clouds", "partly cloudy"),
    3: ("Clouds", "overcast"),
    45: ("Fog", "fog"),
    48: ("Fog", "depositing rime fog"),
    51: ("Drizzle", "light drizzle"),
    53: ("Drizzle", "moderate drizzle"),
    55: ("Drizzle", "dense drizzle"),
    61: ("Rain", "slight rain"),
    63: ("Rain", "moderate rain"),
    65: ("Rain", "heavy rain"),
    71: ("Snow", "slight snow"),
    73: ("Snow", "moderate snow"),
    75: ("Snow", "heavy snow"),
    80: ("Rain", "slight rain showers"),
    81: ("Rain", "moderate rain showers"),
    82: ("Rain", "violent rain showers"),
    95: ("Thunderstorm", "thunderstorm"),
    96: ("Thunderstorm", "thunderstorm with hail"),
}

INHG_PER_HPA = 0.02953
METRES_PER_MILE = 1609.34
MPH_PER_MS = 2.23694
MM_PER_INCH = 25.4

# What a feature holds when nothing is known about the weather.
NEUTRAL = {
    "temperature": 72.0,
    "feels_like": 74.0,
    "humidity": 60.0,
    "pressure": 1013.0,
    "wind_speed": 5.0,
    "clouds": 30.0,
    "precipitation": 0.0,
    "snow": 0.0,
    "weather_severity": 1.0,
    "is_raining": 0,
    "is_snowing": 0,
    "is_heavy_rain": 0,
    "is_heavy_snow": 0,
    "is_extreme_weather": 0,
    "is_poor_visibility": 0,
}


# Fixed value: the visibility of a live reading that has none, in metres.
CLEAR_VIEW_M = 10000.0


def wmo_labels(code: str = "weathercode") -> dict[str, Column]:
    """Group and wording of a WMO code from a literal map; an unlisted code is Unknown."""
    pairs = []
    for number, (group, text) in WMO_CODES.items():
        pairs += [F.lit(number), F.struct(F.lit(group).alias("main"), F.lit(text).alias("description"))]
    found = F.try_element_at(F.create_map(*pairs), F.col(code).cast("int"))
    return {
        "weather_main": F.coalesce(found["main"], F.lit("Unknown")),
        "weather_description": F.coalesce(found["description"], F.lit("unknown")),
    }


def hpa_to_inhg(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0)) * INHG_PER_HPA


def metres_to_miles(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0)) / METRES_PER_MILE


def celsius_to_fahrenheit(value: Column) -> Column:
    return value * 9.0 / 5.0 + 32.0


def ms_to_mph(value: Column) -> Column:
    return value * MPH_PER_MS


def inches_to_mm(value: Column) -> Column:
    return value * MM_PER_INCH


def temp_category(temperature: str = "temperature") -> Column:
    """Right-closed temperature bands; a missing temperature has no band."""
    t = F.col(temperature)
    return (
        F.when(t <= 32, "freezing").when(t <= 50, "cold").when(t <= 65, "cool").when(t <= 80, "warm").when(t > 80, "hot")
    )


def severity_score() -> Column:
    """Additive severity, 0 to 12; a comparison with a missing reading adds nothing."""
    points = [
        (F.col("precipitation") > 0, 2),
        (F.col("precipitation") > 0.1, 2),
        (F.col("snow") > 0, 3),
        (F.col("snow") > 1, 2),
        (F.col("wind_speed") > 20, 1),
        (F.col("visibility") < 5, 2),
    ]
    total = F.lit(0)
    for condition, weight in points:
        total = total + flag(condition) * weight
    return total.cast("int")


def weather_flags() -> dict[str, Column]:
    return {
        "weather_severity": severity_score(),
        "is_raining": flag(F.col("precipitation") > 0),
        "is_snowing": flag(F.col("snow") > 0),
        "is_heavy_rain": flag(F.col("precipitation") > 0.1),
        "is_heavy_snow": flag(F.col("snow") > 1),
        "is_extreme_weather": flag(severity_score() >= 5),
        "is_poor_visibility": flag(F.col("visibility") < 5),
    }


def severe_simple(wind: str = "wind_speed", precipitation: str = "precipitation") -> Column:
    return flag((F.col(wind) > 20) | (F.col(precipitation) > 5))


def live_tiers() -> dict[str, Column]:
    """Features of a live metric reading: °C, m/s, mm, metres.

    A missing reading takes the neutral value; a missing reading in a comparison counts as none.
    """
    temp, wind = F.col("temp_c"), F.col("wind_ms")
    fahrenheit, mph = celsius_to_fahrenheit(temp), ms_to_mph(wind)
    heavy_rain, heavy_snow = flag(F.col("rain_mm") >= 5.0), flag(F.col("snow_mm") >= 5.0)
    raining, snowing = flag(F.col("rain_mm") > 0.1), flag(F.col("snow_mm") > 0.1)
    severity = (
        F.when((heavy_rain == 1) | (heavy_snow == 1), 5.0)
        .when((raining == 1) | (snowing == 1), 3.0)
        .when(F.col("cloud_pct") > 70, 2.0)
        .otherwise(1.0)
    )
    return {
        "temperature": F.coalesce(fahrenheit, F.lit(NEUTRAL["temperature"])),
        "feels_like": F.coalesce(fahrenheit - F.lit(0.7) * F.greatest(F.lit(0.0), mph - 3.0), fahrenheit, F.lit(NEUTRAL["temperature"])),
        "wind_speed": F.coalesce(mph, F.lit(NEUTRAL["wind_speed"])),
        "humidity": F.coalesce("humidity_pct", F.lit(NEUTRAL["humidity"])),
        "pressure": F.coalesce("pressure_hpa", F.lit(NEUTRAL["pressure"])),
        "clouds": F.coalesce("cloud_pct", F.lit(NEUTRAL["clouds"])),
        "precipitation": F.coalesce("rain_mm", F.lit(NEUTRAL["precipitation"])),
        "snow": F.coalesce("snow_mm", F.lit(NEUTRAL["snow"])),
        "visibility_m": F.coalesce("visibility_m", F.lit(CLEAR_VIEW_M)),
        "is_raining": raining,
        "is_snowing": snowing,
        "is_heavy_rain": heavy_rain,
        "is_heavy_snow": heavy_snow,
        "is_poor_visibility": flag(F.col("visibility_m") < 1500),
        "weather_severity": severity,
        "is_extreme_weather": flag(severity >= 5.0),
    }


def serving_weather() -> dict[str, Column]:
    """Weather columns of a served request from its temperature, wind, inches of precipitation and rain and snow flags.

    Humidity, pressure and clouds are fixed there; severity counts rain once and snow twice; where it snows, the precipitation is snow.
    """
    rain, wind = F.col("precipitation"), F.col("wind_speed")
    raining, snowing = F.col("is_raining") == 1, F.col("is_snowing") == 1
    return {
        "feels_like": F.col("temperature") - 5.0,
        "humidity": F.lit(60.0),
        "pressure": F.lit(1013.0),
        "clouds": F.lit(50.0),
        "snow": F.when(snowing, rain).otherwise(0.0),
        "weather_severity": (flag(raining) + flag(snowing) * 2).cast("double"),
        "is_heavy_rain": flag(rain > 0.3),
        "is_heavy_snow": flag(snowing & (rain > 0.5)),
        "is_extreme_weather": flag((rain > 0.5) | (wind > 25)),
        "is_poor_visibility": flag((rain > 0.2) | snowing),
    }


# Climate rules as (months, hours, changed readings, label, reason); within a month
# group a later rule refines the earlier one.
CLIMATE_RULES = (
    ((12, 1, 2), (0, 23), {"temperature": 38.0, "feels_like": 34.0, "clouds": 55.0, "weather_severity": 3.0}, "Cold / Clear", "Winter cool conditions"),
    ((1, 2), (0, 9), {"snow": 0.2, "is_snowing": 1, "weather_severity": 5.0, "clouds": 80.0, "is_poor_visibility": 1}, "Cold / Snow", "Morning winter snowfall"),
    ((6, 7, 8), (0, 23), {"temperature": 85.0, "feels_like": 88.0, "humidity": 65.0, "clouds": 35.0, "weather_severity": 2.0}, "Warm / Sunny", "Typical summer day"),
    ((7, 8), (15, 19), {"precipitation": 0.08, "is_raining": 1, "clouds": 70.0, "weather_severity": 3.0}, "Warm / Light rain", "Late-day summer shower"),
    ((3, 4, 5), (0, 23), {"temperature": 62.0, "feels_like": 63.0, "humidity": 58.0, "clouds": 45.0, "weather_severity": 2.0}, "Mild / Partly cloudy", "Spring variability"),
    ((4,), (0, 11), {"precipitation": 0.05, "is_raining": 1, "clouds": 75.0}, "Cool / Light rain", "Morning spring drizzle"),
    ((9, 10, 11), (0, 23), {"temperature": 60.0, "feels_like": 60.0, "humidity": 55.0, "clouds": 40.0, "weather_severity": 2.0}, "Cool / Clear", "Autumn conditions"),
    ((11,), (0, 8), {"clouds": 65.0, "precipitation": 0.04, "is_raining": 1}, "Cool / Light rain", "Early autumn shower"),
)


def climate_defaults(month: str = "pickup_month", hour: str = "pickup_hour") -> dict[str, Column]:
    """Fifteen weather columns, a label and a reason from month and hour alone."""
    m, h = F.col(month), F.col(hour)
    out = {name: F.lit(value) for name, value in NEUTRAL.items()}
    out["weather_label"] = F.lit("Mild / Clear")
    out["weather_reason"] = F.lit("Typical transitional conditions")
    for months, (first, last), changes, label, reason in CLIMATE_RULES:
        hit = m.isin(*months) & h.between(first, last)
        for name, value in {**changes, "weather_label": label, "weather_reason": reason}.items():
            out[name] = F.when(hit, F.lit(value)).otherwise(out[name])
    return out
