"""Plausibility bounds of biometric readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted and normal ranges.
HEART_RATE = (30.0, 220.0)
HEART_RATE_USUAL = (40.0, 200.0)
SKIN_TEMPERATURE_C = (20.0, 42.0)
SKIN_TEMPERATURE_USUAL_C = (28.0, 37.0)
SKIN_CONDUCTIVITY = (0.0, 100.0)
ACCELEROMETER = (-20.0, 20.0)


def bounded(value: Column, bounds: tuple[float, float]) -> Column:
    """The value as a double inside the closed range, else null."""
    number = value.try_cast("double")
    return F.when(number.between(*bounds), number)


def range_flag(value: Column, usual: tuple[float, float]) -> Column:
    """``low`` / ``high`` / ``ok`` against a usual range, null for null."""
    return (
        F.when(value.isNull(), None)
        .when(value < usual[0], "low")
        .when(value > usual[1], "high")
        .otherwise("ok")
    )


def celsius(value: Column) -> Column:
    return (value - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)


def heart_rate(value: Column) -> Column:
    return bounded(value, HEART_RATE)


def heart_rate_flag(value: Column) -> Column:
    return range_flag(heart_rate(value), HEART_RATE_USUAL)


def skin_temperature(value: Column, unit: str = "C") -> Column:
    """Celsius inside the accepted range; Fahrenheit is converted first."""
    number = value.try_cast("double")
    return bounded(celsius(number) if unit == "F" else number, SKIN_TEMPERATURE_C)


def skin_temperature_flag(value: Column, unit: str = "C") -> Column:
    return range_flag(skin_temperature(value, unit), SKIN_TEMPERATURE_USUAL_C)


def skin_conductivity(value: Column) -> Column:
    return bounded(value, SKIN_CONDUCTIVITY)


def accelerometer(value: Column) -> Column:
    return bounded(value, ACCELEROMETER)


# The readings a sanitised row keeps, with their check.
SANITISED = {
    "heart_rate": heart_rate,
    "skin_temperature": skin_temperature,
    "skin_conductivity": skin_conductivity,
}


def sanitise(df: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and the three checked readings, bad ones null."""
    return df.select(*keep, *[check(F.col(c)).alias(c) for c, check in SANITISED.items()])


def rejected_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, how many readings of each kind the checks reject."""
    lost = [
        F.count_if(F.col(c).isNotNull() & check(F.col(c)).isNull()).alias(f"rejected_{c}")
        for c, check in SANITISED.items()
    ]
    return df.groupBy(*keys).agg(F.count("*").alias("readings"), *lost)
