"""Column expressions: calendar parts, encodings, labels and load-time cleaning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# periods of the cyclical encodings: hours in a day, months in a year, days in a week
CYCLES = {"hour": 24, "month": 12, "day_of_week": 7}
WEEKEND = (5, 6)
DAYTIME = (6, 18)


def ntz(c: Column | str) -> Column:
    return F.col(c).cast("timestamp_ntz") if isinstance(c, str) else c.cast("timestamp_ntz")


def parse_ts(c: str) -> Column:
    """Text to wall-clock timestamp, null where the text is not a timestamp."""
    return F.expr(f"try_cast(`{c}` AS timestamp_ntz)")


def epoch_seconds_of(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_seconds(ts: str) -> Column:
    return epoch_seconds_of(F.col(ts))


def slot(ts: str, seconds: int) -> Column:
    """Start of the fixed-width slot a timestamp falls in."""
    s = epoch_seconds(ts)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(seconds))).cast("timestamp_ntz")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make missing floats null, so that aggregates skip them."""
    kinds = {"double", "float"}
    return df.select(
        *[
            F.nanvl(f.name, F.lit(None)).alias(f.name) if f.dataType.typeName() in kinds else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def missing(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(F.col(c).cast("double"))


def available(df: DataFrame, wanted: tuple[str, ...]) -> list[str]:
    """The wished-for columns that exist, in the order wished."""
    return [c for c in wanted if c in df.columns]


def calendar(ts: str) -> dict[str, Column]:
    t = F.col(ts)
    return {
        "hour": F.hour(t),
        "day_of_week": F.weekday(t),
        "month": F.month(t),
        "day_of_year": F.dayofyear(t),
    }


def cyclical(ts: str, parts: tuple[str, ...] = ("hour", "day_of_week", "month")) -> dict[str, Column]:
    cal = calendar(ts)
    out = {}
    for part in parts:
        angle = 2 * math.pi * cal[part] / CYCLES[part]
        out[f"{part}_sin"] = F.sin(angle)
        out[f"{part}_cos"] = F.cos(angle)
    return out


def day_flags(ts: str) -> dict[str, Column]:
    cal = calendar(ts)
    return {
        "is_weekend": cal["day_of_week"].isin(*WEEKEND).cast("int"),
        "is_daytime": cal["hour"].between(*DAYTIME).cast("int"),
    }


def interaction(a: str, b: str) -> Column:
    return F.col(a) * F.col(b) / 100.0


def wind_chill(temp: str, wind: str) -> Column:
    return F.col(temp) - F.col(wind) * 0.3


def heat_index(temp: str, humidity: str) -> Column:
    """Simplified heat index: Celsius in and out, computed in Fahrenheit."""
    t = F.col(temp) * 9.0 / 5.0 + 32.0
    rh = F.col(humidity)
    hi = 0.5 * (t + 61.0 + (t - 68.0) * 1.2 + rh * 0.094)
    return (hi - 32.0) * 5.0 / 9.0


def direction_label(slope: Column, threshold: float = 0.01) -> Column:
    return (
        F.when(F.abs(slope) < threshold, "stable").when(slope > 0, "increasing").otherwise("decreasing")
    )


def fit_label(r2: Column) -> Column:
    return F.when(r2 > 0.7, "strong").when(r2 > 0.3, "moderate").otherwise("weak")


def effect_label(effect: Column) -> Column:
    e = F.abs(effect)
    return (
        F.when(e < 0.2, "negligible").when(e < 0.5, "small").when(e < 0.8, "medium").otherwise("large")
    )


def component_label(strength: Column) -> Column:
    return F.when(strength > 0.6, "strong").when(strength > 0.3, "moderate").otherwise("weak")


def sign_label(r: Column) -> Column:
    return F.when(r > 0, "strong positive").otherwise("strong negative")


def format_minute(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd HH:mm")
