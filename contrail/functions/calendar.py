"""Calendar features of a scheduled departure (F14-F17, F19, F20) and route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: month -> season ------------------------------------------
WINTER_MONTHS = [12, 1, 2]
SPRING_MONTHS = [3, 4, 5]
SUMMER_MONTHS = [6, 7, 8]

WALL_CLOCK = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2})?)?$"


def parse_lenient(c: Column | str) -> Column:
    """Text -> timestamp; unparseable text gives NULL (``errors='coerce'``).

    Accepts ``yyyy-MM-dd HH:mm[:ss]``, the ``T`` separator and bare dates, and
    goes straight to a wall-clock time, so the session time zone (and its gaps)
    plays no part.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = F.trim(c)
    return F.when(F.rlike(text, F.lit(WALL_CLOCK)), text.try_cast("timestamp_ntz"))


def parse_strict(c: Column | str) -> Column:
    """ISO text with a blank or ``T`` separator; bad text raises (ANSI)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def epoch_micros(c: Column | str, ntz: bool) -> Column:
    """Microseconds since 1970-01-01 00:00.  For TIMESTAMP_NTZ the wall clock
    is read as UTC without going through the session time zone, so the value
    does not depend on ``spark.sql.session.timeZone``."""
    c = F.col(c) if isinstance(c, str) else c
    if ntz:
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), c)
    return F.unix_micros(c)


def season_of_month(month: Column) -> Column:
    return (
        F.when(month.isin(*WINTER_MONTHS), "winter")
        .when(month.isin(*SPRING_MONTHS), "spring")
        .when(month.isin(*SUMMER_MONTHS), "summer")
        .otherwise("autumn")
    )


def calendar_columns(ts: Column) -> dict[str, Column]:
    """departure_hour, day_of_week (English name, Monday first), month,
    season, is_weekend from a timestamp column."""
    month = F.month(ts)
    return {
        "departure_hour": F.hour(ts),
        "day_of_week": F.date_format(ts, "EEEE"),
        "month": month,
        "season": F.when(ts.isNotNull(), season_of_month(month)),
        "is_weekend": F.when(ts.isNotNull(), (F.weekday(ts) >= 5).cast("int")),
    }


def route_column(origin: str = "origin_airport", destination: str = "destination_airport") -> Column:
    """``ORIGIN-DEST``; NULL if either side is NULL."""
    return F.concat(F.col(origin), F.lit("-"), F.col(destination))


def enrich_features(df: DataFrame, ts_col: str = "scheduled_departure_local") -> DataFrame:
    """Add calendar fields and ``route`` only where the column is absent.

    A column that is present is kept even when it holds NULLs: presence, not
    ``coalesce``, decides.  Text timestamps are parsed strictly (F20).
    """
    out = df
    if ts_col in df.columns:
        ts = F.col(ts_col)
        if dict(df.dtypes)[ts_col] == "string":
            ts = parse_strict(ts)
        missing = {k: v for k, v in calendar_columns(ts).items() if k not in df.columns}
        if missing:
            out = out.withColumns(missing)
    if "route" not in df.columns and {"origin_airport", "destination_airport"} <= set(df.columns):
        out = out.withColumn("route", route_column())
    return out
