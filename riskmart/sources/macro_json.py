"""Macro-economic observations: JSON payloads, long and wide form, incremental upsert."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.constants import MACRO_SERIES
from riskmart.functions.scalars import round_half_up

PAYLOAD = "observations array<map<string,string>>"


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload files, one JSON document each."""
    return spark.read.schema(PAYLOAD).option("multiLine", True).json(path)


def parse_payloads(df: DataFrame, column: str = "payload") -> DataFrame:
    return df.select(F.from_json(column, PAYLOAD)["observations"].alias("observations"))


def observations(payloads: DataFrame, *keep: str) -> DataFrame:
    """(obs_date, series, value text, keep…): one row per series and observation.

    Fields that are no objects are skipped; a payload without observations gives no rows.
    """
    one = payloads.select(*keep, F.explode("observations").alias("o"))
    entry = one.select(*keep, F.col("o")["d"].alias("obs_date"), F.explode(F.map_entries("o")).alias("e"))
    return entry.filter((F.col("e.key") != "d") & F.col("e.value").startswith("{")).select(
        "obs_date", F.col("e.key").alias("series"), F.get_json_object("e.value", "$.v").alias("value"), *keep)


def to_numbers(long: DataFrame) -> DataFrame:
    """Value as double; text that is no number becomes NULL."""
    return long.withColumn("value", F.col("value").try_cast("double"))


class NoSeriesError(RuntimeError):
    pass


def merge_series(long: DataFrame, series: Mapping[str, str] = MACRO_SERIES) -> DataFrame:
    """Wide table by date with one column per known series that has rows, as a full outer join would give.

    One grouping instead of a chain of joins. No known series at all is an error.
    """
    known = to_numbers(long).filter(F.col("series").isin(*series))
    present = {r["series"] for r in known.select("series").distinct().collect()}
    if not present:
        raise NoSeriesError("no series data")
    names = [s for s in series if s in present]
    wide = known.groupBy(F.col("obs_date").alias("date")).pivot("series", names).agg(F.max("value"))
    return wide.select("date", *[F.col(f"`{s}`").alias(series[s]) for s in names]).orderBy("date")


def pivot_seen(long: DataFrame) -> DataFrame:
    """Wide table with one text column per series that occurs (a feed has tens of series; Spark itself
    refuses more than ``spark.sql.pivotMaxValues``)."""
    return long.groupBy("obs_date").pivot("series").agg(F.max("value"))


def series_profile(wide: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows, first and last date and NULL share per series column, in one pass."""
    cols = [c for c in wide.columns if c != date_col]
    counts = wide.agg(F.count(F.lit(1)).alias("rows"), F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
                      *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).alias("null_rate")) for c in cols]))
    return counts.select("rows", "first_date", "last_date", each.alias("s")).select(
        F.col("s.series").alias("series"), "rows", "first_date", "last_date", round_half_up("s.null_rate", 3).alias("null_rate"))


def since(df: DataFrame, last_date: str, date_col: str = "obs_date") -> DataFrame:
    return df.filter(F.col(date_col) >= last_date)


def load_or_skip(rows: int | None) -> str:
    return "load" if rows else "skip"


def upsert(existing: DataFrame | None, incoming: DataFrame, *keys: str) -> DataFrame:
    """Existing rows without the incoming keys, plus the incoming rows."""
    keys = list(keys or ("obs_date",))
    if existing is None:
        return incoming
    return existing.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming, allowMissingColumns=True)


def newest_values(long: DataFrame) -> DataFrame:
    """``obs_date, series, value, _at, _file``: of several values of one observation that of the newest file."""
    age = F.struct("_at", "_file")
    return long.groupBy("obs_date", "series").agg(F.max_by(F.struct("value"), age).alias("v"), F.max(age).alias("a")).select(
        "obs_date", "series", "v.value", "a._at", "a._file")


def load_since(existing: DataFrame | None, long: DataFrame, last_date: str) -> tuple[str, DataFrame | None]:
    """("load", table with the newer observations) or ("skip", table as it is) when there are none."""
    fresh = since(long, last_date)
    action = load_or_skip(fresh.count())
    return action, (existing if action == "skip" else upsert(existing, fresh, "obs_date", "series"))
