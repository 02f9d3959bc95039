"""Type-2 change history kept as plain tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = ("valid_from", "valid_to", "is_current", "row_hash")


def _hash(key: str, cols: Sequence[str]) -> Column:
    from riskmart.functions.scalars import record_key

    return record_key(key, *cols)


def scd2_start(incoming: DataFrame, key: str, check_cols: Sequence[str], as_of: str) -> DataFrame:
    """First snapshot: every row open from ``as_of``."""
    return incoming.withColumn("valid_from", F.lit(as_of).cast("timestamp")).withColumn(
        "valid_to", F.lit(None).cast("timestamp")).withColumn("is_current", F.lit(True)).withColumn(
        "row_hash", _hash(key, check_cols))


def scd2_apply(history: DataFrame, incoming: DataFrame, key: str, check_cols: Sequence[str], as_of: str) -> DataFrame:
    """Next version of the history table.

    A key whose checked columns differ (NULL equals NULL) gets its open row closed and a new one
    opened; new keys are opened; keys missing from ``incoming`` stay open. One join of the open rows
    with the incoming rows decides everything; closed rows are carried over untouched. The result must
    be written to a new place, see ``VersionedTable``.
    """
    now = F.lit(as_of).cast("timestamp")
    payload = [c for c in history.columns if c not in META]
    closed = history.filter(~F.col("is_current"))
    old = history.filter("is_current").select(F.struct(*history.columns).alias("o"), F.col(key).alias("_ko"))
    new = incoming.select(*payload).select(F.struct(*payload).alias("n"), F.col(key).alias("_kn"))
    pair = old.join(new, F.col("_ko").eqNullSafe(F.col("_kn")), "full")
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in check_cols])
    known, given = F.col("o").isNotNull(), F.col("n").isNotNull()
    changed = known & given & ~same
    kept = F.struct(*[F.col(f"o.{c}").alias(c) for c in payload], F.col("o.valid_from").alias("valid_from"),
                    F.when(changed, now).otherwise(F.col("o.valid_to")).alias("valid_to"),
                    (~changed).alias("is_current"), F.col("o.row_hash").alias("row_hash"))
    opened = F.struct(*[F.col(f"n.{c}").alias(c) for c in payload], now.alias("valid_from"),
                      F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"),
                      _hash_of("n", key, check_cols).alias("row_hash"))
    rows = F.array_compact(F.array(F.when(known, kept), F.when(changed | ~known, opened)))
    moved = pair.select(F.explode(rows).alias("r")).select("r.*")
    return closed.select(*payload, *META).unionByName(moved)


def _hash_of(struct: str, key: str, cols: Sequence[str]) -> Column:
    from riskmart.functions.scalars import record_key

    return record_key(*[F.col(f"{struct}.{c}") for c in (key, *cols)])


def as_of(history: DataFrame, moment: str) -> DataFrame:
    """Rows valid at a moment; intervals are closed on the left and open on the right."""
    t = F.lit(moment).cast("timestamp")
    return history.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def snapshot_source(fact: DataFrame) -> DataFrame:
    return fact.select("applicant_id", "credit_risk_segment", "composite_risk_score")


RISK_KEY, RISK_COLUMNS = "applicant_id", ("credit_risk_segment", "composite_risk_score")
