"""Structured Streaming forms of the recurring jobs. They share the batch functions.

Every job runs with ``availableNow`` by default: it drains what has arrived and stops, which is how a
scheduler would start it; pass another trigger to keep it running.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskmart import constants as K
from riskmart.functions.scalars import record_key
from riskmart.operators.quality import domain_violations, validate_records
from riskmart.sources.macro_json import PAYLOAD, newest_values, observations, to_numbers
from riskmart.sources.raw_csv import null_tokens, read_text_stream, split_types
from riskmart.sources.tables import VersionedTable

DRAIN = {"availableNow": True}


def ingest_csv(spark: SparkSession, source: str, schema: T.StructType, good: str, quarantine: str, checkpoint: str,
               trigger: Mapping = DRAIN) -> StreamingQuery:
    """New CSV files to typed rows and quarantine. Each batch owns a folder, so a replay rewrites it."""
    text = null_tokens(read_text_stream(spark, source, schema.names))

    def write(batch: DataFrame, batch_id: int) -> None:
        ok, bad = split_types(batch, schema)
        ok.write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")

    return text.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def upsert_macro(spark: SparkSession, source: str, target: VersionedTable, checkpoint: str, trigger: Mapping = DRAIN,
                 files_per_batch: int = 1000) -> StreamingQuery:
    """New payload files into the (obs_date, series, value) table; the newest file's value wins.

    The table keeps the time and name of the file each value came from (``_at, _file``), so a file that comes in a later
    batch and is older changes nothing it has no newer value for. Payloads are one JSON document per line. Upserting a
    batch a second time changes nothing, so a replayed batch is harmless.
    """
    payloads = (spark.readStream.schema(PAYLOAD).option("maxFilesPerTrigger", files_per_batch).json(source)
                .withColumn("_at", F.col("_metadata.file_modification_time"))
                .withColumn("_file", F.col("_metadata.file_name")))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = to_numbers(newest_values(observations(batch, "_at", "_file")))
        target.replace(lambda current: rows if current is None else newest_values(current.unionByName(rows)))

    return payloads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def alert_rows(stream: DataFrame, target: str, checkpoint: str, strict: bool = True, trigger: Mapping = DRAIN) -> StreamingQuery:
    """Violating rows, with the broken conditions, appended to a table (exactly once through its log)."""
    return (domain_violations(stream, strict).writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start())


def score_applications(stream: DataFrame, score: Callable[[DataFrame], DataFrame], event_time: str, reuse: str = "1 hour",
                       inputs: Sequence[str] = K.FEATURES, bounds: Mapping[str, tuple] = K.RECORD_BOUNDS,
                       slices: int = 32) -> DataFrame:
    """Scored stream: invalid records are dropped, a record repeated within the reuse time is scored once.

    Repeats are removed in two steps: first per record and a slice of its arrival times, which spreads a
    record that floods the stream over many tasks, then per record among the few left. State holds the
    distinct records of the reuse time.
    """
    valid, _ = validate_records(stream, bounds)
    keyed = valid.withColumn("_key", record_key(*inputs)).withColumn(
        "_slice", F.pmod(F.xxhash64(event_time), F.lit(slices)).cast("int"))
    few = keyed.withWatermark(event_time, reuse).dropDuplicatesWithinWatermark(["_key", "_slice"])
    return score(few.dropDuplicatesWithinWatermark(["_key"])).drop("_key", "_slice")


def rejected_applications(stream: DataFrame, bounds: Mapping[str, tuple] = K.RECORD_BOUNDS) -> DataFrame:
    return validate_records(stream, bounds)[1]


def write_stream(df: DataFrame, target: str, checkpoint: str, trigger: Mapping = DRAIN) -> StreamingQuery:
    return (df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**trigger).start())
