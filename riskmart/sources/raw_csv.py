"""CSV ingestion with NULL tokens, an error policy, a quarantine and audit columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.constants import NULL_TOKENS
from riskmart.functions.scalars import count_where
from riskmart.sources.schemas import FILES, raw_schema

CONTINUE, ABORT = "CONTINUE", "ABORT_STATEMENT"

# fixed values: column type names of tabular frames -> Spark types; anything else is text
FRAME_TYPES = {
    "int64": T.LongType(), "float64": T.DoubleType(), "object": T.StringType(), "bool": T.BooleanType(),
    "datetime64[ns]": T.TimestampNTZType(), "datetime64[us]": T.TimestampNTZType(),
}


def spark_type(frame_type: str) -> T.DataType:
    return FRAME_TYPES.get(frame_type, T.StringType())


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _csv_options(reader):
    return reader.option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")


def read_text(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Every column as text, by position. Short rows are padded with NULL, extra fields are dropped.

    No corrupt-record column is asked for, so a row of another width is not an error.
    """
    return _csv_options(spark.read.schema(text_schema(names))).csv(path)


def read_text_stream(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    return _csv_options(spark.readStream.schema(text_schema(names))).csv(path)


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn the NULL spellings of text columns into NULL."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in texts})


def _misfits(schema: T.StructType) -> list[tuple[T.StructField, Column]]:
    """Typed columns, each with the condition that its text does not fit."""
    return [(f, F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
            for f in schema.fields if not isinstance(f.dataType, T.StringType)]


def _any_misfit(schema: T.StructType) -> Column:
    return reduce(lambda a, b: a | b, [c for _, c in _misfits(schema)], F.lit(False))


def _fitted(schema: T.StructType) -> list[Column]:
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]


def quarantine(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with text that does not fit its type, as read, with the list of the columns at fault."""
    reasons = [F.when(bad, F.concat_ws(" ", F.lit(f.name), F.lit("is no"), F.lit(f.dataType.simpleString()))) for f, bad in _misfits(schema)]
    return text.filter(_any_misfit(schema)).withColumn("reasons", F.array_compact(F.array(*reasons or [F.lit(None).cast("string")])))


def split_types(text: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantine): a row with text that does not fit its type goes to the quarantine as
    read, with the list of the columns at fault. One narrow pass each."""
    return text.filter(~_any_misfit(schema)).select(*_fitted(schema)), quarantine(text, schema)


def typed_and_counted(text: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observation]:
    """Typed rows, and an observation whose ``misfits`` tells, once they are written, how many rows did not fit."""
    seen = Observation()
    judged = text.select(*_fitted(schema), _any_misfit(schema).alias("_misfit"))
    return judged.observe(seen, count_where(F.col("_misfit")).alias("misfits")).filter(~F.col("_misfit")).drop("_misfit"), seen


class LoadError(RuntimeError):
    pass


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType, on_error: str = CONTINUE) -> tuple[DataFrame, DataFrame]:
    """Typed rows and quarantine; in abort mode any quarantined row raises."""
    return _typed(path, read_text(spark, path, schema.names), schema, on_error)


def _typed(path: str, text: DataFrame, schema: T.StructType, on_error: str) -> tuple[DataFrame, DataFrame]:
    good, bad = split_types(null_tokens(text), schema)
    if on_error == ABORT:
        first = bad.limit(1).collect()
        if first:
            raise LoadError(f"{path}: {first[0]['reasons']}")
    return good, bad


def read_delivered_csv(spark: SparkSession, path: str, schema: T.StructType,
                       on_error: str = CONTINUE) -> tuple[DataFrame, DataFrame]:
    """Like ``read_raw_csv``, but columns are found by the file's header in any case and order.

    Delivered files carry many more columns than the models read; only those of ``schema`` are parsed
    into rows. The header itself costs one read of a file's first line.
    """
    return _typed(path, _delivered_text(spark, path, schema), schema, on_error)


def _delivered_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    text = _csv_options(spark.read).csv(path)
    have = {c.lower(): c for c in text.columns}
    missing = [n for n in schema.names if n.lower() not in have]
    if missing:
        raise LoadError(f"{path}: no column {', '.join(missing)}")
    return text.select(*[F.col(f"`{have[n.lower()]}`").alias(n) for n in schema.names])


def load_delivery(spark: SparkSession, folder: str, target: str, now: datetime | None = None) -> DataFrame:
    """Load every delivered file of the folder into ``target``, each on its own, with its load time; the
    quarantined rows of a table go beside it. Returns the report of ``load_many``.

    A file is parsed once: the pass that writes its typed rows counts those that do not fit. Only where there are any
    a second pass writes the quarantine, which is an empty table otherwise.
    """
    unfit: dict[str, tuple[DataFrame, Observation]] = {}

    def read(table: str, file: str) -> DataFrame:
        text = null_tokens(_delivered_text(spark, f"{folder}/{file}", raw_schema(table)))
        good, seen = typed_and_counted(text, raw_schema(table))
        unfit[table] = quarantine(text, raw_schema(table)), seen
        return with_loaded_at(good, now)

    def set_aside(table: str) -> None:
        bad, seen = unfit[table]
        full_refresh(bad if seen.get["misfits"] else bad.limit(0), f"{target}/quarantine/{table}")

    return load_many(spark, {t: lambda t=t, f=f: read(t, f) for t, f in FILES.items()}, target, set_aside)


# Texts of any other form are no numbers. A cast that fails builds its error message for each value, which costs far more.
_PAD = r"[\x00-\x20\x7f]*"
WHOLE_FORM = rf"^{_PAD}[-+]?[0-9]++{_PAD}$"
NUMBER_FORM = rf"(?i)^{_PAD}[-+]?(nan|inf|0x|([0-9]++(\.[0-9]*+)?|\.[0-9]++)(e[-+]?[0-9]+)?[fd]?{_PAD}$)"


def number_of(v: Column, form: str, kind: str) -> Column:
    """``v.try_cast(kind)``, tried only on texts of the form."""
    return F.when(v.rlike(form), v.try_cast(kind))


def infer_table_schema(spark: SparkSession, path: str, sample_rows: int | None = None) -> T.StructType:
    """Types from all rows in one aggregation, or from the first ``sample_rows``: whole numbers without gaps, numbers, true/false without gaps, else text.
    Names come out in upper case."""
    lines = spark.read.option("header", True).option("quote", '"').csv(path)
    head = null_tokens(lines if sample_rows is None else lines.limit(sample_rows))
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(head.columns):
        v = F.col(f"`{c}`")
        aggs += [F.count(v).alias(f"v{i}"), F.count(number_of(v, WHOLE_FORM, "bigint")).alias(f"l{i}"),
                 F.count(number_of(v, NUMBER_FORM, "double")).alias(f"d{i}"),
                 F.count(F.when(F.lower(v).isin("true", "false"), 1)).alias(f"b{i}")]
    seen = head.agg(*aggs).first()
    fields = []
    for i, c in enumerate(head.columns):
        values, full = seen[f"v{i}"], seen[f"v{i}"] == seen["_n"]
        if full and values and seen[f"l{i}"] == values:
            kind = "int64"
        elif seen[f"d{i}"] == values:
            kind = "float64"
        elif full and seen[f"b{i}"] == values:
            kind = "bool"
        else:
            kind = "object"
        fields.append(T.StructField(c.upper(), spark_type(kind)))
    return T.StructType(fields)


def with_loaded_at(df: DataFrame, now: datetime | None = None, name: str = "loaded_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp() if now is None else F.lit(now))


def full_refresh(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_many(spark: SparkSession, loads: Mapping[str, Callable[[], DataFrame]], target: str,
              after: Callable[[str], None] | None = None) -> DataFrame:
    """Load each table on its own; a failing one is reported and does not stop the others. ``after`` is called with
    the name of each table that was written, and fails its load if it raises."""
    report = []
    for name, read in loads.items():
        try:
            full_refresh(read(), f"{target}/{name}")
            if after is not None:
                after(name)
            report.append((name, "ok", spark.read.parquet(f"{target}/{name}").count(), None))
        except Exception as e:  # noqa: BLE001 - the report carries the reason
            report.append((name, "failed", None, f"{type(e).__name__}: {str(e).splitlines()[0][:300]}"))
    return spark.createDataFrame(report, "table string, status string, rows bigint, error string")
