"""Message codecs (S3, S4, S5, S13) and stream subscriptions.

Decoding is permissive: malformed text, a null value or a JSON array under a
struct schema gives an all-null row; unknown keys are ignored; a JSON number
that does not fit the column type (``3.5`` for a long) nulls that field only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketpulse.functions.labels import nan_to_null
from marketpulse.functions.time import naive_utc
from marketpulse.schemas import ARTICLE_WIRE, TICK, TICK_WIRE
from marketpulse.session import file_system

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_FORMAT_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """ISO-8601 text to a naive-UTC instant; bad text gives null, never an
    error (plain ``cast`` aborts the query under ANSI mode).  Text without a zone
    is UTC, whatever the session's zone: it is read with a ``Z`` at its end, which
    text that names its own zone does not bear, and a date alone as midnight.  Text
    that ends in ``Z`` isn't tried with another one: no zone ends so, and Spark would
    find that out by a Java exception per row."""
    text = F.trim(F.col(column).cast("string"))
    as_utc = F.when(~F.endswith(text, F.lit("Z")), F.concat(text, F.lit("Z")).try_cast("timestamp"))
    instant = F.coalesce(as_utc, F.when(F.contains(text, F.lit(":")), text.try_cast("timestamp")))
    return df.withColumn(column, F.coalesce(naive_utc(instant), F.when(~F.contains(text, F.lit(":")), text.try_cast("timestamp_ntz"))))


def decode(df: DataFrame, schema: T.StructType = TICK_WIRE, value: str = "value",
           time_column: str | None = "timestamp", keep: tuple[str, ...] = ()) -> DataFrame:
    """Binary or string message value to typed columns (``keep``
    carries source columns such as the ingest sequence alongside).  NaN in a
    double column is a missing value.

    The struct is unpacked by a generator, which gives its one row also for a null one:
    a filter on columns of ``_m`` would be pushed below and parse the message again for
    each of its mentions of them."""
    text = F.col(value).cast("string")
    out = df.select(F.inline(F.array(F.from_json(text, schema))), *keep)
    out = out.withColumns({f.name: nan_to_null(f.name) for f in schema.fields if isinstance(f.dataType, T.DoubleType)})
    if time_column and time_column in schema.fieldNames():
        out = parse_time(out, time_column)
    return out


def decode_ticks(df: DataFrame, value: str = "value") -> DataFrame:
    return decode(df, TICK_WIRE, value)


def decode_articles(df: DataFrame, value: str = "value") -> DataFrame:
    return decode(df, ARTICLE_WIRE, value)


def iso_text(c, micros: bool = False) -> F.Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, ISO_FORMAT_MICROS if micros else ISO_FORMAT)


def encode(df: DataFrame, time_columns: tuple[str, ...] = ("timestamp",), micros: bool = False) -> DataFrame:
    """Each row as one JSON message in ``value`` (instants as ISO text,
    whole seconds as the producer writes them, or with ``micros``)."""
    cols = [iso_text(c, micros).alias(c) if c in time_columns else F.col(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a Kafka subscription (S1/S2); the connector jar is needed at run time."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_stream(spark: SparkSession, source: str, fmt: str = "kafka", schema: T.StructType | None = None,
                **options) -> DataFrame:
    """Subscribe to a message stream.  ``fmt="kafka"`` takes
    ``kafka_options``; a file format (``json``, ``parquet``, ``text``) reads a
    folder or glob of message files for offline runs and tests."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load() if fmt == "kafka" else reader.load(source)


def kafka_sequence() -> F.Column:
    """Ingest sequence of a Kafka record, unique per topic: partition in the
    high bits, offset in the low 40 bits (an offset beyond them is an error)."""
    offset = F.when(F.col("offset") < F.lit(1 << 40), F.col("offset")).otherwise(
        F.raise_error(F.lit("offset of 2**40 or more: no room for it in the ingest sequence")).cast("long"))
    return F.shiftleft(F.col("partition").cast("long"), 40) + offset


def read_ticks(spark: SparkSession, bootstrap_servers: str, topic: str = "ticks", **opts) -> DataFrame:
    """S1 + S3 + S5 over Kafka, with ``seq`` from the record's partition and
    offset (the cooldown's tie-break between equal instants)."""
    raw = read_stream(spark, topic, "kafka", **kafka_options(bootstrap_servers, topic, **opts))
    return decode(raw.withColumn("seq", kafka_sequence()), TICK_WIRE, keep=("seq",))


def read_articles(spark: SparkSession, bootstrap_servers: str, topic: str = "articles", **opts) -> DataFrame:
    """S2 + S4 + S5 over Kafka."""
    raw = read_stream(spark, topic, "kafka", **kafka_options(bootstrap_servers, topic, **opts))
    return decode_articles(raw)


def publish(df: DataFrame, bootstrap_servers: str, topic: str, time_columns: tuple[str, ...] = ("timestamp",),
            micros: bool = True, checkpoint: str | None = None, **trigger):
    """S13 sink: JSON messages to a Kafka topic (no message key), from a batch or,
    with a ``checkpoint``, from a stream (returns the query).  Instants keep their
    microseconds unless ``micros`` is off, so messages of one second keep their order."""
    messages = encode(df, time_columns, micros)
    options = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    if df.isStreaming:
        return messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    return messages.write.format("kafka").options(**options).save()


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table with known columns; before its first row an empty frame."""
    fs, cls = file_system(spark, path)
    if not fs.exists(cls(path)):
        return spark.createDataFrame([], schema)
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # a folder without a file
            raise
        return spark.createDataFrame([], schema)


def scan_ticks(spark: SparkSession, path: str, since=None, until=None, schema: T.StructType = TICK) -> DataFrame:
    """The tick history table with an optional time range ``[since, until)``.
    A history written with a ``date`` partition column is pruned by it; the
    instant bounds are pushed to the Parquet row-group statistics either way.  A
    history that nothing was written to yet is an empty frame of ``schema``."""
    df = read_or_empty(spark, path, schema)
    has_date = "date" in df.columns
    if since is not None:
        lo = F.lit(since).cast("timestamp_ntz")
        df = df.where(F.col("timestamp") >= lo)
        if has_date:
            df = df.where(F.col("date") >= F.to_date(lo))
    if until is not None:
        hi = F.lit(until).cast("timestamp_ntz")
        df = df.where(F.col("timestamp") < hi)
        if has_date:
            df = df.where(F.col("date") <= F.to_date(hi))
    return df.drop("_id")
