"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.session import file_system, scratch_path

#: ASCII white space, and a word between it (the same text in Java, RE2 and Python)
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that go to a Python worker at once; whole documents are larger than Spark's default is made for
ARROW_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again.

    Cuts the lineage, keeps what was expensive to make, and gives the planner
    the table's true size. Lost executors don't matter: the folder is shared."""
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(ARROW_ROWS)
    conf.set(ARROW_ROWS, BATCH_ROWS)
    try:
        df.write.parquet(path)
    finally:
        conf.set(ARROW_ROWS, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing needs any more; other frames are left alone."""
    for df in tables:
        path = vars(df).get("stored_at")
        if path:
            fs, cls = file_system(df.sparkSession, path)
            fs.delete(cls(path), True)


def whole(text: Column) -> Column:
    """A document's text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def n_points(text: Column) -> Column:
    """Code points of a text as long."""
    return F.char_length(text).cast("long")
