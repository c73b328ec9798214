"""JSON-lines feed to Bronze rows, for batch and streaming readers alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators.contract import BRONZE_SCHEMA, CONTRACT


def _misfit(name: Column, value: Column) -> Column:
    """True for a field the contract does not know, or a value its type rejects."""
    rejected = [
        (name == field) & value.isNotNull() & value.try_cast(kind).isNull()
        for field, kind in CONTRACT.items()
        if kind != "string"
    ]
    unknown = ~name.isin(*CONTRACT)
    for condition in rejected:
        unknown = unknown | condition
    return unknown


def parse(lines: DataFrame) -> DataFrame:
    """Bronze rows from a ``value`` column of JSON lines.

    Contract fields stay text, as landed. Fields outside the contract and values
    that will not cast are kept as JSON in ``_rescued_data``; so is a line that
    is not JSON at all. Blank lines are skipped.
    """
    fields = lines.where(F.trim("value") != "").withColumn(
        "_fields", F.from_json("value", "map<string,string>")
    )
    misfits = F.map_filter("_fields", _misfit)
    rescued = F.when(F.col("_fields").isNull(), F.to_json(F.struct(F.col("value").alias("_line")))).when(
        F.size(misfits) > 0, F.to_json(misfits)
    )
    return fields.select(
        *[F.try_element_at("_fields", F.lit(name)).alias(name) for name in CONTRACT],
        rescued.alias("_rescued_data"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )


def read_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The whole feed at once: for a backfill or a rebuild."""
    return parse(read_lines(spark, folder))


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(folder)


#: Files count however old they are beside the newest one; the source's own limit of
#: seven days would skip copied backfills. The price is that the log of seen files keeps
#: every name.
FILE_AGE = "36500d"


def stream_feed(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Files not seen before, each exactly once; ``folder`` may be a pattern that names part of the feed."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("maxFileAge", FILE_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse(reader.text(folder))


def infer_fields(spark: SparkSession, folder: str, sample: float = 0.01) -> dict[str, str]:
    """Types a reader would infer from part of the feed, to compare with the contract."""
    frame = spark.read.option("recursiveFileLookup", "true").json(
        folder, samplingRatio=sample, primitivesAsString=False
    )
    return {field.name: field.dataType.simpleString() for field in frame.schema}


def read_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BRONZE_SCHEMA).parquet(folder)


def stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(BRONZE_SCHEMA).option("maxFileAge", FILE_AGE).parquet(folder)
