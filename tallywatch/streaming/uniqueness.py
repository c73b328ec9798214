"""One row per id over the whole history of a table, without scanning it.

Every batch stores bitmaps of its ids, one set for each date: an id's hash gives a
position, the position a bucket and a bit, and the bits of a bucket form one binary
value. The number of positions follows the rows of the batch, so about one in
``SPARSE`` is set. A new batch is held against the bitmaps of all dates together; the
few ids that may be there are held against each date, and only those that may be in a
date are looked up in its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.session import written

#: Positions for each id, as a power of two.
SPARSE = 4
#: Bits of one bitmap, as a power of two; fixed by ``bitmap_construct_agg``.
BITMAP = 15


def _position(id_column: str, width: Column) -> Column:
    return F.xxhash64(id_column).bitwiseAND(F.expr("9223372036854775807")) % F.pow(F.lit(2.0), width).cast("long")


def _buckets(rows: DataFrame, id_column: str) -> DataFrame:
    """``bucket`` and ``bit`` of each id under its ``width``."""
    placed = rows.withColumn("position", _position(id_column, F.col("width")))
    return placed.withColumns({"bucket": F.shiftright("position", BITMAP), "bit": F.col("position").bitwiseAND(F.lit((1 << BITMAP) - 1))}).drop("position")


def _holds(bits: str, bit: str) -> Column:
    byte = F.conv(F.hex(F.expr(f"substring({bits}, cast({bit} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2.0), F.col(bit) % 8).cast("int")) > 0


def id_filters(rows: DataFrame, id_column: str, date_column: str) -> DataFrame:
    """``width, date, bucket, bits`` of the ids of a batch."""
    n = rows.count()
    width = max(BITMAP, (max(n, 1) - 1).bit_length() + SPARSE)
    placed = _buckets(rows.select(id_column, F.col(date_column).alias("date"), F.lit(width).alias("width")), id_column)
    return placed.groupBy("width", "date", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def unseen(rows: DataFrame, id_column: str, date_column: str, table: DataFrame, filters: list[str]) -> DataFrame:
    """The rows whose id ``table`` does not hold; ``filters`` are the folders of its ``id_filters``."""
    if not filters or rows.isEmpty():
        return rows
    stored = rows.sparkSession.read.parquet(*filters)
    widths = [r[0] for r in stored.select("width").distinct().collect()]  # at most a few dozen
    asked = _buckets(rows.select(id_column, F.explode(F.array(*[F.lit(w) for w in widths])).alias("width")), id_column)
    whole = stored.groupBy("width", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    perhaps = written(asked.join(whole, ["width", "bucket"]).where(_holds("bits", "bit")).drop("bits"), "perhaps")
    dated = perhaps.join(stored, ["width", "bucket"]).where(_holds("bits", "bit")).select(id_column, F.col("date").alias(date_column)).distinct()
    dated = written(dated, "perhaps-dates")
    dates = [r[0] for r in dated.select(date_column).distinct().collect()]  # one row for each date
    if not dates:
        return rows
    held = table.where(F.col(date_column).isin(dates)).select(id_column, date_column).join(dated, [id_column, date_column], "left_semi")
    known = written(held.select(id_column), "perhaps-held")  # few: the table is read once, however often the result is
    return rows.join(known, id_column, "left_anti").select(*rows.columns)
