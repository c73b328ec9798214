"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Words of the contracts that split at white space only, as a Java and RE2 pattern.
BLANK_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; a text of ASCII alone takes the faster built-in."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def row_key(doc_id: Column, text: Column) -> Column:
    """Digest of id and text; rows that agree in both share it, nulls are told from empty values."""
    return F.md5(
        F.concat(
            F.coalesce(doc_id.cast("string"), F.lit("-")),
            F.when(text.isNull(), F.lit("\n-")).otherwise(F.lit("\n+")),
            F.coalesce(text, F.lit("")),
        )
    )


def text_key(text: Column) -> Column:
    """Digest of a text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def fold(doc_id: object, folds: int) -> int:
    """CRC-32 of the id's text modulo ``folds``, as ``crc32`` gives it in SQL; a null id is in fold 0."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def count_rows(df: DataFrame) -> int:
    return df.count()
