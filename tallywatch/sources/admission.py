"""The backlog of a feed, admitted by event date in groups of bounded size.

A first load that took all days at once would hold the ids of the whole history in the
state of one micro-batch, and days taken out of order would be late. Admitted by date,
each group moves the watermark on before the next one comes, so the state never holds
more than twice the watermark's days and one group.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = r"\d{4}-\d{2}-\d{2}"


@dataclass(frozen=True)
class Group:
    """Days taken together; ``None`` in place of the days stands for all files left."""

    days: tuple[dt.date, ...] | None
    size: int

    def path(self, folder: str) -> str:
        """Files and folders directly in the feed folder whose names hold one of the days."""
        if self.days is None:
            return folder
        return f"{folder}/{{{','.join(f'*{day}*' for day in self.days)}}}"


def feed_days(spark: SparkSession, folder: str) -> DataFrame:
    """Files and bytes of every day of the feed; the day is null where no name directly in the folder holds a date.

    Only the listing is read, not the files.
    """
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    base = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toUri().getPath()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    below = F.element_at(F.split(F.substring_index("path", f"{base}/", -1), "/"), 1)
    day = F.regexp_extract(below, DATE, 0).try_cast("date").alias("day")
    return files.groupBy(day).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def groups(sizes: dict[dt.date, int], done: Collection[dt.date], most_bytes: int) -> list[Group]:
    """Days in order, as many as fit into ``most_bytes`` together and one at least.

    ``sizes`` gives the bytes of every day, ``done`` the days that a finished group has
    taken. The last group asks for the whole folder: files without a date, files that come
    to a finished day, and files that arrived after the listing are taken there, as they
    would be without groups. A day is never split, since its files are in no order; the
    watermark keeps the ids of whole days anyway.
    """
    found: list[Group] = []
    for day in sorted(set(sizes) - set(done)):
        last = found[-1] if found else None
        if last is not None and last.size + sizes[day] <= most_bytes:
            found[-1] = Group((*last.days, day), last.size + sizes[day])
        else:
            found.append(Group((day,), sizes[day]))
    return [*found[:-1], Group(None, found[-1].size if found else 0)]
