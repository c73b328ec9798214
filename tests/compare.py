"""Compare every registered query with its SQL oracle.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()  # fmt: skip


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        cells = []
        for cell in row:
            if cell is None or cell is pd.NaT or (isinstance(cell, float) and cell != cell):
                cells.append("null")
            elif hasattr(cell, "isoformat"):
                cells.append(str(pd.Timestamp(cell)))
            elif isinstance(cell, str):
                cells.append(cell)
            else:
                cells.append(repr(round(float(cell), 9)))
        rows.append(tuple(cells))
    return sorted(rows)


def difference(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> str | None:
    """None when equal, else a short description."""
    if sorted(spark_frame.columns) != sorted(oracle_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(oracle_frame.columns)}"
    ours, theirs = normal(spark_frame), normal(oracle_frame)
    if ours == theirs:
        return None
    only_ours = sorted(set(ours) - set(theirs))[:3]
    only_theirs = sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} vs {len(theirs)} rows; only ours {only_ours}; only oracle {only_theirs}"


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            frame = queries()[name](spark, sf_dir).toPandas()
        except Exception as error:  # report and go on with the next query
            print(f"{name}: ERROR {str(error)[:800]}", flush=True)
            continue
        seconds = time.time() - start
        if name not in oracle_sql():
            print(f"{name}: rows only, {len(frame)} rows, {seconds:.1f}s\n{frame.head(3)}", flush=True)
            continue
        try:
            problem = difference(frame, connection.sql(oracle_sql()[name]).df())
        except Exception as error:
            problem = f"oracle ERROR {str(error)[:800]}"
        print(f"{name}: {problem or 'ok'}, {len(frame)} rows, {seconds:.1f}s", flush=True)


if __name__ == "__main__":
    main()
