"""Run the registered queries and their SQL twins side by side."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def twin(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    # whole numbers with nulls: floats in one engine's frame, a type of their own in the other's
    frame = frame.astype({name: "float64" for name, t in frame.dtypes.items() if str(t) == "Int64"})
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    """Empty when both hold the same rows under the same names."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} and {len(sql_frame)} rows"
    a, b = canonical(spark_frame), canonical(sql_frame)
    for name in a.columns:
        if str(a[name].dtype) != str(b[name].dtype):
            return f"types of {name}: {a[name].dtype} and {b[name].dtype}"
        unlike = (a[name] != b[name]) & ~(a[name].isna() & b[name].isna())
        if unlike.any():
            return f"{unlike.sum()} values of {name}: {a[unlike].head(3).to_dict('records')} {b[unlike].head(3).to_dict('records')}"
    return ""


def main(sf: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, wrong = twin(sf), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        begun = time.time()
        try:
            made = run(spark, sf).toPandas()
            middle = time.time()
            problem = difference(made, connection.execute(oracles[name]).df()) if name in oracles else "rows only"
        except Exception as error:  # noqa: BLE001
            made, middle, problem = [], time.time(), f"{type(error).__name__}: {str(error)[:600]}"
        wrong += problem not in ("", "rows only")
        print(f"{name:24s} {len(made):8d} rows {middle - begun:6.2f} s {time.time() - middle:6.2f} s  {problem or 'equal'}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
