"""Scans of the driver's Parquet tables.

Every reader selects only the columns the order book needs, so the Parquet
scan's ReadSchema is pruned and any later filter is pushed into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey"],
    "part": ["p_partkey", "p_type", "p_size"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_shipdate"],
    "documents": ["doc_id", "text"],
}


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str,
         columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path(sf_dir, name))
    cols = columns if columns is not None else COLUMNS.get(name)
    return df.select(*cols) if cols else df
