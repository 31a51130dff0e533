"""Register CSV in/out, parameter JSON, the log sink and SQL views.

All IO is Spark's own readers and writers, so files are written and read in
parallel (one part file per partition) and any file system Spark supports
works. The register is always read with an explicit all-text schema: nothing
is inferred or cast on the way in.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.text import literal_table
from ..operators.delivery import otif
from ..operators.register import RAW_COLUMNS, clean_register
from ..params import DEFAULT, Params
from .staged import staged_path

# FIXED VALUES: the register's column headers as typed, in order
DISPLAY_HEADERS = ["SL No", "Party", "Project", "Incoterms", "Quote From", "Quote No.",
                   "Quote Date", "Validity Date", "Vertical", "Category", "Item", "Item Qty",
                   "Inquiry", "Inquiry Date", "Job No", "PO No", "PO Date", "PO Validity Date",
                   "DP Date", "Status", "LD", "LD Clause", "Payment Terms", "PO / Quote Value",
                   "Concerned Person"]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in DISPLAY_HEADERS])


def write_register_csv(raw: DataFrame, path: str) -> None:
    """The register as CSV with the as-typed headers, fixed column order."""
    (raw.select(*RAW_COLUMNS).toDF(*DISPLAY_HEADERS)
     .write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_register_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: read a register CSV as all text; blank cells become NULL and the
    headers are renamed to column names (``PO / Quote Value`` -> ``po_quote_value``)."""
    df = (spark.read.option("header", True).option("enforceSchema", False)
          .option("nullValue", "").schema(RAW_SCHEMA).csv(path))
    return df.toDF(*RAW_COLUMNS)


def _to_jsonable(v):
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, tuple):
        return [_to_jsonable(x) for x in v]
    if isinstance(v, dict):
        return {str(k): _to_jsonable(x) for k, x in v.items()}
    return v


def write_params_json(spark: SparkSession, params: Params, path: str) -> None:
    """Parameters as one JSON document."""
    import json
    doc = json.dumps({f.name: _to_jsonable(getattr(params, f.name))
                      for f in dataclasses.fields(params)})
    literal_table(spark, [(doc,)], [("value", "string")]).coalesce(1) \
        .write.mode("overwrite").text(path)


def read_params_json(spark: SparkSession, path: str) -> Params:
    """Parameters back from JSON (a single small document)."""
    import json
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    raw = json.loads(text)
    kw = {}
    for f in dataclasses.fields(Params):
        if f.name not in raw:
            continue
        v = raw[f.name]
        default = getattr(DEFAULT, f.name)
        if isinstance(default, dt.date):
            v = dt.date.fromisoformat(v)
        elif isinstance(default, tuple) and v is not None:
            v = tuple(tuple(x) if isinstance(x, list) else x for x in v)
        kw[f.name] = v
    return Params(**kw)


def write_log(log: DataFrame, path: str, fmt: str = "json") -> None:
    """The cleaning log or the checks' results, rebuilt on every run
    (overwrite, never appended)."""
    log.coalesce(1).write.mode("overwrite").format(fmt).save(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """A written log with the columns it was written with."""
    return spark.read.schema(schema).format(fmt).load(path)


def reloaded_register(raw: DataFrame) -> DataFrame:
    """S2 + S3: the register written as CSV and read back."""
    path = staged_path(raw.sparkSession, "register-csv")
    write_register_csv(raw, path)
    return read_register_csv(raw.sparkSession, path)


def reloaded_log(log: DataFrame) -> DataFrame:
    """S4 + S5: a log written twice to one place and read back."""
    path = staged_path(log.sparkSession, "log")
    for _ in range(2):
        write_log(log, path)
    return read_log(log.sparkSession, path, log.schema)


def otif_by_line(spark: SparkSession, tables, params: Params = DEFAULT) -> DataFrame:
    """Orders due and on time in full per product line, asked of the views in SQL."""
    register_views(spark, tables, params)
    return spark.sql("""
        SELECT product_line, COUNT(*) AS due, SUM(otif) AS otif, MAX(days_late) AS most_days_late
        FROM v_otif JOIN orders USING (order_id) GROUP BY product_line""")


def register_views(spark: SparkSession, tables, params: Params = DEFAULT) -> list[str]:
    """Every table plus the cleaned register and the OTIF view as temp views,
    so the questions can also be asked in Spark SQL."""
    names = []
    for name in tables.TABLES:
        tables[name].createOrReplaceTempView(name)
        names.append(name)
    clean_register(tables.raw_quote_register, tables.customers, params) \
        .createOrReplaceTempView("v_raw_register")
    otif(tables, params).createOrReplaceTempView("v_otif")
    return names + ["v_raw_register", "v_otif"]
