"""Materialised order book: derive a stage once, write Parquet, read many times.

The stages are written to the shared folder the cluster names in
``spark.checkpoint.dir``, keyed by a fingerprint of the source files (path,
length and modification time of every file, as the file system lists them) and
of the rule code. A stage is written when a query first asks for a table made
from it, so a query waits for the stages below its own tables only; ``build``
writes them all. An application writes into a folder of its own, and a stage is
read by others once its write is committed, so applications that build at the
same time do not touch each other's files and a reader sees whole stages only.
Reading the stages back cuts the derivation lineage; a lost executor only
recomputes from those files. Tables that are projections of a stage (order lines,
orders, dispatches, invoices) are not written a second time.
Keyed stages are bucketed by their key (fact tables by order key) and sorted inside
each bucket: joins and groupings on the key need no shuffle, and row-group
statistics prune key lookups. The lines are shuffled once, into the buckets; what is
joined to them bucket by bucket is written in place. The number of buckets follows
the sources' size, so that a task holds about as many rows at any size.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..params import DEFAULT, Params
from ..functions.text import literal_table
from ..session import shared_dir, shuffles_freed
from . import adapter, tpch

# The stages, with the column each is clustered by, in waves: those of one wave do not
# depend on each other. The internal ones (leading underscore) are the shared
# intermediates of the derivation.
WAVES = [
    [("_lines", "order_id"), ("customers", "customer_id"), ("items", "item_id"), ("payment_terms", None)],
    [("_order_base", "K")],
    [("_dispatch_rows", "order_id"), ("quotations", "quote_id"), ("quotation_lines", "quote_id"),
     ("raw_quote_register", None), ("po_document_dates", "sl_no"), ("register_links", "sl_no")],
    [("fx_monthly", None), ("payments", "invoice_id")],
]
STAGES = [s for wave in WAVES for s in wave]
#: Stages whose derivation leaves the rows of a bucket in one task.
IN_PLACE = {"_lines", "_dispatch_rows"}
SOURCES = ["region", "nation", "customer", "part", "orders", "lineitem"]
_LOCK = threading.RLock()
_BUILT: dict[str, StoredBook] = {}


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def source_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every data file under ``path``, on any
    file system Spark reads; partition subfolders included."""
    fs, p = _file_system(spark, path)
    found = fs.listFiles(p, True)
    out = []
    while found.hasNext():
        f = found.next()
        if not f.getPath().getName().startswith(("_", ".")):
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def fingerprint(spark: SparkSession, sf_dir: str, params: Params) -> str:
    h = hashlib.sha256()
    for name in SOURCES:
        h.update(repr(source_files(spark, tpch.path(sf_dir, name))).encode())
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for rel in ("sources/adapter.py", "vocab.py", "functions/numeric.py", "functions/text.py",
                "sources/store.py"):
        with open(os.path.join(here, rel), "rb") as fh:
            h.update(fh.read())
    h.update(repr(params).encode())
    return h.hexdigest()[:16]


#: Bytes of the largest source that one bucket is meant to stand for.
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 8
#: Of the stages' files, which stay on disk through all queries.
COMPRESSION = "zstd"


def bucket_count(spark: SparkSession, sf_dir: str) -> int:
    """A power of two that grows with the order lines."""
    size = sum(f[1] for f in source_files(spark, tpch.path(sf_dir, "lineitem")))
    n = LEAST_BUCKETS
    while n * BUCKET_BYTES < size:
        n *= 2
    return n


def _write(df: DataFrame, path: str, cluster: str | None, table: str, buckets: int, in_place: bool) -> None:
    with shuffles_freed(df.sparkSession):
        if cluster:
            rows = df if in_place else df.repartition(buckets, cluster)
            (rows.write.bucketBy(buckets, cluster).sortBy(cluster).option("compression", COMPRESSION)
             .option("path", path).format("parquet").saveAsTable(table))
        else:
            df.write.option("compression", COMPRESSION).parquet(path)


def _read(spark: SparkSession, path: str, cluster: str | None, table: str, buckets: int) -> DataFrame:
    """The written table, with its buckets made known to this session's catalog."""
    if not cluster:
        return spark.read.parquet(path)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({cluster}) SORTED BY ({cluster}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def _first(spark: SparkSession, pattern: str) -> str | None:
    fs, p = _file_system(spark, pattern)
    found = fs.globStatus(p) or []
    return min((f.getPath().getParent().getParent().toString() for f in found), default=None)


def published(spark: SparkSession, root: str) -> str | None:
    """The first published build below ``root``, by name."""
    return _first(spark, f"{root}/run-*/_published/_SUCCESS")


class StoredBook(adapter.OrderBook):
    """The order book whose stages are written when first asked for, or read where a
    build of the same sources has written them."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params, root: str):
        super().__init__(spark, sf_dir, params)
        self.root = root
        self.whole = published(spark, root)
        self.run = self.whole or f"{root}/run-{uuid.uuid4().hex}"
        self.buckets = bucket_count(spark, sf_dir)

    def _read(self, name: str) -> DataFrame:
        rows = super()._read(name)
        return rows.repartition(self.buckets, "l_orderkey") if name == "lineitem" else rows

    def stage(self, name: str, cluster: str | None, anywhere: bool = True) -> DataFrame:
        """The stage's files, written first where none are committed."""
        runs = f"{self.root}/run-*" if anywhere else self.run
        done = self.whole or _first(self.spark, f"{runs}/{name}/_SUCCESS")
        run = done or self.run
        table = f"orderbook_{run[-12:]}_{name}"
        if not done:
            rows = getattr(adapter.OrderBook, name).func(self)
            try:
                _write(rows, f"{run}/{name}", cluster, table, self.buckets, name in IN_PLACE)
            except Exception:
                self.run = f"{self.root}/run-{uuid.uuid4().hex}"  # the next try has a clean folder
                raise
        return _read(self.spark, f"{run}/{name}", cluster, table, self.buckets)


def _lazily(name: str, cluster: str | None):
    def get(self: StoredBook) -> DataFrame:
        if name not in self.__dict__:
            with _LOCK:
                if name not in self.__dict__:
                    self.__dict__[name] = self.stage(name, cluster)
        return self.__dict__[name]
    return property(get)


for _stage in STAGES:
    setattr(StoredBook, _stage[0], _lazily(*_stage))


def opened(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> StoredBook:
    """The order book, its stages written once per (sources, code, params) into the
    shared checkpoint folder when first asked for."""
    key = fingerprint(spark, sf_dir, params)
    with _LOCK:
        if key not in _BUILT or _BUILT[key].spark is not spark:
            # a join on (order, line) of two tables bucketed by order needs no shuffle either,
            # and a scan whose buckets no operator asks for is still dealt bucket by bucket
            spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
            spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
            _BUILT[key] = StoredBook(spark, sf_dir, params, f"{shared_dir(spark)}/orderbook/{key}")
        return _BUILT[key]


def build(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> StoredBook:
    """The order book with all of its stages written, in one folder."""
    book = opened(spark, sf_dir, params)
    # around all threads, which share the session's setting
    with _LOCK, shuffles_freed(spark):
        if not book.whole:
            for wave in WAVES:
                with ThreadPoolExecutor(max_workers=len(wave)) as pool:
                    made = list(pool.map(lambda s: book.stage(*s, anywhere=False), wave))
                book.__dict__.update(zip([n for n, _ in wave], made))
            literal_table(spark, [(book.run,)], [("v", "string")]).write.text(f"{book.run}/_published")
            book.whole = book.run
    return book
