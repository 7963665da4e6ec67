"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirescope.session import checkpoint_dir


_BATCH, _ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per
    application, so that a job needs no ``--py-files``."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        name = os.path.join(tempfile.mkdtemp(prefix="hirescope-"), "hirescope_package")
        sc.addPyFile(shutil.make_archive(name, "zip", root, "hirescope"))
        _SHIPPED.add(sc.applicationId)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, so a
    lost executor costs nothing that was written.  Unlike ``checkpoint()`` the
    result is columnar, compressed and has a known size, which the planner
    uses.  Shuffle files of finished jobs are released by the driver's
    garbage collector, so it is asked to run.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.parquet(path)
    out._written_to = path
    return out


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver's garbage collector release the shuffle files of tables that nobody refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(*written: DataFrame) -> None:
    """Delete the folders of tables that ``materialise`` wrote and that nothing
    to be computed later reads."""
    for df in written:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_batches(batches: Iterator[pa.RecordBatch], columns: tuple[int, ...], text: int,
                 limit: int = 4 << 20) -> Iterator[list[list]]:
    """Re-cut Arrow batches into lists of Python rows of about ``limit`` text
    characters, so that working memory does not depend on the row count of a
    batch.  ``columns`` picks the columns, ``text`` is the index within them."""
    rows: list[list] = [[] for _ in columns]
    size = 0
    for batch in batches:
        cols = [batch.column(i) for i in columns]
        step = 256
        for at in range(0, batch.num_rows, step):
            part = [c.slice(at, step).to_pylist() for c in cols]
            for have, more in zip(rows, part):
                have.extend(more)
            size += sum(len(x) for x in part[text] if x)
            if size >= limit:
                yield rows
                rows, size = [[] for _ in columns], 0
    if rows[0]:
        yield rows


def map_texts(docs: DataFrame, text_col: str, carry: list[str], fields: str,
              make: Callable[[], Callable[..., list[pa.Array]]], extra: tuple[str, ...] = (),
              limit: int = 4 << 20) -> DataFrame:
    """Apply a Python function to the texts of ``docs`` without losing the rows.

    ``make()`` runs once per task and returns a function of a list of texts
    (and a list for each ``extra`` column) that gives one Arrow array per
    field of the DDL ``fields``.  Returns these fields and a struct ``row`` of
    the ``carry`` columns, so names can't clash and no join back is needed.
    """
    # Rows carry whole documents, twice: Spark's 10000 rows a batch would be far too many.
    conf = docs.sparkSession.conf
    if int(conf.get(_BATCH)) > _ROWS:
        conf.set(_BATCH, str(_ROWS))
    source = docs.select(F.col(text_col).cast("string").alias("text"), *extra,
                         F.struct(*[F.col(c) for c in carry]).alias("row"))
    schema = StructType.fromDDL(fields)
    names = schema.names + ["row"]
    schema = schema.add("row", source.schema["row"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size, end = [], 0, at
                while end < batch.num_rows and size < limit:
                    part = batch.column(0).slice(end, 64).to_pylist()
                    texts += part
                    size += sum(len(x) for x in part if x)
                    end = min(end + 64, batch.num_rows)
                cut = batch.slice(at, end - at)
                lists = [cut.column(i + 1).to_pylist() for i in range(len(extra))]
                yield pa.RecordBatch.from_arrays([*work(texts, *lists), cut.column(len(extra) + 1)], names=names)
                at = end

    return source.mapInArrow(run, schema)
