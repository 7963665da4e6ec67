"""Incremental arrival of raw posting files -> clean -> dedup -> upsert.

``readStream`` picks up new wrapped-JSON files; each micro-batch is cleaned
with the same Column helpers as the batch job and merged into the postings
table by URL, rewriting only the files that hold its keys.

The table is the stream's keyed state.  A row takes effect only where it comes
after the stored row of its URL in (scrape time, file, place in the file), so
files may arrive in any order, twice, or late: a late row changes nothing, a
late posting that was never seen is added, and the table always equals a batch
job over all files so far.  No watermark can drop a row, and the state is the
table itself, on disk.

A commit is named by the stream's id (kept in its checkpoint) and the batch
id: a batch replayed after a loss is not applied twice, and a stream that
starts anew with another checkpoint is not mistaken for the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.operators import filetable
from hirescope.plans.postings import clean_postings, normalize_raw
from hirescope.sources.raw import RAW_DOC, explode_jobs

ORDER = ("scraped_at", "pos")


def upsert_batch(target_base: str, checkpoint: str, scrape_date_mode: str = "row"):
    """foreachBatch function: clean the batch, merge it into the table."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.read.option("multiLine", True).json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        file = F.element_at(F.split(F.input_file_name(), "/"), -1)
        cleaned = clean_postings(normalize_raw(explode_jobs(batch.withColumn("file", file))),
                                 scrape_date_mode=scrape_date_mode, keep=ORDER)
        filetable.upsert(cleaned, target_base, "job_url", ORDER, f"{stream}-{batch_id:012d}", newer_only=True)
    return run


def start(spark: SparkSession, source_dir: str, target_base: str, checkpoint: str,
          available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; ``available_now`` processes what is there and stops."""
    reader = spark.readStream.schema(RAW_DOC).option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.json(source_dir)
    w = docs.writeStream.foreachBatch(upsert_batch(target_base, checkpoint)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def current_table(spark: SparkSession, target_base: str) -> DataFrame | None:
    rows = filetable.read(spark, target_base)
    return None if rows is None else rows.drop(*ORDER)
