"""Corpus pipeline: documents in, packed training sequences out.

The stages, in order: toxic documents go; of each group of near duplicates
the document of least id stays; strings of 100 bytes that start earlier in the
corpus are cut; documents that hold a benchmark item go; the rest is packed.
Each stage reads all that the one before it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import decontaminate, packing, queries, simhash, suffix_dedup, toxicity
from hirescope.llm.common import materialise
from hirescope.llm.queries import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model learned from the
    labelled documents outside the held-out share."""
    model = queries.toxicity_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, carry=tuple(docs.columns))
    return scored.where(F.col("score") < queries.TOXIC_AT).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group; rows without an id stay, and so
    do rows that repeat a kept id."""
    groups = simhash.near_duplicates(docs)
    drop = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated 100-byte strings (null texts become empty); a
    character that a cut splits goes, and ``n_chars`` follows the text."""
    out = suffix_dedup.remove_repeats(docs, carry=tuple(docs.columns), as_text=True)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    found = decontaminate.search(docs, table(spark, sf_dir, "benchmark"), carry=tuple(docs.columns))
    return found.where(F.size("matches") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The stages learn models and follow links to any depth: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
