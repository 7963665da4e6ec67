"""Distributed LSD radix sort: global ranks by composite integer keys.

A row's place is its global position; positions form blocks of ``2**block_bits``.
A pass takes one digit of the composite key, the least significant first:

* a histogram counts the digits of every block,
* prefix sums over (digit, block) give each block the place at which its rows
  of a digit begin,
* the stable rank of a row among the rows of its digit in its block is added,
  and the sum is the row's place for the next pass.

Work is dealt by (block, digit), which holds at most a block's rows however
many keys are equal, so ties and hot keys make no task larger.  Only scalars
(row count, least and greatest key) and one number per digit value meet in one
place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirescope.llm.common import materialise, release

@dataclass(frozen=True)
class Key:
    """An integer column; nulls come last in either direction."""

    column: str
    descending: bool = False


def _digits(rows: DataFrame, keys: list[Key], bits: int) -> list[Column]:
    """The digits of the composite key, the least significant first."""
    spans = rows.agg(F.count("*").alias("rows"), *[f(k.column).alias(f"{i}{n}") for i, k in enumerate(keys)
                                                   for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    out = []
    for i, key in reversed(list(enumerate(keys))):
        lo, hi, c = spans[f"{i}lo"], spans[f"{i}hi"], F.col(key.column).cast("long")
        if lo is not None:
            width = (hi - lo).bit_length()
            if width < 64:
                code = F.lit(hi) - c if key.descending else c - F.lit(lo)
            else:  # read without sign
                code = c.bitwiseXOR(F.lit((1 << 63) - 1 if key.descending else -1 << 63))
            out += [F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << bits) - 1)) for at in range(0, width, bits)]
        if 0 < spans[f"{i}n"] < spans["rows"]:
            out.append(c.isNull().cast("long"))
    return [F.coalesce(d, F.lit(0)).cast("int") for d in out or [F.lit(0)]]


def ranks(rows: DataFrame, keys: list[Key], bits: int = 11, block_bits: int = 18, name: str = "rank") -> DataFrame:
    """``rows`` with a column ``name``: 1, 2, 3, ... in the order of ``keys``.

    Rows equal in every key get consecutive ranks in the order of the written
    input.  Keys are integers of up to 64 bits, of either sign.  An empty
    table stays empty.
    """
    columns = rows.columns
    upto = Window.rowsBetween(Window.unboundedPreceding, -1)
    at = materialise(rows.withColumn("radix_place", F.monotonically_increasing_id()))
    for digit in _digits(at, keys, bits):
        marked = at.select("*", F.shiftright("radix_place", block_bits).alias("radix_block"), digit.alias("radix_digit"))
        counts = marked.groupBy("radix_block", "radix_digit").agg(F.count("*").alias("n"))
        starts = counts.groupBy("radix_digit").agg(F.sum("n").alias("n")).select(
            "radix_digit", F.coalesce(F.sum("n").over(upto.orderBy("radix_digit")), F.lit(0)).alias("start"))
        before = F.coalesce(F.sum("n").over(upto.partitionBy("radix_digit").orderBy("radix_block")), F.lit(0))
        offsets = (counts.select("radix_block", "radix_digit", before.alias("skip")).join(starts, "radix_digit")
                   .select("radix_block", "radix_digit", (F.col("start") + F.col("skip")).alias("radix_offset")))
        stable = F.row_number().over(Window.partitionBy("radix_block", "radix_digit").orderBy("radix_place")) - 1
        moved = materialise(marked.join(offsets, ["radix_block", "radix_digit"])
                            .select(*columns, (F.col("radix_offset") + stable).alias("radix_place")))
        release(at)
        at = moved
    return at.select(*columns, (F.col("radix_place") + 1).alias(name))
