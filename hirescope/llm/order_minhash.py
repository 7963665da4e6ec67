"""Order MinHash document fingerprints, in DataFrame operations only.

A k-mer is ``k`` consecutive tokens (runs of up to ``token`` characters other
than white space), numbered by its occurrence in the text: the second "of the"
is another element than the first.  The elements are dealt by hash over
``slots`` slots of two cells; each cell selects its minimal element.  A slot's
elements are put back in text order and hashed as a tuple.  Two fingerprints
agree in a slot only if both select the same elements in the same order, so
the likeness falls with insertions, deletions and moved passages alike - with
edit distance, where a plain MinHash sees sets only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirescope.llm.common import free_shuffles, materialise

_NO_ID = 2**63 - 1
_POS_BITS = 24
#: Partitions of texts, in shares of the session's: rows of tokens take so many times the room of their text.
_ROWS_A_TEXT = 6


def fingerprints(texts: DataFrame, key: list[str], slots: int = 64, k: int = 2, token: int = 12) -> DataFrame:
    """``key columns, entries`` for every row of ``texts(key..., text)`` with a
    token; ``key`` must identify a row.  ``entries`` is an ascending array of
    ints: the slot's number in the upper bits, 25 bits of its tuple's hash.

    All steps group by ``key``, so a table partitioned by one of the key
    columns is not shuffled again."""
    tokens = F.regexp_extract_all("text", F.lit(rf"\S{{1,{token}}}"), F.lit(0))
    grams = F.arrays_zip(*[F.slice("t", i + 1, F.greatest(F.size("t"), F.lit(1))).alias(f"w{i}") for i in range(k)])
    rows = (texts.select(*key, tokens.alias("t")).select(*key, F.posexplode(grams).alias("pos", "g"))
            .select(*key, "pos", F.xxhash64(*[F.col(f"g.w{i}") for i in range(k)]).alias("km")))
    nth = F.row_number().over(Window.partitionBy("km", *key).orderBy("pos"))
    element = rows.select(*key, "pos", F.xxhash64("km", nth).alias("h"))
    cell = F.pmod("h", F.lit(2 * slots)).cast("int")
    # The upper hash bits choose, the position rides along.
    packed = (F.shiftleft(F.shiftrightunsigned("h", 64 - 39), _POS_BITS)
              + F.least(F.col("pos"), F.lit((1 << _POS_BITS) - 1)))
    chosen = (element.select(*key, cell.alias("cell"), packed.alias("p"))
              .groupBy(*key, F.expr("cell div 2").cast("int").alias("slot"))
              .agg(F.min(F.when(F.col("cell") % 2 == 0, F.col("p"))).alias("a"),
                   F.min(F.when(F.col("cell") % 2 == 1, F.col("p"))).alias("b")))

    def pos(c: str) -> Column:
        return F.col(c).bitwiseAND(F.lit((1 << _POS_BITS) - 1))

    def name(c: str) -> Column:
        return F.shiftright(c, _POS_BITS)

    tuple_hash = (F.when(F.col("a").isNull(), F.xxhash64(name("b")))
                  .when(F.col("b").isNull(), F.xxhash64(name("a")))
                  .when(pos("a") <= pos("b"), F.xxhash64(name("a"), name("b")))
                  .otherwise(F.xxhash64(name("b"), name("a"))))
    entry = (F.col("slot") * F.lit(1 << 25) + F.pmod(tuple_hash, F.lit(1 << 25)).cast("int")).cast("int")
    return (chosen.select(*key, entry.alias("e")).groupBy(*key)
            .agg(F.sort_array(F.collect_list("e")).alias("entries")))


def likeness(a: Column, b: Column) -> Column:
    """Share of the slots used by either fingerprint in which both agree; two
    empty fingerprints are alike."""
    def slots_of(x: Column) -> Column:
        return F.transform(x, lambda e: F.shiftright(e, 25))

    used = F.size(F.array_union(slots_of(a), slots_of(b)))
    return F.when(used == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / used)


def as_text(entries: Column) -> Column:
    """A fingerprint as a string: eight hex digits per used slot."""
    return F.array_join(F.transform(entries, lambda e: F.lower(F.lpad(F.hex(e), 8, "0"))), "")


def neighbours(ids: DataFrame) -> DataFrame:
    """``k, next_k, prev_k, prev_n`` for distinct ids ``k`` with ``n``, in
    ascending order of ``k`` and closed to a ring.

    The ids are dealt over ranges; each range is ordered by itself and only
    its first and last id meet those of the other ranges."""
    tasks = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(ids.repartitionByRange(tasks, "k").select("k", "n", F.spark_partition_id().alias("part")))
    inside = Window.partitionBy("part").orderBy("k")
    ends = dealt.groupBy("part").agg(F.min("k").alias("first"), F.max(F.struct("k", "n")).alias("last"))
    ring = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per range
    all_ends = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part", F.coalesce(F.lead("first").over(ring), F.first("first").over(all_ends)).alias("after"),
        F.coalesce(F.lag("last").over(ring), F.last("last").over(all_ends)).alias("before"))
    own = dealt.select("part", "k", F.lead("k").over(inside).alias("nk"),
                       F.lag(F.struct("k", "n")).over(inside).alias("pv"))
    return (own.join(F.broadcast(ends), "part")
            .select("k", F.coalesce("nk", "after").alias("next_k"), F.coalesce("pv", "before").alias("pv"))
            .select("k", "next_k", F.col("pv.k").alias("prev_k"), F.col("pv.n").alias("prev_n")))


def _printed(docs: DataFrame, id_col: str, text_col: str, slots: int, k: int, token: int) -> tuple[DataFrame, DataFrame]:
    """The ring of ids, and per id ``k`` and hash ``th`` of a text: how many rows
    hold it, its length, the edited text's digest and both fingerprints.  Both are written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("k"), text.alias("text"))
    ring = materialise(neighbours(src.groupBy("k").agg(F.max(F.length("text").cast("long")).alias("n"))))
    # The same three columns wherever texts meet other rows, so that they are shuffled once; into
    # small partitions, since every token of a text becomes a row that is sorted twice in its task.
    tasks = _ROWS_A_TEXT * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = src.select("k", F.xxhash64("text").alias("th"), "text").repartition(tasks, "k")
    gift = (src.join(ring.select("k", "prev_k", "prev_n"), "k")
            .select(F.col("prev_k").alias("k"), "th", F.expr("left(text, cast(prev_n div 2 as int))").alias("head"))
            .repartition(tasks, "k").groupBy("k").agg(F.min_by("head", "th").alias("head")))
    both = (src.join(gift, "k").groupBy("k", "th").agg(F.first("text").alias("text"), F.first("head").alias("head"), F.count("*").alias("copies"))
            .withColumn("n", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.expr("left(text, cast(n - n div 2 as int))"),
                                           F.expr("left(head, cast(n div 2 as int))"))))
    sides = both.select("k", "th", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("s")).select("k", "th", "s.*")
    prints = fingerprints(sides, ["k", "th", "side"], slots, k, token)
    wide = prints.groupBy("k", "th").agg(*[
        F.flatten(F.collect_list(F.when(F.col("side") == s, F.col("entries")))).alias(c)
        for s, c in ((0, "entries"), (1, "edited_entries"))])
    none = F.array().cast("array<int>")
    known = (both.select("k", "th", "copies", "n", F.sha2("edited", 256).alias("edited_sha256")).join(wide, ["k", "th"], "left")
             .select("k", "th", "copies", "n", "edited_sha256", F.coalesce("entries", none).alias("entries"),
                     F.coalesce("edited_entries", none).alias("edited_entries")))
    return ring, materialise(known)


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = 64, k: int = 2,
                       token: int = 12) -> DataFrame:
    """Fingerprint every text, and its edited form: the last half of its code
    points replaced by the beginning of the next document's text.

    Returns one row per input row: ``doc_id, n_chars, edited_sha256, entries,
    edited_entries, near_edited, near_next`` (likeness to the edited text and
    to the next document).

    The next document is the next larger id; after the largest comes the
    smallest (a single document follows itself).  Null texts count as empty,
    null ids come last, as one id.  Rows that repeat an id with another text
    are fingerprinted each; their predecessor sees the one whose text hashes
    lowest.  Texts of white space only have an empty fingerprint.
    """
    ring, known = _printed(docs, id_col, text_col, slots, k, token)
    free_shuffles(docs.sparkSession)   # the texts' shuffle files: from here on the written rows do
    after = (known.select("k", "th", "entries").join(ring.select("k", "prev_k"), "k")
             .select(F.col("prev_k").alias("k"), "th", "entries").groupBy("k").agg(F.min_by("entries", "th").alias("next_entries")))
    judged = known.join(after, "k").select(
        F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id"), F.col("n").alias("n_chars"), "edited_sha256", "entries", "edited_entries",
        likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
        likeness(F.col("entries"), F.col("next_entries")).alias("near_next"), "copies")
    return judged.select("*", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("copies", "col")
