"""Exact duplicates through an extendible-hash index on shared files.

1. *Directory.*  Distinct text hashes are counted per cell (leading
   ``max_depth`` bits).  A bucket is the shortest hash prefix whose entries
   fit ``capacity``: what an extendible-hash directory ends with after it has
   doubled once for each overfull bucket.  All depths are summed in one pass.
2. *Index.*  One entry per distinct text (its bytes compared, as the text is
   part of the grouping key, after map-side aggregation: a hot group of copies
   reaches the shuffle as one row per task), written to shared files sorted by
   (slot, hash).
3. *Chains.*  Tasks that own ranges of (slot, hash) number the entries that
   share a hash; only such entries are matched to documents by their bytes
   again, all others by hash.

Defined results: a null text equals an empty one; of equal texts the row with
the largest doc_id stays (null ids are smallest); rows that repeat both id and
text count in ``group_size`` and are all marked, and ``dedup`` returns one of
them; an empty table gives an empty result; extra columns pass through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import documents, shuffle_parts, text_of
from stayline.llm.registry import register
from stayline.session import materialize

#: Entries a bucket holds before it splits.
CAPACITY = 100_000
#: Longest prefix of the directory: at most 2 ** MAX_DEPTH rows, which bounds its broadcast.
MAX_DEPTH = 12


def text_hash(text: Column, bits: int = 64) -> Column:
    """64-bit hash of the text; fewer leading ``bits`` make collisions likely (tests)."""
    h = F.xxhash64(text)
    return h if bits >= 64 else h.bitwiseAND(F.lit(-1 << (64 - bits)))


def _cell(h: Column, max_depth: int) -> Column:
    return F.shiftrightunsigned(h, 64 - max_depth)


def directory(hashes: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(cell, depth, slot) for every cell in use: the local depth of its bucket
    and the bucket's first cell.  ``hashes`` has one column ``h``."""
    cells = hashes.distinct().groupBy(_cell(F.col("h"), max_depth).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {max_depth} - depth)"))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("entries")).filter(F.col("entries") <= capacity)
    found = levels.join(fits, ["depth", "prefix"], "left").groupBy("cell").agg(
        F.coalesce(F.min(F.when(F.col("entries").isNotNull(), F.col("depth"))), F.lit(max_depth)).alias("depth"))
    return found.withColumn("slot", F.expr(
        f"shiftleft(shiftright(cell, {max_depth} - depth), {max_depth} - depth)"))


def build_index(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH,
                hash_bits: int = 64, payload: bool = False) -> DataFrame:
    """The index, written to shared files and read back: slot, h, text,
    keep_id, n, and with ``payload`` the kept row itself as struct ``row``."""
    text = text_of("text")
    h = text_hash(text, hash_bits)
    dirs = materialize(directory(docs.select(h.alias("h")), capacity, max_depth), "directory")
    cols = [h.alias("h"), text.alias("t"), F.col("doc_id").alias("id")]
    if payload:
        cols.append(F.struct(*[F.col(c) for c in docs.columns if c != "text"],
                             F.col("text").isNull().alias("__null_text")).alias("row"))
    aggs = [F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n")]
    if payload:
        aggs.append(F.max_by("row", F.struct(F.col("id").isNotNull(), "id")).alias("row"))
    entries = docs.select(*cols).groupBy("h", "t").agg(*aggs)
    entries = (entries.withColumn("cell", _cell(F.col("h"), max_depth))
               .join(F.broadcast(dirs.select("cell", "slot")), "cell").drop("cell")  # at most 2 ** max_depth rows
               .sortWithinPartitions("slot", "h"))
    return materialize(entries.withColumnRenamed("t", "text"), "index")


def chains(index: DataFrame) -> DataFrame:
    """Index entries without their texts, each with the number of entries that
    share its hash (``chain``), counted by the owners of (slot, h) ranges."""
    owned = (index.select("slot", "h", "keep_id", "n")
             .repartitionByRange(shuffle_parts(index.sparkSession), "slot", "h"))
    return owned.withColumn("chain", F.count(F.lit(1)).over(Window.partitionBy("slot", "h")))


def mark(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, hash_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs``."""
    index = build_index(docs, capacity, max_depth, hash_bits)
    chained = materialize(chains(index), "chains")
    text = text_of("text")
    d = docs.select("doc_id", text_hash(text, hash_bits).alias("h"), F.sha2(text, 256).alias("text_sha256"))
    clash = chained.filter("chain > 1").select("h").distinct()
    single = chained.filter("chain = 1 AND n > 1").select("h", "keep_id", F.col("n").alias("group_size"))
    collided = not clash.isEmpty()
    base = d.join(clash, "h", "left_anti") if collided else d
    # Texts of their own need no entry: only groups of two or more are joined.
    out = base.join(single, "h", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), "text_sha256")
    if collided:
        dt = docs.select("doc_id", text_hash(text, hash_bits).alias("h"), text.alias("t"),
                         F.sha2(text, 256).alias("text_sha256")).join(clash, "h", "left_semi")
        e = index.join(clash, "h", "left_semi").select("h", F.col("text").alias("t"), "keep_id", "n")
        out = out.unionByName(dt.join(e, ["h", "t"]).select(
            "doc_id", "keep_id", F.col("n").alias("group_size"), "text_sha256"))
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def dedup(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, hash_bits: int = 64) -> DataFrame:
    """One row per distinct text, with the columns of ``docs``: the payload of the index's entries."""
    index = build_index(docs, capacity, max_depth, hash_bits, payload=True)
    text = F.when(~F.col("row.__null_text"), F.col("text"))
    return index.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


@register("op7_exact_dedup", """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
""")
def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return mark(documents(spark, sf_dir))
