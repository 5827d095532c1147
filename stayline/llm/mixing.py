"""Mixing sources to target weights.

Every source's words are packed, in a fixed pseudorandom document order, into
blocks of ``BLOCK`` words.  A source's target in words becomes a number of
slots; each slot of the mix takes one block.  Slots are dealt to output shards
by a pseudorandom permutation of all slots, which draws each shard's source
counts as a multinomial given the totals (so that the totals meet the
targets).  A source's slots pass through its blocks epoch by epoch, each epoch
in the order of its own permutation, and blocks are joined to them by index.

Permutations are ``i -> (p * i + c) mod n`` with a prime ``p`` above any ``n``,
which is one-to-one; all draws are hashes, so that reruns and retried tasks
agree.  Offsets within a source come from per-chunk sums, so no source is
ordered by one task.

Defined results: a null text has no words; the null source is a source of its
own, last in order; a source without words has target 0; rows that repeat an id
are mixed as rows of their own (``mix_documents`` gives them the same number of
copies); an empty table gives an empty result; extra columns are not read and,
in ``mix_documents``, pass through unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import documents, shuffle_parts, text_of, words_of
from stayline.llm.registry import register
from stayline.session import materialize

BLOCK = 64
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source (and no document) gives more than this many times its size.
MOST = 3
#: Slots of an output shard, documents of a chunk within a source, slots that one row expands to.
SHARD_SLOTS = 4096
CHUNK_DOCS = 2048
RUN = 4096
#: Copies are summed in units of 2 to the minus this.
SHARE_BITS = 20
#: Known primes above any number of blocks: fixed values.
PRIMES = (2305843009213693951, 1000000000000000003, 1000000000000000009, 999999999999999989)


def permuted(i: Column, n: Column, *salt: Column) -> Column:
    """The place of index ``i`` in a pseudorandom permutation of ``n`` indices chosen by ``salt``."""
    primes = F.array(*[F.lit(str(p)).cast("decimal(19,0)") for p in PRIMES])
    p = F.get(primes, F.pmod(F.xxhash64(*salt, F.lit(7)), F.lit(len(PRIMES))).cast("int"))
    c = F.pmod(F.xxhash64(*salt, F.lit(8)), n)
    return (((i.cast("decimal(18,0)") * p) % n.cast("decimal(18,0)") + c) % n).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` (one row per source: source, source_size) with source_no,
    weight and target: shares of all words by weight, at most ``MOST`` times
    the source's size, the excess reshared by weight among the others.

    In the order of size per weight the sources at their limit come first, so
    one pass of running sums finds the share per weight: the largest of what
    is left per weight after each possible set of them."""
    one = Window.orderBy(F.col("source").asc_nulls_last())  # over one row per source
    d = sizes.withColumn("source_no", F.row_number().over(one).cast("long"))
    d = d.withColumn("weight", F.get(F.array(*[F.lit(w) for w in WEIGHTS]),
                                     ((F.col("source_no") - 1) % len(WEIGHTS)).cast("int")))
    cap = F.lit(MOST) * F.col("source_size")
    before = Window.orderBy(cap / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    d = d.withColumn("__share", left / weight).withColumn("__share", F.max("__share").over(whole))
    return d.withColumn("target", F.least(cap.cast("double"), F.col("__share") * F.col("weight"))).drop("__share")


def with_targets(sized: DataFrame) -> DataFrame:
    """One row per source of ``sized`` (doc_id, source, size), with its target, blocks and slots."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    n = F.ceil(F.col("source_size") / BLOCK).cast("long")
    # A slot takes a block's words, on average a little under BLOCK.
    slots = F.coalesce(F.least(MOST * F.col("blocks"), F.round(
        F.col("target") * F.col("blocks") / F.nullif(F.col("source_size"), F.lit(0))).cast("long")), F.lit(0))
    d = targets(s).withColumn("blocks", n).withColumn("slots", slots.cast("long"))
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    return (d.withColumn("slot_base", F.coalesce(F.sum("slots").over(before), F.lit(0)).cast("long"))
            .withColumn("all_slots", F.sum("slots").over(whole).cast("long")))


def packed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sized`` with its source's columns and ``start``: the words of the source before the document."""
    src = sources.select(F.col("source").alias("__source"), "source_no", "source_size", "target", "docs")
    d = sized.join(src, sized["source"].eqNullSafe(src["__source"])).drop("__source", "source")
    chunks = F.ceil(F.col("docs") / CHUNK_DOCS).cast("long")
    d = d.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), chunks)).drop("docs")
    sums = d.groupBy("source_no", "chunk").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("chunk_start"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.join(sums, ["source_no", "chunk"])
    start = F.col("chunk_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return d.withColumn("start", start).drop("chunk", "chunk_start")


def slots(sources: DataFrame) -> DataFrame:
    """The mix: one row per slot with shard, place, source_no, block and epoch."""
    runs = sources.filter("slots > 0").select(
        "source_no", "blocks", "slots", "slot_base", "all_slots",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / RUN))).alias("run"))
    d = runs.repartition(shuffle_parts(sources.sparkSession), "source_no", "run").select(
        "source_no", "blocks", "slot_base", "all_slots", F.explode(F.sequence(
            F.col("run") * RUN, F.least((F.col("run") + 1) * RUN, F.col("slots")) - 1)).alias("j"))
    epoch = F.floor(F.col("j") / F.col("blocks")).cast("long")
    place = permuted(F.col("slot_base") + F.col("j"), F.col("all_slots"), F.lit("place"))
    return d.select("source_no", epoch.alias("epoch"), F.floor(place / SHARD_SLOTS).cast("long").alias("shard"),
                    (place % SHARD_SLOTS).alias("place"),
                    permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.col("source_no"), epoch).alias("block"))


def document_blocks(placed: DataFrame) -> DataFrame:
    """One row per document and block that it has words in, with the number of those words."""
    end = F.col("start") + F.col("size")
    d = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / BLOCK).cast("long"), F.floor((end - 1) / BLOCK).cast("long"))))
    words = F.least(end, (F.col("block") + 1) * BLOCK) - F.greatest(F.col("start"), F.col("block") * BLOCK)
    return d.withColumn("words", words)


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, source_no, size, source_size, target, taken (words the mix takes, with repeats) for every row."""
    sized = materialize(docs.select("doc_id", "source", F.size(words_of(text_of())).cast("long").alias("size")), "sizes")
    sources = materialize(with_targets(sized), "sources")
    placed = packed(sized, sources)
    uses = slots(sources).groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("uses"))
    key = ["source_no", "start", "doc_id", "size", "source_size", "target"]
    # Merged, as the optimizer takes the few rows that expand to all slots for a small table.
    got = (document_blocks(placed).join(uses.hint("merge"), ["source_no", "block"], "left")
           .groupBy(*key).agg(F.coalesce(F.sum(F.col("words") * F.col("uses")), F.lit(0)).alias("taken")))
    out = ["doc_id", "source_no", "size", "source_size", "target", "taken"]
    none = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return got.select(*out).unionByName(none.select(*out))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, with repeats) for every row."""
    return mixed(docs).drop("source_no")


def with_copies(taken: DataFrame) -> DataFrame:
    """doc_id and copies for the rows (doc_id, source_no, size, taken) of ``taken``, one per id and with words.

    Copies are ``taken / size`` rounded down or up.  The remainders run on
    along each source's documents in the order of length, so that the copies
    of a source, and of its documents of any length, add up to what the mix
    takes of them, to about one document."""
    one = 1 << SHARE_BITS
    d = taken.withColumn("share", F.round(F.col("taken") * F.lit(one) / F.col("size")).cast("long"))
    # Classes of about a fifth in length; the places inside come from per-chunk sums.
    d = d.withColumn("length", F.floor(4 * F.log2("size")).cast("long"))
    n = d.groupBy("source_no", "length").agg(F.count(F.lit(1)).alias("docs"))
    d = d.join(n, ["source_no", "length"]).withColumn("chunk", F.pmod(
        F.xxhash64("doc_id", F.lit(9)), F.ceil(F.col("docs") / CHUNK_DOCS).cast("long")))
    sums = d.groupBy("source_no", "length", "chunk").agg(F.sum("share").alias("n"))
    before = Window.partitionBy("source_no").orderBy("length", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = F.pmod(F.xxhash64("source_no", F.lit(11)), F.lit(one))
    sums = sums.select("source_no", "length", "chunk",
                       (first + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("chunk_start"))
    inside = (Window.partitionBy("source_no", "length", "chunk").orderBy(F.xxhash64("doc_id", F.lit(10)), "doc_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("chunk_start") + F.coalesce(F.sum("share").over(inside), F.lit(0))
    d = d.join(sums, ["source_no", "length", "chunk"]).withColumn("start", start)
    copies = F.shiftright(F.col("start") + F.col("share"), SHARE_BITS) - F.shiftright("start", SHARE_BITS)
    return d.select("doc_id", copies.cast("int").alias("copies"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes their words, in whole
    copies (0 to ``MOST``) whose words meet those taken, columns unchanged."""
    taken = mixed(docs).groupBy("doc_id").agg(F.min("source_no").alias("source_no"), F.sum("size").alias("size"),
                                              F.sum("taken").alias("taken")).filter("size > 0")
    m = with_copies(materialize(taken, "taken")).select(
        F.col("doc_id").alias("__mix_id"), F.col("copies").alias("__copies")).filter("__copies > 0")
    d = docs.join(m, docs["doc_id"].eqNullSafe(m["__mix_id"]))
    d = d.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return d.select(*[docs[c] for c in docs.columns])


@register("op8_mix_sources")
def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))
