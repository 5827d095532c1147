"""Near duplicates by ProbMinHash.

A text's shingles are its five-word windows, weighted by how often it has
them.  The similarity of two texts is their probability Jaccard

    J_P(a, b) = sum over x in both of 1 / sum over y of max(a_y / a_x, b_y / b_x),

which is the plain Jaccard where no shingle repeats.  Each shingle is a Poisson
process whose rate is its weight; an arrival falls into one of the signature's
components, which keeps its earliest arrival's shingle.  Two texts agree in a
component with probability J_P.  A text's processes stop as soon as the next
arrivals come later than everything the signature holds.

Signatures are cut into bands.  In every bucket of a band the texts are
compared, exactly, with its hub: the text that meets most others.  What this
leaves in different components of one bucket is compared too, but for pairs
that an upper bound of the similarity, from counts of shingles per hash cell,
rules out; so every pair of a bucket is compared, already linked, or known to
be dissimilar, while a group of copies or near copies never becomes all its
pairs.  Classes are the connected components of the pairs whose exact J_P
reaches the threshold.

Bands: 30 of 5 components find a pair of similarity 0.8 with probability
1 - (1 - 0.8 ** 5) ** 30 = 0.999993.

Defined results: a text of one to four words has one shingle, itself; a null
text or one without words has none and is a class of its own, named by its id;
texts with the same weighted shingles are compared once, very long ones whole;
rows that share an id are one document: its different texts are compared each
with all others and stand in one class; classes do not depend on the order of
the rows; a row without an id has no class (null) and is kept; an empty table
gives an empty result; extra columns are not read and, in ``dedup``, pass
through unchanged."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import documents
from stayline.llm.components import components
from stayline.llm.pieces import rounds, spaced
from stayline.llm.registry import register
from stayline.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 30
ROWS = 5
#: Cells whose counts bound what two texts share.
CELLS = 512
#: Rounds of arrivals between two looks at which texts are done, after the first few.
LOOK_EVERY = 8

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, shingle, weight) of all texts, sorted by doc and shingle."""
    words = pc.split_pattern(pa.array(list(map(spaced, texts)), pa.large_string()), " ")
    coded = words.flatten().dictionary_encode()
    dictionary = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, dictionary), np.uint64, len(dictionary))
    at = coded.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    if "" in dictionary:
        real = at != dictionary.index("")
        at, doc = at[real], doc[real]
    h = hashes[at]
    count = np.bincount(doc, minlength=len(texts))
    size = np.minimum(count, SHINGLE)
    # A window starts at every word that has enough words after it in its text.
    left = np.repeat(np.cumsum(count), count) - np.arange(len(doc))
    first = left >= size[doc]
    first &= (count[doc] >= SHINGLE) | (left == count[doc])
    start = np.flatnonzero(first)
    value = np.zeros(len(start), np.uint64)
    for k in range(SHINGLE):
        there = k < size[doc[start]]
        value[there] += mixed(h[start[there] + k] * _MULTIPLIERS[k])
    value, owner = mixed(value), doc[start]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(at, append=len(value))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, size: int) -> np.ndarray:
    """(docs, size) signature components; rows of texts without shingles are 0."""
    earliest = np.full(docs * size, np.inf)
    kept = np.zeros(docs * size, np.uint64)
    active = np.arange(len(doc))
    time = np.zeros(len(doc))
    rate = 1.0 / weight
    n = 0
    while len(active):
        n += 1
        u = mixed(shingle[active] + np.uint64(n * int(_GOLDEN) % (1 << 64)))
        uniform = (u >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        time[active] -= np.log1p(-uniform) * rate[active]
        t = time[active]
        slot = doc[active] * size + ((mixed(u ^ _GOLDEN) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(earliest, slot, t)
        won = earliest[slot] == t
        kept[slot[won]] = shingle[active[won]]
        if n <= LOOK_EVERY or n % LOOK_EVERY == 0:
            last = earliest.reshape(docs, size).max(axis=1)
            active = active[t < last[doc[active]]]
    return kept.reshape(docs, size)


def sign(df: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, words (16 bytes that name the text's weighted shingles; null
    without words) and buckets (array of long, one per band) of every row."""
    doc_id = next(f for f in df.schema.fields if f.name == "doc_id")
    schema = T.StructType([doc_id, T.StructField("words", T.BinaryType()),
                           T.StructField("buckets", T.ArrayType(T.LongType()))])
    band = np.arange(bands, dtype=np.uint64) * _GOLDEN

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for i, j in rounds(texts):
                n = j - i
                doc, value, weight = shingles(texts[i:j])
                sig = signatures(doc, value, weight, n, bands * rows).reshape(n, bands, rows)
                key = np.broadcast_to(band, (n, bands)).copy()
                for k in range(rows):
                    key = mixed(key ^ sig[:, :, k])
                at = np.searchsorted(doc, np.arange(n + 1))
                names = names_of(value, weight, at)
                flat = pa.array(key.reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, n), pa.array(names, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), flat)],
                    ["doc_id", "words", "buckets"])
    return df.select("doc_id", "text").mapInArrow(run, schema)


def names_of(value: np.ndarray, weight: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """The name of each text's weighted shingles, which stand from one offset of ``at`` to the next."""
    return [hashlib.blake2b(value[s:e].tobytes() + weight[s:e].tobytes(), digest_size=16).digest()
            if e > s else None for s, e in itertools.pairwise(at)]


def weighted_shingles(df: DataFrame) -> DataFrame:
    """words (the name that ``sign`` gives them), shingles (64-bit) and weights
    (32-bit) as binaries, sorted by shingle, and the other columns of ``df``."""
    rest = [f for f in df.schema.fields if f.name != "text"]
    schema = T.StructType([*rest, T.StructField("words", T.BinaryType()), T.StructField("shingles", T.BinaryType()),
                           T.StructField("weights", T.BinaryType())])

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for i, j in rounds(texts):
                doc, value, weight = shingles(texts[i:j])
                at = np.searchsorted(doc, np.arange(j - i + 1))
                names = names_of(value, weight, at)
                weight = weight.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(f.name).slice(i, j - i) for f in rest), pa.array(names, pa.binary()),
                     pa.array([value[s:e].tobytes() for s, e in itertools.pairwise(at)], pa.binary()),
                     pa.array([weight[s:e].tobytes() for s, e in itertools.pairwise(at)], pa.binary())],
                    schema.names)
    return df.select(*[f.name for f in rest], "text").mapInArrow(run, schema)


def probability_jaccard(xa: np.ndarray, wa: np.ndarray, xb: np.ndarray, wb: np.ndarray) -> float:
    """Exact J_P of two weighted sets with sorted elements."""
    at = np.searchsorted(xb, xa)
    at[at == len(xb)] = 0
    both = xb[at] == xa if len(xb) else np.zeros(len(xa), bool)
    if not both.any():
        return 0.0
    a, b = wa[both].astype(np.float64), wb[at[both]].astype(np.float64)
    ratio = a / b
    order = np.argsort(ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    # Elements of greater ratio than x's count with a, the others with b times the ratio.
    b_upto = np.cumsum(b) + (wb.sum() - b.sum())
    a_after = wa.sum() - np.cumsum(a)
    return float((a / (a_after + ratio * b_upto)).sum())


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` (a, b) with exact similarity of ``threshold`` or more."""
    def side(tag):
        return sets.select(F.col("id").alias(tag), F.col("shingles").alias(f"x{tag}"), F.col("weights").alias(f"w{tag}"))

    def run(batches):
        for b in batches:
            found = []
            for xa, wa, xb, wb in zip(*(b.column(c).to_pylist() for c in ("xa", "wa", "xb", "wb")), strict=True):
                found.append(probability_jaccard(np.frombuffer(xa, np.uint64), np.frombuffer(wa, np.uint32),
                                                 np.frombuffer(xb, np.uint64), np.frombuffer(wb, np.uint32)) >= threshold)
            keep = pa.array(found, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])
    joined = pairs.hint("merge").join(side("b"), "b").hint("merge").join(side("a"), "a")
    return joined.select("a", "b", "xa", "wa", "xb", "wb").mapInArrow(run, pairs.select("a", "b").schema)


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id and class_id (the least id of the class) for every row of ``docs`` (doc_id, text)."""
    signed = materialize(sign(docs, bands, rows), "signed")
    # Rows with the same words become one node, with a number of its own and its least document.
    nodes = materialize(signed.filter("words IS NOT NULL AND doc_id IS NOT NULL").groupBy("words").agg(
        F.min("doc_id").alias("first"), F.min_by("buckets", "doc_id").alias("buckets")).withColumn(
        "id", F.monotonically_increasing_id()), "nodes")
    members = nodes.select("id", F.explode("buckets").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A bucket's hub is its text that meets most others in all its buckets: of a family of copies, the source.
    met = members.join(sizes, "bucket").groupBy("id").agg(F.sum("n").alias("met"), F.collect_list("bucket").alias("buckets"))
    met = materialize(met.select("id", "met", F.explode("buckets").alias("bucket")), "met")  # at most one per band
    hubs = met.groupBy("bucket").agg(F.max("met").alias("met"), F.max_by("id", F.struct("met", "id")).alias("hub"))
    pairs = materialize(met.join(hubs.select("bucket", "hub"), "bucket").filter("id <> hub").select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct(), "pairs")
    # Only texts that share a bucket with another one are read again; a document's other texts are not theirs.
    # Rows of a document whose texts differ in white space alone may give a node twice, which adds no links.
    wanted = nodes.join(met.select("id").distinct(), "id", "left_semi").select(
        F.col("first").alias("doc_id"), F.col("words").alias("name"), "id")
    sets = materialize(weighted_shingles(docs.select("doc_id", "text").join(wanted.hint("merge"), "doc_id")
                                         .dropDuplicates(["doc_id", "text", "id"])).filter("words = name")
                       .select("id", "shingles", "weights"), "sets")
    links = materialize(verify(pairs, sets, threshold), "links")
    own = _same_document(signed, nodes)
    if own is not None:
        links = materialize(links.unionByName(own), "links")
    comp = components(links)
    more = _across(met, comp, sets, threshold)
    if more is not None:
        found = materialize(verify(more.join(pairs, ["a", "b"], "left_anti"), sets, threshold), "links")
        if not found.isEmpty():
            comp = components(links.unionByName(found))
    named = nodes.select("words", "id", "first").join(comp, "id", "left")
    least = named.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("first").alias("class_id"))
    named = named.join(least, "comp", "left").select("words", F.coalesce("class_id", "first").alias("class_id"))
    d = signed.select("doc_id", "words").join(named, "words", "left")
    return d.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))


def _same_document(signed: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the texts of each document that has several."""
    d = signed.filter("words IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "words")
    h = F.xxhash64("words")
    several = materialize(d.groupBy("doc_id").agg(F.min(h).alias("lo"), F.max(h).alias("hi")).filter("lo <> hi")
                          .select("doc_id"), "several")
    if several.isEmpty():
        return None
    d = d.join(several, "doc_id", "left_semi").join(nodes.select("words", "id"), "words").select("doc_id", "id")
    star = d.groupBy("doc_id").agg(F.min("id").alias("a"))
    return d.join(star, "doc_id").filter("a <> id").select("a", F.col("id").alias("b")).distinct()


def _across(met: DataFrame, comp: DataFrame, sets: DataFrame, threshold: float) -> DataFrame | None:
    """Pairs (a, b) of one bucket that stand in different components and can
    still be similar: texts outside a bucket's largest component against the
    others in it, as far as ``may_be_similar`` does not rule them out."""
    d = met.select("bucket", "id").join(comp, "id", "left").select("bucket", "id", F.coalesce("comp", "id").alias("comp"))
    # Buckets of two have been compared whole.
    several = d.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("c0"), F.max("comp").alias("c1")
                                      ).filter("c0 <> c1 AND n > 2").select("bucket")
    d = materialize(d.join(several, "bucket"), "across")
    if d.isEmpty():
        return None
    d = materialize(d.join(counted_cells(sets), "id"), "across")
    major = (d.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"))
             .groupBy("bucket").agg(F.max_by("comp", F.struct("k", "comp")).alias("major")))
    text = F.struct("total", "n", "cells")
    strays = d.join(major, "bucket").filter("comp <> major").select(
        "bucket", F.col("id").alias("s_id"), F.col("comp").alias("s_comp"), text.alias("s"))
    others = d.select("bucket", "id", "comp", text.alias("o"))
    found = strays.join(others.hint("merge"), (strays["bucket"] == others["bucket"]) & (F.col("s_comp") != F.col("comp"))
                        & may_be_similar("s", "o", threshold))
    return materialize(found.select(F.least("s_id", "id").alias("a"), F.greatest("s_id", "id").alias("b")).distinct(), "pairs")


def counted_cells(sets: DataFrame) -> DataFrame:
    """id, total weight, n (shingles) and how many of them fall into each of
    ``CELLS`` cells by their hash (null for a count that a short cannot hold)."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("total", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("cells", T.ArrayType(T.ShortType()))])

    def run(batches):
        for b in batches:
            x = [np.frombuffer(v, np.uint64) for v in b.column("shingles").to_pylist()]
            n = [len(v) for v in x]
            cell = (mixed(np.concatenate(x)) % np.uint64(CELLS)).astype(np.int64)
            cells = np.bincount(np.repeat(np.arange(len(x)), n) * CELLS + cell, minlength=len(x) * CELLS)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([int(np.frombuffer(v, np.uint32).sum()) for v in b.column("weights").to_pylist()]),
                 pa.array(n, pa.int64()), pa.ListArray.from_arrays(
                     pa.array(np.arange(len(x) + 1, dtype=np.int32) * CELLS), pa.array(cells.astype(np.int16)),
                     mask=pa.array(cells.reshape(-1, CELLS).max(axis=1, initial=0) > np.iinfo(np.int16).max))],
                ["doc_id", "total", "n", "cells"])
    return sets.mapInArrow(run, schema)


def may_be_similar(a: str, b: str, threshold: float) -> Column:
    """An upper bound of J_P reaches the threshold, for structs (total, n, cells).

    Two texts share at most the sum over the cells of the lesser count, so each
    has at least ``own`` shingles that the other lacks.  With x y / (u y + v x)
    concave, J_P <= 1 / (1 + own_a / (total_a - own_a) + own_b / (total_b - own_b));
    without repeats this is the bound on the plain Jaccard."""
    def odds(t: str, shared: Column) -> Column:
        own = F.col(f"{t}.n") - shared
        return F.when(F.col(f"{t}.total") > own, own / (F.col(f"{t}.total") - own)).otherwise(float("inf"))
    bound = F.aggregate(F.zip_with(f"{a}.cells", f"{b}.cells", lambda x, y: F.least(x, y).cast("int")), F.lit(0),
                        lambda x, y: x + y, lambda n: odds(a, n) + odds(b, n) <= 1 / threshold - 1 + 1e-9)
    return F.coalesce(bound, F.lit(True))  # without counts nothing is ruled out


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``classes`` with ``kept``: whether the row's id is its class's least one."""
    return classes(docs, threshold).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def dedup(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with the least id of their class, columns unchanged."""
    gone = near_duplicates(docs, threshold).filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


@register("op3_prob_minhash")
def op3_prob_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
