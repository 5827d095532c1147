"""Token ids in compact files, and back.

A folder holds ``codebook`` (id, bits: the code length of every id in use) and
``blocks``.  Ids are Huffman-coded with the canonical code of those lengths,
which come from the counts over all documents.  File ``file_no`` holds a range
of doc_ids in ascending order (null ids first), in independent blocks of whole
documents with about ``BLOCK_IDS`` ids: doc_ids, n_tokens per document, n_ids,
``payload`` (the bits) and ``checkpoints`` (the bit offset of every 128th id).
Both are Parquet folders written by Spark's committer, so that lost executors
leave no half-written file.

Defined results: a null text is an empty one (its only id is the end id);
repeated rows are documents of their own, rows of one id in the order of their
ids; an empty table gives files without blocks and an empty result; extra
columns are not read."""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm import huffman
from stayline.llm.common import documents
from stayline.llm.pieces import MARKS, SPACE_RUN, WHITE_SPACE, Memory, offsets_of, rounds, splitter
from stayline.llm.registry import register
from stayline.session import ensure_checkpoint_dir

END_ID = 2
BLOCK_IDS = 1 << 16
FILE_IDS = 8_000_000
#: Pieces that the library encodes in one call, and that a worker remembers.
PHRASE = 64
REMEMBERED = 200_000
#: Bytes of text that one round of encoding holds.
ENCODE_BYTES = 16_000_000
#: Ids that are decoded together.
DECODE_IDS = 1 << 20


@functools.cache
def _encoder(content: str):
    """Texts to (offsets, ids) with the tokenizers library.  Where its
    pre-tokenizer is the byte-level one, it encodes distinct pieces."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(content)
    t.no_truncation()
    t.no_padding()
    spec = json.loads(content)
    pre = spec.get("pre_tokenizer") or {}

    def batch(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    added = spec.get("added_tokens", [])
    plain = not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added)
    if plain and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) \
            and not pre.get("add_prefix_space"):
        return PhraseEncoder(t, tuple(a["content"] for a in added)).encode

    def whole(texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        ids = batch([x or "" for x in (texts if isinstance(texts, list) else texts.to_pylist())])
        return (np.cumsum([0, *map(len, ids)]),
                np.fromiter(itertools.chain.from_iterable(ids), np.uint32, sum(map(len, ids))))
    return whole


#: For Arrow: a word of Latin letters, or one and a mark; a piece of a space and another symbol.
_MARK = f"[{''.join(map(re.escape, sorted(MARKS)))}]"
_PLAIN = rf"^[A-Za-z\x{{c0}}-\x{{d6}}\x{{d8}}-\x{{f6}}\x{{f8}}-\x{{ff}}]+{_MARK}?$"
_SPACED = "^ [^" + re.sub(r"\\u(....)", r"\\x{\1}", WHITE_SPACE) + "]"


def _strings(offsets: np.ndarray, data: pa.Buffer | None) -> pa.LargeStringArray:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), data)


class PhraseEncoder:
    """Texts to ids with the tokenizers library, which is asked for distinct pieces only.

    A space before another symbol always begins a piece, so a text in which
    white space follows no space is first cut at its spaces.  Arrow finds the
    distinct parts of a round and cuts those of a word, or of one and a mark;
    the rest is cut by ``splitter``.  The ids of pieces are remembered."""

    def __init__(self, tokenizer, specials: tuple[str, ...], size: int = REMEMBERED):
        self.tokenizer, self.cut, self.memory = tokenizer, splitter(specials), Memory(size)
        vocab = tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)  # of the text of an id
        for token, i in vocab.items():  # a byte is one symbol in the vocabulary, but not in added tokens
            self.bytes[i] = len(token.encode()) if token in specials else len(token)

    def _new(self, pieces: pa.LargeStringArray) -> pa.LargeListArray:
        """The ids of each piece.  Those of a space and another symbol are given
        to the library in phrases.  It cuts these into the same pieces, so each
        piece ends where an id's text does; a phrase where one does not, and
        other pieces, are encoded one by one."""
        phrased = pc.match_substring_regex(pieces, _SPACED).to_numpy(zero_copy_only=False)
        whole = pieces.filter(pa.array(phrased))
        size = np.zeros(len(pieces), np.int64)
        at = np.flatnonzero(phrased)
        ends = (np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:] if len(whole) else np.zeros(1, np.int64))
        flat, done = [], []
        for k in range(0, len(whole), PHRASE * PHRASE):  # the library's results are large
            last = min(k + PHRASE * PHRASE, len(whole))
            starts = np.append(np.arange(k, last, PHRASE), last)
            found = self.tokenizer.encode_batch_fast(_strings(ends[starts], whole.buffers()[2]).to_pylist(),
                                                     add_special_tokens=False)
            for i, j, e in zip(starts[:-1], starts[1:], found, strict=True):
                ids = np.array(e.ids, np.uint32)
                reached = np.cumsum(self.bytes[ids])
                stop = np.searchsorted(reached, ends[i + 1:j + 1] - ends[i])
                if stop[-1] == len(ids) - 1 and (reached[stop] == ends[i + 1:j + 1] - ends[i]).all():
                    size[at[i:j]] = np.diff(stop, prepend=-1)
                    flat.append(ids)
                    done.append(at[i:j])
        known = np.zeros(len(pieces), bool)
        for i in done:
            known[i] = True
        rest = np.flatnonzero(~known)
        alone = [e.ids for e in self.tokenizer.encode_batch_fast(pieces.take(pa.array(rest)).to_pylist(),
                                                                 add_special_tokens=False)]
        size[rest] = [len(x) for x in alone]
        order = np.concatenate([*done, rest]).astype(np.int64)
        flat += [np.array(x, np.uint32) for x in alone]
        lists = pa.LargeListArray.from_arrays(pa.array(offsets_of(size[order])),
                                              pa.array(np.concatenate(flat) if flat else np.zeros(0, np.uint32)))
        return lists.take(pa.array(np.argsort(order)))

    def _lists(self, parts: pa.LargeStringArray, literal: list[str]) -> pa.LargeListArray:
        """The ids of the parts with a space before each, then of texts as they are."""
        if self.cut.keeps_words:
            plain = pc.match_substring_regex(parts, _PLAIN)
        else:
            plain = pa.array(np.zeros(len(parts), bool))
        words = parts.filter(plain)
        marked = pc.match_substring_regex(words, _MARK + "$")
        marks = pc.utf8_slice_codeunits(words.filter(marked), -1)
        words = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)
        words = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), words, pa.scalar("", pa.large_string()))
        plain, marked = plain.to_numpy(zero_copy_only=False), marked.to_numpy(zero_copy_only=False)
        cuts = [*[self.cut(" " + p) for p in parts.filter(pa.array(~plain)).to_pylist()], *map(self.cut, literal)]
        coded = pa.concat_arrays([words, marks, pa.array(itertools.chain.from_iterable(cuts), pa.large_string())]).dictionary_encode()

        others = np.concatenate([np.flatnonzero(~plain), len(parts) + np.arange(len(literal))]).astype(np.int64)
        count = np.ones(len(parts) + len(literal), np.int64)
        simple = np.flatnonzero(plain)
        count[simple[marked]] = 2
        count[others] = n = np.fromiter(map(len, cuts), np.int64, len(cuts))
        at = offsets_of(count)
        place = np.empty(at[-1], np.int64)  # of each piece among the three kinds
        place[at[simple]] = np.arange(len(words))
        place[at[simple[marked]] + 1] = len(words) + np.arange(len(marks))
        before = offsets_of(n)
        place[np.repeat(at[others] - before[:-1], n) + np.arange(before[-1])] = len(words) + len(marks) + np.arange(before[-1])
        lists = self.memory.fill(coded.dictionary, self._new).take(coded.indices.take(pa.array(place)))
        return pa.LargeListArray.from_arrays(pa.array(lists.offsets.to_numpy()[at]), lists.values)

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]; null is empty."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        whole = pc.fill_null(texts, "")
        run = pc.match_substring_regex(whole, SPACE_RUN)
        runs = np.flatnonzero(run.to_numpy(zero_copy_only=False))
        # A text with runs takes part as one literal part.
        words = pc.split_pattern(pc.if_else(run, "", whole) if len(runs) else whole, " ")
        first = words.offsets.to_numpy() - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        # A text's first part has no space before it.
        heads, head_of = np.unique(at[first[:-1]], return_inverse=True)
        n = len(coded.dictionary)
        at[first[:-1]] = n + head_of
        at[first[runs]] = n + len(heads) + np.arange(len(runs))
        literal = [*coded.dictionary.take(pa.array(heads)).to_pylist(), *whole.take(pa.array(runs)).to_pylist()]
        lists = self._lists(coded.dictionary, literal).take(pa.array(at))
        return lists.offsets.to_numpy()[first], lists.values.to_numpy()


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """Arrow binaries of ``data[offsets[i]:offsets[i + 1]]``."""
    at = (offsets * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])


def tokenize(df: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n, ids of each row's whole text, the end id included; ``ids``
    holds little-endian integers of 16 bits where the vocabulary allows, else 32."""
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    kind = _id_type(max([end_id, *spec["model"]["vocab"].values(), *(a["id"] for a in spec.get("added_tokens", []))]))
    content = df.sparkSession.sparkContext.broadcast(text)
    doc_id = next(f for f in df.schema.fields if f.name == "doc_id")
    schema = T.StructType([doc_id, T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        enc = _encoder(content.value)
        for b in batches:
            texts = b.column("text")
            for i, j in rounds(texts, ENCODE_BYTES):
                at, found = enc(texts.slice(i, j - i))
                ends = at + np.arange(len(at))  # room for one more id in each
                ids = np.empty(ends[-1], kind)
                is_end = np.zeros(ends[-1], bool)
                is_end[ends[1:] - 1] = True
                ids[is_end] = end_id
                ids[~is_end] = found
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(np.diff(ends)), _binary(ends, ids)],
                    ["doc_id", "n", "ids"])
    return df.select("doc_id", "text").mapInArrow(run, schema)


def _id_type(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def count_ids(tokens: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all documents; tasks count first, so at most one row per id and task is shuffled."""
    def run(batches):
        counts = np.zeros(0, np.int64)
        for b in batches:
            c = b.column("ids")
            n = np.bincount(np.frombuffer(b"".join(c.to_pylist()), kind))
            if len(n) > len(counts):
                counts, n = n, counts
            counts[:len(n)] += n
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])
    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(df: DataFrame, tokenizer_path: str, root: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                file_ids: int = FILE_IDS) -> str:
    """Write the token files of ``df`` (doc_id, text) under folder ``root``; returns it."""
    spark = df.sparkSession
    # Tokenised once: both the counts and the coding read it.
    tokenize(df, tokenizer_path, end_id).write.option("compression", "zstd").parquet(f"{root}/tokens")
    tokens = spark.read.parquet(f"{root}/tokens")
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    kind = _id_type(max([end_id, *spec["model"]["vocab"].values(), *(a["id"] for a in spec.get("added_tokens", []))]))
    rows = count_ids(tokens, kind).toPandas()  # at most one row per id of the vocabulary
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    counts[rows["id"]] = rows["n"]
    lengths = huffman.code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, bits int").coalesce(1).write.parquet(
        f"{root}/codebook")
    codes = spark.sparkContext.broadcast((huffman.canonical_codes(lengths), lengths))
    doc_type = tokens.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("file_no", T.IntegerType()), T.StructField("block_no", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(doc_type)), T.StructField("n_tokens", T.ArrayType(T.IntegerType())),
        T.StructField("n_ids", T.IntegerType()), T.StructField("checkpoints", T.BinaryType()),
        T.StructField("payload", T.BinaryType())])

    def run(batches):
        code, length = codes.value
        file_no, block_no = TaskContext.get().partitionId(), 0
        docs, parts, size, doc_arrow = [], [], 0, None

        def block():
            payload, checkpoints = huffman.encode_block(np.frombuffer(b"".join(parts), kind), code, length)
            return pa.RecordBatch.from_arrays(
                [pa.array([file_no], pa.int32()), pa.array([block_no], pa.int32()),
                 pa.array([docs], pa.list_(doc_arrow)),
                 pa.array([[len(p) // width for p in parts]], pa.list_(pa.int32())), pa.array([size], pa.int32()),
                 pa.array([checkpoints], pa.binary()), pa.array([payload], pa.binary())], names)
        width, names = np.dtype(kind).itemsize, schema.names
        for b in batches:
            doc_arrow = b.schema.field("doc_id").type
            for d, ids in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                docs.append(d)
                parts.append(ids)
                size += len(ids) // width
                if size >= block_ids:
                    yield block()
                    docs, parts, size, block_no = [], [], 0, block_no + 1
        if docs:
            yield block()
    n_files = max(1, -(-(tokens.agg(F.sum("n")).first()[0] or 0) // file_ids))
    ordered = tokens.select("doc_id", "ids").repartitionByRange(n_files, "doc_id").sortWithinPartitions("doc_id", "ids")
    # Bits do not compress any further.
    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{root}/blocks")
    return root


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per document of the token files under ``root``: file_no,
    block_no, offset (ids before it in the block), doc_id, n_tokens and ids
    (binary, little-endian integers of 32 bits)."""
    rows = spark.read.parquet(f"{root}/codebook").toPandas()  # at most one row per id of the vocabulary
    lengths = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.uint8)
    lengths[rows["id"]] = rows["bits"]
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{root}/blocks")
    doc_type = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("file_no", T.IntegerType()), T.StructField("block_no", T.IntegerType()),
        T.StructField("offset", T.LongType()), T.StructField("doc_id", doc_type),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        table, bits = huffman.decode_table(shared.value)

        def decoded(b):
            n = b.column("n_ids").to_pylist()
            found = huffman.decode_blocks(list(zip(b.column("payload").to_pylist(), b.column("checkpoints").to_pylist(),
                                                   n, strict=True)), table, bits)
            docs, each = b.column("doc_ids"), b.column("n_tokens")
            per = np.diff(docs.offsets.to_numpy())
            sizes = each.flatten().to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.concatenate(found).astype("<u4") if found else np.zeros(0, "<u4")
            base = np.repeat(np.cumsum([0, *n])[:-1], per)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column("file_no").to_numpy(), per)),
                 pa.array(np.repeat(b.column("block_no").to_numpy(), per)), pa.array(ends[:-1] - base),
                 docs.flatten(), pa.array(sizes), _binary(ends, ids)], schema.names)
        for b in batches:
            start, size = 0, 0
            for i, n in enumerate(b.column("n_ids").to_pylist()):
                if i > start and size + n > DECODE_IDS:
                    yield decoded(b.slice(start, i - start))
                    start, size = i, 0
                size += n
            if b.num_rows > start:
                yield decoded(b.slice(start))
    return blocks.mapInArrow(run, schema)


def block_starts(spark: SparkSession, root: str) -> DataFrame:
    """(file_no, block_no, start): the ids of all blocks before each one."""
    b = spark.read.parquet(f"{root}/blocks").select("file_no", "block_no", "n_ids")
    files = b.groupBy("file_no").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # over one row per file
    files = files.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file_no").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    return b.join(files, "file_no").select("file_no", "block_no", (
        F.col("file_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("start"))


@register("op9_token_files")
def op9_token_files(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_files(documents(spark, sf_dir), tokenizer_path, root)
    d = read_files(spark, root).select("file_no", "block_no", "offset", "doc_id", "n_tokens",
                                       F.crc32("ids").alias("ids_crc32"))
    return d.join(block_starts(spark, root), ["file_no", "block_no"]).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
