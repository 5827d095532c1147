"""BPE encoding by a depth-first walk over the trie of distinct pieces.

For a byte-level BPE the encoding of a prefix is known from its *last token*
alone: the token ``t`` such that the prefix without ``t`` ends in a token that
forms a stable pair with ``t``.  Exactly one suffix token qualifies, so the
last token is a state that can be passed from a trie node to its children, and
the whole encoding is read back along the last tokens.  The distinct pieces of
a round are put in order; in that order neighbours share their trie path up to
their common prefix, so walking them with one stack visits each trie node once
and shared prefixes are encoded once.

A pair (l, r) is *stable* if BPE on the joined bytes would never merge across
the border.  What stands at the border while BPE runs are the tokens on l's
right edge and r's left edge of their merge trees, each alive from the rank
that makes it to the rank that consumes it; the pair is unstable if two of
them are alive together at the rank of their own merge.

Defined results: a null text is an empty one (no ids, decoded ''); repeated
rows are encoded alike; an empty table gives an empty result; extra columns
pass through ``encode`` and ``decode`` unchanged, but for one of the result's
name, which the result replaces."""

from __future__ import annotations

import functools
import itertools
import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import documents
from stayline.llm.pieces import PieceEncoder, id_lists, rounds, splitter
from stayline.llm.registry import register

_NEVER = 1 << 62
#: Remembered pair verdicts of a worker.
PAIRS = 200_000
#: Bytes of text of a round, and pieces that a worker remembers, next to the vocabulary.
ROUND_BYTES = 4_000_000
REMEMBERED = 500_000


@functools.cache
def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """Vocabulary, merge ranks and the trie walk of one tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items()}
        self.token_bytes |= {i: s.encode() for s, i in self.specials.items()}
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token: rank, left, right
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            l, r, t = vocab[left], vocab[right], vocab[left + right]
            self.merge_rank.setdefault((l, r), rank)
            self.made.setdefault(t, (rank, l, r))
        # Only bytes and merge results can come out of BPE.
        self.ids = {b: i for i, b in self.token_bytes.items()
                    if i in self.made or (len(b) == 1 and i not in self.specials.values())}
        self.starts = {b[:k] for b in self.ids for k in range(1, len(b) + 1)}
        self.stable: dict[int, bool] = {}

    @functools.cache
    def edge(self, token: int, right: bool) -> list[tuple[int, int, int]]:
        """(token, made at rank, consumed at rank) down the right or left edge of the merge tree."""
        out, consumed = [], _NEVER
        while True:
            rank, l, r = self.made.get(token, (-1, -1, -1))
            out.append((token, rank, consumed))
            if rank < 0:
                return out
            token, consumed = (r if right else l), rank

    def is_stable(self, l: int, r: int) -> bool:
        for a, a_made, a_gone in self.edge(l, True):
            for b, b_made, b_gone in self.edge(r, False):
                m = self.merge_rank.get((a, b), -1)
                # At equal rank the leftmost merge goes first.
                if m > a_made and m > b_made and m < a_gone and m <= b_gone:
                    return False
        return True

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct pieces, in the given order."""
        words = [p.encode("utf-8", "surrogatepass") for p in pieces]
        out: list[tuple[int, ...]] = [()] * len(words)
        ids, starts, stable = self.ids, self.starts, self.stable
        if len(stable) > PAIRS:
            stable.clear()
        prev = b""
        last, cut, begin = [-1], [0], [0]  # by depth: last token, where it starts, where the longest token start starts
        for at in sorted(range(len(words)), key=words.__getitem__):
            w = words[at]
            if pieces[at] in self.specials:
                out[at] = (self.specials[pieces[at]],)
                continue
            depth, n = 0, min(len(w), len(prev))
            while depth < n and w[depth] == prev[depth]:
                depth += 1
            del last[depth + 1:], cut[depth + 1:], begin[depth + 1:]
            for end in range(depth + 1, len(w) + 1):
                s = begin[-1]
                while w[s:end] not in starts:
                    s += 1
                begin.append(s)
                while True:  # longest suffix token first; one of them fits
                    t = ids.get(w[s:end])
                    if t is not None:
                        if s == 0:
                            break
                        key = last[s] << 32 | t
                        fits = stable.get(key)
                        if fits is None:
                            fits = stable[key] = self.is_stable(last[s], t)
                        if fits:
                            break
                    s += 1
                last.append(t)
                cut.append(s)
            prev = w
            d, path = len(w), []
            while d:
                path.append(last[d])
                d = cut[d]
            out[at] = tuple(reversed(path))
        return out

    def decode(self, ids) -> str:
        known = self.token_bytes
        return b"".join([known.get(i, b"") for i in ids]).decode("utf-8", "replace")


@functools.cache
def model(content: str) -> Bpe:
    return Bpe(content)


@functools.cache
def _encoder(content: str) -> PieceEncoder:
    m = model(content)
    return PieceEncoder(splitter(tuple(m.specials)), m.encode_pieces, REMEMBERED)


def _file(spark, path: str):
    """The tokenizer file's content (a few MB), for the workers."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, which a result takes (in any case of letters)."""
    taken = {n.lower() for n in names}
    return df.select(*[df[c] for c in df.columns if c.lower() not in taken])


def encode(df: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with column ``ids`` (array of int): the whole text's token ids."""
    content = _file(df.sparkSession, tokenizer_path)
    df = without(df, ids)
    schema = T.StructType([*df.schema.fields]).add(ids, T.ArrayType(T.IntegerType()))

    def run(batches):
        enc = _encoder(content.value)
        for b in batches:
            texts = b.column(text)
            for i, j in rounds(texts, ROUND_BYTES):
                lists = id_lists(*enc.encode(texts.slice(i, j - i)))
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, lists], [*b.schema.names, ids])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with column ``decoded``: the text of the ids (null ids: null)."""
    content = _file(df.sparkSession, tokenizer_path)
    df = without(df, decoded)
    schema = T.StructType([*df.schema.fields]).add(decoded, T.StringType())

    def run(batches):
        m = model(content.value)
        for b in batches:
            texts = [None if x is None else m.decode(x) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, decoded])
    return df.mapInArrow(run, schema)


def encode_decode(df: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``ids`` and ``decoded``: both directions in one pass over the rows."""
    content = _file(df.sparkSession, tokenizer_path)
    df = without(df, "ids", "decoded")
    schema = T.StructType([f for f in df.schema.fields if f.name != text]).add(
        "ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    def run(batches):
        m, enc = model(content.value), _encoder(content.value)
        for b in batches:
            keep = [k for k, n in enumerate(b.schema.names) if n != text]
            texts = b.column(text)
            for i, j in rounds(texts, ROUND_BYTES):
                part = b.slice(i, j - i)
                at, found = enc.encode(texts.slice(i, j - i))
                back = [m.decode(found[s:e].tolist()) for s, e in itertools.pairwise(at)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keep], id_lists(at, found), pa.array(back, pa.string())],
                    [*[b.schema.names[k] for k in keep], "ids", "decoded"])
    return df.mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op4_trie_bpe")
def op4_trie_bpe(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    d = encode_decode(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path or default_tokenizer())
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))
