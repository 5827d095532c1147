import heapq
import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stayline.llm import huffman, token_files
from stayline.session import ensure_checkpoint_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


def huffman_cost(counts):
    """Total bits of an unlimited Huffman code."""
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


def test_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    for n in (2, 3, 50, 1000):
        counts = rng.integers(1, 1000, n)
        lengths = huffman.code_lengths(counts)
        assert (counts * lengths).sum() == huffman_cost(counts)
        assert (2.0 ** -lengths.astype(float)).sum() <= 1
    steep = np.array([1 << i for i in range(40)])  # an unlimited code would need 39 bits
    lengths = huffman.code_lengths(steep)
    assert lengths.max() <= huffman.LEAST_LIMIT and (2.0 ** -lengths.astype(float)).sum() <= 1


def test_codes_are_canonical_and_prefix_free():
    counts = np.random.default_rng(2).integers(0, 50, 300)
    lengths = huffman.code_lengths(counts)
    codes = huffman.canonical_codes(lengths)
    words = [format(int(codes[i]), f"0{lengths[i]}b") for i in np.flatnonzero(lengths)]
    assert len(set(words)) == len(words)
    for a, b in zip(sorted(words), sorted(words)[1:]):
        assert not b.startswith(a)


def test_blocks_round_trip():
    rng = random.Random(4)
    for n_ids in (1, 2, 127, 128, 129, 1000, 5000):
        ids = np.array([min(int(rng.expovariate(0.02)), 999) for _ in range(n_ids)], np.uint32)
        lengths = huffman.code_lengths(np.bincount(ids, minlength=1000))
        codes = huffman.canonical_codes(lengths)
        table, bits = huffman.decode_table(lengths)
        cut = n_ids // 3
        blocks = [(*huffman.encode_block(p, codes, lengths), len(p)) for p in (ids[:cut], ids[cut:], ids[:0])]
        got = huffman.decode_blocks(blocks, table, bits)
        assert np.array_equal(np.concatenate(got), ids)
        assert [len(g) for g in got] == [cut, n_ids - cut, 0]


def read(spark, docs, **sizes):
    root = f"{ensure_checkpoint_dir(spark)}/token-test-{uuid.uuid4().hex}"
    token_files.write_files(docs, PATH, root, **sizes)
    d = token_files.read_files(spark, root).join(token_files.block_starts(spark, root), ["file_no", "block_no"])
    return root, sorted(((r.start + r.offset, r.doc_id, r.n_tokens, bytes(r.ids)) for r in d.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("name,sizes", [("odd", {}), ("odd", {"block_ids": 20, "file_ids": 5000}), ("sample", {"file_ids": 20_000})])
def test_files_hold_the_librarys_ids_in_order(request, spark, name, sizes):
    docs = request.getfixturevalue(name)
    t = Tokenizer.from_file(PATH)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    root, got = read(spark, docs, **sizes)
    assert [g[1] for g in got] == [r[0] for r in rows]
    at = 0
    for (start, _, n, ids), (_, text) in zip(got, rows):
        want = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (start, n, zlib.crc32(ids)) == (at, len(want), zlib.crc32(want.tobytes()))
        at += n
    blocks = spark.read.parquet(f"{root}/blocks").collect()
    assert all(len(b.doc_ids) == len(b.n_tokens) and sum(b.n_tokens) == b.n_ids for b in blocks)
    if sizes.get("block_ids") == 20:
        assert len(blocks) > 5


def test_empty(spark, empty):
    assert read(spark, empty)[1] == []


def test_whole_text_path(spark):
    """A tokenizer with another pre-tokenizer is not fed in pieces."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        content = f.read()
    enc = token_files._encoder(content)
    texts = ["Hello World  again", None, "a-b c"]
    at, ids = enc(texts)
    t = Tokenizer.from_str(content)
    assert [ids[s:e].tolist() for s, e in zip(at[:-1], at[1:])] == [
        t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_phrases_give_the_librarys_ids():
    """Special strings, runs of white space, marks, letters of all kinds and rounds beyond what is remembered."""
    library = Tokenizer.from_file(PATH)
    rng = random.Random(11)
    atoms = ["word", "Éte", "naïve", "x", "İ", "日本", "क़न", "12", "a1", "it's", "we'LL", "'", "''", "...", "!?", "<|endoftext|>",
             "<|endof", "×", "é", "e\u0301", "\u00a0", "\n", "\t", "\r\n", " ", "  ", "\u2003", "$$$", "ok.", "ok.\nthen", "👩‍👩‍👧"]
    texts = [None, "", " ", "\n"] + ["".join(rng.choice(atoms) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 40)))
                                    for _ in range(600)]
    with open(PATH, encoding="utf-8") as f:
        content = f.read()
    for size in (3, 10_000):
        encoder = token_files.PhraseEncoder(Tokenizer.from_str(content), ("<|endoftext|>",), size)
        for k in range(0, len(texts), 97):
            at, ids = encoder.encode(texts[k:k + 97])
            for i, text in enumerate(texts[k:k + 97]):
                assert ids[at[i]:at[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text
