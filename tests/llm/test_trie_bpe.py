import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayline.llm import pieces, trie_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return trie_bpe._encoder(f.read())


def ids_of(encoder, texts):
    at, found = encoder.encode(texts)
    return [found[s:e].tolist() for s, e in zip(at[:-1], at[1:])]


def test_random_texts_equal_the_library(library, encoder):
    rng = random.Random(3)
    signs = "ab '\n\t.1é日😀sdtlr -=_\r\xa0\x85 "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0xD7FF), rng.randrange(0x10000, 0x1FFFF)]))
                      for _ in range(40)) for _ in range(300)]
    texts += ["don't we'll 'tis ''s !'s", "x<|endoftext|>y <|endoftext|>", "a" * 5000, "ab" * 3000, "  \n  a", None, ""]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids_of(encoder, texts) == want


def test_shared_prefixes_do_not_depend_on_the_round(encoder):
    """Any order and grouping of pieces gives the same ids, and forgetting changes nothing."""
    with open(PATH, encoding="utf-8") as f:
        m = trie_bpe.model(f.read())
    words = ["inter", "internal", "international", "internationalization", "int", "i", " international", "nation"]
    alone = [m.encode_pieces([w])[0] for w in words]
    assert m.encode_pieces(words) == alone
    assert m.encode_pieces(words[::-1]) == alone[::-1]
    small = pieces.PieceEncoder(encoder.cut, m.encode_pieces, 2)
    texts = ["the cat sat", "on the mat", "the mat sat on the cat"] * 3
    assert ids_of(small, texts) == ids_of(encoder, texts)


@pytest.mark.parametrize("name", ["odd", "sample"])
def test_query_columns(request, spark, library, name):
    docs = request.getfixturevalue(name)
    got = trie_bpe.encode_decode(docs.select("doc_id", "text"), PATH).select(
        "doc_id", "ids", F.sha2("decoded", 256).alias("decoded_sha256")).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_encode_then_decode_is_a_round_trip(odd):
    d = trie_bpe.decode(trie_bpe.encode(odd, PATH), PATH)
    assert set(odd.columns) <= set(d.columns)  # its column "ids" is replaced
    assert all(r.decoded == (r.text or "") for r in d.select("text", "decoded").collect())


def test_empty(empty):
    assert trie_bpe.encode(empty, PATH).count() == 0
    assert trie_bpe.encode_decode(empty, PATH).count() == 0


def test_rounds_cover_a_batch():
    texts = ["abc", None, "d" * 50, "", "e"]
    for size in (1, 4, 100):
        cuts = list(pieces.rounds(texts, size))
        assert [c for c, _ in cuts][0] == 0 and cuts[-1][1] == len(texts)
        assert all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert list(pieces.rounds([])) == []


def test_dtype_of_id_lists():
    a = pieces.id_lists(np.array([0, 2, 2, 3]), np.array([5, 6, 7], np.uint32))
    assert a.to_pylist() == [[5, 6], [], [7]]
