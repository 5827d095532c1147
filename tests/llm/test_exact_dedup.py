import hashlib
from collections import defaultdict

import pytest

from stayline.llm import exact_dedup


def brute(rows):
    by = defaultdict(list)
    for d, t in rows:
        by[t or ""].append(d)
    out = []
    for d, t in rows:
        ids = by[t or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((d, keep, len(ids), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits,capacity", [(64, 100_000), (64, 3), (3, 2)])
def test_marks_equal_brute_force(odd, bits, capacity):
    """Three bits of hash put different texts into one chain; a small capacity doubles the directory."""
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [tuple(r) for r in exact_dedup.mark(odd, capacity=capacity, max_depth=4, hash_bits=bits).collect()]
    assert sorted(got, key=str) == brute(rows)


@pytest.mark.parametrize("bits", [64, 2])
def test_dedup_keeps_one_row_of_each_text(odd, bits):
    rows = {(r.doc_id, r.text) for r in odd.collect()}
    out = exact_dedup.dedup(odd, capacity=3, max_depth=4, hash_bits=bits)
    assert out.columns == odd.columns
    got = out.collect()
    assert len(got) == len({t or "" for _, t in rows}) == len({r.text or "" for r in got})
    assert {(r.doc_id, r.text) for r in got} <= rows and all(r.h == "extra h" for r in got)


def test_directory_splits_overfull_buckets(spark):
    h = spark.range(4000).selectExpr("xxhash64(id) AS h")
    d = exact_dedup.directory(h, capacity=300, max_depth=8).collect()
    sizes = defaultdict(int)
    cells = {r.cell: r.slot for r in d}
    for r in h.selectExpr("shiftrightunsigned(h, 56) AS c").collect():
        sizes[cells[r.c]] += 1
    assert max(sizes.values()) <= 300 and 16 <= len(sizes) < 64
    for r in d:  # a bucket is a whole aligned block of cells
        assert r.slot <= r.cell < r.slot + (1 << (8 - r.depth)) and r.slot % (1 << (8 - r.depth)) == 0


def test_empty(empty):
    assert exact_dedup.mark(empty).count() == 0
    assert exact_dedup.dedup(empty).count() == 0
