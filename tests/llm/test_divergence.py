import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from stayline.llm import divergence


def brute(rows, least=3, top=200):
    """The contract's rows with Python's integers."""
    docs = [(x or "", s or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in
                                re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]) for _, t, x, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, n, both = Counter(), defaultdict(Counter), Counter()
        for x, s, ws in docs:
            if x == lang:
                df.update(set(ws))
                n[s].update(ws)
                both.update(ws)
        kept = [t for t, k in df.items() if k >= least]

        def p(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // total for t in kept}
        q, ps = p(both), {s: p(c) for s, c in n.items()}
        for s in n:
            pairs = [(o, sum((ps[s][t] - ps[o][t]) ** 2 // ps[o][t] for t in kept)) for o in n if o != s]
            terms = [(t, (ps[s][t] - q[t]) ** 2 // q[t]) for t in kept if n[s][t] and ps[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_equals_brute_force(spark, sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text", "lang", "source").collect()]
    want = brute(rows)
    assert result(divergence.audit(sample)) == want and len(want) > 1000
    # Many small shards and several rounds of broadcasts change nothing.
    assert result(divergence.audit(sample, shard_keys=100, round_bytes=20_000)) == want


def test_odd_rows(spark, odd, odd_rows, empty):
    assert result(divergence.audit(odd)) == brute(odd_rows)
    assert result(divergence.audit(odd, least=1, top=2)) == brute(odd_rows, 1, 2)
    assert divergence.audit(empty).count() == 0


def test_perfect_hash():
    keys = [f"key {i}".encode() for i in range(5000)]
    ph = divergence.PerfectHash.build(keys)
    slots = ph.slots(pa.array(keys, pa.binary()), divergence.hashes(keys))
    assert sorted(slots) == list(range(5000))
    others = [f"other {i}".encode() for i in range(5000)]
    assert set(ph.slots(pa.array(others, pa.binary()), divergence.hashes(others))) == {-1}


def test_keys_of_equal_hashes_are_found(monkeypatch):
    monkeypatch.setattr(divergence, "hashes", lambda keys: np.array([len(k) % 3 for k in keys], np.uint64))
    keys = [b"a" * i for i in range(1, 20)]
    ph = divergence.PerfectHash.build(keys)
    got = ph.slots(pa.array(keys + [b"zz"], pa.binary()), divergence.hashes(keys + [b"zz"]))
    assert sorted(got[:-1]) == list(range(19)) and got[-1] == -1


def test_no_product_overflows():
    count, total = np.array([0, 7, 10 ** 15]), np.array([10 ** 15 + 5] * 3)
    want = [1 + 10 ** 9 * (int(c) + 1) // int(t) for c, t in zip(count, total)]
    assert divergence._parts_per_billion(count, total).tolist() == want
