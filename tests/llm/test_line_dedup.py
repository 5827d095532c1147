import random

import pytest

from stayline.llm import line_dedup as L


def brute(rows, min_words):
    """Cleaned text per id: at every line the longest run that an earlier place has, by comparison with all of them."""
    texts = dict(rows)
    order = sorted(texts, key=lambda d: (d is not None, d))
    seqs = {d: [(i, x) for i, x in enumerate((texts[d] or "").split("\n")) if x.split()] for d in order}
    places = [(d, k) for d in order for k in range(len(seqs[d]))]
    gone = {d: set() for d in order}
    for n, (d, k) in enumerate(places):
        mine, best = [x for _, x in seqs[d]][k:], 0
        for e, j in places[:n]:
            other, m = [x for _, x in seqs[e]][j:], 0
            while m < min(len(mine), len(other)) and mine[m] == other[m]:
                m += 1
            best = max(best, m)
        if best and sum(len(x.split()) for x in mine[:best]) >= min_words:
            gone[d].update(range(k, k + best))
    out = {}
    for d in order:
        drop = set()
        for k in gone[d]:
            drop.add(seqs[d][k][0])
            if k + 1 in gone[d]:  # lines without a word inside a run
                drop.update(range(seqs[d][k][0], seqs[d][k + 1][0]))
        lines = (texts[d] or "").split("\n")
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else texts[d] or ""
    return out


def test_clean_text_equals_brute_force(spark):
    rng = random.Random(5)
    vocab = [" ".join([f"w{i}"] * rng.randint(1, 4)) for i in range(6)]
    rows = []
    for d in range(40):
        n = rng.choice([0, 1, 3, 8, 20])
        rows.append((d, "\n".join(rng.choice([*vocab, "", f"u{d} {rng.randint(0, 9)}"]) for _ in range(n))))
    rows += [(100 + i, rows[i][1]) for i in range(10)]
    rows += [(200, "\n".join(["a b"] * 40)), (201, None), (202, "\n".join(["a b"] * 33 + ["z"])), (None, rows[4][1])]
    got = {r.doc_id: r.clean_text for r in L.clean(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()}
    want = brute(rows, 5)
    assert got == want
    assert sum(want[d] != (t or "") for d, t in rows) > 10


def test_sweep_carries_open_intervals_over_borders():
    """Any cut of a suffix array into ranges gives the lengths of the whole."""
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 12)
        at = rng.sample(range(50), n)
        lcp = [0] + [rng.randint(0, 4) for _ in range(n - 1)]
        whole = [0] * n
        for i in range(n):
            for j in range(n):
                if at[j] < at[i]:
                    whole[i] = max(whole[i], min(lcp[min(i, j) + 1:max(i, j) + 1]))
        cut = rng.randint(0, n)
        found, open_ = [], []
        for a, c in ((at[:cut], lcp[:cut]), (at[cut:], lcp[cut:])):
            if a:
                part = [0] * len(a)
                enter = L.cut(open_, c[0])
                open_ = L.sweep(a, c, enter, part)
                found += part
        back, open_, link = [], [], 0
        for a, c in ((at[cut:], lcp[cut:]), (at[:cut], lcp[:cut])):
            if a:
                part = [0] * len(a)
                open_ = L.sweep(a[::-1], [0, *c[:0:-1]], L.cut(open_, link), part)
                link = c[0]
                back = part[::-1] + back
        assert [max(x, y) for x, y in zip(found, back)] == whole


def test_odd_documents(odd):
    out = L.clean(odd, 50)
    assert out.count() == odd.count() and "removed" in out.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[11].clean_text == "x y" and got[1].clean_text == "" and got[9].removed == []
    assert got[10].clean_text.count("\n") <= 1


def test_empty(empty):
    assert L.clean(empty).count() == 0


@pytest.mark.parametrize("steps,lcp,want", [
    ([], 3, []), ([(5, 9)], 7, [(5, 9)]), ([(5, 9), (2, 1)], 3, [(3, 9), (2, 1)]), ([(5, 9), (4, 3)], 0, [])])
def test_cut(steps, lcp, want):
    assert L.cut(steps, lcp) == want
