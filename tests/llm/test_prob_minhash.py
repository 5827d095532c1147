import itertools
from collections import Counter

import numpy as np
import pytest

from stayline.llm import prob_minhash as M


def weights(text):
    w = [x for x in M.spaced(text).split(" ") if x]
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in set(a) | set(b)) for x in set(a) & set(b))


def brute(rows):
    """Least id of each row's component in the graph of all similar pairs."""
    sets = {d: weights(t) for d, t in rows if d is not None}
    of = {d: d for d in sets}

    def root(d):
        while of[d] != d:
            d = of[d]
        return d
    for a, b in itertools.combinations(sorted(sets), 2):
        if root(a) != root(b) and sets[a] and len(sets[a] & sets[b]) and similarity(sets[a], sets[b]) >= M.THRESHOLD:
            x, y = sorted((root(a), root(b)))
            of[y] = x
    return {d: root(d) for d in sets}


def family(rng, docs, words=120):
    """Copies of copies of a text, each with a few words changed."""
    base = [f"w{rng.integers(0, 800)}" for _ in range(words)]
    out = [base]
    while len(out) < docs:
        t = list(out[rng.integers(0, len(out))])
        for _ in range(rng.integers(0, 5)):
            t[rng.integers(0, words)] = f"x{rng.integers(0, 10 ** 6)}"
        out.append(t)
    return [" ".join(t) for t in out]


def test_classes_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    texts = family(rng, 60) + family(rng, 15) + family(rng, 5, 30)
    texts += ["tiny text", "tiny text", "tiny  text\n", "other text", "", None, "a b c d e", "a b c d e f"]
    texts += ["again and again " * 30, "again and again " * 40, " ".join(f"u{i}" for i in range(300))]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    rows = [(int(d), t) for d, t in rows]
    got = {r.doc_id: r.class_id for r in M.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert 1 < len(set(got.values())) < len(got)


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(0)
    for _ in range(10):
        a = [f"w{rng.integers(0, 500)}" for _ in range(80)]
        b = list(a)
        for k in rng.integers(0, 80, rng.integers(0, 8)):
            b[k] = "y"
        texts = [" ".join(a + a[:20] * 3), " ".join(b)]
        doc, x, w = M.shingles(texts)
        s = M.signatures(doc, x, w, 2, 3000)
        exact = similarity(weights(texts[0]), weights(texts[1]))
        cut = np.searchsorted(doc, [0, 1, 2])
        (i, j, k) = cut
        assert M.probability_jaccard(x[i:j], w[i:j].astype(np.uint32), x[j:k], w[j:k].astype(np.uint32)) == pytest.approx(exact)
        assert (s[0] == s[1]).mean() == pytest.approx(exact, abs=0.05)


def test_odd_documents(spark, odd):
    got = M.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    cls = {}
    for r in got:
        cls.setdefault(r.doc_id, set()).add(r.class_id)
    assert cls[5] == cls[6] == cls[7] == {5} and cls[15] == {15} and cls[None] == {None}
    assert cls[1] == {1} and cls[2] == {2} and cls[3] == {3}
    out = M.dedup(odd)
    assert out.columns == odd.columns
    left = [r.doc_id for r in out.collect()]
    assert 5 in left and 6 not in left and 7 not in left and None in left


def test_rows_that_share_an_id_are_one_document(spark):
    """Its texts are compared each, whatever the order and the partitions of the rows."""
    rng = np.random.default_rng(4)
    a, b, c = (" ".join(f"{k}{rng.integers(0, 900)}" for _ in range(100)) for k in "abc")
    near = {t: t.rsplit(" ", 2)[0] + " changed words" for t in (a, b, c)}
    rows = [(5, a), (5, b), (5, a), (2, near[a]), (3, near[b]), (7, c), (8, near[c]), (8, None), (9, b), (10, "alone it is")]
    want = {2: 2, 3: 2, 5: 2, 9: 2, 7: 7, 10: 10}
    for parts in (1, 3, 7):
        rng.shuffle(rows)
        d = spark.createDataFrame([(int(i), t) for i, t in rows], "doc_id long, text string").repartition(parts)
        got = M.near_duplicates(d).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, r.class_id) for r in got if r.doc_id != 8} == set(want.items())
        assert sorted(r.class_id for r in got if r.doc_id == 8) == [7, 8]  # a row without words has its own id
        assert {r.doc_id for r in M.dedup(d).collect()} == {2, 7, 10}


def test_empty(empty):
    assert M.classes(empty).count() == 0
    assert M.dedup(empty).count() == 0
