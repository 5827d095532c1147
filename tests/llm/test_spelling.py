import re
import zlib
from collections import Counter

from stayline.llm import spelling


def brute(rows, least=3, one_in=97):
    """The contract's words and forms by comparing every pair."""
    counts = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % one_in == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= least}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]
    out = {}
    for w in n:
        ys = [y for y in n if near(w, y)]
        best = min(ys, key=lambda y: (-n[y], y), default=None)
        form = best if best and n[best] >= 2 * n[w] else None
        out[w] = [form, n[w], len(ys), n[form] if form else None]
    for w, r in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        r.insert(1, root)
    return {w: tuple(r) for w, r in out.items()}


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_equals_all_pairs_on_every_document(spark):
    from stayline.llm.common import documents
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in documents(spark, sf).collect()]
    want = brute(rows)
    assert result(spelling.op13_spelling_variants(spark, sf)) == want
    assert sum(r[0] is not None for r in want.values()) > 100


def test_dense_words_lose_no_pair(spark):
    """Short words over two letters: many near words, repeated bigrams, equal ranks, ties."""
    import itertools
    words = ["".join(w) for k in (5, 6, 7) for w in itertools.product("ab", repeat=k)]
    words += ["éa" + w for w in words[:64]] + ["aaaaaÿ", "aaaaa÷"]
    rows = [(i, " ".join([w] * (3 + i % 5))) for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(spelling.group_variants(docs)) == brute(rows)


def test_chains_reach_the_last_form(spark):
    text = " ".join(["colourx"] * 3 + ["colour"] * 6 + ["color"] * 12 + ["couleur"] * 3)
    got = result(spelling.group_variants(spark.createDataFrame([(1, text)], "doc_id long, text string"), delete_one_in=0))
    assert got == {"colourx": ("colour", "color", 3, 1, 6), "colour": ("color", "color", 6, 2, 12),
                   "color": (None, "color", 12, 1, None), "couleur": (None, "couleur", 3, 0, None)}


def test_pivots_are_the_rarest_disjoint_pair():
    count = {"ab": 5, "bc": 1, "cd": 2, "de": 9, "ef": 2}
    assert spelling.gram_prefix("abcdef", count) == ([1, 2, 4], [1, 2, 4])
    assert spelling.gram_prefix("aaaaaab", {"aa": 1, "ab": 2}) == ([0, 1, 2], [0, 1, 2, 3])
    assert spelling.pivots("abcdef", [1, 2, 4], count) == (1, 4)


def test_long_words(spark):
    """Words of 200 and 20,000 letters with one edit at either end and inside."""
    rows = []
    for base in ("abcdefghij" * 20, "a" * 20_000):
        n = len(base)
        edits = [base, "b" + base, base + "x", base[1:] + "y", base[:n // 2] + "z" + base[n // 2:],
                 base[:n // 2] + "q" + base[n // 2 + 1:], base[:-1], "zz" + base]
        rows += [(i, " ".join([w] * (3 + i))) for i, w in enumerate(edits)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(spelling.group_variants(docs, delete_one_in=0))
    want = brute(rows, one_in=10 ** 12)
    assert got == want and sum(r[3] for r in want.values()) > 20


def test_odd_rows(spark, odd, odd_rows, empty):
    assert result(spelling.group_variants(odd, least=1)) == brute([r[:2] for r in odd_rows], least=1)
    assert result(spelling.group_variants(odd)) == brute([r[:2] for r in odd_rows])
    assert spelling.group_variants(empty).count() == 0
