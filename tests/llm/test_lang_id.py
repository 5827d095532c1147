import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import lang_id


def predict(docs, model):
    lang, score = lang_id.language_of(F.col("spans"), model.langs)
    return lang_id.label_spans(docs.select("doc_id", "text"), model).select(
        "doc_id", "spans", lang.alias("lang"), score.alias("score"))


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return lang_id.learn(docs.filter(~lang_id.is_held_out()))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(lang_id.is_held_out())
    right = predict(docs, model).join(docs.select("doc_id", F.col("lang").alias("want")), "doc_id")
    assert right.agg(F.avg((F.col("lang") == F.col("want")).cast("double"))).first()[0] > 0.97


def test_spans_of_mixed_text(spark, model, sample):
    part = {r.lang: r.text for r in sample.filter("length(text) > 400").dropDuplicates(["lang"]).collect()}
    a, b = part["en"][:300].rsplit(" ", 1)[0], part["de"][:300].rsplit(" ", 1)[0]
    text = a + " " + b + " " + a
    r = predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [s.lang for s in r.spans] == ["en", "de", "en"]
    assert abs(r.spans[1].start - len(a) - 1) < 30 and abs(r.spans[1].end - len(a) - len(b) - 1) < 30
    assert r.lang == "en" and 0.4 < r.score < 0.9
    for s in r.spans:
        assert s.letters <= s.end - s.start and text[s.start] != " " and text[s.end - 1] != " "


def test_best_path_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(300):
        s = -rng.exponential(3, (rng.integers(1, 7), 3)).astype(np.float32)
        got = lang_id.best_path(s, 2.0)

        def worth(p):
            return sum(float(s[i, l]) for i, l in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        assert worth(got) == pytest.approx(max(worth(p) for p in itertools.product(range(3), repeat=len(s))), abs=1e-4)


def test_numerals_are_no_letters():
    assert [lang_id.runs(t) for t in ("²", "½", "①", "x²y", "Wörter12ab", "2nd")] == [
        [], [], [], ["x", "y"], ["wörter", "ab"], ["nd"]]


def plain_units(model, token):
    """(letters, fit, scores) of a token's units, gram by gram."""
    base = max(int(model.symbols.max()) + 1, 3)
    place = {(n, k): r for n, ks, rs in zip(lang_id.GRAM_SIZES, model.keys, model.rows)
             for k, r in zip(ks.tolist(), rs.tolist())}

    def row(g, first, last):
        key = 0
        for i, c in enumerate(g):
            key = key * base + (1 if first and i == 0 else 2 if last and i == len(g) - 1 else int(model.symbols[ord(c)]))
        return place.get((len(g), key % 2 ** 64), -1)
    units, of = [], None
    for w in lang_id.runs(token):
        if lang_id.script(w[0]) != of:
            units.append([])
        of = lang_id.script(w[0])
        units[-1].append(w)
    out = []
    for words in units:
        total = np.zeros(len(model.langs))
        for w in words:
            for n in lang_id.GRAM_SIZES:
                for i in range(len(w) + 3 - n):
                    total += model.likelihood[:, row(f"^{w}$"[i:i + n], i == 0, i + n == len(w) + 2)]
        fits = model.scripts[:, lang_id.SCRIPT_NAMES.index(lang_id.script(words[0][0]))]
        if fits.any():
            total = total / len(lang_id.GRAM_SIZES)
            total = np.where(fits, np.maximum(total - total[fits].max(), -lang_id.MOST_AGAINST), lang_id.UNFIT)
        else:
            total = np.zeros(len(total))
        out.append((sum(map(str.isalpha, "".join(words))), bool(fits.any()), total))
    return out


TOKENS = ["Haus", "x²y", "jean-paul's", "дом", "日本語のtext", "क़नमस्ते", "l'été", "e\u0301te\u0301", "\u0301", "12", "İstanbul",
          "кот-cat-дог", "aб", "¿qué?", "a\u0301б\u0301", "", "Straße,und"]


def test_scores_equal_a_plain_sum(model):
    got = model.score(TOKENS)
    want = [(i, *u) for i, t in enumerate(TOKENS) for u in plain_units(model, t)]
    assert got.token.tolist() == [w[0] for w in want]
    assert got.letters.tolist() == [w[1] for w in want] and got.fit.tolist() == [w[2] for w in want]
    assert np.allclose(got.scores, [w[3] for w in want], atol=1e-4)


def test_rounds_of_tokens_agree(model, monkeypatch):
    whole = model.score(TOKENS * 3)
    monkeypatch.setattr(lang_id, "ROUND_CELLS", 200)
    for a, b in zip(whole, model.score(TOKENS * 3)):
        assert (a == b).all()


def test_tokens_are_cut_at_scripts_and_long_runs(model):
    u = model.score(["ab-дом!x", "q" * 150, "日本語のtext", ","])
    cuts = list(zip(u.token.tolist(), u.start.tolist(), u.end.tolist()))
    assert cuts == [(0, 0, 3), (0, 3, 7), (0, 7, 8), (1, 0, 64), (1, 64, 128), (1, 128, 150),
                    (2, 0, 3), (2, 3, 4), (2, 4, 8)]


def test_labels_of_texts_together_equal_single_paths():
    rng = np.random.default_rng(8)
    sizes = rng.integers(1, 60, 200)
    text = np.repeat(np.arange(200) * 2, sizes)  # texts without a unit between
    scores = -rng.exponential(2.5, (len(text), 3))
    scores[np.arange(len(text)), rng.integers(0, 3, 200)[text // 2]] = 0  # one main label each
    scores[rng.random(len(text)) < 0.02] = (lang_id.UNFIT, 0, 0)
    got = lang_id.label_units(text, scores)

    def worth(labels, s):
        return s[np.arange(len(s)), labels].sum() - lang_id.SWITCH * np.count_nonzero(np.diff(labels))
    for t in np.unique(text):
        mine = text == t
        assert worth(got[mine], scores[mine]) == pytest.approx(worth(lang_id.best_path(scores[mine]), scores[mine]))


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, "это русский текст про дом и сад", "ru") for i in range(20)] + [
        (50 + i, "this is an english text about house and garden", "en") for i in range(20)]
    m = lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    s = m.score(["дом", "zzz", "日本"])
    assert s.scores[0].tolist() == [lang_id.UNFIT, 0] and m.langs == ("en", "ru")  # left out, not only disliked
    assert s.scores[1].tolist() == [0, lang_id.UNFIT]
    assert (s.scores[2] == 0).all() and s.fit.tolist() == [True, True, False]  # nobody's script: no preference
    texts = [(1, "日本語"), (2, "²½"), (3, "the house 日本 and garden"), (4, "the дом garden")]
    got = {r.doc_id: r for r in predict(spark.createDataFrame(texts, "doc_id long, text string"), m).collect()}
    assert (got[1].lang, got[1].score, [s.lang for s in got[1].spans]) == ("en", 0.0, ["und"])
    assert (got[2].lang, got[2].score, got[2].spans) == ("und", 0.0, [])
    assert [(s.lang, s.start, s.end, s.letters) for s in got[3].spans] == [
        ("en", 0, 9, 8), ("und", 10, 12, 2), ("en", 13, 23, 9)]
    assert got[3].lang == "en" and got[3].score == pytest.approx(17 / 19)
    assert [s.lang for s in got[4].spans] == ["en", "ru", "en"]


def test_every_language_of_the_sample_is_learned(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)} " * 5, f"l{i:03}") for i in range(300)]
    m = lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(m.langs) == 300


def test_odd_documents(spark, odd, model):
    got = {r.doc_id: r for r in predict(odd, model).collect()}
    for d in (1, 2, 3, 14):
        assert (got[d].lang, got[d].score, got[d].spans) == ("und", 0.0, [])
    assert (got[12].score, {s.lang for s in got[12].spans}) == (0.0, {"und"})  # a script of no language
    assert all(0 < r.score <= 1 and r.lang in model.langs for d, r in got.items() if d not in (1, 2, 3, 12, 14))
    assert predict(odd, model).count() == odd.count()


def test_empty(spark, empty, odd, model):
    assert predict(empty, model).count() == 0
    nothing = lang_id.learn(empty)
    assert {(r.lang, r.score) for r in predict(odd, nothing).collect()} == {("und", 0.0)}
