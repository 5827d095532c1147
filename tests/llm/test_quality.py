import re
from collections import Counter

import pytest

from stayline.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


@pytest.mark.parametrize("name", ["odd", "sample"])
def test_measures_equal_brute_force(request, name):
    docs = request.getfixturevalue(name)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    got = quality.judge(docs).collect()
    assert len(got) == sum(map(len, texts.values()))
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(
            texts[r.doc_id][0]), r.doc_id
        assert not (r.kept and r.base_failed)


def test_thresholds_follow_the_group(spark):
    """A symbol share that is usual for one source is far out in another."""
    plain = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda {}"
    heavy = "alpha# beta# gamma# delta# epsilon# zeta# eta# theta# iota kappa lambda {}"
    rows = [(i, plain.format(i), "en", "prose") for i in range(100)]
    rows += [(200 + i, heavy.format(i), "en", "code") for i in range(100)]
    rows += [(900, heavy.format("x"), "en", "prose")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(d).collect()}
    assert not kept.pop(900) and all(kept.values())


def test_every_fence_rejects_planted_junk_and_keeps_the_rest(spark):
    """Junk of one kind a fence, in groups of their own lengths: all of it goes, no clean document does,
    and each fence's limit differs from group to group."""
    def clean(i, words, lines):
        w = [f"wo{(i * 31 + k * 17) % 97:02d}rd{k}" for k in range(words)]
        return "\n".join(" ".join(w[j::lines]) for j in range(lines))

    rows, junk = [], {}
    for g, (words, lines) in enumerate([(24, 4), (60, 6), (150, 10)]):
        source, at = f"s{g}", 1000 * g
        rows += [(at + i, clean(i, words + i % 7, lines), "en", source) for i in range(120)]
        base = clean(500, words, lines)
        planted = {"symbol_share": base.replace("wo", "#$wo"),
                   "word_length": base.replace("wo", "wo" + "x" * 12),
                   # every line of two words but one comes twice
                   "dup_line_share": "\n".join(f"al{i // 2} be{i // 2}" for i in range(2 * lines)) + f"\nlast {base[:9]}"}
        for k, (name, text) in enumerate(planted.items()):
            rows.append((at + 900 + k, text, "en", source))
            junk[at + 900 + k] = name
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(d).collect()}
    gone = {i for i, r in got.items() if not r.kept and not r.base_failed}
    assert gone == {i for i in junk if not got[i].base_failed}
    for f in quality.FENCES:  # 3 groups
        assert sum(junk.get(i) == f.name for i in gone) == 3
    t = quality.thresholds(quality.sketches(quality.measure(d)))
    for f in quality.FENCES:
        assert t.select(f"{f.name}_hi").distinct().count() == 3


def test_thresholds_of_the_given_documents_differ(sample):
    docs = sample.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet")
    t = quality.thresholds(quality.sketches(quality.measure(docs)), min_group=10)
    for f in quality.FENCES:
        assert t.select(f"{f.name}_hi").distinct().count() > 1, f.name


def test_filter_returns_the_kept_rows_unchanged(odd):
    kept = {r.doc_id for r in quality.judge(odd).filter("kept").collect()}
    out = quality.filter_documents(odd)
    assert out.columns == odd.columns
    assert {r.doc_id for r in out.collect()} == kept and kept


def test_empty(empty):
    assert quality.judge(empty).count() == 0
    assert quality.filter_documents(empty).count() == 0
