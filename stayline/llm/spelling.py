"""Spelling variants: words at edit distance one, grouped under the commonest form.

Method: pivotal grams.  The bigrams of all words are ordered by how many words
hold them, rarest first, and of equal ones by position.  A word's *gram
prefix* is its three first bigrams in that order; its two *pivots* are the
disjoint pair of them that is rarest in sum, found by dynamic programming over
positions.  One edit spoils at most one of two disjoint pivots, so of two near
words the one whose prefix ends first has a pivot that stands in the other's
gram prefix, shifted by at most the difference in length.  Everything on the pivot's far side of the edit is then
equal too:

* an edit before the second pivot leaves the word from that pivot on;
* any other edit leaves the word up to the end of the first pivot.

That equal side is part of the index key, which makes the position limit exact,
and so is the half of the rest that the edit spares (the rest is cut in two at
the indexed word's middle).  Candidates are verified by edit distance.  The
join is on hashes of those keys, with at most 12 probes and 16 index rows a
word; no list of a single bigram is ever met.

Defined results: null texts count as empty, a null doc_id as the empty string
in the checksum; empty and blank texts have no words; a text of any length is
read whole; repeated rows count again; ties for the largest near word go to the
smallest in code-point order; an empty table gives an empty result; extra
columns are not read."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import documents
from stayline.llm.registry import register
from stayline.session import materialize

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One word in so many of a document loses a character before counting (0: none).
DELETE_ONE_IN = 97
#: Distinct words that one task counts before it passes them on.
HELD_WORDS = 300_000
SHORT_WORD = 100
GRAM_PREFIX = 3  # bigrams x edits + 1

#: Latin-1 bytes: letters stay, A-Z in lower case, everything else separates.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _count(counts: Counter, doc_id, text: str, delete_one_in: int) -> None:
    """Add the words of one text.  Characters beyond U+00FF are no letters, so
    the text is cut as Latin-1, one byte for each code point."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for w, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        if len(w) >= LEAST_LENGTH:
            if delete_one_in:
                h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), head)
                if h % delete_one_in == 0:
                    p = h % len(w)
                    w = w[:p] + w[p + 1:]
                    if len(w) < LEAST_LENGTH:
                        continue
            counts[w] += n


def word_counts(docs: DataFrame, least: int = LEAST_COUNT, delete_one_in: int = DELETE_ONE_IN) -> DataFrame:
    """(word, n) of every word with at least ``least`` occurrences.  A task
    counts up to ``HELD_WORDS`` distinct words at a time before the shuffle."""
    def run(batches):
        counts: Counter = Counter()

        def out():
            words = pa.array([w.decode("latin-1") for w in counts], pa.string())
            b = pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return b
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                if t.is_valid:
                    _count(counts, d, t.as_py(), delete_one_in)
                    if len(counts) >= HELD_WORDS:
                        yield out()
        yield out()
    parts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _grams(word: str) -> list[str]:
    return list(map("".join, zip(word, word[1:])))


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Number of words with each bigram.  Words have 90 letters (a-z and the
    64 from U+00C0), so there are at most 8,100 rows."""
    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                counts.update(set(_grams(w)))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                         ["gram", "n"])
    parts = words.select("word").mapInArrow(run, "gram string, n long")
    return {r[0]: r[1] for r in parts.groupBy("gram").agg(F.sum("n")).collect()}


def gram_prefix(word: str, count: dict[str, int]) -> tuple[list[int], list[int]]:
    """Ascending positions of the rarest bigrams, once as pivots are chosen
    from them and once as the word is indexed by them: with the place next to
    the last one, if it holds the same bigram (as in "aaa"), to which one edit
    may shift it."""
    grams = _grams(word)
    first = heapq.nsmallest(GRAM_PREFIX, range(len(grams)), key=lambda i: (count[grams[i]], grams[i], i))
    shifted = first[-1] + 1
    more = [shifted] if shifted < len(grams) and grams[shifted] == grams[first[-1]] else []
    return sorted(first), sorted(first + more)


def pivots(word: str, prefix: list[int], count: dict[str, int]) -> tuple[int, int]:
    """The two disjoint bigrams of the prefix with the least sum of counts:
    best pair that ends at each bigram, from the best one before it."""
    best, left, k = None, None, 0
    for i in prefix:
        while prefix[k] <= i - 2:
            here = (count[word[prefix[k]:prefix[k] + 2]], prefix[k])
            left = here if left is None or here < left else left
            k += 1
        if left is not None:
            pair = (left[0] + count[word[i:i + 2]], left[1], i)
            best = pair if best is None or pair < best else best
    return best[1], best[2]


def _halves(side: str, shared: str, rest: str, m: int):
    """Keys of ``rest`` against an indexed rest of ``m`` characters, of which
    the edit spares either the first half or the other one."""
    h = m // 2
    if len(rest) >= h:
        yield f"{side}{m}F{shared}|{rest[:h]}"
    if len(rest) >= m - h:
        yield f"{side}{m}L{shared}|{rest[len(rest) - m + h:]}"


def index_keys(word: str, prefix: list[int]) -> list[str]:
    """Keys under which a word is found: for each bigram of its gram prefix,
    the word up to it (A) or from it on (B) and a half of the rest."""
    out = []
    for i in prefix:
        out += _halves("A", word[:i + 2], word[i + 2:], len(word) - i - 2)
        out += _halves("B", word[i:], word[:i], i)
    return out


def probe_keys(word: str, first: int, second: int) -> list[str]:
    """Keys that a word looks up for others of its length and one more or less."""
    out = []
    for d in (-1, 0, 1):
        for side, shared, rest in (("A", word[:first + 2], word[first + 2:]), ("B", word[second:], word[:second])):
            if len(rest) + d >= 0:
                out += _halves(side, shared, rest, len(rest) + d)
    return out


def keyed(words: DataFrame, count: dict[str, int]) -> DataFrame:
    """(word, n, held, asked): each word's index and probe keys."""
    def run(batches):
        for b in batches:
            held, asked = [], []
            for w in b.column(0).to_pylist():
                prefix, indexed = gram_prefix(w, count)
                held.append(index_keys(w, indexed))
                asked.append(probe_keys(w, *pivots(w, prefix, count)))
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(held, kind), pa.array(asked, kind)],
                                             ["word", "n", "held", "asked"])
    return words.select("word", "n").mapInArrow(run, "word string, n long, held array<string>, asked array<string>")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two different words are at edit distance one.  The built-in
    distance takes time with the square of the length even under a limit, so
    long words are compared on either side of their common beginning, which is
    found by halving."""
    n = F.least(F.length(a), F.length(b))
    span = F.struct(F.lit(0).alias("lo"), n.alias("hi"))

    def halve(s, _):
        mid = F.ceil((s["lo"] + s["hi"]) / 2).cast("int")
        same = F.substring(a, 1, mid) == F.substring(b, 1, mid)
        return F.struct(F.when(same, mid).otherwise(s["lo"]).alias("lo"),
                        F.when(same, s["hi"]).otherwise(F.greatest(mid - 1, s["lo"])).alias("hi"))
    at = F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int")), span, halve, lambda s: s["lo"])
    over = F.length(a) - F.length(b)
    long = F.substring(a, at + F.when(over < 0, 1).otherwise(2), F.length(a)) == F.substring(
        b, at + F.when(over > 0, 1).otherwise(2), F.length(b))
    return (a != b) & (F.abs(over) <= 1) & F.when(n <= SHORT_WORD, F.levenshtein(a, b, 1) == 1).otherwise(long)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near): ``near`` is the array of (word, n) at edit distance
    one, for words that have any.  A word of L letters has at most
    90 (2 L + 1) + L near words, which bounds the array."""
    d = materialize(keyed(words, gram_counts(words)), "grams")

    def side(keys: str, name: str) -> DataFrame:
        return d.select(F.struct("word", "n").alias(name), F.explode(keys).alias("k")).select(
            name, F.xxhash64("k").alias("k"))
    a, b = F.col("a"), F.col("b")
    found = side("asked", "a").join(side("held", "b"), "k").filter(
        _one_edit(a["word"], b["word"]))
    both = found.select(F.explode(F.array(F.struct(a.alias("x"), b.alias("y")),
                                          F.struct(b.alias("x"), a.alias("y")))).alias("p"))
    return (both.groupBy(F.col("p.x.word").alias("word"), F.col("p.x.n").alias("n"))
            .agg(F.collect_set("p.y").alias("near")))


def forms(words: DataFrame, near: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word with the largest count
    (the smallest in code-point order of several), if ``ratio`` times the word's own."""
    least = F.array_min(F.transform("near", lambda y: F.struct((-y["n"]).alias("n"), y["word"].alias("word"))))
    d = near.select("word", "n", F.size("near").cast("long").alias("n_near"), least.alias("best"))
    good = -F.col("best.n") >= ratio * F.col("n")
    d = d.select("word", "n_near", F.when(good, F.col("best.word")).alias("form"),
                 F.when(good, -F.col("best.n")).alias("form_n"))
    return words.select("word", "n").join(d, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for the (word, form) rows of ``links``: the last word when
    forms are followed, by pointer doubling.  Counts grow by the ratio at each
    step, so no path returns to a word, and few rounds reach every end."""
    at = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if at.join(on, "root", "left_semi").isEmpty():
            return at
        at = materialize(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def group_variants(docs: DataFrame, least: int = LEAST_COUNT, delete_one_in: int = DELETE_ONE_IN) -> DataFrame:
    """word, n, n_near, form, form_n, root for every counted word of (doc_id, text)."""
    words = materialize(word_counts(docs, least, delete_one_in), "words")
    d = materialize(forms(words, near_words(words)), "forms")
    ends = roots(d.filter("form IS NOT NULL").select("word", "form"))
    return d.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


@register("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return group_variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")
