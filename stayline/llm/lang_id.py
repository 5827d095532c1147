"""Language spans of mixed-language text.

A model of each language is learned from labelled documents: smoothed
log-likelihoods of character n-grams, and the scripts it is written in.  A
text's tokens (cut at ASCII white space, at changes of script and, where a run
of letters is longer, every ``STRETCH`` letters) get a score per language.
Script ranges narrow the candidates first: where a language is written in a
token's script, those that are not are left out.  Viterbi then labels the
tokens, paying ``SWITCH`` for every change of language, and runs of one label
are the spans.  Letters in a script of no language are spans of ``und``.

A text's language is the learned one with the most letters in its spans; the
score is its share of all letters, those of ``und`` included.

Learning takes a bounded sample of labelled rows: about ``SAMPLE_DOCS``
documents, dealt evenly to the languages by a hash of the id, with their whole
texts and all n-grams in them.  (So many documents hold at most that many
languages.)

Letters are what Python calls alphabetic, and words take in the combining
marks behind a letter; numerals like superscripts are no letters.

Defined results: a null text is an empty one; a text without a letter has no
spans, language ``und`` and score 0, as any text has where nothing could be
learned; a text in foreign scripts alone gets the first language and score 0;
ties go to the language first in code-point order; repeated rows are judged
alike; an empty table gives an empty result; extra columns are not read."""

from __future__ import annotations

import bisect
import functools
import unicodedata
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import documents
from stayline.llm.pieces import rounds, spaced
from stayline.llm.registry import register

UNKNOWN = "und"
SAMPLE_DOCS = 20_000
GRAM_SIZES = (2, 3, 4)
#: Cost of a change of language, and the most by which a token can speak against a language of its script, in nats.
SWITCH = 12.0
MOST_AGAINST = 8.0
#: Score of a language that a token's script leaves out: more than any changes can cost.
UNFIT = -1000.0
#: Share of a language's letters that makes a script one of its own.
SCRIPT_SHARE = 0.05
#: Letters of a run that are scored together.
STRETCH = 64
#: Numbers (characters by languages) that are worked on at once.
ROUND_CELLS = 16_000_000

#: First code point of each stretch of a script: fixed values.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xA640, "cyrillic"),
    (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
)
_SCRIPT_STARTS = [c for c, _ in SCRIPTS]
SCRIPT_NAMES = sorted({x for _, x in SCRIPTS})
#: No letter or mark of a word is assigned beyond, but for variation selectors.
_CODES = 0x40000


def script(c: str) -> str:
    return SCRIPTS[bisect.bisect_right(_SCRIPT_STARTS, ord(c)) - 1][1]


def is_mark(c: str) -> bool:
    return unicodedata.category(c)[0] == "M"


def runs(token: str) -> list[str]:
    """Words of a token, in lower case: letters of one script with the marks on them, at most ``STRETCH`` each."""
    out, of = [], None
    for c in token:
        if c.isalpha():
            if script(c) != of or len(out[-1]) == STRETCH:
                out.append("")
            of = script(c)
        elif of is None or not is_mark(c):
            of = None
            continue
        elif len(out[-1]) == STRETCH:
            out.append("")
        out[-1] += c.lower()[0]
    return out


def grams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i:i + n] for n in GRAM_SIZES for i in range(len(w) - n + 1)]


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: 1 for a letter and 2 for a mark, the script's place among the names, the lower-case letter."""
    chars = [chr(c) for c in range(_CODES)]
    kind = np.zeros(0x110000, np.uint8)
    kind[:_CODES] = [1 if c.isalpha() else 2 * is_mark(c) for c in chars]
    lower = np.arange(0x110000, dtype=np.uint32)
    lower[:_CODES] = [ord(c.lower()[0]) for c in chars]
    of = np.searchsorted(_SCRIPT_STARTS, np.arange(0x110000), "right") - 1
    return kind, np.array([SCRIPT_NAMES.index(x) for _, x in SCRIPTS], np.uint8)[of], lower


class Units(NamedTuple):
    """What is labelled: a token, or the parts of one where its script changes or a run is long."""
    token: np.ndarray  # place of its token
    start: np.ndarray  # in the token
    end: np.ndarray
    letters: np.ndarray
    fit: np.ndarray  # whether any language is written in its script
    scores: np.ndarray  # a column per language, 0 for the best one


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    symbols: np.ndarray  # by code point: 0 unseen, 1 before and 2 behind a word, then the letters
    keys: tuple[np.ndarray, ...]  # by gram size: the known grams' symbols as one number
    rows: tuple[np.ndarray, ...]  # their places in ``likelihood``
    likelihood: np.ndarray  # log-likelihoods, a row per language; the last column is that of an unseen gram
    scripts: np.ndarray  # language by script name: whether it is written in it

    def score(self, tokens: list[str]) -> Units:
        """The units of tokens without white space, in order."""
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        # A token is about as many grams of each size as letters.
        cells = np.cumsum(sizes + 1) * (len(self.langs) + 12) // ROUND_CELLS
        cut = np.flatnonzero(np.diff(cells, prepend=-1))
        parts = []
        for i, j in zip(cut, [*cut[1:], len(tokens)], strict=True):
            u = self._score(tokens[i:j], sizes[i:j])
            parts.append(u._replace(token=u.token + i))
        return Units(*map(np.concatenate, zip(*parts, strict=True))) if parts else self._score([], sizes)

    def _score(self, tokens: list[str], sizes: np.ndarray) -> Units:
        kinds, script_of, lower = _tables()
        codes = np.frombuffer("".join([t + "\n" for t in tokens]).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.arange(len(codes))
        kind = kinds[codes]
        letter = kind == 1
        last_letter = np.maximum.accumulate(np.where(letter, at, -1))
        last_other = np.maximum.accumulate(np.where(kind == 0, at, -1))
        inside = (kind > 0) & (last_letter > last_other)
        of = script_of[codes[np.maximum(last_letter, 0)]]  # a mark is of its letter's script
        run = inside.copy()
        run[1:] &= ~inside[:-1] | (of[1:] != of[:-1])
        run_start = np.maximum.accumulate(np.where(run, at, 0))
        begins = np.flatnonzero(inside & ((at - run_start) % STRETCH == 0))  # of words
        word = np.cumsum(np.bincount(begins, minlength=len(codes)))[inside] - 1

        token_ends = np.cumsum(sizes + 1)
        token = np.searchsorted(token_ends, begins, "right")
        word_script = of[begins]
        new = ~run[begins]  # a further stretch of a run
        new[1:] |= (token[1:] != token[:-1]) | (word_script[1:] != word_script[:-1])
        new[:1] = True
        unit = np.cumsum(new) - 1  # by word
        n = int(new.sum())
        of_token = token[new]
        start = begins[new] - (token_ends - sizes - 1)[of_token]
        first = np.diff(of_token, prepend=-1) != 0
        start[first] = 0
        end = sizes[of_token]
        inner = np.flatnonzero(~first)
        end[inner - 1] = start[inner]
        letters = np.bincount(unit[word], weights=letter[inside], minlength=n).astype(np.int64)

        fits = self.scripts[:, word_script[new]].T
        fit = fits.any(axis=1)
        scores = self._likelihoods(lower[codes[inside]], word, unit, n)
        scores[~fits & fit[:, None]] = -np.inf
        scores[~fit] = 0
        scores = scores - scores.max(axis=1, keepdims=True) if len(self.langs) else scores
        scores = np.where(np.isneginf(scores), UNFIT, np.maximum(scores, -MOST_AGAINST))
        return Units(of_token, start, end, letters, fit, scores)

    def _likelihoods(self, chars: np.ndarray, word: np.ndarray, unit: np.ndarray, n: int) -> np.ndarray:
        """Sums over the grams of each unit's words.  Grams of several sizes say
        the same thing, so each counts for its share of them."""
        out = np.zeros((n, len(self.langs)))
        size = np.bincount(word, minlength=len(unit)) + 2
        ends = np.cumsum(size)
        around = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
        around[np.arange(len(chars)) + 2 * word + 1] = self.symbols[chars]
        around[ends - size], around[ends - 1] = 1, 2
        left = np.repeat(ends, size) - np.arange(len(around))  # characters of the word from here on
        owner = np.repeat(unit, size)
        for length, keys, rows in zip(GRAM_SIZES, self.keys, self.rows, strict=True):
            some = np.flatnonzero(left >= length)
            found = pc.index_in(pa.array(_keys(around, length, self.symbols)[some]), value_set=pa.array(keys))
            row = np.append(rows, self.likelihood.shape[1] - 1)[pc.fill_null(found, len(rows)).to_numpy()]
            for j, per in enumerate(self.likelihood):
                out[:, j] += np.bincount(owner[some], weights=per[row], minlength=n)
        return out / len(GRAM_SIZES)


def _keys(around: np.ndarray, length: int, symbols: np.ndarray) -> np.ndarray:
    """By place: the ``length`` symbols from there as one number, exact below
    65,536 symbols (beyond it is a hash of 64 bits)."""
    base = np.uint64(max(int(symbols.max()) + 1, 3))
    out = around.copy()
    for k in range(1, length):
        out[:-k] = out[:-k] * base + around[k:]
    return out


def best_path(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Labels with the highest sum of scores less ``switch`` per change.

    If no stretch speaks for another language by more than half a change, one
    label throughout is the best: leaving it costs a change for each stretch
    away, and gains no more than that.  Other texts take the full recursion."""
    n, k = scores.shape
    main = int(scores.sum(0).argmax())
    gain = np.cumsum(scores.astype(np.float64) - scores[:, main:main + 1], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, k)), gain]), axis=0)[:-1]
    if (gain - low).max() <= switch / 2:
        return np.full(n, main)
    rows, came = scores.tolist(), []
    best = rows[0]
    for row in rows[1:]:
        top = max(best)
        at = best.index(top)
        from_ = [at if top - switch > b else j for j, b in enumerate(best)]
        best = [r + max(b, top - switch) for r, b in zip(row, best, strict=True)]
        came.append(from_)
    out = np.empty(n, np.int64)
    out[-1] = label = best.index(max(best))
    for t in range(n - 2, -1, -1):
        label = came[t][label]
        out[t] = label
    return out


def label_units(text: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The label of each unit; ``text`` (ascending) says whose it is.  Texts in
    which one label throughout is the best (see ``best_path``) are found together."""
    first = np.flatnonzero(np.diff(text, prepend=-1))
    size = np.diff(np.append(first, len(text)))
    main = np.repeat(np.add.reduceat(scores, first, axis=0).argmax(axis=1) if len(first) else first, size)
    most = -UNFIT
    out = main.copy()
    mixed = np.zeros(len(first), bool)
    floor = np.repeat(first, size) * most  # a text's sums start below all those of the texts before
    own = scores[np.arange(len(scores)), main]
    for j in range(scores.shape[1]):
        gain = np.clip(scores[:, j] - own, -most, most)
        total = np.cumsum(gain)
        before = total - gain
        before -= np.repeat(before[first], size) + floor
        rise = before + gain - np.minimum.accumulate(before)
        if len(first):
            mixed |= np.maximum.reduceat(rise, first) > SWITCH / 2
    for t in np.flatnonzero(mixed):
        i, j = first[t], first[t] + size[t]
        out[i:j] = best_path(scores[i:j])
    return out


def text_spans(words: pa.ListArray, model: Model) -> pa.ListArray:
    """Spans of texts that are cut at their white space."""
    first = words.offsets.to_numpy().astype(np.int64)
    coded = words.flatten().dictionary_encode()
    at, tokens = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    u = model.score(tokens)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))[at]
    begin = np.cumsum(size + 1) - size - 1  # of each token, over all texts
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # Each token's units, in order.
    count = np.bincount(u.token, minlength=len(tokens))
    copies = count[at]
    place = np.repeat(np.arange(len(at)), copies)
    unit = np.arange(len(place)) - np.repeat(np.cumsum(copies) - copies, copies) + (np.cumsum(count) - count)[at[place]]
    text, begin = text[place], begin[place] - np.append(begin, 0)[first[text[place]]]
    fit = u.fit[unit]
    label = np.full(len(unit), len(model.langs))  # the last one stands for ``und``
    label[fit] = label_units(text[fit], u.scores[unit[fit]])

    new = np.ones(len(unit), bool)
    new[1:] = (text[1:] != text[:-1]) | (label[1:] != label[:-1])
    cut = np.flatnonzero(new)
    last = np.append(cut, len(unit))[1:] - 1
    letters = np.add.reduceat(u.letters[unit], cut) if len(cut) else cut
    names = pa.array([*model.langs, UNKNOWN]).take(pa.array(label[cut]))
    of_text = np.bincount(text[cut], minlength=len(first) - 1)
    spans = pa.StructArray.from_arrays(
        [names, pa.array(begin[cut] + u.start[unit[cut]]), pa.array(begin[last] + u.end[unit[last]]), pa.array(letters)],
        ["lang", "start", "end", "letters"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(of_text)).astype(np.int32)), spans)


# ---------------------------------------------------------------- learning

def sample(labelled: DataFrame, docs: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text) of about ``docs`` documents of ``labelled`` (doc_id, text, lang), dealt evenly to the languages."""
    n = (labelled.filter("lang IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
         .orderBy(F.desc("n"), "lang").limit(docs))  # each needs a document
    share = n.select(F.col("lang").alias("__lang"), (F.lit(docs) / F.count(F.lit(1)).over(
        Window.partitionBy(F.lit(0))) / F.col("n")).alias("__share"))  # at most docs rows
    d = labelled.select("doc_id", "text", "lang").join(F.broadcast(share), F.col("lang") == F.col("__lang"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return d.filter(place < F.col("__share")).select("lang", "text")


def count_grams(sampled: DataFrame) -> DataFrame:
    """(lang, gram, n) of the sample; one character's grams count its letters."""
    spaced = F.translate(F.coalesce("text", F.lit("")), "\t\n\u000b\f\r", "     ")
    words = (sampled.select("lang", F.explode(F.split(spaced, " ")).alias("token"))
             .groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n")))

    def run(batches):
        for b in batches:
            found: dict[tuple[str, str], int] = {}
            for lang, token, n in zip(*(b.column(c).to_pylist() for c in ("lang", "token", "n")), strict=True):
                for w in runs(token):
                    for g in [*grams(w), *filter(str.isalpha, w)]:
                        found[lang, g] = found.get((lang, g), 0) + n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())], ["lang", "gram", "n"])
    return words.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(labelled: DataFrame, docs: int = SAMPLE_DOCS) -> Model:
    rows = count_grams(sample(labelled, docs)).toPandas()  # grams of a bounded sample
    langs = tuple(sorted(rows["lang"].unique()))
    lang = np.searchsorted(np.array(langs, object), rows["lang"].to_numpy()) if langs else np.zeros(0, np.int64)
    n, size = rows["n"].to_numpy(np.int64), rows["gram"].str.len().to_numpy(np.int64)

    letters = np.zeros((len(langs), len(SCRIPT_NAMES)))
    symbols = np.zeros(0x110000, np.uint32)
    ones = size == 1
    np.add.at(letters, (lang[ones], [SCRIPT_NAMES.index(script(c)) for c in rows["gram"][ones]]), n[ones])
    chars = sorted(set("".join(rows["gram"][size == 3])) - set("^$"))  # with the marks; of every word
    symbols[[ord(c) for c in chars]] = np.arange(3, 3 + len(chars))

    keys, places, counts, known = [], [], [], 0
    for length in GRAM_SIZES:
        some = np.flatnonzero(size == length)
        codes = np.frombuffer("".join(rows["gram"].to_numpy()[some]).encode("utf-32-le"), np.uint32)
        around = symbols[codes].astype(np.uint64)
        around[codes == ord("^")], around[codes == ord("$")] = 1, 2
        key, place = np.unique(_keys(around, length, symbols)[::length], return_inverse=True)
        per = np.zeros((len(langs), len(key)))
        np.add.at(per, (lang[some], place), n[some])
        keys.append(key)
        places.append(known + np.arange(len(key)))
        counts.append(per)
        known += len(key)
    seen = np.concatenate([*counts, np.zeros((len(langs), 1))], axis=1) + 0.5  # the last one: any gram not seen
    return Model(langs, symbols, tuple(keys), tuple(places), np.log(seen / seen.sum(axis=1, keepdims=True)).astype(np.float32),
                 letters >= np.maximum(SCRIPT_SHARE * letters.sum(axis=1, keepdims=True), 1))


# ---------------------------------------------------------------- labelling

def label_spans(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``spans``: array of (lang, start, end,
    letters), offsets in code points, end exclusive, in order."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([f for f in df.schema.fields if f.name != text]).add("spans", T.ArrayType(
        T.StructType().add("lang", "string").add("start", "long").add("end", "long").add("letters", "long")))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("letters", pa.int64())]))

    def run(batches):
        m = shared.value
        for b in batches:
            keep = [k for k, n in enumerate(b.schema.names) if n != text]
            texts = b.column(text).to_pylist()
            for i, j in rounds(texts):
                if m.langs:
                    found = text_spans(pc.split_pattern(pa.array(list(map(spaced, texts[i:j])), pa.large_string()), " "), m)
                else:
                    found = pa.array([[]] * (j - i), kind)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(k).slice(i, j - i) for k in keep], found.cast(kind)],
                    [*[b.schema.names[k] for k in keep], "spans"])
    return df.mapInArrow(run, schema)


def language_of(spans: Column, langs: tuple[str, ...]) -> tuple[Column, Column]:
    """(language, score) of a text from its spans."""
    def letters(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda a, s: a + s["letters"])
    per = F.transform(F.array(*[F.lit(x) for x in langs]) if langs else F.array().cast("array<string>"),
                      lambda l: F.struct(letters(F.filter(spans, lambda s: s["lang"] == l)).alias("n"), l.alias("l")))
    # The first of the languages with the most letters; spans of ``und`` count to all letters only.
    best = F.aggregate(per, F.struct(F.lit(-1).cast("long").alias("n"), F.lit(UNKNOWN).alias("l")),
                       lambda a, x: F.when(x["n"] > a["n"], x).otherwise(a))
    return (F.when(letters(spans) > 0, best["l"]).otherwise(UNKNOWN),
            F.coalesce(best["n"] / F.nullif(letters(spans), F.lit(0).cast("long")), F.lit(0.0)))


def is_held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


@register("op1_language_id")
def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    m = learn(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    d = label_spans(docs.select("doc_id", "text"), m)
    lang, score = language_of(F.col("spans"), m.langs)
    return d.select("doc_id", is_held_out().alias("held_out"), lang.alias("lang_pred"), score.alias("score"),
                    F.size("spans").cast("long").alias("n_spans"))
