"""Personal data in plain and in disguised form, with offsets in the given text.

*Plain* identifiers are found by fixed patterns.  For the disguised ones a
cascade of small transducers rewrites the text: homoglyphs and invisible
characters, letters that stand for digits, spelled-out digits, and at/dot
disguises.  Each one yields a text and the edits that led to it; the same
patterns run over the last text, and what they find is carried back through
the edits to the source's code points.  A rewritten finding is added unless it
lies within a plain one of its kind; plain findings always stay.

Defined results: a null text is an empty one; the empty text has no findings;
repeated rows are judged alike; an empty table gives an empty result; extra
columns are not read."""

from __future__ import annotations

import bisect
import functools
import re
import unicodedata
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.common import documents
from stayline.llm.registry import register

KINDS = ("email", "ip", "card", "phone")

# ---------------------------------------------------------------- plain form

# A look-behind starts a match only where a run does; the matches are those of
# the plain patterns, without trying every later start in a long run.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterable[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        start = at = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            done = m.end()


def ips(text: str) -> Iterable[tuple[int, int]]:
    for m in _IP.finditer(text):
        # Leading zeros may make a part long without making it large.
        if all(int(p[-12:]) <= 255 and not p[:-12].strip("0") for p in m.group().split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> Iterable[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterable[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def plain(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    out += [("ip", s, e) for s, e in ips(text)]
    out += [("card", s, e) for s, e in cards(text)]
    if "+" in text:
        out += [("phone", s, e) for s, e in phones(text)]
    return out


# ---------------------------------------------------------------- transducers

Edit = tuple[int, int, str]  # start, end, what stands there instead

#: Letters of other scripts that look like Latin ones: fixed values.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g",
}
#: Signs that look like ASCII ones, and invisible characters: fixed values.
SIGNS = {
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹣": "-", "․": ".", "。": ".", "｡": ".", "﹒": ".",
    "﹫": "@", "⁺": "+", "﹢": "+", " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
    "­": "", "​": "", "‌": "", "‍": "", "⁠": "", "﻿": "",
}
#: Words for the digits 0 to 9: fixed values.
SPELLED = (
    ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
    ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
)
AT_WORDS = r"(?:at|arroba|arobase|ät)"
DOT_WORDS = r"(?:dot|punkt|point|punto)"
#: Words before which "at" is plain prose.
ARTICLES = r"(?:the|a|an|this|that|his|her|our|their)"
#: Spelled digits in a row that count as a number.
LEAST_SPELLED = 3


@functools.cache
def _glyphs() -> tuple[dict[str, str], re.Pattern]:
    table = dict(LOOKALIKES) | SIGNS
    # Full-width forms, mathematical letters and circled digits are compatibility forms of one ASCII character.
    for c in [*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x2460, 0x24EB)]:
        to = unicodedata.normalize("NFKC", chr(c))
        if len(to) == 1 and "!" <= to <= "~":
            table[chr(c)] = to
    for c in range(0x80, 0x20000):
        d = unicodedata.decimal(chr(c), None)
        if d is not None:
            table.setdefault(chr(c), str(d))
    return table, re.compile("[" + "".join(map(re.escape, sorted(table))) + "]")


def fold_glyphs(text: str) -> list[Edit]:
    if text.isascii():
        return []
    table, pattern = _glyphs()
    if table.keys().isdisjoint(text):
        return []
    return [(m.start(), m.end(), table[m.group()]) for m in pattern.finditer(text)]


_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl]+(?=[. -]?[0-9])|(?<=[0-9][. -])[OoIl]+(?=[0-9])")
# Groups of digits and such letters that are whole words, and their separators.
_DIGIT_GROUP = r"(?<![^\W_])[0-9OoIl]++(?![^\W_])"
_DIGIT_GROUPS = re.compile(rf"\+?{_DIGIT_GROUP}(?:[ .()-]{{1,3}}{_DIGIT_GROUP})*+")
_GROUP = re.compile(r"[0-9OoIl]+")
_AS_DIGITS = str.maketrans("OoIl", "0011")


def fold_letter_digits(text: str) -> list[Edit]:
    """Letters among digits, and those at either end of a group that has digits;
    a group of letters alone, which may be a word, only where a pattern needs it."""
    out = {i for m in _LETTER_DIGIT.finditer(text) for i in range(*m.span())}
    for m in _DIGIT_GROUPS.finditer(text):
        s = m.group()
        if not _DIGIT.search(s) or not any(c in s for c in "OoIl"):
            continue
        some = _GROUP.sub(lambda g: g.group().translate(_AS_DIGITS) if _DIGIT.search(g.group()) else g.group(), s)
        to = some if plain(some) else s.translate(_AS_DIGITS)
        if to != some and not plain(to):
            to = some
        out |= {m.start() + k for k in range(len(s)) if s[k] != to[k]}
    return [(i, i + 1, text[i].translate(_AS_DIGITS)) for i in sorted(out)]


_VALUES = {w: str(i) for words in SPELLED for i, w in enumerate(words)}
_WORD = "(?:" + "|".join(sorted(_VALUES, key=lambda w: (-len(w), w))) + r")(?![^\W_])"
_GAP = rf"(?:[ ,-]{{1,3}}|[ ]+{DOT_WORDS}[ ]+|[ -]?[()][ -]?|\.)"
_RUN = re.compile(rf"(?:(?<![^\W_]){_WORD}|(?<![0-9])[0-9]++)(?:{_GAP}(?:{_WORD}|[0-9]++))+")
_RUN_PART = re.compile(rf"(?P<word>{_WORD})|(?P<digits>[0-9]+)|(?P<dot>{DOT_WORDS})|(?P<point>\.)|(?P<mark>[,()])")
_PLUS = re.compile(r"(?:(?<![^\W_])plus[ ]+|\+)$")
#: Stands beside a rewritten number, so that it does not run on into its neighbours.
_GUARD = "\0"


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class _Run:
    """The digit groups of a run: value, place, whether spelled, and the gap before each."""

    def __init__(self, text: str, start: int):
        self.value, self.span, self.word, self.gap, gap = [], [], [], [], ""
        for p in _RUN_PART.finditer(text):
            if p.lastgroup in ("word", "digits"):
                self.value.append(_VALUES.get(p.group(), p.group()))
                self.span.append((start + p.start(), start + p.end()))
                self.word.append(p.lastgroup == "word")
                self.gap.append(gap)
                gap = ""
            else:
                gap = p.lastgroup if p.lastgroup != "mark" else p.group()

    def odd(self, i: int, j: int) -> bool:
        """Whether anything from group ``i`` to before ``j`` is disguised."""
        return any(self.word[i:j]) or "dot" in self.gap[i + 1:j]

    def phone(self, i: int) -> int:
        n, best = 0, 0
        for j in range(i, len(self.value)):
            n += len(self.value[j])
            if n > 15:
                break
            best = j + 1 if n >= 9 else best
        return best

    def ip(self, i: int) -> int:
        j = i
        for part in range(4):
            number, spelled = "", j < len(self.value) and self.word[j]
            while j < len(self.value) and (not number or self.gap[j] in ("", ",")):
                # The last part ends with its digits; a spelled one goes on as far as it fits.
                if number and part == 3 and (not spelled or int(number + self.value[j][-12:]) > 255):
                    break
                number += self.value[j]
                if len(number) > 12 or int(number) > 255:
                    return 0
                j += 1
            if not number or part < 3 and (j >= len(self.value) or self.gap[j] not in ("dot", "point")):
                return 0
        return j

    def card(self, i: int) -> int:
        """As far as a card goes that begins and ends where a number may."""
        if not self.edge(i):
            return 0
        digits, best = "", 0
        for j in range(i, len(self.value)):
            if j > i and self.gap[j] not in ("", ","):
                break
            digits += self.value[j]
            if len(digits) > 19:
                break
            if len(digits) >= 13 and self.edge(j + 1) and luhn(digits):
                best = j + 1
                if not self.odd(i, best):
                    break
        return best

    def edge(self, i: int) -> bool:
        return i in (0, len(self.value)) or self.gap[i] != "" or self.word[i] != self.word[i - 1]

    def text(self, i: int, j: int, phone: bool = False) -> str:
        return "".join(("." * (k > i and not phone and self.gap[k] in ("dot", "point"))) + self.value[k] for k in range(i, j))


def fold_spelled(text: str) -> list[Edit]:
    low, out = _lower(text), []
    for m in _RUN.finditer(low):
        r = _Run(m.group(), m.start())
        n = len(r.value)
        if not r.odd(0, n):
            continue
        plus = _PLUS.search(low, max(0, m.start() - 12), m.start())
        i = done = 0

        def rest(a: int, b: int) -> None:
            """A stretch that no pattern holds over may still be part of one; from its first spelled digit on."""
            while a < b and not r.word[a]:
                a += 1
            if sum(r.word[a:b]) >= LEAST_SPELLED:
                spoken = plus if a == 0 and plus and plus.group() != "+" else None
                start = spoken.start() if spoken else r.span[a][0]
                out.append((start, r.span[b - 1][1], "+" * bool(spoken) + r.text(a, b)))
        while i < n:
            phone = r.phone(0) if i == 0 and plus else 0
            j = phone or r.ip(i) or r.card(i)
            if not j:
                i += 1
                continue
            said = bool(phone and plus.group() != "+")
            if said or r.odd(i, j):
                rest(done, i)
                start = plus.start() if phone else r.span[i][0]
                out.append((start, r.span[j - 1][1], _GUARD + "+" * bool(phone) + r.text(i, j, bool(phone)) + _GUARD))
                done = j
            i = j
        rest(done, n)
    return out


_BRACKETED = re.compile(
    rf"\s{{0,3}}(?:\[\s?(?P<a>{AT_WORDS}|@|{DOT_WORDS}|\.)\s?\]|\(\s?(?P<b>{AT_WORDS}|@|{DOT_WORDS}|\.)\s?\)"
    rf"|\{{\s?(?P<c>{AT_WORDS}|@|{DOT_WORDS}|\.)\s?\}}|<\s?(?P<d>{AT_WORDS}|@|{DOT_WORDS}|\.)\s?>"
    rf"|(?P<q>[_*~|])(?P<e>{AT_WORDS}|{DOT_WORDS})(?P=q))\s{{0,3}}", re.I)
_MAY_BRACKET = re.compile(r"[\[({<_*~|]\s?[@.adpAÄäDP]")


def fold_bracketed(text: str) -> list[Edit]:
    """``name [at] host (dot) net`` and the like, between symbols of an address."""
    if not _MAY_BRACKET.search(text):
        return []
    out = []
    for m in _BRACKETED.finditer(text):
        inner = next(m.group(g) for g in "abcde" if m.group(g)).lower()
        before, after = text[:m.start()][-1:], text[m.end():m.end() + 1]
        # Both sides must go on with a symbol of an address or with another disguise.
        if before and after and (before in _LOCAL or before in "])}>_*~|") and (after in _LOCAL or after in "[({<_*~|"):
            out.append((m.start(), m.end(), "@" if inner == "@" or re.fullmatch(AT_WORDS, inner) else "."))
    return out


_NAME = r"[A-Za-z0-9_%+-]+"
_HOST_DOTS = rf"(?:(?:[ ]{{1,3}}(?:\.|{DOT_WORDS})[ ]{{1,3}}|\.)[A-Za-z0-9-]+)"
_SPOKEN = re.compile(
    rf"(?<![A-Za-z0-9._%+-]){_NAME}(?:(?:[ ]{{1,3}}{DOT_WORDS}[ ]{{1,3}}|\.){_NAME}){{0,4}}"
    rf"(?P<at>[ ]{{1,3}}{AT_WORDS}[ ]{{1,3}}(?!{ARTICLES}[ ])|[ ]{{0,3}}@[ ]{{0,3}})[A-Za-z0-9-]+{_HOST_DOTS}{{1,5}}(?![A-Za-z0-9-])", re.I)
_SPOKEN_DOT = re.compile(rf"[ ]{{1,3}}(?:\.|{DOT_WORDS})[ ]{{1,3}}", re.I)
_MAY_SPEAK = re.compile(rf" (?:\.|{DOT_WORDS}) |@ | @", re.I)


def fold_spoken(text: str) -> list[Edit]:
    """``name at host dot net`` and ``name @ host . net``.  An ``at`` in words
    counts only with a spoken or spaced dot behind it, as plain prose has it too."""
    if not _MAY_SPEAK.search(text):
        return []
    out = []
    for m in _SPOKEN.finditer(text):
        host = m.end("at")
        dots = [d.span() for d in _SPOKEN_DOT.finditer(text, m.start(), m.end()) if not m.start("at") <= d.start() < host]
        if "@" not in m.group("at") and not any(s >= host for s, _ in dots):
            continue
        out += [(s, e, ".") for s, e in dots] + [(m.start("at"), host, "@")] * (m.group("at") != "@")
    return sorted(out)


TRANSDUCERS: tuple[Callable[[str], list[Edit]], ...] = (
    fold_glyphs, fold_letter_digits, fold_spelled, fold_bracketed, fold_spoken)


class Rewritten:
    """A text after non-overlapping, ordered edits, with the way back."""

    def __init__(self, text: str, edits: list[Edit]):
        self.edits, parts, at, size = edits, [], 0, 0
        self.starts, self.ends = [], []  # of each edit in the new text
        for s, e, to in edits:
            parts += [text[at:s], to]
            size += s - at
            self.starts.append(size)
            size += len(to)
            self.ends.append(size)
            at = e
        self.text = "".join([*parts, text[at:]])

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The span of the old text that a span of the new one stems from."""
        return self._one(start, False), self._one(end, True)

    def _one(self, i: int, is_end: bool) -> int:
        # The last edit that begins before this place.
        k = (bisect.bisect_left(self.starts, i) if is_end else bisect.bisect_right(self.starts, i)) - 1
        if k < 0:
            return i
        s, e, _ = self.edits[k]
        if i < self.ends[k] or (is_end and i <= self.ends[k]):
            return e if is_end else s
        return e + i - self.ends[k]


def disguised(text: str) -> list[tuple[str, int, int]]:
    """What the patterns find after the transducers, as spans of ``text``."""
    steps, now = [], text
    for t in TRANSDUCERS:
        edits = t(now)
        if edits:
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    out = []
    for kind, s, e in plain(now) if steps else ():
        for step in reversed(steps):
            s, e = step.back(s, e)
        out.append((kind, s, e))
    return out


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(plain findings, added ones), each by kind as listed and start."""
    base = plain(text)
    within = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    added = [x for x in dict.fromkeys(disguised(text)) if not any(s <= x[1] and x[2] <= e for s, e in within[x[0]])]
    return base, sorted(added, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


# ---------------------------------------------------------------- on tables

_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def detect(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``base`` and ``added``: arrays of (kind, start, end)."""
    span = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
    schema = T.StructType([f for f in df.schema.fields if f.name != text]).add("base", span).add("added", span)

    def spans(found):
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in found], _SPANS)

    def run(batches):
        for b in batches:
            keep = [k for k, n in enumerate(b.schema.names) if n != text]
            found = [find(t or "") for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in keep], spans([f[0] for f in found]), spans([f[1] for f in found])],
                [*[b.schema.names[k] for k in keep], "base", "added"])
    return df.mapInArrow(run, schema)


def joined(spans):
    """``kind:start:end`` of an array of spans, by kind as listed and then start, joined by commas."""
    order = F.array(*[F.lit(k) for k in KINDS])
    by = F.array_sort(F.transform(spans, lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("k"), s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("n"))))
    return F.array_join(F.transform(by, lambda s: F.concat_ws(":", s["n"], s["s"], s["e"])), ",")


@register("op2_pii")
def op2_pii(spark, sf_dir: str) -> DataFrame:
    """The counts are those of the plain findings; ``n_added`` counts the disguised ones."""
    d = detect(documents(spark, sf_dir).select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return d.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                    joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
