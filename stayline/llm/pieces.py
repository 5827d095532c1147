"""Cutting text into the pieces that byte-level BPE encodes one by one.

The rules of the tokenizer files: English contractions, then runs of letters,
of numbers and of other symbols, each with at most one space before it, then
white space (without the last one before a symbol).  They are compiled for
``re`` with explicit Unicode classes; a text in ASCII takes a shorter form of
the same pattern."""

from __future__ import annotations

import functools
import itertools
import re
import sys
import unicodedata
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode White_Space: fixed values.
WHITE_SPACE = ("\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000")
#: A single one behind a word is a piece of its own: the ASCII symbols.
MARKS = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
CONTRACTIONS = r"'(?:[stmd]|re|ve|ll)"

#: Characters of text that one round of work holds, bytes that one of encoding does, and encoded strings that a worker remembers.
ROUND_CHARS = 8_000_000
ENCODE_BYTES = 8_000_000
REMEMBERED = 1_500_000


@functools.cache
def _newer() -> dict[int, str]:
    """Letters and numbers that Python's Unicode tables do not know yet, as the
    tokenizers library classes them."""
    import regex
    from tokenizers.pre_tokenizers import ByteLevel
    whole = ByteLevel(add_prefix_space=False).pre_tokenize_str
    out = {}
    for c in range(0x40000):  # no letter is assigned beyond
        if unicodedata.category(chr(c)) == "Cn" and regex.match(r"[\p{L}\p{N}]", chr(c)):
            for major, known in (("L", "a"), ("N", "1")):
                if len(whole(known + chr(c))) == 1:
                    out[c] = major
    return out


@functools.cache
def _class(major: str) -> str:
    """Ranges of the code points whose general category starts with ``major``."""
    out, start, newer = [], None, _newer()
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and (unicodedata.category(chr(c))[0] == major or newer.get(c) == major)
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


def _pattern(letters: str, numbers: str, space: str) -> re.Pattern:
    return re.compile(f"{CONTRACTIONS}| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


@functools.cache
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    return (_pattern("A-Za-z", "0-9", "\\t-\\r\\x20"), _pattern(_class("L"), _class("N"), WHITE_SPACE))


@functools.cache
def splitter(specials: tuple[str, ...] = ()) -> Callable[[str], list[str]]:
    """A function text -> pieces; the strings in ``specials`` are pieces of their own."""
    plain, wide = _patterns()

    def cut(text: str) -> list[str]:
        return (plain if text.isascii() else wide).findall(text)
    cut.keeps_words = True
    if not specials:
        return cut
    at = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)))

    def cut_around(text: str) -> list[str]:
        m = at.search(text)
        if m is None:
            return cut(text)
        out, i = [], 0
        for m in at.finditer(text):
            out += cut(text[i:m.start()])
            out.append(m.group())
            i = m.end()
        return out + cut(text[i:])
    # Whether a word with at most one mark behind it never holds a special string.
    cut_around.keeps_words = all(not s[:-1].isalpha() for s in specials)
    return cut_around


#: For Arrow: white space after a space.
SPACE_RUN = " [\\t-\\r\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


class Memory:
    """Ids of remembered strings, as two Arrow arrays: a few dozen bytes each.
    Beyond ``size`` strings only those of the last round are kept."""

    def __init__(self, size: int):
        self.size = size
        self.known = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_list(pa.uint32()))

    def fill(self, wanted: pa.Array, make: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The id lists of distinct strings; unknown ones are made together."""
        at = pc.fill_null(pc.index_in(wanted, value_set=self.known), -1).to_numpy().copy()
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = wanted.take(pa.array(unknown))
            at[unknown] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.ids = pa.concat_arrays([self.ids, make(new)])
        out = self.ids.take(pa.array(at))
        if len(self.known) > self.size:
            self.known, self.ids = wanted, out
        return out


class PieceEncoder:
    """Texts to ids.

    A space before another symbol always begins a piece, so a text in which
    white space follows no space is first cut at its spaces.  Arrow finds the
    distinct parts of a round; each is remembered whole, and only new ones are
    cut into pieces.  ``encode_new`` encodes a list of distinct pieces and is
    asked once for all new pieces of a round."""

    def __init__(self, cut: Callable[[str], list[str]], encode_new: Callable[[list[str]], list | pa.Array], size: int = REMEMBERED):
        self.cut, self.encode_new = cut, encode_new
        self.parts, self.pieces = Memory(size), Memory(size)

    def _make_pieces(self, pieces: pa.Array) -> pa.Array:
        ids = self.encode_new(pieces.to_pylist())
        return ids if isinstance(ids, pa.Array) else ids_array(ids)

    def _literal(self, texts: list[str]) -> pa.Array:
        """The ids of texts as they are."""
        return self._joined([self.cut(t) for t in texts])

    def _joined(self, cuts: list[Sequence[str]]) -> pa.Array:
        """The ids of texts that are cut into pieces."""
        flat = pa.array(itertools.chain.from_iterable(cuts), pa.large_string()).dictionary_encode()
        lists = self.pieces.fill(flat.dictionary, self._make_pieces).take(flat.indices)
        last = offsets_of(np.fromiter(map(len, cuts), np.int64, len(cuts)))
        return pa.LargeListArray.from_arrays(pa.array(lists.offsets.to_numpy()[last]), lists.values)

    def _spaced(self, parts: pa.Array) -> pa.Array:
        """The ids of the parts with a space before each; most are a word, or one and a mark."""
        cut, words, cuts = self.cut, self.cut.keeps_words, []
        for p in parts.to_pylist():
            if words and p.isalpha():
                cuts.append((" " + p,))
            elif words and p[-1:] in MARKS and p[:-1].isalpha():
                cuts.append((" " + p[:-1], p[-1]))
            else:
                cuts.append(cut(" " + p))
        return self._joined(cuts)

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]; null is empty."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        whole = pc.fill_null(texts, "")
        run = pc.match_substring_regex(whole, SPACE_RUN)
        runs = np.flatnonzero(run.to_numpy(zero_copy_only=False))
        # A text with runs takes part as one literal part.
        words = pc.split_pattern(pc.if_else(run, "", whole) if len(runs) else whole, " ")
        first = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        known = self.parts.fill(coded.dictionary, self._spaced)
        # A text's first part has no space before it.
        heads = np.unique(at[first[:-1]])
        others = self._literal([*coded.dictionary.take(pa.array(heads)).to_pylist(), *whole.take(pa.array(runs)).to_pylist()])
        head_at = np.searchsorted(heads, at[first[:-1]]) + len(known)
        head_at[runs] = len(known) + len(heads) + np.arange(len(runs))
        at[first[:-1]] = head_at
        lists = pa.concat_arrays([known, others]).take(pa.array(at))
        return lists.offsets.to_numpy()[first], lists.values.to_numpy()


def ids_array(ids: list[Sequence[int]]) -> pa.LargeListArray:
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum()))
    return pa.LargeListArray.from_arrays(pa.array(offsets_of(size)), pa.array(flat))


def offsets_of(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def spaced(text: str | None) -> str:
    """The text with a space for every ASCII white-space character."""
    text = text or ""
    for c in "\n\t\r\x0b\x0c":
        text = text.replace(c, " ")
    return text


def rounds(texts: pa.Array | list[str | None], chars: int = ROUND_CHARS):
    """(first, last) slices of a batch with about ``chars`` characters (bytes of an Arrow array) each."""
    start, size = 0, 0
    sizes = [len(t or "") for t in texts] if isinstance(texts, list) else pc.fill_null(
        pc.binary_length(texts), 0).to_pylist()
    for i, n in enumerate(sizes):
        if i > start and size + n > chars:
            yield start, i
            start, size = i, 0
            pa.default_memory_pool().release_unused()  # workers share an executor's memory with its JVM
        size += n
    if len(texts) > start:
        yield start, len(texts)
    pa.default_memory_pool().release_unused()


def id_lists(offsets: np.ndarray, ids: np.ndarray) -> pa.ListArray:
    """Arrow lists of 32-bit integers from what ``PieceEncoder.encode`` returns."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
