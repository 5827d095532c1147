import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stayline.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(sum(divmod(x * (1 + i % 2), 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


def test_plain_findings_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20000):
        t = "".join(rng.choice("a.@1-0+ 25(.@4)é") for _ in range(rng.randint(0, 40)))
        assert pii.plain(t) == brute(t), t


@pytest.mark.parametrize("text,kind,value", [
    ("mail john.smith [at] example (dot) com now", "email", "john.smith [at] example (dot) com"),
    ("john dot smith at example dot co dot uk ok", "email", "john dot smith at example dot co dot uk"),
    ("write jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("j@example．com", "email", "j@example．com"), ("a @ b . com", "email", "a @ b . com"),
    ("x{at}mail3.example{dot}com!", "email", "x{at}mail3.example{dot}com"),
    ("call plus one five five five one two three four five six seven eight.", "phone",
     "plus one five five five one two three four five six seven eight"),
    ("pay four zero four one eight nine four nine seven four six zero eight seven nine five", "card",
     "four zero four one eight nine four nine seven four six zero eight seven nine five"),
    ("ip one nine two dot one six eight dot zero dot one x", "ip", "one nine two dot one six eight dot zero dot one"),
    ("１９２.１６８.０.１", "ip", "１９２.１６８.０.１"),
    ("+１ (988) 555‑2485", "phone", "+１ (988) 555‑2485"),
    ("host 192.16​8.0.1 up", "ip", "192.16​8.0.1"),
    ("card 4O41 8949 746O 8795", "card", "4O41 8949 746O 8795"),
])
def test_disguises_map_back_to_the_source(text, kind, value):
    _, added = pii.find(text)
    assert (kind, value) in [(k, text[s:e]) for k, s, e in added]


@pytest.mark.parametrize("text,kind,value", [
    ("at 192 dot 168 dot 0 dot 1 now", "ip", "192 dot 168 dot 0 dot 1"),
    ("192 dot 168 dot zero dot one", "ip", "192 dot 168 dot zero dot one"),
    ("192.168 dot 0 dot 1", "ip", "192.168 dot 0 dot 1"),
    ("call +1 555 five 55 five 1234 ok", "phone", "+1 555 five 55 five 1234"),
    ("call +1 (555) five 55 five 1234 ok", "phone", "+1 (555) five 55 five 1234"),
    ("done one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
    ("phone plus one five five five one two three four five six seven", "phone",
     "plus one five five five one two three four five six seven"),
    ("4041 8949 7460 eight seven nine five", "card", "4041 8949 7460 eight seven nine five"),
    ("call one two three 192 dot 168 dot 0 dot 1", "ip", "192 dot 168 dot 0 dot 1"),
    ("+1 (five five five) one two three four five six seven", "phone", "+1 (five five five) one two three four five six seven"),
])
def test_numbers_with_few_spelled_digits(text, kind, value):
    _, added = pii.find(text)
    assert (kind, value) in [(k, text[s:e]) for k, s, e in added]


@pytest.mark.parametrize("text,kind,value", [
    ("call +1 8OO 555 1234 ok", "phone", "+1 8OO 555 1234"), ("+1 800 OOO 1234 ok", "phone", "+1 800 OOO 1234"),
    ("pay 4111 1111 1111 11ll.", "card", "4111 1111 1111 11ll"), ("host 2OO.10.0.1", "ip", "2OO.10.0.1"),
    ("host 2OO.lO.0.1", "ip", "2OO.lO.0.1"), ("l92.168.0.1", "ip", "l92.168.0.1"), ("192.168.0.l", "ip", "192.168.0.l"),
    ("I 4O41 8949 746O 8795", "card", "4O41 8949 746O 8795"), ("4041 8949 8795 746O", "card", "4041 8949 8795 746O"),
])
def test_letters_for_digits_in_any_place(text, kind, value):
    _, added = pii.find(text)
    assert (kind, value) in [(k, text[s:e]) for k, s, e in added]


@pytest.mark.parametrize("text", ["at 192.168.0.1 one can see", "4041 8949 7460 8795 two left", "one dot two, 3 dot 4"])
def test_words_beside_plain_numbers_add_nothing(text):
    assert pii.find(text)[1] == []


@pytest.mark.parametrize("text", [
    "", "see you at noon. dot dot", "he is at example.com now", "look at the dot com boom", "un deux trois soleil",
    "one two three, then four", "Ich war um acht da", "km² and 5l of water", "a point at the dot", "array[at] (dot)"])
def test_clean_text_is_left_alone(text):
    assert pii.find(text) == ([], [])


def test_plain_findings_stay():
    base, added = pii.find("jоhn@example.com")
    assert base == [("email", 2, 16)] and added == [("email", 0, 16)]


@pytest.mark.parametrize("name", ["odd", "sample"])
def test_table(request, name):
    docs = request.getfixturevalue(name)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    d = pii.detect(docs.select("doc_id", "text")).select("doc_id", pii.joined(F.col("base")).alias("s"),
                                                         F.sha2(pii.joined(F.col("base")), 256).alias("h")).collect()
    assert len(d) == docs.count()
    for r in d:
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(texts[r.doc_id]))
        assert r.s == want and r.h == hashlib.sha256(want.encode()).hexdigest()


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+" * 100_000, "a@" * 100_000, "one " * 50_000):
        pii.find(t)


def test_empty(empty):
    assert pii.detect(empty).count() == 0
