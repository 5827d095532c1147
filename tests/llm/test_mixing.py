import pytest
from pyspark.sql import functions as F

from stayline.llm import mixing


def fill(sizes):
    """Targets by the stated rule, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while True:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 3 * sizes[s] + 1e-9}
        if not over:
            return target | {s: left * weight[s] / w for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over


@pytest.mark.parametrize("name", ["odd", "sample"])
def test_targets_and_taken(request, name):
    docs = request.getfixturevalue(name)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, (len((r.text or "").split()) if (r.text or "").isascii() else None, r.source))
    sizes, taken = {}, {}
    for r in rows:
        n, s = texts[r.doc_id]
        assert n is None or r["size"] == n
        assert 0 <= r.taken <= 3 * r["size"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r.taken
    want = fill(sizes)
    for r in rows:
        s = texts[r.doc_id][1]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= mixing.BLOCK


def test_reruns_agree(sample):
    a = mixing.mix(sample).orderBy("doc_id").collect()
    b = mixing.mix(sample.repartition(7)).orderBy("doc_id").collect()
    assert a == b


def test_permutations_are_one_to_one(spark):
    for n in (1, 2, 3, 7, 64, 1000, 12345):
        d = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("s")).alias("p"))
        r = d.agg(F.min("p"), F.max("p"), F.count_distinct("p")).first()
        assert tuple(r) == (0, n - 1, n)


def test_small_sources_stop_at_three_times(spark):
    rows = [(i, "w " * 100, "big") for i in range(30)] + [(100, "w " * 70, "tiny"), (101, "", "none")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(d).collect()}
    assert got[100].target == 210 and got[100].taken == 210
    assert got[101].target == 0 and got[101].taken == 0
    assert sum(r.taken for r in got.values() if r.source_size == 3000) == pytest.approx(2860, abs=mixing.BLOCK)


def test_documents_are_repeated_as_taken(odd):
    out = mixing.mix_documents(odd)
    assert out.columns == odd.columns
    n = {}
    for r in out.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    m = {}
    for r in mixing.mix(odd).collect():
        a, b = m.get(r.doc_id, (0, 0))
        m[r.doc_id] = (a + r.taken, b + r["size"])
    times = {15: 2}  # given twice
    for d, (t, s) in m.items():
        copies = int(t / s + 0.5) if s else 0
        assert n.get(d, 0) == copies * times.get(d, 1), d


def test_copies_meet_the_targets_at_every_length(spark):
    """A source with a third of all words and weight 1 of 39 is taken at about 0.08: its long documents too."""
    def length(i):
        return 20 + i * 7919 % 1900  # from a part of a block to 30 blocks
    rows = [(i, "w " * length(i), "a") for i in range(600)]
    rows += [(1000 + 60 * s + i, "w " * length(i), f"b{s:02d}") for s in range(19) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    info = {r.doc_id: r for r in mixing.mix(d).collect()}
    words, source = {}, {i: s for i, _, s in rows}
    copies = {}
    for r in mixing.mix_documents(d).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        words[r.source] = words.get(r.source, 0) + info[r.doc_id]["size"]
    assert max(copies.values()) <= mixing.MOST
    target = {source[i]: r.target for i, r in info.items()}
    size = {source[i]: r.source_size for i, r in info.items()}
    assert target["a"] < 0.25 * size["a"]
    for s in target:  # to about two of the longest documents
        assert abs(words.get(s, 0) - target[s]) < 4000, s
    for low, high in ((20, 500), (500, 1000), (1000, 1500), (1500, 2000)):
        ids = [i for i, r in info.items() if source[i] == "a" and low <= r["size"] < high]
        taken, got = sum(info[i].taken for i in ids), sum(copies.get(i, 0) * info[i]["size"] for i in ids)
        assert abs(got - taken) < 2 * high, (low, got, taken)


def test_shards_are_full(sample):
    sized = sample.select("doc_id", "source", F.size(F.split("text", r"\s+")).cast("long").alias("size"))
    s = mixing.slots(mixing.with_targets(sized))
    places = s.agg(F.count(F.lit(1)), F.count_distinct("shard", "place")).first()
    assert places[0] == places[1]


def test_empty(empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0
