"""Source divergence audit: how the sources of a language differ in their terms.

Method: an exact count by document keeps the terms of each language that
``least`` of its documents hold.  The kept terms are dealt by hash to shards of
at most about ``SHARD_KEYS``; a task builds each shard's minimal perfect hash: levels
of bit arrays, in which a key owns the bit that no other remaining key
hashes to, its slot being the number of bits before its own.  Shards are
broadcast with their stored terms, at most about ``ROUND_BYTES`` at a time (so
the size is bounded; a larger vocabulary takes more rounds over the texts).
The second pass looks up each term, checks it against the stored one, and
increments a dense array of the group's slots; the arrays of all tasks are
summed by slot.  A shard's counts of all sources of its language then form one
small matrix, from which integer arithmetic gives the divergences.

For a group's count and the language's: p = 1 + floor(1e9 (count + 1) / (N + V)),
with V kept terms and N their occurrences; a term's divergence of p from q is
floor((p - q)^2 / q).

Defined results: null text, lang and source count as ''; a group without kept
terms still has its pairs; texts of any length are read whole; repeated rows
count again; ties rank by term or source in UTF-8 order; an empty table gives
an empty result; extra columns are not read."""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import documents
from stayline.llm.registry import register
from stayline.session import materialize

LEAST_DOCS = 3
TOP_TERMS = 200
SHARD_KEYS = 16_384
#: Bytes of shards that are broadcast at once, distinct terms that a task holds, and bytes of its dense counts.
ROUND_BYTES = 64_000_000
HELD_TERMS = 400_000
DENSE_BYTES = 160_000_000
LEVELS = 32
_U = np.uint64

#: Bytes of UTF-8: a-z and everything beyond ASCII stay, A-Z in lower case, the rest separates.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0x80 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TERMS).split()


# ---------------------------------------------------------------- perfect hash

def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash of each hash for every level (a multiply-xorshift finisher)."""
    h = h + _U((level + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def hashes(keys: list[bytes]) -> np.ndarray:
    """``xxhash64`` of Spark (its seed is 42), which also deals terms to shards."""
    return np.array([xxhash.xxh64_intdigest(k, 42) for k in keys], dtype=_U)


class PerfectHash:
    """Minimal perfect hash of a set of keys with the keys stored by slot.
    Keys that no level separates (equal hashes) take the last slots and are
    found by the keys themselves."""

    def __init__(self, words: list[np.ndarray], keys: pa.Array):
        self.words, self.keys, at = words, keys, 0
        self.before = []
        for w in words:
            ones = np.bitwise_count(w).astype(np.int64)
            self.before.append(at + np.cumsum(ones) - ones)
            at += int(ones.sum())
        self.rest = {k: at + i for i, k in enumerate(keys[at:].to_pylist())}

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        h = hashes(keys)
        left, words, order = np.arange(len(keys)), [], []
        for level in range(LEVELS):
            if not len(left):
                break
            n = 1 + len(left) // 32  # 64-bit words, two bits a key
            at = _mixed(h[left], level) % _U(64 * n)
            place, first, count = np.unique(at, return_index=True, return_counts=True)
            own = count == 1
            w = np.zeros(n, dtype=_U)
            np.bitwise_or.at(w, (place[own] >> _U(6)).astype(np.int64), _U(1) << (place[own] & _U(63)))
            words.append(w)
            order.append(left[first[own]])
            left = left[~np.isin(at, place[own])]
        order = np.concatenate([*order, left]) if len(keys) else np.arange(0)
        return cls(words, pa.array([keys[i] for i in order], pa.binary()))

    def slots(self, keys: pa.Array, h: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that are not in the set."""
        out, open_ = np.full(len(h), -1), np.arange(len(h))
        for level, (w, before) in enumerate(zip(self.words, self.before)):
            at = _mixed(h[open_], level) % _U(64 * len(w))
            word, bit = (at >> _U(6)).astype(np.int64), at & _U(63)
            hit = (w[word] >> bit) & _U(1) == _U(1)
            below = np.bitwise_count(w[word] & ((_U(1) << bit) - _U(1)))
            out[open_[hit]] = (before[word] + below)[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        found = out >= 0
        same = pc.equal(self.keys.take(pa.array(np.where(found, out, 0))), keys).to_numpy(zero_copy_only=False) \
            if len(self.keys) else np.zeros(len(h), bool)
        out[~(found & same)] = -1
        if self.rest:
            for i in np.flatnonzero(out < 0):
                out[i] = self.rest.get(keys[int(i)].as_py(), -1)
        return out


def _stored(lang: str, shard: int, shards: int, ph: PerfectHash) -> dict:
    return {"lang": lang, "shard": shard, "shards": shards, "keys": ph.keys.to_pylist(),
            "words": [w.tobytes() for w in ph.words]}


def _loaded(row) -> PerfectHash:
    return PerfectHash([np.frombuffer(bytes(w), dtype=_U) for w in row["words"]],
                       pa.array([bytes(k) for k in row["keys"]], pa.binary()))


# ---------------------------------------------------------------- on tables

def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term) with at least ``least`` documents, terms as bytes of UTF-8."""
    def run(batches):
        counts: dict[str, Counter] = defaultdict(Counter)

        def out():
            rows = [(x, t, n) for x, c in counts.items() for t, n in c.items()]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.int64())], ["lang", "term", "n"])
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                counts[lang].update(set(terms_of(text.as_py())))
                if sum(map(len, counts.values())) >= HELD_TERMS:
                    yield out()
        yield out()
    parts = docs.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return parts.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term")


def perfect_hashes(kept: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(lang, shard, shards, keys, words): one row for each shard of a language.
    All languages have the same number of shards, which the size of the table
    ``kept`` (read twice) gives."""
    shards = max(1, -(-kept.count() // shard_keys))
    dealt = kept.select("lang", "term", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"))

    def build(t: pa.Table) -> pa.Table:
        ph = PerfectHash.build(t.column("term").to_pylist())
        return pa.Table.from_pylist([_stored(t.column("lang")[0].as_py(), t.column("shard")[0].as_py(), shards, ph)], schema)
    schema = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("shards", pa.int32()),
                        ("keys", pa.list_(pa.binary())), ("words", pa.list_(pa.binary()))])
    return dealt.groupBy("lang", "shard").applyInArrow(
        build, "lang string, shard int, shards int, keys array<binary>, words array<binary>")




def recount(docs: DataFrame, shards: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(lang, shard, slot, source, n) of the terms of ``shards`` in (lang, source, text) rows."""
    size = F.aggregate("keys", F.lit(0).cast("long"), lambda a, k: a + 8 + F.octet_length(k))
    total = shards.agg(F.sum(size)).first()[0] or 0
    rounds = max(1, -(-total // round_bytes))
    out = None
    for r in range(rounds):
        some = shards.filter(F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)) == r).collect()  # about round_bytes
        held = docs.sparkSession.sparkContext.broadcast([x.asDict() for x in some])
        d = docs.select("lang", "source", "text").mapInArrow(
            _counter(held), "lang string, shard int, slot int, source string, n long")
        out = d if out is None else out.unionByName(d)
    slot = ["lang", "shard", "slot", "source"]
    return out.repartition(*slot).groupBy(*slot).agg(F.sum("n").alias("n"))  # tasks have summed their rows already


def _parts(labels: np.ndarray) -> list[np.ndarray]:
    """The places of each distinct label."""
    order = np.argsort(labels, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(labels[order])) + 1) if len(order) else []


def _counter(held):
    def run(batches):
        hashed = {(x["lang"], x["shard"]): _loaded(x) for x in held.value}
        shards = {x["lang"]: x["shards"] for x in held.value}
        counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        dense: dict[tuple[str, str, int], np.ndarray] = {}

        def located(lang, terms):
            """(shard, slot) of each term, slot -1 where it is not held."""
            h, keys = hashes(terms), pa.array(terms, pa.binary())
            shard, slot = h.view(np.int64) % shards[lang], np.full(len(terms), -1)
            for part in _parts(shard):
                ph = hashed.get((lang, int(shard[part[0]])))
                if ph is not None:  # else of another round
                    slot[part] = ph.slots(keys.take(pa.array(part)), h[part])
            return shard, slot

        def add():
            langs: dict[str, list] = defaultdict(list)
            for (lang, source), c in counts.items():
                langs[lang].append((source, c))
            for lang, groups in langs.items():  # the sources of a language share most terms
                terms = list(dict.fromkeys(chain.from_iterable(c for _, c in groups)))
                place = dict(zip(terms, range(len(terms))))
                shard, slot = located(lang, terms)
                for source, c in groups:
                    at = np.fromiter(map(place.__getitem__, c), np.int64, len(c))
                    n = np.fromiter(c.values(), np.int64, len(c))
                    n, at = n[slot[at] >= 0], at[slot[at] >= 0]
                    for part in _parts(shard[at]):
                        s, own = int(shard[at[part[0]]]), slot[at[part]]
                        if (lang, source, s) not in dense:
                            dense[lang, source, s] = np.zeros(len(hashed[lang, s].keys), np.int64)
                        dense[lang, source, s][own] += n[part]
            counts.clear()

        def out():
            rows = []
            while dense:
                (lang, source, s), at = dense.popitem()
                slot = np.flatnonzero(at)
                k = len(slot)
                rows.append(pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, k), pa.repeat(pa.scalar(s, pa.int32()), k), pa.array(slot, pa.int32()),
                     pa.repeat(source, k), pa.array(at[slot])], ["lang", "shard", "slot", "source", "n"]))
                if sum(r.num_rows for r in rows) >= 50_000 or not dense:
                    yield from pa.Table.from_batches(rows).combine_chunks().to_batches()
                    rows = []
        for b in batches:
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text")):
                if lang in shards:
                    counts[lang, source].update(terms_of(text.as_py()))
                    if sum(map(len, counts.values())) >= HELD_TERMS:
                        add()
                        if sum(a.nbytes for a in dense.values()) >= DENSE_BYTES:
                            yield from out()
        add()
        yield from out()
    return run


def _parts_per_billion(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(1e9 (count + 1) / total), three digits at a time, so that no product overflows."""
    out, rest = (count + 1) // total, (count + 1) % total
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // total, rest * 1000 % total
    return 1 + out


def _divergences(source, slot, n, sources, totals, lang_total, v, keys, top):
    """(sums, best): the sum of divergences of each source (row) from each
    other one (column), and each source's ``top`` (value, term) pairs."""
    k = len(sources)
    sums, best = np.zeros((k, k), np.int64), [[] for _ in range(k)]
    order = np.argsort(slot, kind="stable")
    source, slot, n = source[order], slot[order], n[order]
    width = max(64, 2 ** 21 // k)
    for lo in range(0, len(keys), width):
        hi = min(len(keys), lo + width)
        a, b = np.searchsorted(slot, [lo, hi])
        m = np.zeros((k, hi - lo), np.int64)
        m[source[a:b], slot[a:b] - lo] = n[a:b]
        p = _parts_per_billion(m, (totals + v)[:, None])
        q = _parts_per_billion(m.sum(0), np.int64(lang_total + v))
        for i in range(k):
            d = p[i] - p
            sums[i] += (d * d // p).sum(1)
            here = np.flatnonzero((m[i] > 0) & (p[i] > q))
            if len(here):
                d = p[i, here] - q[here]
                value = d * d // q[here]
                if len(value) > top:  # ties of the last one stay
                    least = np.partition(value, len(value) - top)[len(value) - top]
                    here, value = here[value >= least], value[value >= least]
                terms = keys.take(pa.array(here + lo)).to_pylist()
                best[i] = sorted(best[i] + list(zip((-value).tolist(), terms)))[:top]
    return sums, best


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS, shard_keys: int = SHARD_KEYS,
          round_bytes: int = ROUND_BYTES) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) group of ``docs``."""
    d = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = materialize(kept_terms(d, least), "kept-terms")
    shards = materialize(perfect_hashes(kept, shard_keys), "perfect-hashes")
    counts = materialize(recount(d, shards, round_bytes), "recount")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (d.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
              .withColumn("total", F.coalesce("total", F.lit(0).cast("long"))))
    groups = materialize(groups, "groups")
    per_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(
        shards.groupBy("lang").agg(F.sum(F.size("keys")).alias("v")), "lang")
    # One row for each source of the language and one with the terms go to each shard.
    none = F.lit(None)
    info = (shards.select("lang", "shard").join(per_lang, "lang").join(groups, "lang")
            .select("lang", "shard", "source", "total", "lang_total", "v", none.cast("array<binary>").alias("keys"))
            .unionByName(shards.select("lang", "shard", none.cast("string").alias("source"),
                                       *[none.cast("long").alias(c) for c in ("total", "lang_total", "v")], "keys")))

    def shard_parts(left: pa.Table, right: pa.Table) -> pa.Table:
        lang, keys, stats = None, [], []
        for r in right.to_pylist():
            if r["keys"] is None:
                stats.append(r)
                lang = r["lang"]
            else:
                keys = r["keys"]
        stats.sort(key=lambda r: r["source"])
        sources = [r["source"] for r in stats]
        at = pc.index_in(left.column("source"), pa.array(sources, pa.string())).to_numpy()
        sums, best = _divergences(
            at.astype(np.int64), left.column("slot").to_numpy().astype(np.int64), left.column("n").to_numpy(), sources,
            np.array([r["total"] for r in stats], np.int64), stats[0]["lang_total"], stats[0]["v"],
            pa.array(keys, pa.binary()), top)
        rows = [(sources[i], "pair", sources[j], int(sums[i, j])) for i in range(len(sources)) for j in range(len(sources))
                if i != j]
        rows += [(sources[i], "term", t.decode(), -v) for i in range(len(sources)) for v, t in best[i]]
        return pa.table({"lang": pa.array([lang] * len(rows), pa.string()),
                         **{c: pa.array([r[k] for r in rows], ty) for k, (c, ty) in enumerate(
                             [("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])}})
    parts = counts.groupBy("lang", "shard").cogroup(info.groupBy("lang", "shard")).applyInArrow(
        shard_parts, "lang string, source string, part string, item string, value long")
    # Languages without kept terms have pairs as well, of value 0.
    other = groups.select("lang", F.col("source").alias("item"))
    zero = groups.join(other, "lang").filter("source <> item").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    total = parts.unionByName(zero).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    w = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = total.withColumn("rank", F.row_number().over(w))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))


AUDIT_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ts)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 3
), g AS (
  SELECT DISTINCT lang, source FROM d
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(ts) AS term FROM d)
  JOIN kept USING (lang, term) GROUP BY lang, source, term
), f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v.v
  FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p FROM f
), l AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)) AS q
  FROM f GROUP BY lang, term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p.p - l.q) * (p.p - l.q) // l.q)::BIGINT
  FROM p JOIN l ON l.lang = p.lang AND l.term = p.term WHERE p.n > 0 AND p.p > l.q
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""


@register("op12_source_divergence", AUDIT_SQL)
def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir)).select("lang", "source", "part", "item", "value", "rank")
