"""Repeated runs of lines, by a suffix array over line ids.

Lines that occur once can end a run but never be part of one, so the text
that is indexed is the concatenation of the stretches of lines that occur more
than once, numbered in document order (``at``; ``end`` is the number of the
last line of the stretch).

*Prefix doubling*, three doublings in a round: ``rank`` of a position orders it
by its first ``8 ** k`` lines.  A round joins the ranks 1 to 7 times ``8 ** k``
lines further on, counts the distinct tuples of these eight ranks, sorts those
by range and gives every position of an undecided class its place within the
class.  Positions whose class is down to one, or has reached the stretch's
end, take no more part.  A position keeps its tuples of all rounds.

*Longest common prefixes* of neighbours in the suffix array are read from the
first place where their tuples differ; what lies beyond it is less than one
step of that round, and is looked up that many lines further on in the tuples
of the rounds before.

*Intervals.*  A pass over each sorted range, in both directions, keeps the
stack of open LCP intervals with the earliest position in each, and finds for
every position the longest prefix that an earlier position has too: the
maximal repeated runs.  What is open at a range's border is a short list (one
entry per length); those lists alone are passed from range to range.

Runs with ``MIN_WORDS`` words or more are removed at every place but their
first, in the order of (doc_id, text hash, line).

Defined results: a null text is an empty one; lines without a word are no part
of the sequence and go with a run that spans them; rows that repeat id and
text are one document; a row without an id comes first; an empty table gives
an empty result; extra columns are not read and pass through ``clean``
unchanged."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import SPACE_PATTERN, documents, shuffle_parts, text_of, words_of
from stayline.llm.registry import register
from stayline.session import materialize

MIN_WORDS = 50
#: Ranks that a round puts together.
STEP = 8
_WHOLE = 1 << 62

Steps = list[tuple[int, int]]  # (common lines, earliest position), longest first


def in_order(df: DataFrame, cols: list[str], fn: Callable[[pa.Table, int], pa.Table], schema: str,
             within: list[str] | None = None) -> DataFrame:
    """``fn(rows, range number)`` over the rows of each range of ``cols``, sorted
    by those and ``within``; written, so that a repeated task cannot see other ranges."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            yield from fn(pa.Table.from_batches(got).combine_chunks(), TaskContext.get().partitionId()).to_batches()
    n = shuffle_parts(df.sparkSession)
    return materialize(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols, *(within or [])).mapInArrow(run, schema), "ordered")


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def starts(ordered: DataFrame, total: Column) -> DataFrame:
    """(part, before): the sum over earlier ranges of ``total``, which each
    range's last row (``tail``) holds; one row per range."""
    rows, before, out = ordered.filter("tail").select("part", total.alias("n")).collect(), 0, []
    for r in sorted(rows, key=lambda r: r["part"]):
        out.append((r["part"], before))
        before += r["n"]
    return F.broadcast(ordered.sparkSession.createDataFrame(out, "part long, before long"))


# ---------------------------------------------------------------- positions

def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, th (text hash), idx (line number), seq (among lines with a word), words, and the line's hash h1, h2."""
    text = text_of()
    numbered = F.filter(F.transform(F.split(text, "\n"), lambda l, i: F.struct(i.alias("idx"), l.alias("line"))),
                        lambda s: F.length(F.regexp_replace(s["line"], SPACE_PATTERN, "")) > 0)
    d = docs.select("doc_id", F.xxhash64(text).alias("th"), F.posexplode(numbered).alias("seq", "s"))
    line = F.col("s.line")
    return d.select("doc_id", "th", "seq", F.col("s.idx").alias("idx"), F.size(words_of(line)).alias("words"),
                    F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit(1)).alias("h2"))


def positions(docs: DataFrame) -> DataFrame:
    """at, end, doc_id, th, idx, words, upto (words of the stretch up to here) and rank of every repeated line."""
    lines = materialize(lines_of(docs), "lines")

    def cumulated(t, part):
        n = _column(t, "n")
        return pa.table({"h1": t.column("h1"), "h2": t.column("h2"), "n": n, "cum": np.cumsum(n) - n,
                         "part": np.full(len(n), part), "tail": np.arange(len(n)) == len(n) - 1})
    repeated = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ids = in_order(repeated, ["h1", "h2"], cumulated, "h1 long, h2 long, n long, cum long, part long, tail boolean")
    ids = ids.join(starts(ids, F.col("cum") + F.col("n")), "part").select(
        "h1", "h2", (F.col("before") + F.col("cum")).alias("rank"))
    here = lines.join(ids, ["h1", "h2"]).drop("h1", "h2").dropDuplicates(["doc_id", "th", "idx"])
    here = here.withColumn("key", F.xxhash64("doc_id", "th"))

    def stretches(t, part):
        key, seq, words = _column(t, "key"), _column(t, "seq"), _column(t, "words").astype(np.int64)
        n = len(key)
        first = np.ones(n, bool)
        first[1:] = (key[1:] != key[:-1]) | (seq[1:] != seq[:-1] + 1)
        begin = np.flatnonzero(first)
        which = np.cumsum(first) - 1
        cum = np.cumsum(words)
        return pa.table({"part": np.full(n, part), "i": np.arange(n), "last": np.append(begin[1:], n)[which] - 1,
                         "doc_id": t.column("doc_id"), "th": t.column("th"), "idx": _column(t, "idx").astype(np.int64),
                         "words": words, "upto": cum - (cum - words)[begin][which], "rank": t.column("rank"),
                         "tail": np.arange(n) == n - 1})
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Ranges of documents, so that a document's lines are in one range.
    p = in_order(here, ["doc_id", "th"], stretches, f"part long, i long, last long, doc_id {kind}, th long, idx long, "
                                                    "words long, upto long, rank long, tail boolean", ["seq"])
    off = starts(p, F.col("i") + 1)
    return materialize(p.join(off, "part").select(
        (F.col("before") + F.col("i")).alias("at"), (F.col("before") + F.col("last")).alias("end"),
        "doc_id", "th", "idx", "words", "upto", "rank"), "positions")


# ---------------------------------------------------------------- ranks

def doubled(pos: DataFrame) -> DataFrame:
    """at, end, rank and tuples (the eight ranks of each round, in one array)
    of every position of ``pos`` (at, end, rank)."""
    active = pos.select("at", "end", "rank", F.array().cast("array<bigint>").alias("tuples"))
    done: DataFrame | None = None
    span = 1
    nexts = [f"n{j}" for j in range(1, STEP)]
    while True:
        state = active if done is None else active.unionByName(done)
        steps = F.least(F.lit(STEP - 1), F.floor((F.col("end") - F.col("at")) / span))
        near = active.filter(F.col("at") + span <= F.col("end")).select(
            "at", F.explode(F.sequence(F.lit(1).cast("long"), steps)).alias("j"))
        near = (near.withColumn("to", F.col("at") + F.col("j") * span)
                .join(state.select(F.col("at").alias("to"), F.col("rank").alias("r")), "to")
                .groupBy("at").agg(*[F.max(F.when(F.col("j") == j, F.col("r"))).alias(f"n{j}") for j in range(1, STEP)]))
        looked = materialize(active.join(near, "at", "left").fillna(-1, nexts), "looked")
        keys = ["rank", *nexts]

        def placed(t, part):
            rank, n = _column(t, "rank"), _column(t, "n")
            cum = np.cumsum(n) - n
            first = np.ones(len(rank), bool)
            first[1:] = rank[1:] != rank[:-1]
            which = np.cumsum(first) - 1
            place = cum - cum[np.flatnonzero(first)][which]
            # The members of the range's first and last class, for those that go on over its border.
            edge = np.zeros(len(rank), bool)
            edge[-1] = True
            edge[np.flatnonzero(which == 0)[-1]] = True
            return pa.table({"part": np.full(len(rank), part), **{k: t.column(k) for k in keys}, "n": n, "place": place,
                             "edge": edge})
        kinds = ", ".join(f"{k} long" for k in keys)
        o = in_order(looked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, placed,
                     f"part long, {kinds}, n long, place long, edge boolean")
        o = o.join(_carried(o), ["part", "rank"], "left").select(
            *keys, "n", (F.col("rank") + F.col("place") + F.coalesce("carry", F.lit(0))).alias("new"))
        looked = materialize(looked.join(o, keys).select(
            "at", "end", F.col("new").alias("rank"), F.concat("tuples", F.array(*keys)).alias("tuples"), "n",
            F.col(nexts[-1]).alias("far")), "ranks")
        cols = ["at", "end", "rank", "tuples"]
        over = looked.filter("n = 1 OR far < 0").select(cols)
        active = looked.filter("n > 1 AND far >= 0").select(cols)
        done = over if done is None else done.unionByName(over)
        if active.isEmpty():
            return done
        span *= STEP


def _carried(o: DataFrame) -> DataFrame:
    """(part, rank, carry): of a class that goes on from earlier ranges, its
    members there.  Two rows per range are read, and at most one is returned."""
    rows = o.filter("edge").select("part", "rank", (F.col("place") + F.col("n")).alias("n")).collect()
    out, last, members = [], None, 0
    for r in sorted(rows, key=lambda r: (r["part"], r["rank"])):
        if r["rank"] == last:
            out.append((r["part"], last, members))
            members += r["n"]
        else:
            last, members = r["rank"], r["n"]
    return F.broadcast(o.sparkSession.createDataFrame(out, "part long, rank long, carry long"))


# ---------------------------------------------------------------- common prefixes

def neighbours(ranked: DataFrame) -> DataFrame:
    """The suffix array: part, i, at, with lcp to the position before it (0 for the very first)."""
    kind = "part long, i long, at long, end long, prev long, lcp long, level long, edge array<long>"

    def compared(t, part):
        at, end = _column(t, "at"), _column(t, "end")
        lists = t.column("tuples").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.chunk(0)
        off, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        size, n = np.diff(off), len(at)
        common = np.minimum(size, np.roll(size, 1))
        differ = np.full(n, -1)
        for k in range(int(size.max())):
            rows = np.flatnonzero((differ < 0) & (k < common) & (np.arange(n) > 0))
            differ[rows[flat[off[rows] + k] != flat[off[rows - 1] + k]]] = k
        here, before = np.full(n, -1), np.full(n, -1)
        found = np.flatnonzero(differ >= 0)
        here[found], before[found] = flat[off[found] + differ[found]], flat[off[found - 1] + differ[found]]
        lcp, level = reach(differ, here, before, end - at + 1)
        first = np.arange(n) == 0
        edge = [flat[off[j]:off[j + 1]].tolist() if j in (0, n - 1) else None for j in range(n)]
        return pa.table({"part": np.full(n, part), "i": np.arange(n), "at": at, "end": end,
                         "prev": pa.array(np.roll(at, 1), mask=first), "lcp": lcp, "level": level,
                         "edge": pa.array(edge, pa.list_(pa.int64()))})
    sa = in_order(ranked.select("rank", "at", "end", "tuples"), ["rank", "at"], compared, kind)
    # Each range's first position meets the last one of the range before: two rows per range.
    ends = sa.filter("edge IS NOT NULL").select("part", "i", "at", "end", "edge").orderBy("part", "i").collect()
    fixed = []
    for a, b in zip(ends, ends[1:]):
        if b["part"] != a["part"]:
            k = next((k for k, (x, y) in enumerate(zip(a["edge"], b["edge"])) if x != y), -1)
            lcp, level = reach(*(np.array([v]) for v in (k, b["edge"][k], a["edge"][k], b["end"] - b["at"] + 1)))
            fixed.append((b["part"], b["i"], b["at"], a["at"], int(lcp[0]), int(level[0])))
    firsts = sa.sparkSession.createDataFrame(fixed, "part long, i long, at long, prev long, lcp long, level long")
    lowest = ends[0]["part"] if ends else -1
    cols = ["part", "i", "at", "prev", "lcp", "level"]
    pairs = sa.filter((F.col("i") > 0) | (F.col("part") == lowest)).select(cols).unionByName(firsts)
    found = pairs.filter("level = 0")
    open_ = materialize(pairs.filter("level > 0"), "open")
    side = ranked.select("at", "tuples")
    while not open_.isEmpty():
        j = (open_.withColumn("to", F.col("at") + F.col("lcp")).withColumn("prev_to", F.col("prev") + F.col("lcp"))
             .join(side.select(F.col("at").alias("to"), F.col("tuples").alias("ta")), "to")
             .join(side.select(F.col("at").alias("prev_to"), F.col("tuples").alias("tb")), "prev_to"))
        # They differ within one step of the round ``level``, so in a round before it.
        upto = F.least(F.size("ta"), F.size("tb"), STEP * F.col("level"))
        unequal = F.transform(F.sequence(F.lit(0).cast("long"), upto - 1), lambda k: F.get("ta", k) != F.get("tb", k))
        j = j.withColumn("k", F.array_position(unequal, True) - 1)
        level = F.floor(F.col("k") / STEP)
        ended = (F.get("ta", F.col("k")) < 0) | (F.get("tb", F.col("k")) < 0)
        j = (j.withColumn("ended", ended)
             .withColumn("lcp", (F.col("lcp") + F.col("k") % STEP * F.pow(F.lit(STEP), level)).cast("long"))
             .withColumn("level", F.when(F.col("ended"), 0).otherwise(level).cast("long")))
        j = materialize(j.select(cols), "open")
        found = found.unionByName(j.filter("level = 0"))
        open_ = j.filter("level > 0")
    return found.select("part", "i", "at", "lcp")


def reach(differ: np.ndarray, here: np.ndarray, before: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common lines that are certain, round whose steps hide more) of two
    positions whose tuples first differ at index ``differ`` (-1: nowhere, so
    that they are equal for all ``left`` lines), with these ranks there (-1:
    past the end)."""
    level, j = np.divmod(np.maximum(differ, 0), STEP)
    lcp = np.where(differ < 0, left, j * STEP ** level.astype(np.int64))
    sure = (differ < 0) | (here < 0) | (before < 0)
    return lcp, np.where(sure, 0, level)


# ---------------------------------------------------------------- intervals

def cut(steps: Steps, lcp: int) -> Steps:
    """The open intervals after a neighbour with which they share at most ``lcp`` lines."""
    if not steps or steps[0][0] <= lcp:
        return steps
    over = [p for l, p in steps if l >= lcp]
    rest = [s for s in steps if s[0] < lcp]
    return [(lcp, min(over)), *rest] if lcp else []


def merged(a: Steps, b: Steps) -> Steps:
    """Both lists in one, without entries that a longer one with an earlier position makes idle."""
    out: Steps = []
    for l, p in sorted([*a, *b], key=lambda s: (-s[0], s[1])):
        if not out or p < out[-1][1]:
            out.append((l, p))
    return out


def sweep(at: list[int], lcp: list[int], steps: Steps, found: list[int] | None) -> Steps:
    """Walk positions; ``lcp[j]`` is shared with the one before (that of the
    first is already in ``steps``).  ``found[j]`` rises to the most lines that
    an earlier position shares.  Returns the open intervals at the last one."""
    stack = steps[::-1]  # shortest first
    for j, p in enumerate(at):
        if j:
            c, low = lcp[j], at[j - 1]
            while stack and stack[-1][0] >= c:
                low = min(low, stack.pop()[1])
            if c:
                while stack and stack[-1][1] >= low:
                    stack.pop()  # idle: shorter and later
                stack.append((c, low))
        if found is not None:
            for l, first in reversed(stack):
                if first < p:
                    if l > found[j]:
                        found[j] = l
                    break
    return merged([(_WHOLE, at[-1])], stack)


def longest_earlier(sa: DataFrame) -> DataFrame:
    """(at, lines): the most lines from ``at`` on that an earlier position has too; from part, i, at, lcp."""
    n = shuffle_parts(sa.sparkSession)
    def ranges(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            t = pa.Table.from_batches(got).combine_chunks()
            part = _column(t, "part")
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            for s, e in zip(starts, np.append(starts[1:], len(part))):
                yield int(part[s]), _column(t, "at")[s:e].tolist(), _column(t, "lcp")[s:e].tolist()

    def borders(batches):
        for part, at, lcp in ranges(batches):
            right = sweep(at, lcp, [], None)
            left = sweep(at[::-1], [0, *lcp[:0:-1]], [], None)
            rows = [{"first": lcp[0], "least": min(lcp[1:], default=_WHOLE), "part": part, "left": [list(s) for s in left],
                     "right": [list(s) for s in right]}]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("part", pa.int64()), ("first", pa.int64()), ("least", pa.int64()),
                ("left", pa.list_(pa.list_(pa.int64()))), ("right", pa.list_(pa.list_(pa.int64())))]))
    # One short row per range, not per position.
    ordered = sa.repartition(n, "part").sortWithinPartitions("part", "i")
    rows = ordered.mapInArrow(borders, "part long, first long, least long, left array<array<long>>, "
                                       "right array<array<long>>").collect()
    rows.sort(key=lambda r: r["part"])
    into: dict[int, tuple[Steps, Steps]] = {}
    from_left, open_ = {}, []
    for r in rows:
        from_left[r["part"]] = enter = cut(open_, r["first"])
        open_ = merged([tuple(s) for s in r["right"]], cut(enter, r["least"]))
    open_, link = [], 0
    for r in reversed(rows):
        enter = cut(open_, link)
        into[r["part"]] = (from_left[r["part"]], enter)
        open_, link = merged([tuple(s) for s in r["left"]], cut(enter, r["least"])), r["first"]
    shared = sa.sparkSession.sparkContext.broadcast(into)

    def lengths(batches):
        for part, at, lcp in ranges(batches):
            left, right = shared.value[part]
            found = [0] * len(at)
            sweep(at, lcp, left, found)
            back = found[::-1]
            sweep(at[::-1], [0, *lcp[:0:-1]], right, back)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(back[::-1], pa.int64())], ["at", "lines"])
    return ordered.mapInArrow(lengths, "at long, lines long")


# ---------------------------------------------------------------- runs

def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th, first, last (line numbers), lines and words of every run that has an earlier copy."""
    pos = positions(docs)
    found = materialize(longest_earlier(neighbours(doubled(pos))).filter("lines > 0"), "lengths")
    reach = found.select("at", (F.col("at") + F.col("lines") - 1).alias("to"))
    upto = pos.select(F.col("at").alias("to"), F.col("upto").alias("to_upto"))
    d = pos.drop("rank").join(reach.join(upto, "to"), "at", "left")
    counts = F.col("to_upto") - F.col("upto") + F.col("words") >= min_words
    stretch = Window.partitionBy("end").orderBy("at")  # lines of one document
    d = d.withColumn("covered", F.max(F.when(counts, F.col("to"))).over(stretch) >= F.col("at"))
    d = d.withColumn("new", (F.col("covered") & ~F.coalesce(F.lag("covered").over(stretch), F.lit(False))).cast("int"))
    d = d.withColumn("run", F.sum("new").over(stretch)).filter("covered")
    return d.groupBy("doc_id", "th", "end", "run").agg(
        F.min("idx").alias("first"), F.max("idx").alias("last"), F.count(F.lit(1)).alias("lines"),
        F.sum("words").alias("words")).drop("end", "run")


def clean(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with column ``removed`` (array of first, last, in order) and
    ``clean_text``: the text without the lines of the later copies."""
    runs = repeated_runs(docs, min_words).groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).agg(
        F.array_sort(F.collect_list(F.struct("first", "last"))).alias("__runs"))  # runs of one document
    taken = ("removed", "clean_text")
    d = docs.select(*[docs[c] for c in docs.columns if c.lower() not in taken]).withColumn("__h", F.xxhash64(text_of()))
    d = d.join(runs, d["doc_id"].eqNullSafe(runs["__id"]) & (d["__h"] == runs["__th"]), "left")
    none = F.array().cast("array<struct<first:bigint,last:bigint>>")
    d = d.withColumn("removed", F.coalesce("__runs", none))
    kept = F.filter(F.split(text_of(), "\n"), lambda l, i: ~F.exists(
        F.col("removed"), lambda r: (i >= r["first"]) & (i <= r["last"])))
    return d.withColumn("clean_text", F.when(F.size("removed") > 0, F.array_join(kept, "\n")).otherwise(text_of())).drop(
        "__id", "__th", "__h", "__runs")


@register("op6_line_dedup")
def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    d = clean(documents(spark, sf_dir).select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return d.select("doc_id", F.size(F.split(text_of(), "\n")).cast("long").alias("n_lines"),
                    F.size("removed").cast("long").alias("n_runs"), gone.alias("n_removed"),
                    F.sha2("clean_text", 256).alias("clean_sha256"))
