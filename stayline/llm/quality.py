"""Quality rules with adaptive thresholds.

Per document a handful of text measures are computed with built-in functions;
per (language, source) the measures of the documents that pass the base rule,
and the words and lines they are shares of, go into mergeable KLL quantile
sketches.  A group's thresholds are far-out fences read from its sketches: the
upper quantile plus ``spread`` times the range between the quantiles.  Where
hardly any document of a group has symbols or repeated lines that range is 0;
the group's step then takes its place, one item in a document of the group's
own lesser length (``Fence.short``), also read from a sketch.  No cutoff is a
constant.  Groups with fewer than ``min_group`` such documents use the merged
sketches of their language, and beneath that those merged over everything.
Thresholds are then joined to the documents and decide them.

Defined results: a null text is an empty one (no words, so the base rule
rejects it); null languages and sources form groups of their own; repeated
rows are judged alike; an empty table gives an empty result; extra columns are
not read and, in ``filter_documents``, pass through unchanged."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import SPACE_PATTERN, documents, text_of, words_of
from stayline.llm.registry import register
from stayline.session import materialize

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
SKETCH_K = 400
MIN_GROUP = 50


@dataclass(frozen=True)
class Fence:
    """Limits for one measure: its ``tail`` and 1 - ``tail`` quantiles -/+ ``spread``
    times their distance, or times 1 / the ``short`` quantile of ``per`` if that is more."""
    name: str
    tail: float
    spread: float
    per: str
    short: float
    lower: bool = False


FENCES = (
    Fence("symbol_share", 0.25, 4.0, "n_words", 0.1),
    Fence("word_length", 0.1, 4.0, "n_words", 0.1, lower=True),
    Fence("dup_line_share", 0.25, 2.0, "n_lines", 0.5),
)
#: Measures with a sketch.
SKETCHED = ("symbol_share", "word_length", "dup_line_share", "n_words", "n_lines")


def _measures(df: DataFrame, text: Column, p: str) -> DataFrame:
    """Add ``p``-prefixed measures.  The steps are separate columns because
    each array is referenced several times by the next step."""
    n = F.size(f"{p}words")
    df = (df.withColumn(f"{p}text", text)
          .withColumn(f"{p}words", words_of(F.col(f"{p}text")))
          .withColumn(f"{p}lines", F.filter(F.split(f"{p}text", "\n"),
                                            lambda s: F.length(F.regexp_replace(s, SPACE_PATTERN, "")) > 0))
          .withColumn(f"{p}grams", F.when(n >= WINDOW, F.transform(
              F.sequence(F.lit(0), n - WINDOW),
              lambda i: F.xxhash64(*[F.get(F.col(f"{p}words"), i + k) for k in range(WINDOW)])))
              .otherwise(F.array().cast("array<bigint>"))))
    # Only texts with a repeated window pay for the sort.
    df = df.withColumn(f"{p}sorted", F.when(
        F.size(F.array_distinct(f"{p}grams")) < F.size(f"{p}grams"),
        F.array_sort(F.transform(f"{p}grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    s = F.col(f"{p}sorted")
    df = df.withColumn(f"{p}starts", F.array_sort(F.transform(
        F.filter(s, lambda e, i: ((i > 0) & (F.get(s, i - 1)["g"] == e["g"]))
                 | F.coalesce(F.get(s, i + 1)["g"] == e["g"], F.lit(False))), lambda e: e["i"])))
    covered = F.aggregate(
        f"{p}starts", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["to"])).alias("n"),
                              (i + WINDOW).alias("to")),
        lambda a: a["n"])
    return (df.withColumn(f"{p}n_words", n.cast("long"))
            .withColumn(f"{p}word_chars", F.length(F.array_join(f"{p}words", "")).cast("long"))
            .withColumn(f"{p}n_symbols", F.regexp_count(F.col(f"{p}text"), F.lit(SYMBOLS)).cast("long"))
            .withColumn(f"{p}n_lines", F.size(f"{p}lines").cast("long"))
            .withColumn(f"{p}n_dup_lines",
                        (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"))
            .withColumn(f"{p}n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop(*[f"{p}{c}" for c in ("text", "words", "lines", "grams", "sorted", "starts")]))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` with the counts of ``MEASURES`` (long), each named with ``prefix``."""
    return _measures(docs, text_of("text"), prefix)


def base_failed(prefix: str = "") -> Column:
    """Fixed rule: under ten words, or over a fifth of them in repeated windows."""
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 10) | (100 * r > 20 * n)


def shares(prefix: str = "") -> dict[str, Column]:
    """The measures that the adaptive fences judge (null for a text without words)."""
    n = F.nullif(F.col(f"{prefix}n_words"), F.lit(0))
    return {"symbol_share": F.col(f"{prefix}n_symbols") / n,
            "word_length": F.col(f"{prefix}word_chars") / n,
            "dup_line_share": F.col(f"{prefix}n_dup_lines") / F.nullif(F.col(f"{prefix}n_lines"), F.lit(0))}


def sketches(measured: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row per (lang, source): the count and a KLL sketch per measure of its
    documents that pass the base rule.  Sketches are built map-side and merged,
    whatever the group's size."""
    # Not a filter: moved below the measures, it would repeat them.
    cols = shares() | {c: F.col(c).cast("double") for c in ("n_words", "n_lines")}
    return measured.groupBy("lang", "source").agg(
        F.count_if(~base_failed()).alias("n"),
        *[F.kll_sketch_agg_double(F.when(~base_failed(), cols[c]), k).alias(c) for c in SKETCHED])


def thresholds(sketched: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, <measure>_hi, <measure>_lo) from the sketches; small
    groups take the merged sketch of their language, then the overall one."""
    def merged(by: list[str], tag: str) -> DataFrame:
        return sketched.groupBy(*[F.col(c).alias(f"{tag}_{c}") for c in by]).agg(
            F.sum("n").alias(f"{tag}_n"),
            *[F.kll_merge_agg_double(c).alias(f"{tag}_{c}") for c in SKETCHED])
    by_lang, overall = merged(["lang"], "l"), merged([], "a")
    t = (sketched.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
         .join(F.broadcast(overall), F.lit(True), "left"))  # one row

    def quantile(name: str, at: float) -> Column:
        sk = (F.when(F.col("n") >= min_group, F.col(name))
              .when(F.col("l_n") >= min_group, F.col(f"l_{name}")).otherwise(F.col(f"a_{name}")))
        return F.when(F.kll_sketch_get_n_double(sk) > 0, F.kll_sketch_get_quantile_double(sk, F.lit(at)))
    out = [F.col("lang"), F.col("source")]
    for f in FENCES:
        lo, hi = quantile(f.name, f.tail), quantile(f.name, 1 - f.tail)
        room = f.spread * F.greatest(hi - lo, 1 / quantile(f.per, f.short))
        out.append((hi + room).alias(f"{f.name}_hi"))
        if f.lower:
            out.append((lo - room).alias(f"{f.name}_lo"))
    return t.select(*out)


def _passes(prefix: str = "", limits: str = "") -> Column:
    """Whether all measures lie within the joined limits."""
    cols, ok = shares(prefix), F.lit(True)
    for f in FENCES:
        ok = ok & F.coalesce(cols[f.name] <= F.col(f"{limits}{f.name}_hi"), F.lit(True))
        if f.lower:
            ok = ok & F.coalesce(cols[f.name] >= F.col(f"{limits}{f.name}_lo"), F.lit(True))
    return ok


def judge(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, the measures, base_failed and kept for every document.  The
    measures are written once to the shared folder, as both the sketches and
    the filter read them."""
    m = materialize(measure(docs.select("doc_id", "lang", "source", "text")).drop("text"), "quality")
    t = thresholds(sketches(m), min_group)
    t = t.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"),
                 *[c for c in t.columns if c not in ("lang", "source")])
    j = m.join(t, m["lang"].eqNullSafe(t["t_lang"]) & m["source"].eqNullSafe(t["t_source"]), "left")
    failed = base_failed()
    return j.select("doc_id", *MEASURES, failed.alias("base_failed"), (~failed & _passes()).alias("kept"))


def filter_documents(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged.  The thresholds
    (one row per language and source) are written first; texts are never
    shuffled when that table is small enough for the optimizer to broadcast."""
    small = measure(docs.select("doc_id", "lang", "source", "text")).drop("text")
    t = materialize(thresholds(sketches(small), min_group), "thresholds")
    t = t.select(*[F.col(c).alias(f"__q_{c}") for c in t.columns])
    j = measure(docs, "__q_").join(t, docs["lang"].eqNullSafe(t["__q_lang"])
                                   & docs["source"].eqNullSafe(t["__q_source"]), "left")
    # One term over both sides of the join: split at an AND, its left part would be
    # moved below the measures and repeat them.
    out = F.greatest(base_failed("__q_").cast("int"), (~_passes("__q_", "__q_")).cast("int"))
    return j.filter(out == 0).select(*[docs[c] for c in docs.columns])


@register("op10_quality_rules")
def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    d = judge(documents(spark, sf_dir))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept")
