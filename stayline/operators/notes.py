"""Note segmentation and sentence splitting (D08: N01-N10).

All rules are column expressions.  The segmentation rules (N01-N06) put a mark
at every place where a segment begins and the note is split at the marks;
numbered items and one-line answers, which depend on their neighbours, are
decided on the array of pieces with higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Patterns of the rules.
DEID_PATTERN = r"(?i)\[\*\*.{0,15}.*?\*\*\]"
SENT_BREAK = "\u0001"
SEGMENT_BREAK = "\u0002"
# The header lines that open a note, and the title words that may be lower-case.
HEADER_LINES = (("Admission Date:", "Discharge Date:"), ("Date of Birth:", "Sex:"))
# A title: words that begin with a capital, "of", "on", "or" or a remark in
# parentheses, up to a colon; "Disp:" is none.
TITLE = r"(?!Disp[ ]*:)\p{Lu}[^\s:]*(?:[ \t]+(?:of|on|or|\([^):\n]*\)|\p{Lu}[^\s:]*))*[ \t]*:"


# ------------------------------------------------------------ native part
def isolate_rulers(text: Column) -> Column:
    """Runs of 3+ '-' / '_' become their own block; blank runs collapse."""
    t = F.regexp_replace(text, r"---+", "\n\n-----\n\n")
    t = F.regexp_replace(t, r"___+", "\n\n_____\n\n")
    return F.regexp_replace(t, r"\n\n+", "\n\n")


def blocks(text: Column) -> Column:
    """Blank-line separated blocks, as an array."""
    return F.split(isolate_rulers(text), "\n\n")


def deid_spans(text: Column) -> Column:
    """The de-identification spans ``[** ... **]`` of a note."""
    return F.regexp_extract_all(text, F.lit(DEID_PATTERN), 0)


def mark_sentence_starts(text: Column) -> Column:
    """A sentence starts after '.' + space before a title-case token (a
    capital of any script and something else), and after a stand-alone '-'
    before a token that is not another '-'."""
    t = F.regexp_replace(text, r"\.\s+(\p{Lu}\P{Lu})", "." + SENT_BREAK + "$1")
    return F.regexp_replace(t, r"(\s)-\s+([^\s-])", "$1-" + SENT_BREAK + "$2")


def sentences(text: Column) -> Column:
    """N07 + N09: sentence array; newlines inside a sentence become spaces and
    blank sentences are dropped."""
    parts = F.split(mark_sentence_starts(text), SENT_BREAK)
    flat = F.transform(parts, lambda s: F.trim(F.regexp_replace(s, "\n", " ")))
    return F.filter(flat, lambda s: F.length(s) > 0)


def explode_indexed(df: DataFrame, keys: list[str], arr: Column, idx: str, val: str) -> DataFrame:
    """One row per element with its 0-based position (N10 output shape)."""
    return df.select(*keys, F.posexplode(arr).alias(idx, val))


def flattened_note(text: Column) -> Column:
    """One sentence per line (the reference writes each followed by '\\n')."""
    return F.concat(F.array_join(sentences(text), "\n"), F.lit("\n"))


# ------------------------------------------------------------ segments
def is_title(segment: Column) -> Column:
    """Whether a whole segment is a title (``Past Medical History:``)."""
    return segment.rlike("^" + TITLE + "$")


def mark_headers(text: Column) -> Column:
    """The note's opening lines ``Admission Date: a Discharge Date: b`` and
    ``Date of Birth: c Sex: d`` (in this order, either may be missing) become
    four parts each."""
    blank = r"\A((?:[^\x02\n]*\x02)*\s*)"
    for first, second in HEADER_LINES:
        line = blank + f"({first})([^\\n]*?)({second})([^\\n]*)"
        text = F.regexp_replace(text, line, SEGMENT_BREAK.join(["$1$2", "$3", "$4", "$5", ""]))
    return text


def mark_titles(text: Column) -> Column:
    """A title at the start of a line is a part of its own, and what follows it another one."""
    return F.regexp_replace(text, "(?m)^[ \\t]*(" + TITLE + ")", SEGMENT_BREAK + "$1" + SEGMENT_BREAK)


def split_items(part: Column) -> Column:
    """Lines that begin with a number and a period start a part of their
    own where the number follows on the one before or the next follows on it."""
    pieces = F.split(F.regexp_replace(part, r"(?m)^([ \t]*[0-9]+\.)", SEGMENT_BREAK + "$1"), SEGMENT_BREAK)
    numbers = F.transform(pieces, lambda p: F.regexp_extract(p, r"\A[ \t]*([0-9]{1,9})\.", 1).try_cast("int"))
    pairs = F.arrays_zip(pieces.alias("p"), numbers.alias("k"),
                         F.concat(F.array(F.lit(None).cast("int")), F.slice(numbers, 1, F.size(numbers) - 1)).alias("before"),
                         F.concat(F.slice(numbers, 2, F.size(numbers)), F.array(F.lit(None).cast("int"))).alias("after"))

    def placed(acc: Column, x: Column) -> Column:
        starts = F.coalesce(x["k"] == x["before"] + 1, F.lit(False)) | F.coalesce(x["after"] == x["k"] + 1, F.lit(False))
        return F.concat(acc, F.when(starts, F.lit(SEGMENT_BREAK)).otherwise(F.lit("")), x["p"])
    return F.split(F.aggregate(pairs, F.lit(""), placed), SEGMENT_BREAK)


def join_answers(parts: Column) -> Column:
    """A one-line part after a title rejoins it, if a title or the note's end follows."""
    nothing = F.array(F.lit(None).cast("string"))
    near = F.arrays_zip(parts.alias("p"), F.concat(nothing, F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("before"),
                        F.concat(F.slice(parts, 2, F.size(parts)), nothing).alias("after"))
    flagged = F.transform(near, lambda x: F.struct(
        x["p"].alias("p"), x["before"].alias("before"),
        (F.coalesce(is_title(x["before"]), F.lit(False)) & ~is_title(x["p"]) & ~x["p"].contains("\n")
         & F.coalesce(is_title(x["after"]), F.lit(True))).alias("answer")))
    # An answer takes its title's place; the title before it goes.
    kept = F.filter(F.arrays_zip(flagged.alias("x"), F.concat(
        F.slice(F.transform(flagged, lambda x: x["answer"]), 2, F.size(flagged)), F.array(F.lit(False))).alias("taken")),
        lambda z: ~z["taken"] & z["x"]["p"].isNotNull())  # no parts: one empty row
    return F.transform(kept, lambda z: F.when(z["x"]["answer"], F.concat(z["x"]["before"], F.lit(" "), z["x"]["p"]))
                       .otherwise(z["x"]["p"]))


def segment_notes(notes: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, seg_idx, segment).  A NULL note has no segments, and
    neither has one of white space only.  The steps are columns of their own,
    as each refers to the one before several times."""
    marked = mark_titles(mark_headers(isolate_rulers(F.col(text))))
    d = notes.select(F.col(key), F.split(marked, SEGMENT_BREAK + "|\n\n").alias("__parts"))
    d = d.withColumn("__parts", F.flatten(F.transform("__parts", split_items)))
    d = d.withColumn("__parts", F.filter(F.transform("__parts", lambda p: F.regexp_replace(p, r"\A\s+|\s+\z", "")),
                                         lambda p: p != ""))
    d = d.withColumn("__parts", join_answers(F.col("__parts")))
    return explode_indexed(d, [key], F.col("__parts"), "seg_idx", "segment")


def note_sentences(segments: DataFrame, keys: list[str], text: str = "segment") -> DataFrame:
    """N07-N09 on each segment: (keys, sent_idx, sentence)."""
    return explode_indexed(segments, keys, sentences(F.col(text)), "sent_idx", "sentence")


# ------------------------------------------------------------ abbreviations
# White space, and a word (in opening marks) with or without a period behind it.
BLANKS = r"[ \t\n\r\f]+"
WORD = r"^[(\[\"']*(\p{L}+(?:\.\p{L}+)*)\.?$"
#: How often an abbreviation has its period, and the score from which a word is one (Kiss and Strunk 2006).
WITH_PERIOD = 0.99
ABBREVIATION_SCORE = 0.3


def last_word(text: Column) -> Column:
    """The last word of a text, in lower case, without its period; empty if there is none."""
    return F.lower(F.regexp_extract(F.element_at(F.split(text, BLANKS), -1), WORD, 1))


def abbreviations(notes: DataFrame, text: str = "text") -> DataFrame:
    """(word, n, n_period, n_before_lower, score, abbreviation) of every word
    that stands before a period.

    The score is the log-likelihood ratio of "the word has its period almost
    always" to "as often as any word", lessened by the word's length and by
    each occurrence without a period, and raised by periods within the word and
    by each period before a lower-case word, which ends no sentence.  A NULL
    text has no words; ties and repeated notes count as they stand."""
    parts = F.split(F.col(text), BLANKS)
    after = F.concat(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")))
    d = notes.select(F.explode(F.arrays_zip(parts.alias("part"), after.alias("after"))).alias("x"))
    d = d.select(F.lower(F.regexp_extract("x.part", WORD, 1)).alias("word"), F.col("x.part").endswith(".").alias("period"),
                 F.col("x.after").rlike(r"^\p{Ll}").alias("lower")).filter("word <> ''")
    per = d.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if("period").alias("n_period"),
                                F.count_if(F.col("period") & F.col("lower")).alias("n_before_lower"))
    base = per.agg(F.least(F.greatest(F.sum("n_period") / F.sum("n"), F.lit(1e-9)), F.lit(WITH_PERIOD)).alias("base"))
    per = per.filter("n_period > 0").crossJoin(F.broadcast(base))  # one row
    with_, without = F.col("n_period"), F.col("n") - F.col("n_period")
    ratio = 2 * (with_ * F.log(F.lit(WITH_PERIOD) / F.col("base"))
                 + without * F.log(F.lit(1 - WITH_PERIOD) / (1 - F.col("base"))))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    score = (ratio * F.exp(-letters) * (F.length("word") - letters + 1) * F.pow(letters, -without)
             * (1 + F.col("n_before_lower")))
    return per.select("word", "n", "n_period", "n_before_lower", F.round(score, 4).alias("score"),
                      (F.round(score, 4) >= ABBREVIATION_SCORE).alias("abbreviation"))


def learned_sentences(notes: DataFrame, keys: list[str], known: DataFrame, text: str = "text") -> DataFrame:
    """N07 with the abbreviations of ``known`` (word): (keys, sent_idx,
    sentence), where no sentence ends with one of them and its period.
    ``keys`` identify a note."""
    d = explode_indexed(notes, keys, sentences(F.col(text)), "__at", "__part")
    d = d.withColumn("__word", F.when(F.col("__part").endswith("."), last_word(F.col("__part"))))
    d = d.join(known.select(F.col("word").alias("__word"), F.lit(1).alias("__open")).distinct(), "__word", "left")
    order = Window.partitionBy(*keys).orderBy("__at")
    # Sentences before this one that end at a true period.
    d = d.withColumn("sent_idx", F.count(F.when(F.col("__open").isNull(), 1)).over(
        order.rowsBetween(Window.unboundedPreceding, -1)).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct("__at", "__part")))
    return d.groupBy(*keys, "sent_idx").agg(F.array_join(F.transform(parts, lambda x: x["__part"]), " ").alias("sentence"))


def notes_in_stays(notes: DataFrame, stays: DataFrame, join_key: str = "hadm_id") -> DataFrame:
    """J23 + P08: notes joined to their stays, kept when the note's date OR its
    time is not after the stay's end (a NULL in one side is tolerated); notes
    marked as errors are dropped."""
    d = notes.join(stays.select(join_key, "icustay_id", "outtime"), join_key, "inner")
    if "iserror" in notes.columns:
        d = d.filter(F.col("iserror").isNull())
    bound = F.coalesce(F.col("chartdate") <= F.col("outtime"), F.lit(False)) | \
        F.coalesce(F.col("charttime") <= F.col("outtime"), F.lit(False))
    return d.filter(bound).drop("outtime")
