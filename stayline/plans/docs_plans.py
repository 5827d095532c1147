"""Note operators bound to ``documents.text``: whole texts, every document."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayline.operators import notes as N
from stayline.plans.registry import register
from stayline.sources.tables import table

_MARK = ("regexp_replace(regexp_replace(text, '\\.\\s+(\\p{Lu}\\P{Lu})', '.' || chr(1) || '\\1', 'g'), "
         "'(\\s)-\\s+([^\\s-])', '\\1-' || chr(1) || '\\2', 'g')")
_SENTS = f"list_filter(list_transform(string_split({_MARK}, chr(1)), lambda x: trim(replace(x, chr(10), ' '))), lambda x: length(x) > 0)"


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@register("note_blocks", """
SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS block_idx, unnest(l) AS block FROM (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(regexp_replace(text, '---+', chr(10) || chr(10) || '-----' || chr(10) || chr(10), 'g'),
         '___+', chr(10) || chr(10) || '_____' || chr(10) || chr(10), 'g'), '\\n\\n+', chr(10) || chr(10), 'g'), chr(10) || chr(10)) AS l
  FROM documents)""")
def q_note_blocks(spark, sf):
    """Rulers isolated, blank-line blocks exploded with their position."""
    d = docs(spark, sf)
    return N.explode_indexed(d, ["doc_id"], N.blocks(F.col("text")), "block_idx", "block")


@register("note_sentences", f"""
SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS sent_idx, unnest(l) AS sentence
FROM (SELECT doc_id, {_SENTS} AS l FROM documents)""")
def q_note_sentences(spark, sf):
    """N07 + N09: rule-based sentence split of every whole document."""
    d = docs(spark, sf)
    return N.explode_indexed(d, ["doc_id"], N.sentences(F.col("text")), "sent_idx", "sentence")


@register("note_flat", f"""
SELECT doc_id, array_to_string({_SENTS}, chr(10)) || chr(10) AS text FROM documents""")
def q_note_flat(spark, sf):
    """Each note rewritten as one flattened sentence per line."""
    d = docs(spark, sf)
    return d.select("doc_id", N.flattened_note(F.col("text")).alias("text"))


_BLANKS = "'[ \\t\\n\\r\\f]+'"
_WORD = "'^[(\\[\"'']*(\\p{L}+(?:\\.\\p{L}+)*)\\.?$'"
_ABBREVIATIONS = f"""
part AS (SELECT unnest(l) AS p, unnest(list_append(l[2:], '')) AS after
  FROM (SELECT string_split_regex(text, {_BLANKS}) AS l FROM documents WHERE text IS NOT NULL)),
word AS (SELECT lower(regexp_extract(p, {_WORD}, 1)) AS word, p LIKE '%.' AS period, regexp_matches(after, '^\\p{{Ll}}') AS low
  FROM part WHERE regexp_extract(p, {_WORD}, 1) <> ''),
per AS (SELECT word, count(*) AS n, count(*) FILTER (period) AS n_period, count(*) FILTER (period AND low) AS n_before_lower
  FROM word GROUP BY word),
base AS (SELECT least(greatest(sum(n_period) / CAST(sum(n) AS DOUBLE), 1e-9), 0.99) AS base FROM per),
score AS (SELECT *, n - n_period AS without, length(replace(word, '.', '')) AS letters FROM per, base WHERE n_period > 0),
abbr AS (SELECT word, n, n_period, n_before_lower, round(2 * (n_period * ln(CAST(0.99 AS DOUBLE) / base)
    + without * ln((1 - CAST(0.99 AS DOUBLE)) / (1 - base))) * exp(-letters) * (length(word) - letters + 1)
    * pow(CAST(letters AS DOUBLE), -without) * (1 + n_before_lower), 4) AS score FROM score)"""


@register("note_abbreviations", f"""
WITH {_ABBREVIATIONS}
SELECT word, n, n_period, n_before_lower, score, score >= 0.3 AS abbreviation FROM abbr""")
def q_note_abbreviations(spark, sf):
    """Words before a period, counted and scored as abbreviations."""
    return N.abbreviations(docs(spark, sf))


@register("learned_sentences", f"""
WITH {_ABBREVIATIONS},
sent AS (SELECT doc_id, generate_subscripts(l, 1) AS k, unnest(l) AS s FROM (SELECT doc_id, {_SENTS} AS l FROM documents)),
open AS (SELECT doc_id, k, s, s LIKE '%.' AND lower(regexp_extract(string_split_regex(s, {_BLANKS})[-1], {_WORD}, 1)) IN (
  SELECT word FROM abbr WHERE score >= 0.3) AS is_open FROM sent),
numbered AS (SELECT *, CAST(count(*) FILTER (NOT is_open) OVER (
  PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INTEGER) AS sent_idx FROM open)
SELECT doc_id, sent_idx, string_agg(s, ' ' ORDER BY k) AS sentence FROM numbered GROUP BY doc_id, sent_idx""")
def q_learned_sentences(spark, sf):
    """Sentences that do not end at the corpus's own abbreviations."""
    d = docs(spark, sf)
    return N.learned_sentences(d, ["doc_id"], N.abbreviations(d).filter("abbreviation"))


@register("note_deid", """
SELECT doc_id, CAST(len(regexp_extract_all(text, '(?i)\\[\\*\\*.{0,15}.*?\\*\\*\\]')) AS INTEGER) AS n_deid FROM documents""")
def q_note_deid(spark, sf):
    """Number of de-identification spans per note."""
    d = docs(spark, sf)
    return d.select("doc_id", F.size(N.deid_spans(F.col("text"))).alias("n_deid"))


# Notes with headers, rulers, lists and inline titles, made of the conversations:
# one note per conversation, its turns in order as a titled section, a ruled
# list, or a title with a one-line answer.  The oracle states the segments that
# such a note has by construction.
_TURNS = """
WITH turn AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS k,
         'Said ' || trim(regexp_replace(regexp_replace(coalesce(text, ''), '[:_-]', '', 'g'), '\\s+', ' ', 'g')) AS said
  FROM conversations),
part AS (
  SELECT conv_id, -1 AS k, 0 AS i, 'Admission Date: A' || conv_id AS segment FROM turn WHERE k = 0
  UNION ALL SELECT conv_id, -1, 1, 'Discharge Date: D' || conv_id FROM turn WHERE k = 0
  UNION ALL SELECT conv_id, k, 0, 'History of Illness:' FROM turn WHERE k % 3 = 0
  UNION ALL SELECT conv_id, k, 1, trim(said) || chr(10) || 'and more' FROM turn WHERE k % 3 = 0
  UNION ALL SELECT conv_id, k, 0, '-----' FROM turn WHERE k % 3 = 1
  UNION ALL SELECT conv_id, k, 1, '1. ' || trim(said) FROM turn WHERE k % 3 = 1
  UNION ALL SELECT conv_id, k, 2, '2. done' FROM turn WHERE k % 3 = 1
  UNION ALL SELECT conv_id, k, 0, 'Status on Leaving: ' || trim(said) FROM turn WHERE k % 3 = 2),
seg AS (SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY k, i) - 1 AS INTEGER) AS seg_idx, segment FROM part)"""


def notes_of_conversations(spark, sf):
    """(conv_id, text): see above."""
    t = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    said = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "[:_-]", ""), r"\s+", " "))
    d = t.select("conv_id", (F.row_number().over(w) - 1).alias("k"), F.trim(F.concat(F.lit("Said "), said)).alias("said"))
    body = (F.when(F.col("k") % 3 == 0, F.concat(F.lit("History of Illness:\n"), "said", F.lit("\nand more\n")))
            .when(F.col("k") % 3 == 1, F.concat(F.lit("------\n1. "), "said", F.lit("\n2. done\n\n")))
            .otherwise(F.concat(F.lit("Status on Leaving: "), "said", F.lit("\n\n"))))
    rows = d.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("k", body.alias("b")))).alias("t"))
    head = F.concat(F.lit("Admission Date: A"), F.col("conv_id").cast("string"),
                    F.lit(" Discharge Date: D"), F.col("conv_id").cast("string"), F.lit("\n\n"))
    return rows.select("conv_id", F.concat(head, F.array_join(F.transform("t", lambda x: x["b"]), "")).alias("text"))


@register("note_segments", _TURNS + "\nSELECT conv_id, seg_idx, segment FROM seg")
def q_note_segments(spark, sf):
    """Header, ruler, list and inline-title segmentation of the conversations' notes."""
    return N.segment_notes(notes_of_conversations(spark, sf), "conv_id")


_SEG_SENTS = _SENTS.replace("regexp_replace(text,", "regexp_replace(segment,")


@register("segment_sentences", _TURNS + f"""
SELECT conv_id, seg_idx, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS sent_idx, unnest(l) AS sentence
FROM (SELECT conv_id, seg_idx, {_SEG_SENTS} AS l FROM seg)""")
def q_segment_sentences(spark, sf):
    """Segments of every note, each split into flattened sentences."""
    return N.note_sentences(N.segment_notes(notes_of_conversations(spark, sf), "conv_id"), ["conv_id", "seg_idx"])
