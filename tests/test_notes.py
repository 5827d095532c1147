"""Note segmentation rules (N01-N09) on inline fixtures."""

from pyspark.sql import functions as F

from stayline.operators.notes import abbreviations, is_title, learned_sentences, segment_notes, sentences


def segments(spark, text):
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [r.segment for r in segment_notes(d).orderBy("seg_idx").collect()]


def test_rulers_headers_lists_inline_titles(spark):
    text = ("Admission Date: 2100-01-01 Discharge Date: 2100-01-05\n\n"
            "Date of Birth: 2050-01-01 Sex: F\n\n"
            "Chief Complaint: chest pain\n\n"
            "History of Present Illness:\nfell at home.\n-----\nMedications on Admission:\n"
            "1. Aspirin\n2. Lasix\n3. Metoprolol\n\n"
            "Building: West\nCampus: East side\n\nDisp:\nnone")
    segs = segments(spark, text)
    # leading header lines split into parts, then one-line answers rejoin their title
    assert segs[:4] == ["Admission Date: 2100-01-01", "Discharge Date: 2100-01-05",
                        "Date of Birth: 2050-01-01", "Sex: F"]
    assert segs[4:7] == ["Chief Complaint: chest pain", "History of Present Illness:", "fell at home."]
    assert segs[7] == "-----"                                   # ruler isolated
    assert segs[8:12] == ["Medications on Admission:", "1. Aspirin", "2. Lasix", "3. Metoprolol"]
    # two headers in one block; the last answer stays apart (next segment is no title)
    assert segs[12:] == ["Building: West", "Campus:", "East side", "Disp:\nnone"]


def test_one_line_answer_rejoins_title(spark):
    assert segments(spark, "Indication:\n\nSource of embolism.\n\nHR (bpm):\n\n80") == [
        "Indication: Source of embolism.", "HR (bpm): 80"]


def test_lists_need_consecutive_numbers(spark):
    assert segments(spark, "intro\n1. a\n2. b\n4. c\n7. d\n8. e") == ["intro", "1. a", "2. b\n4. c", "7. d", "8. e"]
    assert segments(spark, "dose\n5. alone") == ["dose\n5. alone"]


def test_empty_notes_have_no_segments(spark):
    assert segments(spark, None) == [] and segments(spark, " \n\n ") == []


def test_is_title_rules(spark):
    want = {"Past Medical History:": True, "History of Present Illness:": True, "BP (mm Hg):": True, "Évolution:": True,
            "Disp:": False, "the end:": False, "No colon": False, "Two: parts": False}
    d = spark.createDataFrame([(t,) for t in want], "t string").select("t", is_title(F.col("t")).alias("y"))
    assert {r.t: r.y for r in d.collect()} == want


def test_sentence_split(spark):
    df = spark.createDataFrame([("Pt is stable. He ate.\nVitals - 120 over 80. USA trip. ",)], "t string")
    got = df.select(sentences(F.col("t"))).first()[0]
    assert got == ["Pt is stable.", "He ate.", "Vitals -", "120 over 80. USA trip."]  # no break before USA
    df = spark.createDataFrame([("Il est stable. Élodie va bien.",)], "t string")
    assert df.select(sentences(F.col("t"))).first()[0] == ["Il est stable.", "Élodie va bien."]


def test_notes_in_stays_time_bound(spark):
    from datetime import datetime
    from stayline.operators.notes import notes_in_stays
    notes = spark.createDataFrame(
        [(1, datetime(2100, 1, 1), None, None, "a"), (1, None, datetime(2100, 1, 3), None, "b"),
         (1, datetime(2100, 1, 9), datetime(2100, 1, 9), None, "c"), (1, datetime(2100, 1, 1), None, 1, "d")],
        "hadm_id long, chartdate timestamp_ntz, charttime timestamp_ntz, iserror int, text string")
    stays = spark.createDataFrame([(1, 10, datetime(2100, 1, 5))], "hadm_id long, icustay_id long, outtime timestamp_ntz")
    assert sorted(r.text for r in notes_in_stays(notes, stays).collect()) == ["a", "b"]


def test_planted_abbreviations_do_not_split(spark):
    rows = [(i, f"Seen by Dr. Smith today. The patient took 5 mg. of aspirin at home. Call Dr. Jones about the e.g. Lasix dose. "
                f"The patient is at home. Aspirin today helped Smith. The dose at home helped patient {i}.") for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "Dr. Alone")]
    notes = spark.createDataFrame(rows, "doc_id long, text string")
    table = {r.word: r for r in abbreviations(notes).collect()}
    assert {w for w, r in table.items() if r.abbreviation} == {"dr", "mg", "e.g"}
    assert (table["dr"].n, table["dr"].n_period, table["dr"].n_before_lower) == (81, 81, 0)
    assert table["mg"].n_before_lower == 40
    assert (table["home"].n, table["home"].n_period) == (120, 80) and not table["home"].abbreviation
    assert (table["smith"].n, table["smith"].n_period) == (80, 40)
    got = {}
    for r in learned_sentences(notes, ["doc_id"], abbreviations(notes).filter("abbreviation")).orderBy("doc_id", "sent_idx").collect():
        got.setdefault(r.doc_id, []).append((r.sent_idx, r.sentence))
    assert got[7] == list(enumerate([
        "Seen by Dr. Smith today.", "The patient took 5 mg. of aspirin at home.", "Call Dr. Jones about the e.g. Lasix dose.",
        "The patient is at home.", "Aspirin today helped Smith.", "The dose at home helped patient 7."]))
    assert got[103] == [(0, "Dr. Alone")] and 100 not in got and 102 not in got


def test_no_notes_have_no_abbreviations(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert abbreviations(none).count() == 0 and learned_sentences(none, ["doc_id"], abbreviations(none)).count() == 0
