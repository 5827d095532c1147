import math
import os
import sys
import uuid
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from stayline.llm import exact_dedup, mixing, prob_minhash, quality  # noqa: E402
from stayline.session import ensure_checkpoint_dir  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_apply_the_operators(spark, sample):
    """Each stage's rows are those that its operator keeps of the stage before."""
    docs, root = sample, f"{ensure_checkpoint_dir(spark)}/stages-{uuid.uuid4().hex}"
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        before, docs = docs, spark.read.parquet(f"{root}/{name}")
        seen[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == sample.columns

    def ids(d):
        return sorted(r.doc_id for r in d.select("doc_id").collect())
    before, after = seen["quality"]
    assert ids(after) == ids(quality.judge(before).filter("kept"))
    before, after = seen["exact"]
    assert ids(after) == ids(exact_dedup.mark(before).filter("kept")) and len(ids(after)) < len(ids(before))
    before, after = seen["near"]
    assert ids(after) == ids(prob_minhash.near_duplicates(before).filter("kept"))
    before, after = seen["mix"]
    # Whole copies, taken / size rounded down or up, with remainders carried along each source.
    copies = Counter(ids(after))
    rows = mixing.mixed(before).collect()
    for r in rows:
        share = r.taken / r["size"]
        assert math.floor(share - 1e-4) <= copies[r.doc_id] <= math.ceil(share + 1e-4)
    for s in {r.source_no for r in rows}:
        own = [r for r in rows if r.source_no == s]
        assert abs(sum(copies[r.doc_id] - r.taken / r["size"] for r in own)) < 1.01
    before, after = seen["tokens"]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert r.ids == t.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_stages_take_empty_tables(spark, sample):
    docs = sample.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = docs if name == "tokens" else out


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 50 and out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
