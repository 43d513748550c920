import hashlib
import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from helpers import EXTRA, awkward, frame, words
from ledgerline.llm import op9_byte_bpe
from ledgerline.llm.common import stored
from test_op3_minhash import brute as classes
from test_op7_rules import base

SF = "/root/testdata/sf0.001"


def corpus():
    rng = random.Random(8)
    rows = [(*r, None) for r in awkward(rng)]  # without a language they do not shape the references
    passage = " ".join(f"shared{a}{b}" for a in "abcdef" for b in "abcde")
    for i in range(30):
        body = ". ".join(" ".join(rng.choice("the of and to in is that for it was on are".split()) if rng.random() < 0.5 else f"Item{rng.randrange(300)}" for _ in range(12)) for _ in range(6))
        rows.append((100 + i, body + (" " + passage if i % 10 == 0 else ""), "en"))
    return rows + [(200, rows[-1][1], "en"), (201, rows[-1][1] + " more", "en")]


def test_stages_in_order():
    numbers = {"quality_rules": 7, "near_duplicates": 3, "repeated_passages": 1, "benchmark_leaks": 2, "byte_pairs": 9}
    assert [numbers[name] for name, _ in corpus_pipeline.STAGES] == [7, 3, 1, 2, 9]


def test_stages_on_awkward_rows(spark):
    docs = frame(spark, corpus())
    stages = dict(corpus_pipeline.STAGES)
    kept = stored(stages["quality_rules"](spark, docs, SF), "t")
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert rows and not any(base(t)[5] for _, t in rows)
    one = stored(stages["near_duplicates"](spark, kept, SF), "t")
    assert one.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in one.collect()) == sorted({str(c) for _, c, _ in classes(rows)})
    cut = stored(stages["repeated_passages"](spark, one, SF), "t")
    before = {r["doc_id"]: r["text"] for r in one.collect()}
    after = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert cut.columns == docs.columns and before.keys() == after.keys()
    shared = [i for i in before if "sharedcc" in before[i]]
    assert [i for i in shared if "sharedcc" in after[i]] == [min(shared)]
    clean = stages["benchmark_leaks"](spark, cut, SF)
    assert clean.columns == docs.columns and clean.count() == cut.count()
    assert all(r[c] == f"{c}-{r['doc_id']}" for r in clean.collect() for c in EXTRA)
    done = stages["byte_pairs"](spark, clean, SF).collect()
    ranks = op9_byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(done) == len(after)
    for r in done:
        assert r["n_tokens"] == len(reference.encode_ordinary(after[r["doc_id"]]))
        assert r["decoded_sha256"] == hashlib.sha256(after[r["doc_id"]].encode()).hexdigest()


def test_stages_on_an_empty_table(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "t")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    total = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0 < out.count() < total 
