"""The pipeline's stages against brute force over one small table."""

import collections

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from pressledger.llm import mixing, toxicity
from pressledger.llm.pretokens import vocabulary
from tests.llm.test_operators import base_secrets, brute_components


def test_stages_keep_their_promises(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = (before, docs)
        assert name == "packing" or docs.columns == before.columns

    before, after = seen["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{small}/labels.parquet"))
    scores = {r.doc_id: r.predicted for r in toxicity.score_toxicity(before, model).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, bad in scores.items() if not bad)

    before, after = seen["near_duplicates"]
    want = brute_components([(r.doc_id, r.text) for r in before.collect()], 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, c) in want.items() if i == c)

    before, after = seen["secrets"]
    old = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert (r.text == old[r.doc_id]) == (not base_secrets(old[r.doc_id] or "")) or "[random]" in r.text
        assert not base_secrets(r.text or "") and r.n_chars == len(r.text)

    before, after = seen["mixing"]
    times = collections.Counter(r.doc_id for r in after.collect())
    for r in mixing.mix_sources(before).collect():
        assert times[r.doc_id] * r["size"] == r.taken

    before, after = seen["packing"]
    tok, ids = Tokenizer.from_file(vocabulary()), collections.Counter()
    for r in before.collect():
        ids.update([*tok.encode(r.text or "", add_special_tokens=False).ids, 0])
    packed = collections.Counter()
    for p in after.collect():
        packed.update(np.frombuffer(p.ids, dtype="<u4").tolist())
    assert packed == ids


def test_run_returns_the_last_stage(spark, small):
    assert corpus_pipeline.run(spark, small).columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
