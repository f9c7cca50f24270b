"""The pipeline's stages against brute force, each on what its predecessor kept."""

import hashlib

import pytest

import corpus_pipeline
from millrace.llm import mixing, pii, quality
from millrace.llm.queries import tokenizer_path

from .test_operators import brute_components, docs, empty, texts  # noqa: F401


def test_stage_by_stage(spark, docs, texts, tmp_path):  # noqa: F811
    import sentencepiece

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_dedup", "pii_pseudonyms", "mixing", "sentencepiece"]
    kept, d = {}, docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, "").write.parquet(f"{tmp_path}/{n}")
        d = spark.read.parquet(f"{tmp_path}/{n}")
        kept[name] = d.collect()
        if n < 4:
            assert d.columns == docs.columns
    good = [(i, t, *x) for i, t, *x in texts if quality.first_rejection(quality.Document(t), quality.RULES) is None]
    assert sorted(r.doc_id for r in kept["quality_rules"]) == sorted(i for i, *_ in good)
    one = {i for i, _, _, k in brute_components(good, 5, 80) if k}
    assert {r.doc_id for r in kept["minhash_dedup"]} == one
    p = pii.Pseudonyms(pii.DEMO_KEY)
    text = {i: t for i, t, *_ in good}
    assert {(r.doc_id, r.text) for r in kept["pii_pseudonyms"]} == {(i, p.text(text[i])[0]) for i in one}
    before = spark.read.parquet(f"{tmp_path}/2")
    times = {r.doc_id: r.taken // max(1, r["size"]) for r in mixing.mix_report(before).collect()}
    counts = {}
    for r in kept["mixing"]:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    distinct = [r.doc_id for r in kept["pii_pseudonyms"]]
    assert all(counts.get(i, 0) == times[i] for i in times if distinct.count(i) == 1)
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    want = sorted(hashlib.sha256(" ".join(map(str, sp.encode(r.text, add_eos=True))).encode()).hexdigest() for r in kept["mixing"])
    assert sorted(r.ids_sha256 for r in kept["sentencepiece"]) == want


@pytest.mark.parametrize("n", range(5))
def test_stages_take_empty_tables(spark, empty, n):  # noqa: F811
    assert corpus_pipeline.STAGES[n][1](spark, empty, "").count() == 0
