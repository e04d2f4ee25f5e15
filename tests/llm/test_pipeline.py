"""The pipeline against a plain Python version of its stages, each judged on its own input."""

import hashlib
import struct

import public_tokenizers
import sentencepiece

import __spark_entry__ as E
import corpus_pipeline
from tessera.llm import secrets_forest
from tests.llm import test_decontaminate, test_minhash, test_quality_rules


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_are_registered_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "sentencepiece",
    ]
    assert E.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


def test_every_stage_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        after = rows_of(docs)
        if name == "quality_rules":  # too few labels here to certify a cutoff: the base rules alone
            bad = {i for i, r in before.items() for c in [test_quality_rules.counts_of(r.text)] if c[0] < 10 or 100 * c[4] > 20 * c[0]}
            assert bad and set(after) == set(before) - bad
        elif name == "minhash_near_dedup":
            want = test_minhash.brute_force(sorted((i, r.text) for i, r in before.items()))
            assert set(after) == {i for i, (_, c) in want.items() if c == i} and len(after) < len(before)
        elif name == "benchmark_decontamination":
            want = test_decontaminate.brute_force([(i, r.text) for i, r in before.items()], bench)
            assert set(after) == {r[0] for r in want if not r[-1]}
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert all(after[i].text == before[i].text or secrets_forest.MASK in after[i].text for i in before)
        else:
            for i, r in before.items():
                ids = library.encode(r.text or "", add_bos=True, add_eos=True)
                assert after[i].n_tokens == len(ids)
                assert after[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
                assert after[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        if name != "sentencepiece":
            assert docs.columns == columns
    whole = rows_of(corpus_pipeline.run(spark, sf_dir))
    assert whole == after
