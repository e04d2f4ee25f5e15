import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid

SF = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def predicted(spark):
    docs = spark.read.parquet(SF)
    return langid.predict_languages(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()


def test_held_out_accuracy_and_calibration(predicted):
    held = [r for r in predicted if r.held_out]
    assert len(held) > 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in predicted)
    assert all(0 <= r.score <= 1 for r in predicted)
    right = [r.lang == r.lang_pred for r in held if r.n_chars >= 40]
    assert np.mean(right) >= 0.98
    accepted = [r.lang == r.lang_pred for r in held if r.accepted]
    assert len(accepted) > 0.8 * len(held) and np.mean(accepted) >= 0.98


def test_only_text_counts(spark):
    docs = spark.read.parquet(SF)
    model = langid.fit_languages(docs)
    some = docs.filter("doc_id < 60")
    other = some.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 10_000})
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict_languages(some, model).collect()}
    b = {r.doc_id - 10_000: (r.lang_pred, r.score) for r in langid.predict_languages(other, model).collect()}
    assert a == b


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.read.parquet(SF)
    noisy = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    one, two = langid.fit_languages(docs), langid.fit_languages(noisy)
    assert one.languages == two.languages and np.array_equal(one.logits, two.logits)


def test_subwords_in_runs_equal_the_whole(monkeypatch):
    rng = random.Random(0)
    text = "".join(rng.choice("abc éß日 .1") for _ in range(700))
    whole = np.sort(np.concatenate(list(langid.subwords(text))))
    monkeypatch.setattr(langid, "_PIECE", 64)
    assert np.array_equal(np.sort(np.concatenate(list(langid.subwords(text)))), whole)
    assert not list(langid.subwords("12 .,!")) and not list(langid.subwords(""))


def test_nulls_no_letters_repeated_rows_and_empty_tables(spark, make_docs):
    train = make_docs(["der die das und nicht"] * 40, "de", ids=range(40)).union(make_docs(["the and of that with"] * 40, "en", ids=range(40, 80)))
    model = langid.fit_languages(train)
    docs = make_docs([None, "", "123 !!", "the of", "the of", "und " * 50_000, "x"], ids=[1, 2, 3, 4, 4, 5, None])
    docs = docs.withColumns({"score": F.lit("s"), "lang_pred": F.lit(1)})
    rows = langid.predict_languages(docs, model).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 7 and all((got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False) for i in (1, 2, 3))
    assert got[4].lang_pred == "en" and got[5].lang_pred == "de" and got[None].held_out is False
    assert langid.predict_languages(docs.limit(0), model).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict_languages(unlabelled).collect()} == {"und"}


def test_more_than_200_languages_are_all_learned(spark, monkeypatch):
    rows = [(i, f"{chr(0x4E00 + i % 230) * 3} {chr(0x4E00 + i % 230) * 4}", f"l{i % 230:03d}") for i in range(230 * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.fit_languages(docs).languages == [f"l{k:03d}" for k in range(230)]
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 229)
    with pytest.raises(ValueError):
        langid.fit_languages(docs)


def test_a_repeated_document_sends_one_row_to_the_driver(spark, monkeypatch):
    """3,000 rows of one id: equal texts are one row of the sample, different ones are drawn as any others."""
    plain = [(i, f"the of and {i}", "en") for i in range(300)]
    seen = []
    real = langid.train
    monkeypatch.setattr(langid, "train", lambda samples, *a: seen.append(len(samples)) or real(samples, *a))
    for hot in ([(3, "same words here", "en")] * 3000, [(3, f"own words {i}", "en") for i in range(3000)]):
        docs = spark.createDataFrame(plain + hot, "doc_id long, text string, lang string")
        langid.fit_languages(docs, max_sample=10)
    assert all(n <= 2 * langid.LEAST_SAMPLE for n in seen) and len(seen) == 2
