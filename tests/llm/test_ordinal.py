import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ordinal_quality as O


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    ratings = labels.select("doc_id", O.toxic_aware_grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return docs.select("doc_id", "text"), ratings


def test_held_out_selection(tables):
    docs, ratings = tables
    train = ratings.filter("doc_id % 4 != 0")
    model = O.fit_grades(docs, train)
    assert (np.diff(model.thresholds) > 0).all()
    held = ratings.filter("doc_id % 4 = 0")
    rows = O.grade_documents(docs.join(held.select("doc_id"), "doc_id"), model).join(held, "doc_id").collect()
    share = lambda g: np.mean([r.kept for r in rows if r.grade == g])
    assert share(2) >= 0.97 and share(1) <= 0.2 and share(0) <= 0.1
    mean = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)]
    assert mean[0] < mean[1] < mean[2]
    assert all(0 <= r.tail_prob <= 1 and r.tail_prob <= r.expected_grade + 1e-9 for r in rows)


def test_held_out_share_of_low_quality_that_is_kept(tables):
    docs, ratings = tables
    model = O.fit_grades(docs, ratings.filter("doc_id % 4 != 0"))
    held = ratings.filter("doc_id % 4 = 0 and grade < 2")
    rows = O.grade_documents(docs.join(held.select("doc_id"), "doc_id"), model).join(held, "doc_id").collect()
    for grade in (0, 1):
        assert np.mean([r.kept for r in rows if r.grade == grade]) <= 0.1


def test_shared_weights_and_ordered_thresholds():
    rng = random.Random(7)
    features, samples, grades = O.Features(), [], []
    for i in range(600):
        g = i % 3
        words = [rng.choice([f"good{j}" for j in range(5)] if rng.random() < g / 2 else [f"bad{j}" for j in range(5)]) for _ in range(60)]
        samples.append(features.of(" ".join(words).encode()))
        grades.append(g)
    model = O.train(samples, np.array(grades))
    assert model.thresholds[0] < model.thresholds[1]
    w = {n: model.weights[features.bucket(n)] for n in (b"good1", b"bad1")}
    assert w[b"good1"] > 0 > w[b"bad1"]


def test_grades_of_labels(spark):
    rows = spark.createDataFrame([(1, 0), (1, 1), (0, 0), (0, 1), (1, None), (None, 1)], "quality int, toxic int")
    got = [r[0] for r in rows.select(O.toxic_aware_grade(F.col("quality"), F.col("toxic"))).collect()]
    assert got == [2, 0, 1, 0, 2, None]


def test_nulls_repeated_rows_and_empty_tables(spark, make_docs):
    docs = make_docs([None, "", "!!", "fine words", "fine words", "long text " * 30_000], ids=[1, 2, 3, 4, 4, None])
    docs = docs.withColumns({"kept": F.lit("k"), "tail_prob": F.lit(1)})
    ratings = spark.createDataFrame([(4, 2), (4, 1), (1, 0), (None, 2), (3, None), (2, 9)], "doc_id long, grade int")
    rows = O.grade_documents(docs, O.fit_grades(docs, ratings)).collect()
    got = {r.doc_id: (r.expected_grade, r.tail_prob, r.kept) for r in rows}
    assert len(rows) == 6 and got[1] == got[2] == got[3] == (0.0, 0.0, False)
    assert O.grade_documents(docs.limit(0), O.fit_grades(docs, ratings)).count() == 0
    none = O.grade_documents(docs, O.fit_grades(docs, ratings.limit(0))).collect()
    assert {(r.doc_id, r.expected_grade, r.kept) for r in none if r.doc_id == 4} == {(4, None, True)}


def test_a_repeated_document_sends_one_row_to_the_driver(spark, monkeypatch):
    rows = [(i, f"good words {i}") for i in range(100)] + [(3, f"hot text {i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame([(i, i % 3) for i in range(100)], "doc_id long, grade int")
    seen = []
    real = O.train
    monkeypatch.setattr(O, "train", lambda samples, *a: seen.append(len(samples)) or real(samples, *a))
    O.fit_grades(docs, ratings, max_per_grade=10)
    O.fit_grades(docs, ratings, max_per_grade=1000)
    assert seen[0] <= 3 * 25 and seen[1] == 100
