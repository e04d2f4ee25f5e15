import math
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality_rules as Q
from tests.util import canon


def counts_of(text):
    """Plain Python version of the base counts."""
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    places = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(places))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_the_oracle(spark, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(folder, t)}.parquet')")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    df = Q.judge_documents(docs, labels)
    res = con.execute(Q.oracle_sql())
    cols = [c[0] for c in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, res.fetchall())


def test_base_counts_of_odd_texts(spark, make_docs):
    long = " ".join(f"w{i % 997}" for i in range(2500))
    texts = [
        None, "", " \n\t\x0b\x0c\r ", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 40, "x\xa0y z w q r s",
        "l1 a\nl1 a\n\n\n l2\nl1 a\r", "# * $ % & | < > !", "ÄÖÜ ßß 日本 𠮷 " * 4, "a b c d e f a b c d e g", long, "A" * 50_000,
    ]
    docs = make_docs(texts).withColumns({"n_words": F.lit("clash"), "row": F.lit(1), "placed": F.lit(2)})
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in Q.judge_documents(docs, labels).collect()}
    for i, t in enumerate(texts):
        r, want = got[i], counts_of(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r.kept == (not r.base_failed)


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10, 0.1), (3, 200, 0.05), (0, 1, 0.5), (40, 6000, 0.01), (5, 2000, 0.0083), (900, 100_000, 0.01)]
    for k, n, rate in cases:
        got = spark.range(1).select(Q.binomial_tail(f"{k}L", f"{n}L", rate)).first()[0]
        log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate) for i in range(k + 1)]
        assert got == pytest.approx(sum(math.exp(x) for x in log), rel=1e-6)
    assert spark.range(1).select(Q.binomial_tail("30L", "200L", 0.05)).first()[0] == 1


def test_certified_cutoffs_reject_bad_and_keep_good(spark, make_docs):
    clean = [" ".join(f"word{i}x{j}" for j in range(14)) for i in range(1500)]
    dirty = [" ".join(f"w#{i}#{j}##" for j in range(14)) for i in range(150)]
    docs = make_docs(clean + dirty).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))  # a null stratum too
    labels = spark.createDataFrame([(i, int(i < 1500), 0) for i in range(1650)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: (r.kept, r.failed_rules) for r in Q.judge_documents(docs, labels).collect()}
    assert all(out[i] == (True, "") for i in range(1500))
    assert all(not out[i][0] and "symbols" in out[i][1] for i in range(1500, 1650))
    few = labels.filter("doc_id < 30 or doc_id >= 1600")  # too few good labels certify nothing
    assert Q.judge_documents(docs, few).filter("not kept").count() == 0
    kept = Q.drop_rejected(docs.withColumn("stratum", F.lit("s")), labels)
    assert kept.count() == 1500 and kept.columns == [*docs.columns, "stratum"]


def test_repeated_rows_null_ids_and_empty_table(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(12))
    docs = make_docs([text, text, None], ids=[1, 1, None])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    rows = sorted((str(r.doc_id), r.n_words, r.kept) for r in Q.judge_documents(docs, labels).collect())
    assert rows == [("1", 12, True), ("1", 12, True), ("None", 0, False)]
    assert Q.judge_documents(docs.limit(0), labels).count() == 0
    assert Q.drop_rejected(docs, labels.limit(0)).count() == 2


def test_main_path_is_native(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plan = Q.judge_documents(documents, labels)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
