import random

from pyspark.sql import functions as F

from tessera.llm.components import connected_components
from tessera.llm.minhash import drop_near_duplicates, near_duplicates


def shingle_set(text, k=5):
    words = (text or "").encode().lower().split()
    n = min(k, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def brute_force(docs):
    """{doc_id: (n_shingles, component)} with every pair compared."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, (i, x) in enumerate(sets):
        for j, y in sets[p + 1 :]:
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: (len(s), find(i)) for i, s in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_whole_table_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    df = near_duplicates(documents)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(df) == brute_force(rows)
    assert df.filter("kept != (doc_id = component_id)").count() == 0


def test_chained_copies_and_edge_texts(make_docs):
    rng = random.Random(5)
    texts = [None, "", "  \n", "One two", "one TWO", "one two three four five", "ÄB äb", "äb äb"]
    for _ in range(4):
        base = [f"w{rng.randrange(400)}" for _ in range(120)]
        texts += family(rng, base, 25, 7)
    texts += ["same " * 3000] * 3 + [" ".join(f"v{i}" for i in range(30000))] * 2
    rng.shuffle(texts)
    docs = make_docs(texts)
    assert result(near_duplicates(docs, block=8)) == brute_force(list(enumerate(texts)))


def test_bucket_of_several_components_is_compared_in_full(make_docs):
    """Members far from both ends of their bucket, close to each other."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for c in range(6):
        words = list(base)
        for i in rng.sample(range(200), 6):
            words[i] = f"c{c}x{i}"
        texts += family(rng, words, 6, 2)
    rng.shuffle(texts)
    docs = make_docs(texts)
    # few bands of one minimum: large buckets that hold several components
    assert result(near_duplicates(docs, bands=60, rows=1, block=4)) == brute_force(list(enumerate(texts)))


def test_repeated_rows_null_ids_extra_columns_and_empty_table(make_docs):
    text = "a b c d e f g h"
    docs = make_docs([text, text, "other words here", text, None], ids=[3, 3, 2, None, 7])
    docs = docs.withColumns({"component_id": F.lit(9), "kept": F.lit("no"), "node": F.lit(1), "key": F.lit("k")})
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_duplicates(docs).collect())
    assert got == [("2", 1, "2", True), ("3", 4, "3", True), ("3", 4, "3", True), ("7", 0, "7", True), ("None", 4, "None", True)]
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 5
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, rng.randrange(8, 90)) for _ in range(200)] + [(5, 5), (None, 4), (160, 3)]
    rng.shuffle(links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {3} and got[3] == 3
    assert all(v == 7 for k, v in got.items() if 7 <= k < 90) and 5 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
