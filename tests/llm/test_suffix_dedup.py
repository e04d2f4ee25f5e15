import random

from pyspark.sql import functions as F

from tessera.llm.suffix_dedup import repeated_passages


def brute_force(docs, length):
    """{doc_id: set of covered word places}: windows that occur in another document too."""
    where = {}
    words = [(i, t.encode().lower().split()) for i, t in docs if t and i is not None]
    for i, w in words:
        for p in range(len(w) - length + 1):
            where.setdefault(tuple(w[p : p + length]), set()).add(i)
    out = {}
    for i, w in words:
        for p in range(len(w) - length + 1):
            if len(where[tuple(w[p : p + length])]) > 1:
                out.setdefault(i, set()).update(range(p, p + length))
    return out


def covered(df):
    out = {}
    for r in df.collect():
        assert r.n_words == r.end_word - r.start_word and r.other_doc_id != r.doc_id
        out.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    return out


def test_whole_table_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    df = repeated_passages(documents)
    assert df.columns == ["doc_id", "start_word", "end_word", "n_words", "other_doc_id"]
    got = covered(df)
    assert got and got == brute_force(rows, 50)


def test_planted_passages_of_every_overlap(make_docs):
    """Passages that share some context on one side with one document and on the other side with another."""
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [word() for _ in range(120)]
    texts = []
    for _ in range(60):
        a = rng.randrange(0, 100)
        b = rng.randrange(a + 5, 121)
        texts.append(" ".join([word() for _ in range(rng.randrange(30))] + base[a:b] + [word() for _ in range(rng.randrange(30))]))
    texts += ["same " * 400, "SAME " * 300, "a b " * 200, "b a " * 90, None, "", "short text", " ".join(base), " ".join(base[:50])]
    docs = make_docs(texts)
    for length, gram in ((50, 8), (20, 5)):
        assert covered(repeated_passages(docs, length, gram)) == brute_force(list(enumerate(texts)), length)


def test_repeated_rows_null_ids_extra_columns_and_empty_table(make_docs):
    text = " ".join(f"x{i}" for i in range(80))
    docs = make_docs([text, text, text, "y " + text, "z " * 70], ids=[4, 4, None, 9, 5])
    docs = docs.withColumns({"start": F.lit(1), "gram": F.lit("g"), "low": F.lit(0)})
    got = sorted(tuple(r) for r in repeated_passages(docs).collect())
    assert got == [(4, 0, 80, 80, 9), (9, 1, 81, 80, 4)]
    assert repeated_passages(docs.filter("doc_id = 4")).count() == 0
    assert repeated_passages(docs.limit(0)).count() == 0
