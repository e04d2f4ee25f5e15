import hashlib
import random
import re

from pyspark.sql import functions as F

from tessera.llm.decontaminate import Matcher, drop_contaminated, find_passages, report

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def windows(text, n=10):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_force(docs, items, n=10):
    by = {}
    for i, t in items:
        for w in windows(t, n):
            by.setdefault(w, set()).update([] if i is None else [str(i)])
    sizes = {len(w) for w in by}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                key = tuple(w[p : p + size])
                if key in by:
                    hit.update(range(p, p + size))
                    found |= by[key]
        ids = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_whole_table_equals_brute_force(spark, documents, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = brute_force(docs, items)
    df = report(find_passages(documents, bench))
    assert df.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == want
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)


def test_short_items_shared_windows_and_several_blocks(spark, make_docs):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(40)] + ["Ä", "é1", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 9, 10, 11, 25]))) for i in range(60)] + [(7, "v1 v2"), (None, "v3 v4"), (9, None), (10, "..")]
    docs = [None, "", "--", "V1, v2!", text(3000)] + [text(rng.randrange(60)) for _ in range(60)]
    docs += [text(5) + " " + t.upper().replace(" ", " -- ") + "\n" + text(5) for _, t in items[:30] if t]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = make_docs(docs).withColumns({"items": F.lit("i"), "spans": F.lit(1), "row": F.lit("r")})
    want = brute_force(list(enumerate(docs)), items)
    for block_bytes in (1 << 20, 900):  # one block, several blocks
        got = report(find_passages(frame, bench, block_bytes=block_bytes))
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in want if not r[-1])


def test_matcher_equals_plain_search():
    rng = random.Random(1)
    for _ in range(200):
        patterns = sorted({bytes(rng.choice(b"ab ") for _ in range(rng.randrange(1, 9))) for _ in range(8)})
        text = bytes(rng.choice(b"ab ") for _ in range(60))
        want = sorted((i, p) for p in patterns for i in range(len(text)) if text.startswith(p, i))
        assert sorted(Matcher(patterns).find(text)) == want


def test_empty_tables_repeated_rows_and_null_ids(spark, make_docs):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = make_docs(["x one two three", "x one two three", None], ids=[2, 2, None])
    rows = sorted((str(r.doc_id), r.n_hit, r.contaminated) for r in report(find_passages(docs, bench)).collect())
    assert rows == [("2", 3, True), ("2", 3, True), ("None", 0, False)]
    assert report(find_passages(docs.limit(0), bench)).count() == 0
    assert report(find_passages(docs, bench.limit(0))).filter("contaminated or n_hit > 0").count() == 0
