import itertools
import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import filter_audit
from tessera.llm.filter_audit import RadixTrie, audit, cut_points, document_masks, first_documents

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """The rules, document by document and order by order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = text.encode().split()
        copies = [i for i, t, _ in docs if (t or "") == text and i is not None]
        rows.append(
            (
                lang or "",
                {
                    "A": len(words) < 100,
                    "B": 100 * len(set(words)) < 80 * len(words),
                    "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
                    "D": any(c in "#$%&*|" for c in text),
                    "E": doc_id is not None and min(copies) < doc_id,
                },
                doc_id in good,
                doc_id in toxic,
            )
        )
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                lost = [r for r in left if r[1][f]]
                gone = [r for r in own if r[1][f] and any(r[1][g] for g in order[: step - 1])]
                unique = [r for r in own if r[1][f] and sum(r[1].values()) == 1]
                left = [r for r in left if not r[1][f]]
                shapley[f] += len(lost)
                out[part, order, step] = [len(left), len(lost), len(gone), len(unique), sum(r[2] for r in lost), sum(r[3] for r in lost)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def found(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(n=300, seed=11):
    rng = random.Random(seed)
    texts = ["", None, "A B C", "# x", "same " * 120, " ".join(map(str, range(120))), "é" * 20_000 + " " + "w" * 70_000]
    for _ in range(40):
        texts.append(" ".join(rng.choice(["The", "word", "ÀB", "x|y", "CAPS", str(rng.randrange(999))]) for _ in range(rng.randrange(150))))
    return [(rng.choice([None, *range(200)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(n)]


def test_audit_against_brute_force(spark):
    docs = corpus()
    labels = [(i, i % 2, i % 3) for i in range(0, 200, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (7, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    df = df.withColumns({"mask": F.lit("m"), "part": F.lit("p"), "good": F.lit(0), "shard": F.lit(1), "first": F.lit(True)}).repartition(7)
    assert found(audit(df, spark.createDataFrame(labels, LABELS))) == brute(docs, labels)


def test_masks_with_tiny_shards(spark, monkeypatch):
    """Many shards: the cut points must not tear copies apart."""
    rng = random.Random(3)
    docs = [(rng.choice([None, *range(900)]), f"text {rng.randrange(400) ** 3}" if i % 3 else "hot", "en") for i in range(2000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 2_000)
    assert len(cut_points(df, 20, 2000)) > 10
    want = []
    for doc_id, text, _ in docs:
        low = min((i for i, t, _ in docs if (t or "") == (text or "") and i is not None), default=None)
        want.append((doc_id, doc_id is not None and low < doc_id))
    got = [(r.doc_id, r["mask"] >= 16) for r in document_masks(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_cut_points_follow_a_common_prefix(spark):
    """A third of the texts share 5,000 characters: cuts fall behind them."""
    rows = [("common " * 715 + str(i),) if i % 3 else (f"{i} own",) for i in range(900)]
    df = spark.createDataFrame(rows, "text string")
    cuts = cut_points(df, 8, 900)
    assert sum(c.startswith(b"common " * 714) for c in cuts) >= 3
    assert cuts == sorted(set(cuts))


def test_copies_do_not_make_cuts(spark):
    df = spark.createDataFrame([("the same text",)] * 600 + [(f"{i} other",) for i in range(300)], "text string")
    assert b"the same text" not in cut_points(df, 6, 900)


def test_radix_trie_against_a_dictionary():
    rng = random.Random(1)
    trie, want = RadixTrie(), {}
    for n in range(20_000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(12)))
        i = rng.choice([None, n % 977])
        trie.insert(text, hash(text), i)
        old = want.get(text)
        want[text] = i if old is None else old if i is None else min(old, i)
    assert sorted((t[1], str(t[0])) for t in trie.terminals()) == sorted((hash(t), str(i)) for t, i in want.items())
    assert list(RadixTrie().terminals()) == []


def test_shards_are_dealt_by_prefix_and_copies_collapse_before(spark, monkeypatch):
    """A text in a third of the rows is a row per piece in the shuffle; every text is emitted once."""
    df = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"text {i}") for i in range(3000)], "doc_id long, text string")
    first = first_documents(df)
    rows = first.collect()
    assert len(rows) == 2001 and {r.doc_id for r in rows if r.doc_id % 3 == 0} == {0}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], LABELS)
    assert audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    rows = found(audit(one, labels))
    assert len(rows) == 600 and rows["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


def test_query_equals_its_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    from tessera.llm.queries import queries

    df = queries()["op11_filter_audit"](spark, sf_dir)
    sql = con.execute(f"SELECT {', '.join(df.columns)} FROM ({filter_audit.oracle_sql()})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(sql)
