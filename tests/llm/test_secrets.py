import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import secrets_forest as S


def corpus(rng, n):
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    upper = lambda k: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(k))
    out = []
    for i in range(n):
        kind = i % 6
        body = [
            (f'token = "{hexes(40)}"', True),
            (f"key AKIA{upper(16)} here", True),
            (f"password={hexes(18)}", True),
            (f"card {rng.randrange(10**15, 10**16)}", False),
            (f"see chapter-section-{rng.randrange(100)} for more", False),
            ("no candidate here", None),
        ][kind]
        out.append((f"words before {body[0]} and words after", body[1]))
    return out


@pytest.fixture(scope="module")
def trained(spark, make_docs):
    docs = make_docs([t for t, _ in corpus(random.Random(1), 400)])
    return S.fit_forest(S.labelled_findings(S.with_candidates(docs)))


def test_forest_on_unseen_findings(make_docs, trained):
    texts = corpus(random.Random(2), 300)
    found = {r.doc_id: r for r in S.scan_documents(make_docs([t for t, _ in texts]), trained).collect()}
    for i, (text, secret) in enumerate(texts):
        assert (i in found) == (secret is not None), text
        if secret is not None:
            r = found[i]
            assert r.secret == secret and 0 <= r.score <= 1, text
            assert text[r.start : r.start + len(r.finding)] == r.finding


def test_several_findings_in_one_text_and_masking(make_docs, trained):
    a, b = "0123456789abcdef" * 2, "fedcba9876543210" * 2
    text = f'token = "{a}" then card 4929000000000000 ü token = "{b}"\n"{a}"'
    docs = make_docs([text, None, "", "plain", text], ids=[1, 2, 3, 4, 1]).withColumns({"found": F.lit(1), "parts": F.lit("p"), "row": F.lit("r")})
    rows = [r for r in S.scan_documents(docs, trained).collect() if r.doc_id == 1]
    assert len(rows) == 8 and {text[r.start : r.start + len(r.finding)] == r.finding for r in rows} == {True}
    masked = S.mask_secrets(docs, trained)
    assert masked.columns == docs.columns
    got = {r.doc_id: r.text for r in masked.collect()}
    assert masked.count() == 5 and got[2] is None and got[3] == "" and got[4] == "plain"
    assert f'token = "{S.MASK}" then card 4929000000000000 ü token = "{S.MASK}"\n' in got[1]


def test_forest_expression_equals_the_trees(spark, make_docs, trained):
    docs = make_docs([t for t, _ in corpus(random.Random(3), 60)])
    rows = S.with_candidates(docs).select(F.explode("found").alias("f")).select("f.x", S.forest_score(trained, F.col("f.x")).alias("score"))

    def vote(node, x):
        while not isinstance(node, float):
            node = node[2] if x[S.FEATURES[node[0]]] <= node[1] else node[3]
        return node

    for r in rows.collect():
        assert r.score == pytest.approx(sum(vote(t, r.x) for t in trained) / len(trained), abs=1e-6)


def test_without_labelled_classes(make_docs):
    docs = make_docs(['password="abc123def456ghi"', "nothing"])
    rows = S.scan_documents(docs).collect()  # one class alone: the findings' own labels count
    assert [(r.finding, r.secret) for r in rows] == [("abc123def456ghi", True)]
    assert S.scan_documents(docs.limit(0)).count() == 0 and S.mask_secrets(docs.limit(0)).count() == 0
    assert S.mask_secrets(docs.drop("source")).columns == [c for c in docs.columns if c != "source"]


def test_whole_table_masks_what_it_reports(documents):
    found = S.scan_documents(documents)
    hits = {r.doc_id for r in found.filter("secret").collect()}
    masked = {r.doc_id for r in S.mask_secrets(documents).filter(F.col("text").contains(S.MASK)).collect()}
    assert hits == masked
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_long_text_with_many_findings(make_docs, trained):
    text = " ".join(f"k{i:012d}" for i in range(3000))
    assert S.scan_documents(make_docs([text]), trained).count() == 3000


def planted(rng, n):
    """Texts with their secret, of every issued format and assignment, half of them without a digit."""
    letters, both = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    out = []
    for i in range(n):
        run = lambda k: "".join(rng.choice(letters if i % 2 else both) for _ in range(k))  # noqa: B023, E731
        kinds = [
            ("key {} here", "AKIA" + run(16).upper()),
            ("see {} there", rng.choice(["ghp_", "gho_", "ghs_"]) + run(36)),
            ("use {}.", "glpat-" + run(20)),
            ("pay {} now", "sk_live_" + run(rng.choice([16, 24]))),
            ("hook {} for chat", "xoxb-" + run(24)),
            ('password = "{}"', run(rng.choice([8, 24]))),
            ("token={}, then", run(9)),
            ("db2_prod_password: '{}'", "p@ss w!rd " + run(4)),
            ("secret: {} is set", run(5) + "$%&" + run(5)),
        ]
        form, secret = kinds[i // 2 % len(kinds)]
        out.append((f"words before {form.format(secret)} and words after", secret))
    return out


def test_masks_every_planted_secret_also_without_digits(make_docs):
    rng = random.Random(5)
    plants = planted(rng, 360)
    harmless = [t for t, secret in corpus(rng, 360) if secret is False]
    docs = make_docs([t for t, _ in plants] + harmless)
    got = {r.doc_id: r.text for r in S.mask_secrets(docs).collect()}
    assert [(t, got[i]) for i, (t, x) in enumerate(plants) if got[i] != t.replace(x, S.MASK)] == []
    assert [got[len(plants) + k] for k in range(len(harmless))] == harmless


def test_a_repeated_finding_takes_one_place_of_the_sample(make_docs):
    texts = [t for t, _ in corpus(random.Random(6), 120)] + ["card 4929000000000000 "] * 300 + ["card 4111000000000000 "] * 3
    rows = S.training_sample(S.labelled_findings(S.with_candidates(make_docs(texts))), 18).collect()
    for c in (0, 1):
        assert len({r.h for r in rows if r.label == c}) == 18 == sum(r.label == c for r in rows)
    rows = S.training_sample(S.labelled_findings(S.with_candidates(make_docs(texts)))).collect()
    assert sorted(r.weight for r in rows if r.weight > 1)[-1] == S.MAX_WEIGHT and 3.0 in {r.weight for r in rows}
