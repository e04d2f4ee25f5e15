"""Secrets in texts: candidate strings, judged by a random forest.

A candidate is a run of at least twelve key characters with a digit, a run that
begins as an issued format does, or what is assigned to the name of a secret:
a quoted string or an unbroken run of six characters or more, whatever they are.  Its
features are its length, how often its characters change class, shares of
digits, capitals, vowels and distinct characters, how much of it dictionary
words cover, the path it stands in (of the file and within its own token) and
the words beside it.  A random forest trained on labelled findings then removes
the false positives.  The trained trees become one SQL expression, so the same
scan that finds the candidates judges them, row by row and without a join.

DataFrame, SQL and pyspark.ml functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import written

_KEY = "A-Za-z0-9+/_-"
BEFORE, AFTER = 48, 24  # characters of context
#: Fixed words: names of secrets in front of them, names of harmless things, and an everyday dictionary.
SECRET_WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "private_key", "bearer", "credential")
HARMLESS_WORDS = ("example", "sample", "dummy", "test", "phone", "tel", "order", "invoice", "isbn", "version", "commit", "sha", "md5", "checksum", "card", "page")
DICTIONARY = (
    "the", "and", "that", "this", "with", "from", "have", "for", "not", "you", "was", "are", "der", "die", "das", "und",
    "ist", "ein", "nicht", "les", "des", "une", "est", "que", "los", "las", "para", "con", "por", "user", "name", "file",
    "data", "test", "example", "page", "version", "image", "index", "admin", "item", "order", "http", "www", "com", "html",
)
_NAMES = "(?i:" + "|".join(SECRET_WORDS) + ")"
_ASSIGN = _NAMES + r"[\"']?\s{0,8}[:=]\s{0,8}"
#: Beginnings of the ISSUED formats, as long as the shortest of each.
_ISSUED_START = r"A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[0-9A-Za-z-]{10}|sk_live_[0-9a-zA-Z]{16}|glpat-[A-Za-z0-9_-]{20}"
CANDIDATE = (
    r"(?:(?<=[:=][\s\"']{0,9})(?:"  # cheap to test, before the assignment itself
    + rf"(?<={_ASSIGN}\")[^\"\r\n]{{6,200}}+(?=\")|(?<={_ASSIGN}')[^'\r\n]{{6,200}}+(?=')"
    + rf"|(?<={_ASSIGN}[\"']?)[^\s\"'`,;<>]{{5,}}[^\s\"'`,;<>.:!?)\]}}])"
    + f"|(?<![{_KEY}])(?:(?={_ISSUED_START})|(?=[A-Za-z+/_-]*+[0-9])"
    + rf"(?![{_KEY}]*{_ASSIGN}[\"']?[^\s\"'=]))[{_KEY}]{{12,}}+={{0,2}})"  # not the name that a value is assigned to
)
#: Formats that only issued keys have; they label findings and are no features.
ISSUED = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abp]-[0-9A-Za-z-]{10,}$|^sk_live_[0-9a-zA-Z]{16,}$|^glpat-[A-Za-z0-9_-]{20}$"
ASSIGNED = r"(?i)(" + "|".join(SECRET_WORDS) + r")[\"']?\s*[:=]\s*[\"']?$"
#: Short plain words, placeholders and calls; what is assigned may be prose or code, so these label nothing.
UNSURE = r"^[A-Z]?[a-z]{0,11}$|^[$%]?[{<]|^[A-Za-z_.]+[(\[]"
HARMLESS = r"^[0-9+/_-]+$|^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|^[A-Za-z]+([_/-][A-Za-z]+)+[_/-]?[0-9]{1,4}$"

FEATURES = (
    "length", "changes", "digits", "capitals", "vowels", "distinct", "hex", "covered",
    "file_path", "token_path", "secret_before", "harmless_before", "assigned", "quoted",
)
#: Labelled findings of either class that the forest is fitted on, lowest hashes first.
MAX_LABELLED = 20_000
#: Weight of a repeated finding at most.
MAX_WEIGHT = 8
TREES, DEPTH, SEED, THRESHOLD = 24, 5, 11, 0.5
MASK = "[secret]"


def _share(part: Column, whole: Column) -> Column:
    return F.round(part / F.greatest(whole, F.lit(1)), 6)


def _left_after(text: Column, pattern: str) -> Column:
    """Characters that are not matched by the pattern."""
    return F.length(F.regexp_replace(text, pattern, ""))


def features(before: Column, found: Column, after: Column, path: Column) -> list[Column]:
    """The numeric features of a candidate, in the order of FEATURES."""
    n = F.length(found)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(found, "[a-z]+", "l"), "[A-Z]+", "u"), "[0-9]+", "0")
    runs = F.length(F.regexp_replace(classes, "[^lu0]+", "-"))
    near = F.lower(before)
    words = [
        n,
        _share(runs - 1, n),
        _share(n - _left_after(found, "[0-9]"), n),
        _share(n - _left_after(found, "[A-Z]"), n),
        _share(n - _left_after(found, "(?i)[aeiou]"), n),
        _share(F.size(F.array_distinct(F.split(found, ""))), n),
        found.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        _share(n - _left_after(found, "(?i)" + "|".join(sorted(DICTIONARY, key=len, reverse=True))), n),
        F.coalesce(path, F.lit("")).rlike("(?i)test|example|sample|doc"),
        F.length(F.regexp_extract(F.concat(before, found), r"(\S*)$", 1)) - _left_after(F.regexp_extract(F.concat(before, found), r"(\S*)$", 1), r"[/\\.]"),
        near.rlike("|".join(SECRET_WORDS)),
        near.rlike("|".join(HARMLESS_WORDS)),
        before.rlike(r"[=:]\s*[\"']?$"),
        before.rlike("[\"'`]$") & after.rlike("^[\"'`]"),
    ]
    return [w.cast("double").alias(name) for w, name in zip(words, FEATURES, strict=True)]


def _label(before: Column, found: Column) -> Column:
    """1 for issued formats and assigned secrets, 0 for plain numbers, UUIDs and numbered names, null when unsure."""
    return F.when(found.rlike(ISSUED) | (before.rlike(ASSIGNED) & ~found.rlike(UNSURE)), 1).when(found.rlike(HARMLESS), 0)


def with_candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """``row`` (struct of all columns of ``docs``), the texts between candidates, and the candidates with features and label.

    The n candidates of a text lie between its n + 1 ``parts``; null and empty
    texts have no candidate (``found`` is empty).
    """
    file = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    df = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        file.alias("file"),
        docs["text"].alias("text"),
        F.coalesce(F.regexp_extract_all("text", F.lit(CANDIDATE), 0), F.array().cast("array<string>")).alias("strings"),
    )
    df = df.select("row", "file", "strings", F.when(F.size("strings") > 0, F.split("text", CANDIDATE)).alias("parts"))
    empty = F.array().cast("array<int>")
    ends = F.aggregate(
        F.arrays_zip("parts", "strings"),
        F.struct(F.lit(0).alias("at"), empty.alias("starts")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["parts"]) + F.coalesce(F.length(x["strings"]), F.lit(0))).alias("at"),
            F.concat(a["starts"], F.array(a["at"] + F.length(x["parts"]))).alias("starts"),
        ),
        lambda a: a["starts"],
    )
    # Zipped, so that each array is made once and not once per candidate.
    n = F.size("strings")
    zipped = F.arrays_zip(F.slice(ends, 1, n).alias("start"), F.col("strings").alias("finding"), F.slice("parts", 1, n).alias("before"), F.slice("parts", 2, n).alias("after"))
    df = df.select("row", "file", "parts", zipped.alias("zipped"))
    near = F.transform(
        "zipped",
        lambda c: F.struct(
            c["start"].alias("start"),
            c["finding"].alias("finding"),
            F.substr(c["before"], F.greatest(F.length(c["before"]) - BEFORE + 1, F.lit(1))).alias("before"),
            F.substr(c["after"], F.lit(1), F.lit(AFTER)).alias("after"),
        ),
    )
    df = df.select("row", "file", "parts", near.alias("near"))
    found = F.transform(
        "near",
        lambda c: F.struct(
            c["start"].alias("start"),
            c["finding"].alias("finding"),
            _label(c["before"], c["finding"]).alias("label"),
            F.struct(*features(c["before"], c["finding"], c["after"], F.col("file"))).alias("x"),
        ),
    )
    none = F.array().cast(df.select(found.alias("found")).schema[0].dataType)
    return df.select("row", "parts", F.coalesce(found, none).alias("found"))


def labelled_findings(candidates: DataFrame) -> DataFrame:
    """The candidates that label themselves: ``label`` and the features, one row per finding."""
    one = candidates.select(F.explode("found").alias("f"))
    return one.filter("f.label is not null").select("f.label", F.col("f.finding").alias("finding"), "f.x.*")


def training_sample(findings: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``label, FEATURES, h, weight`` of the ``max_labelled`` findings of each class with the lowest hash ``h``.

    Findings that are equal with equal features count once, with their number,
    MAX_WEIGHT at most, as weight: a finding that many rows repeat takes one place.
    """
    rows = findings.select("label", *FEATURES, F.xxhash64("finding", *FEATURES).alias("h"))
    rows = rows.groupBy("label", *FEATURES, "h").agg(F.least(F.count("*"), F.lit(MAX_WEIGHT)).cast("double").alias("weight"))
    rows = written(rows, "findings")
    classes = [rows.filter(F.col("label") == c).orderBy("h", *FEATURES).limit(max_labelled) for c in (0, 1)]
    return written(classes[0].union(classes[1]), "labelled")


def fit_forest(findings: DataFrame, max_labelled: int = MAX_LABELLED) -> list | None:
    """Random forest on labelled findings (``label`` 0 or 1, ``finding`` and the FEATURES); its trees as nested tuples.

    At most ``max_labelled`` different findings of each class are used, those
    with the lowest hash.  None when either class has no finding.
    """
    train = training_sample(findings, max_labelled)
    if train.select("label").distinct().count() < 2:
        return None
    order = ["h", *FEATURES]
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(train.orderBy(*order).coalesce(1))
    data = data.select("features", F.col("label").cast("double").alias("label"), "weight")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", weightCol="weight").fit(data)

    def tree(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return float(node.prediction())
        split = node.split()
        return int(split.featureIndex()), float(split.threshold()), tree(node.leftChild()), tree(node.rightChild())

    return [tree(t._call_java("rootNode")) for t in forest.trees]


def forest_score(forest: Sequence, x: Column) -> Column:
    """Share of the trees that vote for a secret."""

    def vote(node) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        at, threshold, low, high = node
        return F.when(x[FEATURES[at]] <= threshold, vote(low)).otherwise(vote(high))

    total = vote(forest[0])
    for tree in forest[1:]:
        total = total + vote(tree)
    return F.round(total / len(forest), 6)


def with_scores(candidates: DataFrame, forest: Sequence | None, threshold: float = THRESHOLD) -> DataFrame:
    """``found`` becomes (start, finding, score, secret); without a forest the self-labelled secrets count."""

    def judged(f: Column) -> Column:
        score = F.coalesce(f["label"], F.lit(0)).cast("double") if forest is None else forest_score(forest, f["x"])
        return F.struct(f["start"].alias("start"), f["finding"].alias("finding"), score.alias("score"))

    scored = candidates.select("row", "parts", F.transform("found", judged).alias("found"))
    kind = T.ArrayType(
        T.StructType(
            [T.StructField("start", T.IntegerType()), T.StructField("finding", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("secret", T.BooleanType())]
        )
    )
    secret = F.transform("found", lambda f: F.struct(f["start"], f["finding"], f["score"], (f["score"] >= threshold)))
    return scored.select("row", "parts", secret.cast(kind).alias("found"))


def scan_documents(docs: DataFrame, forest: Sequence | None = None, fit: bool = True, path: str = "source") -> DataFrame:
    """One row per candidate: ``doc_id, start, finding, score, secret`` (start in characters from 0).

    The forest is fitted on the findings of ``docs`` that label themselves,
    unless one is given.  Null, empty and keyless texts have no row; rows
    without a doc_id keep their null; repeated rows are scanned one by one.
    """
    candidates = with_candidates(docs, path).select(F.struct("row.doc_id").alias("row"), "found")
    candidates = written(candidates, "candidates")  # the texts are searched once
    if fit and forest is None:
        forest = fit_forest(labelled_findings(candidates))
    found = with_scores(candidates.withColumn("parts", F.lit(None)), forest)
    return found.select(F.col("row.doc_id").alias("doc_id"), F.inline("found"))


def mask_secrets(docs: DataFrame, forest: Sequence | None = None, path: str = "source") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mask (all rows, all columns)."""
    candidates = with_candidates(docs, path)
    if forest is None:
        forest = fit_forest(labelled_findings(written(candidates.select("found"), "candidates")))
    found = with_scores(candidates, forest)
    piece = F.transform(
        "parts",
        lambda p, i: F.concat(p, F.coalesce(F.when(F.get("found", i)["secret"], MASK).otherwise(F.get("found", i)["finding"]), F.lit(""))),
    )
    text = F.when(F.size("found") > 0, F.array_join(piece, "")).otherwise(F.col("row.text"))
    names = [c for c in docs.columns]
    return found.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names])
