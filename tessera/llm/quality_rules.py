"""Quality rules whose cutoffs are certified on labelled documents.

Every text gets counts (words, symbols, repeated lines, repeated windows) and,
from them, one integer score per rule; a rule rejects a document whose score is
above the rule's cutoff in the document's stratum (its language).  Cutoffs come
from labelled documents: for each stratum, rule and cutoff of a fixed grid the
number of good documents that the cutoff would reject is compared with the
binomial distribution, exactly: the cutoff is certified when at most that many
rejections have a probability under the level if the true false-rejection rate
were above ``alpha / rules``.  Errors over the grid are controlled by fixed
sequence testing (from the most lenient cutoff on, stop at the first failure),
errors over rules and strata by Bonferroni.  With probability ``1 - delta`` all
certified cutoffs of all strata hold at once, so any of them may be chosen: the
one that rejects most bad documents, each good one counting ``price`` times.  A
stratum with too few labels certifies nothing, and nothing there is rejected
beyond the base rules.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACES, WORD_BREAKS, written

ALPHA, DELTA, PRICE = 0.05, 0.05, 20
MIN_WORDS, MAX_REPEATED = 10, 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
SHARES = (0, 5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900)
#: Rule: (score as SQL over the counts, cutoffs from strict to lenient).  Shares are per mille.
RULES: dict[str, tuple[str, tuple[int, ...]]] = {
    "symbols": ("1000 * n_symbols / word_chars", SHARES),
    "repeated_lines": ("1000 * n_dup_lines / n_lines", SHARES),
    "repeated_words": ("1000 * n_repeat_words / n_words", SHARES[:10]),
    "long_words": ("10 * word_chars / n_words", (60, 70, 80, 90, 100, 120, 150, 200, 300)),
    "capitals": ("1000 * n_capitals / word_chars", SHARES),
    "exclamations": ("1000 * n_exclamations / n_words", SHARES),
}
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Stratum cutoffs sent to every task; beyond so many strata they are joined by shuffle.
MAX_BROADCAST_STRATA = 10_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclamations")


def _occurrences(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, ASCII_SPACES, "")) > 0


def with_counts(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """``row`` (struct of all columns of ``docs`` unless given) and the counts of the text; null counts as no text.

    Windows are compared within the row: the hashes of its word windows are
    sorted with their places, equal neighbours are confirmed word by word.
    """
    row = F.struct(*[docs[c] for c in docs.columns]) if row is None else row
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(row.alias("row"), text.alias("text"))
    df = df.select(
        "row",
        F.length(F.translate("text", ASCII_SPACES, "")).cast("long").alias("word_chars"),
        _occurrences(F.col("text"), SYMBOLS).alias("n_symbols"),
        _occurrences(F.col("text"), CAPITALS).alias("n_capitals"),
        _occurrences(F.col("text"), "!").alias("n_exclamations"),
        F.filter(F.split("text", "\n"), _has_word).alias("lines"),
        F.array_remove(F.split("text", f"[{WORD_BREAKS}]+"), "").alias("words"),
    )
    last = F.size("words") - WINDOW
    window = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(WINDOW)])
    )
    df = df.select(
        "row", "word_chars", "n_symbols", "n_capitals", "n_exclamations", "words",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.when(last >= 0, window).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    done = [c for c in df.columns if c not in ("words", "windows")]
    # Rare from here on: only texts in which some window repeats have places to sort.
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*done, "words", F.when(F.size("windows") > F.size(F.array_distinct("windows")), placed).alias("placed"))

    def same(one: Column, j: Column) -> Column:
        other = F.get("placed", j)
        equal = F.slice("words", one["i"] + 1, WINDOW) == F.slice("words", other["i"] + 1, WINDOW)
        return F.coalesce((one["h"] == other["h"]) & equal, F.lit(False))

    marked = F.transform("placed", lambda one, j: F.when(same(one, j - 1) | same(one, j + 1), one["i"]))
    df = df.select(*done, F.array_sort(F.filter(marked, lambda i: i.isNotNull())).alias("repeated"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(
        "repeated",
        start,
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i.cast("long"), a["end"])).alias("n"), (i + WINDOW).cast("long").alias("end")),
        lambda a: a["n"],
    )
    return df.select(*done, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    """Too few words, or too large a share of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _score(rule: str) -> Column:
    top, _, bottom = RULES[rule][0].partition(" / ")
    return F.expr(f"coalesce(({top}) div nullif({bottom}, 0), 0)")


def _log_gamma(x: str) -> str:
    """Logarithm of the gamma function for x >= 1 (shift by eight, then Stirling's series; error under 1e-12)."""
    y = f"({x} + 8D)"
    product = " * ".join(f"({x} + {i}D)" for i in range(8))
    series = f"1D / (12D * {y}) - 1D / (360D * pow({y}, 3)) + 1D / (1260D * pow({y}, 5)) - 1D / (1680D * pow({y}, 7))"
    return f"(({y} - 0.5D) * ln({y}) - {y} + 0.9189385332046727D + {series} - ln({product}))"


def binomial_tail(k: str, n: str, rate: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, rate), exactly summed from k down; 1 above the mean, where nothing is certified."""
    p, q = f"{rate!r}D", f"{1 - rate!r}D"
    top = f"exp({_log_gamma(f'({n} + 1)')} - {_log_gamma(f'({k} + 1)')} - {_log_gamma(f'({n} - {k} + 1)')} + {k} * ln({p}) + ({n} - {k}) * ln({q}))"
    down = f"if({k} = 0, cast(array() as array<bigint>), sequence(cast({k} as bigint), 1L, -1L))"
    step = f"(a, i) -> named_struct('t', a.t * i * {q} / (({n} - i + 1) * {p}), 's', a.s + a.t * i * {q} / (({n} - i + 1) * {p}))"
    total = f"aggregate({down}, named_struct('t', 1D, 's', 1D), {step}, a -> a.s)"
    return F.expr(f"if({k} > {n} * {p}, 1D, {top} * {total})")


def fit_cutoffs(
    counts: DataFrame, labels: DataFrame, stratum: str, alpha: float = ALPHA, delta: float = DELTA, price: int = PRICE
) -> DataFrame:
    """One row per stratum with a certified cutoff: ``stratum`` and a map from rule to cutoff.

    ``counts`` has doc_id, ``stratum`` and the counts of all documents;
    ``labels`` has doc_id and quality (1 good, 0 bad, null unlabelled; of several
    labels of a document the lowest holds).  All labelled documents that pass
    the base rules count; nothing is sampled.
    """
    truth = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rules = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                # the cutoffs below the score are the ones that reject the document
                sum((_score(name) > c).cast("int") for c in grid).alias("below"),
            )
            for name, (_, grid) in RULES.items()
        ]
    )
    labelled = counts.filter(~base_failed()).join(truth, "doc_id")
    one = labelled.select(F.col(stratum).alias("stratum"), "quality", F.explode(rules).alias("r"))
    good, bad = F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") != 1)
    tally = one.groupBy("stratum", "r.rule", "r.below").agg(good.alias("good"), bad.alias("bad"))
    tests = F.lit(len(RULES))
    strata = written(tally, "tally")  # a row per stratum, rule and cutoff
    n_strata = max(1, strata.select("stratum").distinct().count())
    grids = F.create_map(*[x for name, (_, grid) in RULES.items() for x in (F.lit(name), F.array(*[F.lit(c) for c in grid]))])
    total = strata.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n"), F.collect_list(F.struct("below", "good", "bad")).alias("tally")
    )
    at = F.posexplode(F.element_at(grids, F.col("rule"))).alias("at", "cutoff")
    rejected = lambda what: F.aggregate(
        F.filter("tally", lambda t: t["below"] > F.col("at")), F.lit(0).cast("long"), lambda s, t: s + t[what]
    )
    tried = total.select("stratum", "rule", "n", "tally", at)
    tried = tried.select("stratum", "rule", "n", "at", "cutoff", rejected("good").alias("k"), rejected("bad").alias("gain"))
    rate, level = alpha / len(RULES), delta / n_strata
    tried = tried.withColumn("passes", binomial_tail("k", "n", rate) <= F.lit(level) / tests)
    # Fixed sequence: a cutoff counts only if all more lenient ones pass.
    stop = F.max(F.when(~F.col("passes"), F.col("at"))).alias("stop")
    steps = F.collect_list(F.struct("at", "cutoff", "k", "gain")).alias("steps")
    by = tried.groupBy("stratum", "rule").agg(stop, steps)
    valid = F.filter("steps", lambda s: s["at"] > F.coalesce(F.col("stop"), F.lit(-1)))
    worth = F.transform(valid, lambda s: F.struct((s["gain"] - price * s["k"]).alias("worth"), s["at"].alias("at"), s["cutoff"].alias("cutoff")))
    best = by.select("stratum", "rule", F.array_max(worth).alias("best")).filter("best.worth > 0")
    pairs = F.collect_list(F.struct(F.col("rule"), F.col("best.cutoff")))
    return written(best.groupBy("stratum").agg(F.map_from_entries(pairs).alias("cutoffs")), "cutoffs")


def with_verdict(counts: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """Adds ``base_failed``, ``kept`` and ``failed_rules`` to the rows of ``counts``."""
    few = cutoffs.count() <= MAX_BROADCAST_STRATA
    cutoffs = cutoffs.select(F.col("stratum").alias("_stratum"), "cutoffs")
    joined = counts.join(F.broadcast(cutoffs) if few else cutoffs, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    above = [F.when(_score(r) > F.element_at("cutoffs", F.lit(r)), F.lit(r)) for r in RULES]
    out = joined.withColumn("base_failed", base_failed()).withColumn("failed_rules", F.concat_ws(",", *above))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")).drop("_stratum", "cutoffs")


def judge_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept``, ``failed_rules`` for every input row.

    Null and empty texts have no words and fail the base rules.  Rows without a
    doc_id are judged but never labelled; rows that repeat a doc_id are judged
    one by one.  Null is a stratum of its own.  Further columns are not read.
    """
    counts = with_counts(docs, F.struct("doc_id", F.col(stratum).alias("stratum"))).select("row.*", *COUNTS)
    counts = written(counts, "counts")
    cutoffs = fit_cutoffs(counts, labels, "stratum")
    return with_verdict(counts, cutoffs, "stratum").drop("stratum")


def drop_rejected(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept (all columns).

    The rows are written with their counts, so that each text is counted once
    for both the cutoffs and the verdict.
    """
    counted = written(with_counts(docs), "counted")
    counts = counted.select("row.doc_id", F.col(f"row.{stratum}").alias("stratum"), *COUNTS)
    cutoffs = fit_cutoffs(counts, labels, "stratum")
    judged = with_verdict(counted.withColumn("stratum", F.col(f"row.{stratum}")), cutoffs, "stratum")
    return judged.filter("kept").select("row.*")


def _sql_score(rule: str) -> str:
    top, _, bottom = RULES[rule][0].partition(" / ")
    return f"coalesce(({top}) // nullif({bottom}, 0), 0)"


def oracle_sql(alpha: float = ALPHA, delta: float = DELTA, price: int = PRICE) -> str:
    """The same rows as :func:`judge_documents` over ``documents`` and ``labels``, in DuckDB SQL."""
    rate = alpha / len(RULES)
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    grid = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, unnest({list(cuts)}) AS cutoff, unnest({list(range(len(cuts)))}) AS step" for name, (_, cuts) in RULES.items()
    )
    scores = " UNION ALL ".join(f"SELECT rid, lang, quality, '{r}' AS rule, {_sql_score(r)} AS score FROM labelled" for r in RULES)
    all_scores = " UNION ALL ".join(f"SELECT rid, lang, '{r}' AS rule, {i} AS pos, {_sql_score(r)} AS score FROM counts" for i, r in enumerate(RULES))

    def n_of(chars: str) -> str:
        return f"length(text) - length(translate(text, '{chars}', ''))"

    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (SELECT rid, list_filter(string_split_regex(text, '[{WORD_BREAKS}]+'), lambda w: w <> '') AS words FROM docs),
windows AS (
  SELECT rid, unnest(range(0, len(words) - {WINDOW - 1})) AS i, words FROM split WHERE len(words) >= {WINDOW}),
grams AS (SELECT rid, i, array_to_string(words[i + 1 : i + {WINDOW}], ' ') AS g FROM windows),
repeated AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + j) AS n FROM repeated, range(0, {WINDOW}) t(j) GROUP BY rid),
counts AS (
  SELECT d.rid, d.doc_id, d.lang, len(s.words) AS n_words,
         length(translate(text, {spaces}, '')) AS word_chars,
         {n_of(SYMBOLS)} AS n_symbols, {n_of(CAPITALS)} AS n_capitals, {n_of("!")} AS n_exclamations,
         len(list_filter(string_split(text, chr(10)), lambda l: translate(l, {spaces}, '') <> '')) AS n_lines,
         len(list_filter(string_split(text, chr(10)), lambda l: translate(l, {spaces}, '') <> ''))
           - len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: translate(l, {spaces}, '') <> ''))) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM docs d JOIN split s USING (rid) LEFT JOIN covered c USING (rid)),
judged AS (
  SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AS base_failed FROM counts),
truth AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
labelled AS (SELECT j.*, t.quality FROM judged j JOIN truth t USING (doc_id) WHERE NOT base_failed),
scores AS ({scores}),
grid AS ({grid}),
tried AS (
  SELECT s.lang, s.rule, g.cutoff, g.step, count(*) FILTER (quality = 1) AS n,
         count(*) FILTER (quality = 1 AND score > cutoff) AS k, count(*) FILTER (quality <> 1 AND score > cutoff) AS gain
  FROM scores s JOIN grid g USING (rule) GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k > n * {rate!r} THEN FALSE ELSE
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln({rate!r}) + (n - i) * ln({1 - rate!r}))))
    <= {delta!r} / (SELECT greatest(1, count(*)) FROM (SELECT DISTINCT lang FROM labelled)) / {len(RULES)} END AS passes
  FROM tried),
valid AS (
  SELECT * FROM (SELECT *, max(CASE WHEN NOT passes THEN step END) OVER (PARTITION BY lang, rule) AS stop FROM tested)
  WHERE step > coalesce(stop, -1)),
best AS (
  SELECT lang, rule, cutoff FROM valid WHERE gain - {price} * k > 0
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain - {price} * k DESC, step DESC) = 1),
failed AS (
  SELECT rid, string_agg(a.rule, ',' ORDER BY pos) AS rules FROM ({all_scores}) a JOIN best b
  ON a.rule = b.rule AND a.lang IS NOT DISTINCT FROM b.lang WHERE score > cutoff GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_exclamations,
       base_failed, NOT base_failed AND f.rid IS NULL AS kept, coalesce(f.rules, '') AS failed_rules
FROM judged j LEFT JOIN failed f ON j.rid = f.rid
"""
