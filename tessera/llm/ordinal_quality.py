"""Quality grades by ordinal cumulative-link regression on hashed text features.

Ratings are grades 0 .. G.  One weight vector over hashed features gives a
score f(x); ordered thresholds t_1 < ... < t_G turn it into
P(grade < g) = sigmoid(t_g - f(x)), so all grades share the weights.  From that
follow the expected grade and, for selection, the probability that a document
reaches a wanted grade.  Weights and thresholds are fitted by stochastic
gradient descent on a bounded sample of rated documents; every document is then
scored on its whole text.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pieces_of

BUCKETS = 1 << 17
#: Rated documents of each grade that the model is fitted on (about; chosen by hash).
MAX_PER_GRADE = 1500
#: Features in fewer sample documents than this keep weight zero.
LEAST_DOCS = 15
EPOCHS, RATE, DECAY, SEED = 25, 0.3, 2e-4, 5
GRADES, WANTED = 2, 2
#: Share of the documents of the wanted grade that the cutoff may lose.
LOST = 0.015

#: Letters (lower case) and digits stay words; other ASCII characters but white space stay marks.
_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
_MARKS = bytes(c if 0x21 <= c <= 0x7E and not chr(c).isalnum() else 0x20 for c in range(256))
_CAPITALS = bytes(range(0x41, 0x5B))
_NUMERIC = (b"\x00capitals", b"\x00same", b"\x00windows", b"\x00lines", b"\x00length")
#: Bytes of a word's beginning that make features of their own.
STARTS = (4, 5, 6)


def toxic_aware_grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 of low quality, 2 good; null without a quality label."""
    return F.when(quality.isNull(), None).when(F.coalesce(toxic, F.lit(0)) == 1, 0).when(quality == 0, 1).otherwise(2).cast("int")


class Features:
    """Buckets and values of a text's features.

    Words and their beginnings and runs of marks count by their rate in the
    text; shares of capitals, of words that repeat the one before them, of
    five-word windows and of lines that repeat, and the length are one each.
    """

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def bucket(self, name: bytes) -> int:
        at = self.known.get(name)
        if at is None:
            if len(self.known) > 400_000:
                self.known.clear()
            at = self.known[name] = xxhash.xxh3_64_intdigest(name) % BUCKETS
        return at

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.translate(_WORDS).split()
        n = max(1, len(words))
        counts = Counter(words)
        starts: Counter = Counter()
        for word, k in counts.items():
            for size in STARTS:
                if len(word) >= size:
                    starts[b"\x00start " + word[:size]] += k
        marks = Counter(text.translate(_MARKS).split())
        lines = [x for x in text.split(b"\n") if x.strip()]
        windows = set(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
        capitals = len(text) - len(text.translate(None, _CAPITALS))
        shares = (
            capitals / max(1, len(text)),
            sum(map(bytes.__eq__, words, words[1:])) / n,
            1 - len(windows) / max(1, len(words) - 4) if len(words) > 4 else 0.0,
            1 - len(set(lines)) / max(1, len(lines)),
        )
        names = [*counts, *starts, *(b"\x00mark " + m for m in marks), *_NUMERIC]
        size = np.array([*counts.values(), *starts.values(), *marks.values()], dtype=np.float32) * (1000.0 / n)
        more = [*(np.log1p(1000 * min(1.0, x)) for x in shares), np.log1p(n)]
        values = np.concatenate([np.log1p(size), np.array(more, dtype=np.float32)])
        return np.fromiter(map(self.bucket, names), dtype=np.int64, count=len(names)), values * np.float32(0.1)


def _sigmoid(x: np.ndarray | float):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Model:
    """Feature weights, ordered thresholds (none when nothing was rated), and the tail probability that selects."""

    weights: np.ndarray
    thresholds: np.ndarray
    cutoff: float

    def below(self, buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
        """P(grade < g) for g = 1 .. G."""
        return _sigmoid(self.thresholds - float(self.weights[buckets] @ values))


def train(
    samples: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int = GRADES, wanted: int = WANTED
) -> Model:
    """Fit by stochastic gradient ascent of the cumulative-link likelihood, all grades weighing the same.

    Every fifth text is kept aside: the cutoff is the tail probability, a half at
    most, that all but the share LOST of those with the wanted grade reach.
    """
    if not len(samples):
        return Model(np.zeros(BUCKETS, dtype=np.float32), np.empty(0), 0.0)
    rng = np.random.default_rng(SEED)
    aside = np.arange(len(samples)) % 5 == 4
    whole, truth = samples, grades
    samples, grades = [x for x, a in zip(samples, aside, strict=True) if not a], grades[~aside]
    docs = np.bincount(np.concatenate([i for i, _ in samples]), minlength=BUCKETS)
    common = docs >= LEAST_DOCS
    samples = [(i[common[i]], v[common[i]]) for i, v in samples]
    weigh = len(grades) / np.maximum(1, np.bincount(grades, minlength=n_grades + 1)) / (n_grades + 1)
    w = np.zeros(BUCKETS)
    t = np.linspace(-0.5, 0.5, n_grades)
    steps, done = EPOCHS * len(samples), 0
    total, kept = np.zeros(BUCKETS), 0
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(samples)):
            rate = RATE * (1 - done / steps) + 1e-3
            done += 1
            i, v = samples[k]
            g = grades[k]
            f = w[i] @ v
            low = _sigmoid(t[g - 1] - f) if g > 0 else 0.0
            high = _sigmoid(t[g] - f) if g < n_grades else 1.0
            p = max(high - low, 1e-9)
            d_low, d_high = low * (1 - low), high * (1 - high)
            step = rate * min(weigh[g], 5.0) / p
            w[i] += np.clip(step * (d_low - d_high), -2, 2) * v - rate * DECAY * w[i]
            if g > 0:
                t[g - 1] -= np.clip(step * d_low, -0.5, 0.5) * 0.2
            if g < n_grades:
                t[g] += np.clip(step * d_high, -0.5, 0.5) * 0.2
            t = np.maximum.accumulate(t + np.arange(n_grades) * 1e-6)
        if epoch >= EPOCHS // 2:  # averaged weights settle the last steps
            total += w
            kept += 1
    model = Model((total / max(1, kept)).astype(np.float32), t, 0.5)
    good = [1 - model.below(*whole[k])[wanted - 1] for k in np.flatnonzero(aside & (truth >= wanted))]
    return replace(model, cutoff=min(0.5, float(np.quantile(good, LOST)))) if good else model


def fit_grades(docs: DataFrame, ratings: DataFrame, n_grades: int = GRADES, max_per_grade: int = MAX_PER_GRADE) -> Model:
    """Model from the rated documents; ``ratings`` has doc_id and grade (0 .. ``n_grades``, null unrated).

    Of several grades of a document the lowest holds.
    """
    rated = ratings.filter(f"doc_id is not null and grade between 0 and {n_grades}").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    counts = {r["grade"]: r["n"] for r in rated.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], np.empty(0, dtype=np.int64), n_grades)
    rate = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, int(min(1.0, max_per_grade / n) * (1 << 32)))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 32))
    chosen = rated.filter(draw < F.element_at(rate, F.col("grade")))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter("text is not null")
    # The sample is bounded by max_per_grade, so its ids may go to every task.  Of several rows of an
    # id one is learned from: an id that fills a third of the table is one row on the driver.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))

    def run(batches):
        features = Features()
        for whole in batches:
            for batch in pieces_of(whole):
                found = [features.of(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("grade"),
                        pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                        pa.array([v for _, v in found], pa.list_(pa.float32())),
                    ],
                    names=["doc_id", "grade", "idx", "val"],
                )

    kind = dict(sample.dtypes)
    rows = sample.select("doc_id", F.col("grade").cast("int").alias("grade"), "text")
    rows = rows.mapInArrow(run, f"doc_id {kind['doc_id']}, grade int, idx array<int>, val array<float>").toArrow()
    idx, val = rows.column("idx").combine_chunks(), rows.column("val").combine_chunks()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable").tolist()
    samples = [(idx[k].values.to_numpy().astype(np.int64), val[k].values.to_numpy()) for k in order]
    return train(samples, rows.column("grade").to_numpy()[order].astype(np.int64), n_grades)


def grade_documents(docs: DataFrame, model: Model, wanted: int = WANTED, cutoff: float | None = None) -> DataFrame:
    """``doc_id, expected_grade, tail_prob, kept`` for every input row.

    ``tail_prob`` is the probability of reaching the grade ``wanted``; ``kept``
    holds when it is at least ``cutoff`` (the model's own by default).  Null, empty and wordless
    texts have grade 0 and are not kept.  Without any rating the grade and the
    probability are null and every text with a word is kept.  Repeated rows and
    rows without an id are graded one by one; further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    least = model.cutoff if cutoff is None else cutoff

    def run(batches):
        m, features = shared.value, Features()

        def grade(text):
            if not text or not text.translate(_WORDS).split():
                return 0.0, 0.0, False
            if not len(m.thresholds):
                return None, None, True
            above = 1 - m.below(*features.of(text))
            return float(above.sum()), float(above[wanted - 1]), bool(above[wanted - 1] >= least)

        for whole in batches:
            for batch in pieces_of(whole):
                found = [grade(t) for t in batch.column("text").to_pylist()]
                kinds = (pa.float64(), pa.float64(), pa.bool_())
                cols = [pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "expected_grade", "tail_prob", "kept"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, expected_grade double, tail_prob double, kept boolean")
