"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's letters (lower-cased, words marked at both ends) are cut into subwords
of two to four characters; each is hashed to a bucket with an embedding, and the
mean of the embeddings goes through a linear softmax.  Embeddings and softmax
are trained together by stochastic gradient descent on a bounded sample of
labelled documents; a part of the sample is kept aside to fit the temperature
of the probabilities and the score below which a prediction is rejected.  Since
the mean is linear, the trained model folds into one row of logits per bucket.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pieces_of

BUCKETS, DIM = 1 << 15, 16
#: Labelled documents that the model is fitted on (about; chosen by hash, evenly over the languages).
MAX_SAMPLE = 2400
#: Labelled documents of each language at least (about; all that there are, when fewer).
LEAST_SAMPLE = 50
#: More languages than this are an error, since the model and its sample grow with them; none is left out.
MOST_LANGUAGES = 500
EPOCHS, RATE, SEED = 6, 0.5, 3
#: Accuracy that accepted predictions must reach on the documents kept aside.
ACCEPT = 0.99
_PIECE = 1 << 16
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def subwords(text: str):
    """Buckets of the subwords of a text, in runs of bounded length (none without a letter)."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    for at in range(0, len(codes), _PIECE):
        part = codes[at : at + _PIECE + 3]
        letter = _letters()[part]
        if not letter.any():
            continue
        part = np.where(letter, part, np.uint32(32))
        h = part
        for n, odd in ((2, 0x9E3779B1), (3, 0xC2B2AE35), (4, 0x27D4EB2F)):
            if len(part) < n:
                break
            h = h[:-1] * np.uint32(odd) + part[n - 1 :]
            # breaks may stand at the ends, not within, and not alone
            whole = letter[:-1] | letter[1:] if n == 2 else letter[1:-1] if n == 3 else letter[1:-2] & letter[2:-1]
            yield ((h * np.uint32(0x85EBCA6B)) >> np.uint32(17))[:_PIECE][whole[:_PIECE]]


@dataclass(frozen=True)
class Model:
    """Logits per bucket, the languages, and the score that an accepted prediction needs."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    accept: float

    def predict(self, text: str | None) -> tuple[str, float]:
        total, n = np.zeros(len(self.languages)), 0
        for buckets in subwords(text or ""):
            total += self.logits[buckets].sum(axis=0, dtype=np.float64)
            n += len(buckets)
        if not n or not self.languages:
            return UNKNOWN, 0.0
        p = _softmax(total / n + self.bias)
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, p[best]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(samples: list[tuple[np.ndarray, np.ndarray]], truth: np.ndarray, languages: list[str]) -> Model:
    """Fit on (buckets, shares) of each sample text; every fifth text is kept aside for calibration."""
    rng = np.random.default_rng(SEED)
    c = len(languages)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, c), dtype=np.float32), np.zeros(c, dtype=np.float32)
    aside = np.arange(len(samples)) % 5 == 4
    own = np.flatnonzero(~aside)
    steps, done = max(1, EPOCHS * len(own)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(own):
            rate = RATE * (1 - done / steps)
            done += 1
            idx, share = samples[i]
            hidden = share @ emb[idx]
            miss = _softmax(hidden @ out + bias)
            miss[truth[i]] -= 1
            back = out @ miss
            out -= rate * np.outer(hidden, miss)
            bias -= rate * 0.1 * miss
            # a share is about 1 / len(idx): scaled so that a step moves the mean as far as it moves ``out``
            emb[idx] -= (rate * len(idx) ** 0.5 * share)[:, None] * back
    logits = emb @ out
    held = [i for i in np.flatnonzero(aside)]
    scale, accept = 1.0, 0.0
    if held:
        z = np.stack([samples[i][1] @ logits[samples[i][0]] + bias for i in held])
        y = truth[held]
        grid = np.geomspace(0.25, 8, 41)
        loss = [-np.log(np.maximum(_softmax(z * t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
        scale = float(grid[int(np.argmin(loss))])
        p = _softmax(z * scale)
        right, score = p.argmax(axis=1) == y, p.max(axis=1)
        order = np.argsort(-score, kind="stable")
        good = np.flatnonzero(np.cumsum(right[order]) >= ACCEPT * np.arange(1, len(order) + 1))
        accept = float(score[order[good[-1]]]) if len(good) else 1.0
    return Model(languages, (logits * scale).astype(np.float32), bias * scale, accept)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: CRC-32 of the id as text leaves 1 modulo 3; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_languages(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> Model:
    """Model from text and lang of the rows of ``docs`` that are not held out and have both and an id."""
    known = docs.filter("text is not null and lang is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in lang")
    if not counts:
        return Model([], np.zeros((BUCKETS, 0), dtype=np.float32), np.zeros(0), 1.0)
    languages = sorted(r["lang"] for r in counts)
    per = max(LEAST_SAMPLE, max_sample // len(languages))
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], int(min(1.0, per / r["n"]) * (1 << 32)))])
    known = known.select("doc_id", "lang", "text", F.xxhash64("text").alias("h"))
    draw = F.pmod(F.xxhash64("doc_id", "h", F.lit(SEED)), F.lit(1 << 32))
    # Rows that repeat id, language and text are drawn together and learned once, however many there are.
    sample = known.filter(draw < F.element_at(rates, F.col("lang"))).groupBy("doc_id", "lang", "h").agg(F.min("text").alias("text"))

    def run(batches):
        for whole in batches:
            for batch in pieces_of(whole):
                idx, share = [], []
                for text in batch.column("text").to_pylist():
                    all_ = np.concatenate([*subwords(text), np.empty(0, np.uint32)]).astype(np.int64)
                    u, n = np.unique(all_, return_counts=True)
                    idx.append(u.astype("<i4"))
                    share.append((n / max(1, n.sum())).astype("<f4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in ("doc_id", "lang", "h")],
                        pa.array(idx, pa.list_(pa.int32())),
                        pa.array(share, pa.list_(pa.float32())),
                    ],
                    names=["doc_id", "lang", "h", "idx", "share"],
                )

    # Bounded by the sample and the buckets: 2,400 rows of a few kilobytes each as a rule, 25,000 at most.
    rows = sample.mapInArrow(run, "doc_id long, lang string, h long, idx array<int>, share array<float>").toArrow()
    order = np.lexsort([rows.column("h").to_numpy(), rows.column("doc_id").to_numpy()])
    idx, share = rows.column("idx").combine_chunks(), rows.column("share").combine_chunks()
    langs = rows.column("lang").to_pylist()
    samples, truth = [], []
    for i in order:
        if len(idx[int(i)]):
            samples.append((idx[int(i)].values.to_numpy(), share[int(i)].values.to_numpy()))
            truth.append(languages.index(langs[int(i)]))
    return train(samples, np.array(truth, dtype=np.int64), languages)


def predict_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` for every input row.

    Learns from ``docs`` unless a model is given.  A null text or one without a
    letter is ``und`` with score 0, not accepted; with nothing to learn from all
    are.  Predictions read the text alone.  Repeated rows are predicted one by
    one, rows without an id are not held out and never learned from.
    """
    model = model or fit_languages(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for whole in batches:
            for batch in pieces_of(whole):
                found = [m.predict(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("held_out"),
                        pa.array([x for x, _ in found], pa.string()),
                        pa.array([s for _, s in found], pa.float64()),
                        pa.array([x != UNKNOWN and s >= m.accept for x, s in found], pa.bool_()),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score", "accepted"],
                )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")
