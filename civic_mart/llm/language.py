"""Language ID: averaged hashed subword embeddings under a linear softmax.

Subwords are the 1- to 3-grams of the lower-cased text's letters (anything else is one
boundary sign), hashed into buckets.  A text is the average of its buckets' embeddings;
a linear softmax gives the language.  Both are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled rows.  A part of the sample that the
training does not see calibrates the probabilities (a temperature) and the rejection
threshold.  For prediction the product of embeddings and softmax weights is one small
table, so a text costs a lookup and a sum per subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm.common import crc_mod, table, text_of
from civic_mart.llm.pieces import LETTER, batches_of, char_classes, code_points

BUCKETS = 1 << 14
SAMPLE_ROWS = 2_500      # labelled rows that the model is fitted on
CALIBRATION_SHARE = 0.2  # of them, kept from training
MIN_STEPS = 400          # training steps at least
REJECT_QUANTILE = 0.01   # share of right calibration answers that may be rejected
UNKNOWN = "und"


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all subwords, offsets of the texts in them)."""
    low = [t.lower() for t in texts]
    cps, at = code_points([f" {t} " for t in low])
    c = np.where(char_classes()[cps] == LETTER, cps, 0).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    out, whose = [], []
    for n in (1, 2, 3):
        m = len(c) - n + 1
        h, any_letter = np.full(max(m, 0), n, np.uint64), np.zeros(max(m, 0), bool)
        for j in range(n):
            part = c[j:j + m]
            h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
            any_letter |= part > 0
        any_letter &= owner[:m] == owner[n - 1:n - 1 + m]
        out.append(((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(50)).astype(np.int64)[any_letter])
        whose.append(owner[:m][any_letter])
    buckets, owners = np.concatenate(out), np.concatenate(whose)
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.searchsorted(owners[order], np.arange(len(texts) + 1))


@dataclass
class LanguageModel:
    """``weights[bucket, language]`` already include the embeddings; ``names`` are sorted."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities, whether the text has a letter)."""
        buckets, at = subwords(texts)
        sizes = np.diff(at)
        sums = np.zeros((len(texts), len(self.names)))
        full = sizes > 0
        if full.any():
            sums[full] = np.add.reduceat(self.weights[buckets], at[:-1][full], axis=0, dtype=np.float64)
        x = (sums / np.maximum(sizes, 1)[:, None] + self.bias) / self.temperature
        x = np.exp(x - x.max(1, keepdims=True))
        return x / x.sum(1, keepdims=True), full


def train(rows: list[tuple[list[int], list[float], str]], dim: int = 16, epochs: int = 12, rate: float = 2.0,
          seed: int = 7) -> LanguageModel | None:
    """Fit on (buckets, shares of them, language) rows; None without rows."""
    if not rows:
        return None
    names = sorted({r[2] for r in rows})
    y = np.array([names.index(r[2]) for r in rows])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    cut = int(len(rows) * CALIBRATION_SHARE) if len(rows) >= 50 else 0
    held, fit = order[:cut], order[cut:]
    emb = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    soft, bias = np.zeros((dim, len(names)), np.float32), np.zeros(len(names), np.float32)

    def dense(which: np.ndarray) -> np.ndarray:
        x = np.zeros((len(which), BUCKETS), np.float32)
        for i, k in enumerate(which):
            x[i, rows[k][0]] = rows[k][1]
        return x

    epochs = max(epochs, -(-MIN_STEPS * 64 // len(fit)))  # small samples are read more often
    steps = epochs * -(-len(fit) // 64)
    step = 0
    for _ in range(epochs):
        fit = rng.permutation(fit)
        for i in range(0, len(fit), 64):
            batch = fit[i:i + 64]
            x, lr = dense(batch), rate * (1 - step / steps) + 0.05
            step += 1
            mean = x @ emb
            logit = mean @ soft + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            d_mean = p @ soft.T
            soft -= lr * (mean.T @ p)
            bias -= lr * p.sum(0)
            emb -= lr * 20 * (x.T @ d_mean)  # a bucket holds a small share of a text
    model = LanguageModel(names, emb @ soft, bias)
    if cut:
        logit = np.concatenate([dense(held[i:i + 256]) @ model.weights + bias for i in range(0, cut, 256)])

        def probabilities(t: float) -> np.ndarray:
            e = np.exp((logit - logit.max(1, keepdims=True)) / t)
            return e / e.sum(1, keepdims=True)

        loss = {t: -np.log(probabilities(t)[np.arange(cut), y[held]] + 1e-12).mean()
                for t in np.geomspace(0.05, 5, 41)}
        model.temperature = float(min(loss, key=loss.get))
        p = probabilities(model.temperature)
        right = p.max(1)[p.argmax(1) == y[held]]
        model.reject_below = float(np.quantile(right, REJECT_QUANTILE)) if len(right) else 0.0
    return model


def sample_rows(docs: DataFrame, usable: Column, n: int, label: str) -> DataFrame:
    """At most ``n`` usable rows (doc_id, text, label), chosen by a hash of the id.

    Ids are chosen without reading texts; the id list, at most ``n`` rows, is broadcast."""
    ids = docs.where(usable).select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(n)
    return docs.where(usable).select("doc_id", "text", label).join(F.broadcast(ids), "doc_id", "left_semi").limit(n)


def fit(docs: DataFrame, usable: Column, n: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Train on at most ``n`` rows of ``docs(doc_id, text, lang)``; the features are made by the tasks."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, langs, out = [text_of(t) for t in pdf["text"]], list(pdf["lang"]), []
            for first, last in batches_of(texts, 200_000):
                buckets, at = subwords(texts[first:last])
                for i, lang in enumerate(langs[first:last]):
                    own, count = np.unique(buckets[at[i]:at[i + 1]], return_counts=True)
                    if len(own):
                        out.append((own, (count / count.sum()).astype(np.float32), lang))
            yield pd.DataFrame(out, columns=["buckets", "shares", "lang"])

    sample = sample_rows(docs, usable & F.col("lang").isNotNull(), n, "lang")
    found = sample.mapInPandas(rows, "buckets array<int>, shares array<float>, lang string").toPandas()
    found = found.assign(first=[b[0] if len(b) else 0 for b in found["buckets"]], size=found["buckets"].map(len))
    found = found.sort_values(["lang", "size", "first"], kind="stable")  # the same order on every run
    return train(list(zip(found["buckets"], found["shares"], found["lang"])))


def predict(text: Column, model: LanguageModel | None) -> Column:
    """Struct (lang_pred, score, rejected) of a text column."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in series:
            texts = [text_of(t) for t in s]
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if model:
                for a, b in batches_of(texts, 200_000):
                    p, has = model.probabilities(texts[a:b])
                    best = p.argmax(1)
                    names[a:b] = np.where(has, np.array(model.names, object)[best], UNKNOWN)
                    scores[a:b] = np.where(has, p[np.arange(b - a), best], 0.0)
            below = model.reject_below if model else 1.0
            yield pd.DataFrame({"lang_pred": names, "score": scores, "rejected": (names == UNKNOWN) | (scores < below)})

    return run(text)


def language_id(docs: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)`` for each row of ``docs(doc_id, text, lang)``.

    Learns from rows whose crc32(doc_id) mod 5 is not 0 with a language.  A text that is
    null or has no letter is ``und`` with score 0 and rejected; so is every text if there
    is nothing to learn from.  ``rejected`` marks answers below the calibrated threshold.
    Repeated rows and null ids give rows of their own; an empty table an empty result."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    held = crc_mod("doc_id", 5) == 0
    model = fit(d, ~held, sample)
    return d.select("doc_id", held.alias("held_out"), predict(F.col("text"), model).alias("p")).select(
        "doc_id", "held_out", "p.*")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
