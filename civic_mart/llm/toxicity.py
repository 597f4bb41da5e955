"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A step's input is a word: its hashed word embedding beside the mean of its hashed
character trigram embeddings.  A text is read in overlapping windows; in each window two
recurrent passes (one per direction) give states, attention pools them, and a logistic
unit scores the window.  A text's score is its highest window's.

Training is plain numpy (back-propagation through time, Adam for the network and SGD for
the embeddings) on a bounded sample of labelled rows, whole texts each.  A label speaks of a whole text,
so after a first phase only the windows of a toxic text that score near its best stay.  The sizes are small: the work is done once a word and window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm.common import crc_mod, materialize, table, text_of
from civic_mart.llm.pieces import batches_of

WINDOW, STRIDE = 64, 48
HIDDEN, DIM = 8, 8
WORD_BUCKETS, CHAR_BUCKETS = 1 << 17, 1 << 15
SAMPLE_POSITIVE, SAMPLE_NEGATIVE = 900, 1_600  # labelled rows that the model is fitted on
SAMPLE_BYTES = 24_000_000                      # and no further row once their whole texts hold so much
THRESHOLD = 0.3
DROPOUT = 0.25
MIN_STEPS = 100  # training steps of a phase at least
MIN_TEXTS = 4  # sampled texts that must hold a word for it to have an embedding; the rest share one
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8").split()


def window_starts(n: int) -> list[int]:
    """Starts of the windows of a text of ``n`` words: every STRIDE, the last one reaching the end."""
    if n <= WINDOW:
        return [0] if n else []
    starts = list(range(0, n - WINDOW, STRIDE))
    return [*starts, n - WINDOW]


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket of each word, trigram buckets of all, offsets of the words in them)."""
    bare = [w.strip(_PUNCTUATION) or w for w in words]
    bucket = np.fromiter((zlib.crc32(w) for w in bare), np.int64, len(bare)) % WORD_BUCKETS
    flat = np.frombuffer(b"".join(b"^" + w + b"$" for w in bare) + b"  ", np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, bare), np.int64, len(bare)) + 2
    ends = np.cumsum(size)
    keep = np.ones(len(flat) - 2, bool)
    keep[ends - 1], keep[ends - 2] = False, False  # a trigram stays inside its word
    h = (flat[:-2] << np.uint64(16)) | (flat[1:-1] << np.uint64(8)) | flat[2:]
    h = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % CHAR_BUCKETS
    return bucket, h[keep], np.concatenate([[0], np.cumsum(size - 2)])


def sum_rows(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices and the sums of their rows."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    first = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
    return index[first], np.add.reduceat(values[order], first, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BiGru:
    """Parameters by name; ``e_*`` are the embeddings."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    prior: float = 0.0
    shift: float = 0.0  # a text's probability is the logistic of its highest logit + shift
    known: np.ndarray = field(default_factory=lambda: np.ones(WORD_BUCKETS, bool))  # buckets of frequent words

    @classmethod
    def fresh(cls, seed: int) -> BiGru:
        rng = np.random.default_rng(seed)
        draw = lambda s, *shape: rng.normal(0, s, shape).astype(np.float32)
        p = {"e_word": draw(0.05, WORD_BUCKETS, DIM), "e_char": draw(0.2, CHAR_BUCKETS, DIM)}
        for d in "fb":
            p |= {f"x_{d}": draw(0.3, 2 * DIM, 3 * HIDDEN), f"u_{d}": draw(0.3, HIDDEN, 3 * HIDDEN),
                  f"c_{d}": np.zeros(3 * HIDDEN, np.float32)}
        p |= {"wa": draw(0.3, 2 * HIDDEN, 2 * HIDDEN), "va": draw(0.3, 2 * HIDDEN), "out": draw(0.3, 2 * HIDDEN),
              "bias": np.full(1, -1.5, np.float32)}
        return cls(p)

    def inputs(self, features) -> np.ndarray:
        bucket, grams, at = features
        bucket = np.where(self.known[bucket], bucket, 0)
        chars = np.zeros((len(bucket), DIM), np.float32)
        size = np.diff(at)
        if len(grams):
            full = size > 0
            chars[full] = np.add.reduceat(self.p["e_char"][grams], at[:-1][full], axis=0)
        return np.concatenate([self.p["e_word"][bucket], chars / np.maximum(size, 1)[:, None]], 1)

    def _pass(self, gx: np.ndarray, idx: np.ndarray, live: np.ndarray, d: str, keep: list | None):
        u, n = self.p[f"u_{d}"], len(idx)
        h = np.zeros((n, HIDDEN), np.float32)
        states = np.empty((idx.shape[1], n, HIDDEN), np.float32)
        for t in range(idx.shape[1]) if d == "f" else range(idx.shape[1] - 1, -1, -1):
            g, hu = gx[idx[:, t]], h @ u
            zr = _sigmoid(g[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            cand = np.tanh(g[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
            m = live[:, t:t + 1]
            if keep is not None:
                keep.append((t, h, z, r, cand, hu[:, 2 * HIDDEN:], m))
            h = np.where(m, cand + z * (h - cand), h)
            states[t] = h
        return states

    def forward(self, x: np.ndarray, idx: np.ndarray, live: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logit of each window; ``idx`` are rows of the word inputs ``x``, ``live`` marks real words."""
        kept = {"f": [], "b": []}
        both = np.concatenate([self._pass(x @ self.p[f"x_{d}"] + self.p[f"c_{d}"], idx, live, d,
                                          kept[d] if trace is not None else None) for d in "fb"], 2)
        act = np.tanh(both @ self.p["wa"])  # [steps, windows, 2H]
        a = np.where(live.T, act @ self.p["va"], -1e9)
        a = np.exp(a - a.max(0))
        a *= live.T
        a /= np.maximum(a.sum(0), 1e-9)
        pooled = (a[:, :, None] * both).sum(0)
        if trace is not None:
            trace |= {"kept": kept, "both": both, "act": act, "a": a, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gradients(self, features, idx: np.ndarray, live: np.ndarray, y: np.ndarray,
                  drop: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Gradients of the mean loss; ``drop`` scales the word inputs (dropout)."""
        p, trace = self.p, {}
        x = self.inputs(features)
        if drop is not None:
            x = x * drop
        d_logit = ((_sigmoid(self.forward(x, idx, live, trace)) - y) / len(y)).astype(np.float32)
        both, act, a, pooled = trace["both"], trace["act"], trace["a"], trace["pooled"]
        g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()])}
        d_pool = d_logit[:, None] * p["out"]
        d_a = (both * d_pool).sum(2)
        d_a = a * (d_a - (a * d_a).sum(0))
        g["va"] = (act * d_a[:, :, None]).sum((0, 1))
        d_act = d_a[:, :, None] * p["va"] * (1 - act ** 2)
        g["wa"] = both.reshape(-1, 2 * HIDDEN).T @ d_act.reshape(-1, 2 * HIDDEN)
        d_both = a[:, :, None] * d_pool + d_act @ p["wa"].T
        d_x = np.zeros_like(x)
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            u = p[f"u_{d}"]
            d_h = np.zeros_like(both[0, :, part])
            d_steps, d_u = np.empty((idx.shape[1], len(idx), 3 * HIDDEN), np.float32), np.zeros_like(u)
            for t, h, z, r, cand, hn, m in reversed(trace["kept"][d]):
                d_new = d_h + d_both[t, :, part]
                d_on = np.where(m, d_new, 0)
                d_n = d_on * (1 - z) * (1 - cand ** 2)
                d_z = d_on * (h - cand) * z * (1 - z)
                d_r = d_n * hn * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_n * r], 1)
                d_steps[t] = np.concatenate([d_z, d_r, d_n], 1)
                d_u += h.T @ d_hu
                d_h = np.where(m, d_on * z, d_new) + d_hu @ u.T
            d_gx = np.zeros((len(x), 3 * HIDDEN), np.float32)
            seen, total = sum_rows(idx.T.reshape(-1), d_steps.reshape(-1, 3 * HIDDEN))
            d_gx[seen] = total
            g |= {f"u_{d}": d_u, f"x_{d}": x.T @ d_gx, f"c_{d}": d_gx.sum(0)}
            d_x += d_gx @ p[f"x_{d}"].T
        if drop is not None:
            d_x *= drop
        bucket, grams, at = features
        g["e_word"], g["e_char"] = (np.where(self.known[bucket], bucket, 0), d_x[:, :DIM]), (grams, np.repeat(
            d_x[:, DIM:] / np.maximum(np.diff(at), 1)[:, None], np.diff(at), axis=0))
        return g

    def window_logits(self, texts: list[str]) -> list[np.ndarray]:
        """Logits of every window of every text."""
        vocab: dict[bytes, int] = {}
        idx, counts = [], []
        for t in texts:
            ids = [vocab.setdefault(w, len(vocab)) for w in words_of(t)]
            starts = window_starts(len(ids))
            idx += [ids[s:s + WINDOW] for s in starts]
            counts.append(len(starts))
        scores = np.empty(len(idx))
        if idx:
            x = self.inputs(word_features(list(vocab)))
            order = sorted(range(len(idx)), key=lambda i: len(idx[i]))  # short windows run few steps
            for i in range(0, len(order), 1024):
                some = order[i:i + 1024]
                m, live = pad([idx[j] for j in some])
                scores[some] = self.forward(x, m, live)
        return np.split(scores, np.cumsum(counts)[:-1]) if counts else []

    def scores(self, texts: list[str]) -> np.ndarray:
        """Score of every text: its highest window's; 0 without words."""
        if not self.p:
            return np.full(len(texts), self.prior)
        top = [s.max() if len(s) else -np.inf for s in self.window_logits(texts)]
        return np.array([_sigmoid(t + self.shift) if t > -np.inf else 0.0 for t in top])

    def calibrate(self, top: np.ndarray, y: np.ndarray, share: float) -> None:
        """Shift the logits so that ``THRESHOLD`` is the split of least error on texts that the
        training did not see, ``share`` being label 1's share among labelled texts."""
        if not len(y) or y.min() == y.max():
            return
        x = np.sort(top)
        cuts = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
        missed = np.searchsorted(np.sort(top[y == 1]), cuts) / (y == 1).sum()
        false = 1 - np.searchsorted(np.sort(top[y == 0]), cuts) / (y == 0).sum()
        error = share * missed + (1 - share) * false
        best = cuts[error <= error.min() + 1e-12]
        self.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - (best[0] + best[-1]) / 2)


def pad(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(index matrix, mask of real entries) as wide as the longest row."""
    size = np.array([len(r) for r in rows])
    live = np.arange(size.max()) < size[:, None]
    out = np.zeros(live.shape, np.int64)
    out[live] = np.concatenate([np.asarray(r) for r in rows])
    return out, live


def train(texts: list[str], y: np.ndarray, share: float = 0.1, seed: int = 5, epochs: tuple[int, int, int] = (2, 2, 3),
          rate: float = 0.01) -> BiGru:
    """Fit on all windows of whole texts that have words, with labels 0 or 1."""
    if not len(y) or y.min() == y.max():
        return BiGru(prior=float(y.mean()) if len(y) else 0.0)
    model, rng = BiGru.fresh(seed), np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, fitted = (order[:len(y) // 4], order[len(y) // 4:]) if len(y) >= 100 else (order[:0], order)
    if y[fitted].min() == y[fitted].max():
        held, fitted = order[:0], order
    apart, apart_y = [texts[i] for i in held], y[held]
    texts, y = [texts[i] for i in fitted], y[fitted]
    vocab: dict[bytes, int] = {}
    windows, sizes = [], []
    for t in texts:
        ids = [vocab.setdefault(w, len(vocab)) for w in words_of(t)]
        starts = window_starts(len(ids))
        windows += [ids[s:s + WINDOW] for s in starts]
        sizes.append(len(starts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    bucket, grams, at = word_features(list(vocab))
    label = y[owner].astype(np.float32)
    in_texts = np.zeros(len(vocab), np.int64)
    for first, last in zip(np.searchsorted(owner, np.arange(len(texts))), np.searchsorted(owner, np.arange(1, len(texts) + 1))):
        in_texts[np.unique(np.concatenate([windows[i] for i in range(first, last)]).astype(np.int64))] += 1
    per_bucket = np.zeros(WORD_BUCKETS, np.int64)
    np.maximum.at(per_bucket, bucket, in_texts)
    model.known = per_bucket >= MIN_TEXTS
    use = np.arange(len(windows))
    mean, square, step = {}, {}, 0

    def some(batch: np.ndarray):
        m, live = pad([windows[i] for i in batch])
        seen, m = np.unique(m, return_inverse=True)
        spans = [np.arange(at[i], at[i + 1]) for i in seen]
        features = (bucket[seen], grams[np.concatenate(spans)], np.concatenate([[0], np.cumsum([len(s) for s in spans])]))
        return features, m.reshape(live.shape), live

    for phase, rounds in enumerate(epochs):
        if phase:  # of a toxic text only its higher windows: its label need not speak of the others
            s = np.concatenate([_sigmoid(model.forward(model.inputs(f), m, live)) for f, m, live in
                                (some(np.arange(i, min(i + 512, len(windows)))) for i in range(0, len(windows), 512))])
            top = np.zeros(len(texts))
            np.maximum.at(top, owner, s)
            hard = s >= np.quantile(s[label == 0], 0.5)  # of the others, the harder half and a part of the rest
            use = np.flatnonzero(np.where(label == 1, s >= (0.5, 0.9)[phase - 1] * top[owner],
                                          hard | (rng.random(len(s)) < 0.1)))
        size = min(256, max(32, len(use) // 24))
        for _ in range(max(rounds, -(-MIN_STEPS * size // len(use)))):  # small samples are read more often
            order = rng.permutation(use)
            for i in range(0, len(order), size):
                batch = order[i:i + size]
                features, m, live = some(batch)
                drop = ((rng.random((len(features[0]), 2 * DIM)) > DROPOUT) / (1 - DROPOUT)).astype(np.float32)
                grads = model.gradients(features, m, live, label[batch], drop)
                step += 1
                for k, g in grads.items():
                    if k.startswith("e_"):
                        # a summed gradient, clipped row by row, so that frequent words learn and rare ones hardly move
                        seen, total = sum_rows(*g)
                        model.p[k][seen] -= np.clip(20 * total, -0.1, 0.1)
                        continue
                    mean[k] = 0.9 * mean.get(k, 0) + 0.1 * g
                    square[k] = 0.99 * square.get(k, 0) + 0.01 * g * g
                    model.p[k] = (model.p[k] - rate * (mean[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    if len(held):
        model.calibrate(np.concatenate([[s.max() for s in model.window_logits(apart[a:b])]
                                        for a, b in batches_of(apart, 500_000)]), apart_y, share)
    return model


def _labelled_ids(labels: DataFrame, positive: int, negative: int) -> DataFrame:
    """At most so many (doc_id, toxic) of either label, chosen by a hash of the id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_mod("doc_id", 4) != 2)).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))  # repeated labels: toxic if any says so
    pick = lambda v, n: known.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(n)
    return pick(1, positive).unionByName(pick(0, negative))


def fit(docs: DataFrame, labels: DataFrame, positive: int = SAMPLE_POSITIVE,
        negative: int = SAMPLE_NEGATIVE) -> BiGru:
    """Train on the whole texts of at most ``positive`` + ``negative`` labelled rows.

    Rows are taken by a hash of their id; a label's rows end with the one that brings their
    texts to the label's part of ``SAMPLE_BYTES``, so that few rows are read of very long texts."""
    ids = _labelled_ids(labels, positive, negative)  # at most positive + negative rows
    found = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(ids), "doc_id").limit(positive + negative).withColumn("place", F.xxhash64("doc_id", F.lit(3))),
        "toxicity-sample")
    sizes = found.select("toxic", "place", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).toPandas()
    taken = F.lit(False)
    for label, most in ((1, positive), (0, negative)):
        own = sizes[sizes["toxic"] == label].sort_values("place")
        own = own[own["size"].cumsum() - own["size"] < SAMPLE_BYTES * most / (positive + negative)]
        if len(own):
            taken = taken | ((F.col("toxic") == label) & (F.col("place") <= int(own["place"].max())))
    found = found.where(taken).select("doc_id", "toxic", "text").toPandas()
    found = found.sort_values("doc_id", kind="stable")  # the same order on every run
    found = found[np.array([bool(words_of(text_of(t))) for t in found["text"]], bool)]
    share = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod("doc_id", 4) != 2)).agg(
        F.avg("toxic")).first()[0]
    return train(found["text"].tolist(), found["toxic"].to_numpy(np.int64), share or 0.0)


def score(text: Column, model: BiGru) -> Column:
    @F.pandas_udf("double")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            texts = [text_of(t) for t in s]
            yield pd.Series(np.concatenate([model.scores(texts[a:b]) for a, b in batches_of(texts, 500_000)])
                            if texts else np.empty(0))

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs(doc_id, text)``.

    Learns from ``labels(doc_id, toxic)`` whose crc32(doc_id) mod 4 is not 2.  Null, empty
    and blank texts score 0.  Without labels of both values the score is the share of label
    1 (0 without any).  Repeated rows and null ids give rows of their own; an empty table
    gives an empty result; other columns are ignored."""
    model = fit(docs, labels)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text"), model).alias("score")).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
