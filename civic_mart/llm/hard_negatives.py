"""Hard-negative mining with exact whole-number products.

Anchors meet all rows in a grid of blocks: a task holds one block of anchors and one block
of candidates, multiplies them tile by tile with Strassen's recursion on int64 (zero padding
to even sizes, whole-number additions, so every score is exact), and keeps per anchor a heap
of its best positives, then per anchor and positive a heap of its best negatives in the
window.  Heaps of different blocks merge into one: the best of the bests.

Two passes, as a window is known only after its positive.  The first multiplies rows of
equal labels only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civic_mart.llm.common import materialize, table

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
WINDOW_PERCENT = (50, 95)
RELABEL_EVERY, RELABEL_MODULUS = 7, 10
BLOCK_ROWS = 2_048         # rows of a block; fewer where vectors are long
BLOCK_BYTES = 32 << 20     # of a block's whole numbers
TILE = 512                 # rows and columns of a tile
LEAF = 32                  # sides up to this are multiplied plainly
_LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of int64 matrices by Strassen's seven half-size products.

    Odd sides are padded with zeros.  Sums that leave 64 bits on the way wrap round and come
    back, so the product is exact wherever it fits 64 bits itself."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    if n % 2 or k % 2 or m % 2:
        a = np.pad(a, ((0, n % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, m % 2)))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    out = np.empty((2 * h, 2 * j), np.int64)
    p = strassen(a11 + a22, b11 + b22, leaf)
    out[:h, :j] = p
    out[h:, j:] = p
    p = strassen(a21 + a22, b11, leaf)
    out[h:, :j] = p
    out[h:, j:] -= p
    p = strassen(a11, b12 - b22, leaf)
    out[:h, j:] = p
    out[h:, j:] += p
    p = strassen(a22, b21 - b11, leaf)
    out[:h, :j] += p
    out[h:, :j] += p
    p = strassen(a11 + a12, b22, leaf)
    out[:h, :j] -= p
    out[:h, j:] += p
    out[h:, j:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:h, :j] += strassen(a12 - a22, b21 + b22, leaf)
    return out[:n, :m]


class Heaps:
    """The best ``size`` (score, column) of each row: highest score, then smallest column."""

    def __init__(self, rows: int, size: int) -> None:
        self.score = np.full((rows, size), _LEAST)
        self.column = np.full((rows, size), -1, np.int64)

    def merge(self, rows: np.ndarray, scores: np.ndarray, columns: np.ndarray) -> None:
        """Takes in candidates: (rows, n) scores, columns ascending and above those held; -2^63 is none."""
        size = self.score.shape[1]
        ahead = scores.max(1, initial=_LEAST) > self.score[rows, -1]  # a tie loses to the smaller column
        rows, scores = rows[ahead], scores[ahead].copy()
        if not len(rows):
            return
        every, at = np.arange(len(rows)), np.empty((len(rows), size), np.int64)
        best = np.empty((len(rows), size), np.int64)
        for k in range(size):  # argmax names the first of equals
            at[:, k] = scores.argmax(1)
            best[:, k] = scores[every, at[:, k]]
            scores[every, at[:, k]] = _LEAST
        both = np.concatenate([self.score[rows], best], 1)
        named = np.concatenate([self.column[rows], np.where(best == _LEAST, -1, columns[at])], 1)
        # stable: of equals those held come first, which have the smaller columns
        order = np.argsort(~both, axis=1, kind="stable")[:, :size]  # ~x is -x-1: descending, and -2^63 has one
        self.score[rows] = np.take_along_axis(both, order, 1)
        self.column[rows] = np.take_along_axis(named, order, 1)


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    """Whole-number vectors as rows; shorter ones are padded with zeros."""
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _by_id(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows by id (null last), so that a smaller column is a smaller id."""
    return pdf.sort_values(["id", "key"], kind="stable", na_position="last").reset_index(drop=True)


def _tiles(a: np.ndarray, c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor rows, candidate rows, their scores), candidates ascending for each anchor."""
    for i in range(0, len(a), TILE):
        for j in range(0, len(c), TILE):
            yield (np.arange(i, min(i + TILE, len(a))), np.arange(j, min(j + TILE, len(c))),
                   strassen(a[i:i + TILE], c[j:j + TILE].T))


_ID = "Int64"
_POSITIVE = "anchor long, positive_key long, positive_id long, score long"
_NEGATIVE = "anchor long, slot int, negative_key long, negative_id long, score long"


def _positives(dim: int, size: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows, out = _by_id(rows), []
        for label, own in anchors.groupby("label"):
            same = rows[rows["label"] == label]
            a, c = _matrix(own["q"], dim), _matrix(same["q"], dim)
            a_key, c_key = own["key"].to_numpy(np.int64), same["key"].to_numpy(np.int64)
            heaps = Heaps(len(a), size)
            for i, j, score in _tiles(a, c):
                score[a_key[i][:, None] == c_key[j]] = _LEAST  # the anchor itself
                heaps.merge(i, score, j)
            row, slot = np.nonzero(heaps.column >= 0)
            at = heaps.column[row, slot]
            out.append(pd.DataFrame({"anchor": a_key[row], "positive_key": c_key[at],
                                     "positive_id": same["id"].astype(_ID).to_numpy()[at],
                                     "score": heaps.score[row, slot]}))
        return pd.concat(out, ignore_index=True) if out else _none("anchor", "positive_key", "positive_id", "score")

    return run


def _negatives(dim: int, size: int, window: tuple[int, int]):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = ["anchor", "slot", "negative_key", "negative_id", "score"]
        if not len(anchors) or not len(rows):
            return _none(*names)
        rows = _by_id(rows)
        a, c = _matrix(anchors["q"], dim), _matrix(rows["q"], dim)
        a_label, c_label = anchors["label"].to_numpy(), rows["label"].to_numpy()
        most = max(map(len, anchors["positives"]))
        low = np.full((most, len(a)), np.iinfo(np.int64).max)  # an empty window where there is no positive
        high = np.full((most, len(a)), _LEAST)
        for i, scores in enumerate(anchors["positives"]):
            for k, s in enumerate(scores):
                low[k, i], high[k, i] = -(-window[0] * int(s) // 100), window[1] * int(s) // 100
        heaps = [Heaps(len(a), size) for _ in range(most)]
        for i, j, score in _tiles(a, c):
            score[a_label[i][:, None] == c_label[j]] = _LEAST
            for k in range(most):
                inside = (score >= low[k, i][:, None]) & (score <= high[k, i][:, None])
                some = inside.any(1)
                heaps[k].merge(i[some], np.where(inside[some], score[some], _LEAST), j)
        a_key, c_key = anchors["key"].to_numpy(np.int64), rows["key"].to_numpy(np.int64)
        c_id, out = rows["id"].astype(_ID).to_numpy(), []
        for k, h in enumerate(heaps):
            row, place = np.nonzero(h.column >= 0)
            at = h.column[row, place]
            out.append(pd.DataFrame({"anchor": a_key[row], "slot": k, "negative_key": c_key[at],
                                     "negative_id": c_id[at], "score": h.score[row, place]}))
        return pd.concat(out, ignore_index=True)

    return run


def _none(*names: str) -> pd.DataFrame:
    return pd.DataFrame({n: np.empty(0, np.int64) for n in names})


def _best(rows: DataFrame, by: list[str], key: str, name: str, size: int) -> DataFrame:
    """Heaps merged: the best ``size`` rows of each group, with their ``place`` from 1.  Each
    task cuts its rows to the best of their group before they are shuffled."""
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col(name).asc_nulls_last(), key)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= size)


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(id, label, q)`` of the rows that take part: a label, and a vector without null or
    non-finite components.  Every seventh id has the next label (``RELABEL_EVERY``)."""
    e = F.col("embedding").cast("array<double>")
    fits = F.col("label").isNotNull() & F.coalesce(
        F.forall(e, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % RELABEL_MODULUS).otherwise(label)
    return vectors.where(fits).select(F.col("vec_id").cast("long").alias("id"), moved.alias("label"),
                                      F.transform(e, lambda x: F.floor(scale * x)).alias("q"))


def hard_negatives(vectors: DataFrame, anchor_every: int = ANCHOR_EVERY, n_positives: int = POSITIVES,
                   n_negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW_PERCENT,
                   scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for
    ``vectors(vec_id, embedding, label)``.

    Rows with a null label or vector, or a null or non-finite component, take no part.  Empty
    vectors score 0 with all; a shorter vector counts as padded with zeros.  Rows that share an
    id are rows of their own: each such anchor gives its own rows, and its twins can be its
    positives.  A row without an id is never an anchor and comes after all ids at equal scores.
    Scores must fit 64 bits: a table whose longest vector squared does not fails the job.  No
    anchor, or an empty table, gives an empty result; other columns are ignored."""
    low, high = window
    rows = materialize(whole_numbers(vectors, scale).withColumn("key", F.monotonically_increasing_id()), "negatives-rows")
    length, dim = rows.agg(F.max(F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))),
                           F.max(F.size("q"))).first()
    if length is not None and length * max(high, 100) >= 2.0 ** 62:
        raise ValueError("scores of these vectors do not fit 64 bits; use a smaller scale")
    dim = max(1, dim or 0)
    size = max(1, min(block_rows, BLOCK_BYTES // (8 * dim)))
    # keys are unique, so blocks are even whatever the ids and labels
    sides, blocks = (max(1, -(-n // size)) for n in rows.agg(
        F.count(F.when(F.col("id") % anchor_every == 0, 1)), F.count(F.lit(1))).first())
    anchors = rows.where(F.col("id") % anchor_every == 0)

    def grid(asked: DataFrame, run, schema: str) -> DataFrame:
        """``run`` on every cell: a block of anchors and a block of rows."""
        left = asked.select(*[F.col(c).alias(c) for c in asked.columns]).withColumn("side", F.pmod(F.xxhash64("key"), F.lit(sides))).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        right = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks))).withColumn(
            "side", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sides - 1).cast("long"))))
        return left.groupBy("side", "block").cogroup(right.groupBy("side", "block")).applyInPandas(run, schema)

    positives = materialize(_best(grid(anchors, _positives(dim, n_positives), _POSITIVE),
                                  ["anchor"], "positive_key", "positive_id", n_positives), "negatives-positives")
    heaps = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))),
                                                        lambda x: x["score"]).alias("positives"))
    asked = anchors.join(heaps, F.col("key") == F.col("anchor")).drop("anchor")
    found = _best(grid(asked, _negatives(dim, n_negatives, (low, high)), _NEGATIVE),
                  ["anchor", "slot"], "negative_key", "negative_id", n_negatives)
    ids = anchors.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    chosen = positives.select("anchor", (F.col("place") - 1).alias("slot"), "positive_id",
                              F.col("score").alias("positive_score")).join(ids, "anchor")
    return found.join(chosen, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score",
        F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP12_SQL = f"""
WITH fit AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {RELABEL_MODULUS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.k AS anchor, a.vec_id AS anchor_id, b.k AS other, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM fit a JOIN fit b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.k <> b.k),
positive AS (
  SELECT anchor, anchor_id, other AS positive, other_id AS positive_id, score AS positive_score
  FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST, other) <= {POSITIVES})
SELECT positive.anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, other_id NULLS LAST, other)::INTEGER AS "rank",
       other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pairs USING (anchor)
WHERE NOT same AND {WINDOW_PERCENT[0]} * positive_score <= 100 * score AND 100 * score <= {WINDOW_PERCENT[1]} * positive_score
QUALIFY "rank" <= {NEGATIVES}
"""
