"""Importance resampling towards a target distribution, over hashed word runs.

Every run of 1 to ``max_n`` consecutive words is a feature; its bucket is its CRC-32.  A
bucket's gain says how much likelier it is in the target texts than in the documents; a
document's weight is the sum of its features' gains, and the documents drawn are those of
the highest weight plus Gumbel noise (a draw without replacement by weight).

The texts of a batch are joined with a sentinel that no word holds, one regular expression
finds the words of all of them, their documents come from the joined texts' offsets, and
runs whose first and last word lie in different documents are masked before the counts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm.common import materialize, table, text_of
from civic_mart.llm.pieces import batches_of
from civic_mart.sources.paging import positions

MAX_N = 1
BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 10
SEED = 2024
CHUNK = 100_000  # words that are looked at together
SENTINEL = b"\x00"  # not a word character
# lower-cased UTF-8: digits, a-z and every byte of a code point above 127
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class _Buckets(dict):
    """Bucket of each word met (begins anew when it grows large)."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = at = zlib.crc32(word) % self.buckets
        return at


def joined(texts: list[str]) -> tuple[bytes, np.ndarray]:
    """(texts as lower-cased UTF-8 with a sentinel between them, offset of each)."""
    raw = [t.encode("utf-8").lower() for t in texts]  # bytes.lower changes A-Z only
    return SENTINEL.join(raw), np.cumsum([0, *(len(r) + 1 for r in raw[:-1])])


def features(texts: list[str], max_n: int, known: _Buckets) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(run length, document of each run, bucket of each run), some words at a time."""
    blob, offsets = joined(texts)
    found = WORD.finditer(blob)
    words: list[bytes] = []
    docs = np.empty(0, np.int64)
    while block := list(islice(found, CHUNK)):
        old = min(len(words), max_n - 1)  # runs may begin in the block before
        words = words[len(words) - old:] + [m.group() for m in block]
        docs = np.concatenate([docs[len(docs) - old:], np.searchsorted(
            offsets, np.fromiter((m.start() for m in block), np.int64, len(block)), side="right") - 1])
        yield 1, docs[old:], np.fromiter((known[w] for w in words[old:]), np.int64, len(block))
        for n in range(2, max_n + 1):
            last = np.arange(max(old, n - 1), len(words))
            last = last[docs[last] == docs[last - n + 1]]  # no run crosses documents
            yield n, docs[last], np.fromiter(
                (zlib.crc32(b" ".join(words[i - n + 1:i + 1])) % known.buckets for i in last), np.int64, len(last))


def bucket_counts(texts: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` over all of ``texts(text)``: a task sends one row for each bucket it met."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for pdf in batches:
            batch = [text_of(t) for t in pdf["text"]]
            for a, b in batches_of(batch):
                for _, _, bucket in features(batch[a:b], max_n, known):
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    return texts.select("text").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket.  The driver gets ``buckets`` numbers, whatever the input."""
    spark = docs.sparkSession
    s = materialize(bucket_counts(docs, max_n, buckets), "importance-raw").select("bucket", F.col("n").alias("s"))
    t = materialize(bucket_counts(target, max_n, buckets), "importance-target").select("bucket", F.col("n").alias("t"))
    whole_s, whole_t = (x.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for x, c in ((s, "s"), (t, "t")))
    every = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    ratio = ((F.coalesce("t", F.lit(0)) + F.lit(1.0)) * F.lit(float(whole_s + buckets))
             / ((F.coalesce("s", F.lit(0)) + F.lit(1.0)) * F.lit(float(whole_t + buckets))))
    out = np.zeros(buckets, np.int64)
    for bucket, gain in every.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect():
        out[bucket] = gain
    return out


def weigh(text: Column, gain: np.ndarray, max_n: int = MAX_N) -> Column:
    """Struct (n_words, n_features, weight) of a text column."""
    buckets = len(gain)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Buckets(buckets)
        for column in series:
            texts = [text_of(t) for t in column]
            out = np.zeros((3, len(texts)), np.int64)
            for a, b in batches_of(texts):
                for n, doc, bucket in features(texts[a:b], max_n, known):
                    runs = np.bincount(doc, minlength=b - a)
                    out[0, a:b] += runs if n == 1 else 0
                    out[1, a:b] += runs
                    # sums of whole numbers, exact in doubles up to 2^53
                    out[2, a:b] += np.bincount(doc, gain[bucket], b - a).astype(np.int64)
            yield pd.DataFrame({"n_words": out[0], "n_features": out[1], "weight": out[2]})

    return run(text)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the id alone: the same on every run and machine."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = DRAW_PERCENT, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank, n_words)`` for each row of ``docs(doc_id, text)``.

    ``percent`` of the rows with at least ``min_words`` words are drawn: those of the highest
    score, ties to the smaller id (a null id before all).  Ranks come from a range-partitioned
    order with per-partition counts, so no task sees all rows.  Null and empty texts have no
    features: weight 0, never drawn if ``min_words`` is positive.  Repeated rows are rows of
    their own with equal scores and ranks that follow each other.  An empty target gives
    gains from the documents alone, an empty table an empty result; other columns are ignored."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = gains(plain, target, max_n, buckets)
    scored = materialize(plain.select("doc_id", weigh(F.col("text"), gain, max_n).alias("w")).select(
        "doc_id", "w.*", (F.col("w.weight") + noise(F.col("doc_id"), seed)).alias("score")), "importance-scores")
    able = scored.where(F.col("n_words") >= min_words)
    n_drawn = percent * able.count() // 100
    placed = positions(able.withColumn("_least", -F.col("score")), [], ["_least", "doc_id"])
    names = ["doc_id", "n_features", "weight", "score"]
    drawn = placed.select(*names, F.when(F.col("_pos") < n_drawn, F.col("_pos") + 1).alias("rank"), "n_words")
    return drawn.unionByName(scored.where(F.col("n_words") < min_words).select(
        *names, F.lit(None).cast("long").alias("rank"), "n_words"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = "3988292384"  # the polynomial of CRC-32, reversed
_BIT = f"CASE WHEN v & 1 = 1 THEN xor(v >> 1, {_CRC}) ELSE v >> 1 END"
OP13_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT b::BIGINT AS b, b::BIGINT AS v, 0 AS k FROM range(256) t(b)
  UNION ALL SELECT b, {_BIT}, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS c FROM bits WHERE k = 8),
docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWERED}, '{_FEATURE}') AS w FROM documents),
doc_words AS (SELECT rid, unnest(w) AS word FROM docs),
target_words AS (SELECT unnest(regexp_extract_all({_LOWERED}, '{_FEATURE}')) AS word FROM benchmark),
spelled AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM doc_words UNION SELECT word FROM target_words) u),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(list_transform(range(0, strlen(x) // 2),
           lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)),
           lambda a, b: xor(a >> 8, c[(xor(a, b) & 255) + 1]), 4294967295::BIGINT)) % {BUCKETS} AS bucket
  FROM spelled, crc),
raw AS (SELECT bucket, count(*) AS s FROM doc_words JOIN hashed USING (word) GROUP BY bucket),
aim AS (SELECT bucket, count(*) AS t FROM target_words JOIN hashed USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM raw) + {BUCKETS})::DOUBLE
         / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM aim) + {BUCKETS})::DOUBLE))) AS g
  FROM raw FULL JOIN aim USING (bucket)),
weights AS (SELECT rid, sum(g)::BIGINT AS weight FROM doc_words JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT)
         + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (rid)),
placed AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {DRAW_PERCENT} * n // 100 THEN place END AS "rank", n_features AS n_words
FROM scored LEFT JOIN placed USING (rid)
"""
