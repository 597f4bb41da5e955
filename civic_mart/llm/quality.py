"""Quality rules from cross-document line frequency.

Per document: counts of words, symbols, repeated lines and repeated word windows decide
``base_failed``.  Across documents: every line is normalised (A-Z lower-cased, white
space folded) and hashed; for each host the distinct documents that hold a line are
counted; lines above the host's limit are boilerplate and count as removed; a document
that keeps too small a share of its words is depleted and rejected.

Copies of one document are one document for that count, else a page mirrored a thousand
times would make its own text boilerplate.  A document is known by a hash of its whole set
of line hashes, so documents that share some lines, or most, still count one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm.common import materialize, table, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_LIMIT = 50        # a line in at most so many documents of a host is never boilerplate
LIMIT_SHARE = 0.05    # nor one in at most this share of the host's distinct documents
KEEP_SHARE = 0.3      # a document left with less of its words is depleted

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words that occur at least twice."""
    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    gram = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    span = 1
    while span < window:  # ranks of 2-, 4-, 8-grams: exact, no hash
        step = min(span, window - span)
        gram = np.unique(gram[:-step] * (int(gram.max()) + 1) + gram[step:], return_inverse=True)[1]
        span += step
    twice = np.bincount(gram)[gram] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def line_hash(line: bytes) -> int:
    """60-bit hash of a normalised line (the first 15 hex digits of its MD5)."""
    return int(hashlib.md5(b" ".join(line.lower().split())).hexdigest()[:15], 16)


def _document(text: str) -> tuple:
    words = words_of(text)
    lines = text.encode("utf-8").split(b"\n")
    seen: set[bytes] = set()
    repeated, sizes = 0, {}
    for line in lines:
        own = line.split()
        if not own:
            continue
        repeated += line in seen
        seen.add(line)
        h = line_hash(line)
        sizes[h] = sizes.get(h, 0) + len(own)
    chars = sum(map(len, text.split())) if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") \
        else sum(len(w.decode("utf-8")) for w in words)
    return (len(words), chars, sum(text.count(c) for c in SYMBOLS), repeated, repeat_words(words),
            list(sizes), list(sizes.values()))


def document_stats(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: counts, and its distinct line hashes with their words."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line", "line_words"]
        for pdf in batches:
            out = pd.DataFrame([_document(text_of(t)) for t in pdf["text"]], columns=names, index=pdf.index)
            yield pd.concat([pdf[["doc_id", "host", "text_key"]].astype({"doc_id": "Int64"}), out], axis=1)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
        F.xxhash64("text").alias("text_key"), "text").mapInPandas(
        rows, f"doc_id long, host string, text_key long, {_STATS}, line array<long>, line_words array<long>")


def quality_rules(docs: DataFrame, host: str = "source", min_limit: int = MIN_LIMIT,
                  limit_share: float = LIMIT_SHARE, keep_share: float = KEEP_SHARE) -> DataFrame:
    """One row for each row of ``docs(doc_id, text, <host>)``: ``doc_id``, the counts,
    ``base_failed``, ``kept``, ``removed_words`` (words on boilerplate lines), and the row's
    ``host``, ``text_key`` (a hash of its text) and ``boilerplate`` (hashes of its lines to remove).

    Null texts have no words (base_failed).  Documents without a host form one host.
    Repeated rows are documents of their own in the result and, being copies, count
    once for a line.  An empty table gives an empty result; other columns are ignored."""
    stats = materialize(
        document_stats(docs, host).withColumn("rid", F.monotonically_increasing_id())
        .withColumn("host", F.coalesce("host", F.lit(""))), "quality-stats")  # rid is fixed once stored
    lines = stats.select("rid", "host", F.xxhash64(F.sort_array("line")).alias("known_by"),
                         F.explode(F.arrays_zip("line", "line_words")).alias("l")).select(
        "rid", "host", F.col("l.line").alias("line"), F.col("l.line_words").alias("line_words"), "known_by")
    # distinct (line, document) first, so that a hot line is counted from partial sums
    common = lines.groupBy("host", "line", "known_by").agg(F.lit(1)).groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > min_limit)
    hosts = stats.groupBy("host", F.xxhash64(F.sort_array("line")).alias("known_by")).agg(F.lit(1)).groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"))
    boilerplate = materialize(common.join(hosts, "host").where(
        F.col("n_docs") > F.lit(limit_share) * F.col("host_docs")).select("host", "line"), "quality-lines")
    removed = lines.select("rid", "host", "line", "line_words").join(boilerplate, ["host", "line"]).groupBy("rid").agg(
        F.sum("line_words").alias("removed_words"), F.collect_list("line").alias("boilerplate"))
    out = stats.drop("line", "line_words").join(removed, "rid", "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0))).withColumn(
        "boilerplate", F.coalesce("boilerplate", F.array().cast("array<long>")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (left >= F.lit(keep_share) * F.col("n_words"))).alias("kept"), "removed_words",
        "host", "text_key", "boilerplate")


def without_lines(text: Column, boilerplate: Column) -> Column:
    """The text without the lines whose hashes (``line_hash``) are given; unchanged where there are none."""
    def hashed(line: Column) -> Column:
        low = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        words = F.trim(F.regexp_replace(low, r"[\x20\x09-\x0D]+", " "))
        return F.conv(F.substring(F.md5(words), 1, 15), 16, 10).cast("long")

    kept = F.array_join(F.filter(F.split(text, "\n"), lambda line: ~F.array_contains(boilerplate, hashed(line))), "\n")
    return F.when(F.size(boilerplate) > 0, kept).otherwise(text)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("host", "text_key", "boilerplate")


_WORD = r"[^\x20\x09-\x0D]+"
OP7_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT rid, regexp_extract_all(text, '{_WORD}') AS w FROM docs),
windows AS (SELECT rid, i, list_slice(w, i, i + {WINDOW - 1}) AS win
            FROM words, LATERAL (SELECT unnest(range(1, len(w) - {WINDOW - 2})) AS i) t),
repeated AS (SELECT rid, unnest(list(i)) AS i FROM windows GROUP BY rid, win HAVING count(*) > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM repeated) c GROUP BY rid),
raw_lines AS (SELECT rid, host, unnest(string_split(text, chr(10))) AS line FROM docs),
held AS (
  SELECT rid, host, line, len(w) AS n, substr(md5(translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz')), 1, 15) AS h
  FROM (SELECT *, regexp_extract_all(line, '{_WORD}') AS w FROM raw_lines) x WHERE len(w) > 0),
dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM held GROUP BY rid),
hashed AS (SELECT rid, host, h, sum(n) AS n FROM held GROUP BY ALL),
sets AS (SELECT rid, string_agg(h, ',' ORDER BY h) AS known_by FROM hashed GROUP BY rid),
hosts AS (SELECT host, count(DISTINCT coalesce(known_by, '')) AS n FROM docs LEFT JOIN sets USING (rid) GROUP BY host),
common AS (
  SELECT host, h FROM hashed JOIN sets USING (rid) JOIN hosts USING (host) GROUP BY host, h, hosts.n
  HAVING count(DISTINCT known_by) > {MIN_LIMIT} AND count(DISTINCT known_by) > CAST({LIMIT_SHARE} AS DOUBLE) * hosts.n),
removed AS (SELECT rid, sum(n) AS n FROM hashed SEMI JOIN common USING (host, h) GROUP BY rid),
counts AS (
  SELECT docs.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, CAST(coalesce(removed.n, 0) AS BIGINT) AS removed_words
  FROM docs JOIN words USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN removed USING (rid)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - removed_words >= CAST({KEEP_SHARE} AS DOUBLE) * n_words AS kept, removed_words
FROM judged
"""
