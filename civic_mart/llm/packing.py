"""Best-fit packing of documents into sequences by large-item matching.

Lengths are at most the capacity, so the whole problem is its histogram.  The histogram
(at most 1,024 rows) is packed on the driver in classes of equal bins: lengths above a
third of the capacity pair at most twice a bin, the longest with the longest that fits;
shorter ones go, longest first, to the bin with the smallest gap that takes them.  Every
step fills a whole range of equal bins, so the plan's size depends on the capacity alone.
Pieces then find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civic_mart.llm.common import materialize, table, text_of, worker_cache
from civic_mart.llm.pieces import PieceCoder, batches_of

CAPACITY = 1024
END_ID = 2


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Pack ``counts[length]`` pieces of each length.

    Returns runs (length, first rank, pieces, first bin, offset) and the number of bins: the
    pieces of a run go to consecutive bins, all at the run's offset."""
    left = [int(c) for c in counts]
    rank = [0] * len(left)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first bin, bins)
    bins = 0

    def put(length: int, first: int, n: int, gap: int) -> None:
        """One piece of ``length`` into each bin of [first, first + n), all with that gap."""
        runs.append((length, rank[length], n, first, capacity - gap))
        rank[length] += n
        left[length] -= n

    def keep(first: int, n: int, gap: int) -> None:
        if n and gap:
            gaps.setdefault(gap, []).append((first, n))

    third = capacity // 3  # lengths above it are large: at most two in a bin
    for a in range(min(capacity, len(left) - 1), third, -1):
        while left[a]:
            b = next((x for x in range(min(a, capacity - a), third, -1) if left[x] > (x == a)), 0)
            n = left[a] if not b else left[a] // 2 if b == a else min(left[a], left[b])
            put(a, bins, n, capacity)
            if b:
                put(b, bins, n, capacity - a)
            keep(bins, n, capacity - a - b)
            bins += n
    for s in range(min(third, len(left) - 1), 0, -1):
        while left[s]:
            gap = min((g for g in gaps if g >= s), default=0)
            if gap:
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
            else:
                gap, first, n = capacity, bins, -(-left[s] // (capacity // s))
                bins += n
            each = gap // s
            full = min(n, left[s] // each)
            for j in range(each if full else 0):
                put(s, first, full, gap - j * s)
            keep(first, full, gap - each * s)
            first, n = first + full, n - full
            if n and left[s]:  # fewer than fill a bin: the last of this length
                rest = left[s]
                for j in range(rest):
                    put(s, first, 1, gap - j * s)
                keep(first, 1, gap - rest * s)
                first, n = first + 1, n - 1
            keep(first, n, gap)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), bins


def _tokenizer(path: str) -> tuple[PieceCoder, dict[str, int]]:
    cache = worker_cache("tokenizers")
    if path not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def encode_pieces(pieces: list[str]):
            out = tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
            ids = [e.ids for e in out]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((x for i in ids for x in i), np.uint32, int(sizes.sum()))
            return (flat, sizes), (np.empty(0, np.uint8), np.zeros(len(ids), np.int64))

        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        cache[path] = PieceCoder(encode_pieces), special
    return cache[path]


def encode(texts: list[str], own: PieceCoder, special: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, id offsets of the texts).  As in the library's plain call, a special token's string in
    a text is that token, and what stands between such strings is encoded by itself."""
    marked = [i for i, t in enumerate(texts) if any(s in t for s in special)]
    if not marked:
        return own.encode(texts)[:2]
    cut = re.compile("(" + "|".join(map(re.escape, special)) + ")")
    parts, of, token = [], [], []
    for i, t in enumerate(texts):
        for part in cut.split(t):
            parts.append("" if part in special else part)
            of.append(i)
            token.append(special.get(part, -1))
    ids, at = own.encode(parts)[:2]
    whole = [ids[at[k]:at[k + 1]] if x < 0 else np.array([x], np.uint32) for k, x in enumerate(token)]
    sizes = np.bincount(of, [len(w) for w in whole], len(texts)).astype(np.int64)
    return np.concatenate(whole), np.concatenate([[0], np.cumsum(sizes)])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces ``(doc_id, piece, start, length, ids_crc32)`` of at most ``capacity`` tokens, with
    ``part`` (the task) and ``nth`` (of the pieces of that length in the task)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (own, special), part = _tokenizer(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for pdf in batches:
            texts, doc_ids = [text_of(t) for t in pdf["text"]], pdf["doc_id"].astype("Int64")
            for a, b in batches_of(texts):
                ids, at = encode(texts[a:b], own, special)
                cut, crc = [], []
                for i in range(b - a):
                    raw = np.append(ids[at[i]:at[i + 1]], np.uint32(end_id)).astype("<u4")
                    n = len(raw)
                    first = n % capacity or capacity  # a longer document's first piece takes the rest
                    bounds = [0, *range(first, n + 1, capacity)]
                    for p, (x, y) in enumerate(zip(bounds, bounds[1:])):
                        cut.append((a + i, p, x, y - x))
                        crc.append(zlib.crc32(raw[x:y]))
                out = pd.DataFrame(cut, columns=["row", "piece", "start", "length"])
                nth = out.groupby("length").cumcount().to_numpy() + seen[out["length"]]
                seen += np.bincount(out["length"], minlength=capacity + 1)
                yield pd.DataFrame({"doc_id": doc_ids.take(out["row"]).array, "piece": out["piece"].to_numpy(),
                                    "start": out["start"].to_numpy(), "length": out["length"].to_numpy(),
                                    "ids_crc32": np.array(crc, np.int64), "part": part, "nth": nth})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(rows, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are one piece with the end id alone.  Repeated rows and null ids
    are packed as documents of their own.  Pieces of equal length are interchangeable; ties
    go by the order of the input's partitions and rows.  An empty table gives an empty
    result; other columns are ignored."""
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity, end_id), "pack-pieces")
    # rank of a piece among all of its length: pieces in earlier parts, then its own place
    by_part = pieces.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = materialize(by_part.select("length", "part", "count", F.coalesce(
        F.sum("count").over(before), F.lit(0)).alias("before")), "pack-ranks")
    counts = np.zeros(capacity + 1, np.int64)
    for r in base.groupBy("length").agg(F.sum("count").alias("n")).collect():  # one row per length
        counts[r["length"]] = r["n"]
    runs, _ = plan_bins(counts, capacity)
    first = (runs[:, 0] << 48) | runs[:, 1]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank = (pdf["before"] + pdf["nth"]).to_numpy(np.int64)
            run = np.searchsorted(first, (pdf["length"].to_numpy(np.int64) << 48) | rank, side="right") - 1
            out = pdf[["doc_id", "piece", "start", "length", "ids_crc32"]].astype({"doc_id": "Int64"})
            yield out.assign(sequence_id=runs[run, 3] + rank - runs[run, 1], offset=runs[run, 4])

    ranked = pieces.join(base.select("length", "part", "before"), ["length", "part"])
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "before").mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
