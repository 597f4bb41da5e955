"""Byte-level BPE encoding and decoding by recursive queries.

Each partition keeps a DuckDB connection in its own process.  The distinct pieces of a
batch become token-position rows (one per byte).  A recursive query joins neighbouring
rows to the merge table, finds each word's smallest rank, contracts it from the left and
repeats until no word changes; an ordered aggregation puts the bytes of the final tokens
together again, which is the decoding.

All occurrences of a word's smallest pair are contracted in one step where that equals
doing them one by one from the left: a merged token must not form a pair of a smaller
rank with any neighbour.  Tokens that can are known from the ranks, and of those only
the leftmost pair goes in a step.  In a run like ``aaaa`` every second pair overlaps and
waits.  A run of a hundred thousand equal signs thus takes a few steps.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm.common import table, text_of, worker_cache
from civic_mart.llm.pieces import PieceCoder, batches_of

SHIFT = 24  # a row's key: word number, then byte position (a word has under 2^24 bytes)
WORDS_A_QUERY = 20_000

_CONTRACT = f"""
WITH RECURSIVE step AS (
  SELECT 0 AS it, k, tok, len FROM start_rows
  UNION ALL (
    WITH pairs AS (
      SELECT l.k, l.len AS left_len, m.tok, m.len, m.alone, m.twin
      FROM step l JOIN step r ON r.k = l.k + l.len JOIN merges m ON m.pair = l.tok * 65536 + r.tok),
    best AS (
      SELECT k >> {SHIFT} AS w, min((tok << {SHIFT}) | (k & {(1 << SHIFT) - 1})) AS low FROM pairs GROUP BY 1),
    ready AS (
      SELECT p.k, p.left_len, p.tok, p.len, p.twin
      FROM pairs p JOIN best b ON b.w = p.k >> {SHIFT} AND p.tok = b.low >> {SHIFT}
      WHERE NOT p.alone OR p.k & {(1 << SHIFT) - 1} = b.low & {(1 << SHIFT) - 1}),
    chosen AS (
      SELECT k, left_len, tok, len FROM ready WHERE NOT twin
      UNION ALL
      SELECT k, left_len, tok, len FROM (
        SELECT *, row_number() OVER (PARTITION BY k >> {SHIFT}, island ORDER BY k) AS n FROM (
          SELECT *, k - left_len * row_number() OVER (PARTITION BY k >> {SHIFT} ORDER BY k) AS island
          FROM ready WHERE twin))
      WHERE n % 2 = 1)
    SELECT s.it + 1, s.k, coalesce(c.tok, s.tok), coalesce(c.len, s.len)
    FROM step s JOIN best b ON b.w = s.k >> {SHIFT}
    LEFT JOIN chosen c ON c.k = s.k
    LEFT JOIN chosen d ON d.k + d.left_len = s.k
    WHERE d.k IS NULL))
SELECT step.k, step.tok
FROM step JOIN (SELECT k >> {SHIFT} AS w, max(it) AS last FROM step GROUP BY 1) f
  ON f.w = step.k >> {SHIFT} AND step.it = f.last
"""
_DECODE = f"""
SELECT e.k >> {SHIFT} AS w, string_agg(v.hex, '' ORDER BY e.k) AS hex
FROM encoded e JOIN vocab v ON v.tok = e.tok GROUP BY 1 ORDER BY 1
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class SqlBpe:
    """Encodes lists of pieces with DuckDB; ``ranks`` maps token bytes to ids."""

    def __init__(self, ranks: dict[bytes, int], memory_mb: int = 250) -> None:
        self.ranks = ranks
        self.byte_tok = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        merges = [(ranks[t[:i]] * 65536 + ranks[t[i:]], r, len(t), t[:i] == t[i:])
                  for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        merges = pd.DataFrame(merges, columns=["pair", "tok", "len", "twin"])
        # a token is contracted alone if it is half of a pair with a smaller rank than its own
        left, right = merges["pair"] // 65536, merges["pair"] % 65536
        alone = set(left[merges["tok"] < left]) | set(right[merges["tok"] < right])
        merges["alone"] = merges["tok"].isin(alone)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": f"{memory_mb}MB"})
        self._load("merges", merges)
        self._load("vocab", pd.DataFrame({"tok": list(ranks.values()), "hex": [t.hex() for t in ranks]}))

    def _load(self, name: str, frame: pd.DataFrame) -> None:
        self.con.register("incoming", frame)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def __call__(self, pieces: list[str]):
        ids, id_sizes, raw, raw_sizes = [], [], [], []
        for i in range(0, len(pieces), WORDS_A_QUERY):
            a, b, c, d = self._query([p.encode("utf-8") for p in pieces[i:i + WORDS_A_QUERY]])
            ids.append(a), id_sizes.append(b), raw.append(c), raw_sizes.append(d)
        return ((np.concatenate(ids), np.concatenate(id_sizes)), (np.concatenate(raw), np.concatenate(raw_sizes)))

    def _query(self, words: list[bytes]):
        n = len(words)
        if any(len(w) >> SHIFT for w in words):
            raise ValueError("a single piece has 16 MB or more")
        sizes = np.array([len(w) for w in words], np.int64)
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)  # a token itself stays whole
        flat = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(n), sizes)
        pos = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        split = whole[word] < 0
        k = np.concatenate([(word[split] << SHIFT) | pos[split], np.flatnonzero(whole >= 0) << SHIFT])
        tok = np.concatenate([self.byte_tok[flat[split]], whole[whole >= 0]])
        length = np.concatenate([np.ones(int(split.sum()), np.int64), sizes[whole >= 0]])
        self._load("start_rows", pd.DataFrame({"k": k, "tok": tok, "len": length}))
        self.con.execute(f"CREATE OR REPLACE TABLE encoded AS {_CONTRACT}")
        got = self.con.execute("SELECT k, tok FROM encoded ORDER BY k").fetchnumpy()
        decoded = self.con.execute(_DECODE).fetchnumpy()
        back = [bytes.fromhex(h) for h in decoded["hex"]]
        if len(back) != n:
            raise ValueError("a word came back without tokens")
        return (np.asarray(got["tok"]).astype(np.uint32),
                np.bincount((np.asarray(got["k"]) >> SHIFT).astype(np.int64), minlength=n),
                np.frombuffer(b"".join(back), np.uint8), np.array([len(x) for x in back], np.int64))


def coder(path: str) -> PieceCoder:
    """The worker's coder for a ranks file."""
    cache = worker_cache("sql_bpe")
    if path not in cache:
        cache[path] = PieceCoder(SqlBpe(read_ranks(path)))
    return cache[path]


def bpe_round_trip(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for each row of ``docs(doc_id, text)``.

    The ranks file is read by the tasks (it is part of an installed package on every
    machine).  Null texts are empty: no tokens and the digests of nothing.  Repeated rows
    and null ids give rows of their own; an empty table an empty result; other columns
    are ignored.  Encoding stops with an error if decoding does not give the text back."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = coder(ranks_path)
        for pdf in batches:
            texts = [text_of(t) for t in pdf["text"]]
            out = []
            for a, b in batches_of(texts):
                ids, at, raw, byte_at = own.encode(texts[a:b])
                ids = ids.astype("<u4")
                if raw.tobytes() != "".join(texts[a:b]).encode("utf-8"):
                    raise ValueError("decoded bytes differ from the text")
                out += [(int(at[i + 1] - at[i]), hashlib.sha256(ids[at[i]:at[i + 1]]).hexdigest(),
                         hashlib.sha256(raw[byte_at[i]:byte_at[i + 1]]).hexdigest()) for i in range(b - a)]
            res = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            res.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield res

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
