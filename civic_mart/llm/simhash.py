"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at most ``r`` bits apart have a word between them that is at most
``ceil(r / 2)`` bits from one and ``floor(r / 2)`` from the other.  Every fingerprint
emits all variants within half the radius, variants are brought together, and what
collides is deduplicated and verified by its true bit distance.

For the odd radius 3 the two halves are 2 and 1.  Parity decides who takes which: a
variant of even parity lies 0 or 2 flips from an even fingerprint and 1 flip from an odd
one, so even fingerprints emit themselves and their 2-flips, odd ones their 1-flips, and
every pair at distance 1, 2 or 3 meets on a variant.  (Smaller radii use the same
variants; the verification then asks for the smaller distance.)

A variant that an odd fingerprint or an even fingerprint itself reaches is a hub: the
triangle inequality puts everything else on it within 3 bits of the hub's fingerprint,
so a star to the smallest hub fingerprint replaces all pairs of the group.

A thousand variants a row would be shuffled at N x 1000 rows.  Variants that share their
top ``k`` bits can instead be made where they meet: a fingerprint travels once to every
prefix that holds one of its variants (1 + k + k(k-1)/2 rows at most) and the task of a
prefix makes only that prefix's variants.  ``k`` grows with log2(N), so a prefix stays
at some thousands of fingerprints.  A prefix with more of them (a large group of near
copies) is split further by a parity code over all 64 bits, which deals even the
variants of one centre evenly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm.common import components, materialize, table, text_of

SHINGLE = 3
MAX_BITS = 3
GROUP_ROWS = 1_000  # aimed-at fingerprints under one prefix
HOT_ROWS = 16_000   # own fingerprints beyond which a prefix is split


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text (unsigned); no words: 0."""
    words = text.encode("utf-8").lower().split()  # bytes.lower changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))  # end of word i is ends[i] - 1
    h64 = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [h64(joined, 42)]
    else:
        starts = [0, *ends]
        hashes = [h64(joined[a:b - 1], 42) for a, b in zip(starts, ends[shingle - 1:])]
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        block = np.array(hashes[i:i + 65_536], np.uint64).astype("<u8")
        bits += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(((2 * bits > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id long, text_key long, fp long)`` for every row: a hash of its text, and the
    fingerprint as a signed long."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = np.fromiter((fingerprint(text_of(t), shingle) for t in pdf["text"]), np.uint64, len(pdf))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "text_key": pdf["text_key"],
                                "fp": fps.view(np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                       "text").mapInPandas(rows, "doc_id long, text_key long, fp long")


def _code() -> np.ndarray:
    """A 16-bit check word for each of the 64 bit positions (a fixed linear code)."""
    x = np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(48)).astype(np.int64)


def _syndrome(x: np.ndarray, shards: int) -> np.ndarray:
    """Parity-code bucket in [0, shards) of 64-bit words; ``shards`` is a power of two."""
    out = np.zeros(len(x), np.int64)
    for i, c in enumerate(_code()):
        out ^= ((x >> np.uint64(i)) & np.uint64(1)).astype(np.int64) * int(c)
    return out & (shards - 1)


def _flips(bits: list[int], radius: int) -> np.ndarray:
    """Masks with exactly ``radius`` of the bits set."""
    one = [1 << b for b in bits]
    masks = {0: [0], 1: one, 2: [a | b for i, a in enumerate(one) for b in one[:i]]}[radius]
    return np.array(masks, np.uint64)


def _send(k: int, split: dict[int, int]):
    """Rows (prefix, shard, fp): a fingerprint goes to every prefix that holds a variant of it."""
    top = list(range(64 - k, 64))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            even = np.bitwise_count(fp) % 2 == 0
            for part, radii in ((fp[even], (0, 1, 2)), (fp[~even], (0, 1))):
                for mask in np.concatenate([_flips(top, r) for r in radii]):
                    prefix = ((part ^ mask) >> np.uint64(64 - k)).astype(np.int64)
                    whole = ~np.isin(prefix, list(split))
                    yield pd.DataFrame({"prefix": prefix[whole], "shard": 0, "fp": part[whole].view(np.int64)})
                    for p, shards in split.items():
                        hit = part[prefix == p].view(np.int64)
                        yield pd.DataFrame({"prefix": p, "shard": np.repeat(np.arange(shards), len(hit)),
                                            "fp": np.tile(hit, shards)})

    return rows


def match_group(prefix: int, k: int, fp: np.ndarray, shard: int, shards: int, max_bits: int) -> np.ndarray:
    """Edges (node, root) found on the variants of one prefix (and code shard)."""
    fp = np.unique(fp)
    low = list(range(64 - k))
    gap = np.bitwise_count((fp >> np.uint64(64 - k)) ^ np.uint64(prefix))  # flips spent on the prefix
    home = (fp & np.uint64((1 << (64 - k)) - 1)) | np.uint64(prefix << (64 - k))
    even = np.bitwise_count(fp) % 2 == 0
    syn = _syndrome(home, shards)

    def variants(of: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks (variant, index of its fingerprint) of at most about a million."""
        masks = _flips(low, radius)
        step = max(1, (1 << 20) // max(1, len(of)))
        for i in range(0, len(masks) if len(of) else 0, step):
            block = masks[i:i + step]
            if shards > 1:
                m, j = np.nonzero((syn[of][None, :] ^ _syndrome(block, shards)[:, None]) == shard)
            else:
                m, j = np.repeat(np.arange(len(block)), len(of)), np.tile(np.arange(len(of)), len(block))
            yield home[of[j]] ^ block[m], of[j]

    index = np.arange(len(fp))
    hub = [x for sel, r in ((even & (gap == 0), 0), (~even & (gap == 0), 1), (~even & (gap == 1), 0))
           for x in variants(index[sel], r)]
    if not hub:
        return np.empty((0, 2), np.uint64)
    hv, hf = np.concatenate([x[0] for x in hub]), fp[np.concatenate([x[1] for x in hub])]
    order = np.lexsort((hf, hv))
    hv, hf = hv[order], hf[order]
    first = np.concatenate([[True], hv[1:] != hv[:-1]])
    keys, roots = hv[first], hf[first]  # each hub variant's smallest fingerprint
    edges = [np.stack([hf, roots[np.cumsum(first) - 1]], 1)]
    edges[0] = edges[0][edges[0][:, 0] != edges[0][:, 1]]
    # 2-flips only look hub variants up; a bitmap turns nearly all of them away
    size = max(16, int(math.log2(len(keys) + 1)) + 5)
    shift, mul = np.uint64(64 - size), np.uint64(0x9E3779B97F4A7C15)
    seen = np.zeros(1 << size, bool)
    seen[(keys * mul) >> shift] = True
    for sel, r in ((even & (gap == 0), 2), (even & (gap == 1), 1), (even & (gap == 2), 0)):
        for v, own in variants(index[sel], r):
            maybe = seen[(v * mul) >> shift]
            if not maybe.any():
                continue
            v, own = v[maybe], own[maybe]
            at = np.minimum(np.searchsorted(keys, v), len(keys) - 1)
            ok = keys[at] == v
            if ok.any():
                edges.append(np.stack([fp[own[ok]], roots[at[ok]]], 1))
    found = np.concatenate(edges)
    close = np.bitwise_count(found[:, 0] ^ found[:, 1])  # verify
    found = found[(close <= max_bits) & (close > 0)]
    return np.unique(found, axis=0)


def links(fps: DataFrame, n: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``(node, root)`` whose components are those of the distance graph of ``fps(fp)``.

    ``fps`` holds ``n`` distinct fingerprints.  Edges join fingerprints at most
    ``max_bits`` apart; pairs joined only through a common hub are not repeated.

    For a ``max_bits`` under 3 a hub star would be too wide, so those radii are
    refused; 3 is the radius that the two halves are built for."""
    if max_bits != 3:
        raise ValueError("variants are laid out for a radius of 3 bits")
    k = min(24, max(4, math.ceil(math.log2(max(n, 1) / GROUP_ROWS))))
    # prefixes with very many fingerprints of their own: at most n / HOT_ROWS rows
    prefix = F.shiftrightunsigned(F.col("fp"), 64 - k)
    hot = {int(r["prefix"]): 1 << math.ceil(math.log2(r["count"] / HOT_ROWS)) for r in
           fps.groupBy(prefix.alias("prefix")).count().where(F.col("count") > HOT_ROWS).collect()}
    sent = fps.mapInPandas(_send(k, hot), "prefix long, shard long, fp long")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        p, shard = int(key[0]), int(key[1])
        found = match_group(p, k, pdf["fp"].to_numpy(np.int64).view(np.uint64), shard, hot.get(p, 1), max_bits)
        return pd.DataFrame({"node": found[:, 0].view(np.int64), "root": found[:, 1].view(np.int64)})

    return sent.groupBy("prefix", "shard").applyInPandas(run, "node long, root long")


def simhash_near_dups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id, text_key, keeper)``, one row for each row of
    ``docs(doc_id, text)``.

    ``keeper`` marks the row that stands for its component: the smallest doc_id (null last),
    then the smallest text_key.  Null or word-free texts have fingerprint zero and link like
    any other.  Rows that repeat a doc_id are each a row of the result; full repeats of a
    keeper are keepers too.  A null doc_id never becomes a component_id unless its whole
    component has none (then it is null).  An empty table gives an empty result; other
    columns are ignored."""
    fps = materialize(fingerprints(docs, shingle), "simhash-fp")
    low = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = materialize(fps.groupBy("fp").agg(F.min(low).alias("low")), "simhash-class")
    edges = materialize(links(classes.select("fp"), classes.count(), max_bits), "simhash-links")
    roots = components(edges, "simhash")
    named = materialize(classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-named")
    least = materialize(named.groupBy("root").agg(F.min("low").alias("low")), "simhash-least")
    by_fp = materialize(named.select("fp", "root").join(least, "root").select("fp", "low"), "simhash-component")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("low.doc_id").alias("component_id"),
        "text_key", (F.col("doc_id").eqNullSafe(F.col("low.doc_id"))
                     & (F.col("text_key") == F.col("low.text_key"))).alias("keeper"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
