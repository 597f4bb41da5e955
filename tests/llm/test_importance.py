"""Importance resampling: against a plain version, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from civic_mart.llm import importance
from llm_data import no_docs, odd_docs

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, max_n):
    words = PLAIN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, max_n, buckets, min_words, percent, seed=2024):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for rows, count in ((docs, s), ((("", x) for x in target), t)):
        for _, text in rows:
            count.update(bucket(f) for f in runs(text, max_n)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)}
    out = []
    for doc_id, text in docs:
        n, f = runs(text, max_n)
        weight = sum(gain[bucket(x)] for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = percent * len(able) // 100
    ranked = [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)]
    return sorted(ranked + [(*r[:4], None) for r in out if r[4] < min_words], key=str)


@pytest.mark.parametrize("max_n,chunk", [(1, 100_000), (3, 7)])
def test_equals_the_plain_version(spark, max_n, chunk, monkeypatch):
    monkeypatch.setattr(importance, "CHUNK", chunk)
    texts = [(r.doc_id, r.text) for r in odd_docs(spark).collect()] + [
        (20 + i, f"Wörter {i % 7} und mehr\x00nul a{'b' * i} 中文 x-y don't " * (i % 4)) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    target = ["und mehr mehr Text", None, "", "the cat sat on the mat"]
    aim = spark.createDataFrame([(x, 1) for x in target], "text string, item_id int")
    got = importance.resample(docs, aim, max_n=max_n, buckets=500, min_words=5, percent=40)
    rows = sorted((tuple(r)[:5] for r in got.collect()), key=str)
    assert rows == plain(texts, target, max_n, 500, 5, 40)
    assert sum(r[4] is not None for r in rows) > 5


def test_odd_tables(spark):
    aim = spark.createDataFrame([("the cat sat",)], "text string")
    out = importance.resample(odd_docs(spark), aim, min_words=1, percent=100).collect()
    assert len(out) == odd_docs(spark).count()
    ranks = sorted(r["rank"] for r in out if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1))
    assert {r.doc_id for r in out if r["rank"] is None} == {2, 3, 4}
    assert all(r.weight == 0 for r in out if r.n_features == 0)
    assert importance.resample(no_docs(spark), aim).collect() == []
    assert importance.resample(odd_docs(spark), aim.limit(0)).count() == odd_docs(spark).count()
