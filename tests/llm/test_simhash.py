from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from civic_mart.llm import simhash
from civic_mart.llm.common import components, local_forest
from llm_data import no_docs, odd_docs


def brute_fp(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps: list[int]) -> dict[int, int]:
    low = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in low:
            for b in low:
                if (a ^ b).bit_count() <= 3 and low[b] < low[a]:
                    low[a], changed = low[b], True
    return low


def near(rng, n, flips):
    out = set()
    for _ in range(n):
        base = rng.getrandbits(64)
        out.add(base)
        for _ in range(3):
            x = base
            for b in rng.sample(range(64), rng.choice(flips)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("text", ["", "one", "One two", "a b c", "A b C d a b c d", "x\x1cy z\x0bq", "é É A" * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fp(text)


@pytest.mark.parametrize("hot", [False, True])
def test_links_find_every_component(hot):
    import pandas as pd

    rng = random.Random(4)
    fps = np.array(near(rng, 60, [1, 2, 3, 4]), np.uint64)
    k = 4
    split = {int(p): 4 for p in np.unique(fps >> np.uint64(64 - k))[:5]} if hot else {}
    sent = pd.concat(simhash._send(k, split)(iter([pd.DataFrame({"fp": fps.view(np.int64)})])))
    edges = np.concatenate([simhash.match_group(int(p), k, g["fp"].to_numpy(np.int64).view(np.uint64), int(s),
                                                split.get(int(p), 1), 3) for (p, s), g in sent.groupby(["prefix", "shard"])])
    assert all((int(a) ^ int(b)).bit_count() <= 3 for a, b in edges)
    nodes, roots = local_forest(edges[:, 0], edges[:, 1])
    got = dict(zip(nodes.tolist(), roots.tolist()))
    assert {f: got.get(f, f) for f in fps.tolist()} == brute_components(fps.tolist())


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(20)]
    edges += [(500 + i, 500) for i in range(50)]
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "node long, root long").repartition(4), "t").collect()}
    nodes, roots = local_forest(*np.array(edges).T)
    assert got == {int(n): int(r) for n, r in zip(nodes, roots) if n != r}
    assert components(spark.createDataFrame([], "node long, root long"), "t").count() == 0


def test_components_of_one_chain_in_many_tasks(spark):
    """A root that one task hooks has a row in another task as well: (5,1), (5,2) against (2,0)."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        for hooked in (2, 3, 4):  # whichever way the nodes are dealt, one of these is not dealt with 5
            edges = spark.createDataFrame([(5, 1), (5, hooked), (hooked, 0)], "node long, root long").repartition(8)
            got = sorted(tuple(r) for r in components(edges, "chain").collect())
            assert got == [(1, 0), (hooked, 0), (5, 0)]
    finally:
        spark.conf.set(setting, before)


def test_operator_on_odd_rows(spark):
    docs = odd_docs(spark)
    got = simhash.simhash_near_dups(docs).collect()
    texts = [r.text or "" for r in docs.collect()]
    assert sorted(r.fingerprint for r in got) == sorted(f"{brute_fp(t):016x}" for t in texts)
    by_id = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    zero = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {2}  # null, empty and blank texts link like any other
    assert by_id[7, f"{brute_fp('The cat sat on the mat and looked at the dog'):016x}"] == 1
    assert sum(r.keeper for r in got if r.doc_id == 5) == 3  # the full repeat, and the other text
    assert simhash.simhash_near_dups(no_docs(spark)).collect() == []
