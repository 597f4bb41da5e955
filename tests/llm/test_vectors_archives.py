"""Embedding near-dedup and the archive converter."""

from __future__ import annotations

import base64
import gzip
import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from civic_mart.llm import hnsw, warc
from civic_mart.llm.common import local_forest


def brute_links(ids, vectors, least=0.95):
    ok = [i for i, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, edges = {i: 0 for i in range(len(ids))}, []
    for a in ok:
        for b in ok:
            if a != b and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a], float), np.array(vectors[b], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[a] += 1
                    edges.append((a, b))
    root = {i: i for i in range(len(ids))}
    if edges:
        root |= dict(zip(*(x.tolist() for x in local_forest(*np.array(edges).T))))
    return links, root


def clouds(n, copies, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    near = np.concatenate([base[i % n] + rng.normal(size=(1, dim)) * rng.choice([0.05, 0.1, 0.3]) for i in range(copies)])
    return np.concatenate([base, near, base[:5]]).astype(np.float32)


def test_graph_finds_what_brute_force_finds():
    x = clouds(1500, 600)
    graph, order = hnsw.Graph.build(hnsw.unit(x.astype(np.float64)))
    graph.widen(0.95)
    unit = hnsw.unit(x.astype(np.float64))
    want = {(i, j) for i, j in zip(*np.nonzero(unit @ unit[order].T >= 0.95))}
    got = set()
    for i in range(0, len(unit), 256):
        r, c = graph.within(unit[i:i + 256], 0.95)
        got |= set(zip((r + i).tolist(), c.tolist()))
    assert not got - want and len(got & want) / len(want) >= 0.98


def test_large_group_is_followed_in_parts():
    rng = np.random.default_rng(5)
    x = hnsw.unit(rng.normal(size=(1, 24)) + rng.normal(size=(3000, 24)) * 0.02)
    graph, _ = hnsw.Graph.build(x)
    tracemalloc.start()
    found = 0
    for row, node in graph.hits(graph.vec[:256], 0.95):
        assert len(row) <= hnsw.PAIRS and (np.diff(row) >= 0).all()
        found += len(row)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 256 * 3000 == len(graph.within(graph.vec[:256], 0.95)[0])
    assert peak < 40e6  # 435 MB when all pairs were followed at once


def test_graph_travels_as_rows_of_its_nodes():
    x = clouds(6000, 300, seed=7).astype(np.float64)
    n = len(x)
    table = pa.table({"dim": pa.array([24] * n, pa.int32()), "shard": pa.array([1] * n, pa.int32()), "node": np.arange(n),
                      "weight": np.ones(n, np.int64), "embedding": pa.array(list(x))})
    out = list(hnsw._build(0.95)(iter(table.to_batches(1000))))
    assert [b.num_rows for b in out] == [hnsw.OUT_ROWS, n - hnsw.OUT_ROWS]
    assert max(pa.table(b.slice(0, 1).to_pydict()).nbytes for b in out) < 2000  # whatever the shard's size
    graph, raw, weights, roots = hnsw._load(iter(out))
    scaled = x / np.abs(x).max(1, keepdims=True)
    built, order = hnsw.Graph.build(hnsw.unit(scaled))
    assert (raw == scaled[order]).all() and (graph.vec == built.vec).all() and len(weights) == len(roots) == n
    assert len(graph.layers) == len(built.layers) and all((a == b).all() for a, b in zip(graph.layers, built.layers))


def test_wide_vectors_make_more_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_VALUES", 1000)
    x = clouds(200, 100, seed=4)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.embedding_near_dups(vectors).collect()}  # 8 shards, not 4
    links, root = brute_links(range(len(x)), x.tolist())
    assert got == {i: (links[i], root[i]) for i in range(len(x))}


def test_operator_matches_brute_force(spark):
    x = clouds(300, 200, seed=2)
    rows = [(int(i * 3 + 1), v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5001, []), (5002, [0.0] * 24), (5003, [float("nan")] + [1.0] * 23), (5004, [None] + [1.0] * 23),
             (5005, [float("inf")] * 24), (5006, [1.0, 2.0]), (5007, [2.0, 4.0]), (5008, x[3].tolist()), (5008, x[3].tolist())]
    vectors = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, n_links int, node int")
    got = sorted(hnsw.embedding_near_dups(vectors.repartition(4)).collect(), key=lambda r: (r.vec_id, r.n_links))
    links, root = brute_links(*zip(*rows))
    low = {}
    for i, (vec_id, _) in enumerate(rows):
        low[root[i]] = min(low.get(root[i], vec_id), vec_id)
    want = sorted((rows[i][0], links[i], low[root[i]], rows[i][0] == low[root[i]]) for i in range(len(rows)))
    assert [tuple(r) for r in got] == want


def test_null_ids_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    got = hnsw.embedding_near_dups(spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [0.0, 1.0]), (None, None)], schema))
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got.collect()) == [
        ("4", 1, "4", True), ("None", 0, "None", True), ("None", 0, "None", True), ("None", 1, "4", False)]
    assert hnsw.embedding_near_dups(spark.createDataFrame([], schema)).collect() == []


# ---------------------------------------------------------------- archives

def test_arc_versions():
    block = b"HTTP/1.1 200 OK\r\nX-Page-Id: 3\r\n\r\nbody\n\nhttp://x 1 2 3 4\n"
    n = len(block)
    one = warc.arc_version_block(1).encode() + b"http://a/ 1.2.3.4 20200102030405 text/html %d\n" % n + block + b"\n"
    two = warc.arc_version_block(2).encode() + b"http://b/ 1.2.3.4 20200102030405 text/html 200 ck - 17 f.arc %d\n" % n + block + b"\n"
    for content in (one + two, gzip.compress(one + two), gzip.compress(one) + gzip.compress(two)):
        a, b = warc.parse_arc(content)
        assert a["url"] == "http://a/" and a["block"] == block and "status" not in a
        assert b["url"] == "http://b/" and b["block"] == block and b["status"] == "200"
    with pytest.raises(ValueError, match="cut"):
        list(warc.parse_arc(one[:-30]))
    with pytest.raises(ValueError, match="fields"):
        list(warc.parse_arc(warc.arc_version_block(2).encode() + b"http://a/ 1.2.3.4 2020 text/html 0\n"))
    assert list(warc.parse_arc(b"")) == []


PAGES = "page_id long, url string, html string, digest string, payload int"


def odd_pages(spark):
    rows = [(5, "http://a", "same"), (3, "http://b c", "same"), (9, None, "same"), (1, "", None), (2, "http://d", ""),
            (7, "http://é", "\r\n\r\nWARC/1.1\r\n\r\nx\n" * 40), (None, "http://e", "same"), (None, "http://f", "lonely"),
            (8, "http://g", "中🙂" * 30000), (3, "http://h", "same")]
    return spark.createDataFrame([(*r, "d", 1) for r in rows], PAGES), rows


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, tmp_path, version):
    pages, rows = odd_pages(spark)
    got = warc.arc_to_warc(pages.repartition(2), f"{tmp_path}/arc", f"{tmp_path}/warc", version).collect()
    low = {}
    for page, _, html in rows:
        if page is not None:
            low[html or ""] = min(low.get(html or "", page), page)
    want = []
    for page, _, html in rows:
        raw, first = (html or "").encode(), low.get(html or "")
        revisit = first is not None and first != page
        want.append((str(page), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if revisit else "response", str(first if revisit else None)))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == sorted(want)


def test_revisits_have_no_payload_and_refer_to_records(spark, tmp_path):
    pages, _ = odd_pages(spark)
    warc.arc_to_warc(pages, f"{tmp_path}/arc", f"{tmp_path}/warc", min_bytes=5).count()
    records = [r for f in warc.archives(spark, f"{tmp_path}/warc").collect() for r in warc.parse_warc(bytes(f.content))]
    assert len(records) == 10 and all(w["warc-type"] == "response" for w, b in records)  # "same" has 4 bytes
    warc.arc_to_warc(pages, f"{tmp_path}/arc2", f"{tmp_path}/warc2").count()
    records = [r for f in warc.archives(spark, f"{tmp_path}/warc2").collect() for r in warc.parse_warc(bytes(f.content))]
    ids = {w["warc-record-id"] for w, b in records if w["warc-type"] == "response"}
    revisits = [(w, b) for w, b in records if w["warc-type"] == "revisit"]
    assert len(revisits) == 4 and all(w["warc-refers-to"] in ids and b.endswith(b"\r\n\r\n") for w, b in revisits)


def test_empty_pages(spark, tmp_path):
    assert warc.arc_to_warc(spark.createDataFrame([], PAGES), f"{tmp_path}/arc", f"{tmp_path}/warc").collect() == []
