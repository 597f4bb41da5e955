"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.sources.sinks import discard, materialize

__all__ = ["components", "crc_mod", "discard", "materialize", "table", "text_of", "worker_cache", "words_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(col: str, modulus: int):
    """``crc32(col as text) mod modulus`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % modulus


def text_of(value) -> str:
    return value if isinstance(value, str) else ""


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: exactly what ``bytes.split`` separates."""
    return text.encode("utf-8").split()


def local_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest reachable node of every node of an edge list: (nodes, roots).

    Hooks each root to the smallest root it touches, then halves paths, until stable."""
    nodes, inverse = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inverse[:len(u)], inverse[len(u):]
    parent = np.arange(len(nodes))
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return nodes, nodes[parent]
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _forest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    u, v = np.empty(0, np.int64), np.empty(0, np.int64)
    for pdf in batches:  # contracted batch by batch: holds one edge for each node seen
        u = np.concatenate([u, pdf["node"].to_numpy(np.int64)])
        v = np.concatenate([v, pdf["root"].to_numpy(np.int64)])
        nodes, roots = local_forest(u, v)
        keep = nodes != roots
        u, v = nodes[keep], roots[keep]
    yield pd.DataFrame({"node": u, "root": v})


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(node long, root long)``.

    Returns ``(node, root)`` with the smallest reachable node for every node that is not
    itself the smallest.  Each round contracts the edges that meet in one task into a
    forest (rows are dealt by child, and a child has one row per task of the round
    before, so no key is hot), stores it in the shared folder, and lets every node jump
    to the root of its root.  The jump is a plain join of two stored tables, which AQE
    splits at a hot root.  Ends when no root is a child and every child has one row: a root
    that a task hooks gets a row there while another task may hold one of it too, and the
    next round brings the two together.  The driver sees two counts a round.  Null ids must be left out by the caller; no edges give an empty table."""
    schema = "node long, root long"
    edges = edges.select("node", "root").mapInPandas(_forest_rows, schema)
    rounds = 0
    while True:
        forest = materialize(edges.repartition(F.col("node")).mapInPandas(_forest_rows, schema),
                             f"{name}-forest-{rounds}")
        up = forest.select(F.col("node").alias("up_node"), F.col("root").alias("up_root"))
        jumped = forest.join(up, F.col("root") == F.col("up_node"), "left")
        if jumped.where(F.col("up_node").isNotNull()).limit(1).count() == 0 and forest.groupBy("node").count().where(
                F.col("count") > 1).limit(1).count() == 0:
            return forest
        rounds += 1
        # child -> root of its root; the old edge stays, so nothing that was linked comes apart
        edges = jumped.select("node", F.coalesce("up_root", "root").alias("root")).unionByName(
            jumped.where(F.col("up_root").isNotNull()).select(
                F.col("root").alias("node"), F.col("up_root").alias("root")).distinct())


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker (tables that tasks need again)."""
    import builtins

    return builtins.__dict__.setdefault("_corpus_worker_cache", {}).setdefault(name, {})
