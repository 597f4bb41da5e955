"""Geocode merge: first non-null per key over ordered records, block > tract > neighborhood."""

from __future__ import annotations

from pyspark.sql import functions as F

from civic_mart.operators import spatial
from civic_mart.operators.geocode import GeocodeSpec, LayerSpec, geocode
from conftest import rows

SQ = "POLYGON (({a} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b}))"


def _layers(spark):
    blocks = spark.createDataFrame([(1, SQ.format(a=0, b=0, c=1, d=1), "Q", "1", "B1")],
                                   "pid long, g string, BoroName string, BoroCode string, code string")
    tracts = spark.createDataFrame([(1, SQ.format(a=0, b=0, c=2, d=2), "Q", "1t", "T1"),
                                    (2, SQ.format(a=2, b=0, c=4, d=2), "Q", "2t", "T2")],
                                   "pid long, g string, BoroName string, BoroCode string, code string")
    out = []
    for name, df, prefix in (("blocks", blocks, "b_"), ("tracts", tracts, "t_")):
        layer = spatial.prepare_layer(df, "g", "BoroName", "pid", ["code", "BoroCode", "BoroName"])
        out.append(LayerSpec(prefix, layer, {f"{name}_code": "code"}))
    return out


def test_merge_first_non_null(spark):
    recs = spark.createDataFrame([
        # key, t, x, y, boro, zip
        ("k1", 2, 0.5, 0.5, "Q", None),    # block + tract
        ("k1", 1, 0.5, 0.5, "Q", "111"),   # earlier record carries the zip
        ("k1", 3, 0.5, 0.5, "Q", "333"),
        ("k2", 1, 3.0, 1.0, "q", None),    # tract only
        ("k3", 1, 9.0, 9.0, "Q", "999"),   # nothing
        ("k4", 1, 3.0, 1.0, None, "4"),    # NULL borough: nothing
    ], "k string, t long, x double, y double, boro string, zip string")
    layers = _layers(spark)
    spec = GeocodeSpec(key="k", order=["t"], x="x", y="y", borough="boro", fields={"zipcode": "zip"}, layers=layers)
    got = {r["k"]: r.asDict() for r in geocode(recs, spec).collect()}
    assert len(got) == geocode(recs, spec).count() == 4  # one row per key, k1 three times in the source
    assert got["k1"]["zipcode"] == "111" and got["k1"]["blocks_code"] == "B1"
    assert got["k1"]["tracts_code"] == "T1" and got["k1"]["borough_code"] == "1"  # block wins
    assert got["k2"]["blocks_code"] is None and got["k2"]["tracts_code"] == "T2"
    assert got["k2"]["borough_code"] == "2t"  # falls back to the tract's borough
    assert got["k3"]["tracts_code"] is None and got["k3"]["zipcode"] == "999"
    assert got["k4"]["borough_code"] is None


def test_geocode_invariant_to_partitioning(spark):
    from civic_mart.plans.pipeline import Mart
    from conftest import SF_SMALL
    mart = Mart(spark, SF_SMALL, materialize=False)
    a = mart.stage_inspections()
    mart.m.inspections = lambda _orig=mart.m.inspections: _orig().repartition(7)  # type: ignore[method-assign]
    b = mart.stage_inspections()
    assert rows(a) == rows(b)
    assert a.count() == a.select("camis").distinct().count()  # one row per key


def _stored(spark, monkeypatch):
    from functools import partial

    from civic_mart.sources import sinks
    monkeypatch.setattr(spatial, "prepare_layer", partial(spatial.prepare_layer, materialize=lambda df: sinks.materialize(df, "layer")))
    return _layers(spark)


def test_keys_that_moved_and_keys_that_stayed(spark, monkeypatch):
    """Null keys, null places, repeated rows and keys with several places, against a merge done here."""
    recs = [("a", 1, 0.5, 0.5, "Q", None), ("a", 2, 3.0, 1.0, "Q", "2"), ("a", 2, 3.0, 1.0, "Q", "2"),
            (None, 1, 9.0, 9.0, "Q", "9"), (None, 2, 0.5, 0.5, "Q", "8"), ("b", 3, None, None, None, "3"),
            ("c", 1, None, 1.0, "Q", None), ("c", 4, 3.0, 1.0, "q", None), ("d", 1, 1.5, 1.5, "Q", None),
            ("d", 2, 1.5, 1.5, "Q", "d"), ("e", 1, 0.5, 0.5, "Q", "e"), ("e", 1, 0.5, 0.5, None, "f")]
    df = spark.createDataFrame(recs, "k string, t long, x double, y double, boro string, zip string")
    spec = GeocodeSpec(key="k", order=["t"], x="x", y="y", borough="boro", fields={"zipcode": "zip"}, layers=_stored(spark, monkeypatch))

    def places(x, y, boro):
        q = (boro or "").lower() == "q" and x is not None and y is not None
        block = "B1" if q and 0 < x < 1 and 0 < y < 1 else None
        tract = next((t for t, lo in (("T1", 0), ("T2", 2)) if q and lo < x < lo + 2 and 0 < y < 2), None)
        return block, tract

    want = {}
    for k in {r[0] for r in recs}:
        mine = sorted((r for r in recs if r[0] == k), key=lambda r: (r[1], r[5] or "~"))
        first = lambda values: next((v for v in values if v is not None), None)
        found = [places(*r[2:5]) for r in mine]
        block, tract = first(f[0] for f in found), first(f[1] for f in found)
        want[k] = (first(r[5] for r in mine), block, tract, "1" if block else {"T1": "1t", "T2": "2t"}.get(tract))
    out = geocode(df, spec)
    got = {r["k"]: (r["zipcode"], r["blocks_code"], r["tracts_code"], r["borough_code"]) for r in out.collect()}
    assert got == want and out.count() == len(want)


def test_a_key_with_one_place_is_not_merged(spark, monkeypatch):
    recs = spark.createDataFrame([("a", 1, 0.5, 0.5, "Q", None)], "k string, t long, x double, y double, boro string, zip string")
    spec = GeocodeSpec(key="k", order=["t"], x="x", y="y", borough="boro", fields={"zipcode": "zip"}, layers=_stored(spark, monkeypatch))
    plan = geocode(recs, spec)._jdf.queryExecution().optimizedPlan()
    assert plan.getClass().getSimpleName() == "Union"
    single = plan.children().head().toString()
    # located rows go out as they are: the groups lie under the lookups (the merge was above them)
    assert single.index("Join") < single.index("Aggregate")
