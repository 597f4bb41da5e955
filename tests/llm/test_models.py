"""Language ID, toxicity and the Pitman-Yor model."""

from __future__ import annotations

import math
import pathlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from civic_mart.llm import language, pitman_yor, queries, toxicity
from civic_mart.llm.common import crc_mod
from llm_data import no_docs, odd_docs


# ---------------------------------------------------------------- language

def test_language_held_out_accuracy(spark):
    got = queries.QUERIES["op3_language"](spark, SF_SMALL).toPandas()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs)
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    assert (both["lang_pred"] == both["lang"])[both["held_out"]].mean() > 0.9
    assert got["score"].between(0, 1).all()


def test_language_on_odd_rows(spark):
    got = language.language_id(odd_docs(spark)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 11
    for i in (2, 3, 4, 8):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0 and by_id[i].rejected
    assert by_id[1].lang_pred in {"en", "de", "fr"}
    assert language.language_id(no_docs(spark)).collect() == []
    unlabelled = odd_docs(spark).withColumn("lang", language.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.language_id(unlabelled).collect()} == {"und"}


def test_subwords_do_not_cross_texts():
    one, at = language.subwords(["abc", "", "Déf g"])
    for i, t in enumerate(["abc", "", "Déf g"]):
        assert sorted(one[at[i]:at[i + 1]]) == sorted(language.subwords([t])[0])


# ---------------------------------------------------------------- toxicity

def test_gradients():
    rng = np.random.default_rng(0)
    m = toxicity.BiGru.fresh(1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    f = toxicity.word_features([b"abc", b"de", b"idiot!", b"x"])
    idx, live, y = np.array([[0, 1, 2, 3], [2, 1, 0, 0]]), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool), np.array([1.0, 0.0])

    def loss():
        p = toxicity._sigmoid(m.forward(m.inputs(f), idx, live))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = m.gradients(f, idx, live, y)
    for k, a in m.p.items():
        if k.startswith("e_"):
            total = np.zeros(a.shape)
            np.add.at(total, *g[k])
            i = (int(g[k][0][1]), 2)
            want = total[i]
        else:
            i = tuple(rng.integers(0, s) for s in a.shape)
            want = g[k][i]
        old = a[i]
        a[i] = old + 1e-3
        up = loss()
        a[i] = old - 1e-3
        down = loss()
        a[i] = old
        assert (up - down) / 2e-3 == pytest.approx(want, rel=0.05, abs=1e-5), k


def test_window_starts_cover_a_text():
    for n in (0, 1, 63, 64, 65, 112, 113, 500):
        starts = toxicity.window_starts(n)
        assert set().union(*(range(s, min(s + 64, n)) for s in starts)) == set(range(n))
        assert all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_toxicity_learns_and_finds_one_word_in_a_long_text(spark):
    rng = random.Random(3)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    bad = ["idiot", "moron", "scum"]
    rows, labels = [], []
    for i in range(700):
        words = [word() for _ in range(rng.randrange(20, 160))]
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(9000, " ".join([word() for _ in range(3000)] + ["you", "moron", "idiot", "scum"] + [word() for _ in range(3000)])),
             (9001, None), (9002, ""), (None, "fine words"), (9003, " ".join(word() for _ in range(50)))]
    docs = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "doc_id long, text string, toxic int, score double")
    known = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, known).toPandas()
    assert len(got) == len(rows)
    held = got[got["held_out"] & (got["doc_id"] < 700)]
    truth = held["doc_id"] % 4 == 0
    assert ((held["predicted"] == 1) == truth).mean() > 0.95
    by_id = got.set_index("doc_id")
    assert by_id.loc[9000, "predicted"] == 1
    assert by_id.loc[9001, "score"] == 0 and by_id.loc[9002, "score"] == 0
    assert (got["held_out"] == [pd.notna(i) and zlib.crc32(str(int(i)).encode()) % 4 == 2 for i in got["doc_id"]]).all()


def test_toxicity_is_fitted_on_whole_texts(spark, monkeypatch):
    free = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    long = {i: " ".join(f"w{i}x{j}" for j in range(4000)) + " " + "中" * 200 for i in free}  # 83 windows
    docs = spark.createDataFrame(list(long.items()) + [(i, "held out") for i in range(400) if i not in long],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2 if i in long else 1) for i in range(400)], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda *a: seen.update(a=a) or toxicity.BiGru())
    toxicity.fit(docs, labels, 10, 10)
    texts, y, share = seen["a"]
    assert len(texts) == 20 and set(texts) <= set(long.values()) and y.sum() == 10
    assert share == sum(i % 2 for i in free) / len(free)  # held-out labels are not read
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 4 * len(long[free[0]].encode()))
    toxicity.fit(docs, labels, 10, 10)
    assert 2 <= len(seen["a"][0]) <= 8 and set(seen["a"][1]) == {0, 1}  # fewer rows, each whole


def test_toxicity_is_calibrated_on_all_windows(monkeypatch):
    monkeypatch.setattr(toxicity, "MIN_STEPS", 2)
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(2000)) for i in range(120)]  # 42 windows
    y, seen = np.arange(120) % 2, {}
    monkeypatch.setattr(toxicity.BiGru, "calibrate", lambda self, top, y, share: seen.update(top=top))
    model = toxicity.train(texts, y, 0.5, epochs=(1, 0, 0))
    held = np.random.default_rng(5).permutation(120)[:30]
    assert np.allclose(toxicity._sigmoid(seen["top"]), model.scores([texts[i] for i in held]))


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(odd_docs(spark), labels).collect()} == {0.0}
    assert toxicity.toxicity(no_docs(spark), labels).collect() == []


# ---------------------------------------------------------------- Pitman-Yor

def brute_base(docs, held):
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for t in docs]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
            for ws in tokens], n


def test_lm_scores(spark):
    got = queries.QUERIES["op2_lm"](spark, SF_SMALL).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().sort_values("doc_id")
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in docs["doc_id"]]
    base, n = brute_base(docs["text"], held)
    assert got["held_out"].tolist() == held and set(got["train_tokens"]) == {n}
    assert list(zip(got["n_tokens"], got["n_known"])) == [b[:2] for b in base]
    assert np.allclose(got["base_score"], [b[2] for b in base])
    unseen = got[got["held_out"]]
    assert unseen["score"].sum() > unseen["base_score"].sum()  # a better model of texts it has not seen


def test_lm_on_odd_rows(spark, tmp_path):
    odd_docs(spark).write.parquet(f"{tmp_path}/d")  # a stored table
    docs = spark.read.parquet(f"{tmp_path}/d")
    got = pitman_yor.lm_scores(docs, crc_mod("doc_id", 5) == 1, buckets=7).collect()
    rows = docs.collect()
    base, n = brute_base([r.text for r in rows], [zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 1 for r in rows])
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == sorted(
        (str(r.doc_id), *b[:2], round(b[2], 4)) for r, b in zip(rows, base))
    assert {r.train_tokens for r in got} == {n}
    nothing = pitman_yor.lm_scores(docs, crc_mod("doc_id", 5) >= 0).collect()
    assert {(r.train_tokens, r.base_score, r.score) for r in nothing} == {(0, 0.0, 0.0)}
    assert pitman_yor.lm_scores(no_docs(spark), crc_mod("doc_id", 5) == 1).collect() == []


def test_probabilities_sum_to_one():
    """In every context the known tokens and the unknown one share the mass."""
    rng = np.random.default_rng(0)
    types, classes = 200, pitman_yor.CLASSES
    words = np.arange(types, dtype=np.uint64)
    pair = np.unique(rng.integers(0, types * 5, 600))
    word, cls = pair // 5, pair % 5
    counts = rng.geometric(0.2, len(pair)).astype(np.int64)
    word = np.concatenate([word, np.setdiff1d(np.arange(types), word)])
    cls, counts = (np.concatenate([x, np.ones(len(word) - len(pair), np.int64)]) for x in (cls, counts))
    row = type("Row", (), {"bucket": 0, "words": words.tobytes(), "pair_word": word.astype(np.uint32).tobytes(),
                           "classes": cls.astype(np.uint8).tobytes(), "counts": counts.tobytes()})
    tokens = np.bincount(cls, counts, classes)
    all_ = pitman_yor.Restaurants(int(counts.sum()), types, tokens, np.bincount(cls, minlength=classes), len(word), types, 0.7, 0.6)
    # the totals of one seating, then the predictive of that same seating
    run = pitman_yor.sweeps(row, all_, 5)
    tables, customers, root_tables, _ = next(run)
    exact = pitman_yor.Restaurants(all_.n, types, tokens, np.bincount(cls, tables, classes), customers.sum(),
                                   root_tables.sum(), 0.7, 0.6)
    parent = exact.parent(customers, root_tables)
    assert parent.sum() + exact.unknown() == pytest.approx(1, abs=1e-9)
    for k in range(5):
        mine = cls == k
        own = (counts - 0.7 * tables)[mine].sum() / (pitman_yor.THETA_CONTEXT + tokens[k])
        assert own + exact.back_off()[k] == pytest.approx(1, abs=1e-9)


def test_predictive_sums_to_one_over_buckets():
    """The job's own steps on several buckets: in every context, seen or not, the averaged
    probabilities of all known words and the unknown one sum to one."""
    rng = np.random.default_rng(3)
    classes, texts = pitman_yor.CLASSES, [" ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 400) for _ in range(200)]
    chunk = pitman_yor.Chunk(texts, np.zeros(len(texts), bool), 5)
    asked = pd.DataFrame(list(chunk.by_bucket(True)), columns=["bucket", "words", "pairs", "classes", "counts"])
    model = pd.concat([pitman_yor._merge((b,), part) for b, part in asked.groupby("bucket")], ignore_index=True)
    tokens, pairs = np.stack(model["class_tokens"]).sum(0), np.stack(model["class_pairs"]).sum(0)
    types = sum(len(w) // 8 for w in model["words"])
    all_ = pitman_yor.Restaurants(int(tokens.sum()), types, tokens, pairs, pairs.sum(), types, 0.7, 0.6)
    seated = pd.concat(pitman_yor._seatings(all_, 4)(iter([model])), ignore_index=True)
    tables = np.stack(seated["class_tables"]).sum(0).reshape(pitman_yor.SAMPLES, classes)
    customers, root = (np.stack(seated[c]).sum(0) for c in ("customers", "root_totals"))
    seatings = [pitman_yor.Restaurants(all_.n, types, tokens, tables[i], customers[i], root[i], 0.7, 0.6)
                for i in range(pitman_yor.SAMPLES)]
    total = np.mean([a.back_off() * a.unknown() for a in seatings], axis=0)  # the unknown token in each class
    for row in seated.itertuples():
        p, parents = pitman_yor.predictive(row, seatings)
        word = np.frombuffer(row.pair_word, np.uint32).astype(np.int64)
        cls = np.frombuffer(row.classes, np.uint8).astype(np.int64)
        every = np.mean([a.back_off()[:, None] * parent for a, parent in zip(seatings, parents)], axis=0)  # (class, word)
        every[cls, word] = p
        total += every.sum(1)
    assert np.allclose(total, 1, atol=1e-9)


def test_seating_follows_the_restaurant_process():
    """Mean tables of the sampler against the exact recursion of the process."""
    c, weight, d = 40, 3.0, 0.5
    p = np.zeros(c + 1)
    p[1] = 1
    for i in range(1, c):
        new = np.where(np.arange(c + 1) <= i, weight / np.maximum(weight + i - d * np.arange(c + 1), 0.1), 0)
        p = p * (1 - new) + np.concatenate([[0], (p * new)[:-1]])
    want = (p * np.arange(c + 1)).sum()
    got = pitman_yor.seat(np.full(4000, c), np.full(4000, weight), d, np.random.default_rng(1)).mean()
    assert got == pytest.approx(want, rel=0.02)


def test_context_is_the_word_before(spark, tmp_path):
    """Two words with the same last letters are contexts of their own (they were one class)."""
    rows = [(i, f"x{j}aaa left{j % 2}" if i % 2 else f"y{j}aaa right{j % 2}") for j in range(4) for i in range(j * 40, j * 40 + 40)]
    asked = [(1000, "x1aaa left1"), (1001, "x1aaa right1"), (1002, "y1aaa right1"), (1003, "y1aaa left1")]
    spark.createDataFrame(rows + asked, "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    got = {r.doc_id: r.score for r in pitman_yor.lm_scores(spark.read.parquet(f"{tmp_path}/d"), F.col("doc_id") >= 1000,
                                                           buckets=3).collect()}
    assert got[1000] > got[1001] + 0.5 and got[1002] > got[1003] + 0.5


def test_lm_sums_to_one_in_every_word_context(spark, tmp_path, monkeypatch):
    """All tokens that can follow a word, the unknown one included, share its mass, through the job."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 30) % 60) for _ in range(120)]
    words = sorted({w for t in texts for w in t.split()})
    before = [*words[:6], "never seen"]
    asked = [f"{u} {w}" for u in before for w in [*words, "?"]] + [*words, "?", "", *before]
    spark.createDataFrame(list(enumerate(texts + asked)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")
    kept = f"{tmp_path}/tokens"

    def score(n, types, discount, start):
        def run(key, tokens, answers):
            t = next(tokens.itertuples())
            _, log_p, _ = pitman_yor.token_scores(t, answers, discount, start)
            ends = np.cumsum(np.frombuffer(t.sizes, np.int64))
            pd.Series([log_p[e - s:e] for s, e in zip(np.frombuffer(t.sizes, np.int64), ends)], index=t.doc_ids).to_pickle(kept)
            return scored(key, tokens, answers)
        scored = real(n, types, discount, start)
        return run

    real = pitman_yor._score
    monkeypatch.setattr(pitman_yor, "_score", score)
    docs = spark.read.parquet(f"{tmp_path}/d")
    pitman_yor.lm_scores(docs, F.col("doc_id") >= len(texts), buckets=4).collect()
    log_p = dict(zip(texts + asked, pd.read_pickle(kept).sort_index()))
    for u in before:
        k = len(u.split())
        follow = [log_p[f"{u} {w}"][k] for w in [*words, "?"]] + [log_p[u][k]]
        assert sum(10.0**x for x in follow) == pytest.approx(1, abs=1e-5)  # answers travel in single precision
    assert sum(10.0**x for x in [log_p[w][0] for w in [*words, "?"]] + [log_p[""][0]]) == pytest.approx(1, abs=1e-5)


def test_reseating_samples_the_posterior(monkeypatch):
    """Gibbs steps against the posterior by its own recursion, drawn at once and customer by customer."""
    def posterior(c, d, rate):
        p = np.zeros(c + 2)
        p[1] = 1
        for i in range(1, c):
            t = np.arange(c + 2)
            p = p * np.maximum(i - d * t, 0) + np.concatenate([[0], (p * rate(t))[:-1]])
        return p[:c + 1] / p.sum()

    rng = np.random.default_rng(2)
    for c, d, strength, others in ((3, 0.5, 1.0, 0.0), (40, 0.7, 5.0, 3.0)):
        want = posterior(c, d, lambda t: (strength + d * (others + t)) * (2.0 + t) / (9.0 + t))
        full = lambda x: np.full(20000, x)
        for drawn, steps in ((64, 1), (0, 40)):
            monkeypatch.setattr(pitman_yor, "DRAWN", drawn)
            tables = full(1)
            for _ in range(steps):
                tables = pitman_yor.reseat(full(c), tables, d, strength, full(others), full(2.0), full(9.0), rng)
            assert np.allclose(np.bincount(tables, minlength=c + 1) / 20000, want, atol=0.015)
    # the curve for large dishes goes on where the table ends
    c = np.full(6, pitman_yor.EXACT)
    t = np.array([1, 2, 3, 10, 50, 300])
    assert np.allclose(pitman_yor.sits_alone(c, t, 0.7), pitman_yor.sits_alone(c + 1, t, 0.7), rtol=0.01)


def test_lm_buckets_grow_with_the_texts(spark, tmp_path, monkeypatch):
    odd_docs(spark).write.parquet(f"{tmp_path}/d")
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 20)
    seen, real = [], pitman_yor._table_totals
    monkeypatch.setattr(pitman_yor, "_table_totals", lambda *a: seen.append(a[2]) or real(*a))
    docs = spark.read.parquet(f"{tmp_path}/d")
    size = sum(len((r.text or "").encode()) for r in docs.collect())
    monkeypatch.setattr(pitman_yor, "MIN_BUCKETS", 1)
    pitman_yor.lm_scores(docs, crc_mod("doc_id", 5) == 1).count()
    assert seen == [max(size // 20, int(spark.conf.get("spark.sql.shuffle.partitions")))]


def test_lm_leaves_no_tables_and_settings_behind(spark, tmp_path, monkeypatch):
    """What the steps store goes as soon as nothing reads it: only the scores stay."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.2, 400) % 90000) for _ in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    stored, real = {}, pitman_yor.materialize
    monkeypatch.setattr(pitman_yor, "materialize", lambda df, name: stored.setdefault(name, real(df, name)))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.minPartitionNum", "spark.sql.parquet.compression.codec",
                                                   "spark.sql.classic.shuffleDependency.fileCleanup.enabled")}
    got = pitman_yor.lm_scores(docs, crc_mod("doc_id", 5) == 1, buckets=4)
    assert got.count() == len(texts)
    left = {name for name, df in stored.items()
            if pathlib.Path(df.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parent.exists()}
    assert left == {"lm-scores"}
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_lm_chunk_is_sent_once():
    """A bucket learns from the pairs of held-out texts nothing, and knows where each chunk's lie among its own."""
    texts = ["the cat sat", "the dog sat on the cat", "a bird the cat", ""]
    chunk = pitman_yor.Chunk(texts, np.array([False, False, True, True]), 3)
    sent = pd.DataFrame(list(chunk.by_bucket())).assign(chunk="c")
    n = learned = 0
    for b, part in sent.groupby("bucket"):
        row = next(pitman_yor._merge((b,), part).itertuples())
        asked = pitman_yor.unpack_places(row.asked_words[0])
        known = np.frombuffer(row.words, np.uint64)
        for word, at in zip(np.frombuffer(part["words"].iloc[0], np.uint64), asked):
            assert (at < 0 and word not in known) or known[at] == word
        at = pitman_yor.unpack_places(row.asked_contexts[0])
        assert (pitman_yor.unpack(part["contexts"].iloc[0])[at >= 0] == pitman_yor.unpack(row.contexts)[at[at >= 0]]).all()
        n, learned = n + len(at), learned + (at >= 0).sum()
        assert np.frombuffer(row.context_counts, np.uint32).min(initial=1) > 0
    pairs = [list(zip([None, *t.split()], [*t.split(), ""])) for t in texts]
    assert n == len({p for t in pairs for p in t}) and learned == len({p for t in pairs[:2] for p in t})


def test_lm_places_and_small_numbers_come_back():
    for places in ([], [-1], [0], [5, -1, 3, 3, 2**30, 0, -1]):
        assert pitman_yor.unpack_places(pitman_yor.pack_places(np.array(places, np.int64))).tolist() == places
    for kind in (np.float32, np.int64):
        x = np.array([0, 1, 2.5, 1e6]).astype(kind)
        assert (pitman_yor.grow(pitman_yor.shrink(x), kind) == x).all()


def test_lm_texts_that_changed_between_readings_fail():
    chunk = pd.DataFrame([{"chunk": "0-0-x"}])
    with pytest.raises(ValueError, match="not asked"):
        pitman_yor.token_scores(next(chunk.itertuples()), pd.DataFrame(columns=["bucket", "pair_p"]), 0.5, (0.0, 0.0))
