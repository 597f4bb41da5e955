"""Personal data: patterns against plain ones, messages against enumeration, held-out mentions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from civic_mart.llm import pii, skip_chain
from civic_mart.llm.common import table
from llm_data import no_docs, odd_docs

SF = "/root/testdata/sf0.01"
PLAIN = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))


def fits(kind, s):
    d = [int(c) for c in s if c in "0123456789"]
    if kind == 1:
        return all(int(p) <= 255 for p in s.split("."))
    if kind == 2:
        doubled = [x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(reversed(d))]
        return 14 <= len(d) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 10 <= len(d) <= 15


def plain_spans(text):
    return sorted((m.start(), k + 1, m.end()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if fits(k, m[0]))


def test_patterns_equal_plain_ones():
    rng = random.Random(4)
    pieces = ["a.b@c.de", "@", "x@y", "1.2.3.4", "256.1.1.1", "0001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
              "+1 (499) 555-6503", "+", "+44.20", " ", ".", "-", "é", "９", "5", "007", "_", "@b-.c", "%", "\n", "3782 822463 10005"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + "(" * 300_000,
                                  "1 " * 150_000, "=" * 300_000 + "1", "a.b@" + "c" * 300_000])
def test_long_runs_take_linear_time(text):
    began = time.time()
    pii.added_spans([text], [pii.base_spans(text)], skip_chain.Model())
    assert time.time() - began < 60


def small_graph(edges, kinds, given, seed=0):
    rng, n = np.random.default_rng(seed), len(given)
    code = np.stack([rng.integers(0, g, n) for g in skip_chain.GROUPS], 1).astype(np.uint8)
    return skip_chain.Graph(np.zeros(n, np.int64), np.arange(n), np.arange(n), np.array(given), code,
                            np.array(edges).reshape(-1, 2), np.array(kinds, np.int64))


def random_model(seed=1, size=1.0):
    rng = np.random.default_rng(seed)
    m = skip_chain.Model()
    for w in m.weights():
        w += rng.normal(0, size, w.shape)
    return m


def enumerated(m, g, given):
    """Exact marginals and log of the total weight by trying every labelling."""
    n, total = len(given), 0.0
    node = np.zeros((n, skip_chain.N_LABELS))
    for y in itertools.product(range(skip_chain.N_LABELS), repeat=n):
        if any(a >= 0 and a != b for a, b in zip(given, y)):
            continue
        s = sum(w[g.code[i, k], y[i]] for i in range(n) if given[i] < 0 for k, w in enumerate(m.unary))
        s += sum(m.pair[t, y[i], y[j]] for (i, j), t in zip(g.edge, g.kind))
        total += np.exp(s)
        for i in range(n):
            node[i, y[i]] += np.exp(s)
    return node / total, np.log(total)


def test_messages_are_exact_on_trees_and_near_on_loops():
    tree = small_graph([(0, 1), (1, 2), (1, 3), (3, 4)], [0, 1, 2, 0], [-1, -1, 3, -1, -1])
    m = random_model()
    got, _ = skip_chain.beliefs(m, tree, tree.given, 60)
    assert np.allclose(got, enumerated(m, tree, tree.given)[0], atol=1e-8)
    loop = small_graph([(0, 1), (1, 2), (0, 2), (2, 3)], [0, 0, 1, 1], [-1, -1, -1, 2])
    m = random_model(size=0.4)
    got, _ = skip_chain.beliefs(m, loop, loop.given, 60)
    assert np.abs(got - enumerated(m, loop, loop.given)[0]).max() < 0.05


def test_gradient_is_the_slope_of_the_likelihood():
    g = small_graph([(0, 1), (1, 2), (1, 3)], [0, 0, 0], [-1, -1, 3, -1])
    seen, m = np.array([1, -1, 3, 0]), random_model(5)

    def log_likelihood():
        return enumerated(m, g, seen)[1] - enumerated(m, g, g.given)[1] + sum(
            w[g.code[i, k], seen[i]] for i in (0, 3) for k, w in enumerate(m.unary))  # left out where a label is fixed

    both = [skip_chain._expected(g, *skip_chain.beliefs(m, g, x, 60)) for x in (seen, g.given)]
    for w, s, f in zip(m.weights(), *both):
        for at in list(np.ndindex(w.shape))[::7]:
            w[at] += 1e-5
            up = log_likelihood()
            w[at] -= 2e-5
            down = log_likelihood()
            w[at] += 1e-5
            assert abs((up - down) / 2e-5 - (s - f)[at]) < 1e-5


@pytest.fixture(scope="module")
def entity_texts():
    import duckdb

    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.1/documents.parquet' where text is not null "
                                      "order by md5(text)").fetchall()]
    return [t for t in texts if pii.base_spans(t)]


@pytest.fixture(scope="module")
def model(entity_texts):
    return skip_chain.train(*pii.lessons(entity_texts[:200]))


def test_held_out_mentions(model, entity_texts):
    """Most damaged mentions of a document's own entities are found, strangers are left alone."""
    g, seen = pii.lessons(entity_texts[200:])
    belief, _ = skip_chain.beliefs(model, g, g.given)
    label = np.where(belief.max(1) >= pii.LEAST_BELIEF, belief.argmax(1), 0)
    own, strange = seen > 0, seen == 0
    assert own.sum() > 80 and strange.sum() > 80
    assert (label[own] == seen[own]).mean() > 0.85
    assert (label[strange] > 0).mean() < 0.02


def test_far_mentions_follow_the_full_one(model):
    full = "Write to jane.roe77@mail.example.org or +1 (499) 555-6503, card 4111 1111 1111 1111. " + "of the and " * 400
    part = "as said, jane.roe77[at]mail.example.org, 499-555-6503 and 4111-XXXX-XXXX-1111 hold"
    other = "as said, mary.poe31[at]post.example.org, 388-111-9218 and 5222-XXXX-XXXX-7773 hold"

    def added(text):
        return [(text[a:b], skip_chain.LABELS[k]) for a, k, b in pii.added_spans([text], [pii.base_spans(text)], model)[0]]

    assert added(full + part) == [("jane.roe77[at]mail.example.org", "email"), ("499-555-6503", "phone"),
                                  ("4111-XXXX-XXXX-1111", "card")]
    assert added(full + other) == added(other) == added(part) == []


def test_texts_do_not_depend_on_their_batch(model, entity_texts):
    some = entity_texts[200:260] + ["", "no digits", "7 7 7"]
    some = [t + " " + " ".join(t[a:b].split("@")[0] for a, k, b in pii.base_spans(t)[:1]) for t in some]
    base = [pii.base_spans(t) for t in some]
    assert pii.added_spans(some, base, model) == [pii.added_spans([t], [b], model)[0] for t, b in zip(some, base)]


def test_query_equals_plain_base(spark):
    got = {r.doc_id: r for r in pii.op11_pii(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        base, r = plain_spans(d.text or ""), got[d.doc_id]
        said = ",".join(f"{skip_chain.LABELS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in base) for x in (1, 2, 3, 4)]
        spans = r.spans.split(",") if r.spans else []
        assert set(said.split(",") if said else []) <= set(spans) and len(spans) == len(base) + r.n_added
    assert sum(r.n_email > 0 for r in got.values()) > 5


def test_odd_tables(spark, model):
    out = pii.find_personal_data(odd_docs(spark), model).collect()
    assert len(out) == odd_docs(spark).count() and all(r.spans == "" and r.n_added == 0 for r in out)
    assert pii.find_personal_data(no_docs(spark)).collect() == []  # nothing to fit on either
    df = spark.createDataFrame([("a b.c@d.ef g", "x"), (None, "y"), ("", "z")], "text string, spans string")
    assert [r.t for r in df.select(pii.redact(df.text, model).alias("t")).collect()] == ["a [email] g", None, ""]
