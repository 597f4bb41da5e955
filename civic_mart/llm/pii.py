"""Personal data: patterns, and a skip-chain conditional random field that adds mentions.

Patterns find e-mail and IP addresses, card and phone numbers.  A text that names one of
them in full often repeats it in part or disguised (``name[at]host``, a masked card, a phone
number without its country sign); such tokens are no evidence by themselves.  The field
(skip_chain.py) labels them together: repeated or similar tokens of a document share
potentials, and messages carry the label of the full mention to the others.

The field is fitted on a bounded sample of documents.  Their own entities are given; damaged
copies of them, and damaged copies of entities that the document does not hold, are added to
the text with the labels that the field is to learn.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm import skip_chain
from civic_mart.llm.common import table, text_of
from civic_mart.llm.pieces import batches_of

KINDS = skip_chain.LABELS[1:]
EMAIL, IP, CARD, PHONE = 1, 2, 3, 4
LEAST_BELIEF = 0.75
SAMPLE_ROWS = 600          # documents that the field is fitted on: half of them with an entity
SAMPLE_BYTES = 8_000_000   # and fewer if they hold so many code points

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_ENTITY = r"@[A-Za-z0-9-]+\.|\+[0-9][ ().0-9-]{8}|([0-9]+\.){3}[0-9]|([0-9][ -]?){14}"  # for the sample only


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, label, end) of the patterns' matches, by start and then kind.

    Each pattern runs in linear time: an address is found from its at-sign, and no match
    begins inside a run of digits that has been tried."""
    if not _ANY.search(text):
        return []
    found, last = [], 0
    at = text.find("@")
    while at >= 0:
        head = text[last:at]
        user = len(head) - len(head.rstrip(LOCAL))
        m = _DOMAIN.match(text, at + 1) if user else None
        if m:
            found.append((at - user, EMAIL, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and skip_chain.luhn(d):
            found.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append((m.start(), PHONE, m.end()))
    return sorted(found)


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], model: skip_chain.Model) -> list[list[tuple[int, int, int]]]:
    """(start, label, end) of the sites that the field labels, for each text.  Adjacent sites of
    one number are one span."""
    g = skip_chain.build(texts, base)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(g.doc):
        return out
    belief, _ = skip_chain.beliefs(model, g, g.given)
    label = np.where((g.given < 0) & (belief.max(1) >= LEAST_BELIEF), belief.argmax(1), 0)
    beside = {int(i) for (i, j), k in zip(g.edge, g.kind) if k == skip_chain.CHAIN}
    before = -1
    for i in np.flatnonzero(label).tolist():
        spans, k = out[g.doc[i]], int(label[i])
        if before == i - 1 and before in beside and label[before] == k and k in (CARD, PHONE):
            spans[-1] = (spans[-1][0], k, int(g.end[i]))
        else:
            spans.append((int(g.start[i]), k, int(g.end[i])))
        before = i
    return out


def _damaged(kind: int, v: str, rng: random.Random) -> str:
    """A partial or disguised mention of an entity."""
    d = _digits(v)
    if kind == EMAIL:
        user, host = v.split("@", 1)
        return rng.choice([f"{user}@{host.split('.')[0]}", f"{user}[at]{host}", f"{user}(at){host}", user])
    if kind == IP:
        parts = v.split(".")
        return rng.choice([".".join(parts[:3]), "-".join(parts), ".".join([*parts[:3], "*"])])
    if kind == CARD:
        at = rng.randrange(5, len(d) - 4)
        wrong = d[:at] + str((int(d[at]) + rng.randrange(1, 10)) % 10) + d[at + 1:]
        return rng.choice([f"{d[:4]}-XXXX-XXXX-{d[-4:]}", f"{d[:4]}********{d[-4:]}", wrong, ".".join(
            d[i:i + 4] for i in range(0, len(d), 4))])
    own = d[-10:]
    return rng.choice([own, f"{own[:3]}.{own[3:6]}.{own[6:]}", f"{own[:3]}-{own[3:6]}-{own[6:]}", f"{own[3:6]}-{own[6:]}",
                       f"({own[:3]}) {own[3:6]}-{own[6:]}"])


def _stranger(v: str, rng: random.Random) -> str:
    """A token of the same form with other digits and letters."""
    return "".join(part if part in ("[at]", "(at)") else "".join(
        rng.choice("0123456789") if c.isdigit() else rng.choice("abcdefghijklmnoprstuvwxyz")
        if c.isalpha() and c not in "xX" else c for c in part) for part in re.split(r"(\[at\]|\(at\))", v))


def lessons(texts: list[str]) -> tuple[skip_chain.Graph, np.ndarray]:
    """(graph, observed labels) of a sample: a text with damaged mentions added, of its own
    entities (to be labelled) and of strangers (to be left alone).  Sites of the text that are
    linked to another have no observed label, the others are to be left alone."""
    said, spans, marks = [], [], []
    for text in texts:
        rng = random.Random(hashlib.md5(text.encode("utf-8")).digest())
        base, words = base_spans(text), text[:4000].split() or ["-"]
        known = dict.fromkeys((k, text[a:b]) for a, k, b in base)
        some = rng.sample(sorted(known), min(3, len(known)))
        adds = [(v, k) for k, v in ((k, _damaged(k, v, rng)) for k, v in some)]
        adds += [(_stranger(_damaged(k, v, rng), rng), 0) for k, v in some]
        own = []
        for v, label in rng.sample(adds, len(adds)):
            text += "\n" + " ".join(rng.choice(words) for _ in range(rng.randrange(2, 6))) + " "
            if not base_spans(v):
                own.append((len(text), label, len(text) + len(v)))
            text += v + " " + rng.choice(words)
        said.append(text), spans.append(base_spans(text)), marks.append(own)
    g = skip_chain.build(said, spans)
    linked = np.zeros(len(g.doc), bool)
    linked[g.edge[g.kind != skip_chain.CHAIN].ravel()] = True
    observed = np.where(linked, -1, 0)
    first = np.searchsorted(g.doc, np.arange(len(said) + 1))
    for d, own in enumerate(marks):
        at = np.arange(first[d], first[d + 1])
        for a, label, b in own:
            observed[at[(g.start[at] >= a) & (g.end[at] <= b)]] = label
    return g, np.where(g.given >= 0, -1, observed)


def fit(docs: DataFrame) -> skip_chain.Model:
    """The field's weights from a sample of ``docs(text)``, the same on every run.

    The driver sees at most ``SAMPLE_ROWS`` texts of ``SAMPLE_BYTES`` together, chosen by the
    hash of the text.  Without entities the field adds nothing."""
    sized = docs.where(F.col("text").rlike("[0-9@]")).select(
        F.xxhash64("text").alias("h"), F.length("text").alias("n"), F.col("text").rlike(_ENTITY).alias("has")).where(
        F.col("n") <= SAMPLE_BYTES // 8)
    chosen, held = [], 0
    for has in (True, False):
        for h, n in sized.where(F.col("has") == has).select("h", "n").distinct().orderBy("h").limit(SAMPLE_ROWS // 2).collect():
            if held + n <= SAMPLE_BYTES:
                chosen.append(h)
                held += n
    if not chosen:
        return skip_chain.Model()
    rows = docs.where(F.xxhash64("text").isin(chosen)).select("text").distinct().collect()
    return skip_chain.train(*lessons(sorted(r["text"] for r in rows)))


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{skip_chain.LABELS[k]}:{a}:{b}" for a, k, b in spans)


def _spans(texts: list[str], model: skip_chain.Model) -> Iterator[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    for a, b in batches_of(texts, 500_000):
        base = [base_spans(t) for t in texts[a:b]]
        yield from zip(base, added_spans(texts[a:b], base, model))


def scan(text: Column, model: skip_chain.Model) -> Column:
    """Struct (n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of a text column."""
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in columns:
            yield pd.DataFrame(
                [(*(sum(s[1] == k + 1 for s in base) for k in range(len(KINDS))),
                  hashlib.sha256(_said(base).encode()).hexdigest(), _said(sorted(base + more)), len(more))
                 for base, more in _spans([text_of(t) for t in column], model)], columns=names)

    return run(text)


def redact(text: Column, model: skip_chain.Model) -> Column:
    """The text with every mention replaced by its kind in brackets (null stays null)."""

    def cut(t: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for a, k, b in spans:
            if a >= at:
                out += [t[at:a], f"[{skip_chain.LABELS[k]}]"]
            at = max(at, b)
        return "".join([*out, t[at:]])

    @F.pandas_udf("string")
    def run(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in columns:
            spans = _spans([text_of(t) for t in column], model)
            yield pd.Series([cut(t, sorted(base + more)) if isinstance(t, str) else None
                             for t, (base, more) in zip(column, spans)], dtype=object)

    return run(text)


def find_personal_data(docs: DataFrame, model: skip_chain.Model | None = None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` for each row of
    ``docs(doc_id, text)``; ``n_added`` counts the spans that the field adds to the patterns'.

    Null and empty texts have no spans.  Repeated rows and null ids give rows of their own; an
    empty table an empty result; other columns are ignored.  A text's spans do not depend on
    the texts beside it."""
    model = model or fit(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scan(F.col("text"), model).alias("s")).select("doc_id", "s.*")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
