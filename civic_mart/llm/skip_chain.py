"""A skip-chain conditional random field over number-like tokens, with loopy message passing.

A document's nodes are its ``sites``: entities found by patterns (their label is given) and
the other tokens that hold a digit or an at-sign.  All other tokens cannot be personal data
here: their label is fixed, so they drop out of the graph.  Neighbouring sites share a chain
potential.  Distant sites that repeat or resemble each other share a skip potential, so what
is known of one mention decides the others.  Beliefs come from a fixed number of rounds of
damped sum-product messages, for the graphs of many documents at once.
"""

from __future__ import annotations

import os.path
import re
import zlib
from array import array
from dataclasses import dataclass, field

import numpy as np

LABELS = ("other", "email", "ip", "card", "phone")
N_LABELS = len(LABELS)
CHAIN, SAME, PART, NEAR, LOOSE = range(5)  # edge types
N_TYPES = 5
ROUNDS = 20
DAMPING = 0.3

TRIM = "\"'`<>(){}[],;:!?.#*%$&|=~^/\\"
_AT = re.compile(r"@|\[at\]|\(at\)")
_SITE = re.compile(r"[0-9@]\S*+")
_SIGNS = re.compile(r"[\W_]+")
_NUMBERS = re.compile(r"[0-9]+(?:[.\x20()-]+[0-9]+)*")
_MASKED = re.compile(r"([0-9]{4})[-.\x20xX*•0-9]*[xX*•][-.\x20xX*•]*([0-9]{4})")
_HEX = re.compile(r"[0-9a-f]{16,}")
# words that introduce an entity (fixed values: mail, phone, card, network)
_CUES = re.compile(r"(e-?mail|correo|courriel)|(phone|tel|call|mobile|fax|llame)|(card|visa|karte|carte|tarjeta|iban)"
                   r"|(\bip\b|host|server|addr)", re.IGNORECASE)
_SIZES = (0, 1, 3, 5, 7, 10, 12, 14, 20)   # lower ends of digit counts
_LENGTHS = (0, 3, 5, 8, 11, 15, 20, 32)    # and of lengths
#: number of codes of each feature
GROUPS = (4, len(_SIZES), 5, 4, 8, 4, len(_LENGTHS), 2, 5, 4)


def _bucket(ends: tuple[int, ...], n: int) -> int:
    return sum(n >= x for x in ends) - 1


def luhn(digits: str) -> bool:
    """Whether the check digit of a number fits."""
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def codes(v: str, lead: str, before: str, joined: int) -> tuple[int, ...]:
    """A site's features: the token, the sign before it, the text before it, adjacent sites."""
    digits = sum(c in "0123456789" for c in v)
    parts = _AT.split(v)
    at = 0
    if len(parts) > 1:
        at = 3 if len(parts) > 2 or not parts[0] or not parts[1] else 2 if "." in parts[1] else 1
    letters = any(c.isalpha() for c in v)
    low = v.lower()
    if v.isdigit():
        form = 1
    elif _MASKED.fullmatch(v):
        form = 4
    elif not letters and (numbers := v.split("."))[1:] and all(n.isdigit() and len(n) < 4 for n in numbers):
        form = 2
    elif _NUMBERS.fullmatch(v.lstrip("+(")):
        form = 3
    elif _HEX.fullmatch(low):
        form = 6
    elif letters and "." in v:
        form = 5
    else:
        form = 7 if letters else 0
    only = "".join(c for c in v if c in "0123456789")
    cue = 0
    for m in _CUES.finditer(before):
        cue = m.lastindex
    return (at, _bucket(_SIZES, digits), min(v.count("."), 4), min(v.count("-"), 3), form,
            1 if lead == "+" or v[0] == "+" else 2 if lead == "(" else 3 if lead in "\"'" and lead else 0,
            _bucket(_LENGTHS, len(v)), int(14 <= len(only) <= 19 and luhn(only)), cue, joined)


def plain(v: str) -> str:
    return _SIGNS.sub("", v.lower())


def keys_of(v: str) -> list[str]:
    """What sites must share one of to be compared: whole, user part, number ends, masked ends, groups."""
    said = plain(v)
    out = [f"w{said}"] if len(said) >= 4 else []
    user = _AT.split(v.lower())[0]
    if any(c.isalpha() for c in user) and len(u := plain(user)) >= 5:
        out.append(f"u{u}")
    digits = "".join(c for c in v if c in "0123456789")
    if len(digits) >= 7:
        out.append(f"d{digits[-7:]}")
    if len(digits) >= 10:
        out += [f"p{digits[:8]}", f"q{digits[-8:]}"]
    if m := _MASKED.fullmatch(v):
        out.append(f"m{m[1]}{m[2]}")
    elif 14 <= len(digits) <= 19:
        out.append(f"m{digits[:4]}{digits[-4:]}")
    groups = [g for g in re.split(r"[^0-9]+", v) if g]
    if len(groups) >= 3 and all(len(g) <= 3 for g in groups[:3]):
        out.append("i" + ".".join(groups[:3]))
    return out


def likeness(a: str, b: str) -> int:
    """Edge type of two tokens (0: too unlike for a skip edge)."""
    a, b = plain(a), plain(b)
    if a == b:
        return SAME
    short, long = sorted((a, b), key=len)
    if len(short) >= 5 and (long.startswith(short) or long.endswith(short)):
        return PART
    head = len(os.path.commonprefix((a, b)))
    tail = len(os.path.commonprefix((a[head:][::-1], b[head:][::-1])))
    share = (head + tail) / max(1, len(long))
    return NEAR if share >= 0.75 else LOOSE if share >= 0.5 else 0


@dataclass
class Graph:
    """Sites and edges of the documents of a batch."""

    doc: np.ndarray      # document of each site
    start: np.ndarray
    end: np.ndarray
    given: np.ndarray    # label of each site, -1 where it is to be found
    code: np.ndarray     # (sites, features)
    edge: np.ndarray     # (edges, 2), lower site first
    kind: np.ndarray     # type of each edge


@dataclass
class Model:
    unary: list[np.ndarray] = field(default_factory=lambda: [np.zeros((n, N_LABELS)) for n in GROUPS])
    pair: np.ndarray = field(default_factory=lambda: np.zeros((N_TYPES, N_LABELS, N_LABELS)))

    def weights(self) -> list[np.ndarray]:
        return [*self.unary, self.pair]


def tokens(text: str) -> list[tuple[int, int]]:
    """(start, end) of every token with a digit or at-sign, without signs at its ends.  Linear."""
    out, at = [], 0
    for m in _SITE.finditer(text):
        head = text[at:m.start()]
        at = m.end()
        a = m.start() - (len(head.rsplit(None, 1)[-1]) if head and not head[-1].isspace() else 0)
        body = text[a:at]
        left = body.lstrip(TRIM)
        out.append((a + len(body) - len(left), a + len(body) - len(left) + len(left.rstrip(TRIM))))
    return out


def sites(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label or -1) in text order: the found entities (start, label, end) and the
    tokens that touch none.  Entities that overlap an earlier one are left to it."""
    out, last = [], 0
    entities = []
    for a, label, b in sorted(found):
        if a >= last:
            entities.append((a, b, label))
            last = b
    i = 0
    for a, b in tokens(text):
        while i < len(entities) and entities[i][1] <= a:
            out.append(entities[i])
            i += 1
        if a < b and (i == len(entities) or entities[i][0] >= b):
            out.append((a, b, -1))
    return out + entities[i:]


def build(texts: list[str], found: list[list[tuple[int, int, int]]]) -> Graph:
    """The graph of a batch.  Sites that share a key are linked in a row, and each open site
    with the nearest given ones before and after it: linear in the sites, not all pairs."""
    doc, start, end, given = array("q"), array("q"), array("q"), array("b")
    code = bytearray()
    chain, key, of = array("q"), array("q"), array("q")
    for d, (text, spans) in enumerate(zip(texts, found)):
        places = sites(text, spans)
        if all(p[2] >= 0 for p in places):
            continue  # nothing to be found
        gaps = [len(g := text[a[1]:b[0]]) <= 4 and "\n" not in g and not any(map(str.isalnum, g))
                for a, b in zip(places, places[1:])]
        for k, (a, b, label) in enumerate(places):
            v, node = text[a:b], len(doc)
            before, after = bool(k and gaps[k - 1]), k < len(gaps) and gaps[k]
            if after:
                chain.append(node)
            doc.append(d), start.append(a), end.append(b), given.append(label)
            code += bytes(codes(v, text[a - 1:a], text[max(0, a - 24):a], before + 2 * after))
            for said in keys_of(v):
                key.append(d << 32 | zlib.crc32(said.encode("utf-8")))
                of.append(node)
    given_ = np.array(given, np.int64)
    pairs = _pairs(np.array(key, np.int64), np.array(of, np.int64), given_)
    kinds = np.fromiter((likeness(texts[doc[i]][start[i]:end[i]], texts[doc[j]][start[j]:end[j]]) for i, j in pairs),
                        np.int64, len(pairs))
    first = np.array(chain, np.int64)
    return Graph(np.array(doc, np.int64), np.array(start, np.int64), np.array(end, np.int64), given_,
                 np.frombuffer(bytes(code), np.uint8).reshape(len(doc), len(GROUPS)),
                 np.concatenate([np.stack([first, first + 1], 1), pairs[kinds > 0]]),
                 np.concatenate([np.full(len(first), CHAIN), kinds[kinds > 0]]))


def _pairs(key: np.ndarray, node: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Distinct (lower, upper) sites to compare; pairs of given sites are left out."""
    if not len(key):
        return np.empty((0, 2), np.int64)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    at = np.arange(len(key))
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(new)
    known = given[node] >= 0
    before = np.maximum.accumulate(np.where(known, at, -1))
    after = np.minimum.accumulate(np.where(known, at, len(key))[::-1])[::-1]
    rows = [np.stack([at[:-1], at[1:]], 1)]
    for other in (before, after):
        ok = ~known & (other >= 0) & (other < len(key))
        rows.append(np.stack([other[ok], at[ok]], 1))
    both = np.concatenate(rows)
    both = both[group[both[:, 0]] == group[both[:, 1]]]
    both = np.sort(node[both], 1)
    both = both[(both[:, 0] != both[:, 1]) & ((given[both] < 0).any(1))]
    return np.unique(both, axis=0)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def beliefs(model: Model, g: Graph, given: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(label probabilities of the sites, of the edges' label pairs) with ``given`` labels fixed."""
    n, e = len(g.doc), len(g.edge)
    score = sum((w[g.code[:, k]] for k, w in enumerate(model.unary)), np.zeros((n, N_LABELS)))
    fixed = given >= 0
    score[fixed] = -40.0
    score[fixed, given[fixed]] = 0.0
    pair = np.concatenate([model.pair[g.kind], model.pair[g.kind].transpose(0, 2, 1)])
    src, dst = np.concatenate([g.edge[:, 0], g.edge[:, 1]]), np.concatenate([g.edge[:, 1], g.edge[:, 0]])
    back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
    said = np.zeros((2 * e, N_LABELS))

    def total() -> np.ndarray:
        return score + np.stack([np.bincount(dst, said[:, k], n) for k in range(N_LABELS)], 1)

    for _ in range(rounds if e else 0):
        held = total()[src] - said[back]
        new = _log_sum(held[:, :, None] + pair, 1)
        new -= _log_sum(new, 1)[:, None]
        said = DAMPING * said + (1 - DAMPING) * new
    all_ = total()
    node = np.exp(all_ - _log_sum(all_, 1)[:, None])
    joint = (all_[g.edge[:, 0]] - said[e:])[:, :, None] + (all_[g.edge[:, 1]] - said[:e])[:, None, :] + pair[:e]
    joint -= _log_sum(joint.reshape(e, -1), 1)[:, None, None] if e else 0
    return node, np.exp(joint)


def _expected(g: Graph, node: np.ndarray, joint: np.ndarray) -> list[np.ndarray]:
    out = [np.zeros((n, N_LABELS)) for n in GROUPS]
    for k, x in enumerate(out):
        np.add.at(x, g.code[:, k], node)
    pair = np.zeros((N_TYPES, N_LABELS, N_LABELS))
    np.add.at(pair, g.kind, joint)
    pair[SAME:] = (pair[SAME:] + pair[SAME:].transpose(0, 2, 1)) / 2  # skip potentials know no direction
    return [*out, pair]


def train(g: Graph, observed: np.ndarray, steps: int = 120, rate: float = 0.15, decay: float = 0.01) -> Model:
    """Weights that make ``observed`` labels (-1: unknown) likely, given the found entities.

    The gradient is the difference of expected features with and without the observed labels
    fixed, both from loopy messages; steps by Adam."""
    model = Model()
    open_ = (observed >= 0) & (g.given < 0)
    if not open_.any():
        return model
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    for t in range(1, steps + 1):
        seen = _expected(g, *beliefs(model, g, np.where(open_, observed, g.given), 8))
        free = _expected(g, *beliefs(model, g, g.given, 8))
        for w, s, f, m1, m2 in zip(model.weights(), seen, free, first, second):
            grad = (f - s) / open_.sum() + decay / 10 * w
            m1 += 0.1 * (grad - m1)
            m2 += 0.01 * (grad * grad - m2)
            w -= rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.99 ** t)) + 1e-6)
    return model
