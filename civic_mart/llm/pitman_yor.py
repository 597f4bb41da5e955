"""LM scoring: a hierarchical Pitman-Yor model over word tokens.

Every token sits in the restaurant of its context, the word before it (a text's first word has a
context of its own).  Contexts of one class (a hash of the context's last letters) share a parent, the
class restaurants share the restaurant without context, and its base is uniform over the known
tokens and one unknown.  A restaurant's tables are its parent's customers.

Seating starts with a forward draw and is then sampled by Gibbs: in every sweep each dish of each
restaurant gets its number of tables anew, given all others (``reseat``).  A word's customers, in all
its contexts, in the classes and in the root, are seated where the word's counts are; what couples
words is how many tables a restaurant has in all.  Words are therefore dealt by hash to buckets, each
sweep seats a bucket's words given the table totals of all restaurants, and a round of sweeps ends
with the exact totals of all buckets: numbers per class go to the driver, numbers per context word
are summed in the bucket that owns the word and sent back to the buckets that hold the context.  The
last round keeps several seatings, each with the totals that belong to it.  The predictive takes the
mean tables of every context and the mean of its class's probabilities, so it sums to one in
every context.

Texts are read in chunks of about a million tokens.  A chunk sends its distinct pairs of a word and
the one before once, as arrays per bucket, with how often it learns from each (not at all from held-out
texts), so a word that makes up a third of the corpus is one entry a chunk and context.  The bucket
keeps where each of them lies among its own, about a byte and a half a pair, and with the tables
seated answers one number for each: neither pairs nor the model travel again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm.common import crc_mod, discard, materialize, table, text_of, worker_cache

CLASSES = 64           # context classes; the last one is the start of a text
CHUNK_TOKENS = 1 << 20
BURN_IN, SAMPLES = 3, 3
THETA_WORD, THETA_CONTEXT, THETA_ROOT = 5.0, 50.0, 100.0
DRAWN, EXACT = 64, 1024  # customers up to which a dish's tables are drawn at once; up to which Stirling numbers are tabled
DIRECT = 8             # customers up to which a dish's weights are multiplied out
MOVES = 32             # customers of a larger dish that are taken out and reseated in a sweep
MIN_BUCKETS, BUCKET_BYTES = 32, 64 << 20
KEY_BITS = np.uint64((1 << 48) - 1)
START = 0              # the key of the context before a text's first word
END = b""              # the end token (no word is empty)


def tokens_of(text: str) -> list[bytes]:
    return [*text.encode("utf-8").lower().split(), END]  # bytes.lower changes A-Z only


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % (CLASSES - 1)


def context_key(word: np.ndarray) -> np.ndarray:
    """A context's key: 48 bits of the word's, so that a corpus's pairs take six bytes each."""
    return word & KEY_BITS


def pair_key(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """One 48-bit key for a word and the context it stands in."""
    return (word * np.uint64(0x9E3779B97F4A7C15) + context) & KEY_BITS


def pack(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys, "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8")[:, 0].astype(np.uint64)


def shrink(values: np.ndarray) -> bytes:
    """Numbers that are mostly small or alike: byte by byte of all of them, deflated."""
    return zlib.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def grow(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T.copy().view(kind)[:, 0]


def pack_places(places: np.ndarray) -> bytes:
    """Places in a list, -1 for none, as the steps between them."""
    steps = np.diff(places[places >= 0], prepend=0)
    out = np.zeros(len(places), np.uint32)
    out[places >= 0] = np.where(steps < 0, -2 * steps, 2 * steps + 1)
    return shrink(out)


def unpack_places(data: bytes) -> np.ndarray:
    code = grow(data, np.uint32).astype(np.int64)
    out, steps = np.full(len(code), -1), code[code > 0]
    out[code > 0] = np.cumsum(np.where(steps % 2, steps // 2, -(steps // 2)))
    return out


def triples(tokens: np.ndarray, sizes: np.ndarray, word_class: np.ndarray):
    """Distinct (word, class of the word before, word before) of a chunk's tokens, in that order.

    Returns (word and class of each (word, class) pair, pair of each triple, context of each triple,
    triple of each token); the context before a text's first word is ``len(word_class)``."""
    n = len(word_class)
    before = np.empty_like(tokens)
    if len(tokens):
        before[1:] = tokens[:-1]
        before[np.cumsum(sizes) - sizes] = n
    cls = np.append(word_class, CLASSES - 1).astype(np.int64)[before]
    code, token_triple = np.unique((tokens * CLASSES + cls) * (n + 1) + before, return_inverse=True)
    pair = code // (n + 1)
    first = np.ones(len(pair), bool)
    first[1:] = pair[1:] != pair[:-1]
    return pair[first] // CLASSES, pair[first] % CLASSES, np.cumsum(first) - 1, code % (n + 1), token_triple


class Chunk:
    """Tokens of some texts as indices into the chunk's distinct words, ordered by bucket and word key,
    so that a bucket's share of words, pairs and triples is one slice each."""

    def __init__(self, texts: list[str], held: np.ndarray, buckets: int) -> None:
        words = [tokens_of(t) for t in texts]
        self.sizes = np.array([len(w) for w in words], np.int64)
        coded = pa.array(list(chain.from_iterable(words)), pa.large_binary()).dictionary_encode()
        tok, vocab = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
        keys = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocab), np.uint64, len(vocab))
        bucket = (context_key(keys) % np.uint64(buckets)).astype(np.int64)  # which also owns the word as a context
        order = np.lexsort((keys, bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.word_bucket = keys[order], bucket[order]
        self.word_class = np.fromiter(map(word_class, vocab), np.uint8, len(vocab))[order]
        self.tokens, self.held = place[tok], held

    def by_bucket(self, counts: bool = True) -> Iterator[dict]:
        """A row for each bucket that has pairs; ``counts``: with the tokens of each that are learned from."""
        word, cls, pair, before, token_triple = triples(self.tokens, self.sizes, self.word_class)
        context = np.append(context_key(self.words), np.uint64(START))[before]
        learns = np.repeat(~self.held, self.sizes)
        n = np.bincount(token_triple[learns], minlength=len(pair))
        pair_n = np.bincount(pair, n, len(word)).astype(np.int64)
        pair_contexts = np.bincount(pair, minlength=len(word))
        bucket = self.word_bucket[word]
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(word) else [0]
        for a, b in zip(edges, edges[1:]):
            own, pairs = np.unique(word[a:b], return_counts=True)
            x, y = np.searchsorted(pair, [a, b])
            row = {"bucket": int(bucket[a]), "words": self.words[own].tobytes(),
                   "pairs": pairs.astype(np.uint8).tobytes(), "classes": cls[a:b].astype(np.uint8).tobytes(),
                   "contexts": pack(context[x:y]), "pair_contexts": pair_contexts[a:b].astype(np.uint32).tobytes()}
            if counts:
                row |= {"counts": pair_n[a:b].astype(np.uint32).tobytes(), "context_counts": n[x:y].astype(np.uint32).tobytes()}
            yield row


def chunks(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[tuple[str, Chunk, pd.DataFrame]]:
    """(name, chunk, its rows) of a partition; the same on every reading of a stored table."""
    part, n = TaskContext.get().partitionId(), 0
    held_back: list[pd.DataFrame] = []

    def made() -> tuple[str, Chunk, pd.DataFrame]:
        rows = pd.concat(held_back, ignore_index=True)
        chunk = Chunk([text_of(t) for t in rows["text"]], rows["held_out"].to_numpy(bool), buckets)
        return f"{part}-{n}-{zlib.crc32(chunk.tokens.tobytes()):08x}", chunk, rows  # other texts, other name

    chars = 0
    for pdf in batches:
        size = pdf["text"].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy()
        start = 0
        for i, s in enumerate(size):
            chars += s
            if chars >= 6 * CHUNK_TOKENS:  # about six characters a token
                held_back.append(pdf.iloc[start:i + 1])
                yield made()
                held_back, chars, start, n = [], 0, i + 1, n + 1
        if start < len(pdf):
            held_back.append(pdf.iloc[start:])
    if held_back:
        yield made()


def _unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word keys, word of each pair, class of each pair) of a bucket row."""
    words = np.frombuffer(row.words, np.uint64)
    return (words, np.repeat(np.arange(len(words)), np.frombuffer(row.pairs, np.uint8)),
            np.frombuffer(row.classes, np.uint8).astype(np.int64))


# ---------------------------------------------------------------- counts

_ASKED = ("chunks array<string>, asked_words array<binary>, asked_pairs array<binary>, asked_classes array<binary>, "
          "asked_contexts array<binary>")  # of each chunk: its words, classes per word, classes, contexts
_MODEL = (f"bucket int, words binary, totals binary, pair_word binary, classes binary, counts binary, {_ASKED}, "
          "contexts binary, pair_contexts binary, context_counts binary, class_tokens array<long>, "
          "class_pairs array<long>, class_contexts array<long>, context_ones long, context_twos long, "
          "ones long, twos long, root_ones long, root_twos long")


def _merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """All of a bucket's counts in one row: sorted words, their (word, class) pairs in word order, and
    the contexts of each pair, all as far as they are learned, and where each chunk's own lie among
    them.  Without contexts the classes seat the tokens themselves."""
    parts = [(*_unpack(r), np.frombuffer(r.counts, np.uint32).astype(np.int64)) for r in pdf.itertuples()]
    sizes = [len(p[0]) for p in parts]
    words, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    shift = np.cumsum([0, *sizes])
    pair, inverse = np.unique(np.concatenate([place[p[1] + s] * CLASSES + p[2] for p, s in zip(parts, shift)]), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([p[3] for p in parts]), len(pair)).astype(np.int64)
    pair_word = pair // CLASSES
    totals = np.bincount(pair_word, counts, len(words)).astype(np.int64)
    learned, known = counts > 0, totals > 0
    pair_at, word_at = np.cumsum(learned) - 1, np.where(known, np.cumsum(known) - 1, -1)
    word, cls, counts = word_at[pair_word[learned]], pair[learned] % CLASSES, counts[learned]
    contexts, context_pair, context_counts = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    customers = counts  # that sit in a class
    asked: dict[str, list] = {c.split()[0]: [] for c in _ASKED.split(", ")}
    if "contexts" in pdf:
        of = np.repeat(inverse, np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["pair_contexts"]]))
        contexts = np.concatenate([unpack(x) for x in pdf["contexts"]])
        part = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["context_counts"]])
        # those learned come first, so that they name the pair of a key that others share
        order = np.argsort(part == 0, kind="stable")
        _, first, at = np.unique(pair_key(words[pair_word[of]], contexts)[order], return_index=True, return_inverse=True)
        every = np.empty(len(order), np.int64)
        every[order] = at
        first, n = order[first], np.bincount(every, part, len(first)).astype(np.int64)
        place_of = np.full(len(first), -1)
        kept = np.flatnonzero(n > 0)
        kept = kept[np.argsort(of[first[kept]], kind="stable")]
        place_of[kept] = np.arange(len(kept))
        contexts, context_pair, context_counts = contexts[first[kept]], pair_at[of[first[kept]]], n[kept]
        customers = np.bincount(context_pair, minlength=len(word))
        if "chunk" in pdf:
            ends = np.cumsum([len(x) // 6 for x in pdf["contexts"]])
            asked = {"chunks": pdf["chunk"].tolist(), "asked_words": [pack_places(word_at[place[e - n:e]]) for e, n in zip(shift[1:], sizes)],
                     "asked_pairs": [zlib.compress(x, 1) for x in pdf["pairs"]], "asked_classes": [zlib.compress(x, 1) for x in pdf["classes"]],
                     "asked_contexts": [pack_places(place_of[every[e - len(x) // 6:e]]) for e, x in zip(ends, pdf["contexts"])]}
    held_by = np.bincount(word, minlength=int(known.sum()))  # classes that hold the word
    return pd.DataFrame([{
        "bucket": key[0], "words": words[known].tobytes(), "totals": totals[known].tobytes(),
        "pair_word": word.astype(np.uint32).tobytes(), "classes": cls.astype(np.uint8).tobytes(),
        "counts": counts.tobytes(), **asked, "contexts": pack(contexts),
        "pair_contexts": np.bincount(context_pair, minlength=len(word)).astype(np.uint32).tobytes(),
        "context_counts": context_counts.astype(np.uint32).tobytes(),
        "class_tokens": np.bincount(cls, counts, CLASSES).astype(np.int64),
        "class_pairs": np.bincount(cls, minlength=CLASSES),
        "class_contexts": np.bincount(cls, customers, CLASSES).astype(np.int64),
        "context_ones": int((context_counts == 1).sum()), "context_twos": int((context_counts == 2).sum()),
        "ones": int((customers == 1).sum()), "twos": int((customers == 2).sum()),
        "root_ones": int((held_by == 1).sum()), "root_twos": int((held_by == 2).sum())}])


def _pairs_of(row) -> np.ndarray:
    """The (word, class) pair of each of a bucket's contexts."""
    sizes = np.frombuffer(row.pair_contexts, np.uint32)
    return np.repeat(np.arange(len(sizes)), sizes)


def _by_owner(contexts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's distinct contexts by the bucket that owns them: (contexts, edges of each owner's share,
    place of each given context among them)."""
    keys, at = np.unique(contexts, return_inverse=True)
    owner = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return keys[order], np.searchsorted(owner[order], np.arange(buckets + 1)), place[at]


_PARTS = "owner int, bucket int, contexts binary, tables binary"


def context_parts(bucket: int, contexts: np.ndarray, tables: np.ndarray, buckets: int) -> pd.DataFrame:
    """The tables of a bucket's words in the restaurants of their contexts, a row for each bucket that owns some."""
    keys, edges, at = _by_owner(contexts, buckets)
    tables = np.bincount(at, tables, len(keys)).astype(np.float32)
    return pd.DataFrame([(i, bucket, pack(keys[a:b]), tables[a:b].tobytes())
                         for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a],
                        columns=["owner", "bucket", "contexts", "tables"])


def _sum_parts(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, their tables, place of each row's contexts among them) of an owner's parts."""
    keys, at = np.unique(np.concatenate([unpack(x) for x in pdf["contexts"]]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([np.frombuffer(x, np.float32) for x in pdf["tables"]]), len(keys)), at


def _send_back(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The tables of an owner's contexts to every bucket that holds some of them, in that bucket's order."""
    _, tables, at = _sum_parts(pdf)
    ends = np.cumsum([len(x) // 6 for x in pdf["contexts"]])
    return pd.DataFrame([(int(key[0]), b, tables[at[e - len(c) // 6:e]].astype(np.float32).tobytes())
                         for b, c, e in zip(pdf["bucket"], pdf["contexts"], ends)], columns=["owner", "bucket", "tables"])


def _own(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    keys, tables, _ = _sum_parts(pdf)
    return pd.DataFrame([(int(key[0]), pack(keys), tables.tobytes())], columns=["bucket", "own_contexts", "own_tables"])


# ---------------------------------------------------------------- seating

def seat(counts: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that a dish's customers open, customer by customer, for many dishes at once.

    ``fresh`` is the weight of a new table: (strength + discount * the restaurant's tables)
    times the parent's probability of the dish.  The first customer always opens one.  From
    the 64th on customers are seated in blocks of an eighth of those that sit, with the
    odds at the block's start."""
    tables = np.minimum(counts, 1)
    active = np.flatnonzero(counts > 1)
    seated = 1
    while len(active):
        block = 1 if seated < 64 else seated // 8
        odds = fresh[active] / (fresh[active] + np.maximum(seated - discount * tables[active], 1e-9))
        n = np.minimum(block, counts[active] - seated)
        tables[active] += rng.binomial(n, odds)
        seated += block
        active = active[counts[active] > seated]
    return tables


def stirling(discount: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Generalised Stirling numbers S(c, t): the ways to seat c customers at t tables, each weighted by
    its tables' sizes.  Returns their logarithms up to ``EXACT`` customers, the probability that one
    of c customers at t tables sits alone, S(c - 1, t - 1) / S(c, t), and, for more customers, a
    curve of the latter by the saddle point of the generating function (within 0.6 % there)."""
    cache = worker_cache("lm-stirling")
    if discount not in cache:
        log_s = np.full((EXACT + 1, EXACT + 1), -np.inf)
        log_s[1, 1] = 0
        t = np.arange(EXACT + 1)
        for c in range(1, EXACT):
            log_s[c + 1, 1:] = np.logaddexp(log_s[c, :-1], log_s[c, 1:] + np.log(np.maximum(c - discount * t[1:], 1e-300)))
        alone = np.zeros_like(log_s)
        seen = np.tri(EXACT + 1, dtype=bool)[1:, 1:]
        alone[1:, 1:][seen] = np.exp(log_s[:-1, :-1][seen] - log_s[1:, 1:][seen])
        y = np.exp(np.linspace(-1e-9, -60, 50000))
        f = (1 - y**discount) / discount
        cache[discount] = log_s, alone, np.log((1 - y) * y**(discount - 1) / f), np.log((1 - y) / f)
    return cache[discount]


def sits_alone(counts: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """Probability that one of ``counts`` customers at ``tables`` tables sits alone."""
    _, alone, x, y = stirling(discount)
    t = np.maximum(tables - 1, 1)
    far = t / counts * np.exp(np.interp(np.log((counts - 1) / t), x, y))
    near = alone[np.minimum(counts, EXACT), np.minimum(tables, EXACT)]
    return np.where(tables < 2, counts < 2, np.where(counts <= EXACT, near, np.minimum(far, 1)))


def reseat(counts: np.ndarray, tables: np.ndarray, discount: float, strength: float, others: np.ndarray,
           weight: np.ndarray, mass: np.ndarray, rng: np.random.Generator, grows: int = 1) -> np.ndarray:
    """A Gibbs step: each dish's tables given all other dishes' and the parent's customers.

    A dish's j-th table (from 0) weighs (strength + discount * (others + j)) * (weight + j) / (mass + j): ``others``
    are the restaurant's tables of other dishes, ``weight`` / ``mass`` is the parent's probability
    of the dish without the customers that the dish's own tables are (``grows`` 0: it does not rise as
    they come back).  Up to ``DRAWN`` customers are taken out together and their number of tables is drawn from its
    exact conditional.  Of a larger dish ``MOVES`` customers are taken out one by one and reseated
    given the others."""
    log_s = stirling(discount)[0]
    tables = np.where(counts > DRAWN, tables, np.minimum(counts, 1))

    def rate(i, j):
        return (strength + discount * (others[i] + j)) * (weight[i] + grows * j) / (mass[i] + grows * j)

    drawn = np.flatnonzero((counts > 1) & (counts <= DRAWN))
    drawn = drawn[np.argsort(counts[drawn], kind="stable")]
    edges = np.searchsorted(counts[drawn], np.arange(2, DRAWN + 2))
    for c, a, b in zip(range(2, DRAWN + 1), edges, edges[1:]):
        i = drawn[a:b, None]
        if len(i) and c <= DIRECT:  # the same without logarithms: so few factors neither vanish nor overflow
            p = np.cumsum(np.cumprod(rate(i, np.arange(c)), 1) * np.exp(log_s[c, 1:c + 1]), 1)
            tables[i[:, 0]] = 1 + (p < rng.random((len(i), 1)) * p[:, -1:]).sum(1)
        elif len(i):
            log_p = np.cumsum(np.log(rate(i, np.arange(c))), 1) + log_s[c, 1:c + 1]
            p = np.cumsum(np.exp(log_p - log_p.max(1, keepdims=True)), 1)
            tables[i[:, 0]] = 1 + (p < rng.random((len(i), 1)) * p[:, -1:]).sum(1)
    large = np.flatnonzero(counts > DRAWN)
    if len(large):
        c, t = counts[large], tables[large]
        for _ in range(MOVES):
            t = t - (rng.random(len(t)) < sits_alone(c, t, discount))
            new = rate(large, t)
            t = t + (rng.random(len(t)) * (new + c - 1 - discount * t) < new)
        tables[large] = t
    return tables


class Restaurants:
    """What every bucket needs to know of all of them."""

    def __init__(self, n: int, types: int, class_tokens: np.ndarray, class_tables: np.ndarray, root_customers: float,
                 root_tables: float, discount: float, root_discount: float, context_discount: float = 0.5) -> None:
        self.n, self.types, self.discount, self.root_discount = n, types, discount, root_discount
        self.context_discount = context_discount
        self.class_tokens, self.class_tables = class_tokens.astype(float), class_tables.astype(float)
        self.root_customers, self.root_tables = float(root_customers), float(root_tables)

    def back_off(self) -> np.ndarray:
        """Share of each class that goes to the parent."""
        return (THETA_CONTEXT + self.discount * self.class_tables) / (THETA_CONTEXT + self.class_tokens)

    def unknown(self) -> float:
        """The parent's probability of the unknown token."""
        share = (THETA_ROOT + self.root_discount * self.root_tables) / (THETA_ROOT + self.root_customers)
        return share / (self.types + 1)

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        own = np.maximum(customers - self.root_discount * tables, 0) / (THETA_ROOT + self.root_customers)
        return own + self.unknown()


def sweeps(row, all_: Restaurants, seed: int, buckets: int = 1, all_totals: bytes | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, tuple]]:
    """Endless sweeps of one bucket: (tables of each pair, parent customers and tables of
    each word, (customers of each pair, tables of each context of a pair)).

    The first seating is drawn forward, every other one by Gibbs from the one before.  ``all_totals``
    are the tables of the bucket's contexts in all buckets."""
    word = np.frombuffer(row.pair_word, np.uint32).astype(np.int64)
    cls = np.frombuffer(row.classes, np.uint8).astype(np.int64)
    counts = np.frombuffer(row.counts, np.int64)
    contexts = unpack(getattr(row, "contexts", b""))
    own = np.ones(len(contexts), np.int64)
    if len(contexts):
        pair = _pairs_of(row)
        tokens = np.frombuffer(row.context_counts, np.uint32).astype(np.int64)
        keys, _, at = _by_owner(contexts, buckets)  # one table a word to begin with, of this bucket's words
        totals = np.bincount(at) if all_totals is None else np.frombuffer(all_totals, np.float32).astype(float)
        in_context = totals[at]
        counts = np.bincount(pair, minlength=len(word))
    types = len(row.words) // 8
    rng = np.random.default_rng([seed, int(row.bucket)])
    customers = np.bincount(word, minlength=types)  # a table for each pair to begin with
    tables, root_tables = np.ones(len(word), np.int64), np.ones(types, np.int64)
    weight = THETA_CONTEXT + all_.discount * all_.class_tables
    uniform = np.full(types, 1.0 / (all_.types + 1))
    first = True

    def without(customers, tables, discount, own):  # the parent's own customers of a dish that others sent
        return np.maximum(customers - own - discount * tables, 0)

    while True:
        p0 = all_.parent(customers, root_tables)
        if len(contexts):
            back, mass = weight[cls] * p0[word], THETA_CONTEXT + all_.class_tokens[cls]
            if first:
                p = (np.maximum(counts - all_.discount * tables, 0) + back) / mass
                own = seat(tokens, (THETA_WORD + all_.context_discount * in_context) * p[pair], all_.context_discount, rng)
            else:
                own = reseat(tokens, own, all_.context_discount, THETA_WORD, np.maximum(in_context - own, 0),
                             without(counts[pair], tables[pair], all_.discount, own) + back[pair],
                             np.maximum(mass[pair] - own, THETA_CONTEXT), rng)
            counts = np.bincount(pair, own, len(word)).astype(np.int64)
            tables = np.minimum(tables, counts)
        if first:
            tables = seat(counts, weight[cls] * p0[word], all_.discount, rng)
        else:
            root_back = (THETA_ROOT + all_.root_discount * all_.root_tables) / (all_.types + 1)
            tables = reseat(counts, tables, all_.discount, THETA_CONTEXT, np.maximum(all_.class_tables[cls] - tables, 0),
                            without(customers[word], root_tables[word], all_.root_discount, tables) + root_back,
                            np.maximum(THETA_ROOT + all_.root_customers - tables, THETA_ROOT), rng)
        customers = np.bincount(word, tables, types).astype(np.int64)
        root_tables = np.minimum(root_tables, customers)
        if first:
            root_tables = seat(customers, (THETA_ROOT + all_.root_discount * all_.root_tables) * uniform, all_.root_discount, rng)
        else:
            root_tables = reseat(customers, root_tables, all_.root_discount, THETA_ROOT,
                                 np.maximum(all_.root_tables - root_tables, 0), uniform, np.ones(types), rng, grows=0)
        first = False
        yield tables, customers, root_tables, (counts, own)


_TOTALS = f"class_customers array<long>, class_tables array<long>, customers long, root_tables long, {_PARTS}"


def _table_totals(all_: Restaurants, seed: int, buckets: int):
    """A bucket's totals after the burn-in: of the classes in its first row, of its contexts in a row for each owner."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                if not row.words:  # a bucket of held-out words only
                    continue
                run = sweeps(row, all_, seed, buckets)
                for _ in range(BURN_IN):
                    tables, customers, root_tables, (seated, own) = next(run)
                cls = np.frombuffer(row.classes, np.uint8).astype(np.int64)
                out = context_parts(row.bucket, unpack(row.contexts), own, buckets)
                totals = {"class_customers": np.bincount(cls, seated, CLASSES).astype(np.int64),
                          "class_tables": np.bincount(cls, tables, CLASSES).astype(np.int64),
                          "customers": int(customers.sum()), "root_tables": int(root_tables.sum())}
                for i, (name, value) in enumerate(totals.items()):
                    out.insert(i, name, pd.Series([value] + [None] * (len(out) - 1), dtype=object if i < 2 else "Int64"))
                yield out

    return rows


_SEATED = (f"bucket int, words binary, totals binary, pair_word binary, classes binary, {_ASKED}, counts binary, tables binary, "
           "root_tables binary, contexts binary, pair_contexts binary, context_counts binary, context_tables binary, "
           "class_customers array<long>, class_tables array<long>, customers array<long>, root_totals array<long>")


def _seatings(all_: Restaurants, seed: int, buckets: int = 1):
    """A bucket's counts with ``SAMPLES`` kept seatings: customers and tables of each pair, parent tables of
    each word, what the seatings add to the totals of all restaurants, and the mean tables of each context of a pair."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples():
                run, cls = sweeps(row, all_, seed, buckets, getattr(row, "context_totals", None)), np.frombuffer(row.classes, np.uint8).astype(np.int64)
                for _ in range(BURN_IN):
                    next(run)
                kept = [next(run) for _ in range(SAMPLES)]
                out.append((row.bucket, row.words, row.totals, row.pair_word, row.classes,
                            row.chunks, row.asked_words, row.asked_pairs, row.asked_classes, row.asked_contexts,
                            np.stack([k[3][0] for k in kept]).astype(np.int64).tobytes(),
                            np.stack([k[0] for k in kept]).astype(np.uint32).tobytes(),
                            np.stack([k[2] for k in kept]).astype(np.uint32).tobytes(),
                            row.contexts, row.pair_contexts, row.context_counts,
                            np.mean([k[3][1] for k in kept], axis=0).astype(np.float32).tobytes(),
                            np.concatenate([np.bincount(cls, k[3][0], CLASSES) for k in kept]).astype(np.int64),
                            np.concatenate([np.bincount(cls, k[0], CLASSES) for k in kept]).astype(np.int64),
                            [int(k[1].sum()) for k in kept], [int(k[2].sum()) for k in kept]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _SEATED.split(", ")])

    return rows


def _with_totals(run):
    """``run`` over a bucket's row and the totals of its contexts."""
    def rows(model: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        every = b"".join(totals.sort_values("owner")["tables"])
        return pd.concat(run(iter([model.assign(context_totals=every)])), ignore_index=True)

    return rows


def predictive(row, seatings: list[Restaurants]) -> tuple[np.ndarray, np.ndarray]:
    """(probability of each pair of a word and a class averaged over the seatings, parent
    probability of each word in each seating).

    A seating's tables go with the totals of that same seating, so in every class the known
    words and the unknown one share the whole mass, in each seating and on average."""
    word = np.frombuffer(row.pair_word, np.uint32).astype(np.int64)
    cls = np.frombuffer(row.classes, np.uint8).astype(np.int64)
    counts = np.frombuffer(row.counts, np.int64).reshape(len(seatings), -1)
    tables = np.frombuffer(row.tables, np.uint32).reshape(len(seatings), -1).astype(np.int64)
    root_tables = np.frombuffer(row.root_tables, np.uint32).reshape(len(seatings), -1).astype(np.int64)
    p, parents = np.zeros(len(word)), []
    for all_, sits, own, root in zip(seatings, counts, tables, root_tables):
        parent = all_.parent(np.bincount(word, own, root_tables.shape[1]), root)
        p += ((sits - all_.discount * own) / (THETA_CONTEXT + all_.class_tokens[cls])
              + all_.back_off()[cls] * parent[word]) / len(seatings)
        parents.append(parent)
    return p, np.stack(parents)


_ANSWERS = "chunk string, bucket int, pair_p binary, own binary, word_counts binary, word_tables binary"


def _answer(seatings: list[Restaurants]):
    """For each chunk's share of a bucket: probabilities of the pairs in their class, what the words' own
    context gives them, and the words' counts."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                totals = np.append(np.frombuffer(row.totals, np.int64), 0)  # the last one stands for none
                pairs = np.frombuffer(row.pair_word, np.uint32).astype(np.int64) * CLASSES + np.frombuffer(row.classes, np.uint8)
                p, parents = predictive(row, seatings)
                pairs, p = np.append(pairs, np.iinfo(np.int64).max), np.append(p, 0)
                parents = np.concatenate([parents, [[all_.unknown()] for all_ in seatings]], axis=1)
                sits = np.append(np.frombuffer(row.context_counts, np.uint32) - seatings[0].context_discount * np.frombuffer(
                    row.context_tables, np.float32), 0)
                for chunk, at, per_word, cls, contexts in zip(
                        row.chunks, row.asked_words, row.asked_pairs, row.asked_classes, row.asked_contexts):
                    at = unpack_places(at)
                    word = np.repeat(at, np.frombuffer(zlib.decompress(per_word), np.uint8))
                    cls = np.frombuffer(zlib.decompress(cls), np.uint8).astype(np.int64)
                    # a pair not seen: the parent's share
                    value = sum(all_.back_off()[cls] * parent[word] / len(seatings) for all_, parent in zip(seatings, parents))
                    code = np.where(word >= 0, word * CLASSES + cls, -1)
                    place = np.searchsorted(pairs, code)
                    value = np.where(pairs[place] == code, p[place], value)
                    yield pd.DataFrame([(chunk, row.bucket, value.astype(np.float32).tobytes(), shrink(sits[unpack_places(contexts)].astype(
                        np.float32)), shrink(totals[at]), None)], columns=[c.split()[0] for c in _ANSWERS.split(", ")])

    return rows


def _as_contexts(key: tuple, model: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
    """For each chunk's share of a bucket: the words' tables as a context."""
    out = []
    for row in model.itertuples():
        known = context_key(np.frombuffer(row.words, np.uint64))
        as_context = np.zeros(len(known) + 1)  # the last one stands for none
        for r in own.itertuples():
            contexts, tables = unpack(r.own_contexts), np.frombuffer(r.own_tables, np.float64)
            at = np.minimum(np.searchsorted(contexts, known), len(contexts) - 1)
            as_context[:-1] = np.where(contexts[at] == known, tables[at], 0)
        out += [(chunk, int(key[0]), None, None, None, shrink(as_context[unpack_places(at)].astype(np.float32)))
                for chunk, at in zip(row.chunks, row.asked_words)]
    return pd.DataFrame(out, columns=[c.split()[0] for c in _ANSWERS.split(", ")])


# ---------------------------------------------------------------- scoring

def token_scores(t, answers: pd.DataFrame, discount: float, start: tuple[float, float]):
    """(each token's word, log10 probability of each token, count of each word) of a chunk from the
    answers of all buckets.  ``start``: tokens and tables of the restaurant before a text's first word."""
    answers = answers.sort_values("bucket")
    if answers.empty:
        raise ValueError(f"chunk {t.chunk}: not asked; its texts were others when they were counted")
    pair_p = np.concatenate([np.frombuffer(x, np.float32) for x in answers["pair_p"].dropna()]).astype(np.float64)
    own, tables, counts = (np.concatenate([grow(x, kind) for x in answers[c].dropna()]).astype(np.float64)
                           for c, kind in (("own", np.float32), ("word_tables", np.float32), ("word_counts", np.int64)))
    word = grow(t.tokens, np.uint32).astype(np.int64)
    pairs, _, pair, context, token = triples(word, np.frombuffer(t.sizes, np.int64), np.frombuffer(t.word_classes, np.uint8))
    if (len(pair_p), len(own)) != (len(pairs), len(pair)):
        raise ValueError(f"chunk {t.chunk}: {len(pairs)} and {len(pair)} asked, {len(pair_p)} and {len(own)} answered")
    # a known word is followed by a token wherever it stands, so its count is its restaurant's
    in_context = THETA_WORD + np.append(counts, start[0])
    back_off = (THETA_WORD + discount * np.append(tables, start[1])) / in_context
    return word, np.log10(own / in_context[context] + back_off[context] * pair_p[pair])[token], counts


def _score(n: int, types: int, discount: float, start: tuple[float, float]):
    """Scores of a chunk's texts."""

    def run(key: tuple, tokens: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if tokens.empty:
            raise ValueError(f"chunk {key[0]}: its texts are not there any more")
        t = next(tokens.itertuples())
        word, log_p, counts = token_scores(t, answers, discount, start)
        sizes = np.frombuffer(t.sizes, np.int64)
        first = np.cumsum(sizes) - sizes
        base = np.log10((counts + 0.5) / (n + 0.5 * (types + 1)))
        total = lambda x: np.add.reduceat(x, first)  # noqa: E731  every text has a token
        return pd.DataFrame({
            "doc_id": pd.array(t.doc_ids, "Int64"), "held_out": np.asarray(t.held_out, bool), "n_tokens": sizes,
            "n_known": total((counts > 0).astype(np.int64)[word]), "base_score": total(base[word]), "score": total(log_p)})

    return run


def _start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tables of the restaurant before a text's first word, of its owner's."""
    for pdf in batches:
        for r in pdf.itertuples():
            yield pd.DataFrame({"tables": np.frombuffer(r.own_tables, np.float64)[unpack(r.own_contexts) == START]})


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings changed for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def lm_scores(docs: DataFrame, held_out, buckets: int | None = None, seed: int = 1) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text)``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, perplexity``.

    ``docs`` is a stored table, read three times (once for its size only); ``held_out`` a boolean column over it that
    says what is not learned from.  Null and empty texts are one end token.  With nothing to
    learn from, every token is the unknown one, with probability 1.  Repeated rows and null
    ids give rows of their own; an empty table an empty result; other columns are ignored."""
    spark = docs.sparkSession
    with settings(spark, {
            "spark.sql.files.minPartitionNum": spark.conf.get("spark.sql.files.minPartitionNum", None)
            or str(spark.sparkContext.defaultParallelism),  # both readings of the texts are split alike
            # what a step has stored is read from there: its shuffle files can go
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}):
        return _lm_scores(docs, held_out, buckets, seed)


def _lm_scores(docs: DataFrame, held_out, buckets: int | None, seed: int) -> DataFrame:
    spark = docs.sparkSession
    if not buckets:  # a bucket's share of the texts does not grow with them
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
        buckets = max(MIN_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    sent = ("bucket int, words binary, pairs binary, classes binary, counts binary, contexts binary, pair_contexts binary, "
            "context_counts binary, chunk string")

    def count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, chunk, _ in chunks(batches, buckets):
            yield pd.DataFrame(list(chunk.by_bucket())).assign(chunk=name)[[c.split()[0] for c in sent.split(", ")]]

    def token_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, chunk, rows in chunks(batches, buckets):
            yield pd.DataFrame([{
                "chunk": name, "tokens": shrink(chunk.tokens.astype(np.uint32)),
                "word_classes": chunk.word_class.tobytes(),
                "sizes": chunk.sizes.tobytes(), "doc_ids": [None if pd.isna(x) else int(x) for x in rows["doc_id"]],
                "held_out": rows["held_out"].tolist()}])

    def by_class(df: DataFrame, name: str, size: int) -> np.ndarray:  # a few numbers a context class
        total = np.zeros(size)
        for r in df.select(F.posexplode(name).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect():
            total[r["i"]] = r["x"]
        return total

    def kept_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                yield context_parts(r.bucket, unpack(r.contexts), np.frombuffer(r.context_tables, np.float32), buckets)

    model = materialize(d.mapInPandas(count_rows, sent).groupBy("bucket").applyInPandas(_merge, _MODEL), "lm-counts")
    class_pairs, class_contexts = by_class(model, "class_pairs", CLASSES), by_class(model, "class_contexts", CLASSES)
    ones = [f"{level}{k}" for level in ("context_", "", "root_") for k in ("ones", "twos")]
    sums = model.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ones],
                     F.coalesce(F.sum(F.octet_length("words") / 8), F.lit(0)).cast("long").alias("types")).first()
    class_tokens = by_class(model, "class_tokens", CLASSES)
    n, types = int(class_tokens.sum()), int(sums["types"])
    share = lambda a, b: min(0.95, max(0.05, a / max(a + 2 * b, 1)))
    discounts = (share(sums["ones"], sums["twos"]), share(sums["root_ones"], sums["root_twos"]),
                 share(sums["context_ones"], sums["context_twos"]))
    all_ = Restaurants(n, types, class_contexts, class_pairs, class_pairs.sum(), types, *discounts)
    totals = materialize(model.mapInPandas(_table_totals(all_, seed, buckets), _TOTALS), "lm-tables")
    root = totals.agg(F.coalesce(F.sum("customers"), F.lit(0)).alias("c"), F.coalesce(F.sum("root_tables"), F.lit(0)).alias("t")).first()
    all_ = Restaurants(n, types, by_class(totals, "class_customers", CLASSES), by_class(totals, "class_tables", CLASSES),
                       root["c"], root["t"], *discounts)
    # the kept seatings, and the exact totals of each
    in_contexts = materialize(totals.groupBy("owner").applyInPandas(_send_back, "owner int, bucket int, tables binary"), "lm-in-contexts")
    discard(totals)
    seated = materialize(model.drop("class_tokens", "class_pairs", "class_contexts", *ones).groupBy("bucket").cogroup(
        in_contexts.groupBy("bucket")).applyInPandas(_with_totals(_seatings(all_, seed + 1, buckets)), _SEATED), "lm-seatings")
    discard(model, in_contexts)
    class_customers, class_tables = (by_class(seated, c, SAMPLES * CLASSES).reshape(SAMPLES, CLASSES)
                                     for c in ("class_customers", "class_tables"))
    customers, root_totals = by_class(seated, "customers", SAMPLES), by_class(seated, "root_totals", SAMPLES)
    seatings = [Restaurants(n, types, class_customers[i], class_tables[i], customers[i], root_totals[i], *discounts)
                for i in range(SAMPLES)]
    own = materialize(seated.select("bucket", "contexts", "context_tables").mapInPandas(kept_parts, _PARTS).groupBy(
        "owner").applyInPandas(_own, "bucket int, own_contexts binary, own_tables binary"), "lm-contexts")
    start = own.where(F.col("bucket") == START % buckets).mapInPandas(_start, "tables double").agg(
        F.coalesce(F.sum("tables"), F.lit(0.0)).alias("t")).first()
    answers = seated.select("bucket", "totals", "pair_word", "classes", *[c.split()[0] for c in _ASKED.split(", ")], "counts", "tables",
                            "root_tables", "context_counts", "context_tables").mapInPandas(_answer(seatings), _ANSWERS).unionByName(
        seated.select("bucket", "words", "chunks", "asked_words").groupBy("bucket").cogroup(own.groupBy("bucket")).applyInPandas(
            _as_contexts, _ANSWERS))
    tokens = d.mapInPandas(token_rows, "chunk string, tokens binary, word_classes binary, sizes binary, "
                                       "doc_ids array<long>, held_out array<boolean>")
    scored = materialize(tokens.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        _score(n, types, discounts[2], (class_tokens[CLASSES - 1], start["t"])),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"), "lm-scores")
    discard(seated, own)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 1)
