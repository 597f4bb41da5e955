"""Secret scans: patterns, and guess costs of values in a credential's place.

The base kinds are patterns.  Beyond them, a value that a credential word introduces is
judged by how many guesses a cracker would need: a dynamic programme over the value finds
the cheapest segmentation into common words, dates, repeats, keyboard walks and
brute-force spans.  Values that stay dear even so are reported as kind ``guess``.

The credential word may be a part of an identifier (``AWS_SECRET_ACCESS_KEY``).  Short ones
that other words contain (pin in shipping) must be a part by themselves.  The guess cost
alone decides; prose stays out because the dictionary holds a vocabulary's word pieces.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import heapq
import math
import re
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm.common import table, text_of, worker_cache

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
# an identifier with a sign or word of assignment after it (possessive: linear), a command's option, an element
NAME = re.compile(r"""(?<![A-Za-z0-9_.-])([A-Za-z0-9_.-]++)["']?+(?:[\x20\t]*+(?::=|=>|[:=])|[\x20\t]++is\x20)""", re.ASCII)
OPTION = re.compile(r"(?<![A-Za-z0-9_.-])(--?[A-Za-z][A-Za-z0-9_.-]*+)[\x20\t]++(?=[^\s-])", re.ASCII)
ELEMENT = re.compile(r"<([A-Za-z0-9_.-]++)>(?=[^<\n]+</)", re.ASCII)
# the value that follows: after a scheme's word, up to its closing quote, the next element or white space
VALUE = re.compile(r"""[\x20\t]*+(?:(?i:bearer|basic|digest|token)[\x20\t]++)?(?:"([^"\n]+)"|'([^'\n]+)'|["']?([^\s"']\S*))""")
INNER = re.compile(r"([^<\n]+)")
# the password of an address with user and password
ADDRESS = re.compile(r"://[^\s/:@]+:([^\s/@]+)@")
# credential words that may stand anywhere in an identifier, and short ones that must be a part of it
ANYWHERE = re.compile(r"password|passwd|passphrase|passcode|pwd|secret|token|credential|authorization"
                      r"|(?:api|access|private)[_.-]?key", re.IGNORECASE | re.ASCII)
PART = re.compile(r"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?:(?i:auth|bearer|login|pin)(?![A-Za-z])"
                  r"|(?:[Aa]uth|[Bb]earer|[Ll]ogin|[Pp]in)(?=[A-Z]))|(?i:pass)(?![A-Za-z])|[Pp]ass(?=[A-Z])", re.ASCII)
SPACED = re.compile(r"(?:api|access|private)\x20key", re.IGNORECASE | re.ASCII)  # the key begins the identifier
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "login", "pin")
MIN_LOG_GUESSES = 10.0

# common words of passwords, most frequent first (a short list; more can be passed in)
COMMON = tuple("""password love admin welcome monkey dragon master login letmein sunshine princess football baseball
shadow superman michael jordan hunter summer winter spring autumn hello secret test user root guest default change
computer internet server system access private public company office money family freedom whatever trust angel star
blue green black white orange purple silver golden tiger lion eagle cookie cheese pepper ginger flower hockey soccer
the and you are this that with from have not for key pass word my our new old good best day night time""".split())
VOCABULARY = "byte_bpe_50k.tiktoken"  # its word pieces follow the common words, by rank
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
DATE = re.compile(r"(?:\d{1,2}[-/.]\d{1,2}[-/.](?:\d{4}|\d{2})|(?:19|20)\d{2}[-/.]?\d{2}[-/.]?\d{2}|(?:19|20)\d{2})")
DIGITS, LOWER, UPPER, SIGNS = 10, 26, 26, 33
_NEXT = {a + b for row in ROWS for x in (row, row[::-1]) for a, b in zip(x, x[1:])}


def _charset(value: str) -> int:
    return (DIGITS * any(c.isdigit() for c in value) + LOWER * any(c.islower() for c in value)
            + UPPER * any(c.isupper() for c in value)
            + SIGNS * any(not c.isalnum() for c in value)) or LOWER


def dictionary() -> tuple[dict[str, int], int]:
    """Rank of every common word and word piece, and the longest one's length; read once a worker."""
    cache = worker_cache("secret-words")
    if "rank" not in cache:
        rank = {w: i + 1 for i, w in enumerate(COMMON)}
        with open(public_tokenizers.path(VOCABULARY), "rb") as lines:
            for line in lines:
                piece = base64.b64decode(line.split()[0]).strip()
                if len(piece) >= 3 and piece.isalpha():  # ASCII letters
                    rank.setdefault(piece.decode().lower(), len(rank) + 1)
        cache["rank"] = rank, max(map(len, rank))
    return cache["rank"]


def _from_start(best: list[float], starts: list[int], i: int, choices: int) -> float:
    """Least cost of a span from one of ``starts`` to ``i``, of ``choices`` guesses a character.

    A start that an earlier one beats now is beaten at every longer span: it is struck out, so
    the list stays short."""
    least = math.inf
    for k, j in enumerate(starts):
        if i - j < 3:
            break
        cost = best[j] + math.log10(choices * (i - j))
        if cost >= least:
            starts[k] = -1
        least = min(least, cost)
    starts[:] = [j for j in starts if j >= 0]
    return least


def log_guesses(value: str, words: dict[str, int] | None = None) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs.

    Linear in the value's length but for the longest dictionary word."""
    rank, longest = (words, max(map(len, words), default=0)) if words else dictionary()
    n, low = len(value), value.lower()
    plain = [c in "0123456789" for c in value]
    per_char = math.log10(_charset(value))
    dates = {}
    for i in range(n):
        if plain[i] and (m := DATE.match(value, i)):
            dates.setdefault(m.end(), []).append((i, math.log10(365 * 120 if m.end() - i > 4 else 120)))
    best = [0.0] + [math.inf] * n
    walks, repeats = [0], [0]  # starts that a keyboard walk or a repeat up to here may have
    joint = math.log10(2)  # a guess of how the parts are put together
    for i in range(1, n + 1):
        cost = best[i - 1] + per_char  # brute force, one character more
        if i > 1:
            walks = walks + [i - 1] if low[i - 2:i] in _NEXT else [i - 1]
            repeats = repeats + [i - 1] if low[i - 1] == low[i - 2] else [i - 1]
        cost = min(cost, _from_start(best, walks, i, len(ROWS) * 20) + joint)
        cost = min(cost, _from_start(best, repeats, i, _charset(value[i - 1])) + joint)
        for size in range(3, min(longest, i) + 1):
            at = rank.get(low[i - size:i])
            if at:
                part = value[i - size:i]
                cased = 0 if part == low[i - size:i] else math.log10(2) if part[1:].islower() or part.isupper() \
                    else size * math.log10(2)
                cost = min(cost, best[i - size] + math.log10(at) + cased + joint)
        for period in (2, 3, 4):  # a block said twice or more costs one block and a count
            if i >= 2 * period and low[i - period:i] == low[i - 2 * period:i - period]:
                cost = min(cost, best[i - period] + joint)
        for at, c in dates.get(i, ()):
            cost = min(cost, best[at] + c + joint)
        best[i] = cost
    return best[n]


def introduces(text: str, name: re.Match) -> bool:
    """Whether the identifier, or it and the word before it, holds a credential word."""
    return bool(ANYWHERE.search(name[1]) or PART.search(name[1])
                or SPACED.search(text, max(0, name.start() - 8), name.start() + 3))


def _values(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values in a credential's place, none inside another."""
    def places(name: re.Pattern, value: re.Pattern) -> Iterator[tuple]:
        return ((m.start(), m.end(), m, value) for m in name.finditer(text))

    named = heapq.merge(places(NAME, VALUE), places(OPTION, VALUE), places(ELEMENT, INNER), key=lambda x: x[:2])
    out, at = [], 0  # at: end of the last value
    for start, end, m, pattern in named:
        if start < at or not introduces(text, m) or not (v := pattern.match(text, end)):
            continue
        a, b = v.span(v.lastindex)
        if v.lastindex == v.re.groups:  # not quoted
            b = a + len(text[a:b].rstrip("\"'.,;:!?)]}>"))
        at = max(a, b)
        out.append((a, b))
    taken = sorted(out)
    for m in ADDRESS.finditer(text):
        a, b = m.span(1)
        i = bisect.bisect_right(taken, (a, b))
        if not any(x <= a and b <= y for x, y in taken[max(0, i - 1):i + 1]):
            out.append((a, b))
    return out


def spans_of(text: str, min_log_guesses: float = MIN_LOG_GUESSES) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every secret, in code points, by start and then kind."""
    low = text.lower()
    found: list[tuple[int, int, int]] = []
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "://" in low or any(h in low for h in CONTEXT_HINTS):
        base = sorted((a, b) for a, _, b in found)
        for a, b in sorted(_values(text)):
            inner = min((x for x, _ in base if a < x < b), default=b)  # another secret follows in a list
            b = b if inner == b else a + len(text[a:inner].rstrip("\"'.,;:!?)]}>"))
            if any(x <= a and b <= y for x, y in base):
                continue  # a base span holds it already
            if a < b and log_guesses(text[a:b]) >= min_log_guesses:
                found.append((a, 3, b))
    return sorted(found)


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(text: Column) -> Column:
    """Struct (n_assign, n_access, n_hex, base_sha256, spans) of a text column."""

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            out = []
            for t in series:
                spans = spans_of(text_of(t))
                base = [s for s in spans if s[1] < 3]
                out.append((*(sum(s[1] == k for s in base) for k in range(3)),
                            hashlib.sha256(_said(base).encode()).hexdigest(), _said(spans)))
            yield pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run(text)


def redact(text: Column) -> Column:
    """The text with every secret replaced by ``[kind]`` (null stays null)."""

    @F.pandas_udf("string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield series.map(lambda t: redacted(t) if isinstance(t, str) else None)

    return run(text)


def redacted(text: str) -> str:
    out, at = [], 0
    for a, k, b in spans_of(text):
        if b <= at:
            continue  # inside the one before
        if a >= at:
            out += [text[at:a], f"[{KINDS[k]}]"]
        at = b
    return "".join([*out, text[at:]]) if out else text


def secret_scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for each row of
    ``docs(doc_id, text)``.  Null and empty texts have no spans.  Repeated rows and null ids
    give rows of their own; an empty table an empty result; other columns are ignored."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scan(F.col("text")).alias("s")).select("doc_id", "s.*")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))
