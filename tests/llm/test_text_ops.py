"""Pieces, byte-level BPE, packing, quality rules and secret scans."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from civic_mart.llm import bpe, packing, pieces, quality, secret_scan
from llm_data import LONG, no_docs, odd_docs

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "a", "  a", "a  ", "\n\nfoo", "it's we're I'll 'sabc 's 'S don't ''s '!s  's x'llama ", "x　 y \x1c z\x85w",
         "aaaa" * 500, "=" * 2001, " " * 500 + "x", "🙂🙂 é 中文字 ①²½", "'", "1'd2", "\t\t a\r\n b", "'re'", "ab" * 801 + "==", LONG]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice("aab  \n'strevmld.=-01é中 A") for _ in range(rng.randrange(120))) for _ in range(n)]


def test_pieces_are_the_patterns_matches():
    texts = TEXTS + random_texts(300)
    cps, offsets = pieces.code_points(texts)
    starts = pieces.split(cps, offsets)
    joined, ends = "".join(texts), np.append(starts[1:], len(cps))
    got = [joined[a:b] for a, b in zip(starts, ends)]
    assert got == [m for t in texts for m in regex.findall(public_tokenizers.PATTERN, t)]


def test_sql_bpe_equals_the_library():
    own = pieces.PieceCoder(bpe.SqlBpe(bpe.read_ranks(RANKS)), most=200)  # forgets now and then
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for texts in (TEXTS, random_texts(100), random_texts(100, 9)):
        ids, at, raw, byte_at = own.encode(texts)
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == lib.encode_ordinary(t)
            assert raw[byte_at[i]:byte_at[i + 1]].tobytes() == t.encode()


def test_bpe_contracts_rank_by_rank():
    """A merged token that pairs to a smaller rank than its own goes one at a time."""
    ranks = {bytes([b]): b for b in range(256)} | {b"xab": 300, b"xa": 299, b"ab": 301, b"aa": 302}
    own = bpe.SqlBpe(ranks)

    def by_hand(word):
        parts = [bytes([b]) for b in word]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if not best:
                return [ranks[p] for p in parts]
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    rng = random.Random(2)
    words = list({"".join(rng.choice("xab") for _ in range(rng.randrange(1, 15))) for _ in range(300)})
    (ids, sizes), _ = own(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [by_hand(w.encode()) for w in words]


def test_bpe_operator(spark):
    docs = odd_docs(spark)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = []
    for r in docs.collect():
        ids = lib.encode_ordinary(r.text or "")
        want.append((str(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_round_trip(docs, RANKS).collect()]
    assert sorted(got) == sorted(want)
    assert bpe.bpe_round_trip(no_docs(spark), RANKS).collect() == []


@pytest.mark.parametrize("capacity", [10, 64, 1024])
def test_plan_is_gapless_and_near_the_bound(capacity):
    rng = np.random.default_rng(capacity)
    for _ in range(6):
        counts = np.zeros(capacity + 1, np.int64)
        counts[rng.integers(1, capacity + 1, 30)] = rng.integers(0, 200, 30)
        runs, bins = packing.plan_bins(counts, capacity)
        seen, filled = np.zeros(capacity + 1, np.int64), defaultdict(list)
        for length, rank, n, first, offset in runs:
            assert rank == seen[length]
            seen[length] += n
            for i in range(n):
                filled[first + i].append((offset, length))
        assert (seen == counts).all() and len(filled) == bins
        for parts in filled.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= capacity
            assert sum(length > capacity // 3 for _, length in parts) <= 2
        large = counts[capacity // 3 + 1:].sum()
        assert bins <= max(large, 1.25 * (counts * np.arange(capacity + 1)).sum() / capacity + 2)


def test_packing_operator(spark):
    docs = odd_docs(spark)
    got = packing.pack(docs.repartition(3), JSON).collect()
    lib = Tokenizer.from_file(JSON)
    want = Counter()
    for r in docs.collect():
        ids = np.array([*lib.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want.update((r.doc_id, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.pack(no_docs(spark), JSON).collect() == []


# ---------------------------------------------------------------- quality

def brute_repeat(words):
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, marked = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            marked |= set(range(i, i + 8))
    return len(marked)


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            brute_repeat(words))


def test_repeat_words():
    rng = random.Random(1)
    for i in range(200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(60))]
        words = words[:20] * 2 if i % 3 == 0 else words
        assert quality.repeat_words(words) == brute_repeat(words)


def test_quality_base_on_odd_rows(spark):
    docs = odd_docs(spark)
    got = quality.quality_rules(docs).collect()
    want = Counter((r.doc_id, *brute_base(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)
    assert quality.quality_rules(no_docs(spark)).collect() == []


def test_boilerplate_lines_deplete_documents(spark):
    def words(i, n):
        return " ".join(f"w{i}x{j}" for j in range(n))

    rows = [(i, words(i, 40) + "\nshared Footer  line", "big") for i in range(200)]       # shared by all, small
    rows += [(1000 + i, words(7000 + i, 3) + "\n" + words("common", 30), "big") for i in range(80)]  # mostly shared
    rows += [(2000 + i, words("copy", 40) + "\n" + words("copy2", 9), "big") for i in range(300)]    # one text, copied
    rows += [(3000, words("common", 30), "small")]
    got = {r.doc_id: r for r in quality.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).collect()}
    assert all(got[i].kept and got[i].removed_words == 3 for i in range(200))
    assert not any(got[1000 + i].kept for i in range(80))
    assert all(got[2000 + i].kept and got[2000 + i].removed_words == 0 for i in range(300))
    assert got[3000].kept  # the limit is a host's own


def test_documents_that_share_several_lines_count_one_by_one(spark):
    rng = random.Random(6)
    stock = [" ".join(f"s{i}x{j}" for j in range(8)) for i in range(40)]
    sets = set()
    while len(sets) < 2000:
        sets.add(tuple(sorted(rng.sample(range(40), 6))))
    rows = [(i, "\n".join(stock[x] for x in s), "pool") for i, s in enumerate(sorted(sets))]
    shared = "\n".join(stock[:6])
    rows += [(5000 + i, f"{shared}\nown line {i}", "one own line") for i in range(200)]
    rows += [(6000 + i, shared, "copies") for i in range(200)]
    got = {r.doc_id: r for r in quality.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).collect()}
    assert all(got[i].removed_words == 48 and not got[i].kept for i in range(2000))
    assert all(got[5000 + i].removed_words == 48 and not got[5000 + i].kept for i in range(200))
    assert all(got[6000 + i].removed_words == 0 and got[6000 + i].kept for i in range(200))


# ---------------------------------------------------------------- secrets

def brute_spans(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text,
                         re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_base_spans():
    rng = random.Random(5)
    bits = ["password", "Token", " = ", ":", '"', "'", "AKIA", "0123456789abcdef" * 2, "ABCDEFGH12345678", "é", " ", "api_key",
            "APIKEY", "a1b2", "/x+y_z=.", "secret"]
    for _ in range(2000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert [s for s in secret_scan.spans_of(text) if s[1] < 3] == brute_spans(text)


def test_guess_costs():
    cost = secret_scan.log_guesses
    for weak in ("password123", "qwerty2020", "aaaaaaaaaaaaaaaaaaaa", "20240101", "abcabcabcabcabc", "Welcome1", "12.05.1999"):
        assert cost(weak) < 7, weak
    for strong in ("9Xk#2mQ!vL8z", "f3ef4d6b2755a36d", "zQ9$kdl-pq0x!1"):
        assert cost(strong) > 15, strong
    assert cost("") == 0 and cost("9Xk#2mQ!vL8z") < cost("9Xk#2mQ!vL8zR")
    spans = secret_scan.spans_of("my password is 9Xk#2mQ!vL8z. login: hello2020 token said nothing")
    assert spans == [(15, 3, 27)]
    assert secret_scan.redacted('x token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" y') == 'x [assign]" y'


def test_credential_words_inside_identifiers():
    rng = random.Random(8)
    draw = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed = lower + lower.upper() + digits
    for before, value in (("AWS_SECRET_ACCESS_KEY=", draw(mixed + "+/", 40)), ('secret_key = "', draw(mixed, 24)),
                          ("MYSQL_PWD=", draw(mixed, 16)), ("userpwd: ", draw(mixed, 16)), ("userPin=", draw(mixed, 16)),
                          ("the api key: ", draw(mixed, 20)), ("url: https://a.b/c?dbpass=", draw(mixed, 16)),
                          ("DB_PASSWORD=", "p@ss!9f$Kq"), ("passphrase: ", draw(lower, 30)), ("pwd=", draw(digits, 20))):
        assert (len(before), 3, len(before) + len(value)) in secret_scan.spans_of(f"{before}{value} and text"), before
        assert value not in secret_scan.redacted(f"{before}{value} and text")
    for prose in ("the token is deprecated", "passphrase is unbelievable", "the secret is perseverance", "pin: 1234",
                  "AUTHOR: Hemingway-Smith", "shipping: 9Xk#2mQ!vL8z", "the monkey is 9Xk#2mQ!vL8z"):
        assert secret_scan.spans_of(prose) == [], prose


def test_secret_operator(spark):
    docs = odd_docs(spark)
    got = secret_scan.secret_scan(docs).collect()
    assert len(got) == docs.count() and all(r.spans == "" and r.n_hex == 0 for r in got)
    assert {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()}
    one = spark.createDataFrame([(1, 'é password="abcdefgh1" AKIAABCDEFGHIJKL ' + "0a" * 16)], "doc_id long, text string")
    r = secret_scan.secret_scan(one).first()
    assert r.spans == "assign:2:21,access:23:39,hex:40:72" and (r.n_assign, r.n_access, r.n_hex) == (1, 1, 1)
    assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert secret_scan.secret_scan(no_docs(spark)).collect() == []


def thue_morse(n, flip=0):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_pieces_whose_keys_collide_keep_their_own_ids():
    """Texts with equal polynomial keys, in one batch and in batches after one another."""
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    one, two = thue_morse(1024), thue_morse(1024, 1)
    cps, at = pieces.code_points([one, two])
    assert len(set(pieces.piece_keys(cps, at[:-1]).tolist())) == 1  # the trap is one
    for batches in ([[one, two, "x y"]], [[one, "x"], [two, one], [two]]):
        sql, library = pieces.PieceCoder(bpe.SqlBpe(bpe.read_ranks(RANKS))), packing._tokenizer(JSON)[0]
        library.forget()
        for texts in batches:
            for coder in (sql, library):
                ids, where, *_ = coder.encode(texts)
                assert [ids[where[i]:where[i + 1]].tolist() for i in range(len(texts))] == [lib.encode_ordinary(t) for t in texts]


def test_special_tokens_are_as_in_the_plain_call():
    own, special = packing._tokenizer(JSON)
    plain = Tokenizer.from_file(JSON)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "", "no", "x<|endoftext|><|endoftext|> it's", "<|endof text|>"]
    ids, at = packing.encode(texts, own, special)
    assert [ids[at[i]:at[i + 1]].tolist() for i in range(len(texts))] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_quality_sql_with_a_shared_pool_of_lines(spark):
    """Documents made of few stock lines, no two alike: the SQL and the code judge them alike."""
    import itertools

    import duckdb

    pool = [f"stock line number {i} of this host with several words in it" for i in range(12)]
    rows = [(i, "\n".join([*some, f"own words of document {i} and some more of them here"] if i % 3 else some), "en", "h", 1)
            for i, some in enumerate(itertools.islice(itertools.combinations(pool, 4), 400))]
    rows += [(1000 + i, f"a clean text {i} " * 9, "en", "other", 1) for i in range(5)] + [(2000, None, None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    got = quality.quality_rules(df).drop("host", "text_key", "boilerplate")
    want = con.execute(quality.OP7_SQL).fetchdf()[got.columns].itertuples(index=False, name=None)
    rows_got = sorted(map(tuple, got.collect()))
    assert rows_got == sorted(want)
    assert sum(not r[7] for r in rows_got) > 200


def test_secrets_in_more_places():
    long = "Xk9pQ7zL2vB8w"
    for text, secret in [(f"Authorization: Bearer {long}", long), ("password: Xk9,pQ7;zL2#vB8w", "Xk9,pQ7;zL2#vB8w"),
                         (f"password := {long}#", f"{long}#"), ("password => 'Xk9 pQ7zL2vB8w#'", "Xk9 pQ7zL2vB8w#"),
                         (f"mysql --password {long} -u me", long), (f"<password>{long}</password>", long),
                         (f"see postgres://user:{long}@host/db", long)]:
        cut = secret_scan.redacted(text)
        assert secret not in cut and long[:6] not in cut and "[" in cut, text
    for text in ("the password is easy to guess", "mysql --password -u me", "http://host:8080/path", "<password></password>"):
        assert secret_scan.redacted(text) == text


def cheapest(value, words):
    """Guess cost by trying every segmentation, with the costs written down anew."""
    import functools
    import math

    kinds = 10 * any(c.isdigit() for c in value) + 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value) \
        + 33 * any(not c.isalnum() for c in value) or 26

    def part(a, b):
        v, low, out = value[a:b], value[a:b].lower(), []
        if b - a == 1:
            out.append(math.log10(kinds))
        if b - a >= 3 and all(low[i:i + 2] in secret_scan._NEXT for i in range(b - a - 1)):
            out.append(math.log10(100 * (b - a)) + math.log10(2))
        if b - a >= 3 and len(set(low)) == 1:
            out.append(math.log10(secret_scan._charset(value[a]) * (b - a)) + math.log10(2))
        if low in words and b - a >= 3:
            cased = 0 if v == low else math.log10(2) if v[1:].islower() or v.isupper() else (b - a) * math.log10(2)
            out.append(math.log10(words[low]) + cased + math.log10(2))
        return min(out, default=math.inf)

    @functools.cache
    def best(b):
        if b == 0:
            return 0.0
        costs = [best(a) + part(a, b) for a in range(b)]
        low = value.lower()
        costs += [best(b - p) + math.log10(2) for p in (2, 3, 4) if b >= 2 * p and low[b - p:b] == low[b - 2 * p:b - p]]
        return min(costs)

    return best(len(value))


def test_guess_costs_equal_every_segmentation():
    rng = random.Random(8)
    words = {"pass": 1, "word": 7, "password": 2, "dragon": 40, "abc": 3}
    for _ in range(300):
        value = "".join(rng.choice(["pass", "Word", "abc", "qwe", "aaa", "x", "Z", "-", "7", "dragon", "ab"]) for _ in range(rng.randrange(1, 6)))
        assert abs(secret_scan.log_guesses(value, words) - cheapest(value, words)) < 1e-9, value
