"""Runs on a grammar against all periods at all places."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.llm import grammar_runs as gr
from rowloom.llm.queries import planted
from tests.llm import odd
from tests.util import rows


def brute(words, least=24, exponent=3):
    """(start, length, period) of all runs: every period, every maximal stretch, the smallest period of a stretch."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i + q < len(words) and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                if i - start + q >= max(least, exponent * q):
                    found.setdefault((start, i + q), q)
                start = None
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def hashed(docs):
    return np.array([xxhash.xxh64_intdigest(w.encode()) for d in docs for w in d], np.uint64)


def check(docs, least=24):
    got = gr.find_runs(hashed(docs), np.array([len(d) for d in docs]), least)
    assert got == [brute(d, least) for d in docs]
    return got


REPEATED = st.lists(st.tuples(st.text("abc", min_size=1, max_size=7), st.integers(1, 12)), max_size=6)


@settings(deadline=None, max_examples=150)
@given(st.lists(REPEATED, min_size=1, max_size=4), st.sampled_from([3, 6, 24]))
def test_runs_of_small_documents(parts, least):
    check([list("".join(u * k for u, k in doc)) for doc in parts], least)


def test_runs_of_longer_documents():
    pick = random.Random(4)
    docs = []
    for _ in range(30):
        words = odd.prose(pick.randrange(10**6), pick.randrange(20, 300)).split()
        for _ in range(pick.randrange(3)):
            unit = [str(pick.randrange(5)) for _ in range(pick.randrange(1, 30))]
            repeat = (unit * 9)[: len(unit) * 3 + pick.randrange(5 * len(unit))]
            at = pick.randrange(len(words))
            words[at:at] = repeat
        docs.append(words)
    found = check([*docs, ["a"] * 1000, ["a", "b"] * 300 + ["a"], [], ["x"]])
    assert sum(map(len, found)) > 20


def test_nested_periods():
    inner = ["a", "b", "c"] * 9
    check([(inner + ["d"]) * 5, (["a"] * 24 + ["b"]) * 4, ["a"] * 23, ["a"] * 24, ["b", *["a"] * 24, "b"]])


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=5))
def test_grammar_is_one_of_the_texts(texts):
    """Every inner boundary stands once, equal symbols have equal words, and no pair of the sequence was left twice."""
    sizes = np.array([len(t) for t in texts])
    docs = np.repeat(np.arange(len(texts)), sizes)
    flat = [f"{d}{w}" for d, t in enumerate(texts) for w in t]
    _, symbols = np.unique(flat, return_inverse=True)
    g = gr.Grammar(symbols, docs, least=2)
    want = [i for i in range(1, len(flat)) if docs[i] == docs[i - 1]]
    assert sorted(g.inner.tolist()) == want
    words = {}
    for x, s, b, e in zip(g.symbol, g.start, g.inner, g.end, strict=True):
        assert words.setdefault(x, (flat[s:b], flat[b:e])) == (flat[s:b], flat[b:e])


def test_repeats_share_symbols():
    text = [str(i) for i in range(40)] * 8
    _, symbols = np.unique(text, return_inverse=True)
    g = gr.Grammar(symbols, np.zeros(len(text), int), least=24)
    assert len(np.unique(g.symbol)) < len(g.symbol) / 2


def test_equal_hashes_of_unlike_words_do_no_harm(monkeypatch):
    """If window hashes called everything equal, the word-by-word check would still leave only true runs."""
    docs = [list("abcabcabcabcxyzxyzxyzxyz") * 2, list("aabab" * 8)]
    monkeypatch.setattr(gr.Windows, "alike", lambda self, start, period, length: np.ones(len(start), bool))
    got = gr.find_runs(hashed(docs), np.array([len(d) for d in docs]), 6)
    for doc, runs in zip(docs, got, strict=True):
        assert set(runs) <= set(brute(doc, 6))


def plainly(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, milli, sha(lines), sha(kept)


def test_digests_of_odd_documents(spark):
    data = [r for r in odd.rows() if len(r[1] or "") < 50_000]
    data += [(300 + i, odd.prose(i, 150), "en", "a") for i in range(60)]
    data += [(400, "a " * 500, "en", "a"), (401, "x y " * 30 + "z " + "x y " * 30, "en", "a")]
    want = sorted((plainly(r[0], r[1]) for r in data), key=repr)
    assert rows(gr.digests(odd.documents(spark, data), edit=planted)) == want
    assert sum(r[1] > 0 for r in want) > 6
    assert gr.digests(odd.empty(spark)).count() == 0


def test_long_texts_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(gr, "CHUNK", 50)
    words = odd.prose(1, 3000).split()
    words[700:1900] = [words[700 + (i % 77)] for i in range(1200)]
    check([words[:40], words, words[:41]])


def test_fewer_periods_are_refused(spark):
    with pytest.raises(ValueError):
        gr.repeated_runs(odd.empty(spark), min_exponent=2)
