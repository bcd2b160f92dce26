"""The n-gram model against a plain one of words and dictionaries."""

import collections
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.llm import kneser_ney as kn
from tests.llm import odd
from tests.util import rows


def words_of(text):
    return [*(text or "").encode().lower().split(), "<end>"]


class Plain:
    """Interpolated modified Kneser-Ney by definition."""

    def __init__(self, texts, order):
        self.order, self.raw = order, collections.Counter(w for t in texts for w in words_of(t))
        self.counts = {}
        found = collections.Counter()
        for t in texts:
            own = ["<s>"] * (order - 1) + words_of(t)
            found.update(tuple(own[i - order + 1 : i + 1]) for i in range(order - 1, len(own)))
        self.counts[order] = found
        for k in range(order - 1, 0, -1):
            before, found = self.counts[k + 1], collections.Counter()
            for gram, n in before.items():
                found[gram[1:]] += n if gram[1] == "<s>" else 1
            self.counts[k] = found
        self.taken, self.context = {}, {}
        for k, found in self.counts.items():
            times = collections.Counter(found.values())
            self.taken[k] = (0.0, *kn.discounts(*(times[i] for i in (1, 2, 3, 4))))
            self.context[k] = collections.defaultdict(list)
            for gram, n in found.items():
                self.context[k][gram[:-1]].append(n)

    def p(self, gram):
        if not gram:
            return 1 / (len(self.raw) + 1)
        k, lower = len(gram), self.p(gram[1:])
        follow = self.context[k].get(gram[:-1])
        if not follow:
            return lower
        taken, total = self.taken[k], sum(follow)
        n = self.counts[k].get(gram, 0)
        return (n - taken[min(n, 3)]) / total + sum(taken[min(f, 3)] for f in follow) / total * lower

    def score(self, text):
        own = ["<s>"] * (self.order - 1) + words_of(text)
        return sum(math.log10(self.p(tuple(own[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(own)))


def test_texts_without_words_in_common():
    assert kn.tokens("A b").tolist() == kn.tokens("a\x0bB ").tolist() != kn.tokens("\u00c4 b").tolist()


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 1


@pytest.mark.parametrize("order, part_bytes", [(2, 1 << 24), (2, 2000), (3, 2000), (4, 9000)])
def test_scores_against_the_plain_model(spark, order, part_bytes):
    """Also with many parts and spread contexts."""
    data = [r for r in odd.rows() if len(r[1] or "") < 50_000]
    data += [(500 + i, "the of " * (i % 7) + odd.prose(i, 30), "en", "a") for i in range(40)]
    plain = Plain([r[1] for r in data if not is_held_out(r[0])], order)
    docs = odd.documents(spark, data)
    model = kn.train(docs, order, part_bytes)
    assert model.words.total == sum(plain.raw.values()) and model.words.grams == len(plain.raw)
    if part_bytes == 2000:
        assert model.parts > 2 and len(model.frequent) > 1
    got = sorted(kn.scored(docs, model).collect(), key=lambda r: repr(tuple(r)[:4]))
    want = []
    total, kinds = sum(plain.raw.values()), len(plain.raw)
    for doc_id, text, *_ in data:
        own = words_of(text)
        base = sum(math.log10((plain.raw[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        want.append((doc_id, is_held_out(doc_id), len(own), sum(plain.raw[w] > 0 for w in own), total, base, plain.score(text)))
    want.sort(key=lambda r: repr(r[:4]))
    for r, w in zip(got, want, strict=True):
        assert tuple(r)[:5] == w[:5]
        assert math.isclose(r.base_score, w[5], rel_tol=1e-9) and math.isclose(r.score, w[6], rel_tol=1e-9)
        assert math.isclose(r.perplexity, 10 ** (-w[6] / w[2]), rel_tol=1e-9)


def test_probabilities_after_a_context_sum_to_one(spark):
    data = [(i, odd.prose(i, 40), "en", "a") for i in range(30)]
    model = kn.train(odd.documents(spark, data), 3)
    known = sorted({w for r in data if not is_held_out(r[0]) for w in r[1].split()})
    hashes = [int(kn.tokens(w)[0]) for w in known]
    for context in ("the", "of the", "never seen", "zz the"):
        own = kn.tokens(context)[:-1][-2:].tolist()
        own = [int(kn.START)] * (2 - len(own)) + own
        flat, at = [], []
        for h in [*hashes, int(kn.END), 12345]:  # the last one is the unknown word
            flat += [*own, h]
            at.append(len(flat) - 1)
        p = 10 ** model.log10(np.array(flat, np.uint64), np.array(at))
        assert math.isclose(p.sum(), 1, rel_tol=1e-9) and (p > 0).all()


def test_a_better_model_than_word_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = kn.scored(docs, kn.train(docs)).filter("held_out").groupBy().sum("score", "base_score", "n_tokens").first()
    assert got[0] > got[1] + 0.1 * got[2]


def test_nothing_to_learn_from(spark):
    data = [(None, "a b", "en", "a"), (None, None, None, None)]
    docs = odd.documents(spark, data)
    found = kn.scored(docs, kn.train(docs)).select("n_tokens", "n_known", "train_tokens", "base_score", "score")
    assert rows(found) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert kn.scored(odd.empty(spark), kn.train(odd.empty(spark))).count() == 0


def test_very_long_texts_and_small_batches(spark, monkeypatch):
    docs = odd.documents(spark)
    whole = rows(kn.scored(docs, kn.train(docs)), "doc_id", "n_tokens", "n_known")
    monkeypatch.setattr(kn, "HELD", 50)
    monkeypatch.setattr(kn, "SCORED", 50)
    assert rows(kn.scored(docs, kn.train(docs, part_bytes=5000)), "doc_id", "n_tokens", "n_known") == whole
    assert max(r[1] for r in whole) == 20_001


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 300)), min_size=1, max_size=80), st.integers(1, 5))
def test_pieces_come_back(pairs, k):
    words = np.array([7 + 2**60 * (w % 16) for w, _ in pairs] * k, np.uint64).reshape(-1, k)
    counts = np.array([n for _, n in pairs])
    grams, back = kn.unpacked(kn.packed(words, counts))
    assert sorted(zip(map(tuple, grams.tolist()), back.tolist())) == sorted(zip(map(tuple, words.tolist()), counts.tolist()))


def test_tables_with_great_counts(tmp_path):
    keys = np.arange(3, 3000, 3).astype(np.uint64)
    values = np.stack([keys % 5, keys * 10**6, np.where(keys % 7 == 0, 254, 255)], axis=1).astype(np.int64)
    kn.write_table(f"{tmp_path}/t/0", keys, values)
    asked = np.arange(0, 3010).astype(np.uint64)[::-1]
    got = kn.looked_up(str(tmp_path), "t", np.where(asked > 1500, 1, 0), asked, 3)
    want = {int(k): v for k, v in zip(keys, values.tolist())}
    assert got.tolist() == [want.get(int(a), [0] * 3) if a <= 1500 else [0] * 3 for a in asked]


def test_discounts():
    assert kn.discounts(0, 0, 0, 0) == (0.5, 1.0, 1.5)
    y = 10 / (10 + 8)
    assert kn.discounts(10, 4, 2, 1) == (1 - 2 * y * 4 / 10, 2 - 3 * y * 2 / 4, 3 - 4 * y * 1 / 2)


def test_refused(spark):
    with pytest.raises(ValueError):
        kn.train(odd.empty(spark), order=1)
    with pytest.raises(ValueError):
        kn.local_folder("s3a://bucket/shared")
    assert kn.local_folder("file:///a%20b/c") == "/a b/c" and kn.local_folder("/a%20b") == "/a%20b"
