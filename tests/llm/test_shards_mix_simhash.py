"""Sharding, mixing and SimHash against brute force, and on odd rows."""

import collections
import math
import re
import zlib

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.llm import minimax_shards as ms
from rowloom.llm import pigeon_simhash as ps
from rowloom.llm.poisson_mix import poisson_mix, target_rates
from tests.llm import odd
from tests.util import NO_PYTHON, plan


def smallest_capacity(sizes, shards):
    def fits(capacity):
        used, at = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if at + s > capacity:
                used, at = used + 1, 0
            at += s
        return used <= shards

    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=300), st.integers(1, 9), st.integers(2, 40))
def test_capacity_search_is_exact_with_any_summary(sizes, shards, summary):
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]

    def ranges(spans):
        width = max(1, -(-sum(b - a + 1 for a, b in spans) // summary))
        found = collections.defaultdict(list)
        for e in ends:
            for number, (a, b) in enumerate(spans):
                if a <= e <= b:
                    found[number, e // width].append(e)
        return [ms.Range(min(v), max(v), len(v)) for v in found.values()]

    before = ms.summary
    ms.summary = lambda groups, spans: ranges(spans)
    try:
        capacity, cuts = ms.cut_at(None, ends[-1], shards)
    finally:
        ms.summary = before
    assert capacity == smallest_capacity(sizes, shards)
    assert cuts[-1] == ends[-1] and all(c in ends for c in cuts)
    assert max(b - a for a, b in zip([0, *cuts], cuts, strict=False)) == capacity


def test_shards_of_odd_documents(spark):
    data = odd.rows()
    found = ms.minimax_shards(odd.documents(spark), 4).collect()
    assert len(found) == len(data)
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in data)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    where = collections.defaultdict(set)
    slots = collections.defaultdict(list)
    for r in found:
        where[r["size"], r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in where.values())  # equal texts are together
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for i, t, _, _ in data:
        own = groups.setdefault(t or "", [math.inf, 0])
        own[0], own[1] = min(own[0], math.inf if i is None else i), own[1] + len((t or "").encode()) + 1
    sizes = [s for _, s in sorted(groups.values())]
    total = collections.Counter()
    for r in found:
        total[r.shard] += r["size"]
    assert max(total.values()) == smallest_capacity(sizes, 4)


def test_no_documents(spark):
    none = odd.empty(spark)
    assert ms.minimax_shards(none).collect() == []
    assert poisson_mix(none).collect() == []
    assert ps.near_duplicates(none).collect() == []
    assert ps.one_of_each(none).columns == none.columns and ps.one_of_each(none).count() == 0


def test_mix_reaches_the_weights(spark):
    docs = spark.createDataFrame(
        [(i, f"t{i}", "big" if i % 10 else None) for i in range(4000)], "doc_id long, text string, source string"
    )
    weights = {"big": 0.5, None: 0.5}
    out = poisson_mix(docs, weights)
    rows = out.collect()
    shares = collections.Counter(r.source for r in rows)
    assert abs(shares[None] / len(rows) - 0.5) < 0.05 and abs(len(rows) - 4000) < 300
    by_doc = collections.Counter((r.doc_id, r.source) for r in rows)
    rates = {r.source: r.rate for r in target_rates(docs, weights, 0.5, 1.0).collect()}
    assert rates == {"big": 2000 / 3600, None: 2000 / 400}
    zero = 3600 - sum(1 for _, s in by_doc if s == "big")
    assert abs(zero / 3600 - math.exp(-rates["big"])) < 0.04  # the share of a Poisson distribution's zeros
    assert sorted(map(tuple, poisson_mix(docs, weights).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    assert sorted(map(tuple, poisson_mix(docs, weights, seed="x").collect()), key=repr) != sorted(map(tuple, rows), key=repr)
    order = [r.doc_id for r in rows]
    assert order != sorted(order)
    assert not any(p in plan(out) for p in NO_PYTHON)


def test_large_rates_and_zero_weights(spark):
    docs = spark.createDataFrame([(i, "t", "s" if i else "z") for i in range(40)], "doc_id long, text string, source string")
    rows = poisson_mix(docs, {"s": 1.0}, epochs=1000.0).collect()
    assert {r.source for r in rows} == {"s"} and abs(len(rows) - 40_000) < 1500


def test_mix_of_odd_documents(spark):
    docs = odd.documents(spark)
    out = poisson_mix(docs, epochs=30.0)
    assert set(out.columns) == set(docs.columns)
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert got == {(i, t) for i, t, _, _ in odd.rows()}
    plain = poisson_mix(docs, epochs=30.0, counted=False)
    assert plain.columns == docs.columns and {r.copy for r in plain.collect()} == {"x"}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if bin(prints[a] ^ prints[b]).count("1") <= ps.MAX_BITS:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_fingerprints_and_classes_of_odd_documents(spark):
    data = [r for r in odd.rows() if r[0] != 108]
    rows = ps.near_duplicates(odd.documents(spark, data)).collect()
    assert len(rows) == len(data)
    texts = {i: t or "" for i, t, _, _ in data if i is not None}
    want = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows if r.doc_id is not None} == want
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == components(want)
    assert len({r.fingerprint for r in rows if r.doc_id is None}) == 2


def test_links_are_all_pairs_within_two_bits(spark):
    import random

    pick = random.Random(5)
    prints = {0}
    for _ in range(30):
        base = pick.getrandbits(64)
        prints.add(base)
        for _ in range(30):
            other = base
            for _ in range(pick.randint(1, 4)):
                other ^= 1 << pick.randrange(64)
            prints.add(other)
    signed = [p - 2**64 if p >= 2**63 else p for p in sorted(prints)]
    frame = spark.createDataFrame([(p,) for p in signed], "bits long")
    got = {(r.a, r.b) for r in ps.links(frame).collect()}
    far = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    want = {(a, b) for a in signed for b in signed if a < b and far(a, b) <= 2}
    assert got == want
    labels = spark.createDataFrame([(p, i) for i, p in enumerate(signed)], "bits long, label long")
    edges = spark.createDataFrame(list(want), "a long, b long")
    found = {r.bits: r.root for r in ps.components(labels, edges).collect()}
    own = components({i: p & (2**64 - 1) for i, p in enumerate(signed)})
    assert found == {p: own[i] for i, p in enumerate(signed)}


def test_a_long_chain_is_one_class(spark):
    n = 300
    order = [(i * 7919) % n for i in range(n)]
    labels = spark.createDataFrame([(i, order[i]) for i in range(n)], "bits long, label long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "a long, b long")
    assert {r.root for r in ps.components(labels, edges).collect()} == {0}


def test_classes_take_few_jobs_and_rows(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(ps, "stored", lambda df, purpose, f=ps.stored: kept.append(f(df, purpose)) or kept[-1])
    n = 3000
    labels = spark.createDataFrame([(i, i) for i in range(n)], "bits long, label long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "a long, b long").repartition(4)
    assert {r.root for r in ps.components(labels, edges).collect()} == {0}
    assert len(kept) <= 5
    assert sum(df.count() for df in kept) <= 4 * n


def test_classes_of_many_tasks_match_brute_force(spark, monkeypatch):
    import random

    pick = random.Random(8)
    monkeypatch.setattr(ps, "EDGES", 40)
    n = 700
    ends = [(i, i + 1) for i in range(200)]  # a chain, a star, single pairs, a loop and links given twice
    ends += [(250, i) for i in range(251, 400)] + [(3, 3), (420, 420), (5, 4)] + ends[:20]
    ends += [(pick.randrange(400, n), pick.randrange(400, n)) for _ in range(150)]
    pick.shuffle(ends)
    parent = list(range(n))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in ends:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    frame = spark.createDataFrame([(a * 2**40 - 2**48, b * 2**40 - 2**48) for a, b in ends], "a long, b long").repartition(8)
    labels = spark.createDataFrame([(i * 2**40 - 2**48, i) for i in range(n)], "bits long, label long")
    rows = ps.components(labels, frame).collect()
    assert len(rows) == n
    assert {(r.bits + 2**48) // 2**40: r.root for r in rows} == {i: top(i) for i in range(n)}


def test_one_of_each_keeps_every_class_once(spark):
    docs = odd.documents(spark)
    out = ps.one_of_each(docs)
    kept = out.collect()
    assert out.columns == docs.columns
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) + 1 and ids.count(108) == 2  # two texts of one id, none of which has a copy
    assert sum(r.doc_id is None for r in kept) == 2
    assert 104 not in ids and 105 not in ids and 1 in ids  # copies of document 1
