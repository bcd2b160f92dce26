"""Near copies against all pairs, classes of rows with odd ids, and times of archives."""

import collections
import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from rowloom.llm import pigeon_simhash as ps
from rowloom.llm.revisits import resolve_revisits
from tests.llm import odd
from tests.util import rows


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def alike_pairs(texts, least):
    """Pairs of texts with at least that similarity, by the shingles they share."""
    sets, having = [shingles(t) for t in texts], collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            having[g].append(i)
    shared = collections.Counter(p for own in having.values() for p in itertools.combinations(own, 2))
    return [(a, b) for (a, b), n in shared.items() if n >= least * (len(sets[a]) + len(sets[b]) - n)]


def classes_of(pairs):
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in list(root)}


def test_recall_of_near_copies(spark):
    """Of the texts that are no least of their class, at least nine in ten go; nothing goes that is unlike all others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    data = sorted((r.doc_id, r.text) for r in docs.collect())
    pairs = alike_pairs([t for _, t in data], 0.8)
    surplus = {data[i][0] for i, root in classes_of(pairs).items() if i != root}
    kept = {r.doc_id for r in ps.one_of_each(docs).collect()}
    gone = {i for i, _ in data} - kept
    assert len(surplus & gone) >= 0.9 * len(surplus) and len(surplus) > 50
    near = {data[i][0] for pair in pairs if data[pair[0]][1] != data[pair[1]][1] for i in pair}
    texts = collections.defaultdict(list)
    for i, t in data:
        texts[t].append(i)
    unlike = {i for i in surplus & near if len(texts[dict(data)[i]]) == 1}
    assert unlike and len(unlike & gone) >= 0.9 * len(unlike)  # copies with changes, not only equal texts
    loose = {data[i][0] for pair in alike_pairs([t for _, t in data], 0.7) for i in pair}
    assert gone <= loose


def edited(words, seed):
    pick = random.Random(seed)
    out = list(words)
    out[pick.randrange(len(out))] = f"new{seed}"
    return " ".join(out)


def test_a_large_group_of_near_copies_is_one_class(spark):
    words = odd.prose(3, 200).split()
    data = [(i, edited(words, i)) for i in range(400)] + [(1000 + i, odd.prose(50 + i, 200)) for i in range(100)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    kept = {r.doc_id for r in ps.one_of_each(docs).collect()}
    assert {i for i in kept if i >= 1000} == set(range(1000, 1100)) and len(kept) <= 105 and 0 in kept
    marked = ps.stored(ps.fingerprints(docs, text_hash=True), "test-bits")
    assert ps.near_copies(docs, marked, 0.8).count() <= 2 * 8 * 400  # never all pairs


def test_all_texts_of_a_key_that_are_alike_are_in_one_class(spark, monkeypatch):
    """Walks of many small changes from common beginnings: most pairs are alike neither to the least text nor to a neighbour."""
    monkeypatch.setattr(ps, "BLOCK", 8)
    data = []
    for origin in range(4):
        for walk in range(12):
            words, pick = odd.prose(700 + origin, 150).split(), random.Random(f"{origin} {walk}")
            for step in range(9):
                words[pick.randrange(150)] = f"w{walk}x{step}"
                data.append((len(data), " ".join(words)))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    marked = ps.stored(ps.fingerprints(docs, text_hash=True), "test-bits")
    bits = {r.own_text: r.bits for r in marked.collect()}
    links = [(r.a, r.b) for r in ps.near_copies(docs, marked, 0.8).collect()]
    root = classes_of([*links, *((b, b) for b in bits.values())])
    own = ps.sketches(docs).collect()
    having = collections.defaultdict(set)
    for i, r in enumerate(own):
        for k in r["keys"]:
            having[k].add(i)
    met = {p for some in having.values() for p in itertools.combinations(sorted(some), 2)}
    alike = [(own[a], own[b]) for a, b in met if ps.jaccard(own[a].least, own[b].least) >= 0.8]
    assert len(alike) > 400 and all(root[bits[a.own_text]] == root[bits[b.own_text]] for a, b in alike)
    known = {own[i].own_text: own[i].least for i in range(len(own))}
    texts = collections.defaultdict(list)
    for t, b in bits.items():
        texts[b].append(t)
    assert all(any(ps.jaccard(known[x], known[y]) >= 0.8 for x in texts[a] for y in texts[b]) for a, b in links)


def test_similarities_of_blocks(spark):
    pick = random.Random(5)
    common = [pick.randrange(2**64) for _ in range(400)]
    sets = [sorted({*pick.sample(common, n), *(pick.randrange(2**64) for _ in range(n // 5))})[: ps.SKETCH]
            for n in (1, 2, 30, 100, 200, 213, 214, 220, 300, 400, 400)]
    least = [ps.np.array(v, "<u8").tobytes() for v in sets]
    found = ps.similarities(least[:6], least)
    assert found.shape == (6, 11) and all(found[i, j] == ps.jaccard(least[i], least[j]) for i in range(6) for j in range(11))
    assert all(ps.similarities(least, least)[i, i] == 1 for i in range(11))


@pytest.mark.parametrize("sizes", [(10, 10, 5), (300, 280, 250), (2000, 2000, 1800), (256, 256, 200), (1, 1, 0)])
def test_similarity_by_least_hashes(sizes):
    pick = random.Random(sum(sizes))
    a, b, both = sizes
    numbers = [pick.randrange(2**64) for _ in range(a + b - both)]
    x, y = numbers[:a], numbers[a - both : a - both + b]
    least = lambda v: ps.np.array(sorted(v)[: ps.SKETCH], "<u8").tobytes()
    found, true = ps.jaccard(least(x), least(y)), len(set(x) & set(y)) / len(set(x) | set(y))
    assert found == true if max(a, b) <= ps.SKETCH - 1 else abs(found - true) < 0.1


def test_chains_let_every_pair_within_the_budget_pass(spark):
    pick = random.Random(1)
    pairs = []
    for _ in range(500):
        a, b = pick.randrange(2**64), 0
        for bit in pick.sample(range(64), pick.randrange(0, 30)):
            b |= 1 << bit
        pairs.append((a - 2**63, (a ^ b) - 2**63))
    df = spark.createDataFrame(pairs, "a long, b long")
    for a, b, kept in df.select("a", "b", ps.chains(F.col("a"), F.col("b"), 14)).collect():
        count = ((a + 2**63) ^ (b + 2**63)).bit_count()
        assert kept if count <= 14 else True
    assert 0 < df.filter(~ps.chains(F.col("a"), F.col("b"), 14)).count() < 500


def test_classes_of_near_copies_take_few_queries(spark, monkeypatch):
    """Every query leaves plans, threads and broadcasts with the driver, however small the tables."""
    kept = []
    monkeypatch.setattr(ps, "stored", lambda df, purpose, f=ps.stored: kept.append(purpose) or f(df, purpose))
    words = odd.prose(4, 120).split()
    data = [(i, edited(words, i)) for i in range(30)] + [(100 + i, odd.prose(90 + i, 120)) for i in range(10)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert {r.doc_id for r in ps.one_of_each(docs).collect()} == {0, *range(100, 110)}
    assert len(kept) <= 15


def test_rows_of_one_id_with_two_texts(spark):
    a, b = odd.prose(1, 60), odd.prose(2, 60)
    docs = spark.createDataFrame([(1, a), (1, b), (5, b), (7, a), (7, a)], "doc_id long, text string")
    assert sorted(tuple(r) for r in ps.one_of_each(docs).collect()) == sorted([(1, a), (1, b)])
    found = rows(ps.near_duplicates(docs), "doc_id", "component_id")
    assert found == [(1, 1), (1, 1), (5, 1), (7, 1), (7, 1)]
    both = odd.documents(spark)
    assert sum(r.doc_id == 108 for r in ps.one_of_each(both).collect()) == 2


def test_a_row_without_id_carries_a_class_on(spark):
    """Its fingerprint lies between two others that are not linked themselves."""
    marked = spark.createDataFrame([(3, 0b0000), (None, 0b0011), (9, 0b1111), (None, 0x7777 << 40)], "doc_id long, bits long")
    found = {(r.doc_id, r.bits): r.component_id for r in ps.classed(ps.stored(marked, "test-bits")).collect()}
    assert found == {(3, 0): 3, (None, 3): 3, (9, 15): 3, (None, 0x7777 << 40): None}


KIND = "record_id long, url string, captured {}, kind string, status int, etag string, last_modified string, headers map<string,string>"
START = datetime.datetime(2024, 1, 1)


@pytest.mark.parametrize(
    "kind, times",
    [
        ("string", ["2024-01-01T00:00:09Z", "2024-01-01T00:00:10Z", "2024-01-01T00:00:11Z"]),
        ("string", ["9", "10", "11"]),
        ("string", ["20240101000009", "20240101000010", "20240101000011"]),
        ("long", [9, 10, 11]),
        ("double", [9.5, 10.0, 10.5]),
        ("timestamp", [START + datetime.timedelta(seconds=s) for s in (9, 10, 11)]),
        ("timestamp_ntz", [START + datetime.timedelta(seconds=s) for s in (9, 10, 11)]),
        ("date", [datetime.date(2024, 1, d) for d in (9, 10, 11)]),
    ],
)
def test_times_of_every_kind(spark, kind, times):
    url = "http://a.example/x"
    data = [(1, url, times[0], "response", 200, '"e"', None, {}), (2, url, times[1], "response", 200, '"e"', None, {}),
            (3, url, times[2], "revisit", 304, '"e"', None, {}), (4, url, times[0], "revisit", 304, '"e"', None, None)]
    found = rows(resolve_revisits(spark.createDataFrame(data, KIND.format(kind))), "record_id", "outcome", "refers_to")
    assert found == [(3, "resolved", 2), (4, "no_earlier_response", None)]


def test_texts_that_are_no_time(spark):
    url = "http://a.example/x"
    data = [(1, url, "soon", "response", 200, '"e"', None, {}), (2, url, "", "revisit", 304, '"e"', None, {}),
            (3, url, None, "revisit", 304, '"e"', None, {}), (4, url, "2024-01-02", "revisit", 304, '"e"', None, {})]
    found = rows(resolve_revisits(spark.createDataFrame(data, KIND.format("string"))), "record_id", "outcome")
    assert found == [(2, "no_earlier_response"), (3, "no_earlier_response"), (4, "no_earlier_response")]
