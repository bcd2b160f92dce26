"""Decontamination, quality and toxicity."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import ordinal_quality as oq
from rowloom.llm import spaced_seeds as ss
from rowloom.llm import toxic_cnn as tc
from tests.llm import odd

SF = "/root/testdata/sf0.01"


def items(spark):
    rows = [(i, odd.prose(1000 + i, 25 + i)) for i in range(8)] + [(50, None), (51, ""), (52, "too short"), (None, odd.prose(7, 30))]
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, key string")


def test_passages_with_replaced_words_are_found(spark):
    pick = random.Random(2)
    rows, want = [], set()
    for n in range(60):
        item = n % 8
        words = odd.prose(1000 + item, 25 + item).split()
        for at in pick.sample(range(len(words)), n % 5):
            words[at] = "changed"
        rows.append((n, odd.prose(5000 + n, 40) + " . " + " ".join(words).upper() + ", " + odd.prose(6000 + n, 30), "en", "a"))
        want.add((n, item))
    rows += [(100 + n, odd.prose(8000 + n, 200), "en", "a") for n in range(40)]  # clean prose of the same words
    found = ss.contaminated(odd.documents(spark, rows), items(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all(r.similarity >= 0.8 and r.doc_start >= 35 for r in found)


def test_odd_documents_hold_nothing_and_stay(spark):
    docs, benchmark = odd.documents(spark), items(spark)
    assert ss.contaminated(docs, benchmark).filter("item_id IS NOT NULL").collect() == []
    kept = ss.without_leaks(docs, benchmark.filter("item_id IS NOT NULL"))
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert ss.contaminated(odd.empty(spark), benchmark).collect() == []
    assert ss.without_leaks(docs, benchmark.limit(0)).count() == docs.count()


def test_leaking_rows_go_with_their_copies(spark):
    leak = odd.prose(1, 30) + " " + odd.prose(1003, 28)
    rows = [(1, leak, "en", "a"), (2, leak, "en", "a"), (None, leak, "en", "a"), (3, odd.prose(3, 50), "en", "a")]
    docs = odd.documents(spark, rows)
    found = ss.contaminated(docs, items(spark)).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in found) == [(0, 3), (1, 3), (2, 3)]
    assert [r.doc_id for r in ss.without_leaks(docs, items(spark)).collect()] == [3]


def test_short_and_unspaced_items_are_found(spark):
    nine = "alpha beta gamma delta epsilon zeta eta theta iota".split()
    ten = "one two three four five six seven eight nine ten".split()
    chinese, japanese = "今天天气很好我们一起去公园散步吧", "すべての人間は生まれながらにして自由である"
    bench = [(1, " ".join(nine)), (2, " ".join(ten)), (3, "quick red fox"), (4, chinese), (5, japanese)]
    rows = [(1, " ".join(["other", *nine[1:]])), (2, " ".join(["x", "y", *ten[2:]])), (3, "A quick red fox."), (4, "他说" + chinese + "。")]
    rows += [(5, "はい" + japanese.replace("自由", "平等")), (6, "quick fox red"), (7, " ".join(["x", *nine[1:7], "y", "z"])), (8, "今天我们去学校")]
    docs = odd.documents(spark, [(*r, "en", "a") for r in rows])
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in ss.contaminated(docs, benchmark).collect()) == [(i, i) for i in range(1, 6)]
    assert sorted(r.doc_id for r in ss.without_leaks(docs, benchmark).collect()) == [6, 7, 8]


@pytest.mark.parametrize("equal, want", [("1111", (0, 4)), ("0110", (1, 3)), ("1101111100000", (0, 8)), ("000", (0, 0))])
def test_longest_like_stretch(equal, want):
    assert ss.longest_like(np.array([c == "1" for c in equal]), 0.8) == want


def test_longest_like_stretch_by_trying_all():
    pick = np.random.default_rng(1)
    for _ in range(200):
        equal = pick.random(pick.integers(1, 30)) < 0.7
        first, last = ss.longest_like(equal, 0.8)
        spans = [(j - i) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1) if equal[i:j].mean() >= 0.8 - 1e-9]
        trimmed = max(spans, default=0)
        assert last - first <= trimmed and (not spans or equal[first:last].mean() >= 0.8 - 1e-9)


def test_registered_leaks_are_the_exact_passages(spark):
    import re

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in ss.contaminated(docs, bench).collect()}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    found = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench.collect() if plain(b.text) in plain(d.text)}
    assert found and got >= found and len(got) <= len(found) + 2


def test_ordinal_gradient_climbs_to_ordered_thresholds():
    texts, grades = [], []
    for i in range(300):
        grade = i % 3
        texts.append(odd.prose(i, 30) + " " + " ".join(["vile"] * (2 - grade) + ["fine"] * grade) + ("!!! ###" if not grade else ""))
        grades.append(grade * 10)
    model = oq.fit(texts, grades)
    assert model.grades == [0, 10, 20] and model.cuts[0] < model.cuts[1]
    tails = model.tails(texts, oq.WordBuckets())
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert np.mean((tails > 0.5).sum(axis=1) * 10 == np.array(grades)) > 0.9


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    model = oq.train(docs, oq.ratings(labels.filter("doc_id % 2 = 0")))
    rows = [r for r in oq.graded(docs, model).collect() if r.doc_id in known and r.doc_id % 2]
    right = [r.accepted == bool(known[r.doc_id]) for r in rows]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in rows)


def test_quality_of_odd_documents(spark):
    docs = odd.documents(spark)
    rated = spark.createDataFrame([(i, i % 2 if i != 7 else None) for i in range(30)] + [(None, 1), (999, 1)], "doc_id long, grade int")
    model = oq.train(docs, rated, max_rows=20)
    out = oq.graded(docs, model).collect()
    assert len(out) == docs.count() and all(r.accepted is not None for r in out)
    nothing = oq.train(docs, rated.limit(0))
    assert all(r.accepted for r in oq.graded(docs, nothing).collect())
    kept = oq.accepted_rows(docs, nothing)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert oq.graded(odd.empty(spark), model).collect() == []


def test_quality_is_fitted_without_texts_on_the_driver(spark):
    data = [(i, f"{odd.prose(i, 30)} {'fine' if i % 2 else 'vile'}") for i in range(60)] + [(99, "so it goes " * 100_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    rated = spark.createDataFrame([(i, i % 2) for i, _ in data], "doc_id long, grade int")
    assert oq.sampled(docs, rated, 100).toArrow().nbytes < 100_000
    order = docs.join(rated, "doc_id").orderBy(F.xxhash64("doc_id")).collect()
    want, got = oq.fit([r.text for r in order], [r.grade for r in order]), oq.train(docs, rated)
    assert np.array_equal(got.weights, want.weights) and np.array_equal(got.cuts, want.cuts) and got.grades == want.grades


def test_toxicity_is_learnt_and_never_from_held_out_rows(spark):
    import zlib

    bad = ["scumword", "trashword", "moronword"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        words = odd.prose(i, 40).split()
        if toxic:
            words[i % 40] = bad[i % 3]
        rows.append((i, " ".join(words), "en" if i % 2 else "fr", "a"))
        out = zlib.crc32(str(i).encode()) % 4 == 2
        labels.append((i, int(toxic) if not out else int(not toxic), 0))  # held-out labels lie
    docs = odd.documents(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    model = tc.train(docs, marks)
    out = {r.doc_id: r for r in tc.scored(docs, model).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in out.items() if r.held_out} == set(held)
    assert np.mean([(out[i].score >= 0.3) == (i % 5 == 0) for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.flagged == (r.score >= r.threshold) for r in out.values())


def test_toxicity_of_odd_documents(spark):
    docs = odd.documents(spark)
    labels = spark.createDataFrame([(i, i % 2 if i != 3 else None, "x") for i in range(30)] + [(None, 1, "x")], "doc_id long, toxic int, score string")
    model = tc.train(docs, labels)
    out = tc.scored(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    alone = tc.train(docs, labels.filter("toxic = 0"))
    assert {r.score for r in tc.scored(docs.select("doc_id", "text"), alone).collect()} == {0.0}
    assert tc.scored(odd.empty(spark), model).collect() == []


def test_filters_stay_inside_their_text():
    words = tc.Vocabulary()
    docs = [tc.numbered(t, words) for t in ("a b c", "", "d")]
    row, starts, stands = tc.joined(docs)
    assert starts.tolist() == [0, 5, 8] and stands.tolist() == [True] * 3 + [False] * 2 + [True, False, False] + [True, False, False]
    random = np.random.default_rng(0)
    net = tc.Net([random.normal(size=(w, tc.SIZE, tc.FILTERS)) for w in tc.WIDTHS], [np.zeros(tc.FILTERS)] * 3,
                 random.normal(size=tc.FILTERS * 3), np.zeros(1))
    vectors = random.normal(size=(len(words.buckets), tc.SIZE))
    vectors[0] = 0
    together = net.numbers(vectors[row], starts, stands)
    for doc, number in zip(docs, together, strict=True):
        assert np.isclose(net.numbers(vectors[tc.joined([doc])[0]], *tc.joined([doc])[1:])[0], number)
