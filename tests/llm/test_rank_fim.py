"""Fill-in-the-middle through a rank index against plain slicing."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.llm import rank_fim as rf
from tests.llm import odd
from tests.util import rows

TEXT = st.text(st.sampled_from("ab é漢😀\n<PSM>"), max_size=120)


@settings(deadline=None, max_examples=80)
@given(st.lists(st.integers(1, 4), max_size=400), st.integers(1, 9))
def test_every_boundary_is_exact_and_no_prediction_is_off_by_more(widths, error):
    offsets = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)]).astype(np.int64)
    index = rf.RankIndex.fit(offsets, error)
    assert [index.offset(k) for k in range(len(offsets))] == offsets.tolist()
    assert np.abs(index.residuals.astype(int)).max() <= error
    again = rf.RankIndex.unpacked(index.packed())
    assert [again.offset(k) for k in range(len(offsets))] == offsets.tolist()


def test_texts_of_one_width_take_one_segment_and_mixed_ones_few():
    plain = rf.RankIndex.fit(rf.boundaries(b"a" * 10_000))
    assert len(plain.firsts) == 1 and not plain.residuals.any()
    mixed = rf.RankIndex.fit(rf.boundaries(("a" * 3000 + "漢" * 3000 + "é" * 3000).encode()))
    assert 2 < len(mixed.firsts) < 200 and mixed.residuals.dtype == np.int8


@settings(deadline=None, max_examples=60)
@given(TEXT)
def test_boundaries_of_units(text):
    data = text.encode()
    chars = rf.boundaries(data)
    assert [data[a:b].decode() for a, b in zip(chars, chars[1:], strict=False)] == list(text)
    lines = rf.boundaries(data, "line")
    assert [data[a:b] for a, b in zip(lines, lines[1:], strict=False)] == data.splitlines(True) if "\r" not in text else True
    words = rf.boundaries(data, "word")
    found = [data[a:b].split() for a, b in zip(words, words[1:], strict=False)]
    assert [w for f in found for w in f] == data.split() and all(len(f) == 1 for f in found)


def plainly(doc_id, text):
    """The contract by slicing the string."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    text = text or ""
    n = len(text)
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_odd_documents_against_slicing(spark):
    data = odd.rows() + [(200 + i, t, "en", "a") for i, t in enumerate(["a <P> b", "<<S>M>", "<S", "<<<<PS", "M>" * 30])]
    docs = odd.documents(spark, data)
    want = sorted(((r[0], *plainly(r[0], r[1])) for r in data), key=repr)
    assert rows(rf.fill_in_middle(docs)) == want
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    digests = sorted(((r[0], sha(plainly(*r[:2])[-1]), sha(r[1])) for r in data), key=repr)
    assert rows(rf.digests(docs), "doc_id", "output_sha256", "restored_sha256") == digests
    assert rf.digests(odd.empty(spark)).count() == 0


@settings(deadline=None, max_examples=100)
@given(TEXT, st.integers(0, 10_000))
def test_cut_texts(text, doc_id):
    got = rf.cut(text.encode(), doc_id)
    assert (*got[:-1], got[-1].decode()) == plainly(doc_id, text)


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_texts_come_back_with_every_unit(spark, unit):
    docs = odd.documents(spark)
    made = rf.fill_in_middle(docs, unit, seed="other", error=300)
    back = made.select("doc_id", rf.restored(made.output, made.form).alias("text"))
    assert rows(back) == sorted(((r[0], r[1] or "") for r in odd.rows()), key=repr)
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}


def test_stored_indexes_find_any_cut(spark):
    texts = {r[0]: r[1] or "" for r in odd.rows() if r[0] not in (None, 108)}
    for row in rf.rank_indexes(odd.documents(spark)).collect():
        if row.doc_id in texts:
            index, text = rf.RankIndex.unpacked(row.asDict()), texts[row.doc_id]
            for k in {0, len(text) // 3, len(text)}:
                assert index.offset(k) == len(text[:k].encode())


def test_unknown_units_and_errors_are_refused(spark):
    with pytest.raises(ValueError):
        rf.boundaries(b"a", "page")
    with pytest.raises(ValueError):
        rf.fill_in_middle(odd.empty(spark), error=40_000)
