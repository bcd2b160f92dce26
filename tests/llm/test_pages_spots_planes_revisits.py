"""Main text, fingerprints, id files and revisits."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rowloom.llm import bit_planes as bp
from rowloom.llm import revisits as rv
from rowloom.llm import site_style as sy
from rowloom.llm import spot_signatures as sp
from rowloom.llm.word_encoder import Encoder
from tests.llm import odd

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("a < b <3", "a < b <3"),
        ("<p>one<p>two <b>bo</b>ld<br>three", "one two bold three"),
        ("<ul><li>a<li>b</ul>", "a b"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
        ("<script>if (a<b) '</p>'</script><style>p{}</style>x", "x"),
        ("<!-- <p>no</p> -->yes<!-- open", "yes"),
        ("<nav>m</nav><article><header><h1>T</h1></header><p>x&nbsp;y</p><aside>n</aside></article><footer>f</footer>", "T x y"),
        ("<body class='nav-open'><main><p>m</p></main><p>outside</p>", "m"),
        ("<main><p>a long main text</p><article>card</article></main><p>o</p>", "a long main text card"),
        ("<main><p>m</p><article>the article</article></main><p>o</p>", "the article"),
        ("<article><p>a</p></article><article class='comment'>c</article>", "a"),
        ("<div id=comments><p>c</p></div><div class=post-content>hello</div>", "hello"),
        ("<div class='ad'>only an advert</div>", "only an advert"),
        ("<p>a <span class='advert'>zz</span>b</p><form>f<input>g</form>", "a b"),
        ("<div hidden>h</div><div style='display: none'>i</div><div aria-hidden=true>j</div>k", "k"),
        ("<article><p>cut off", "cut off"),
        ("<p>a</div></span></p>b", "a b"),
        ("<article><h1>t &am</h1><p>é&#233;&eacute;</p>", "t &am ééé"),
        ("<div>" * 200 + "deep" + "</div>" * 200, "deep"),
    ],
)
def test_text_of_one_page(html, text):
    assert sy.Page(html).main_text(frozenset()) == text


def test_formulas_are_text():
    tex = "<semantics><mrow><msup><mi>x</mi><mn>2</mn></msup><mo>=</mo><mn>4</mn></mrow><annotation>x^2=4</annotation></semantics>"
    assert sy.Page("<article>Let <math><mi>x</mi></math> be</article>").main_text(frozenset()) == "Let x be"
    assert sy.Page(f"<p>If <math>{tex}</math>, then</p>").main_text(frozenset()) == "If x2=4, then"
    assert sy.Page("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable></math>").main_text(frozenset()) == "1 2"


BODY = odd.prose(77, 90)


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<div class=content-sidebar-wrap><article>{BODY}</article><div class=sidebar>s</div></div><p>by us</p>", f"{BODY}"),
        ("<div class=layout-sidebar-right><article>short</article></div><p>longer than the article</p>", "short"),
        (f"<div class=layout-sidebar-right><div class=page-with-menu><div>{BODY}</div><nav>n</nav></div></div><p>by us</p>", f"{BODY} by us"),
        (f"<div class=text-widget>{BODY}</div><div class=text-widget>{BODY}</div><h1>T</h1>", f"{BODY} {BODY} T"),
        (f"<article>{BODY}</article><div class=related-posts><article>card</article></div>", BODY),
        (f"<div>{BODY}</div><div id=comments><div class=comment-list>{BODY} {BODY}</div></div>", BODY),
        ("<p>a text</p><div class=ad>a longer advert than that</div>", "a text"),
        ("<div class=comments><article class=comment>c</article></div><p>a</p>", "a"),
    ],
)
def test_named_noise_is_a_prior(html, text):
    assert sy.Page(html).main_text(frozenset()) == text


def test_repeated_text_under_a_noisy_name_is_cut(spark):
    body = [odd.prose(i, 90) for i in range(8)]
    rows = [(i, "http://wp.example/", f"<div class=content-sidebar-wrap><div><p>{b}</p></div><div class=end>Kept for us</div></div>") for i, b in enumerate(body)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in sy.main_texts(frame).collect()} == dict(enumerate(body))


def site(host, n, seed):
    pick = random.Random(seed)
    out = {}
    for i in range(n):
        body = [odd.prose(pick.randrange(10**6), 25) for _ in range(pick.randint(2, 5))]
        out[i] = (
            f"http://{host}/p{i}",
            "<body><div class=top><div>Home</div><div>Shop</div></div><div class=text>"
            + "".join(f"<div>{b}</div>" for b in body)
            + "</div><div class=bottom><p>All rights kept</p><p>Write to us</p></div></body>",
            " ".join(body),
        )
    return out


def test_unnamed_repeated_parts_are_cut_by_the_tree(spark):
    pages = site("one.example", 40, 1)
    rows = [(i, url, html, "x", "y") for i, (url, html, _) in pages.items()]
    rows += [(1000 + i, url, html, "x", "y") for i, (url, html, _) in site("two.example", 2, 9).items()]  # too few pages
    rows += [(2000 + i, "http://copies.example/", "<div>same page</div>", "x", "y") for i in range(30)]
    rows += [(3000, None, None, "x", "y"), (3001, "not a url", "", "x", "y"), (None, "http://one.example/", None, None, None)]
    rows += [(3002, "http://one.example/a", "<article>" + "long " * 50_000 + "</article>", "x", "y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string, cut string").repartition(4)
    found = sy.main_texts(frame).collect()
    assert len(found) == len(rows)
    got = {r.page_id: r.text for r in found}
    assert {i: got[i] for i in pages} == {i: text for i, (_, _, text) in pages.items()}
    assert got[1000].startswith("Home Shop") and got[2000] == "same page"
    assert got[3000] == got[3001] == got[None] == "" and got[3002] == " ".join(["long"] * 50_000)
    assert all(r.n_chars == len(r.text) for r in found)
    assert sy.main_texts(frame.limit(0)).collect() == []


def test_text_beside_a_teaser_goes_by_its_importance(spark):
    rows, want = [], {}
    for i in range(12):
        body, card, thin = odd.prose(i, 120), odd.prose(500 + i, 5), odd.prose(900 + i, 4)
        top = "<div class=top><p>All rights kept</p></div>"
        rows.append((i, "http://big.example/", f"{top}<div class=text><p>{body}</p></div><article>{card}</article>"))
        rows.append((100 + i, "http://thin.example/", f"{top}<main>{thin}</main><div class=text><p>{body}</p></div>"))
        want |= {i: f"{body} {card}", 100 + i: f"{thin} {body}"}
    rows.append((200, "http://one.example/", f"<div class=text>{body}</div><article>{card}</article>"))
    rows.append((201, "http://two.example/", f"<div class=text>{card}</div><article>{body}</article>"))
    want |= {200: f"{body} {card}", 201: body}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in sy.main_texts(frame).collect()} == want


def test_classes_may_hold_slashes(spark):
    rows, want = [], {}
    for i in range(8):
        body = odd.prose(i, 60)
        column = f"<div class='md:w-2/3'><article class=post>{body}</article></div>"
        rows.append((i, "http://wind.example/", f"<div class=wrap>{column}<div class=same><p>All rights kept</p></div></div>"))
        rows.append((100 + i, "http://near.example/", f"<div class=a>Same everywhere</div><div class=a/b>{body}</div>"))
        want |= {i: body, 100 + i: body}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in sy.main_texts(frame).collect()} == want


def plain_cut(tree, threshold, gamma, min_pages):
    """The cut elements by a walk from the deepest level up."""
    weighed, out = {}, set()
    for r in sorted(tree, key=lambda r: -r.depth):
        inside = [weighed[c.host, c.element] + (c.share,) for c in tree if c.host == r.host and c.parent == r.element]
        part = gamma**r.children
        value = (1 - part) * r.own + part * sum(v * share for v, _, _, share in inside) if inside else r.own
        value = {1: 0.0, 2: 1.0}.get(r.named, value)
        best, texts = max([value, *(b for _, b, _, _ in inside)]), r.element.endswith("/#text") or any(t for _, _, t, _ in inside)
        weighed[r.host, r.element] = value, best, texts
        if best < threshold and texts and r.pages >= min_pages and r.named == 0:
            out.add((r.host, r.element))
    return out


def test_depth_is_not_bounded(spark):
    pick = random.Random(5)
    rows, want = [], {}
    for i in range(8):
        body = odd.prose(i, 60)
        inside = f"<div class=top>All rights kept</div><div class=text>{body}</div><div class=end>Write to us</div>"
        rows.append((i, "http://deep.example/", "<div>" * 30 + inside + "</div>" * 30))
        want[i] = body
        parts = "".join(f"<{t}>{pick.choice(['same', 'like', str(pick.random())])}" + f"</{t}>" * pick.randint(0, 1) for t in pick.choices(["div", "ul", "section", "nav", "article"], k=25))
        rows.append((100 + i, "http://odd.example/", parts))
    rows.append((300, "http://bomb.example/", "<div class=abcdefgh>" * 400 + "deep"))
    want[300] = "deep"
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in sy.main_texts(frame).collect()}
    assert {i: got[i] for i in want} == want
    tree = sy.style_tree(sy.elements(sy.with_host(frame.filter("page_id < 300")))).cache()
    for threshold in (0.2, 0.5):
        cut = {tuple(r) for r in sy.cut_elements(tree, threshold, 0.9, 3).collect()}
        assert cut and cut == plain_cut(tree.collect(), threshold, 0.9, 3)


def test_importance_is_entropy(spark):
    pages = [("h", i, f"<div><p>{'same' if i < 4 else i}</p></div>" + ("<ul><li>x</ul>" if i % 2 else "")) for i in range(8)]
    frame = spark.createDataFrame(pages, "host string, page long, html string")
    tree = {r.element: r for r in sy.style_tree(sy.elements(frame)).collect()}
    assert tree["/div"].pages == 8 and tree["/ul"].pages == 4 and abs(tree["/div"].own) < 1e-12
    text = tree["/div/p/#text"].own  # one word on 4 pages, four on one page each
    assert abs(text - (1 - 4 * np.log(4) / 8 / np.log(8))) < 1e-9
    assert abs(tree["/ul/li/#text"].own) < 1e-9
    assert abs(tree["/div"].share - (4 * 1 + 4 * 0.5) / 8) < 1e-9


def edited(data):
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for n, (i, text, *_) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        yield i, text, text[: len(text) - half] + after[:half], after


def test_fingerprints_of_odd_documents(spark):
    data = [r for r in odd.rows() if r[0] not in (106, 108, None)] + [(106, odd.prose(6, 20_000), "en", "a"), (None, "no id", "en", "a")]
    rows = {r.doc_id: r for r in sp.fingerprints(odd.documents(spark, data)).collect()}
    assert len(rows) == len(data)
    known = sp.WordMarks(sp.ANCHORS)
    spots = lambda t: set(sp.spots(t, known).tolist())
    like = lambda a, b: len(a & b) / len(a | b)
    for i, text, changed, after in edited(data):
        own, row = spots(text), rows[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.fingerprint == "".join(f"{s:08x}" for s in sorted(own))
        assert abs(row.near_edited - like(own, spots(changed))) < 1e-12 and abs(row.near_next - like(own, spots(after))) < 1e-12
    assert rows[104].fingerprint == rows[105].fingerprint == rows[1].fingerprint


def test_every_repeated_row_gets_a_fingerprint(spark):
    data = odd.rows()
    rows = sp.fingerprints(odd.documents(spark, data)).collect()
    assert collections.Counter((r.doc_id, r.n_chars) for r in rows) == collections.Counter((i, len(t or "")) for i, t, _, _ in data)
    assert sp.fingerprints(odd.empty(spark)).collect() == []
    one = sp.fingerprints(odd.documents(spark, [(1, "one text of the day", "en", "a")])).collect()
    assert [r.near_next for r in one] == [1.0]


def test_near_pairs_are_all_pairs(spark):
    pick = random.Random(3)
    data = []
    for i in range(60):
        words = odd.prose(i // 6, 120 + (i // 6) * 7).split()
        for _ in range(i % 6):
            words[pick.randrange(len(words))] = "other"
        data.append((i, " ".join(words), "en", "a"))
    data += [(100, data[0][1], "en", "a"), (101, None, "en", "a"), (None, data[1][1], "en", "a")]
    members, pairs = sp.near_pairs(odd.documents(spark, data), 0.7)
    known = sp.WordMarks(sp.ANCHORS)
    sets = {i: frozenset(sp.spots(t or "", known).tolist()) for i, t, _, _ in data if i is not None}
    names = {s: min(i for i in sets if sets[i] == s) for s in sets.values()}
    assert {r.doc_id: r.class_id for r in members.collect() if r.doc_id is not None} == {i: names[s] for i, s in sets.items()}
    want = {(names[a], names[b]) for a in names for b in names if names[a] < names[b] and len(a & b) >= 0.7 * len(a | b) - 1e-9}
    assert want and {(r.a, r.b) for r in pairs.collect()} == want


def test_jaccard_skips_by_length():
    a, b = np.arange(10), np.arange(5)
    assert sp.jaccard(a, b) == 0.5 and sp.jaccard(a, b, 0.6) == 0.0


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("top", [0, 1, 200, 255, 256, 50_256, 2**24, 2**32 - 1])
def test_planes_round_trip(kind, top):
    pick = np.random.default_rng(top)
    for n in (1, 7, 8, 1000):
        ids = pick.integers(0, top + 1, n, dtype=np.uint64).astype("<u4")
        width, planes = bp.to_planes(ids, kind)
        assert (bp.from_planes(planes, n, width, kind) == ids).all() and len(planes) == width * (8 if kind == "bit" else 1)


@pytest.mark.parametrize("kind, block", [("byte", 1000), ("bit", 64)])
def test_id_files_round_trip(spark, tmp_path, kind, block):
    data = sorted((r for r in odd.rows() if r[0] not in (None, 108)), key=lambda r: r[0])
    path = str(tmp_path / "ids")
    rows = bp.round_trip(odd.documents(spark, data), TOKENIZER, path, block=block, kind=kind).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    at, want, ids_of = 0, [], {}
    for i, text, _, _ in data:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at, ids_of[i] = at + len(ids), ids
    assert sorted(map(tuple, rows)) == want
    sizes = [r.n_ids for r in spark.read.parquet(f"{path}/blocks").collect()]
    assert max(sizes) == block and sum(sizes) == at
    assert {r.doc_id: r.ids for r in bp.read_ids(spark, path).collect()} == ids_of


def test_id_files_without_documents_and_ids(spark, tmp_path):
    assert bp.round_trip(odd.empty(spark), TOKENIZER, str(tmp_path / "a")).collect() == []
    rows = bp.round_trip(odd.documents(spark), TOKENIZER, str(tmp_path / "b")).collect()
    assert len(rows) == len(odd.rows()) and len({r.start for r in rows}) == len(rows)
    last = max(r.start for r in rows if r.doc_id is not None)
    assert all(r.start > last for r in rows if r.doc_id is None)


def test_word_encoder_is_the_library():
    own, library = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    assert own.words is not None
    pick = random.Random(4)
    chars = [chr(c) for c in range(0x260)] + list("漢字😀٣ѐ")
    weights = [20 if c in " \n'sTtdlrevm.09a" else 1 if ord(c) < 0x250 else 0.05 for c in chars]
    texts = ["".join(pick.choices(chars, weights, k=pick.randint(0, 30))) for _ in range(4000)]
    texts += ["a<|endoftext|>b", "", " ", "\n\n  x", "don't we'll I'VE 12³ x"]
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    other = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.words is None


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTP://WWW.Example.ORG:80/a/B/?b=2&utm_source=x&a=1#top", "example.org/a/B?a=1&b=2"),
        ("https://example.org", "example.org/"),
        ("https://user@example.org:443/?ref=x", "example.org/"),
        ("https://example.org:8080//", "example.org:8080/"),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(rv.canonical_url(frame.url)).first()[0] == want


FIELDS = "record_id long, url string, captured long, kind string, status int, etag string, last_modified string"


def records(spark, rows):
    frame = spark.createDataFrame(rows, f"{FIELDS}, headers map<string,string>, canonical_url string, payload string")
    return frame.repartition(3)


def test_revisits_against_a_plain_loop(spark):
    pick = random.Random(8)
    rows = []
    for n in range(600):
        kind = pick.choice(["response", "revisit"])
        url = "http://hot.example/" if n % 3 else f"http://e{n % 7}.example/x?utm_a={n}"
        etag = pick.choice([None, "", '"1"', 'W/"1"', '"2"'])
        rows.append((n, url, pick.randrange(200), kind, pick.choice([200, 200, 404]), etag, pick.choice([None, "m1", "m2"]),
                     {"Date": str(n), "X": "a"} if kind == "response" else {"date": str(n), "x": "b"}, "z", f"p{n}"))
    rows += [(1000, None, 5, "revisit", 304, '"1"', None, None, None, None), (1001, "http://hot.example/", None, "revisit", 304, '"1"', None, None, None, None)]
    rows += [(1002, None, 1, "response", 200, '"1"', None, None, None, "p"), (1003, "http://hot.example/", 500, "revisit", 304, '"2"', None, {}, None, None)]
    want = {}
    plain = lambda t: (t or "").removeprefix("W/") or None
    for i, url, at, kind, _, etag, changed, headers, _, _ in rows:
        if kind != "revisit":
            continue
        same = lambda u: u is not None and u.split("?")[0] == (url or "").split("?")[0]
        old = [r for r in rows if r[3] == "response" and r[4] == 200 and same(r[1]) and at is not None and r[2] is not None and r[2] < at]
        found = max(old, key=lambda r: (r[2], r[0]), default=None)
        if found is None:
            want[i] = ("no_earlier_response", None, None)
            continue
        mine, theirs = (plain(etag), plain(found[5])) if plain(etag) else (changed, found[6])
        outcome = "no_validator" if not mine or not theirs else "resolved" if mine == theirs else "validator_mismatch"
        good = outcome == "resolved"
        want[i] = (outcome, found[0] if good else None, {"date": (headers or {}).get("date", str(found[0])), "x": "a"} if good else None)
    out = rv.resolve_revisits(records(spark, rows), carried=("payload",)).collect()
    assert {r.record_id: (r.outcome, r.refers_to, r.headers) for r in out} == want
    assert {o for o, _, _ in want.values()} == {"resolved", "validator_mismatch", "no_validator", "no_earlier_response"}
    assert all(r.payload == (None if r.refers_to is None else f"p{r.refers_to}") for r in out)
    assert rv.resolve_revisits(records(spark, rows).limit(0)).collect() == []
