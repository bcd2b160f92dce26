"""Attributes that look like noise and are not, and trees that decide without names."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from rowloom.llm import site_style as ss

BODY = "The quick brown fox jumps over the lazy dog near the old mill."


@pytest.mark.parametrize(
    "html",
    [
        f'<article data-hidden-fields="0"><p>{BODY}</p></article>',
        f'<article><p title="The hidden valley">{BODY}</p></article>',
        f'<article data-id="footer" data-content-role="banner" data-style="display:none"><p>{BODY}</p></article>',
        f"<article data-x='class=\"ad\" hidden'><p>{BODY}</p></article>",
        f'<article><p data-class="ad" xid="nav">{BODY}</p></article>',
        f'<article hidden="false"><p>{BODY}</p></article>',
    ],
)
def test_only_an_attribute_itself_says_noise(html):
    assert ss.Page(html).main_text(frozenset()) == BODY


def test_links_and_headings_keep_their_words():
    html = '<article><h2 id="navigation">Navigation of ships</h2><p>See <a title="a hidden gem" href="/x">this</a>.</p><h2 id="related-work">Related work</h2></article>'
    assert ss.Page(html).main_text(frozenset()) == "Navigation of ships See this. Related work"


@pytest.mark.parametrize(
    "noise",
    ['<div class="alert">Sale</div>', '<div class="adbox">Sale</div>', '<div class="usercomments">Sale</div>', "<video>Sale</video>",
     "<p hidden>Sale</p>", '<p aria-hidden="true">Sale</p>', '<p HIDDEN=hidden>Sale</p>', '<p style="display : none">Sale</p>',
     '<div id=sidebar>Sale</div>', "<div role='navigation'>Sale</div>", '<div title=x class = "nav">Sale</div>'],
)
def test_noise_goes(noise):
    assert ss.Page(f"<article><p>{BODY}</p>{noise}</article>").main_text(frozenset()) == BODY


def site(seed, n=12):
    """Pages without any names: a menu of varying entries, prose, a side list and a footer with a counter."""
    pick = random.Random(seed)
    entries = ["Home", "About us", "Prices", "Contact", "Help desk", "Our shops"]
    out = []
    for i in range(n):
        words = " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randrange(2, 7))) for _ in range(80))
        menu = "".join(f'<li><a href="/{e}">{e}</a></li>' for e in entries if pick.random() < 0.8)
        body = f"<div><p>{words}</p></div>"
        foot = f"<div><div><p>All rights are with the house since long ago, page {pick.randrange(10**6)} of many</p></div></div>"
        out.append((i, f"http://h{seed}.x/{i}", f"<body><ul>{menu}</ul>{body}{foot}</body>", words))
    return out


def test_the_tree_alone_cuts_what_pages_share(spark):
    """Words kept that are of the text, and words of the text that are kept."""
    pages = [page for seed in range(4) for page in site(seed)]
    df = spark.createDataFrame([(100 * k + p[0], p[1], p[2]) for k, p in enumerate(pages)], "page_id long, url string, html string")
    good = got = want = 0
    by_url = {p[1]: p[3] for p in pages}
    for row in ss.main_texts(df).collect():
        kept, true = Counter(row.text.split()), Counter(by_url[row.url].split())
        good, got, want = good + (kept & true).total(), got + kept.total(), want + true.total()
    assert good / got >= 0.95 and good / want >= 0.95


def plain_tree(pages):
    """(host, element) -> pages, own importance and share, by definition over all pages in memory."""
    shown = defaultdict(list)
    for host, html in pages:
        page = ss.Page(html)
        for element, (parent, _) in page.places.items():
            features = set() if element in page.protected or element in page.noisy else page.features.get(element, set())
            shown[host, element].append((tuple(sorted(page.children[element])), features, 1 / len(page.children[parent]), parent))
    out = {}
    for (host, element), seen in shown.items():
        m = len(seen)
        styles, features = Counter(s for s, *_ in seen), Counter(f for _, fs, *_ in seen for f in fs)
        if m == 1:
            own = 1.0
        elif features:
            own = 1 - sum(c * math.log(c) for c in features.values()) / sum(features.values()) / math.log(m)
        else:
            own = -sum(c / m * math.log(c / m) for c in styles.values()) / math.log(m)
        above = len(shown.get((host, seen[0][3]), seen))
        out[host, element] = (m, own, sum(s for *_, s, _ in seen) / above)
    return out


def test_style_tree_by_definition(spark):
    pages = [(f"h{seed}.x", p[2]) for seed in range(3) for p in site(seed, 5)]
    pages += [("h9.x", f"<body><article><p>{re.sub('e', 'i' * k, BODY)}</p></article><nav>a b</nav></body>") for k in range(3)]
    df = spark.createDataFrame([(i, f"http://{h}/{i}", html) for i, (h, html) in enumerate(pages)], "page_id long, url string, html string")
    found = {(r.host, r.element): (r.pages, r.own, r.share) for r in ss.style_tree(ss.elements(ss.with_host(df))).collect()}
    want = plain_tree(pages)
    assert found.keys() == want.keys()
    for key, (m, own, share) in want.items():
        assert found[key][0] == m and math.isclose(found[key][1], own, abs_tol=1e-9), key
        assert math.isclose(found[key][2], share, abs_tol=1e-9), key
