import time
from collections import Counter

import pytest

from anemora.llm import extraction
from anemora.llm.extraction import RUN, assemble, blocks, extract, shard_repeats, stream, suffix_array

SCHEMA = "page_id bigint, url string, html string, text int, n_chars string"

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header><p>Site name</p></header><nav><ul><li><a href="/x">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy  now</div>
<div id="cookie-notice">We use cookies</div><{main}><h1>Head &lt;1&gt;</h1><p><b>Bold
 text<br><p>caf&eacute;&nbsp;and&#32;&#x41;</p><div class="share-buttons">Share</div><form><p>Mail</p><input></form><ul><li>one<li>two</ul>
<aside>Side</aside></{main}><section class="comments"><p>First!</p></section><footer>&copy; host</footer></body></html>"""


@pytest.mark.parametrize("main", ["article", "main", "div role='main'"])
def test_main_text(main):
    html = PAGE.format(main=main).replace("</div role='main'>", "</div>")
    assert assemble(html, set())[0] == "Head <1>\nBold text\ncafé and A\none\ntwo"


def test_odd_markup():
    assert assemble("", set())[0] == "" and blocks("plain &amp text")[0] == ["plain & text"]
    assert assemble("<article><p title='a>b'>x<!-- > --> y</p><p>z", set())[0] == "x y\nz"
    assert assemble("<div><script>if (a<b) {}</script>left <textarea>no</textarea>right</div>", set())[0] == "left right"
    assert assemble("<p>a < b and c > d</p>", set())[0] == "a < b and c > d"
    assert assemble("<article>t<table><tr><td>1<td>2<tr><td>3</table></article>", set())[0] == "t\n1\n2\n3"


def test_suffix_array_orders_prefixes():
    import numpy as np
    tokens = np.array([3, 1, 2, 3, 1, 2, 4, 1, 2, 3], np.uint64)
    for depth in (1, 2, 3, 5):
        order, rank = suffix_array(tokens, depth)
        keys = [tuple(tokens[i:i + depth].tolist()) for i in range(len(tokens))]
        assert [keys[i] for i in order] == sorted(keys)
        assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(10) for j in range(10))


def test_shard_counts_pages_once():
    streams = ["a b c d e f g".split(), "x a b c d e f a b c d e f".split(), "a b".split(), [], "q r s t u v".split()]
    hashes, count = shard_repeats(streams)
    want = Counter()
    for s in streams:
        want.update({tuple(s[i:i + RUN]) for i in range(len(s) - RUN + 1)})
    assert sorted(count.tolist()) == sorted(want.values()) and len(set(hashes.tolist())) == len(want)


def _pages():
    menu, foot = "Start News Sport Money Culture Travel", "All rights reserved by this fine host"
    pages = []
    for i in range(30):
        body = "".join(f"<p>text number {i} part {k} says something new {i * k} here</p>" for k in range(3))
        pages.append((i, f"https://a.example/{i}", f"<div><span>{menu}</span></div><div>{body}</div><div>{foot}</div>", 0, "x"))
    pages += [(100 + i, f"http://b.example:80/{i}", f"<div>{menu}</div><article><p>{menu}</p><p>own {i}</p></article>", 0, "x") for i in range(2)]
    pages += [(200, None, None, 0, "x"), (201, "https://c.example", "", 0, "x"), (202, "https://c.example/2", f"<p>{menu}</p>", 0, "x"), pages[0], pages[0]]
    return pages


def brute(pages):
    """Main texts by counting every run of every page of a host."""
    hosts = {}
    for p in pages:
        host = (p[1] or "").split("/")[2].split(":")[0] if p[1] else ""
        hosts.setdefault(host, []).append(p)
    out = []
    for rows in hosts.values():
        runs = Counter()
        for p in rows:
            t = stream(p[2] or "")[0]
            runs.update({tuple(t[i:i + RUN]) for i in range(len(t) - RUN + 1)})
        need = max(min(3, len(rows)), -(-len(rows) // 4), 2)
        for p in rows:
            tokens, owner, texts, inside, marked, has_main = stream(p[2] or "")
            gone = [False] * len(tokens)
            for i in range(len(tokens) - RUN + 1):
                if runs[tuple(tokens[i:i + RUN])] >= need:
                    gone[i:i + RUN] = [True] * RUN
            for b in range(len(texts)):
                at = [i for i, o in enumerate(owner) if o == b]
                if not all(gone[i] for i in at):
                    while at:
                        n = 1
                        while n < len(at) and gone[at[n]] == gone[at[0]]:
                            n += 1
                        if n < RUN:
                            for i in at[:n]:
                                gone[i] = False
                        at = at[n:]
            kept = []
            for b, text in enumerate(texts):
                left = " ".join(t for t, o, g in zip(tokens, owner, gone) if o == b and not g)
                if inside[b] and not marked[b]:
                    kept.append(text)
                elif not has_main and not marked[b] and left:
                    kept.append(left)
            out.append((p[0], p[1], "\n".join(kept), len("\n".join(kept)), sum(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard, broadcast", [(512, 64 << 20), (4, 0)])
def test_extract_against_brute_force(spark, monkeypatch, shard, broadcast):
    monkeypatch.setattr(extraction, "SHARD_PAGES", shard)
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", broadcast)
    pages = _pages()
    got = sorted((tuple(r) for r in extract(spark.createDataFrame(pages, SCHEMA)).collect()), key=str)
    assert got == brute(pages)
    texts = {r[0]: r[2] for r in got}
    assert texts[0].startswith("text number 0") and "Start" not in texts[3] and "reserved" not in texts[3]
    assert texts[100] == "Start News Sport Money Culture Travel\nown 0" and texts[202] == "Start News Sport Money Culture Travel"
    assert extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_embedded_elements_keep_the_article():
    def text(html):
        return assemble(html, set())[0]

    assert text('<article><p>one <svg width="1"/>two</p><p>three</p></article>') == "one two\nthree"
    assert text("<article><p>one <svg><title>t</title><text>drawn</text></svg>two</p></article>") == "one two"
    assert text("<article><p>one <svg><text>drawn<p>two</p></article>") == "one\ntwo"
    assert text("<article><p>sum <math><mi>x</mi><mo>=</mo><mn>1</mn></math> here <math/>too</p></article>") == "sum x=1 here too"
    assert text("<article><p>a <object data='x'>instead</p><p>b</p></article>") == "a instead\nb"
    assert text("<article><p>a <canvas>chart of b</canvas></p><p>c</p></article>") == "a chart of b\nc"


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_boilerplate_of_a_section_goes(spark, monkeypatch, broadcast):
    """A box on a tenth of a host's pages goes; what few pages share and what shares only a phrase stays."""
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", broadcast)
    box = "<div><span>Our desk</span><ul><li>Rugby<li>Chess<li>Rowing<li>Darts</ul></div><div>Write to the desk of this section any day</div>"
    pages = []
    for i in range(300):
        own = f"<p>page {i} tells a story {i * 7} of its own</p>"
        shared = f"<p>{i} as everyone in this town will know by now {i}</p>" if i % 10 == 1 else ""
        few = "<p>a notice that only very few pages hold</p>" if i < 6 else ""
        pages.append((i, f"https://a.example/{i}", own + shared + few + (box if i % 10 == 0 else ""), 0, "x"))
    texts = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    for i in range(300):
        want = [f"page {i} tells a story {i * 7} of its own"]
        want += [f"{i} as everyone in this town will know by now {i}"] if i % 10 == 1 else []
        want += ["a notice that only very few pages hold"] if i < 6 else []
        assert texts[i] == "\n".join(want)


def _text(html):
    return assemble(html, set())[0]


def test_marks_are_names_not_values():
    assert _text('<p title="The hidden truth">a</p><p hidden>b</p><p data-x="hidden">c</p>') == "a\nc"
    assert _text('<article><p>a</p></article><div data-role="main"><p>long text that is not the main element</p></div>') != "long text that is not the main element"
    assert _text('<div><p>x y z</p></div><div role="main">main text</div>') == "main text"
    assert _text("<p style='color:red;display : none'>a</p><p>b</p><p aria-hidden=false>c</p><p ARIA-HIDDEN=true>d</p>") == "b\nc"


def test_parts_of_an_article_stay():
    assert _text("<article><figure><img><figcaption>A picture</figcaption></figure><fieldset><label>Field</label></fieldset><p>t</p></article>") == "A picture\nField\nt"
    # A header goes with its title, also inside the article; a bare heading stays.
    assert _text("<article><header><h1>Title</h1></header><h2>Part</h2><p>t</p></article>") == "Part\nt"


def test_main_element_is_the_one_with_text():
    assert _text('<main id="top"></main><div><p>the article follows</p></div>') == "the article follows"
    body = "<p>" + "body text " * 40 + "</p>"
    assert _text(f"<div>{body}</div><ul><li><article>teaser one</article><li><article>teaser two</article></ul>").startswith("body text")
    assert _text(f"<article><p>short</p></article><article>{body}</article>") == ("body text " * 40).strip()
    assert _text(f'<div class="related"><article>{body}</article></div><article><p>the article itself</p></article>') == "the article itself"


def test_weak_marks_yield():
    assert _text("<body><form><div><p>all of it</p></div></form></body>") == "all of it"
    assert _text('<section id="search-results"><p>one</p><p>two</p></section>') == "one\ntwo"
    assert _text('<p>text</p><div class="cookie-notice">We use cookies</div><form>Mail</form>') == "text"
    assert _text("<form><article><p>wrapped</p></article></form>") == "wrapped"
    assert _text("<form><article><p>wrapped</p><form>inner</form></article></form>") == "wrapped"


def test_open_quotes_are_no_markup():
    assert _text('<p class="x>one</p><p class="y">two</p>') == "one\ntwo"
    assert _text('<p class="x>one</p><p>two</p>') == "one\ntwo"
    assert _text("<p title=\"a > b\">one</p><p title='=\"'>two</p>") == "one\ntwo"
    assert _text("<p>one</p><p>two <b") == "one\ntwo"


ODD = {
    "open scripts": "<script ", "closed scripts": "<script></scrip", "quotes": '<a x="b c\'', "open quotes": '<p class="x>y', "apostrophes": "<a b='c>", "brackets": "<", "comments": "<!--",
    "attributes": 'x y="1" ', "equals": "= ", "depth": "<b><div>", "paragraphs": "<p><b>", "lists": "<ul><li>", "titles": "<title>x</title ", "drawings": "<svg><g>", "references": "&amp", "rows": "<tr><td>",
}


@pytest.mark.parametrize("name", ODD)
@pytest.mark.parametrize("head, tail", [("", ""), ("<a ", ">"), ("<div>" * 1000 + "<b>" * 50_000, "</p>" * 10_000)])
def test_time_grows_with_the_page(name, head, tail):
    def seconds(size):
        page = head + ODD[name] * (size // len(ODD[name])) + tail
        start = time.process_time()
        blocks(page)
        return time.process_time() - start

    small, large = seconds(125_000), seconds(1_000_000)
    # Eight times the page; a quadratic search would take sixty-four times as long.
    assert large < 20 * small + 1
