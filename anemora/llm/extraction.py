"""Main text of HTML pages: block structure, and boilerplate by suffix arrays over a host's pages."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Set
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.llm.common import Words, mix
from anemora.llm.markup import RAW, attributes, scan
from anemora.llm.substrings import rolled
from anemora.session import checkpoint_ready

#: Tokens from which on a repeated run counts as long; pages and share of a host's pages that must hold it.
RUN, PAGES, SHARE = 6, 3, 0.25
#: Different pages of a host from which on whole blocks repeated word for word are boilerplate, whatever the host's size.
BLOCK_PAGES = 16
#: Pages whose streams one suffix array holds.
SHARD_PAGES = 512

#: Tables of hosts (page counts, lists of repeated runs) up to this size are sent to all executors; larger ones are joined by host.
BROADCAST_BYTES = 64 << 20

# Elements by what they mean for the text: fixed values of the HTML standard.
_APART = frozenset("nav header footer aside menu dialog button select option head".split()) | frozenset(RAW)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul").split())
_MAIN = frozenset(("article", "main"))

# Words of class, id and role names that mark what is not the article: fixed values.
_MARKED = frozenset((
    "ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "copyright disqus footer form header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager "
    "pagination popup privacy promo promoted promotion recommended related reply replies respond search share sharing sidebar signup site-footer site-header "
    "skip social sponsor sponsored subscribe subscription tagcloud toolbar widget widgets alert contentinfo complementary").split())

# What a mark by an element's kind or names is worth; text under a weak mark counts if the page has none without.
_PLAIN, _FORM, _COMPOUND, _FIRM = range(4)
#: Share of a page's unmarked text that an article must hold to be its main element; shorter ones are teasers.
MAIN_SHARE = 0.25
_HIDES = re.compile(r"display\s*:\s*none", re.IGNORECASE)


def _mark(name: str, held: dict[str, str]) -> int:
    """How firmly an element is marked as none of the article."""
    if name in _APART or "hidden" in held or held.get("aria-hidden", "").strip().lower() == "true" or _HIDES.search(held.get("style", "")):
        return _FIRM
    found = _FORM if name == "form" else _PLAIN
    for word in f"{held.get('class', '')} {held.get('id', '')} {held.get('role', '')}".lower().split():
        if word in _MARKED:
            return _FIRM
        if any(part in _MARKED for part in re.split(r"[-_:]+", word)):
            found = _COMPOUND
    return found


class _Open:
    """The open elements: name, number of the main element, mark; where each name is open is known without a search."""

    def __init__(self):
        self.stack: list[tuple[str, int, int]] = []
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def push(self, name: str, main: int, mark: int) -> None:
        self.at[name].append(len(self.stack))
        if name in _BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((name, main, mark))

    def cut(self, depth: int) -> None:
        for name, _, _ in reversed(self.stack[depth:]):
            self.at[name].pop()
            if name in _BLOCK:
                self.blocks.pop()
        del self.stack[depth:]

    def last(self, name: str) -> int:
        return self.at[name][-1] if self.at[name] else -1

    def end_paragraph(self, name: str) -> None:
        """A new block ends an open paragraph, with what it holds; a list item or cell also ends the one before."""
        if self.blocks and self.stack[self.blocks[-1]][0] == "p":
            self.cut(self.blocks[-1])
        if name in _ENDS and self.last(name) > max(self.last(stop) for stop in _ENDS[name]):
            self.cut(self.last(name))


def blocks(html: str) -> tuple[list[str], list[bool], list[bool], bool]:
    """The page's text blocks in order: text, whether inside the main element, whether inside something marked; whether there is a main element.

    References are decoded, white space inside a block is one space, blocks without text are left out.
    Unclosed elements end with their parent; a paragraph ends where a block begins.  The main element is the outermost ``article``, ``main`` or
    role main with the most text, first among those that nothing marked holds; one that holds less than ``MAIN_SHARE`` of the unmarked text is none.
    A header goes with its title, inside the article too.  Where all text is under weak marks (a form, one word of a longer class name), the weakest
    of these are dropped, so a page wrapped in a form keeps its text.
    """
    texts, mains, marks = [], [], []
    open_, pending = _Open(), []
    firm_outside: list[int] = []  # of each main element, the mark it lies in

    def flush() -> None:
        text = "".join(pending)
        pending.clear()
        text = " ".join((unescape(text) if "&" in text else text).split())
        if text:
            texts.append(text)
            mains.append(open_.stack[-1][1] if open_.stack else -1)
            marks.append(open_.stack[-1][2] if open_.stack else _PLAIN)

    for kind, name, inner in scan(html):
        if kind == "text":
            if open_.last("svg") < 0:
                pending.append(name)
            continue
        block = name in _BLOCK
        # A block ends a drawing that is still open, as in HTML, but for what a foreignobject holds.
        if block and kind == "open" and (at := open_.last("svg")) > open_.last("foreignobject"):
            open_.cut(at)
        if block or name in _APART:
            flush()
        if kind == "close":
            if open_.at[name]:
                open_.cut(open_.last(name))
            continue
        if block:
            open_.end_paragraph(name)
        elif name == "br" or name == "img" or name == "input":
            pending.append(" ")
        if name in _VOID or not block and inner.endswith("/"):
            continue
        main, mark = open_.stack[-1][1:] if open_.stack else (-1, _PLAIN)
        held = attributes(inner) if inner else {}
        if name in _MAIN or held.get("role", "").strip().lower() == "main":
            if main < 0:
                main = len(firm_outside)
                firm_outside.append(mark)
                # Inside, only what lies inside marks; where it lies is weighed when the main element is chosen.
                mark = _PLAIN
            mark = max(mark, _mark("", held | {"role": ""}))
        elif name != "html" and name != "body":
            mark = max(mark, _mark(name, held))
        open_.push(name, main, mark)
    flush()
    chosen = _main(texts, mains, marks, firm_outside)
    if chosen < 0:
        marks = [max(mark, firm_outside[main]) if main >= 0 else mark for main, mark in zip(mains, marks)]
    within = [mark for main, mark in zip(mains, marks) if chosen < 0 or main == chosen]
    limit = min((m for m in within if m < _FIRM), default=_PLAIN)
    return texts, [chosen >= 0 and main == chosen for main in mains], [mark > limit for mark in marks], chosen >= 0


def _main(texts: list[str], mains: list[int], marks: list[int], outside: list[int]) -> int:
    """Number of the main element, or -1."""
    held = [0] * len(outside)
    free = 0
    for text, main, mark in zip(texts, mains, marks):
        if main >= 0 and mark < _FIRM:
            held[main] += len(text)
        if mark == _PLAIN and (main < 0 or outside[main] == _PLAIN):
            free += len(text)
    best = max(range(len(held)), key=lambda i: (held[i] > 0, -outside[i], held[i], -i), default=-1)
    if best < 0 or not held[best] or outside[best] == _FIRM or held[best] < MAIN_SHARE * free:
        return -1
    return best


_ENDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table", "tbody", "thead", "tfoot"}}


def stream(html: str) -> tuple[list[str], list[int], list[str], list[bool], list[bool], bool]:
    """Tokens outside the main element with their blocks, and the blocks."""
    texts, inside, marked, has_main = blocks(html)
    tokens, owner = [], []
    for i, text in enumerate(texts):
        if not inside[i]:
            words = text.split(" ")
            tokens += words
            owner += [i] * len(words)
    return tokens, owner, texts, inside, marked, has_main


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``depth`` tokens, and a class number per suffix; equal classes share these tokens.

    Ranks of 1, 2, 4, ... tokens are made from pairs of shorter ones.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    span = 1
    while span < depth:
        step = min(span, depth - span)
        after = np.full(len(rank), -1)
        after[:len(rank) - step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        span += step
    return np.argsort(rank, kind="stable"), rank


def _token_hashes(tokens: list[str]) -> np.ndarray:
    raw = "\n".join(tokens).encode()
    return Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _LINE).hashes()


_LINE = np.zeros(256, bool)
_LINE[10] = True


def shard_repeats(streams: list[list[str]], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``run`` tokens among some pages' streams, and in how many of the pages each is."""
    parts, pages = [], []
    for i, tokens in enumerate(streams):
        if len(tokens) >= run:
            parts.append(_token_hashes(tokens))
            pages.append(np.full(len(parts[-1]), i))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A mark of its own ends each page, so no run spans two pages.
    text = np.concatenate([np.append(p, mix(np.uint64([k + 1]))) for k, p in enumerate(parts)])
    page = np.concatenate([np.append(p, -1) for p in pages])
    order, rank = suffix_array(text, run)
    whole = np.flatnonzero(page[:max(0, len(page) - run + 1)] >= 0)
    whole = whole[page[whole + run - 1] == page[whole]]
    inner = np.zeros(len(text), bool)
    inner[whole] = True
    order = order[inner[order]]
    hashes = rolled(text, run)
    # Neighbours in the order agree in class; each page counts once per class.
    pair = np.unique(np.stack([rank[order], page[order]], axis=1), axis=0)
    classes, first, count = np.unique(pair[:, 0], return_index=True, return_counts=True)
    at = order[np.unique(rank[order], return_index=True)[1]]
    return hashes[at].view(np.int64), count


def covered(tokens: list[str], repeated: set[int], run: int = RUN) -> np.ndarray:
    """Which tokens lie in a repeated run."""
    edge = np.zeros(len(tokens) + 1, np.int64)
    if len(tokens) >= run and repeated:
        hit = np.flatnonzero([h in repeated for h in rolled(_token_hashes(tokens), run).view(np.int64).tolist()])
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + run, -1)
    return np.cumsum(edge[:-1]) > 0


def whole_runs(gone: np.ndarray, owner: list[int], run: int) -> np.ndarray:
    """Of the covered tokens those in blocks that are covered altogether, or in stretches of ``run`` tokens inside one block.

    A run that ends in the next block's first words does not take these along.
    """
    out = gone.copy()
    if not gone.any():
        return out
    edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1)) if len(owner) else []
    for a, b in zip(edges[:-1], edges[1:]):
        if gone[a:b].all():
            continue
        cuts = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0)) + a
        for i, j in zip(cuts[::2], cuts[1::2]):
            if j - i < run:
                out[i:j] = False
    return out


def spans(html: str, run: int = RUN) -> list[tuple[int, list[int]]]:
    """Hash and blocks of each least row of neighbouring whole blocks with ``run`` tokens or more; none on pages with a main element."""
    texts, inside, marked, has_main = blocks(html)
    if has_main:
        return []
    open_ = [i for i in range(len(texts)) if not marked[i]]
    words = [texts[i].count(" ") + 1 for i in open_]
    out = []
    for a in range(len(open_)):
        b, n = a, 0
        while b < len(open_) and n < run:
            n += words[b]
            b += 1
        if n >= run:
            out.append((xxhash.xxh64_intdigest("\n".join(texts[i] for i in open_[a:b]).encode("utf-8", "replace")) - (1 << 63), open_[a:b]))
    return out


def assemble(html: str, repeated: set[int], run: int = RUN, same: Set[int] = frozenset()) -> tuple[str, int]:
    """The page's main text and the tokens outside the main element that lie in repeated runs or in whole blocks of ``same``.

    Repeated runs and blocks go first.  What is left outside a main element counts only if the page has
    none, and what is marked as something else never counts.
    """
    tokens, owner, texts, inside, marked, has_main = stream(html)
    gone = whole_runs(covered(tokens, repeated, run), owner, run)
    if same:
        out = {i for h, some in spans(html, run) if h in same for i in some}
        gone |= np.array([i in out for i in owner], bool)
    left: dict[int, list[str]] = {}
    for token, block, out in zip(tokens, owner, gone.tolist()):
        if not out:
            left.setdefault(block, []).append(token)
    kept = []
    for i, text in enumerate(texts):
        if marked[i]:
            continue
        if inside[i]:
            kept.append(text)
        elif not has_main and i in left:
            kept.append(" ".join(left[i]))
    return "\n".join(kept), int(gone.sum())


def _sent(table: DataFrame, size: Column) -> DataFrame:
    """A table of hosts, written down and measured; sent to all executors if it is small, joined by host if not."""
    table = table.checkpoint()
    held = table.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(table) if held <= BROADCAST_BYTES else table


def _same_blocks(base: DataFrame, run: int) -> DataFrame:
    """``(_host, _page, same)``: the spans of each different page that ``BLOCK_PAGES`` different pages of its host hold.

    Spans are rows joined by host and hash, never a list for a host; a page's list is no longer than the page.
    """
    def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({h for h, _ in spans(html, run)}) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(found, pa.list_(pa.int64()))], ["host", "page", "spans"])

    rows = base.select("host", F.xxhash64("html").alias("page"), "html").mapInArrow(spans_of, "host string, page bigint, spans array<bigint>")
    rows = rows.select("host", "page", F.explode("spans").alias("span")).distinct().checkpoint()
    often = rows.groupBy("host", "span").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= BLOCK_PAGES).select(F.col("host").alias("_host"), F.col("span").alias("_span"))
    kept = rows.join(often, (F.col("host") == F.col("_host")) & (F.col("span") == F.col("_span")), "left_semi")
    lists = kept.groupBy("host", "page").agg(F.collect_list("span").alias("same")).select(F.col("host").alias("_host"), F.col("page").alias("_page"), "same")
    return _sent(lists, F.size("same") * 8 + F.octet_length("_host") + 16)


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", run: int = RUN, pages: int = PAGES, share: float = SHARE) -> DataFrame:
    """``page_id, url, text, n_chars, n_repeated`` of every page.

    A host's pages are dealt into shards of bounded size; each shard's suffix array finds its runs of ``run`` tokens and counts the pages of
    each, and the counts of all shards are summed, so a host with a third of all pages is many tasks and the result does
    not depend on the shards.  A run in at least ``pages`` pages and ``share`` of the host's pages (in both, if it has two) is boilerplate; its
    tokens are removed outside the main element (whole blocks, or stretches of a run's length inside a block), unique runs stay.  On pages without a main element neighbouring whole blocks of ``run`` tokens that
    ``BLOCK_PAGES`` different pages of the host hold word for word go too, so the boilerplate of one section of a large host does.  Inside an ``article`` or ``main`` element repeated
    passages are text: articles quote and copy each other.  Elements that by tag, class, id or role are menus, headers, footers, sidebars, notices, adverts,
    forms, comments, scripts or hidden are left out.

    Null and empty pages have an empty text; null urls are one host; repeated rows get equal texts and count as pages of their own;
    no rows give no rows.  Other columns are not carried along.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))
    kinds = dict(df.dtypes)
    base = df.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"), host.alias("host"))
    base = base.withColumn("mark", F.xxhash64("page_id", "url", "html"))
    checkpoint_ready(df.sparkSession)
    count = _sent(base.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")).select(F.col("host").alias("of"), "host_pages"), F.octet_length("of") + 8)

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [stream(h)[0] for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("mark"), pa.array(found, pa.list_(pa.string()))], ["host", "mark", "tokens"])

    streams = base.select("host", "mark", "html").mapInArrow(tokens_of, "host string, mark bigint, tokens array<string>")
    sharded = (
        streams.join(count, F.col("host") == F.col("of")).drop("of")
        .withColumn("shard", F.pmod(F.col("mark"), F.ceil(F.col("host_pages") / SHARD_PAGES)))
        .groupBy("host", "host_pages", "shard")
    )

    def find(rows: pa.Table) -> pa.Table:
        hashes, count = shard_repeats(rows.column("tokens").to_pylist(), run)
        n = len(hashes)
        head = [pa.array([rows.column(c)[0].as_py()] * n, rows.schema.field(c).type) for c in ("host", "host_pages", "shard")]
        return pa.table([*head, pa.array(hashes), pa.array(count.astype(np.int64))], names=["host", "host_pages", "shard", "run", "pages"])

    runs = sharded.applyInArrow(find, "host string, host_pages bigint, shard bigint, run bigint, pages bigint")
    enough = (F.col("pages") >= F.greatest(F.least(F.lit(pages), F.col("host_pages")), F.ceil(F.col("host_pages") * share))) & (F.col("pages") >= 2)
    repeated = runs.groupBy("host", "host_pages", "run").agg(F.sum("pages").alias("pages")).where(enough)
    # A run needs a share of the host's pages, so a host has no more of them than a page's length divided by the share.
    known = repeated.groupBy("host").agg(F.sort_array(F.collect_list("run")).alias("runs")).select(F.col("host").alias("of"), "runs")
    known = _sent(known, F.size("runs") * 8 + F.octet_length("of"))

    same = _same_blocks(base, run)

    def text_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, set[int]] = {}
        for batch in batches:
            texts, gone = [], []
            for h, name, runs_of, spans_of in zip(*(batch.column(c).to_pylist() for c in ("html", "host")), batch.column("runs"), batch.column("same")):
                if name not in sets:
                    sets = {name: set(runs_of.as_py() or ())}
                text, n = assemble(h, sets[name], run, frozenset(spans_of.as_py() or ()))
                texts.append(text)
                gone.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(gone, pa.int64())], ["page_id", "url", "text", "n_repeated"])

    pages_of = base.withColumn("page", F.xxhash64("html")).join(same, (F.col("host") == F.col("_host")) & (F.col("page") == F.col("_page")), "left")
    found = pages_of.join(known, F.col("host") == F.col("of"), "left").select("page_id", "url", "html", "host", "runs", "same").mapInArrow(
        text_of, f"page_id {kinds[key]}, url {kinds[url]}, text string, n_repeated bigint")
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_repeated")
