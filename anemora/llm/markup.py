"""Tags and text of HTML by one pass that reads every character a bounded number of times."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

#: Elements whose content is no markup: fixed values of the HTML standard.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe")

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
# Where an attribute's quoted value begins, or the tag ends.
_STOP = re.compile(r">|=\s*+[\"']")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")


def attributes(text: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name, references decoded; of a repeated one the first counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def scan(html: str) -> Iterator[tuple[str, str, str]]:
    """``("text", text, "")``, ``("open", name, attributes)`` and ``("close", name, "")`` in order; names in lower case.

    Comments, declarations and the content of ``RAW`` elements are left out.  A quote whose value runs into the next
    tag's (it ends in ``=``) or never ends is no quote: the tag ends at its first ``>``.  A tag that the page's end cuts off is
    dropped with what follows, as browsers do.  Every search starts where the last one ended or ends the page, so
    the time grows with the page's length, whatever it holds.
    """
    at, text, end = 0, 0, len(html)
    last = {'"': html.rfind('"'), "'": html.rfind("'")}
    last_end = html.rfind(">")
    while (start := html.find("<", at)) >= 0:
        at = start + 1
        mark = html[at:at + 1]
        if mark == "!" or mark == "?":
            if html.startswith("!--", at):
                stop, size = html.find("-->", at + 3), 3
            elif html.startswith("![CDATA[", at):
                stop, size = html.find("]]>", at + 8), 3
            else:
                stop, size = html.find(">", at), 1
            if start > text:
                yield "text", html[text:start], ""
            at = text = end if stop < 0 else stop + size
            continue
        name = _NAME.match(html, at + (mark == "/"))
        if name is None:
            continue
        if start > text:
            yield "text", html[text:start], ""
        if last_end < at:
            text = end
            break
        stop = _tag_end(html, name.end(), last)
        tag = name.group().lower()
        if mark == "/":
            yield "close", tag, ""
        else:
            if tag in _RAW_END:
                closing = _RAW_END[tag].search(html, stop + 1)
                stop = html.find(">", closing.end()) if closing else -1
                if stop < 0:
                    text = end
                    break
            else:
                yield "open", tag, html[name.end():stop]
        at = text = stop + 1
    if text < end:
        yield "text", html[text:], ""


def _tag_end(html: str, at: int, last: dict[str, int]) -> int:
    """Where the ``>`` of the tag is whose name ends at ``at``; there is one further on."""
    first = at
    while True:
        stop = _STOP.search(html, at)
        if stop is None:
            return html.find(">", first)
        if stop.group() == ">":
            return stop.start()
        quote = html[stop.end() - 1]
        close = html.find(quote, stop.end()) if last[quote] >= stop.end() else -1
        if close < 0 or html[stop.end():close].rstrip().endswith("=") and ">" in html[stop.end():close]:
            return html.find(">", first)
        at = close + 1
