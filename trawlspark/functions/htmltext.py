"""Title, body text and links of one HTML page. Small helper for the Arrow batches of the page operators."""

from __future__ import annotations

import re
from html import unescape

_ATTR = r"""((?:[^\s/>=]|(?<=[\s/"'])=)[^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]*+)))?+"""
_ANY_ATTR = re.sub(r"\((?!\?)", "(?:", _ATTR)
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ANY_ATTR})*+)>"
    r"|<(?:[!?]|/(?=[^a-zA-Z>]))[^>]*(?:>|\Z)|</>"
    r"|(<)(?=/?[a-zA-Z])",
    re.S,
)
_ATTRS = re.compile(_ATTR)
# Tags the pattern above cannot read still end somewhere: at the first ">" outside quotes, or else at the first one.
_LENIENT = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^>"'])*+)>""")
_CLOSED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "noscript"}
_ESCAPABLE = {"title", "textarea"}
_HEAD = {"html", "head", "title", "meta", "link", "base", "script", "style", "noscript", "noframes", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def _attribute_text(value: str) -> str:
    # A named entity without ";" stays as it is when a letter, digit or "=" follows.
    return re.sub(r"&(#?\w+)(;|(?![\w=]))", lambda m: unescape(m.group(0)), value)


def _link(attrs: str) -> str | None:
    for name, double, single, bare in _ATTRS.findall(attrs):
        if name.lower() == "href":
            return _attribute_text(double or single or bare)
    return None


def page_parts(html: str) -> tuple[str, str, list[str]]:
    """(title, body, hrefs): text nodes joined by blanks, scripts and styles left out, hrefs in page order."""
    html = html.replace("\r\n", "\n").replace("\r", "\n")
    title: str | None = None
    nodes: list[str] = []
    hrefs: list[str] = []
    run: list[str] = []
    opened: dict[str, int] = {}
    in_body = after_body = False
    at, size = 0, len(html)

    def end_run() -> None:
        if run:
            nodes.append(unescape("".join(run)))
            run.clear()

    def add_text(text: str) -> None:
        nonlocal in_body
        if not in_body:
            text = text.lstrip(" \t\n\f")
            in_body = bool(text)
        if text:
            run.append(text)

    while at < size:
        mark = _MARKUP.search(html, at)
        if mark is None:
            add_text(html[at:])
            break
        if mark.start() > at:
            add_text(html[at:mark.start()])
        at = mark.end()
        if mark.group(4):
            mark = _LENIENT.match(html, mark.start()) or _CLOSED.match(html, mark.start())
            if mark is None:  # a tag cut off by the end of the input
                break
            at = mark.end()
        name = (mark.group(2) or "").lower()
        if not name:  # comment, doctype
            if in_body and not after_body:
                end_run()
            continue
        if mark.group(1):
            if name in ("body", "html"):
                after_body = in_body
            elif opened.get(name) or name in ("p", "br"):
                if name in ("p", "br"):
                    in_body = in_body or name == "br"
                opened[name] = max(opened.get(name, 0) - 1, 0)
                end_run()
            continue
        if name not in _HEAD:
            in_body = True
        end_run()
        if name == "a":
            href = _link(mark.group(3))
            if href is not None:
                hrefs.append(href)
        if name in _RAW or name in _ESCAPABLE:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            inner = html[at:close.start()] if close else html[at:]
            at = close.end() if close else size
            if name in ("script", "style"):
                continue
            if name == "textarea" and inner.startswith("\n"):
                inner = inner[1:]
            if name in _ESCAPABLE:
                inner = unescape(inner)
            if name == "title" and title is None:
                title = inner
            if in_body and inner:
                nodes.append(inner)
            continue
        if name in ("pre", "listing") and html.startswith("\n", at):
            at += 1
        if name not in _VOID:
            opened[name] = opened.get(name, 0) + 1
    end_run()
    return title or "", " ".join(nodes), hrefs
