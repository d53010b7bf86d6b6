"""The single Python boundary: HTML -> node arrays.

Runs inside ``mapInArrow`` (pieces of Arrow batches), one pass per page, using the
standard-library tokenizer. The tree rules follow the common lenient
"html.parser" tree builder: an end tag closes its nearest open match
(unmatched end tags are ignored), void elements never hold children,
``<p>`` does not close an open ``<p>``, adjacent character data merges into
one string, and an all-whitespace string collapses to one newline or space.

Everything downstream (which strings to keep, which subtrees to drop, meta
selection, year filtering, joining) is native Spark expressions over the
emitted arrays, so one parse serves every extraction option.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse, urlunparse

# Elements that never hold children.
VOID_ELEMENTS = frozenset([
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
    "menuitem", "meta", "param", "source", "track", "wbr",
    "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer",
])
STRING_CONTAINERS = ("script", "style", "template")
PRESERVE_WS = ("pre", "textarea")
ASCII_SPACES = " \n\t\x0c\r"
# Fixed value: class pattern of a cookie banner (searched in the class value).
COOKIE_CLASS = re.compile("cookie*.")


class _Open:
    __slots__ = ("name", "a", "script", "cookie", "p_id", "container", "pre")

    def __init__(self, name, a, script, cookie, p_id, container, pre):
        self.name, self.a, self.script, self.cookie = name, a, script, cookie
        self.p_id, self.container, self.pre = p_id, container, pre


class PageParser(HTMLParser):
    """Work is linear in the page: strings are stored once, and a paragraph is
    the range of strings between its start and end."""

    def __init__(self, with_paras: bool = True):
        super().__init__(convert_charrefs=True)
        self.with_paras = with_paras
        self.stack: list[_Open] = []
        self.n_open: Counter[str] = Counter()
        self.buf: list[str] = []
        self.nodes: list[dict] = []
        self.anchors: list[str] = []
        self.metas: list[dict] = []
        self.paras: list[dict] = []      # p_id, removed, first and last string
        self.strings: list[tuple[str, bool]] = []   # raw string, removed
        self.base_href: str | None = None
        self.closed_void: Counter[str] = Counter()

    # -- state of the innermost open element --------------------------------
    def _top(self):
        return self.stack[-1] if self.stack else None

    def _flags(self):
        t = self._top()
        if t is None:
            return False, False, False, None, False
        return t.a, t.script, t.cookie, t.container, t.pre

    # -- strings -------------------------------------------------------------
    def _flush(self, kind_override: str | None = None):
        if not self.buf and kind_override is None:
            return
        text = "".join(self.buf)
        self.buf = []
        a, script, cookie, container, pre = self._flags()
        if kind_override is None:
            if not text.strip(ASCII_SPACES) and not pre:
                text = "\n" if "\n" in text else " "
            kind = container or "text"
        else:
            kind = kind_override
        self._emit(kind, text, a, script, cookie)

    def _emit(self, kind, text, a, script, cookie):
        # Nodes carry the stripped string (empty ones are never body text);
        # paragraphs below keep the raw strings they are made of.
        stripped = text.strip()
        if stripped:
            self.nodes.append({"seq": len(self.nodes), "kind": kind, "text": stripped,
                               "in_a": a, "in_script": script, "in_cookie": cookie})
        if self.with_paras:
            self.strings.append((text, a or script or cookie))

    def handle_data(self, data):
        self.buf.append(data)

    def handle_comment(self, data):
        self._flush()
        self._emit("comment", data, *self._flags()[:3])

    def handle_decl(self, decl):
        self._flush()
        self._emit("doctype", decl, *self._flags()[:3])

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self._emit("text", data[6:], *self._flags()[:3])
        else:
            self._emit("declaration", data, *self._flags()[:3])

    def handle_pi(self, data):
        self._flush()
        self._emit("pi", data, *self._flags()[:3])

    # -- tags ----------------------------------------------------------------
    def handle_starttag(self, tag, attrs, self_closing=False):
        self._flush()
        attr = {}
        for k, v in attrs:
            attr[k] = "" if v is None else v          # a repeated attribute: last wins
        a, script, cookie, container, pre = self._flags()
        if tag == "a":
            if "href" in attr:
                self.anchors.append(attr["href"])
            a = True
        elif tag == "script":
            script = True
        elif tag == "div" and "class" in attr:
            cls = " ".join(attr["class"].split())
            if COOKIE_CLASS.search(cls):
                cookie = True
        elif tag == "meta":
            self.metas.append({"name": attr.get("name"), "property": attr.get("property"),
                               "content": attr.get("content"), "in_a": a, "in_cookie": cookie})
        elif tag == "base" and self.base_href is None and attr.get("href"):
            self.base_href = attr["href"]
        p_id = None
        if tag == "p" and self.with_paras:
            p_id = len(self.paras)
            self.paras.append({"p_id": p_id, "removed": a or script or cookie,
                               "from": len(self.strings), "to": None})
        if tag in STRING_CONTAINERS:
            container = tag
        if tag in PRESERVE_WS:
            pre = True
        self.stack.append(_Open(tag, a, script, cookie, p_id, container, pre))
        self.n_open[tag] += 1
        if tag in VOID_ELEMENTS and not self_closing:
            self._pop_to(tag)
            self.closed_void[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, self_closing=True)
        self._flush()
        self._pop_to(tag)

    def handle_endtag(self, tag):
        self._flush()
        if self.closed_void[tag]:
            self.closed_void[tag] -= 1
            return
        self._pop_to(tag)

    def _pop_to(self, tag):
        if not self.n_open[tag]:
            return
        while True:
            gone = self.stack.pop()
            self.n_open[gone.name] -= 1
            if gone.p_id is not None:
                self.paras[gone.p_id]["to"] = len(self.strings)
            if gone.name == tag:
                return

    def finish(self):
        self.close()
        self._flush()


def _absolute_links(anchors: list[str], page_url: str | None, base_href: str | None) -> list[str]:
    """The set of absolute links of a page, first-seen order."""
    base = page_url or ""
    if base_href:
        base = urljoin(base, base_href)
    out, seen = [], set()
    scheme = urlparse(base).scheme
    for href in anchors:
        h = href.strip()
        if not h or h.startswith("#") or h.startswith(("javascript:", "mailto:")):
            continue
        try:
            parsed = urlparse(h)
            if not parsed.netloc:
                link = urljoin(base, h)
            elif not parsed.scheme:
                link = urlunparse(parsed._replace(scheme=scheme))
            else:
                link = h
        except ValueError:
            continue
        if link not in seen:
            seen.add(link)
            out.append(link)
    return out


def parse_html(html: str | None, page_url: str | None = None, with_links: bool = True,
               with_paras: bool = False) -> dict:
    if not isinstance(html, str):
        return {"nodes": None, "anchors": None, "metas": None, "paras": None,
                "links": None, "ok": False}
    p = PageParser(with_paras)
    try:
        p.feed(html)
        p.finish()
    except Exception:  # malformed beyond the tokenizer's tolerance
        return {"nodes": None, "anchors": None, "metas": None, "paras": None,
                "links": None, "ok": False}
    paras = None
    if with_paras:
        spans = [(q, p.strings[q["from"]:q["to"]]) for q in p.paras]
        paras = [{"p_id": q["p_id"], "removed": q["removed"], "text_all": "".join(t for t, _ in s),
                  "text_kept": "".join(t for t, gone in s if not gone)} for q, s in spans]
    links = _absolute_links(p.anchors, page_url, p.base_href) if with_links else None
    return {"nodes": p.nodes, "anchors": p.anchors, "metas": p.metas, "paras": paras,
            "links": links, "ok": True}
