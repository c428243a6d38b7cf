"""Flatten a page into one array of nodes.

Only this step needs Python: it turns tags into (node, last) intervals. Which
container, paragraph, image or video a node means is decided by Spark
expressions over the array (``newslens.operators.pages``).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa

from newslens.constants import BOILERPLATE_TAGS

NODES = ("array<struct<node:int,last:int,tag:string,text:string,id:string,class:string,"
         "shade:int,attrs:map<string,string>>>")

_ARROW_NODE = pa.struct([
    ("node", pa.int32()), ("last", pa.int32()), ("tag", pa.string()), ("text", pa.string()),
    ("id", pa.string()), ("class", pa.string()), ("shade", pa.int32()), ("attrs", pa.map_(pa.string(), pa.string())),
])

_TAG = re.compile(r"<(/?)[a-zA-Z]")
_NAME_END = re.compile(r"[\s/>]")
_MARK = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>|\Z", re.I) for tag in ("script", "style")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(source):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found.setdefault(name.lower(), html.unescape(value))
    return found


class _Ahead:
    """Next match of a pattern, asked for from growing places: no stretch is searched twice."""

    def __init__(self, pattern: re.Pattern, page: str):
        self.pattern, self.page = pattern, page
        self.since, self.found = 1, 0

    def __call__(self, at: int) -> int:
        if not self.since <= at <= self.found:
            hit = self.pattern.search(self.page, at)
            self.since, self.found = at, hit.start() if hit else len(self.page)
        return self.found


class _TagEnds:
    """Finds the ``>`` outside quotes that ends a tag.

    Opening quotes after which no tag ends are remembered. A search that comes
    to one of them stops, so all searches together are linear in the page.
    """

    def __init__(self, page: str):
        self.page, self.mark, self.dead = page, _Ahead(_MARK, page), set()

    def __call__(self, at: int) -> int:
        """Place of the ``>`` for a tag whose name ends at ``at``, -1 without one."""
        page, passed, x = self.page, [], self.mark(at)
        while 0 <= x < len(page) and page[x] != ">" and x not in self.dead:
            passed.append(x)
            quote_end = page.find(page[x], x + 1)
            hit = _MARK.search(page, quote_end + 1) if quote_end >= 0 else None
            x = hit.start() if hit else -1
        if 0 <= x < len(page) and page[x] == ">":
            return x
        self.dead.update(passed)
        return -1


def flatten(page: str) -> list[dict]:
    """Nodes in document order; ``last`` is the index of a node's last descendant.

    ``shade`` is the index of the innermost boilerplate element around (or at)
    the node, -1 without one.

    An end tag closes the nearest open element of its name and all inside it;
    an end tag without one is ignored. Missing end tags are not invented. A
    ``<`` that begins no complete tag is text. The work is linear in the page,
    also where elements, quotes or tags stay open.
    """
    nodes: list[dict] = []
    still_open: list[dict] = []
    depths: dict[str, list[int]] = {}  # places in still_open by tag
    pieces: list[str] = []             # of the text node at hand
    name_end, tag_end = _Ahead(_NAME_END, page), _TagEnds(page)
    last_end = page.rfind(">")
    at = 0

    def add(tag: str, text: str | None = None, attrs: dict[str, str] | None = None) -> dict:
        attrs = attrs or {}
        shade = still_open[-1]["shade"] if still_open else -1
        node = {"node": len(nodes), "last": len(nodes), "tag": tag, "text": text,
                "id": attrs.get("id"), "class": attrs.get("class"),
                "shade": len(nodes) if tag in BOILERPLATE_TAGS else shade, "attrs": list(attrs.items())}
        nodes.append(node)
        return node

    def end_text() -> None:
        if pieces:
            add("#text", "".join(pieces))
            pieces.clear()

    def close(depth: int) -> None:
        while len(still_open) > depth:
            element = still_open.pop()
            depths[element["tag"]].pop()
            element["last"] = len(nodes) - 1

    while at < len(page):
        if page[at] != "<":
            end = page.find("<", at)
            end = end if end >= 0 else len(page)
            pieces.append(html.unescape(page[at:end]))
            at = end
            continue
        start = _TAG.match(page, at)
        if start:
            name = start.end() - 1
            named = name_end(start.end())
            end = tag_end(named)
        elif page.startswith("<!--", at):
            end_text()
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        elif page.startswith(("<!", "<?"), at) and at < last_end:
            end_text()
            at = page.find(">", at + 2) + 1
            continue
        else:
            end = -1
        if end < 0:
            pieces.append("<")
            at += 1
            continue
        end_text()
        tag, source, at = page[name:named].lower(), page[named:end], end + 1
        if start[1]:
            if depths.get(tag):
                close(depths[tag][-1])
            continue
        element = add(tag, attrs=_attributes(source) if source else None)
        if tag in _RAW_END:
            raw = _RAW_END[tag].search(page, at)
            element["text"] = page[at:raw.start()]
            at = raw.end()
        elif tag not in _VOID and not source.endswith("/"):
            depths.setdefault(tag, []).append(len(still_open))
            still_open.append(element)
    end_text()
    close(0)
    return nodes


_PAGES_AT_ONCE = 64


def flatten_batches(keep: list[str], column: str):
    """Arrow mapper: columns ``keep`` plus ``nodes``; the page itself is dropped.

    Nodes are handed back every few pages, so that a batch of large pages never
    stands in memory as Python objects at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _PAGES_AT_ONCE):
                batch = whole.slice(start, _PAGES_AT_ONCE)
                rows = [None if p is None else flatten(p) for p in batch.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in keep] + [pa.array(rows, pa.list_(_ARROW_NODE))],
                    names=keep + ["nodes"])

    return run
