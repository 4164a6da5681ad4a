"""Text of HTML fragments, broken ones included."""

from __future__ import annotations

from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content, elements whose text is not shown, and elements in
# which white space counts.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta "
    "nextid param source spacer track wbr".split()
)
DROPPED = frozenset(["script", "style", "blockquote"])
UNSHOWN = frozenset(["template", "rt", "rp"])
PREFORMATTED = frozenset(["pre", "textarea"])
BLANKS = " \n\t\f\r"


class _TextNodes(HTMLParser):
    """Collects the text nodes that lie outside dropped elements.

    An end tag closes up to the nearest open element of its name and is ignored if there is
    none; an element that is never closed lasts to the end of its parent.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.nodes: list[str] = []
        self._pending: list[str] = []
        self._open: list[str] = []
        self._depth: Counter[str] = Counter()
        self._closed_void: Counter[str] = Counter()

    def _inside(self, names: frozenset[str]) -> bool:
        return any(self._depth[n] for n in names)

    def _end_node(self, shown: bool = True, keep_type: bool = False) -> None:
        if not self._pending:
            return
        text, self._pending = "".join(self._pending), []
        if not text.strip(BLANKS) and not self._inside(PREFORMATTED):
            text = "\n" if "\n" in text else " "
        hidden = self._inside(DROPPED) or (not keep_type and self._inside(UNSHOWN))
        if shown and not hidden:
            self.nodes.append(text)

    def _close(self, tag: str) -> None:
        self._end_node()
        while self._depth[tag]:
            top = self._open.pop()
            self._depth[top] -= 1
            if top == tag:
                return

    def _start(self, tag: str) -> None:
        self._end_node()
        self._open.append(tag)
        self._depth[tag] += 1

    def handle_starttag(self, tag, attrs):
        self._start(tag)
        if tag in VOID:
            self._close(tag)
            self._closed_void[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self._start(tag)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self._closed_void[tag]:
            self._closed_void[tag] -= 1
        else:
            self._close(tag)

    def handle_data(self, data):
        self._pending.append(data)

    def handle_entityref(self, name):
        self._pending.append(html5.get(f"{name};") or html5.get(name) or f"&{name}")

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[0] in "xX" else int(name)
            char = bytes([code]).decode("windows-1252", "ignore") if code < 256 else ""
            self._pending.append(char or chr(code))
        except (ValueError, OverflowError):
            self._pending.append("\N{REPLACEMENT CHARACTER}")

    def _unseen(self, data, cdata: bool = False):
        self._end_node()
        self._pending.append(data)
        self._end_node(shown=cdata, keep_type=cdata)

    def handle_comment(self, data):
        self._unseen(data)

    def handle_decl(self, decl):
        self._unseen(decl)

    def handle_pi(self, data):
        self._unseen(data)

    def unknown_decl(self, data):
        cdata = data.upper().startswith("CDATA[")
        self._unseen(data[6:] if cdata else data, cdata)

    def text(self, markup: str) -> str:
        self.feed(markup)
        self.close()
        self._end_node()
        return " ".join(self.nodes)


def html_text(markup: str) -> str:
    return _TextNodes().text(markup)


def has_markup(c: Column) -> Column:
    return c.contains("<") & c.contains(">")


def _html_texts(batch: pd.Series) -> pd.Series:
    return batch.map(html_text, na_action="ignore")


def strip_html(c: Column) -> Column:
    """Shown text of a value that contains markup; any other value is returned untouched.

    Only values with markup are sent to Python.
    """
    parse = F.pandas_udf(_html_texts, "string")
    return F.coalesce(parse(F.when(has_markup(c), c)), c)
