"""Fields of stored HTML pages, addressed by simple CSS selectors."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: void elements, and elements whose text is never shown
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_UNSHOWN = frozenset(("script", "style"))
# ---- fixed values: an open element (left) whose end tag is implied by these start tags
_IMPLIED_END = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "td": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "th": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "tr": frozenset(("tr", "tbody", "tfoot")),
    "option": frozenset(("option", "optgroup")),
    "p": frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
        "section table ul".split()
    ),
}


def extract_page_fields(df: DataFrame, mapping: Mapping[str, tuple[str, str]], html: str = "html") -> DataFrame:
    """Replace column ``html`` by one text column per entry of ``mapping``.

    ``mapping`` is field -> (selector, default). A field is the blank-normalised
    text of the first element that matches, the default when none does. Selectors:
    ``tag``, ``.class``, ``#id``, ``tag.class`` and lists of those, joined by blanks
    (descendants) or ``>`` (children). All selectors are one automaton: an open element keeps
    the steps reached so far, so a new one looks at its parent alone.

    Pages are parsed in Python, one Arrow batch at a time; only the page text
    leaves the JVM, and nothing is shuffled.
    """
    wanted = {field: (_steps(selector), default) for field, (selector, default) in mapping.items()}
    result = T.StructType([T.StructField(field, T.StringType()) for field in wanted])

    @F.pandas_udf(result)
    def fields_of(pages: pd.Series) -> pd.DataFrame:
        rows = [_read_fields(page or "", wanted) for page in pages]
        return pd.DataFrame(rows, columns=list(wanted))

    others = [name for name in df.columns if name != html]
    return df.select(*others, fields_of(html).alias("__fields")).select(*others, "__fields.*")


def _steps(selector: str) -> list[tuple[str, str, frozenset[str], bool]]:
    """``'div.a > #b'`` -> [('div', '', {'a'}, False), ('', 'b', {}, True)]; the last says child."""
    steps, child = [], False
    for part in selector.replace(">", " > ").split():
        if part == ">":
            if child or not steps:
                raise ValueError(f"not a simple selector: {selector!r}")
            child = True
            continue
        if not re.fullmatch(r"[\w-]*(?:[.#][\w-]+)*", part):
            raise ValueError(f"not a simple selector: {selector!r}")
        tag = re.match(r"[\w-]*", part).group()
        ident = "".join(re.findall(r"#([\w-]+)", part)[-1:])
        steps.append((tag.lower(), ident, frozenset(re.findall(r"\.([\w-]+)", part)), child))
        child = False
    if not steps or child:
        raise ValueError(f"empty selector or step: {selector!r}")
    return steps


def _read_fields(page: str, wanted: Mapping) -> list[str]:
    reader = _FieldReader([steps if _may_match(page, steps) else None for steps, _ in wanted.values()])
    try:
        if not reader.done():
            reader.feed(page)
            reader.close()
    except _Complete:
        pass
    except Exception:  # markup that the parser gives up on: what was found so far stands
        pass
    return [default if text is None else text for text, (_, default) in zip(reader.texts(), wanted.values())]


#: A class or id written with a character reference, which a plain text search would miss.
_ESCAPED_NAME = re.compile(r"""(?:class|id)\s*=\s*(?:"[^"]*&|'[^']*&|[^\s>"']*&)""", re.IGNORECASE)


def _may_match(page: str, steps: list) -> bool:
    """False only when a class or id of the selector occurs nowhere in the page."""
    names = [name for _, ident, classes, _ in steps for name in (ident, *classes) if name]
    return all(name in page for name in names) or _ESCAPED_NAME.search(page) is not None


class _Complete(Exception):
    """Every selector has its text; the rest of the page cannot change it."""


class _FieldReader(HTMLParser):
    """Collects the text of the first match of each selector (None: not looked for)."""

    def __init__(self, selectors: list):
        super().__init__(convert_charrefs=True)
        self._by_tag: dict[str, list[tuple]] = {}  # "" holds the steps for any tag
        self._ends: dict[int, int] = {}  # bit of a selector's last step -> selector
        bit = 1
        for number, steps in enumerate(selectors):
            for place, (tag, ident, classes, child) in enumerate(steps or ()):
                self._by_tag.setdefault(tag, []).append((bit, ident, classes, child, place == 0))
                if place == len(steps) - 1:
                    self._ends[bit] = number
                bit <<= 1
        self._found: list[list[str] | None] = [None] * len(selectors)
        self._pending = sum(steps is not None for steps in selectors)
        self._open: list[tuple] = []  # (tag, selectors capturing here, steps reached here, here or above)
        self._tags: Counter[str] = Counter()  # of the open elements
        self._capturing: list[int] = []  # selectors whose element is open

    def done(self) -> bool:
        return self._pending == 0

    def texts(self) -> list[str | None]:
        return [None if parts is None else " ".join("".join(parts).split()) for parts in self._found]

    def handle_starttag(self, tag, attrs):
        while self._open and tag in _IMPLIED_END.get(self._open[-1][0], ()):
            self._close(len(self._open) - 1)
        here, above = self._reached(tag, dict(attrs))
        started = []
        for bit, number in self._ends.items():
            if here & bit and self._found[number] is None:
                self._found[number] = []
                started.append(number)
        if tag in _VOID:
            self.handle_data(" ")
            self._finish(len(started))
        else:
            self._open.append((tag, started, here, here | above))
            self._tags[tag] += 1
            self._capturing.extend(started)

    def handle_endtag(self, tag):
        if self._tags[tag]:
            depth = len(self._open) - 1
            while self._open[depth][0] != tag:
                depth -= 1
            self._close(depth)

    def handle_data(self, data):
        if self._capturing and not any(self._tags[tag] for tag in _UNSHOWN):
            for number in self._capturing:
                self._found[number].append(data)

    def _close(self, depth: int) -> None:
        """Close the element at ``depth`` and all inside it."""
        closed = [number for entry in self._open[depth:] for number in entry[1]]
        self._tags.subtract(entry[0] for entry in self._open[depth:])
        del self._open[depth:]
        if closed:
            self._capturing = [number for number in self._capturing if number not in closed]
            self._finish(len(closed))

    def _finish(self, closed: int) -> None:
        self._pending -= closed
        if closed and self.done():
            raise _Complete

    def _reached(self, tag: str, values: dict) -> tuple[int, int]:
        """Steps of all selectors that an element reaches itself, and those its ancestors did."""
        parent, above = self._open[-1][2:] if self._open else (0, 0)
        ident, classes = values.get("id") or "", frozenset((values.get("class") or "").split())
        here = 0
        for key in (tag, ""):
            for bit, wanted, needed, child, first in self._by_tag.get(key, ()):
                before = first or (bit >> 1) & (parent if child else above)
                if before and (not wanted or wanted == ident) and needed <= classes:
                    here |= bit
        return here, above
