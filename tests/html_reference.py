"""Plain parsers of tables and lists, one page at a time, that the built-in SQL of the sources is held
against; and the same handlers driven by the standard library's ``html.parser``."""

import re
from html import unescape
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
RAW_TEXT = {"script", "style"}

class _Cell:
    __slots__ = ("tag", "parts", "alt", "colspan", "rowspan")

    def __init__(self, tag: str, colspan: int, rowspan: int):
        self.tag, self.parts, self.alt = tag, [], None
        self.colspan, self.rowspan = colspan, rowspan


class _Table:
    __slots__ = ("idx", "rows", "cur", "cell", "section", "carry")

    def __init__(self, idx: int):
        self.idx, self.rows, self.cur, self.cell = idx, [], None, None
        self.section = None
        self.carry: list = []  # (col, rows left, cell) from the rows above


_NO_ATTRS: dict = {}


def _span(attrs: dict, name: str) -> int:
    v = attrs.get(name)
    if v is None:
        return 1
    try:
        return max(1, int(str(v).strip() or 1))
    except ValueError:
        return 1


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"                         # comment (unterminated: to the end)
    r"|<![^>]*>|<\?[^>]*>"                        # doctype / declaration / processing
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*)>",  # start or end tag
    re.S)
_ATTR = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW_TEXT}


class Tokenizer:
    """Event source for the handlers below: one compiled regex walks the page and calls
    ``handle_starttag`` / ``handle_endtag`` / ``handle_data`` like ``html.parser`` does
    (lower-cased tag names, decoded entities, script/style bodies as opaque text), at a
    fraction of the per-tag cost.  Attributes are only decoded for the few tags whose
    attributes the handlers read.  One recovery differs on malformed markup: a tag with an
    unterminated quote is kept as text here, where ``html.parser`` swallows the text up to
    the next quote."""

    ATTR_TAGS: frozenset = frozenset()

    def feed(self, html: str) -> None:
        pos, skip_to = 0, 0
        data, start, end_tag = self._data, self.handle_starttag, self.handle_endtag
        attr_tags = self.ATTR_TAGS
        for m in _TOKEN.finditer(html):
            s, e = m.span()
            if s < skip_to:                   # inside a script/style body
                continue
            if s > pos:
                data(html[pos:s])
            pos = e
            closing, tag, raw = m.groups()
            if tag is None:
                continue                       # comment / declaration
            tag = tag.lower()
            if closing:
                end_tag(tag)
                continue
            attrs = self._attrs(raw) if raw and tag in attr_tags else ()
            if raw.endswith("/") and tag not in VOID:
                self.handle_startendtag(tag, attrs)
            else:
                start(tag, attrs)
            if tag in RAW_TEXT:                # opaque until the matching end tag
                close = _RAW_END[tag].search(html, pos)
                stop = close.start() if close else len(html)
                self.handle_data(html[pos:stop])
                if close is None:
                    return
                pos = skip_to = close.end()
                end_tag(tag)
        if pos < len(html):
            data(html[pos:])

    @staticmethod
    def _attrs(raw: str) -> list[tuple[str, str]]:
        out = []
        for name, dq, sq, uq in _ATTR.findall(raw):
            v = dq or sq or uq
            out.append((name.lower(), unescape(v) if "&" in v else v))
        return out

    def _data(self, text: str) -> None:
        self.handle_data(unescape(text) if "&" in text else text)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def close(self) -> None:
        pass


class TableParser(Tokenizer):
    """Collects every table of a page as rows of (tag, text, img alt) cells."""

    ATTR_TAGS = frozenset({"td", "th", "img"})

    def __init__(self):
        self.tables: list[_Table] = []
        self.stack: list[_Table] = []
        self.raw_depth = 0
        self.out: list[tuple] = []  # (table_idx, row_idx, section, cells[(tag,text,alt)])

    # -- structure
    def _finish_cell(self, t: _Table) -> None:
        if t.cell is not None and t.cur is not None:
            t.cur.append(t.cell)
        t.cell = None

    def _finish_row(self, t: _Table) -> None:
        self._finish_cell(t)
        if t.cur is None:
            return
        row, below, above = [], [], t.carry

        def take(wait):
            while above and (above[0][0] <= len(row) or not wait):
                col, left, cell = above.pop(0)
                row.append(cell)
                if left > 1:
                    below.append((col, left - 1, cell))

        for c in t.cur:
            take(True)
            cell = (c.tag, "".join(c.parts), c.alt)
            for _ in range(c.colspan):
                if c.rowspan > 1:
                    below.append((len(row), c.rowspan - 1, cell))
                row.append(cell)
        take(False)
        t.carry = below
        t.rows.append((t.section, row))
        t.cur = None

    def _close_table(self) -> None:
        t = self.stack.pop()
        self._finish_row(t)
        for r, (section, row) in enumerate(t.rows):
            self.out.append((t.idx, r, section, row))

    def handle_starttag(self, tag, attrs):
        if tag in RAW_TEXT:
            self.raw_depth += 1
            return
        a = dict(attrs) if attrs else _NO_ATTRS
        if tag == "table":
            t = _Table(len(self.tables))
            self.tables.append(t)
            self.stack.append(t)
            return
        if not self.stack:
            return
        t = self.stack[-1]
        if tag in ("thead", "tbody", "tfoot"):
            self._finish_row(t)
            t.section = tag
        elif tag == "tr":
            self._finish_row(t)
            t.cur = []
        elif tag in ("td", "th"):
            if t.cur is None:
                t.cur = []
            self._finish_cell(t)
            t.cell = (_Cell(tag, _span(a, "colspan"), _span(a, "rowspan")) if a
                      else _Cell(tag, 1, 1))
        elif tag == "img" and t.cell is not None and t.cell.alt is None:
            t.cell.alt = a.get("alt")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in RAW_TEXT:
            self.raw_depth = max(0, self.raw_depth - 1)

    def handle_endtag(self, tag):
        if tag in RAW_TEXT:
            self.raw_depth = max(0, self.raw_depth - 1)
            return
        if not self.stack:
            return
        t = self.stack[-1]
        if tag == "table":
            self._close_table()
        elif tag == "tr":
            self._finish_row(t)
        elif tag in ("td", "th"):
            self._finish_cell(t)
        elif tag in ("thead", "tbody", "tfoot"):
            self._finish_row(t)
            t.section = None

    def handle_data(self, data):
        if self.raw_depth:
            return
        for t in self.stack:  # text belongs to every enclosing open cell (nested tables)
            if t.cell is not None:
                t.cell.parts.append(data)

    def finish(self) -> list[tuple]:
        self.close()
        while self.stack:
            self._close_table()
        return self.out


def parse_tables(html: str) -> list[tuple]:
    """(table_idx, row_idx, section, [(tag, text, alt), ...]) for every row of every table."""
    p = TableParser()
    p.feed(html or "")
    return p.finish()


def _header_rows(trs: list[tuple]) -> set[int]:
    """Positions of a table's header rows: its ``<thead>`` rows, or else the leading rows
    made only of ``<th>`` cells (how a table reader picks column names)."""
    head = {i for i, (s, _c) in enumerate(trs) if s == "thead"}
    if not head:
        for i, (_s, c) in enumerate(trs):
            if c and all(x[0] == "th" for x in c):
                head.add(i)
            else:
                break
    return head


def header_levels(rows: list[tuple]) -> tuple[dict[int, list[list[str]]], dict[tuple, int]]:
    """Per table, the column names as lists of header levels, and the body position of each
    non-header row ``(table_idx, row_idx) -> body_idx``."""
    by_table: dict[int, list[tuple]] = {}
    for ti, ri, section, cells in rows:
        by_table.setdefault(ti, []).append((ri, section, cells))
    names, body = {}, {}
    for ti, trs in by_table.items():
        trs.sort(key=lambda x: x[0])
        head_pos = _header_rows([(s, c) for _r, s, c in trs])
        head = [c for i, (_r, _s, c) in enumerate(trs) if i in head_pos]
        width = max((len(c) for c in head), default=0)
        names[ti] = [[c[i][1].strip() if i < len(c) else "" for c in head] for i in range(width)]
        k = 0
        for i, (r, _s, _c) in enumerate(trs):
            if i not in head_pos:
                body[(ti, r)] = k
                k += 1
    return names, body


class ListParser(Tokenizer):
    """Collects the ``<li>`` entries of ``<ul>`` lists (optionally of one class)."""

    ATTR_TAGS = frozenset({"ul", "a"})

    def __init__(self, ul_class: str | None):
        self.ul_class = ul_class
        self.ul_depth = 0          # depth of matched <ul> nesting
        self.ul_idx = -1
        self.li = None             # current entry: dict
        self.in_span = self.in_p = False
        self.raw_depth = 0
        self.out: list[tuple] = []
        self.li_count = 0

    def _close_p(self):
        if self.in_p and self.li is not None:
            self.li["items"].append("".join(self.li["p"]))
        self.in_p = False

    def _close_li(self):
        self._close_p()
        if self.li is not None:
            e = self.li
            self.out.append((self.ul_idx, e["idx"], e["date"], e["items"], "".join(e["text"]),
                             e["href"]))
        self.li = None
        self.in_span = False

    def handle_starttag(self, tag, attrs):
        if tag in RAW_TEXT:
            self.raw_depth += 1
            return
        a = dict(attrs)
        if tag == "ul":
            classes = (a.get("class") or "").split()
            if self.ul_depth == 0 and (self.ul_class is None or self.ul_class in classes):
                self.ul_depth = 1
                self.ul_idx += 1
                self.li_count = 0
            elif self.ul_depth:
                self.ul_depth += 1
            return
        if not self.ul_depth:
            return
        if tag == "li" and self.ul_depth == 1:
            self._close_li()
            self.li = {"idx": self.li_count, "date": None, "items": [], "text": [], "p": [],
                       "href": None, "span": []}
            self.li_count += 1
        elif self.li is None:
            return
        elif tag == "span" and self.li["date"] is None and not self.in_span:
            self.in_span = True
            self.li["span"] = []
        elif tag == "p":
            self._close_p()
            self.in_p = True
            self.li["p"] = []
        elif tag == "a" and self.li["href"] is None:
            self.li["href"] = a.get("href")

    def handle_endtag(self, tag):
        if tag in RAW_TEXT:
            self.raw_depth = max(0, self.raw_depth - 1)
            return
        if not self.ul_depth:
            return
        if tag == "ul":
            self.ul_depth -= 1
            if self.ul_depth == 0:
                self._close_li()
        elif self.li is None:
            return
        elif tag == "li" and self.ul_depth == 1:
            self._close_li()
        elif tag == "span" and self.in_span:
            self.li["date"] = "".join(self.li["span"])
            self.in_span = False
        elif tag == "p":
            self._close_p()

    def handle_data(self, data):
        if self.raw_depth or self.li is None:
            return
        self.li["text"].append(data)
        if self.in_span:
            self.li["span"].append(data)
        if self.in_p:
            self.li["p"].append(data)

    def finish(self) -> list[tuple]:
        self.close()
        self._close_li()
        return self.out


def parse_lists(html: str, ul_class: str | None = None) -> list[tuple]:
    p = ListParser(ul_class)
    p.feed(html or "")
    return p.finish()


class _Driver(HTMLParser):
    def __init__(self, handler):
        super().__init__(convert_charrefs=True)
        self.h = handler

    def handle_starttag(self, tag, attrs):
        self.h.handle_starttag(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.h.handle_startendtag(tag, attrs)

    def handle_endtag(self, tag):
        self.h.handle_endtag(tag)

    def handle_data(self, data):
        self.h.handle_data(data)


def parse_tables_stdlib(html):
    h = TableParser()
    d = _Driver(h)
    d.feed(html)
    d.close()
    return h.finish()


def parse_lists_stdlib(html, ul_class=None):
    h = ListParser(ul_class)
    d = _Driver(h)
    d.feed(html)
    d.close()
    return h.finish()


def table_rows_plain(page_id, page, name=None, table=0):
    """What ``table_rows`` gives for one page (its columns in order)."""
    rows = parse_tables(page)
    headers, body = header_levels(rows)
    alt = next((i for t, _r, _s, cs in rows if t == table for i, (tag, _x, a) in enumerate(cs) if tag == "th" and a == name), None) if name else None
    return [(page_id, t, r, s, s == "thead" or (bool(cs) and all(c[0] == "th" for c in cs)), [c[1] for c in cs], [c[1] for c in cs if c[0] == "td"],
             [c[2] for c in cs], alt, headers.get(t, []), body.get((t, r))) for t, r, s, cs in rows]
