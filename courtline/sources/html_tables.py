"""HTML tables of a landed ``pages(page_id, url, html)`` table, one row for each ``<tr>``.

Everything is built-in SQL: a page is marked once, cut into tables, sections, rows and cells by
``split``, and exploded where it lies, so there is no shuffle and no Python.

* Tables may be nested: a fold over a page's table tags keeps the open ones, gives each its own
  markup and the outer cell the inner text.  Unclosed tables end with the page.
* Unclosed cells and rows end where the next begins; cells outside of a row make one.
* ``colspan`` repeats a cell.  ``rowspan`` repeats it in the rows below, at its column or, in a
  shorter row, at the end: a fold over the rows that a span ties together holds the cells from above.

Null or empty pages, and pages without a table, give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions.html import CLOSE, OPEN, attribute, bound, content, marked, once, pieces, stripped, text_of, until_cell
from courtline.session import ensure_parallel

_TAGS = ["table", "thead", "tbody", "tfoot", "tr", "td", "th", "img"]
_CELL = "struct<tag:string,text:string,alt:string>"
_TABLE = "struct<idx:int,body:string>"


def _tables(text: Column) -> Column:
    """array<struct<idx, body>>: every table's own markup, by a fold over the page's table tags."""
    def step(s, piece):
        opens, closes = F.regexp_like(piece, F.lit(r"(?i)^<table[\s/>]")), F.regexp_like(piece, F.lit(r"(?i)^</table[\s/>]"))
        body, plain = content(piece), F.regexp_replace(content(piece), f"{OPEN}[^{CLOSE}]*+{CLOSE}", "\u0003")
        top = F.size(s["stack"])
        stack = (F.when(opens, F.concat(s["stack"], F.array(F.struct(s["n"].alias("idx"), F.lit("").alias("body")))))
                 .when(closes & (top > 0), F.slice(s["stack"], 1, top - 1)).otherwise(s["stack"]))
        depth = F.when(opens, top + 1).when(closes, F.greatest(top - 1, F.lit(0))).otherwise(top)
        grown = F.transform(stack, lambda t, i: F.struct(t["idx"].alias("idx"), F.concat(t["body"], F.when(i == depth - 1, body).otherwise(plain)).alias("body")))
        done = F.when(closes & (top > 0), F.concat(s["done"], F.slice(s["stack"], top, 1))).otherwise(s["done"])
        return F.struct((s["n"] + opens.cast("int")).alias("n"), grown.alias("stack"), done.alias("done"))

    none = F.array().cast(f"array<{_TABLE}>")
    cut = pieces(text, "table", ends=True)
    start = F.struct(F.lit(0).alias("n"), none.alias("stack"), none.alias("done"))
    return F.aggregate(F.slice(cut, 2, 1 << 30), start, step, lambda s: F.concat(s["done"], s["stack"]))


def _cell(piece: Column) -> Column:
    """One cell from its start tag on; it ends at the next end tag of a cell."""
    def cell(inside):
        images = F.filter(F.transform(F.slice(pieces(inside, "img"), 2, 1 << 30), lambda p: attribute(p, "alt")), lambda a: a.isNotNull())
        return F.struct(F.lower(piece.substr(2, 2)).alias("tag"), text_of(inside).alias("text"), F.when(F.contains(inside, F.lit(OPEN)), F.get(images, 0)).alias("alt"),
                        _span(piece, "colspan").alias("colspan"), _span(piece, "rowspan").alias("rowspan"))

    return bound(until_cell(content(piece)), cell)


def _span(piece: Column, name: str) -> Column:
    """A span's value; 1 where it is no number."""
    value = F.regexp_extract(piece, rf"(?is)^<[^{CLOSE}]*?[\s\"'/]{name}\s*=\s*[\"']?\s*\+?(\d{{1,9}})\s*(?:[\"'\s/>])", 1)
    number = F.greatest(F.when(value != "", value.cast("int")).otherwise(F.lit(1)), F.lit(1))
    # a cell's tag without attributes ends at its fourth character
    return F.when((piece.substr(4, 1) != ">") & F.regexp_like(piece, F.lit(rf"(?i)^<[^{CLOSE}]*{name}")), number).otherwise(F.lit(1))


def _rows(body: Column) -> Column:
    """array<struct<section, cells>> of a table's markup, spans not yet placed."""
    def row(part):
        cells = pieces(part, "td|th")
        return F.struct(F.regexp_like(part, F.lit(r"(?i)^<tr[\s/>]")).alias("opened"), F.transform(F.slice(cells, 2, 1 << 30), _cell).alias("cells"))

    def section(part):
        name = F.lower(F.regexp_extract(part, r"(?i)^<(thead|tbody|tfoot)[\s/>]", 1))
        rows = F.filter(F.transform(pieces(part, "tr", ends=True), row), lambda r: r["opened"] | (F.size(r["cells"]) > 0))
        return F.transform(rows, lambda r: F.struct(F.when(name != "", name).alias("section"), r["cells"].alias("cells")))

    return F.flatten(F.transform(pieces(body, "thead|tbody|tfoot", ends=True), section))


def _plain(c: Column) -> Column:
    return F.struct(c["tag"].alias("tag"), c["text"].alias("text"), c["alt"].alias("alt"))


def _spread(row: Column) -> Column:
    """A row's cells, each repeated over its columns."""
    return F.flatten(F.transform(row["cells"], lambda c: F.array_repeat(_plain(c), c["colspan"])))


def _placed(rows: Column) -> Column:
    """Rows with spans placed.  Rows that no span reaches from above start a block of their own; a fold
    over a block's rows holds the cells that reach down (col, left: rows still to fill, cell)."""
    held = f"array<struct<col:int,left:int,cell:{_CELL}>>"
    none = lambda kind: F.array().cast(kind)

    def from_above(x):
        """Cells from above whose column has come, in their order."""
        def take(y, h):
            now = (F.size(y["wait"]) == 0) & (h["col"] <= F.size(y["out"]))
            on = F.struct(h["col"].alias("col"), (h["left"] - 1).alias("left"), h["cell"].alias("cell"))
            return F.struct(F.when(now, F.concat(y["out"], F.array(h["cell"]))).otherwise(y["out"]).alias("out"),
                            F.when(now, y["wait"]).otherwise(F.concat(y["wait"], F.array(h))).alias("wait"),
                            F.when(now & (h["left"] > 1), F.concat(y["below"], F.array(on))).otherwise(y["below"]).alias("below"))

        start = F.struct(x["out"].alias("out"), none(held).alias("wait"), x["below"].alias("below"))
        return F.when(F.size(x["wait"]) == 0, x).otherwise(F.aggregate(x["wait"], start, take))

    def put(x, c):
        def after(y):
            new = F.transform(F.sequence(F.lit(0), c["colspan"] - 1), lambda i: F.struct((F.size(y["out"]) + i).alias("col"), (c["rowspan"] - 1).alias("left"), _plain(c).alias("cell")))
            return F.struct(F.concat(y["out"], F.array_repeat(_plain(c), c["colspan"])).alias("out"), y["wait"].alias("wait"),
                            F.when(c["rowspan"] > 1, F.concat(y["below"], new)).otherwise(y["below"]).alias("below"))

        return bound(from_above(x), after)

    def rest(x):
        """What still waits ends the row."""
        more = F.transform(F.filter(x["wait"], lambda h: h["left"] > 1), lambda h: F.struct(h["col"].alias("col"), (h["left"] - 1).alias("left"), h["cell"].alias("cell")))
        return F.struct(F.concat(x["out"], F.transform(x["wait"], lambda h: h["cell"])).alias("out"), F.concat(x["below"], more).alias("below"))

    def filled(s, row):
        start = F.struct(none(f"array<{_CELL}>").alias("out"), s["held"].alias("wait"), none(held).alias("below"))
        return F.aggregate(row["cells"], start, put, rest)

    def first(s, row):
        """Nothing from above and no colspan: a cell's column is its place."""
        down = F.transform(row["cells"], lambda c, i: F.struct(i.alias("col"), (c["rowspan"] - 1).alias("left"), _plain(c).alias("cell")))
        return F.struct(F.transform(row["cells"], _plain).alias("out"), F.filter(down, lambda h: h["left"] > 0).alias("below"))

    def under(s, row):
        """One cell from above and no span: it is set in at its column, or ends a shorter row."""
        h, cells = F.get(s["held"], 0), F.transform(row["cells"], _plain)
        on = F.array(F.struct(h["col"].alias("col"), (h["left"] - 1).alias("left"), h["cell"].alias("cell")))
        return F.struct(F.concat(F.slice(cells, F.lit(1), h["col"]), F.array(h["cell"]), F.slice(cells, h["col"] + 1, F.size(cells))).alias("out"),
                        F.when(h["left"] > 1, on).otherwise(none(held)).alias("below"))

    def line(s, row):
        wide, tall = F.exists(row["cells"], lambda c: c["colspan"] > 1), F.exists(row["cells"], lambda c: c["rowspan"] > 1)
        made = F.when((F.size(s["held"]) == 0) & ~wide, first(s, row)).when((F.size(s["held"]) == 1) & ~wide & ~tall, under(s, row)).otherwise(filled(s, row))
        return bound(made, lambda d: F.struct(
            d["below"].alias("held"), F.concat(s["rows"], F.array(F.struct(row["section"].alias("section"), d["out"].alias("cells")))).alias("rows")))

    def block(some):
        start = F.struct(none(held).alias("held"), none(f"array<struct<section:string,cells:array<{_CELL}>>>").alias("rows"))
        alone = F.transform(some, lambda r: F.struct(r["section"].alias("section"), _spread(r).alias("cells")))
        return F.when(F.size(some) > 1, F.aggregate(some, start, line, lambda s: s["rows"])).otherwise(alone)

    def reach(x, span):
        starts = F.when(x["i"] >= x["far"], F.concat(x["starts"], F.array(x["i"] + 1))).otherwise(x["starts"])
        return F.struct((x["i"] + 1).alias("i"), F.greatest(x["far"], x["i"] + span).alias("far"), starts.alias("starts"))

    def blocks(all_rows):
        spans = F.transform(all_rows, lambda r: F.coalesce(F.array_max(F.transform(r["cells"], lambda c: c["rowspan"])), F.lit(1)))
        start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("far"), none("array<int>").alias("starts"))
        cut = F.aggregate(spans, start, reach, lambda x: F.concat(x["starts"], F.array(x["i"] + 1)))
        return bound(cut, lambda at: F.flatten(F.transform(F.slice(at, 1, F.size(at) - 1), lambda a, i: block(F.slice(all_rows, a, F.get(at, i + 1) - a)))))

    spanned = F.exists(rows, lambda r: F.exists(r["cells"], lambda c: c["rowspan"] > 1))
    return F.when(spanned, blocks(rows)).otherwise(F.transform(rows, lambda r: F.struct(r["section"].alias("section"), _spread(r).alias("cells"))))


def _all_th(row: Column) -> Column:
    return (F.size(row["cells"]) > 0) & F.forall(row["cells"], lambda c: c["tag"] == "th")


def table_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               tables: Sequence[int] | None = None,
               locate_alt: tuple[str, int] | None = None,
               carry: Sequence[str] = (), spread: bool = True) -> DataFrame:
    """One row per table row of every page: ``(page_id, table_idx, row_idx, section,
    header_row, cells, td_cells, img_alts, alt_col, header, body_idx)``; ``header`` holds,
    per column, the texts of the table's header levels (flatten with ``array_join`` or take
    the last); ``body_idx`` numbers the non-header rows of a table from 0 (null on header
    rows), which is how rows of sibling tables line up.  Header rows are those of ``<thead>``,
    or else the leading rows made only of ``<th>`` cells.

    ``tables`` keeps only those table positions (``read_html(...)[n]``).  ``locate_alt =
    (name, t)`` fills ``alt_col`` with the position of the header cell of table ``t`` whose
    image alt text is ``name`` (the sportsbook column), null when absent.  ``carry`` names
    page columns (a date, a team) copied onto every row of the page, so no join back to
    the pages is needed.  ``spread=False`` leaves the pages in the partitions they have: to count
    those of pages that a query makes would run their shuffles once more."""
    carry = list(carry)
    src = pages.select(pages[id_col].cast("long").alias("page_id"), pages[html_col].alias("_html"), *carry)
    src = ensure_parallel(src) if spread else src
    found = src.select("page_id", *carry, once(src, "tables", lambda: _tables(marked(F.col("_html"), _TAGS))).alias("_tables"))
    wanted = None if tables is None else sorted({*tables, *([locate_alt[1]] if locate_alt else [])})
    if wanted is not None:
        found = found.withColumn("_tables", F.filter("_tables", lambda t: t["idx"].isin(wanted)))
    read = once(src, "read", lambda: F.transform("_tables", lambda t: F.struct(t["idx"].alias("idx"), _rows(t["body"]).alias("rows"))))
    found = found.withColumn("_tables", read)
    found = found.withColumn("_tables", once(src, "placed", lambda: F.transform("_tables", lambda t: F.struct(t["idx"].alias("idx"), _placed(t["rows"]).alias("rows")))))
    if locate_alt is None:
        found = found.withColumn("alt_col", F.lit(None).cast("int"))
    else:
        name, at = locate_alt
        spot = F.transform(F.get(F.filter("_tables", lambda t: t["idx"] == at), 0)["rows"],
                           lambda r: F.array_position(F.transform(r["cells"], lambda c: (c["tag"] == "th") & c["alt"].eqNullSafe(name)), True))
        found = found.withColumn("alt_col", (F.get(F.filter(spot, lambda p: p > 0), 0) - 1).cast("int"))
    # explode_outer: the filter that Spark puts before explode would read every page a second time
    one = found.select("page_id", *carry, "alt_col", F.explode_outer("_tables").alias("_t")).where("_t.idx IS NOT NULL")
    if tables is not None:
        one = one.where(F.col("_t.idx").isin(*tables))
    rows = one.select("page_id", *carry, "alt_col", F.col("_t.idx").alias("table_idx"), F.col("_t.rows").alias("_rows"))
    first_other = F.array_position(F.transform("_rows", _all_th), False)
    rows = rows.withColumn("_thead", F.exists("_rows", lambda r: r["section"].eqNullSafe("thead"))).withColumn(
        "_lead", F.when(first_other > 0, first_other - 1).otherwise(F.size("_rows")))
    whole = F.transform("_rows", lambda r, i: F.struct(r["section"].alias("section"), r["cells"].alias("cells"), i.alias("row_idx"),
                                                       F.when(F.col("_thead"), r["section"].eqNullSafe("thead")).otherwise(i < F.col("_lead")).alias("head")))
    rows = rows.withColumn("_rows", whole).drop("_thead", "_lead")
    rows = rows.withColumn("_heads", F.filter("_rows", lambda r: r["head"]))
    width = F.coalesce(F.array_max(F.transform("_heads", lambda r: F.size(r["cells"]))), F.lit(0))
    levels = F.transform(F.sequence(F.lit(1), width), lambda i: F.transform("_heads", lambda r: stripped(F.coalesce(F.try_element_at(r["cells"], i)["text"], F.lit("")))))
    rows = rows.withColumn("header", F.when(width > 0, levels).otherwise(F.array().cast("array<array<string>>")))
    numbered = F.concat(F.transform("_heads", lambda r: F.struct(r.alias("row"), F.lit(None).cast("int").alias("body_idx"))),
                        F.transform(F.filter("_rows", lambda r: ~r["head"]), lambda r, i: F.struct(r.alias("row"), i.alias("body_idx"))))
    rows = rows.select("page_id", *carry, "alt_col", "table_idx", "header", F.explode_outer(numbered).alias("_r")).where("_r.row IS NOT NULL")
    r = F.col("_r.row")
    return rows.select(
        "page_id", "table_idx", r["row_idx"].alias("row_idx"), r["section"].alias("section"), (r["section"].eqNullSafe("thead") | _all_th(r)).alias("header_row"),
        F.transform(r["cells"], lambda c: c["text"]).alias("cells"),
        F.transform(F.filter(r["cells"], lambda c: c["tag"] == "td"), lambda c: c["text"]).alias("td_cells"),
        F.transform(r["cells"], lambda c: c["alt"]).alias("img_alts"), "alt_col", "header", F.col("_r.body_idx").alias("body_idx"), *carry)
