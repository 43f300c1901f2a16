"""HTML lists of a landed ``pages(page_id, url, html)`` table, one row for each ``<li>``, in built-in SQL.

A fold over a page's ``<ul>`` tags cuts out the lists of one class; entries of lists inside an entry
belong to that entry's text.  Unclosed entries and paragraphs end where the next begins.  Null or
empty pages, and pages without such a list, give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions.html import CLOSE, GAP, OPEN, attribute, bound, content, marked, once, pieces, text_of, until
from courtline.session import ensure_parallel

_TAGS = ["ul", "li", "span", "p", "a"]


def _lists(text: Column, ul_class: str | None) -> Column:
    """array<string>: the markup of every outermost list of the class."""
    def step(s, piece):
        opens = F.regexp_like(piece, F.lit(r"(?i)^<ul[\s/>]"))
        wanted = F.lit(True) if ul_class is None else F.coalesce(F.array_contains(F.split(attribute(piece, "class"), r"\s+"), ul_class), F.lit(False))
        starts = opens & (s["depth"] == 0) & wanted
        depth = (F.when(opens, F.when((s["depth"] > 0) | wanted, s["depth"] + 1).otherwise(F.lit(0)))
                 .otherwise(F.greatest(s["depth"] - 1, F.lit(0))))

        def grown(d):
            inner = F.regexp_replace(content(piece), rf"(?i){OPEN}</?li[\s/>][^{CLOSE}]*+{CLOSE}", GAP)
            more = F.when(d == 1, content(piece)).when(d > 1, inner).otherwise(F.lit(""))
            last = F.size(s["done"])
            done = (F.when(starts, F.concat(s["done"], F.array(more)))
                    .when(d > 0, F.concat(F.slice(s["done"], 1, last - 1), F.array(F.concat(F.try_element_at(s["done"], last), more)))).otherwise(s["done"]))
            return F.struct(d.alias("depth"), done.alias("done"))

        return bound(depth, grown)

    cut = pieces(text, "ul", ends=True)
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("done"))
    return F.aggregate(F.slice(cut, 2, 1 << 30), start, step, lambda s: s["done"])


def _entry(piece: Column) -> Column:
    """date, items, text and href of one entry, from its start tag on."""
    def entry(inside):
        after = F.array_join(F.slice(pieces(inside, "span"), 2, 1 << 30), OPEN + "<")    # from the first span on
        ended = F.regexp_like(after, F.lit(rf"(?i){OPEN}</span[\s/>]"))
        paragraphs = F.transform(F.slice(pieces(inside, "p"), 2, 1 << 30), lambda p: text_of(until(content(p), "p")))
        links = F.transform(F.slice(pieces(inside, "a"), 2, 1 << 30), lambda p: attribute(p, "href"))
        return F.struct(F.when(ended, text_of(until(content(after), "span"))).alias("date"), paragraphs.alias("items"),
                        text_of(inside).alias("text"), F.get(F.filter(links, lambda h: h.isNotNull()), 0).alias("href"))

    return bound(until(content(piece), "li"), entry)


def list_items(pages: DataFrame, ul_class: str | None = None, id_col: str = "page_id",
               html_col: str = "html") -> DataFrame:
    """One row per ``<li>`` of the selected lists: ``(page_id, ul_idx, li_idx, date, items,
    text, href)``; ``date`` is the entry's first ``<span>`` text (null when absent), ``items``
    the texts of its ``<p>`` elements."""
    src = ensure_parallel(pages.select(pages[id_col].cast("long").alias("page_id"), pages[html_col].alias("_html")))
    found = once(src, f"lists {ul_class!r}", lambda: _lists(marked(F.col("_html"), _TAGS), ul_class))
    lists = src.select("page_id", F.posexplode(found).alias("ul_idx", "_list"))
    cut = pieces(F.col("_list"), "li")
    entries = lists.select("page_id", "ul_idx", F.posexplode(F.slice(cut, 2, 1 << 30)).alias("li_idx", "_piece"))
    return entries.withColumn("_e", once(src, "entry", lambda: _entry(F.col("_piece")))).select("page_id", "ul_idx", "li_idx", "_e.date", "_e.items", "_e.text", "_e.href")
