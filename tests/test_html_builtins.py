"""Tables, lists and entities in built-in SQL against plain parsers, on generated, fixture and driver pages."""

import html
import random

import pytest
from pyspark.sql import functions as F

from courtline.functions.html import unescaped
from courtline.sources import list_items, table_rows
from html_reference import parse_lists, table_rows_plain
from site_pages import landed_pages

ODD = ["", None, "<table></table>", "<table/>", "<table><tr><td/>x<td>y</table></table>z", "<td>x</td>", "text & more", "<table><tr><td colspan=1200>w</td></tr></table>",
       "<table>" + "<tr><td rowspan=1500>a</td><td>b</td></tr>" + "<tr><td>c</td></tr>" * 1200 + "</table>", "<table><tr><td>\u0001a\u0002</td></tr></table>",
       "<table><tr><th>A</th><th>B<table><tr><td>in</td></tr></table>after</th></tr><tr><td>1</td></tr></table>", "<!-- <table><tr><td>no</td></tr></table>", "<ul><li>x<!--"]


def table_pages(n=150):
    rng = random.Random(1)

    def cell():
        tag = rng.choice(["td", "th"])
        span = rng.choice([""] * 3 + [' colspan="2"', " rowspan=2", " colspan='3'", " COLSPAN=x", ' rowspan="3" colspan=2', " rowspan=0"])
        raw = "".join(rng.choice([*"ab c&<>\"'é\n\t;#0123456789-", "&amp;", "&#65;", "<b>", "</i>", "<br/>"]) for _ in range(rng.randint(0, 10)))
        body = raw.replace("<", "< ") if rng.random() < 0.5 else html.escape(raw, quote=False)
        return f"<{tag}{span}>" + rng.choice(["", '<img alt="DraftKings">', "<img alt='A &amp; B'/>", "<a title='<td>'>"]) + body + rng.choice(["", f"</{tag}>"])

    for _ in range(n):
        out = ["<html><head><script>var s='<table><td>x</td>';</script><!-- <table> --></head>"]
        for _ in range(rng.randint(0, 4)):
            out.append(rng.choice(["<table>", "<TABLE class='x'>"]) + rng.choice(["", "<thead>", "<tbody>"]))
            for _ in range(rng.randint(0, 4)):
                out.append(rng.choice(["<tr>", "<tr class='a'>", "", "<tr/>"]) + "".join(cell() for _ in range(rng.randint(0, 5))) + rng.choice(["</tr>", "", "</thead>"]))
            out.append(rng.choice(["</table>", "</tbody></table>", ""]) + "text")      # an unclosed table holds the next
        yield "".join(out)


def list_pages(n=250):
    rng = random.Random(2)
    bits = ["<ul>", "<ul class='page_index x'>", "<UL class=page_index>", "</ul>", "<li>", "<li class='q'>", "</li>", "<span>", "<span class=d>", "</span>", "<p>", "</p>",
            "<a href='/x?a=1&amp;b'>", '<a href="/y">', "<a>", "</a>", "<b>", "text", " a &amp; b ", "&copy;", "<script>'</li>'</script>", "<!-- <li> -->", "<pre>", "é\n"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def landed(spark, pages):
    return spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").repartition(4)


@pytest.mark.parametrize("alt, at", [("DraftKings", 1), ("A & B", 0)])
def test_tables_are_those_of_the_plain_parser(spark, alt, at):
    pages = [*table_pages(), *ODD, *(p for _i, _u, p in landed_pages())]
    got = sorted((tuple(r) for r in table_rows(landed(spark, pages), locate_alt=(alt, at)).collect()), key=str)
    plain = lambda p: p if p is None else p.replace("\u0001", "").replace("\u0002", "")  # noqa: E731  marks are no text
    assert got == sorted((r for i, p in enumerate(pages) for r in table_rows_plain(i, plain(p), alt, at)), key=str)


@pytest.mark.parametrize("ul_class", [None, "page_index"])
def test_lists_are_those_of_the_plain_parser(spark, sf_dir, ul_class):
    pages = [*list_pages(), *ODD, *(p for _i, _u, p in landed_pages()), *(r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect())]
    got = sorted((tuple(r) for r in list_items(landed(spark, pages), ul_class).collect()), key=str)
    assert got == sorted(((i, *r) for i, p in enumerate(pages) for r in parse_lists(p, ul_class)), key=str)


def test_chosen_tables_and_carried_columns(spark):
    pages = landed(spark, list(table_pages(30))).withColumn("day", F.col("page_id") * 2)
    whole, some = table_rows(pages, carry=["day"]), table_rows(pages, tables=[1], carry=["day"])
    assert some.columns[-1] == "day" and some.where("day != 2 * page_id").isEmpty()
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.where("table_idx = 1").collect()))


def test_references_are_decoded_as_by_the_standard_library(spark):
    texts = ["a &amp; b", "&lt;x&gt;", "&notit; &notin; x", "&#65;&#x42;&#x80;&#150;&#0;&#xD800;&#1114112;&#99999999999;&#13;&#7;&#xFEFF;&#128512;", "&copy2020 &copy; &hellip;&hell &&& &#; &#x; &ampamp;",
             "&;", "plain", "&Acirc&acirc", "& &nbsp;x&nbspy", "&" + "abcdefgh" * 5 + ";", "&ltabc", "&bne; &NotEqualTilde;", "&#x1F600", "&#65x", "&#0065;", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", unescaped(F.col("t")).alias("u")).collect()
    assert {r.i: r.u for r in rows} == {i: None if t is None else html.unescape(t) for i, t in enumerate(texts)}


def test_no_python_in_the_plan(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for df in (table_rows(pages), list_items(pages)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "ArrowEval" not in plan and "EvalPython" not in plan


def test_spans_and_references_of_the_short_ways(spark):
    """One cell from above at any place, a row too short for it, several of them, other end tags."""
    pages = ["<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>" for rows in (
        ["<td>a</td><td rowspan=3>b</td><td>c</td>", "<td>d</td><td>e</td>", "<td>f</td>", "<td>g</td>"],
        ["<td>a</td><td>b</td><td rowspan='2'>c</td>", "", "<td>d</td>"],
        ["<th rowspan=2>a</th><td rowspan=3>b</td>", "<td>c</td>", "<td rowspan=2>d</td>", "<td colspan=2>e</td>"],
        ["<td rowspan=2>a</td><td>b</td>", "<td colspan=2>c</td>"],
        ["<td>x &amp; y</td>", "<td>&amp;amp; &amp;lt;</td>", "<td>&amp &lt;&amp;</td>", "<td>a</th>b</td>", "<td>a</TD >b</td>", "<td>&amp;<b>lt;</b></td>"])]
    got = sorted((tuple(r) for r in table_rows(landed(spark, pages)).collect()), key=str)
    assert got == sorted((r for i, p in enumerate(pages) for r in table_rows_plain(i, p)), key=str)
