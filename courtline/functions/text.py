"""Text and number cleaning as Column expressions.

Regexes are Java regexes.  ``(?U)`` turns on Unicode character classes so that ``\\s``
matches a no-break space and ``\\b`` treats accented letters as word characters, which is
what the pandas ``.str`` methods of the source pipelines do.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name suffixes removed by name cleaning; the order matters, a suffix goes
# before any other that begins it.
NAME_SUFFIXES = [" Jr.", " Sr.", " III", " II", " IV"]

# Team codes of the stats site mapped to the codes used in the warehouse.
TEAM_CODE_MAP = {"PHO": "PHX", "CHO": "CHA", "BRK": "BKN"}

# Fixed value: a spread magnitude above this is a moneyline, not a spread.
SPREAD_MAX = 25


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.arrow_udf(T.StringType())
def _accent_fold_udf(s: pa.Array) -> pa.Array:
    # two Arrow kernels on the whole batch: decompose, then keep ASCII
    return pc.replace_substring_regex(pc.utf8_normalize(s, form="NFKD"), pattern=r"[^\x00-\x7F]+", replacement="")


def accent_fold(c: str | Column) -> Column:
    """Compatibility-decompose and drop every non-ASCII code point (null stays null).

    Spark has no Unicode normaliser, so this is the one Arrow UDF on the text path."""
    return _accent_fold_udf(_col(c))


def clean_names(c: str | Column) -> Column:
    """Remove the generational suffixes literally, anywhere in the value, in fixed order."""
    return reduce(lambda acc, suf: F.replace(acc, F.lit(suf), F.lit("")), NAME_SUFFIXES, _col(c))


def replace_all(c: str | Column, pairs: list[tuple[str, str]]) -> Column:
    """Chain of literal substring replacements, applied in order."""
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, _col(c))


def map_values(c: str | Column, mapping: dict[str, str]) -> Column:
    """Whole-value map; values not in the map pass through unchanged."""
    c = _col(c)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    return c if expr is None else expr.otherwise(c)


def collapse_ws(c: str | Column) -> Column:
    """Every run of (Unicode) whitespace becomes one space."""
    return F.regexp_replace(_col(c), r"(?U)\s+", " ")


def html_cell_text(c: str | Column) -> Column:
    """Cell text the way a table reader reports it: outer whitespace stripped, line breaks
    and runs of two or more whitespace characters collapsed to one space, '' as null."""
    stripped = F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")
    return F.nullif(F.regexp_replace(stripped, r"(?U)[\r\n]+|\s{2,}", " "), F.lit(""))


def extract_first(c: str | Column, pattern: str, group: int = 1) -> Column:
    """First match of a capture group; no match gives null (not '')."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def extract_tokens_joined(c: str | Column, pattern: str = r"(?U)\b([A-Z]{2,3})\b",
                          sep: str = " ") -> Column:
    """All matches of a capture group joined within the row (e.g. team codes)."""
    return F.array_join(F.regexp_extract_all(_col(c), F.lit(pattern), 1), sep)


def first_token(c: str | Column) -> Column:
    """First whitespace-separated token."""
    return F.get(F.split(F.trim(_col(c)), r"(?U)\s+"), 0)


def spread_filter(c: str | Column) -> Column:
    """Keep the tokens that look like a point spread: a signed number whose magnitude is at
    most 25, or a bare integer at most 25.  Kept tokens are joined by one space.

    Tokens that cannot be read as a number (``+EVEN``) are dropped rather than failing the
    whole dataset."""
    toks = F.split(F.trim(_col(c)), r"(?U)\s+")

    def keep(t: Column) -> Column:
        magnitude = F.substring(t, 2, 1 << 30).try_cast(T.DoubleType())
        signed = F.substring(t, 1, 1).isin("+", "-") & F.coalesce(magnitude <= SPREAD_MAX,
                                                                 F.lit(False))
        bare = t.rlike(r"^[0-9]+$") & F.coalesce(
            t.try_cast(T.DecimalType(38, 0)) <= SPREAD_MAX, F.lit(False))
        return signed | bare

    return F.array_join(F.filter(toks, keep), " ")


def md5_key(*cols: str | Column) -> Column:
    """Hex MD5 of the concatenated values, a missing value spelled ``None``."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("None")) for c in cols]
    return F.md5(F.concat(*parts))


def zero_pad(c: str | Column, width: int = 2) -> Column:
    """Left-pad an integer with zeros to ``width`` digits without ever truncating."""
    return F.format_string(f"%0{width}d", _col(c).cast("long"))


def currency_to_long(c: str | Column) -> Column:
    """``$1,234,567`` -> 1234567 (strict: junk fails under ANSI)."""
    return F.regexp_replace(_col(c), r"[$,]", "").cast("long")
