"""Scalar column functions (names, text, numbers, dates).

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it stays inside
whole-stage codegen; the only Python on the hot path is the Arrow-batched accent fold.
"""

from courtline.functions.text import (  # noqa: F401
    accent_fold,
    clean_names,
    collapse_ws,
    currency_to_long,
    extract_first,
    extract_tokens_joined,
    first_token,
    html_cell_text,
    map_values,
    md5_key,
    replace_all,
    spread_filter,
    zero_pad,
)
from courtline.functions.dates import (  # noqa: F401
    parse_long_date,
    parse_weekday_date,
    date_time_to_ts,
    season_label,
    season_type,
    schedule_months,
    ts_ntz_lit,
)
