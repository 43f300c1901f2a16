"""Scans: landed HTML pages, forum dumps, logs, CSV/JSON files and warehouse tables."""

from courtline.sources.files import read_csv, read_json, read_log_lines, read_table  # noqa
from courtline.sources.html_lists import list_items  # noqa
from courtline.sources.html_tables import table_rows  # noqa
