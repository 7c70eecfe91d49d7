"""Spreadsheet addresses and header names."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the public sheet address.
SHEET_HOST = "docs.google.com"
SHEET_PATH = "/spreadsheets/d/"


def is_sheet_url(url: Column) -> Column:
    return F.coalesce(
        (F.try_parse_url(url, F.lit("HOST")) == SHEET_HOST)
        & F.startswith(F.try_parse_url(url, F.lit("PATH")), F.lit(SHEET_PATH)),
        F.lit(False),
    )


def spreadsheet_id(url: Column) -> Column:
    path = F.try_parse_url(url, F.lit("PATH"))
    return F.when(is_sheet_url(url), F.split_part(path, F.lit("/"), F.lit(4)))


def worksheet_id(url: Column) -> Column:
    return F.when(is_sheet_url(url), F.try_parse_url(url, F.lit("QUERY"), F.lit("gid")))


def csv_export_url(spreadsheet: Column, worksheet: Column, query: Column) -> Column:
    """The address that returns a sheet, or the result of a query on it, as CSV."""

    def parameter(name: str, value: Column) -> Column:
        filled = F.nullif(value, F.lit(""))
        return F.concat(F.lit(f"{name}="), F.url_encode(filled))

    query_string = F.concat_ws(
        "&", parameter("tqx", F.lit("out:csv")), parameter("gid", worksheet), parameter("tq", query)
    )
    return F.concat(F.lit(f"https://{SHEET_HOST}{SHEET_PATH}"), spreadsheet, F.lit("/gviz/tq?"), query_string)


def header_names(line: str) -> list[str]:
    """Column names of a header line."""
    return unique_names(next(csv.reader([line]), []))


def unique_names(cells: Iterable[str | None]) -> list[str]:
    """Column names of header cells: blanks become ``Unnamed: i``, repeats get ``.n``."""
    names: list[str] = []
    for position, raw in enumerate(cells):
        base = raw or f"Unnamed: {position}"
        name, repeat = base, 0
        while name in names:
            repeat += 1
            name = f"{base}.{repeat}"
        names.append(name)
    return names
