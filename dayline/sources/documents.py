"""Nested JSON documents and HTML tables to typed rows."""

from __future__ import annotations

import json
from collections.abc import Mapping
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.functions.dates import STATION_STAMP, parse_date, parse_timestamp

# Columns of the station feed that carry nothing for us.
_STATION_DROPS = ("est", "nord", "fine", "inizio")

# Columns of the station page's table, in page order.
STATION_PAGE_COLUMNS = {
    "Pioggia (mm)": "precipitation_total",
    "Temp. aria (°C)": "temperature_mean",
    "Umidita' aria (%)": "humidity_mean",
    "Vel. Vento (m/s)": "wind_speed_mean",
    "Pressione atm. (hPa)": "atmospheric_pressure_mean",
    "Rad.Sol.Tot. (kJ/m2)": "solar_rad_total",
}


def explode_country_index(docs: DataFrame, country: str, field: str = "stringency",
                          text: str = "value") -> DataFrame:
    """``data: {date: {country: {field}}}`` to ``(date, value)``; error documents give no rows."""
    doc = F.from_json(F.col(text), f"status string, data map<string, map<string, "
                                   f"struct<`{field}`: double>>>").alias("d")
    days = (docs.select(doc).filter(F.col("d.status").isNull() | (F.col("d.status") != "error"))
            .select(F.explode("d.data").alias("day", "countries")))
    reading = F.try_element_at("countries", F.lit(country))
    return (days.filter(reading.isNotNull())
            .select(parse_date("day", "yyyy-MM-dd").alias("date"),
                    reading[field].alias("value")))


def explode_events(docs: DataFrame, text: str = "value") -> DataFrame:
    """Calendar ``items[]`` to ``(holiday, start, end)``, the end exclusive."""
    item = "array<struct<summary: string, start: struct<date: string>, end: struct<date: string>>>"
    return (docs.select(F.explode(F.from_json(F.col(text), f"items {item}")["items"]).alias("e"))
            .select(F.col("e.summary").alias("holiday"),
                    parse_date("e.start.date", "yyyy-MM-dd").alias("start"),
                    parse_date("e.end.date", "yyyy-MM-dd").alias("end")))


def scan_stations(docs: DataFrame, text: str = "value", active_only: bool = True) -> DataFrame:
    """``records[]`` of the station feed; a station is active while its end field is empty."""
    record = ("array<struct<id: string, nome: string, lat: double, lon: double, elev: double, "
              "est: double, nord: double, fine: string, inizio: string>>")
    rows = docs.select(F.inline(F.from_json(F.col(text), f"records {record}")["records"]))
    if active_only:
        rows = rows.filter(F.col("fine") == "")
    return rows.drop(*_STATION_DROPS).withColumnsRenamed({"id": "station_id", "nome": "name"})


def _named() -> Column:
    """The characters of all named entities of HTML, by name; a constant of the plan.

    The space that does not break is a plain one here, so that it is trimmed off values.
    """
    names = {name: char.replace(chr(160), " ") for name, char in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _decoded(cell: Column) -> Column:
    """Named and numeric entities as characters; a cell without an ampersand is left alone."""
    def one(part: Column, i: Column) -> Column:
        code = F.regexp_extract(part, "^#(?:([0-9]{1,7})|[xX][0-9a-fA-F]{1,6});", 1)
        hexed = F.regexp_extract(part, "^#[xX]([0-9a-fA-F]{1,6});", 1)
        digits = F.when(code != "", F.hex(code.cast("long"))).when(hexed != "", hexed)
        char = F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")
        name = F.regexp_extract(part, "^[A-Za-z][A-Za-z0-9]*;", 0)
        named = F.when(name != "", F.try_element_at(_named(), name))
        return F.when(i == 0, part).otherwise(F.coalesce(
            F.concat(char, F.regexp_replace(part, "^#[0-9xXa-fA-F]{1,8};", "")),
            F.concat(named, F.substring(part, F.char_length(name) + 1, F.char_length(part))),
            F.concat(F.lit("&"), part)))

    return F.when(cell.contains("&"), F.array_join(F.transform(F.split(cell, "&"), one), "")).otherwise(cell)


def _plain(cell: Column) -> Column:
    return F.trim(_decoded(F.regexp_replace(cell, r"<[^>]*>", "")))


def _cells(row: Column, cell_re: str) -> Column:
    return F.transform(F.regexp_extract_all(row, F.lit(cell_re), F.lit(1)), _plain)


# The elements of an HTML table.
TABLE = r"(?is)<table\b[^>]*>(.*?)</table\s*>"
TABLE_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
TABLE_CELL = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"


def first_table(page: Column) -> Column:
    """The inside of the first table of a page, up to its own end; of tables in it the text alone.

    The page is cut before each opening and closing tag of a table, and each piece lies as deep as the
    tags before it say.
    """
    pieces = F.split(page, r"(?i)(?=<table\b)|(?=</table\s*>)")

    def step(state: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"^(?i)<table\b"), piece.rlike(r"^(?i)</table\s*>")
        depth = state["depth"] + F.when(opens, 1).when(closes & (state["depth"] > 0), -1).otherwise(0)
        text = F.regexp_replace(piece, r"^(?i)</?table\b[^>]*>", "")
        text = F.when(depth > 1, F.regexp_replace(text, r"<[^>]*>", "")).otherwise(text)
        return F.struct(
            F.when(state["done"], state["depth"]).otherwise(depth).alias("depth"),
            (state["done"] | ((state["depth"] == 1) & (depth == 0))).alias("done"),
            F.when(~state["done"] & (depth > 0), F.concat(state["inside"], F.array(text))).otherwise(state["inside"]).alias("inside"))

    begin = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("inside"))
    nested = F.aggregate(pieces, begin, step, lambda s: F.when(s["done"], F.array_join(s["inside"], "")).otherwise(""))
    alone = F.regexp_count(page, F.lit(r"(?i)<table\b")) < 2
    return F.when(alone, F.regexp_extract(page, TABLE, 1)).otherwise(nested)


def html_rows(pages: DataFrame, html: str = "html", row_re: str = TABLE_ROW,
              cell_re: str = TABLE_CELL, within_re: str | None = TABLE,
              header_row: int | None = None) -> DataFrame:
    """One row per row element of the first enclosing element: its position and cell texts.

    The enclosing element is the first table, unless ``within_re`` names another or is None; rows of
    tables in its cells are not rows of it, their text belongs to the cell.

    With ``header_row`` the texts of that row come along as ``header``.
    """
    kept = [c for c in pages.columns if c != html]
    body = F.col(html) if within_re is None else \
        first_table(F.col(html)) if within_re == TABLE else F.regexp_extract(F.col(html), within_re, 1)
    found = F.regexp_extract_all(body, F.lit(row_re), F.lit(1))
    # cells are cut out before rows are, so that nothing downstream cuts them again
    pages = pages.select(*kept, F.transform(found, lambda r: _cells(r, cell_re)).alias("_rows"))
    head = [] if header_row is None else [F.get("_rows", F.lit(header_row)).alias("header")]
    # the outer form: the plain one adds a filter that would cut all cells again to count them
    rows = pages.select(*kept, *head, F.posexplode_outer("_rows").alias("row", "cells"))
    return rows.filter(F.col("row").isNotNull())


def station_days(pages: DataFrame, key: str = "station_id", html: str = "html",
                 columns: Mapping[str, str] = STATION_PAGE_COLUMNS, header_row: int = 2,
                 first_data_row: int = 4) -> DataFrame:
    """Daily readings of landed station pages.

    The header row names the cells, so a page may order or leave out measures. Rows need a date
    and at least one reading.
    """
    rows = html_rows(pages.select(key, html), html, header_row=header_row)
    rows = rows.filter(F.col("row") >= first_data_row)

    def named(name: str) -> Column:
        """The cell under a header; blank and dashed cells are NULL without a costly parse."""
        at = F.array_position("header", F.lit(name)).cast("int")
        cell = F.when(at > 0, F.get(F.col("cells"), at - 1))
        return F.when(cell.rlike("[0-9]"), cell)

    out = rows.select(key, parse_timestamp(named("Date"), *STATION_STAMP).cast("date").alias("date"),
                      *[named(n).try_cast("double").alias(c) for n, c in columns.items()])
    measures = list(columns.values())
    return out.filter(F.col("date").isNotNull() & F.coalesce(*measures).isNotNull())
