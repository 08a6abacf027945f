"""Headline packs: one text block per case, and its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_headlines(df: DataFrame, id_col: str = "case_id", text_col: str = "pack") -> DataFrame:
    """(id, date, headline_id, headline): one row per ``## Hnn`` section."""
    sections = F.split(F.col(text_col), r"(?m)^## (?=H[0-9]{2,}[ \t]*$)")
    date = F.nullif(F.regexp_extract(F.col(text_col), r"(?m)^# Date: (.*)$", 1), F.lit(""))
    rows = df.select(id_col, date.alias("date"), F.posexplode(sections).alias("at", "section")).where("at > 0")
    return rows.select(
        id_col,
        "date",
        F.regexp_extract("section", r"^(H[0-9]+)", 1).alias("headline_id"),
        F.btrim(F.regexp_replace("section", r"^H[0-9]+[^\n]*\n?", ""), F.lit(" \t\r\n")).alias("headline"),
    )


def headline_rows(df: DataFrame, id_col: str, items_col: str) -> DataFrame:
    """(id, headline_id, headline) from an ordered array of headlines, numbered H01 onward."""
    rows = df.select(id_col, F.posexplode(items_col).alias("at", "headline"))
    return rows.select(id_col, F.format_string("H%02d", F.col("at") + 1).alias("headline_id"), "headline")


def render_headlines(df: DataFrame, id_col: str = "case_id") -> DataFrame:
    """(id, pack): the text block of (id, date, headline_id, headline) rows.

    A pack is one document, so its sections meet in one row by definition.
    """
    number = F.regexp_extract("headline_id", r"([0-9]+)", 1).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct(number.alias("n"), "headline_id", "headline")))
    packs = df.groupBy(id_col).agg(F.min("date").alias("date"), ordered.alias("items"))
    body = F.transform("items", lambda s: F.concat(F.lit("## "), s["headline_id"], F.lit("\n"), s["headline"], F.lit("\n")))
    head = F.concat(F.lit("# External Event Feed\n# Date: "), F.col("date"), F.lit("\n"))
    return packs.select(id_col, F.concat_ws("\n", head, F.array_join(body, "\n")).alias("pack"))
