"""Text hygiene and repair. Python runs only on the rows a native test cannot clear."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Control and format characters other than newline, carriage return and tab.
DISALLOWED = r"[\p{Cc}\p{Cf}&&[^\n\r\t]]"
_ESCAPED_BYTES = re.compile("(?:\x00[0-9A-Fa-f]{2})+")


def has_disallowed(col: Column) -> Column:
    return F.coalesce(col.rlike(DISALLOWED), F.lit(False))


def first_disallowed(col: Column) -> Column:
    return F.regexp_extract(col, f"({DISALLOWED})", 1)


@F.pandas_udf(T.StringType())
def char_name(chars: pd.Series) -> pd.Series:
    """``U+XXXX NAME`` of one character; null in, null out."""
    return chars.map(
        lambda c: f"U+{ord(c):04X} {unicodedata.name(c, 'UNKNOWN')}" if isinstance(c, str) and len(c) == 1 else None
    )


_REPAIRED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])


def _decode(match: re.Match) -> str:
    raw = bytes.fromhex(match.group().replace("\x00", ""))
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def repair(text: str) -> tuple[str, int]:
    """Decode runs of NUL-prefixed hex bytes, then compose to NFC; count what changed."""
    decoded, runs = _ESCAPED_BYTES.subn(_decode, text)
    composed = unicodedata.normalize("NFC", decoded)
    return composed, runs + (composed != decoded)


@F.pandas_udf(_REPAIRED)
def _repair(texts: pd.Series) -> pd.DataFrame:
    rows = [repair(t) if isinstance(t, str) else (None, 0) for t in texts]
    return pd.DataFrame(rows, columns=["text", "n"])


def normalize_text(col: Column) -> Column:
    """Struct of the repaired text and the number of replacements.

    Plain ASCII without NUL cannot change, so those rows ship a null to Python and keep their text.
    """
    clean = col.rlike(r"^[\x01-\x7F]*$")
    fixed_up = _repair(F.when(~clean, col))
    return F.struct(
        F.coalesce(fixed_up["text"], col).alias("text"),
        F.coalesce(fixed_up["n"], F.lit(0)).alias("n"),
    )
