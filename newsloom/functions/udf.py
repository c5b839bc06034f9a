"""What Spark's functions lack, as Arrow-batched UDFs, and the functions under SQL names."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode compatibility composition; null stays null."""
    return text.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    """All named and numbered entities."""
    return text.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def decode_bytes(raw: pd.Series, charset: pd.Series) -> pd.Series:
    """Bytes by the charset named beside them; unknown names are read as UTF-8, bad bytes become marks."""

    def one(b, name):
        try:
            return None if b is None else bytes(b).decode(name or "utf-8", "replace")
        except LookupError:
            return bytes(b).decode("utf-8", "replace")

    return pd.Series([one(b, n) for b, n in zip(raw, charset, strict=True)], dtype=object)


def effective_text(raw):
    """Tags go first, entities second, white space collapses: what a reader sees."""
    bare = html_unescape(F.regexp_replace(F.coalesce(raw, F.lit("")), r"<[^>]*>", " "))
    return F.trim(F.regexp_replace(bare, r"[\s\x{a0}]+", " "))


def comparable(text):
    """NFKC and lower case, without punctuation, marks of separation and blanks."""
    return F.regexp_replace(F.lower(nfkc(F.coalesce(text, F.lit("")))), r"[\p{P}\p{Z}\s]", "")


def register(spark: SparkSession) -> list[str]:
    """The engine's own functions for ``spark.sql``."""
    spark.udf.register("nfkc", nfkc)
    spark.udf.register("html_unescape", html_unescape)
    spark.udf.register("decode_bytes", decode_bytes)
    return ["nfkc", "html_unescape", "decode_bytes"]
