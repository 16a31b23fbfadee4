"""Functions that need Unicode tables the JVM expressions lack, as Arrow-batched UDFs."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxoloom.functions import text


def each(s: pd.Series, f) -> pd.Series:
    return s.map(lambda x: None if x is None else f(x))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition."""
    return each(s, lambda x: unicodedata.normalize("NFC", x))


@F.pandas_udf(T.StringType())
def slug_upper(s: pd.Series) -> pd.Series:
    """Upper-case ASCII slug. Letters without a decomposition, such as ``Đ``, become ``_``."""

    def one(x: str) -> str:
        bare = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
        return re.sub("[^A-Za-z0-9]+", "_", bare).strip("_").upper()

    return each(s, one)


@F.pandas_udf(T.StringType())
def name_key(s: pd.Series) -> pd.Series:
    """Compatibility form, single blanks, case folded."""
    return each(s, lambda x: " ".join(unicodedata.normalize("NFKC", x).split()).casefold())


def clean_text(c: Column | str) -> Column:
    return text.normalize_whitespace(nfc(text.strip_html_tags(c)))
