"""Category label: English name, else native name, else 'Unknown'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.sources.schemas import UNKNOWN_CATEGORY


def category_label(english="product_category_name_english", native="product_category_name") -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.coalesce(c(english), c(native), F.lit(UNKNOWN_CATEGORY))
