"""The reference's UDF surface (U2-U5), re-expressed.

Native expressions are the default; the Arrow-batched pandas UDF twins are
here for the cases where a user really brings Python logic.  Every UDF is
NULL-safe and declares its return type (a Python ``int`` returned for a
``double`` column silently becomes NULL in a plain UDF).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Brand tiers of the reference.
HIGH_RANGE_BRANDS = ("Apple", "Samsung")
MID_RANGE_BRANDS = ("MI",)


def price_range(brand) -> Column:
    """Apple/Samsung -> High Range, MI -> Mid Range, anything else (NULL too) -> Low Range."""
    b = F.col(brand) if isinstance(brand, str) else brand
    return (F.when(b.isin(*HIGH_RANGE_BRANDS), "High Range")
             .when(b.isin(*MID_RANGE_BRANDS), "Mid Range")
             .otherwise("Low Range"))


def age_group(age) -> Column:
    """age <= 30 -> Young, else Older; NULL stays NULL."""
    a = F.col(age) if isinstance(age, str) else age
    return F.when(a.isNull(), None).when(a <= 30, "Young").otherwise("Older")


@F.pandas_udf(T.StringType())
def price_range_udf(brand: pd.Series) -> pd.Series:
    tier = pd.Series("Low Range", index=brand.index, dtype=object)
    tier[brand.isin(HIGH_RANGE_BRANDS)] = "High Range"
    tier[brand.isin(MID_RANGE_BRANDS)] = "Mid Range"
    return tier


@F.pandas_udf(T.StringType())
def age_group_udf(age: pd.Series) -> pd.Series:
    out = pd.Series(None, index=age.index, dtype=object)
    known = age.notna()
    out[known & (age <= 30)] = "Young"
    out[known & ~(age <= 30)] = "Older"
    return out


@F.pandas_udf(T.IntegerType())
def years_remaining_udf(age: pd.Series) -> pd.Series:
    return (100 - age).astype("Int32")


@F.pandas_udf(T.DoubleType())
def product_review_udf(rating: pd.Series, experience: pd.Series) -> pd.Series:
    return (rating.astype("float64") * experience.astype("float64")).astype("float64")
