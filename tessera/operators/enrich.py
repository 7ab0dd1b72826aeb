"""Dimension enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators.clean import clean_keys_then_dedup

# The asset columns the reference keeps and how it renames them.
ASSET_COLUMNS = ["asset_number", "lob", "pl", "ppl", "dlr_region", "dlr_state",
                 "dlr_org_city", "dlr_district"]
ASSET_RENAMES = {"dlr_region": "Region", "dlr_state": "State",
                 "dlr_org_city": "City", "dlr_district": "District"}


def prepare_assets(assets: DataFrame, key: str = "asset_number") -> DataFrame:
    """Project, rename, clean keys (tabs too), then deduplicate on the clean key."""
    return clean_keys_then_dedup(assets.select(*ASSET_COLUMNS), key, ASSET_RENAMES)


def enrich_left(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Left join keeping every fact row; both key columns stay.

    The strategy is Spark's: a broadcast when the dimension's size is under the
    threshold (re-checked at run time by AQE), else a sort-merge join that AQE
    splits on skewed keys, or a join without exchange of bucketed tables.
    """
    return fact.join(dim, fact[fact_key] == dim[dim_key], "left")
