"""Region dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Fixed value: sales regions and their states.
STATE_REGIONS = {
    "mid_atlantic": ("DC", "DE", "MD", "NJ", "NY", "PA"),
    "mid_west": ("IA", "IL", "IN", "KS", "MI", "MN", "MO", "ND", "NE", "OH", "SD", "WI"),
    "new_england": ("CT", "MA", "ME", "NH", "RI", "VT"),
    "south": ("AL", "AR", "FL", "GA", "KY", "LA", "MS", "NC", "PR", "SC", "TN", "VA", "VI", "WV"),
    "south_west": ("AZ", "NM", "OK", "TX"),
    "west": ("AK", "CA", "CO", "HI", "ID", "MT", "NV", "OR", "UT", "WA", "WY"),
}


def region_table(spark: SparkSession, members: dict[str, Sequence[str]]) -> DataFrame:
    """(member, region) rows from a mapping of regions to members.

    Country-to-continent tables are given the same way, by the caller.
    """
    rows = [(m, region) for region, listed in members.items() for m in listed]
    return spark.createDataFrame(rows, "member string, region string")


def state_regions(spark: SparkSession) -> DataFrame:
    return region_table(spark, STATE_REGIONS)
