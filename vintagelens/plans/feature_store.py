"""Attribute, financial and clickstream feeds to the customer feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vintagelens.operators import features, silver
from vintagelens.plans.datamart import FEATURE_FEEDS, Datamart
from vintagelens.sources.feeds import bronze, read_feed
from vintagelens.sources.snapshots import read_all, snapshot_between, write_snapshots

SILVER = {"attributes": silver.attributes, "financials": silver.financials, "clickstream": silver.clickstream}


def feature_store(attributes: DataFrame, financials: DataFrame, clickstream: DataFrame) -> DataFrame:
    """Gold features of all snapshots from the three raw tables."""
    return features.feature_store(
        silver.attributes(attributes), silver.financials(financials), silver.clickstream(clickstream)
    )


def run(spark: SparkSession, feeds: dict[str, str], mart: Datamart, start: str, end: str) -> DataFrame:
    """Bronze, silver and gold of a period; ``feeds`` names the CSV path of each feed."""
    for feed in FEATURE_FEEDS:
        write_snapshots(bronze(read_feed(spark, feeds[feed]), start, end), mart.feature_bronze(feed), period=(start, end))
        raw = snapshot_between(read_all(spark, mart.feature_bronze(feed)), start, end)
        write_snapshots(SILVER[feed](raw), mart.feature_silver(feed), rebalance=False, period=(start, end))
    cleaned = [snapshot_between(read_all(spark, mart.feature_silver(f)), start, end) for f in FEATURE_FEEDS]
    write_snapshots(features.feature_store(*cleaned), mart.feature_store, period=(start, end))
    return snapshot_between(read_all(spark, mart.feature_store), start, end)
