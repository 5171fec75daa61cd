"""Statements of items from four cached tables (items, properties, values, article names); no network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def statements(wanted: DataFrame, values: DataFrame, items: DataFrame, properties: DataFrame) -> DataFrame:
    """(item_id, property, value, item_label, item_description): ``wanted`` (item_id, property) by property id or label; misses are null."""
    known = values.join(items.select(F.col("id").alias("item_id"), F.col("label").alias("item_label"), F.col("description").alias("item_description")), "item_id")
    known = known.join(properties.select(F.col("id").alias("property_id"), F.col("label").alias("property_label"), "datatype"), "property_id")
    names = known.select("*", F.explode(F.array_distinct(F.array("property_id", "property_label"))).alias("property"))
    return wanted.join(names, ["item_id", "property"], "left").select("item_id", "property", format_value("value", "datatype", "property_id").alias("value"), "item_label", "item_description")


def format_value(value: str, datatype: str, property_id: str) -> F.Column:
    """Times as 'day Month year' (publication dates as the year), others as they are; a time that is none gives ''."""
    moment = F.try_to_timestamp(F.regexp_replace(value, "^\\+", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    shown = F.when(F.col(property_id) == "P577", F.date_format(moment, "yyyy")).otherwise(F.date_format(moment, "dd MMMM yyyy"))
    return F.when(F.col(datatype).endswith("dateTime"), F.coalesce(shown, F.lit(""))).otherwise(F.col(value))


def entity_ids(articles: DataFrame, names: DataFrame) -> DataFrame:
    """``articles`` (name, site_id) with their item; a name that is cached as unknown has null, as a miss has."""
    return articles.join(names.select("name", "site_id", "item_id"), ["name", "site_id"], "left")


def entity_field(entities: DataFrame, path: str, to: str) -> DataFrame:
    """A field of the entities' JSON by path, such as $.labels.en.value."""
    return entities.withColumn(to, F.try_variant_get(F.try_parse_json("entity_data"), path, "string"))


def best_statements(claims: DataFrame) -> DataFrame:
    """Of each item and property the preferred claims if there are any, else the normal ones."""
    rank = F.when(F.col("rank") == "preferred", 2).when(F.col("rank") == "normal", 1).otherwise(0)
    top = claims.withColumn("__r", rank).filter("__r > 0")
    best = top.groupBy("item_id", "property_id").agg(F.max("__r").alias("__best"))
    return top.join(best, ["item_id", "property_id"]).filter("__r = __best").drop("__r", "__best")


def interwiki(sites: DataFrame, host: str = "en.wikipedia.org", local: bool | None = None) -> DataFrame:
    """(prefix, url, is_protocol_relative, is_local, is_current) of the cached map ``sites`` (prefix, url, protorel, local); local: only those that are, or aren't.

    A protocol-relative address comes without its protocol; of equal prefixes the least address counts.
    """
    one = sites.groupBy("prefix").agg(F.min(F.struct("url", "protorel", "local")).alias("s")).select("prefix", "s.*")
    rows = one.select(
        "prefix",
        F.when(F.col("protorel"), F.regexp_replace("url", "^https:", "")).otherwise(F.col("url")).alias("url"),
        F.coalesce("protorel", F.lit(False)).alias("is_protocol_relative"),
        F.coalesce("local", F.lit(False)).alias("is_local"),
        F.startswith("url", F.lit(f"https://{host}")).alias("is_current"),
    )
    return rows if local is None else rows.filter(F.col("is_local") == local)
