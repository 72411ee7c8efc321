"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.columns import bracket_min, text_of


def dim_date(bounds: DataFrame, start: str, end: str, release: Column | None = None) -> DataFrame:
    """One row per day in [start, end), both read from the one-row frame `bounds`."""
    last = F.date_sub(F.col(end).cast("date"), 1)
    days = (bounds.where(F.col(start).cast("date") <= last)
                  .select(F.explode(F.sequence(F.col(start).cast("date"), last)).alias("date_day")))
    weekday = F.weekday("date_day") + 1
    out = {
        "date_key": F.date_format("date_day", "yyyyMMdd").cast("int"),
        "day_name": F.date_format("date_day", "EEEE"),
        "iso_day_of_week": weekday,
        "is_weekend": weekday.isin(6, 7),
        "iso_week": F.weekofyear("date_day"),
        "week_start": F.trunc("date_day", "week"),
    }
    if release is not None:
        out["is_after_release"] = F.col("date_day") >= release.cast("date")
    return days.withColumns(out)


def calendar(spark: SparkSession, start: str, end: str, release: str) -> DataFrame:
    """`dim_date` for a window given as text, end exclusive."""
    bounds = spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))
    return dim_date(bounds, "s", "e", F.lit(release)).withColumnRenamed("is_after_release", "is_patch_2_1")


def dim_character(characters: DataFrame, accounts: DataFrame, classes: DataFrame, offenders: DataFrame) -> DataFrame:
    """Current state of every character, with account, class and the confirmed-offender flag."""
    flag = offenders.select("character_id", "confirmed_cheater")
    return (characters.join(accounts.select("account_id", F.col("created_at").alias("account_created_at")), "account_id")
            .join(classes.select("class_id", F.col("name").alias("class_name"), "armor_type", "crit_chance"), "class_id")
            .join(flag, "character_id", "left")
            .select("character_id", F.col("name").alias("character_name"), "account_id", "account_created_at",
                    "faction", "class_id", "class_name", "armor_type", "crit_chance",
                    F.col("level").alias("current_level"), bracket_min("level").alias("current_bracket_min_level"),
                    F.col("xp").alias("current_xp"), F.col("gold").alias("current_gold"),
                    F.col("zone_id").alias("last_zone_id"), F.col("sub_zone_id").alias("last_sub_zone_id"),
                    "created_at", "last_login_at", "last_logout_at",
                    F.coalesce("confirmed_cheater", F.lit(False)).alias("is_confirmed_cheater")))


def dim_character_level(levels: DataFrame) -> DataFrame:
    label = text_of(F.col("bracket_min_level"), "-", F.col("bracket_max_level"))
    return levels.select("character_id", "level", "valid_from", "valid_to", "bracket_min_level",
                         "bracket_max_level", label.alias("bracket_label"))


def dim_zone(sub_zones: DataFrame, zones: DataFrame) -> DataFrame:
    parent = zones.select("zone_id", F.col("name").alias("zone_name"), "zone_type",
                          F.col("faction").alias("zone_faction"), "min_level", "max_level", "server_id")
    return sub_zones.select("sub_zone_id", F.col("name").alias("sub_zone_name"), "zone_id").join(parent, "zone_id")


def dim_item_template(templates: DataFrame, allowed: DataFrame) -> DataFrame:
    """Templates with the sorted list of classes that may use them (NULL where none is listed)."""
    lists = allowed.groupBy("item_template_id").agg(F.sort_array(F.collect_set("class_id")).alias("allowed_classes"))
    return templates.join(lists, "item_template_id", "left")


def dim_creature(creatures: DataFrame, zones: DataFrame) -> DataFrame:
    return creatures.join(zones.select("zone_id", F.col("name").alias("zone_name")), "zone_id", "left")
