"""The catalogue of rules and the tables built from all findings together."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.functions.columns import time_slice
from eventmart.operators.ordered import fine_groups, number_globally
from eventmart.session import shared_folder, shuffles_dropped

# Rule id, name, category, severity, rulebook section, description.
RULE_CATALOGUE = [
    ("R01", "Burst damage", "combat", "high", "5.1",
     "A character landed several hits at the same instant. Every hit comes from one ability, and only one ability can be used every 1.5 seconds."),
    ("R02", "Item duplication", "items", "high", "4.4",
     "A character traded away an item it had already given to someone else. An item belongs to one character at a time."),
    ("R03", "Equip stacking", "items", "medium", "4.1",
     "A character equipped an item into a slot that was already filled, less than a second after the previous equip, without the item being taken off first."),
    ("R04", "Speed hack", "movement", "medium", "3.1",
     "A character walked between two zones faster than the fixed walking speed of 7 m/s allows."),
    ("R05", "Gear above level", "items", "low", "4.1",
     "A character equipped an item whose level requirement is at least 2 levels above its own level."),
    ("R06", "Hit above maximum damage", "combat", "high", "5.2",
     "A single hit did more damage than the damage formula allows for the attacker's level, even with a critical hit."),
    ("R07", "Ability reused during cooldown", "combat", "high", "5.1",
     "An ability was used again before its own cooldown or the 1.5 s global cooldown had ended."),
    ("R08", "Amulet reused during cooldown", "movement", "high", "3.2",
     "The Amulet of the Planes was used again within its 60 minute cooldown."),
    ("R09", "Soulbound item moved", "items", "high", "4.3",
     "An item that had already been equipped (soulbound) was traded or put up for auction."),
    ("R10", "Illegal trade", "economy", "high", "7.2",
     "A trade between characters of different factions or in different zones."),
    ("R11", "Transport misuse", "movement", "medium", "3.3",
     "A transport was used by the wrong faction or before it was released."),
    ("R12", "Combat in a capital hub", "combat", "high", "1.1",
     "A fight started in a capital hub, where no combat of any kind is allowed."),
    ("R13", "Wrong XP award", "progression", "high", "2.2",
     "A character received a different amount of XP than the creature grants."),
]
CATALOGUE_SCHEMA = ("rule_id string, rule_name string, category string, severity string, "
                    "rulebook_section string, plain_english string")


def rule_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULE_CATALOGUE, CATALOGUE_SCHEMA)


def rules_of(severity: str) -> list[str]:
    """The ids of the catalogue's rules of one severity."""
    return [rule[0] for rule in RULE_CATALOGUE if rule[3] == severity]


def violation_key(columns: Sequence[str] = ()) -> Column:
    """A key that stays the same however often a violation is found: of its rule, evidence and wording.

    `columns` are those of the findings. A burst, whose evidence may be stored in pieces, goes by its first event.
    """
    ids = F.concat_ws(",", F.col("evidence_event_ids").cast("array<string>"))
    if "evidence_first" in columns:
        ids = F.when(F.col("rule_id") == "R01", F.col("evidence_first").cast("string")).otherwise(ids)
    return F.sha2(F.concat_ws("|", "rule_id", ids, "detail"), 256)


def described(findings: Iterable[DataFrame], catalogue: DataFrame, characters: DataFrame) -> DataFrame:
    """All findings in one table with the rule's description, the actor's attributes and a key."""
    found = reduce(DataFrame.unionByName, findings)
    return _described(found, catalogue, characters).withColumn("violation_key", violation_key(found.columns))


def _described(found: DataFrame, catalogue: DataFrame, characters: DataFrame) -> DataFrame:
    rules = catalogue.select("rule_id", "rule_name", "category", "severity", "rulebook_section")
    found = found.join(F.broadcast(rules), "rule_id")  # as many rows as there are rules
    return _with_actor(found, characters)


def _with_actor(found: DataFrame, characters: DataFrame) -> DataFrame:
    actors = characters.select(F.col("character_id").alias("_actor"), "account_id", "faction", "class_id")
    return (found.join(actors, F.col("character_id") == F.col("_actor"), "left")
                 .withColumn("character_known", F.col("_actor").isNotNull()).drop("_actor"))


def violations(findings: Iterable[DataFrame], catalogue: DataFrame, characters: DataFrame,
               slice_seconds: Sequence[int] = (1, 3600, 30 * 86_400), stored: bool = False) -> DataFrame:
    """All findings with an id, a key, the rule's description and the actor's attributes.

    They are stored in the shared folder first, so that the rules run once; `stored` says that they are read from tables already.
    `violation_id` is the position in time order and changes when rules change;
    `violation_key` is a hash of what was found and does not. Both are those of the whole finding, in how many pieces its
    evidence may be stored (`evidence_part`). `slice_seconds` are the widths of the
    time slices by which rows are numbered, each a multiple of the one before.

    Findings are moved once, with what their rule gave. Actors are looked up for groups of findings (one instant, rule and
    actor), which are counted for the numbering anyhow and stored, as they are read for totals and for offsets.
    """
    spark = catalogue.sparkSession
    every = reduce(DataFrame.unionByName, findings)
    if not stored:
        every = _kept(every, "findings")
    order = ["occurred_at", "rule_id", "character_id", "evidence_first", "evidence_part", "evidence_event_ids", "detail"]
    slices, fine = [time_slice("occurred_at", s) for s in slice_seconds], order[:3]
    whole = F.when(F.col("evidence_part") == 0, 1).otherwise(0)
    about = ["rule_name", "category", "severity", "rulebook_section"]
    entry = F.row_number().over(W.partitionBy("rule_id").orderBy(*about))
    rules = F.broadcast(catalogue.select("rule_id", *about, entry.alias("_entry")))  # as many rows as there are rules
    groups = fine_groups(every, fine, whole).join(rules.select("rule_id", "_entry"), "rule_id")
    groups = _kept(_with_actor(groups, characters), "groups")
    numbered = number_globally(every, order, slices, fine, "violation_id", whole, groups)
    described = numbered.join(rules, ["rule_id", "_entry"]).withColumn("violation_key", violation_key(numbered.columns))
    return described.select(
        "violation_id", "violation_key", "rule_id", "rule_name", "category", "severity", "rulebook_section",
        "character_id", "account_id", "faction", "class_id", "occurred_at", "encounter_id", "detail",
        "evidence_event_ids", "evidence_server_event_ids", "evidence_part", "character_known")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Stored in the shared folder and read back."""
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def evidence(found: DataFrame) -> DataFrame:
    """A row per piece of evidence: whose violation, at which place in its stored list, which event."""
    pieces = F.posexplode(F.arrays_zip("evidence_event_ids", "evidence_server_event_ids")).alias("place", "_e")
    return found.select("violation_id", "violation_key", "evidence_part", pieces).select(
        "violation_id", "violation_key", "evidence_part", "place", F.col("_e.evidence_event_ids").alias("event_id"),
        F.col("_e.evidence_server_event_ids").alias("server_event_id"))


def tallied(findings: Iterable[DataFrame], catalogue: DataFrame, characters: DataFrame) -> DataFrame:
    """All findings counted per rule and actor, with what `described` adds to each of them.

    For `offenders` and `rule_results`, which need no evidence: findings are added up where they lie (numbers only), and
    an actor with very many of them is one row a rule in the lookup of actors.
    """
    return _described(_tally(reduce(DataFrame.unionByName, findings)), catalogue, characters)


def _tally(found: DataFrame) -> DataFrame:
    """Findings per rule and actor; further evidence rows of one burst count once. A tally stays as it is."""
    if "findings" in found.columns:
        return found
    given = {"rule_id", "rule_name", "severity", "character_id", "account_id", "faction", "class_id", "character_known"}
    return (found.where(F.col("evidence_part") == 0).groupBy(*[c for c in found.columns if c in given])
                 .agg(F.count("*").alias("findings"), F.min("occurred_at").alias("first_at"), F.max("occurred_at").alias("last_at")))


def offenders(found: DataFrame, min_rules: int = 3, decisive: str = "high") -> DataFrame:
    """One row per known character: how many violations, of which rules, when; of `tallied` or `described` findings or of `violations`.

    Confirmed means a rule of the decisive severity or at least `min_rules` different rules.
    The set of rules is bounded by the catalogue; further evidence rows of one burst count once.
    """
    grave = F.col("severity") == decisive
    summed = (_tally(found).where(F.col("character_known"))
                   .groupBy("character_id", "account_id", "faction", "class_id")
                   .agg(F.sum("findings").alias("violations"), F.size(F.collect_set("rule_id")).alias("distinct_rules"),
                        F.sort_array(F.collect_set("rule_name")).alias("rules_broken"),
                        F.sum(F.when(grave, F.col("findings")).otherwise(0)).alias("high_severity"),
                        F.min("first_at").alias("first_violation_at"),
                        F.max("last_at").alias("last_violation_at")))
    return summed.withColumn("confirmed_cheater",
                             (F.col("high_severity") > 0) | (F.col("distinct_rules") >= min_rules))


def rule_results(catalogue: DataFrame, found: DataFrame) -> DataFrame:
    """How often each rule fired and for how many characters, including rules that never fired."""
    per_actor = _tally(found).groupBy("rule_id", "character_id").agg(F.sum("findings").alias("n"))
    fires = per_actor.groupBy("rule_id").agg(F.sum("n").alias("violations"),
                                             F.count("character_id").alias("characters"))
    return (catalogue.join(fires, "rule_id", "left").fillna(0, ["violations", "characters"])
                     .select("rule_id", "rule_name", "category", "severity", "rulebook_section", "violations",
                             "characters", "plain_english"))


def violation_lineage(found: DataFrame, deliveries: DataFrame, violation_id: int | None = None) -> DataFrame:
    """Every piece of evidence traced back to the row as it was delivered."""
    chosen = found if violation_id is None else found.where(F.col("violation_id") == violation_id)
    pieces = chosen.select("violation_id", "rule_name", "character_id", "detail",
                           F.explode("evidence_event_ids").alias("event_id"))
    raw = deliveries.select("event_id", "server_event_id", "server_id", "shard_seq", "source_batch_id",
                            "source_file", "event_type", F.col("event_ts").alias("event_ts_as_delivered"), "body")
    return pieces.join(raw, "event_id")
