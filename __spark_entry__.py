"""

This file only wires the package to the sample tables: inputs come from `eventmart.sources.
sample_world`, the work is done by the package, and `plain` turns result types into ones two
engines hash alike (lists as text, instants as microseconds, whole numbers as bigint).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from eventmart.functions import columns as fc  # noqa: E402
from eventmart.functions.bodies import json_list_sum, parse_body, text_list  # noqa: E402
from eventmart.operators import history, quality  # noqa: E402
from eventmart.operators.ordered import HotKeys, measure_hot_keys  # noqa: E402
from eventmart.operators.asof import asof_interval_join, asof_join, bracket_join  # noqa: E402
from eventmart.plans import checks, dims, facts, findings, reports, rules  # noqa: E402
from eventmart.plans.staging import stg_events  # noqa: E402
from eventmart.plans.warehouse import Warehouse  # noqa: E402
from eventmart.session import apply_settings, shared_folder  # noqa: E402
from eventmart.sources import landing  # noqa: E402
from eventmart.sources.sample_world import sample_table, view  # noqa: E402
from eventmart.streaming import jobs, key_index  # noqa: E402
from oracle_statements import ORACLES  # noqa: E402

# the operators for training data are an addition that may be absent; where they are there, their errors are not hidden
_present = [find_spec(name) for name in ("eventmart.llm", "corpus_pipeline")]
if all(spec is not None and spec.origin for spec in _present):
    import corpus_pipeline  # noqa: E402
    from eventmart.llm import queries as training  # noqa: E402
else:
    training = None

RELEASE = "2024-01-15 00:00:00"
WINDOW = ("2024-01-01", "2024-01-31", RELEASE)
DAY = 86_400


def plain(df: DataFrame, *names: str) -> DataFrame:
    """The named columns (all by default) in types every engine represents alike."""

    def lowered(f: T.StructField) -> Column:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ", ")
        elif isinstance(t, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(t, (T.DateType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, (T.BooleanType, T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        return c.alias(f.name)

    chosen = df.select(*names) if names else df
    return chosen.select(*[lowered(f) for f in chosen.schema.fields])


FILTERS = ("R02", "R06", "R09")  # rules that only filter a stored model

_hot: dict[tuple[str, str, str], HotKeys] = {}
_stored: dict[tuple[str, str, str], DataFrame] = {}


class World:
    """The sample data as raw tables, cleaned feeds and models, opened on demand.

    Models that others build on are stored as Parquet in the cluster's shared folder, once per
    application and data folder. Queries then start from a table, not from a lineage that every
    reference would repeat and a lost executor would recompute.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = apply_settings(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def stored(self, name: str, build: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _stored:
            _stored[key], _ = landing.materialize(build(), self.scratch(f"model-{name}"), partition_by)
        return _stored[key]

    def unless_stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored model if there is one, else what a reader takes that needs a small part of it."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        return _stored[key] if key in _stored else build()

    # models on top of the raw deliveries and the feeds
    def cleaned(self) -> DataFrame:
        return stg_events(self.raw_events, self.clock_corrections)

    def stg(self) -> DataFrame:
        return self.stored("stg", self.cleaned, "event_type")

    def award_log(self) -> DataFrame:
        """The awards among the cleaned events. Where these are not stored, only awards are unpacked, and stored: a
        condition on a field of a body that is still a plan would parse the body once more for each of them."""
        return self.unless_stored("stg", lambda: self.stored("award_log", lambda: self.cleaned().where("event_type = 'xp_gained'").select(
            "event_id", "server_event_id", "event_type", "event_ts_utc", "character_id", "encounter_id", "creature_id", "xp_amount")))

    def hot(self, feed: str, key: str, only: str = "true") -> HotKeys:
        """The hot keys of a feed (or of its rows of a condition), measured once; they serve every part of these rows."""
        name = (self.spark.sparkContext.applicationId, self.sf_dir, f"{feed} {key} {only}")
        if name not in _hot:
            _hot[name] = measure_hot_keys(getattr(self, feed).where(only), [key], self.scratch(f"hot-{feed}"))
        return _hot[name]

    def hot_actors(self) -> HotKeys:
        """Characters with very many events: all feeds of single events are parts of `ev`."""
        return self.hot("actors", "character_id")

    def timed(self) -> DataFrame:
        return quality.clock_correct(quality.dedup_first(self.raw_events), self.clock_corrections)

    def levels(self) -> DataFrame:
        return self.stored("levels", lambda: history.level_history(
            self.level_ups, self.characters, hot=self.hot_actors()))

    def chain(self, log: DataFrame | None = None) -> DataFrame:
        log, trade = self.moves_log if log is None else log, F.col("event_type") == "trade_completed"
        moves = history.item_moves(log.withColumn("items_given", F.when(trade, F.array("item_instance_id"))))
        return history.custody_chain(moves, hot=self.hot("moves_log", "item_instance_id"))

    def judged_chain(self, log: DataFrame) -> DataFrame:
        """The chain as the rules read it: with what each giver handed over before and the first equip of each item."""
        return rules.with_first_equip(history.with_last_given(self.chain(log), hot=self.hot("moves_log", "item_instance_id")), log)

    def custody(self) -> DataFrame:
        return self.stored("custody", lambda: self.judged_chain(self.moves_log))

    def custody_to_count(self) -> DataFrame:
        """The same for findings that are only counted: without the texts of their evidence."""
        no_text = F.lit(None).cast("string")
        return self.unless_stored("custody", lambda: self.stored(
            "custody_to_count", lambda: self.judged_chain(self.moves_log.withColumn("server_event_id", no_text))))

    def damage(self) -> DataFrame:
        return self.stored("damage", lambda: rules.damage_hits(
            self.hits, self.characters, self.abilities, self.levels(), self.gear_score_caps, hot=self.hot_actors()))

    # rules, with thresholds that suit the pace of the sample data
    def r(self, rule: str, evidence: bool = True) -> DataFrame:
        custody = self.custody if evidence else self.custody_to_count
        return {
            "R01": lambda: rules.burst_damage(self.damage()),
            "R02": lambda: rules.item_duplication(custody(), hot=self.hot("moves_log", "item_instance_id")),
            "R03": lambda: rules.equip_stacking(self.equips, max_seconds=DAY, hot=self.hot_actors()),
            "R04": lambda: rules.speed_hack(self.visits, self.zone_adjacency, hot=self.hot_actors()),
            "R05": lambda: rules.gear_above_level(self.equips, self.item_templates, self.levels(), hot=self.hot_actors()),
            "R06": lambda: rules.hit_above_max(self.damage()),
            "R07": lambda: rules.ability_cooldown(self.uses, self.abilities, global_seconds=3600,
                                                  hot=self.hot_actors()),
            "R08": lambda: rules.reuse_within(self.amulets, seconds=6 * 3600, hot=self.hot_actors()),
            "R09": lambda: rules.bound_item_moved(custody(), self.moves_log),
            "R10": lambda: rules.illegal_trade(self.trades, self.characters),
            "R11": lambda: rules.transport_misuse(self.boardings, self.transports, self.characters, self.game_versions),
            "R12": lambda: rules.combat_in_hub(self.fight_starts, self.zones),
            "R13": lambda: rules.wrong_amount(self.award_log(), self.creatures),
        }[rule]()

    def rule(self, rule: str) -> DataFrame:
        """The findings of one rule, as a table: stored, or a filter of one that is."""
        return self.r(rule) if rule in FILTERS else self.stored(rule, lambda: self.r(rule))

    def found(self, *ids: str) -> DataFrame:
        """Violations of the given rules."""
        return findings.violations([self.rule(i) for i in ids], findings.rule_catalogue(self.spark), self.characters, stored=True)

    def tallied(self) -> DataFrame:
        """All findings counted per rule and actor. Rules whose findings are not stored yet run without their evidence."""
        return findings.tallied([self.unless_stored(i, lambda i=i: self.r(i, evidence=False)) for i in RULE_KEYS], findings.rule_catalogue(self.spark), self.characters)

    def offenders(self) -> DataFrame:
        return self.stored("offenders", lambda: findings.offenders(self.tallied()))

    # marts
    def dates(self) -> DataFrame:
        """The calendar the events span."""
        span = self.ev.agg(F.min("ts").alias("s"), (F.max(fc.day("ts")) + F.expr("INTERVAL 1 DAY")).alias("e"))
        return dims.dim_date(span, "s", "e", F.lit(RELEASE))

    def sessions(self) -> DataFrame:
        return facts.fct_sessions(self.logins, hot=self.hot_actors())

    def people(self) -> DataFrame:
        return self.stored("people", lambda: dims.dim_character(
            self.characters, self.accounts, self.classes, self.offenders()))

    def participation(self, columns: list[str] | None = None, only: Column | None = None) -> DataFrame:
        log = self.fight_log.withColumn("opponent_character_ids", F.lit(None).cast("array<string>"))
        hot = self.hot("fight_log", "character_id", "event_type = 'encounter_started'")  # a fight has a start or more
        return facts.encounter_participation(log, self.creatures, self.levels(), hot=hot, columns=columns, only=only)

    def fights(self) -> DataFrame:
        return self.stored("fights", self.participation)

    def won_fights(self) -> DataFrame:
        """What the report on won fights reads of them, several times."""
        return self.unless_stored("fights", lambda: self.stored(
            "won_fights", lambda: self.participation(reports.WON_COLUMNS, reports.won_fight())))

    def kills(self) -> DataFrame:
        return self.stored("kills", lambda: facts.fct_creature_kills(self.fights()))

    def ledger(self) -> DataFrame:
        return facts.fct_gold_ledger(self.economy, self.item_templates)

    def transactions(self) -> DataFrame:
        return facts.fct_transactions(self.economy)

    def zone_dim(self) -> DataFrame:
        return dims.dim_zone(self.sub_zones, self.zones)

    def activity(self) -> DataFrame:
        return facts.fct_subzone_activity(self.presence, self.zone_dim())

    def gear(self) -> DataFrame:
        return self.stored("gear", lambda: facts.fct_character_gear(
            self.people(), self.item_instances, self.item_templates, self.gear_score_caps))

    def awards(self) -> DataFrame:
        xp = self.ev.where("kind = 'click'").select(
            "event_id", F.lit("xp_gained").alias("event_type"), F.col("ts").alias("event_ts_utc"),
            fc.text_of("chr_", F.col("user_id")).alias("character_id"), F.lit(None).cast("string").alias("encounter_id"),
            F.lit(None).cast("string").alias("creature_id"), F.lit(None).cast("string").alias("zone_id"),
            F.col("k").alias("xp_amount"), F.col("cents").alias("xp_total"))
        return facts.fct_xp(xp)

    def raw_tables(self) -> dict[str, DataFrame]:
        names = ["accounts", "characters", "item_instances", "abilities", "classes", "creatures", "game_versions",
                 "gear_score_caps", "item_template_classes", "item_templates", "sub_zones", "transports",
                 "zone_adjacency", "zones", "clock_corrections"]
        return {"events": self.raw_events, **{n: getattr(self, n) for n in names}}

    def scratch(self, name: str) -> str:
        """A fresh folder for one run's output, in the folder the cluster shares."""
        import uuid

        return f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"


REGISTRY: dict[str, Callable[[World], DataFrame]] = {}


def query(fn: Callable[[World], DataFrame]) -> Callable[[World], DataFrame]:
    REGISTRY[fn.__name__.removesuffix("_query")] = fn
    return fn


# ---- sources and sinks ----------------------------------------------------------------------------


@query
def land_events(w: World) -> DataFrame:
    """Deliveries landed by receive date and read back: rows per date."""
    path = w.scratch("land")
    types = {"event_id": "bigint", "schema_version": "integer", "event_ts": "timestamp with time zone",
             "received_at": "timestamp with time zone", "shard_seq": "bigint", "body": "jsonb"}
    late = F.when(F.col("event_id") % 500 != 0, F.col("received_at"))  # some rows lack the receive time
    landing.land_table(landing.typed_as_source(w.raw_events.withColumn("received_at", late), types), path, "received_at")
    stored = landing.read_landed(w.spark, path, keep_date=True)
    return plain(stored.groupBy(F.col("received_date").cast("string").alias("received_date")).agg(
        F.count("*").alias("rows"), F.count("body").alias("bodies"), F.max("event_id").alias("last_event_id")))


@query
def reconcile_landing(w: World) -> DataFrame:
    tables = {"events": w.raw_events, "characters": w.characters, "item_templates": w.item_templates,
              "item_instances": w.item_instances, "no_rows": w.zones.where("1 = 0")}
    manifest = landing.land_all(tables, w.scratch("reconcile"), {"events": "received_at"})
    landing.require_reconciled(manifest)
    return plain(manifest)


@query
def discovered_tables(w: World) -> DataFrame:
    """Every table found in the folder, with its columns counted from the footers and its rows through a SQL view."""
    landing.register_views(w.spark, w.sf_dir, "found_")
    columns = landing.discovered_columns(w.spark, w.sf_dir).groupBy("table_name").agg(F.count("*").alias("n_columns"))
    counts = [w.spark.sql(f"SELECT '{name}' AS table_name, count(*) AS rows FROM found_{name}")
              for name in landing.discover(w.spark, w.sf_dir)]
    return plain(columns.join(reduce(DataFrame.unionByName, counts), "table_name"))


@query
def layer_build_counts(w: World) -> DataFrame:
    """Two layers built and stored; row count per model."""
    house = Warehouse(w.spark, w.raw_tables(), w.scratch("house"), WINDOW)
    return plain(house.build(layers=["staging", "dq", "intermediate"]))


@query
def report_files(w: World) -> DataFrame:
    """Reports saved as CSV with a header and read back."""
    path = w.scratch("csv")
    landing.write_csv(reports.population(w.people()), path)
    back = w.spark.read.option("header", True).csv(path)
    return plain(back.select("faction", "class_name", F.col("bracket_min_level").cast("bigint").alias("bracket_min_level"),
                             "level_bracket", F.col("characters").cast("bigint").alias("characters")))


@query
def export_lowered(w: World) -> DataFrame:
    """Templates with list, decimal and time columns, in the types a desktop BI tool loads."""
    full = dims.dim_item_template(w.item_templates, w.item_template_classes).withColumn(
        "seen_at", F.lit(RELEASE).cast("timestamp"))
    low = landing.lower_types(full)
    return plain(low.select("item_template_id", "allowed_classes", "list_price", "seen_at", "item_level"))


# ---- data quality -----------------------------------------------------------------------------------


@query
def dedup_first(w: World) -> DataFrame:
    return plain(quality.dedup_first(w.raw_events), "event_id", "server_event_id", "server_id", "shard_seq",
                 "received_at", "delivery_count")


@query
def clock_correct(w: World) -> DataFrame:
    return plain(w.timed(), "event_id", "event_ts", "event_ts_utc", "ts_corrected")


@query
def body_missing(w: World) -> DataFrame:
    parsed = parse_body(w.raw_events)
    return plain(parsed.select("event_id", "event_type", "body_missing", F.col("j.character_id").alias("character_id")))


@query
def placeholder_null(w: World) -> DataFrame:
    feed = w.arrived.select("event_id", F.when(F.col("event_id") % 53 == 0, "zone_unknown").otherwise("zone_1").alias("zone_id"),
                            F.when(F.col("event_id") % 61 == 0, 0).otherwise(F.col("k")).alias("new_level"))
    return plain(quality.placeholders_to_null(feed, {"zone_id": "zone_unknown", "new_level": 0}))


@query
def repair_int(w: World) -> DataFrame:
    feed = w.arrived.select("event_id", F.col("amount").alias("price"), (F.col("k") - 3).alias("damage"))
    return plain(quality.repair_columns(feed, ["price", "damage"]))


@query
def recover_attribute(w: World) -> DataFrame:
    log = w.loot_log
    looted = log.where("event_type = 'item_looted'").select("event_id", "item_instance_id", "item_template_id")
    return plain(quality.recover_attribute(looted, log.where("event_type = 'item_dropped'"), "item_instance_id",
                                           "item_template_id"))


@query
def seq_gaps(w: World) -> DataFrame:
    return plain(quality.seq_gaps(w.stg()))


@query
def orphan_refs(w: World) -> DataFrame:
    lost = quality.orphans(w.stg(), "character_id", w.characters, "character_id")
    return plain(lost, "event_id", "event_type", "character_id")


@query
def dq_summary(w: World) -> DataFrame:
    return plain(quality.dq_summary(w.raw_events, w.stg(), w.characters))


@query
def shard_quality(w: World) -> DataFrame:
    q = quality.shard_quality(w.raw_events, w.stg())
    return plain(q.withColumn("mean_delay_ms", F.round("mean_delay_ms", 3)), "server_id", "rows", "unique_events",
                 "extra_rows", "gaps", "lost_events", "largest_gap", "longest_delay_ms", "mean_delay_ms", "typical_delay_ms")


@query
def repair_proof(w: World) -> DataFrame:
    xp = w.stg().where("event_type = 'xp_gained'")
    return plain(quality.repair_proof(xp, w.creatures, "creature_id", "xp_amount", "xp_reward"))


@query
def skew_monitor(w: World) -> DataFrame:
    hourly = quality.skew_by_hour(quality.dedup_first(w.raw_events))
    return plain(hourly.withColumn("min_lag_s", F.round("min_lag_s", 3)))


@query
def gap_monitor(w: World) -> DataFrame:
    return plain(quality.loss_by_hour(quality.dedup_first(w.raw_events)))


@query
def overlapping_corrections(w: World) -> DataFrame:
    """Corrections of one shard that overlap: here the ranges each receive day saw, made to touch."""
    daily = quality.dedup_first(w.raw_events).groupBy("server_id", F.day("received_at").alias("d")).agg(
        F.min("shard_seq").alias("from_shard_seq"), (F.max("shard_seq") + F.day(F.max("received_at")) % 3).alias("to_shard_seq"))
    return plain(quality.overlapping_corrections(daily), "server_id", "from_shard_seq", "to_shard_seq")


# ---- cleaned events and history ---------------------------------------------------------------------


STG_COLUMNS = [
    "event_id", "server_event_id", "server_id", "shard_seq", "source_batch_id", "source_file", "delivery_count",
    "event_type", "schema_version", "game_version", "event_ts_utc", "event_ts_raw", "ts_corrected", "received_at",
    "body_missing", "character_id", "zone_id", "sub_zone_id", "new_level", "xp_amount", "xp_amount_raw", "xp_total",
    "encounter_id", "creature_id", "gold_amount", "gold_amount_raw", "gold_balance_after", "merchant_id",
    "item_instance_id", "item_template_id", "price", "price_raw", "assigned_character_id", "items_given",
    "account_id", "slot", "is_soulbound", "expires_at_raw", "numeric_repair", "body_raw"]


def _stg_table(w: World) -> DataFrame:
    return plain(w.stg(), *STG_COLUMNS)


REGISTRY["stg_events"] = _stg_table


@query
def level_history(w: World) -> DataFrame:
    return plain(dims.dim_character_level(w.levels()))


@query
def level_history_from_log(w: World) -> DataFrame:
    """The same history from the raw log: cleaning, unpacking and intervals in one plan."""
    return plain(history.level_history(w.stg(), w.characters))


@query
def asof_inner(w: World) -> DataFrame:
    bought = w.ev.where("kind = 'purchase'").select("event_id", fc.text_of("chr_", F.col("user_id")).alias("character_id"), "ts")
    return plain(asof_join(bought, w.levels(), ["character_id"], "ts", "valid_from", ["level", "bracket_min_level"], tie="level",
                           hot=w.hot_actors()))


@query
def asof_left(w: World) -> DataFrame:
    """Deaths with the user's latest level-up before, or NULL."""
    ups = w.level_ups.where("new_level IS NOT NULL")
    return plain(asof_join(w.deaths_log.select("event_id", "character_id", "event_ts_utc"),
                           ups.select("character_id", F.col("event_ts_utc").alias("up_at"), "new_level", "xp_total"),
                           ["character_id"], "event_ts_utc", "up_at", ["new_level", "xp_total"], how="left",
                           hot=w.hot_actors()))


@query
def asof_interval(w: World) -> DataFrame:
    bought = w.ev.where("kind = 'purchase'").select("event_id", fc.text_of("chr_", F.col("user_id")).alias("character_id"), "ts")
    return plain(asof_interval_join(bought, w.levels(), ["character_id"], "ts", ["level", "bracket_min_level"]))


@query
def custody_chain(w: World) -> DataFrame:
    return plain(w.chain(), "item_instance_id", "event_id", "server_event_id", "event_type", "holder_after", "giver",
                 "holder_before", "custody_step", "event_ts_utc")


@query
def legal_max(w: World) -> DataFrame:
    hits = w.damage().withColumn("max_possible_hit", F.round("max_possible_hit", 3))
    return plain(hits, "event_id", "character_id", "class_id", "level", "ability_id", "damage",
                 "ability_base_at_level", "gear_score_cap", "max_possible_hit")


@query
def unjudged_hits(w: World) -> DataFrame:
    lost = w.hits.withColumns({
        "character_id": F.when(F.col("event_id") % 7 > 0, F.col("character_id")).otherwise("chr_gone"),
        "ability_id": F.when(F.col("event_id") % 11 > 0, F.col("ability_id"))})
    return plain(rules.unjudged_hits(lost, w.characters, w.abilities))


@query
def repair_int_sql(w: World) -> DataFrame:
    """The repair as a SQL function."""
    fc.register_sql_functions(w.spark)
    return plain(w.arrived.select("event_id", F.expr("repair_int(amount)").alias("amount")))


@query
def landed_since(w: World) -> DataFrame:
    """An incremental read: only the landed partitions from one day on."""
    path = w.scratch("since")
    landing.land_table(w.raw_events, path, "received_at")
    return plain(landing.read_landed(w.spark, path, since="2024-01-20"), "event_id", "server_event_id", "received_at")


@query
def bracket_cap_join(w: World) -> DataFrame:
    joined = bracket_join(w.characters.select("character_id", "level"), w.gear_score_caps, "level",
                          "bracket_min_level", "bracket_max_level")
    return plain(joined)


# ---- rules ------------------------------------------------------------------------------------------

RULE_KEYS = {
    "R01": "r01_burst", "R02": "r02_dup_transfer", "R03": "r03_stacking", "R04": "r04_speed", "R05": "r05_above_level",
    "R06": "r06_above_max", "R07": "r07_cooldown", "R08": "r08_reuse", "R09": "r09_bound_moved",
    "R10": "r10_illegal_pair", "R11": "r11_misuse", "R12": "r12_forbidden_zone", "R13": "r13_wrong_amount"}
for _rule, _key in RULE_KEYS.items():
    REGISTRY[_key] = lambda w, rule=_rule: plain(w.rule(rule))


@query
def wrong_price(w: World) -> DataFrame:
    """The fixed-amount rule on merchant prices."""
    return plain(rules.wrong_amount(w.stg(), w.item_templates, "item_sold", "price", "item_template_id", "sell_price",
                                    "gold", "D05"))


@query
def violations(w: World) -> DataFrame:
    return plain(w.found(*RULE_KEYS))


@query
def all_rules_violations(w: World) -> DataFrame:
    """All thirteen rules together."""
    return plain(w.found(*RULE_KEYS).drop("violation_key"), "violation_id", "rule_id", "severity", "character_id",
                 "occurred_at", "evidence_event_ids", "character_known")


@query
def offenders(w: World) -> DataFrame:
    return plain(w.offenders())


@query
def rule_results(w: World) -> DataFrame:
    return plain(findings.rule_results(findings.rule_catalogue(w.spark), w.tallied()))


@query
def violation_lineage(w: World) -> DataFrame:
    return plain(findings.violation_lineage(w.found("R13"), w.raw_events))


# ---- marts ------------------------------------------------------------------------------------------


@query
def dim_date(w: World) -> DataFrame:
    return plain(w.dates())


@query
def dim_character(w: World) -> DataFrame:
    return plain(w.people().drop("last_login_at", "last_logout_at"))


@query
def dim_zone(w: World) -> DataFrame:
    return plain(w.zone_dim())


@query
def dim_item(w: World) -> DataFrame:
    return plain(dims.dim_item_template(w.item_templates, w.item_template_classes))


@query
def dim_creature(w: World) -> DataFrame:
    return plain(dims.dim_creature(w.creatures, w.zones))


@query
def sessions(w: World) -> DataFrame:
    return plain(w.sessions())


@query
def sessions_open(w: World) -> DataFrame:
    """The option that keeps sessions whose logout is missing."""
    return plain(facts.fct_sessions(w.logins, keep_open=True, hot=w.hot_actors()))


@query
def encounter_participation(w: World) -> DataFrame:
    return plain(w.fights().drop("opponent_character_ids"))


@query
def json_list_sum_query(w: World) -> DataFrame:
    rows = w.fight_log.where("event_type = 'encounter_damage_summary'")
    return plain(rows.select("event_id", "encounter_id", json_list_sum(F.col("summary_damage_done")).alias("total")))


@query
def death_category(w: World) -> DataFrame:
    return plain(facts.fct_deaths(w.deaths_log, w.creatures))


@query
def creature_kills(w: World) -> DataFrame:
    return plain(w.kills())


@query
def loot(w: World) -> DataFrame:
    return plain(facts.fct_loot(w.loot_log, w.item_templates))


@query
def flow_ledger(w: World) -> DataFrame:
    return plain(w.ledger())


@query
def transactions(w: World) -> DataFrame:
    return plain(w.transactions())


@query
def xp_awards(w: World) -> DataFrame:
    return plain(facts.fct_xp(w.stg()))


@query
def hourly_activity(w: World) -> DataFrame:
    return plain(w.activity())


@query
def capped_score(w: World) -> DataFrame:
    return plain(w.gear())


# ---- reports ----------------------------------------------------------------------------------------


@query
def daily_active(w: World) -> DataFrame:
    return plain(reports.daily_active(w.dates(), w.sessions()))


@query
def weekly_pattern(w: World) -> DataFrame:
    return plain(reports.weekly_pattern(w.dates(), w.sessions(), F.lit("2024-01-30").cast("date")))


@query
def population(w: World) -> DataFrame:
    return plain(reports.population(w.people()))


@query
def kills_by_day(w: World) -> DataFrame:
    return plain(reports.kills_by_day(w.kills()))


@query
def deaths_by_day(w: World) -> DataFrame:
    return plain(reports.deaths_by_day(facts.fct_deaths(w.deaths_log, w.creatures)))


@query
def pivot_by_category(w: World) -> DataFrame:
    return plain(reports.looted_by_rarity(facts.fct_loot(w.loot_log, w.item_templates)))


@query
def heatmap(w: World) -> DataFrame:
    return plain(reports.heatmap(w.activity(), w.zone_dim()))


@query
def category_share(w: World) -> DataFrame:
    return plain(reports.deaths_by_killer(facts.fct_deaths(w.deaths_log, w.creatures)))


@query
def peer_percentile(w: World) -> DataFrame:
    return plain(reports.player_360(w.gear(), w.people(), w.sessions(), w.awards()))


@query
def rate_percentile(w: World) -> DataFrame:
    return plain(reports.dps_percentile(w.won_fights(), w.people(), min_fights=5))


@query
def transactions_in_window(w: World) -> DataFrame:
    return plain(reports.transactions_in_window(w.transactions(), F.lit("2024-01-10 12:00:00").cast("timestamp"),
                                                F.lit("2024-01-25 00:00:00").cast("timestamp")))


@query
def sold_by_category(w: World) -> DataFrame:
    return plain(reports.sold_by_rarity(w.transactions(), w.item_templates))


@query
def flow_statement(w: World) -> DataFrame:
    return plain(reports.gold_flow(w.ledger()))


@query
def offender_report(w: World) -> DataFrame:
    return plain(reports.offender_report(w.offenders(), w.people()))


# ---- scalar functions -------------------------------------------------------------------------------


@query
def scalar_json(w: World) -> DataFrame:
    j = parse_body(w.raw_events).select("event_id", "j")
    return plain(j.select("event_id", F.col("j.character_id").alias("text_value"),
                          F.col("j.xp_amount").try_cast("bigint").alias("number_value"),
                          F.size(text_list(F.col("j.items_given"))).alias("list_size"),
                          F.element_at(text_list(F.col("j.items_given")), 1).alias("first_item"),
                          F.col("j.item_template_id").isNull().alias("no_template")))


@query
def scalar_number(w: World) -> DataFrame:
    e = w.arrived
    c, k = F.col("cents"), F.col("k")
    return plain(e.select(
        "event_id", fc.repair_int("amount").alias("repaired"), fc.bracket_min("k").alias("bracket"),
        F.nullif(k % 5, F.lit(0)).alias("nullif_value"), F.coalesce(F.nullif(k % 5, F.lit(0)), F.lit(-1)).alias("filled"),
        F.least(k, c, F.nullif(k % 7, F.lit(0))).alias("least_value"), F.greatest(k, c).alias("greatest_value"),
        F.round(c / F.lit(3.0), 2).alias("rounded"), F.round(c / F.lit(100.0)).alias("whole"),
        fc.ratio(c, k).alias("quotient"), ((F.lit(100) + 12 * k + 0.5 * c) * 1.1 * 2 > 900).alias("above")))


@query
def scalar_text(w: World) -> DataFrame:
    e = w.ev
    return plain(e.select(
        "event_id", fc.text_of("Hit for ", F.col("cents"), ", of ", F.round(F.col("cents") / 7, 2), " s").alias("detail"),
        fc.text_of("Better than ", F.round(F.col("k") * 1.5).cast("int"), "% of others").alias("message"),
        F.array_join(F.array(F.col("kind"), F.lit("x"), F.col("k").cast("string")), ", ").alias("joined"),
        fc.stamp("ts").alias("stamp"), F.col("kind").like("%i%").alias("has_i"), F.col("kind").startswith("s").alias("starts_s")))


@query
def scalar_time(w: World) -> DataFrame:
    t = F.col("ts")
    return plain(w.ev.select(
        "event_id", fc.seconds_between("ts", F.lit("2024-01-01").cast("timestamp")).alias("seconds"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("date_key"), F.date_format("ts", "EEEE").alias("day_name"),
        (F.weekday("ts") + 1).alias("iso_day"), F.weekofyear("ts").alias("iso_week"), F.hour("ts").alias("hour"),
        F.date_trunc("week", t).cast("date").alias("week_start"), F.date_trunc("hour", t).alias("hour_start"),
        t.cast("date").alias("day"), (t + F.expr("INTERVAL 5 HOURS")).alias("plus_5h"),
        ((t >= F.lit(RELEASE).cast("timestamp")) & (t < F.lit("2024-01-20").cast("timestamp"))).alias("in_window")))


@query
def scalar_array(w: World) -> DataFrame:
    items = F.when(F.col("k") % 3 > 0, F.filter(F.array(F.col("k"), F.col("k") * 2), lambda x: x % 4 != 0))
    return plain(w.ev.select("event_id", F.explode(items).alias("item")).groupBy("event_id").agg(
        F.count("*").alias("items"), F.sum("item").alias("total")))


# ---- further checks ---------------------------------------------------------------------------------


def _chain(w: World, hot: HotKeys | int) -> DataFrame:
    log = w.ev.where("kind IN ('click', 'view', 'error')").select(
        "event_id", F.concat(F.lit("sev_"), "event_id").alias("server_event_id"), F.col("kind").alias("event_type"),
        F.col("ts").alias("event_ts_utc"), fc.text_of("chr_", F.col("user_id")).alias("character_id"),
        fc.text_of("shard-0", F.col("event_id") % 3 + 1).alias("server_id"))
    gaps = quality.gap_edges(w.stg())
    return plain(checks.chain_completeness(log, ["click", "view", "error"], gaps, max_seconds=2 * DAY, hot=hot),
                 "event_id", "character_id", "complete", "excused", "seconds")


@query
def chain_complete(w: World) -> DataFrame:
    return _chain(w, w.hot_actors())


@query
def hot_chain_complete(w: World) -> DataFrame:
    """The same with nearly every character cut into slices, as a character with very many events is."""
    return _chain(w, 5)


@query
def threshold_match(w: World) -> DataFrame:
    return plain(checks.threshold_mismatch(w.level_ups, w.xp_levels), "event_id", "character_id", "new_level", "xp_total",
                 "xp_from", "xp_below")


@query
def rate_vs_expected(w: World) -> DataFrame:
    hits = w.hits.withColumn("class_id", fc.text_of("cls_", F.substring("ability_id", 5, 3)))
    out = checks.rate_vs_expected(hits, ["class_id"], F.col("is_critical"), w.classes, "crit_chance")
    return plain(out.withColumns({c: F.round(c, 6) for c in ("observed", "deviation")}))


@query
def drop_rates(w: World) -> DataFrame:
    log = w.kill_log
    out = checks.drop_rates(log, log.where("kind = 'purchase'"), w.loot_entries, w.game_versions)
    return plain(out.withColumn("observed", F.round("observed", 6)), "loot_entry_id", "creature_id", "kills", "drops",
                 "observed", "expected")


@query
def allowed_pairs(w: World) -> DataFrame:
    used = w.uses.join(w.characters.select("character_id", "class_id"), "character_id")
    return plain(checks.not_allowed(used, w.abilities, ["class_id", "ability_id"]), "event_id", "character_id",
                 "class_id", "ability_id")


@query
def balance_continuity(w: World) -> DataFrame:
    return plain(checks.balance_breaks(w.balances, "character_id", "event_ts_utc", "event_id", "movement", "balance_after",
                                       hot=w.hot_actors()))


@query
def assigned_only(w: World) -> DataFrame:
    log = w.loot_log
    loots = log.where("event_type = 'item_looted'").select("event_id", "character_id", "item_instance_id")
    return plain(checks.looted_by_other(loots, log.where("event_type = 'item_dropped'")))


@query
def reward_after_exit(w: World) -> DataFrame:
    log = w.ev.select("event_id", "kind", fc.text_of("chr_", F.col("user_id")).alias("character_id"),
                      F.day("ts").alias("encounter_id"), F.col("ts").alias("event_ts_utc"))
    out = checks.reward_after_exit(log.where("kind = 'purchase'"), log.where("kind = 'error'"), ["character_id", "encounter_id"])
    return plain(out, "event_id", "character_id", "encounter_id", "event_ts_utc", "exited_at")


@query
def login_place(w: World) -> DataFrame:
    return plain(checks.moved_while_away(w.logins, hot=w.hot_actors()))


@query
def concurrent_members(w: World) -> DataFrame:
    return plain(checks.concurrent_members(w.party_members, "party_id", "character_id", "joined_at", "left_at",
                                           hot=w.hot("party_members", "party_id")))


@query
def mixed_parties(w: World) -> DataFrame:
    members = w.party_members.join(w.characters.select("character_id", "faction"), "character_id")
    return plain(checks.mixed_groups(members, "party_id", "faction"))


@query
def no_origin(w: World) -> DataFrame:
    return plain(checks.no_origin(w.loot_log, "item_instance_id", F.col("event_type") == "item_dropped"))


@query
def state_vs_events(w: World) -> DataFrame:
    return plain(checks.state_vs_events(w.characters, w.balances, "character_id", "gold", "balance_after"))


@query
def ratio_to_bound(w: World) -> DataFrame:
    lost = w.damage().join(w.fight_starts.groupBy("character_id").agg(F.max("encounter_kind").alias("kind")), "character_id")
    out = checks.ratio_to_bound(lost, ["kind"], F.col("damage"), F.col("max_possible_hit"))
    return plain(out.select("kind", "rows", F.round("mean_ratio", 6).alias("mean_ratio"),
                            F.round("max_ratio", 6).alias("max_ratio"), F.round("median_ratio", 6).alias("median_ratio"), "above_bound"))


@query
def longest_session(w: World) -> DataFrame:
    out = checks.longest_session(w.sessions(), max_hours=10.0)
    return plain(out)


@query
def pair_net_flow(w: World) -> DataFrame:
    given = w.trades.where("gold_given > 0")
    return plain(checks.pair_net_flow(given, "character_id", "counterpart_character_id", F.col("gold_given")))


@query
def creation_cluster(w: World) -> DataFrame:
    accounts = w.accounts.join(w.characters.select("account_id", "faction"), "account_id")
    clusters = checks.creation_clusters(accounts, ["faction"], "created_at", 6 * 3600, "account_id")
    return plain(checks.cluster_sizes(clusters, ["faction"], "created_at", 3))


@query
def always_together(w: World) -> DataFrame:
    accounts = w.accounts.join(w.characters.select("account_id", "character_id", "faction"), "account_id")
    clusters = checks.creation_clusters(accounts, ["faction"], "created_at", 6 * 3600, "account_id")
    return plain(checks.always_together(clusters, w.party_members, ["faction", "cluster"], "character_id", "party_id"))


@query
def offender_timeline(w: World) -> DataFrame:
    confirmed = w.offenders().where("confirmed_cheater")
    return plain(checks.offender_timeline(w.visits, w.found(*RULE_KEYS), confirmed))


@query
def before_after(w: World) -> DataFrame:
    return plain(checks.before_after(w.ev, ["kind"], "ts", F.lit(RELEASE).cast("timestamp")))


@query
def fight_speed(w: World) -> DataFrame:
    out = checks.fight_speed(w.kills(), "creature_id", "fight_duration_s")
    return plain(out.withColumn("mean_s", F.round("mean_s", 6)), "creature_id", "fights", "fastest_s", "mean_s", "typical_s", "outlier")


# ---- streams ----------------------------------------------------------------------------------------


def _stream(w: World, name: str) -> DataFrame:
    """A view over the events file read as a stream."""
    schema = sample_table(w.spark, w.sf_dir, "events").schema
    source = w.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(w.sf_dir)
    return view(w.spark, w.sf_dir, name, source)


@query
def stream_dedup(w: World) -> DataFrame:
    once = jobs.dedup_stream(_stream(w, "raw_events"))
    out = jobs.run_to_table(once.select("server_event_id", "server_id", "shard_seq", "received_at"), w.scratch("dedup"))
    return plain(out, "server_event_id", "server_id", "shard_seq")


@query
def stream_late_copies(w: World) -> DataFrame:
    """Loads of whole receive days; every 50th event comes once more three days later, beyond any watermark."""
    raw = w.raw_events
    late = raw.where(F.col("event_id") % 100 == 0).withColumns(
        {"received_at": F.col("received_at") + F.expr("INTERVAL 3 DAYS"), "event_id": F.col("event_id") + F.lit(1 << 40)})
    landed, folder = w.scratch("late-landed"), w.scratch("late-loaded")
    # a file for each receive day, as the landing writes them
    day = F.to_date("received_at")
    raw.unionByName(late).withColumn("received_date", day).repartition("received_date").write.partitionBy("received_date").parquet(landed)
    arriving = w.spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 8).parquet(landed)
    loaded = key_index.load_stream(arriving, folder)
    return plain(loaded.groupBy("server_event_id").agg(F.count("*").alias("kept"), F.min("server_id").alias("server_id"), F.min("shard_seq").alias("shard_seq")))


@query
def stream_skew(w: World) -> DataFrame:
    out = jobs.run_to_table(jobs.skew_stream(_stream(w, "raw_events")), w.scratch("skew"))
    return plain(out.withColumn("min_lag_s", F.round("min_lag_s", 3)))


@query
def stream_gaps(w: World) -> DataFrame:
    return plain(quality.lost_events(jobs.run_to_table(jobs.loss_stream(_stream(w, "raw_events")), w.scratch("gaps"))))


@query
def stream_burst(w: World) -> DataFrame:
    return plain(jobs.run_to_table(jobs.burst_stream(_stream(w, "hits")), w.scratch("burst")))


@query
def stream_dup_transfer(w: World) -> DataFrame:
    log = _stream(w, "ev").select(
        fc.text_of("itm_", F.col("k")).alias("item_instance_id"), "event_id", F.col("ts").alias("event_ts_utc"),
        F.concat(F.lit("chr_"), (F.col("user_id") % 7)).alias("giver"),
        F.concat(F.lit("chr_"), (F.col("event_id") % 7)).alias("holder_after"))
    return plain(jobs.run_to_table(jobs.duplicate_transfer_stream(log, remember_days=7), w.scratch("dup")))


@query
def stream_alerts(w: World) -> DataFrame:
    raw = _stream(w, "fight_starts")
    path = w.scratch("alerts")
    found = rules.combat_in_hub(raw, w.zones)
    return plain(jobs.run_alerts(found, path), "rule_id", "character_id", "occurred_at", "encounter_id", "violation_key")


# ---- contract ---------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: raw deliveries -> cleaned events -> wrong awards and duplicate transfers -> evidence."""
    w = World(spark, "/root/testdata/sf0.001")
    return plain(findings.violation_lineage(w.found("R02", "R13"), w.raw_events))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: (lambda spark, sf_dir, fn=fn: fn(World(spark, sf_dir))) for name, fn in REGISTRY.items()}
    return own | (training.QUERIES | {"pipeline": corpus_pipeline.run} if training else {})


def oracle_sql() -> dict[str, str]:
    own = {name: sql for name, sql in ORACLES.items() if name in REGISTRY}
    return own | (training.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}) if training else {})
