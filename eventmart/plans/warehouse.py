"""All models wired together: raw tables in, warehouse tables out.

    w = Warehouse(spark, raw, folder)   # raw: {"events": ..., "characters": ..., ...}
    w.build()                           # or w.build(layers=["staging"])
    w["fct_sessions"]                   # the stored table, or the plan if it is not built yet

Every model is a function of the warehouse. A built model is read back from Parquet, so a lost
executor never recomputes a long lineage; `stg_events` is stored by event type, which most
models filter on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators import history, quality
from eventmart.operators.ordered import HotKeys, measure_hot_keys
from eventmart.plans import dims, facts, findings, reports, rules
from eventmart.plans.staging import stg_events
from eventmart.sources.landing import lower_types, materialize, write_csv

RAW_TABLES = [
    "events", "accounts", "characters", "item_instances", "abilities", "classes", "creatures", "game_versions",
    "gear_score_caps", "item_template_classes", "item_templates", "sub_zones", "transports", "zone_adjacency",
    "zones", "clock_corrections",
]
RULES: dict[str, Callable[["Warehouse"], DataFrame]] = {
    "R01": lambda w: rules.burst_damage(w["int_damage_hits"]),
    "R02": lambda w: rules.item_duplication(w["int_item_custody"], hot=w.hot("item_instance_id")),
    "R03": lambda w: rules.equip_stacking(w["stg_events"], hot=w.hot("character_id")),
    "R04": lambda w: rules.speed_hack(w["stg_events"], w.raw["zone_adjacency"], hot=w.hot("character_id")),
    "R05": lambda w: rules.gear_above_level(w["stg_events"], w.raw["item_templates"], w["int_level_history"],
                                           hot=w.hot("character_id")),
    "R06": lambda w: rules.hit_above_max(w["int_damage_hits"]),
    "R07": lambda w: rules.ability_cooldown(w["stg_events"], w.raw["abilities"], hot=w.hot("character_id")),
    "R08": lambda w: rules.reuse_within(w["stg_events"], hot=w.hot("character_id")),
    "R09": lambda w: rules.bound_item_moved(w["int_item_custody"], w["stg_events"]),
    "R10": lambda w: rules.illegal_trade(w["stg_events"], w.raw["characters"]),
    "R11": lambda w: rules.transport_misuse(w["stg_events"], w.raw["transports"], w.raw["characters"],
                                            w.raw["game_versions"]),
    "R12": lambda w: rules.combat_in_hub(w["stg_events"], w.raw["zones"]),
    "R13": lambda w: rules.wrong_amount(w["stg_events"], w.raw["creatures"]),
}

Model = Callable[["Warehouse"], DataFrame]
MODELS: dict[str, dict[str, Model]] = {
    "staging": {
        "stg_events": lambda w: stg_events(w.raw["events"], w.raw["clock_corrections"]),
    },
    "dq": {
        "dq_shard_seq_gaps": lambda w: quality.seq_gaps(w["stg_events"]),
        "dq_summary": lambda w: quality.dq_summary(w.raw["events"], w["stg_events"], w.raw["characters"]),
        "dq_shard_quality": lambda w: quality.shard_quality(w.raw["events"], w["stg_events"]),
    },
    "intermediate": {
        "int_level_history": lambda w: history.level_history(w["stg_events"], w.raw["characters"],
                                                             hot=w.hot("character_id")),
        "int_item_custody": lambda w: history.custody_chain(history.item_moves(w["stg_events"]),
                                                            hot=w.hot("item_instance_id")),
        "int_damage_hits": lambda w: rules.damage_hits(w["stg_events"], w.raw["characters"], w.raw["abilities"],
                                                       w["int_level_history"], w.raw["gear_score_caps"],
                                                       hot=w.hot("character_id")),
    },
    "cheats": {
        "cheat_rule_catalogue": lambda w: findings.rule_catalogue(w.spark),
        **{f"rule_{rid.lower()}": fn for rid, fn in RULES.items()},
        "cheat_violations": lambda w: findings.violations(
            [w[f"rule_{rid.lower()}"] for rid in RULES], w["cheat_rule_catalogue"], w.raw["characters"]),
        "cheat_offenders": lambda w: findings.offenders(w["cheat_violations"]),
        "cheat_rule_results": lambda w: findings.rule_results(w["cheat_rule_catalogue"], w["cheat_violations"]),
    },
    "marts": {
        "dim_date": lambda w: dims.calendar(w.spark, *w.window),
        "dim_character": lambda w: dims.dim_character(w.raw["characters"], w.raw["accounts"], w.raw["classes"],
                                                      w["cheat_offenders"]),
        "dim_character_level": lambda w: dims.dim_character_level(w["int_level_history"]),
        "dim_zone": lambda w: dims.dim_zone(w.raw["sub_zones"], w.raw["zones"]),
        "dim_item_template": lambda w: dims.dim_item_template(w.raw["item_templates"], w.raw["item_template_classes"]),
        "dim_creature": lambda w: dims.dim_creature(w.raw["creatures"], w.raw["zones"]),
        "fct_sessions": lambda w: facts.fct_sessions(w["stg_events"], hot=w.hot("character_id")),
        "fct_encounter_participation": lambda w: facts.encounter_participation(
            w["stg_events"], w.raw["creatures"], w["int_level_history"], hot=w.hot("character_id")),
        "fct_deaths": lambda w: facts.fct_deaths(w["stg_events"], w.raw["creatures"]),
        "fct_creature_kills": lambda w: facts.fct_creature_kills(w["fct_encounter_participation"]),
        "fct_loot": lambda w: facts.fct_loot(w["stg_events"], w.raw["item_templates"]),
        "fct_gold_ledger": lambda w: facts.fct_gold_ledger(w["stg_events"], w.raw["item_templates"]),
        "fct_economy_transactions": lambda w: facts.fct_transactions(w["stg_events"]),
        "fct_xp": lambda w: facts.fct_xp(w["stg_events"]),
        "fct_subzone_activity": lambda w: facts.fct_subzone_activity(w["stg_events"], w["dim_zone"]),
        "fct_character_gear": lambda w: facts.fct_character_gear(
            w["dim_character"], w.raw["item_instances"], w.raw["item_templates"], w.raw["gear_score_caps"]),
    },
}
REPORTS: dict[str, Model] = {
    "daily_active_players": lambda w: reports.daily_active(w["dim_date"], w["fct_sessions"]),
    "weekly_pattern": lambda w: reports.weekly_pattern(
        w["dim_date"], w["fct_sessions"], F.date_sub(F.lit(w.window[1]).cast("date"), 1)),
    "population": lambda w: reports.population(w["dim_character"]),
    "creatures_killed_by_day": lambda w: reports.kills_by_day(w["fct_creature_kills"]),
    "players_killed_by_day": lambda w: reports.deaths_by_day(w["fct_deaths"]),
    "items_looted_by_rarity": lambda w: reports.looted_by_rarity(w["fct_loot"]),
    "subzone_heatmap": lambda w: reports.heatmap(w["fct_subzone_activity"], w["dim_zone"]),
    "deaths_boss_vs_player": lambda w: reports.deaths_by_killer(w["fct_deaths"]),
    "player_360": lambda w: reports.player_360(w["fct_character_gear"], w["dim_character"], w["fct_sessions"], w["fct_xp"]),
    "dps_percentile": lambda w: reports.dps_percentile(w["fct_encounter_participation"], w["dim_character"]),
    "transactions_in_window": lambda w: reports.transactions_in_window(
        w["fct_economy_transactions"], F.lit(w.window[2]).cast("timestamp"), F.lit(w.window[1]).cast("timestamp")),
    "items_sold_by_rarity": lambda w: reports.sold_by_rarity(w["fct_economy_transactions"], w["dim_item_template"]),
    "gold_flow": lambda w: reports.gold_flow(w["fct_gold_ledger"]),
    "cheat_report": lambda w: reports.offender_report(w["cheat_offenders"], w["dim_character"]),
    "violation_lineage": lambda w: findings.violation_lineage(w["cheat_violations"], w.raw["events"]),
}
EXPORTED = [*[m for m in MODELS["marts"]], "cheat_violations", "cheat_offenders", "cheat_rule_results"]
COUNTS = "layer string, model string, row_count bigint"


class Warehouse:
    """Named models over raw tables; `window` is (first day, end exclusive, release time).

    Without a window it is taken from the data: the days the deliveries span, and the last release of a
    game version before their end.
    """

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], folder: str,
                 window: tuple[str, str, str] | None = None) -> None:
        self.spark, self.raw, self.folder, self._window = spark, raw, folder.rstrip("/"), window
        self._tables: dict[str, DataFrame] = {}
        self._hot: dict[str, HotKeys] = {}
        self._layer_of = {m: layer for layer, models in MODELS.items() for m in models}

    @property
    def window(self) -> tuple[str, str, str]:
        if self._window is None:
            day = F.date_format(F.min("received_at"), "yyyy-MM-dd"), F.date_format(F.date_add(F.max("received_at"), 1), "yyyy-MM-dd")
            first, end = self.raw["events"].agg(*day).first()
            releases = self.raw["game_versions"].where(F.col("released_at") < F.lit(end).cast("timestamp"))
            last = releases.agg(F.date_format(F.max("released_at"), "yyyy-MM-dd HH:mm:ss")).first()[0]
            self._window = (first, end, last or f"{first} 00:00:00")
        return self._window

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = MODELS[self._layer_of[name]][name](self)
        return self._tables[name]

    def hot(self, key: str) -> HotKeys:
        """The hot values of a key among all cleaned events, measured once.

        Items count by all the events that name them, also as part of a traded list.
        """
        if key not in self._hot:
            items = F.concat(F.array(key), F.coalesce("items_given", F.array())) if key == "item_instance_id" else F.array(key)
            named = self["stg_events"].select(F.explode(items).alias(key))
            self._hot[key] = measure_hot_keys(named, [key], f"{self.folder}/hot/{key}")
        return self._hot[key]

    def path(self, name: str) -> str:
        return f"{self.folder}/{self._layer_of[name]}/{name}"

    def open(self, *names: str) -> "Warehouse":
        """Use tables an earlier run has stored."""
        for name in names:
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self

    def build(self, layers: Sequence[str] | None = None, models: Sequence[str] | None = None) -> DataFrame:
        """Store the models of the given layers (all by default) and return their row counts."""
        counts = []
        for layer, named in MODELS.items():
            if layers is not None and not any(part in layer for part in layers):
                continue
            for name, model in named.items():
                if models is not None and name not in models:
                    continue
                by_type = "event_type" if name == "stg_events" else None
                self._tables[name], rows = materialize(model(self), self.path(name), by_type)
                counts.append((layer, name, rows))
        return self.spark.createDataFrame(counts, COUNTS)

    def report(self, name: str) -> DataFrame:
        return REPORTS[name](self)

    def write_reports(self, folder: str, names: Sequence[str] | None = None) -> DataFrame:
        """Save reports as CSV files and return their row counts."""
        rows = [("reports", n, write_csv(self.report(n), f"{folder}/{n}")) for n in (names or REPORTS)]
        return self.spark.createDataFrame(rows, COUNTS)

    def export(self, folder: str, names: Sequence[str] | None = None) -> DataFrame:
        """Save tables with BI-friendly types and return their row counts."""
        rows = []
        for n in names or EXPORTED:
            _, count = materialize(lower_types(self[n]), f"{folder}/{n}")
            rows.append(("export", n, count))
        return self.spark.createDataFrame(rows, COUNTS)
