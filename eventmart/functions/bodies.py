"""Event bodies: one JSON text per event, parsed once, unpacked into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.columns import nulls_for, repair_int, repair_label

# The keys event bodies use, by how their text is read.
TEXT_KEYS = [
    "account_id", "character_id", "zone_id", "sub_zone_id", "name", "faction", "class_id",
    "amulet_item_instance_id", "from_zone_id", "to_zone_id", "to_sub_zone_id", "cause", "transport_id",
    "party_id", "reason", "encounter_id", "encounter_kind", "outcome", "creature_id", "ability_id",
    "attack_type", "target_type", "target_id", "target_creature_id", "target_character_id",
    "source_creature_id", "source_character_id", "killer_type", "killer_id", "item_instance_id",
    "item_template_id", "assigned_character_id", "slot", "merchant_id", "trade_id",
    "counterpart_character_id", "auction_id", "seller_character_id", "buyer_character_id",
]
LONG_KEYS = ["xp_total", "gold_balance_after", "gold_given", "gold_received", "auction_cut"]
INT_KEYS = ["new_level"]
BOOLEAN_KEYS = ["ready", "is_critical", "is_soulbound"]
TIME_KEYS = ["cooldown_until", "expires_at"]
LIST_KEYS = ["opponent_character_ids", "items_given", "items_received"]
JSON_KEYS = ["damage_done", "damage_received"]
# integers the log is known to corrupt: body key -> column
REPAIRED_KEYS = {"xp_amount": "xp_amount", "damage": "damage", "amount": "gold_amount",
                 "price": "price", "buyout_price": "buyout_price"}
PLACEHOLDER_ZONE = "zone_unknown"
ZONE_KEYS = ["zone_id", "from_zone_id", "to_zone_id"]
RENAMED = {"name": "character_name", "ready": "amulet_ready", "cooldown_until": "cooldown_until_raw",
           "expires_at": "expires_at_raw", "damage_done": "summary_damage_done",
           "damage_received": "summary_damage_received"}
SUMMARY_EVENT = "encounter_damage_summary"

_CORRUPT = "_corrupt_record"
# Every field is read as text: a typed field turns a quoted number into NULL, and nested
# values arrive as their JSON text.
BODY_SCHEMA = T.StructType([
    T.StructField(k, T.StringType()) for k in
    [*TEXT_KEYS, *LONG_KEYS, *INT_KEYS, *BOOLEAN_KEYS, *TIME_KEYS, *LIST_KEYS, *JSON_KEYS, *REPAIRED_KEYS, _CORRUPT]])


def parse_body(df: DataFrame, body: str = "body", into: str = "j") -> DataFrame:
    """Add the parsed body (NULL unless it is a well-formed JSON object) and `body_missing`."""
    parsed = df.withColumn("_j", F.from_json(F.col(body), BODY_SCHEMA, {"columnNameOfCorruptRecord": _CORRUPT}))
    is_object = F.coalesce(F.ltrim(F.col(body)).startswith("{") & F.col(f"_j.{_CORRUPT}").isNull(), F.lit(False))
    return (parsed.withColumn("body_missing", ~is_object)
                  .withColumn(into, F.when(~F.col("body_missing"), F.col("_j"))).drop("_j"))


def text_list(value: Column) -> Column:
    """A JSON array of text as ARRAY<STRING>."""
    return F.from_json(value, T.ArrayType(T.StringType()))


def json_list_sum(value: Column, field: str = "total") -> Column:
    """Sum of one number over a JSON list of objects; NULL for an empty list, missing numbers skipped.

    Numbers may be quoted; text that is no whole number counts as missing.
    """
    items = F.from_json(value, T.ArrayType(T.StructType([T.StructField(field, T.StringType())])))
    numbers = F.transform(items, lambda x: x[field].try_cast("bigint"))
    zero = F.lit(0).cast("bigint")
    return F.aggregate(numbers, F.lit(None).cast("bigint"),
                       lambda total, x: F.when(x.isNull(), total).otherwise(F.coalesce(total, zero) + x))


def unpack(df: DataFrame, j: str = "j", event_type: str = "event_type") -> list[Column]:
    """The typed columns of a parsed body, in the cleaned table's names."""

    def field(key: str) -> Column:
        return F.col(j)[key]

    out: dict[str, Column] = {}
    for k in TEXT_KEYS:
        out[RENAMED.get(k, k)] = nulls_for(field(k), PLACEHOLDER_ZONE) if k in ZONE_KEYS else field(k)
    for k in LONG_KEYS:
        out[k] = field(k).try_cast("bigint")
    out["new_level"] = nulls_for(field("new_level").try_cast("int"), 0)
    for k in BOOLEAN_KEYS:
        out[RENAMED.get(k, k)] = field(k).try_cast("boolean")
    for k in TIME_KEYS:
        out[RENAMED.get(k, k)] = field(k).try_cast("timestamp")
    for k in LIST_KEYS:
        out[k] = text_list(field(k))
    for k in JSON_KEYS:
        out[RENAMED[k]] = F.when(F.col(event_type) == SUMMARY_EVENT, field(k))
    raws = []
    for k, name in REPAIRED_KEYS.items():
        raw = field(k).try_cast("bigint")
        raws.append(raw)
        out[name], out[f"{name}_raw"] = repair_int(raw), raw
    out["numeric_repair"] = repair_label(raws)
    return [c.alias(name) for name, c in out.items()]
