"""The event log and reference tables of the package's schema, derived from the sample tables.

Each view is one SQL statement over the sample tables (`events`, `lineitem`, `orders`, `customer`,
`part`, `supplier`, `nation`, `region`) or earlier views. Only SQL that Spark and an ANSI engine
read alike is used, so a check can state its expectation on the very same input. No view needs a
window or a join of large tables: every derived value is a formula of its row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# the large tables, by a key that spreads their rows evenly; used where a file has fewer splits than
# the cluster has cores, so that one core does not derive everything
ROW_KEYS = {"events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey"}
SAMPLE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

VIEWS: dict[str, str] = {}

# --- the stream of events, with a clean time, whole cents and the number hidden in props -------
VIEWS["ev"] = """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type AS kind,
       CAST(round(value * 100) AS BIGINT) AS cents,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
FROM events"""

VIEWS["actors"] = """
SELECT 'chr_' || user_id AS character_id FROM events"""

# --- raw deliveries: 3 shards (the third holds 3/4 of all rows), each numbered 1, 2, 3, ... -----
VIEWS["sent"] = """
SELECT event_id, ts, user_id, k, cents,
       CASE kind WHEN 'signup' THEN 'level_up' WHEN 'click' THEN 'xp_gained' WHEN 'purchase' THEN 'gold_credited'
                 WHEN 'view' THEN 'item_sold' ELSE 'item_dropped' END AS event_type,
       CASE event_id % 8 WHEN 0 THEN 'shard-01' WHEN 1 THEN 'shard-02' ELSE 'shard-03' END AS server_id,
       CASE WHEN event_id % 8 < 2 THEN CAST(floor(event_id / 8) AS BIGINT) + 1
            ELSE CAST(floor(event_id / 8) AS BIGINT) * 6 + event_id % 8 - 1 END AS shard_seq
FROM ev"""
# lost: every 97th number of a shard, and pairs; the third shard's clock is 5 h late from the 28th on
VIEWS["arrived"] = """
SELECT event_id, event_type, server_id, shard_seq, k, cents, user_id, ts,
       (server_id = 'shard-03' AND ts >= TIMESTAMP '2024-01-28 00:00:00') AS late_clock,
       CASE WHEN event_id % 199 = 0 THEN user_id + 10000000 ELSE user_id END AS actor,
       CASE WHEN event_id % 41 = 0 THEN -(k * 10 + 7) - 1
            WHEN event_id % 43 = 0 THEN 2147483648 + k * 10 + 7
            WHEN event_id % 67 = 0 THEN k * 10 + 8
            ELSE k * 10 + 7 END AS amount
FROM sent
WHERE shard_seq % 97 <> 0 AND shard_seq % 1009 > 1"""
VIEWS["with_body"] = """
SELECT event_id, event_type, server_id, shard_seq, ts, late_clock,
       CASE WHEN event_id % 211 = 0 THEN NULL
            WHEN event_id % 223 = 0 THEN '[]'
            WHEN event_id % 227 = 0 THEN '{"character_id": "chr_'
            WHEN event_id % 229 = 0 THEN 'null'
            ELSE '{' || CASE WHEN event_id % 101 = 0 THEN '' ELSE '"character_id": "chr_' || actor || '", ' END
              || '"zone_id": "' || CASE WHEN event_id % 53 = 0 THEN 'zone_unknown' ELSE 'zone_' || k % 25 END
              || '", "sub_zone_id": "sub_' || k || '"'
              || CASE event_type
                   WHEN 'level_up' THEN ', "new_level": '
                        || CASE WHEN event_id % 61 = 0 THEN 0 ELSE user_id % 30 + day(ts) END
                        || ', "xp_total": ' || ((user_id % 30 + day(ts)) * 100 + k)
                   WHEN 'xp_gained' THEN ', "encounter_id": "enc_' || event_id || '", "creature_id": "crt_' || k
                        || '", "xp_amount": ' || amount || ', "xp_total": "' || k * 1000 || '"'
                   WHEN 'gold_credited' THEN ', "encounter_id": "enc_' || event_id || '", "creature_id": "crt_' || k
                        || '", "amount": ' || amount || ', "gold_balance_after": ' || k * 100
                   WHEN 'item_sold' THEN ', "merchant_id": "mer_' || k % 7 || '", "item_instance_id": "itm_' || event_id
                        || '", "item_template_id": "tpl_' || k || '", "price": ' || amount
                   ELSE ', "item_instance_id": "itm_' || event_id || '", "item_template_id": '
                        || CASE WHEN event_id % 31 = 0 THEN 'null' ELSE '"tpl_' || k || '"' END
                        || ', "assigned_character_id": "chr_' || user_id || '", "items_given": ["itm_'
                        || k || '", "itm_' || (k + 1) || '"]'
                 END || '}' END AS body
FROM arrived"""
VIEWS["raw_events"] = """
SELECT event_id * 2 AS event_id, 'sev_' || event_id AS server_event_id, event_type, 1 AS schema_version,
       CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN '2.0' ELSE '2.1' END AS game_version,
       CASE WHEN late_clock THEN ts - INTERVAL '5' HOUR ELSE ts END AS event_ts,
       ts + (700 + event_id % 400) * INTERVAL '0.001' SECOND AS received_at,
       server_id, shard_seq, 'batch_' || day(ts) AS source_batch_id,
       server_id || '/' || day(ts) || '.jsonl' AS source_file, body
FROM with_body
UNION ALL
SELECT event_id * 2 + 1, 'sev_' || event_id, event_type, 1,
       CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN '2.0' ELSE '2.1' END,
       CASE WHEN late_clock THEN ts - INTERVAL '5' HOUR ELSE ts END,
       ts + INTERVAL '60' SECOND, server_id, shard_seq, 'batch_' || day(ts) || 'b',
       server_id || '/' || day(ts) || 'b.jsonl', body
FROM with_body WHERE event_id % 20 = 0"""
VIEWS["clock_corrections"] = """
SELECT 'shard-03' AS server_id, min(shard_seq) AS from_shard_seq, CAST(NULL AS BIGINT) AS to_shard_seq,
       INTERVAL '5' HOUR AS add_to_event_ts
FROM arrived WHERE late_clock"""

# --- reference and state tables ------------------------------------------------------------------
VIEWS["zones"] = """
SELECT 'zone_' || n_nationkey AS zone_id, n_name AS name,
       CASE WHEN n_nationkey % 5 = 0 THEN 'hub' ELSE 'wild' END AS zone_type,
       CASE n_regionkey WHEN 0 THEN 'Sunward' WHEN 1 THEN 'Wildbound' END AS faction,
       n_nationkey * 2 + 1 AS min_level, n_nationkey * 2 + 10 AS max_level,
       'shard-0' || (n_nationkey % 3 + 1) AS server_id
FROM nation"""
VIEWS["zone_adjacency"] = """
SELECT 'zone_' || n_nationkey AS zone_a_id, 'zone_' || (n_nationkey + 1) % 25 AS zone_b_id, 151200 AS min_distance_m
FROM nation
UNION ALL
SELECT 'zone_' || n_nationkey, 'zone_' || (n_nationkey + 7) % 25, 252007 FROM nation"""
VIEWS["sub_zones"] = """
SELECT 'sub_' || s_suppkey AS sub_zone_id, s_name AS name, 'zone_' || s_nationkey AS zone_id FROM supplier"""
VIEWS["creatures"] = """
SELECT 'crt_' || s_suppkey AS creature_id, s_name AS name, s_suppkey % 70 + 1 AS level,
       CASE s_suppkey % 7 WHEN 0 THEN 'boss' WHEN 1 THEN 'elite' WHEN 2 THEN 'elite' ELSE 'normal' END AS rank,
       s_suppkey * 10 + 7 AS xp_reward, 100 + s_suppkey % 50 AS base_damage,
       CASE WHEN s_suppkey % 11 = 3 THEN 'zone_gone' ELSE 'zone_' || s_nationkey END AS zone_id
FROM supplier"""
VIEWS["item_templates"] = """
SELECT 'tpl_' || p_partkey AS item_template_id, p_name AS name,
       CASE WHEN p_partkey % 9 = 0 THEN 'material' ELSE 'gear' END AS item_kind, 'slot_' || p_partkey % 4 AS slot,
       CASE CAST(floor((p_size - 1) / 10) AS INT) WHEN 0 THEN 'common' WHEN 1 THEN 'uncommon' WHEN 2 THEN 'rare'
            WHEN 3 THEN 'epic' ELSE 'legendary' END AS rarity,
       p_size AS item_level, p_size AS level_requirement, p_partkey * 10 + 7 AS sell_price,
       CAST(p_retailprice AS DECIMAL(38,10)) AS list_price
FROM part"""
VIEWS["item_template_classes"] = """
SELECT 'tpl_' || p_partkey AS item_template_id, 'cls_' || p_partkey % 5 AS class_id FROM part WHERE p_size > 3
UNION ALL
SELECT 'tpl_' || p_partkey, 'cls_' || (p_partkey * 3 + 1) % 5 FROM part
WHERE p_size > 3 AND (p_partkey * 3 + 1) % 5 <> p_partkey % 5"""
VIEWS["classes"] = """
SELECT 'cls_' || r_regionkey AS class_id, r_name AS name, 'armor_' || r_regionkey % 2 AS armor_type,
       CAST(0.05 * (r_regionkey + 1) AS DECIMAL(38,10)) AS crit_chance
FROM region"""
VIEWS["abilities"] = """
SELECT 'abl_' || r_regionkey AS ability_id, 'cls_' || r_regionkey AS class_id, 100 + 20 * r_regionkey AS base_damage,
       10 + r_regionkey AS damage_per_level,
       CASE WHEN r_regionkey > 0 THEN r_regionkey * 14400 END AS cooldown_s
FROM region"""
VIEWS["gear_score_caps"] = """
SELECT n_nationkey * 10 + 1 AS bracket_min_level, n_nationkey * 10 + 10 AS bracket_max_level,
       60 + 40 * n_nationkey AS max_gear_score
FROM nation"""
VIEWS["game_versions"] = """
SELECT DISTINCT CASE WHEN r_regionkey < 3 THEN '2.0' ELSE '2.1' END AS version,
       CASE WHEN r_regionkey < 3 THEN TIMESTAMP '2023-06-01 00:00:00' ELSE TIMESTAMP '2024-01-15 00:00:00' END AS released_at
FROM region"""
VIEWS["transports"] = """
SELECT 'trn_' || n_nationkey AS transport_id, 'Line ' || n_name AS name, 'zone_' || n_nationkey AS from_zone_id,
       CASE n_nationkey % 3 WHEN 0 THEN 'Sunward' WHEN 1 THEN 'Wildbound' END AS faction,
       CASE WHEN n_nationkey % 4 = 0 THEN '2.1' ELSE '2.0' END AS available_from_version
FROM nation"""
VIEWS["xp_levels"] = """
SELECT DISTINCT p_size AS level, CAST(p_size * 100 + p_size % 3 AS BIGINT) AS xp_required FROM part"""
VIEWS["accounts"] = """
SELECT 'acc_' || c_custkey AS account_id,
       TIMESTAMP '2023-11-01 00:00:00' + ((c_custkey * 7919) % 86400) * INTERVAL '1' MINUTE AS created_at
FROM customer"""
VIEWS["characters"] = """
SELECT 'chr_' || c_custkey AS character_id, 'acc_' || c_custkey AS account_id, c_name AS name,
       CASE c_nationkey % 2 WHEN 0 THEN 'Sunward' ELSE 'Wildbound' END AS faction, 'cls_' || c_custkey % 5 AS class_id,
       CAST(c_custkey % 70 + 1 AS INT) AS level, c_custkey * 100 AS xp, CAST(round(c_acctbal) AS BIGINT) AS gold,
       'zone_' || c_nationkey AS zone_id, 'sub_' || c_nationkey AS sub_zone_id,
       TIMESTAMP '2023-11-01 00:00:00' + ((c_custkey * 7919) % 86400) * INTERVAL '1' MINUTE AS created_at,
       CAST(NULL AS TIMESTAMP) AS last_login_at, CAST(NULL AS TIMESTAMP) AS last_logout_at
FROM customer"""
VIEWS["item_instances"] = """
SELECT 'itm_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS item_instance_id,
       'tpl_' || l_partkey AS item_template_id,
       CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE 'chr_' || l_orderkey END AS character_id,
       l_returnflag = 'R' AS is_equipped
FROM lineitem"""

# --- cleaned event feeds, in the columns of the cleaned event table -------------------------------
VIEWS["level_ups"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id, 'level_up' AS event_type, ts AS event_ts_utc,
       'chr_' || user_id AS character_id,
       CASE WHEN event_id % 61 = 0 THEN CAST(NULL AS INT) ELSE CAST(user_id % 30 + day(ts) AS INT) END AS new_level,
       (user_id % 30 + day(ts)) * 100 + k AS xp_total
FROM ev WHERE kind = 'signup'"""
VIEWS["hits"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id,
       CASE WHEN user_id % 2 = 0 THEN 'pve_damage_dealt' ELSE 'pvp_damage_dealt' END AS event_type,
       date_trunc('hour', ts) AS event_ts_utc, 'enc_' || user_id AS encounter_id, 'chr_' || user_id AS character_id,
       'abl_' || k % 5 AS ability_id, CASE WHEN k % 2 = 0 THEN 'melee' ELSE 'spell' END AS attack_type,
       CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(floor(cents / 10) AS BIGINT) END AS damage,
       k % 3 = 0 AS is_critical,
       CASE WHEN user_id % 2 = 0 THEN 'crt_' || user_id % 10 END AS target_creature_id,
       CASE WHEN user_id % 2 = 1 THEN 'chr_' || (user_id + 1) END AS target_character_id
FROM ev"""
VIEWS["uses"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id, 'ability_used' AS event_type, ts AS event_ts_utc,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE 'chr_' || user_id END AS character_id,
       CASE WHEN event_id % 89 = 0 THEN NULL ELSE 'abl_' || k % 5 END AS ability_id, 'enc_' || event_id AS encounter_id
FROM ev"""
VIEWS["equips"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id,
       CASE kind WHEN 'view' THEN 'item_unequipped' ELSE 'item_equipped' END AS event_type, ts AS event_ts_utc,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE 'chr_' || user_id END AS character_id,
       CASE WHEN event_id % 37 = 0 THEN NULL ELSE 'slot_' || event_id % 4 END AS slot,
       'itm_' || k AS item_instance_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'tpl_' || k END AS item_template_id
FROM ev WHERE kind IN ('click', 'view')"""
VIEWS["visits"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id,
       CASE WHEN kind = 'view' AND k < 20 THEN 'session_login' WHEN kind = 'view' THEN 'location_changed'
            ELSE 'zone_entered' END AS event_type,
       ts AS event_ts_utc, 'chr_' || user_id AS character_id,
       CASE WHEN event_id % 71 = 0 THEN NULL ELSE 'zone_' || (event_id * 7) % 25 END AS zone_id,
       'shard-0' || (event_id % 3 + 1) AS server_id, event_id AS shard_seq
FROM ev WHERE kind IN ('signup', 'error', 'purchase', 'view')"""
VIEWS["amulets"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id, 'amulet_used' AS event_type, ts AS event_ts_utc,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE 'chr_' || user_id END AS character_id
FROM ev WHERE kind = 'click'"""
VIEWS["moves_log"] = """
SELECT (l_orderkey * 8 + l_linenumber) * 100000 + l_suppkey AS event_id,
       'mov_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS server_event_id,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'item_equipped'
            WHEN l_quantity < 4 THEN 'item_looted' WHEN l_quantity > 46 THEN 'item_sold'
            WHEN l_quantity > 42 THEN 'auction_created' WHEN l_quantity > 38 THEN 'auction_purchased'
            ELSE 'trade_completed' END AS event_type,
       CAST(l_shipdate AS TIMESTAMP) AS event_ts_utc, 'chr_' || l_suppkey % 20 AS character_id,
       'chr_' || (l_orderkey * 3 + l_linenumber) % 20 AS counterpart_character_id,
       'itm_' || l_partkey AS item_instance_id
FROM lineitem"""
VIEWS["boardings"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id, 'transport_boarded' AS event_type, ts AS event_ts_utc,
       'chr_' || user_id AS character_id, 'trn_' || k % 25 AS transport_id,
       CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'zone_' || (k + 1) % 25
            ELSE 'zone_' || k % 25 END AS zone_id
FROM ev WHERE kind = 'error'"""
VIEWS["fight_starts"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id, 'encounter_started' AS event_type, ts AS event_ts_utc,
       'chr_' || user_id AS character_id, 'enc_' || event_id AS encounter_id,
       CASE WHEN k % 2 = 0 THEN 'pve' ELSE 'pvp' END AS encounter_kind,
       CASE WHEN event_id % 59 = 0 THEN NULL ELSE 'zone_' || k % 25 END AS zone_id
FROM ev WHERE kind = 'signup'"""
VIEWS["trades"] = """
SELECT o_orderkey * 2 AS event_id, 'trd_' || o_orderkey || '_a' AS server_event_id, 'trade_completed' AS event_type,
       CAST(o_orderdate AS TIMESTAMP) AS event_ts_utc, 'trd_' || o_orderkey AS trade_id,
       'chr_' || o_custkey AS character_id, 'chr_' || (o_custkey * 7 + o_orderkey) % 1500 AS counterpart_character_id,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'zone_' || o_custkey % 25 END AS zone_id,
       CAST(floor(o_totalprice) AS BIGINT) AS gold_given, CAST(0 AS BIGINT) AS gold_received
FROM orders WHERE o_orderkey % 23 <> 0
UNION ALL
SELECT o_orderkey * 2 + 1, 'trd_' || o_orderkey || '_b', 'trade_completed',
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' SECOND, 'trd_' || o_orderkey,
       'chr_' || (o_custkey * 7 + o_orderkey) % 1500, 'chr_' || o_custkey,
       CASE WHEN o_orderkey % 4 = 0 THEN 'zone_' || (o_custkey + 1) % 25 ELSE 'zone_' || o_custkey % 25 END,
       CAST(0 AS BIGINT), CAST(floor(o_totalprice) AS BIGINT)
FROM orders WHERE o_orderkey % 29 <> 0"""
VIEWS["logins"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id,
       CASE kind WHEN 'view' THEN 'session_login' ELSE 'session_logout' END AS event_type, ts AS event_ts_utc,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE 'chr_' || user_id END AS character_id,
       'zone_' || (event_id * 7) % 25 AS zone_id
FROM ev WHERE kind IN ('view', 'click')"""
# fights: one line item is one participant's start, end and damage; (fight, participant) may repeat
VIEWS["fight_log"] = """
SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS event_id, 'encounter_started' AS event_type,
       CAST(l_shipdate AS TIMESTAMP) AS event_ts_utc, 'enc_' || l_orderkey AS encounter_id,
       'chr_' || l_suppkey % 40 AS character_id, CASE WHEN l_orderkey % 5 = 0 THEN 'pvp' ELSE 'pve' END AS encounter_kind,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE 'crt_' || l_orderkey % 100 END AS creature_id,
       CASE WHEN l_linenumber > 2 THEN 'pty_' || l_orderkey END AS party_id,
       'zone_' || l_orderkey % 25 AS zone_id, 'sub_' || l_orderkey % 100 AS sub_zone_id, CAST(NULL AS VARCHAR(9)) AS outcome,
       CAST(NULL AS BIGINT) AS damage, CAST(NULL AS VARCHAR(9)) AS summary_damage_done,
       CAST(NULL AS VARCHAR(9)) AS summary_damage_received
FROM lineitem
UNION ALL
SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey, 'encounter_ended',
       CAST(l_shipdate AS TIMESTAMP) + l_linenumber * INTERVAL '95' SECOND, 'enc_' || l_orderkey, 'chr_' || l_suppkey % 40,
       NULL, NULL, NULL, NULL, NULL, CASE l_returnflag WHEN 'R' THEN 'defeat' ELSE 'victory' END, NULL, NULL, NULL
FROM lineitem WHERE l_partkey % 19 <> 0
UNION ALL
SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey, 'encounter_damage_summary',
       CAST(l_shipdate AS TIMESTAMP), 'enc_' || l_orderkey, 'chr_' || l_suppkey % 40, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN l_linenumber = 2 THEN '[]'
            WHEN l_linenumber = 3 THEN '[{"ability_id": "abl_1"}, {"ability_id": "abl_2", "total": '
                 || CAST(l_quantity AS BIGINT) || '}]'
            ELSE '[{"ability_id": "abl_1", "total": ' || CAST(l_quantity AS BIGINT) * 3 || '}, {"total": 7}]' END,
       '[{"source_type": "creature", "total": ' || CAST(l_quantity AS BIGINT) || '}]'
FROM lineitem WHERE l_orderkey % 7 > 1
UNION ALL
SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey,
       CASE l_linenumber % 3 WHEN 0 THEN 'pve_damage_received' ELSE 'pve_damage_dealt' END,
       CAST(l_shipdate AS TIMESTAMP), 'enc_' || l_orderkey, 'chr_' || l_suppkey % 40, NULL, NULL, NULL, NULL, NULL, NULL,
       CAST(l_quantity AS BIGINT) * 10, NULL, NULL
FROM lineitem WHERE l_orderkey % 7 < 3"""
VIEWS["deaths_log"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id, 'character_died' AS event_type, ts AS event_ts_utc,
       'chr_' || user_id AS character_id, 'enc_' || event_id AS encounter_id, 'zone_' || k % 25 AS zone_id,
       'sub_' || k AS sub_zone_id,
       CASE WHEN event_id % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN 'character' WHEN k % 3 = 1 THEN 'creature' END AS killer_type,
       CASE WHEN k % 3 = 0 THEN 'chr_' || k ELSE 'crt_' || k END AS killer_id
FROM ev WHERE kind = 'error'"""
VIEWS["loot_log"] = """
SELECT event_id, 'sev_' || event_id AS server_event_id,
       CASE kind WHEN 'purchase' THEN 'item_dropped' ELSE 'item_looted' END AS event_type, ts AS event_ts_utc,
       CASE kind WHEN 'purchase' THEN NULL ELSE 'chr_' || user_id END AS character_id, 'enc_' || event_id AS encounter_id,
       CASE kind WHEN 'purchase' THEN 'crt_' || user_id % 10 END AS creature_id, 'zone_' || k % 25 AS zone_id,
       'sub_' || k AS sub_zone_id, 'itm_' || user_id % 15 || '_' || k AS item_instance_id,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'tpl_' || k END AS item_template_id,
       CASE kind WHEN 'purchase' THEN 'chr_' || (user_id + k % 2) END AS assigned_character_id
FROM ev WHERE kind IN ('purchase', 'view')"""
VIEWS["economy"] = """
SELECT event_id, CASE kind WHEN 'purchase' THEN 'gold_credited' WHEN 'view' THEN 'item_sold'
                           WHEN 'signup' THEN 'trade_completed' WHEN 'click' THEN 'auction_purchased'
                           ELSE 'auction_sold' END AS event_type,
       ts AS event_ts_utc, 'chr_' || user_id AS character_id,
       CASE WHEN kind = 'purchase' AND event_id % 43 > 0 THEN cents END AS gold_amount,
       CASE WHEN kind IN ('view', 'click', 'error') AND event_id % 43 > 0 THEN cents END AS price,
       CASE WHEN kind = 'signup' THEN CASE WHEN k % 5 = 0 THEN 0 ELSE k * 3 END END AS gold_given,
       CASE WHEN kind = 'signup' THEN CASE WHEN k % 5 = 0 THEN 0 WHEN event_id % 47 > 0 THEN k * 2 END END AS gold_received,
       CASE WHEN kind = 'error' THEN CAST(floor(cents / 20) AS BIGINT) END AS auction_cut,
       CASE WHEN kind = 'view' AND event_id % 6 > 0 THEN 'tpl_' || k END AS item_template_id,
       CASE WHEN kind IN ('view', 'error') THEN 'itm_' || event_id END AS item_instance_id,
       CASE WHEN kind = 'error' THEN 'chr_' || (user_id + 1) END AS buyer_character_id,
       CASE WHEN kind = 'view' THEN 'mer_' || k % 7 END AS merchant_id,
       'zone_' || k % 25 AS zone_id, CASE WHEN kind = 'signup' THEN 'trd_' || k || '_' || day(ts) END AS trade_id
FROM ev"""
VIEWS["presence"] = """
SELECT event_id, event_id AS shard_seq, ts AS event_ts_utc, CASE WHEN event_id % 83 = 0 THEN NULL ELSE 'chr_' || user_id END AS character_id,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'sub_' || k END AS sub_zone_id
FROM ev"""
VIEWS["balances"] = """
SELECT event_id, 'chr_' || user_id AS character_id, ts AS event_ts_utc, k * 10 AS movement,
       CASE WHEN event_id % 31 = 0 THEN cents ELSE k * 10 + CASE WHEN event_id % 3 = 0 THEN 20 ELSE 40 END END AS balance_after
FROM ev"""
VIEWS["party_members"] = """
SELECT 'pty_' || o_custkey AS party_id, 'chr_' || o_orderkey % 1500 AS character_id,
       CAST(o_orderdate AS TIMESTAMP) AS joined_at,
       CASE WHEN o_orderkey % 37 = 0 THEN CAST(NULL AS TIMESTAMP)
            ELSE CAST(o_orderdate AS TIMESTAMP) + (o_orderkey % 300) * INTERVAL '1' DAY END AS left_at
FROM orders"""
VIEWS["loot_entries"] = """
SELECT 'ent_' || s_suppkey AS loot_entry_id, 'crt_' || s_suppkey AS creature_id, 'tpl_' || s_suppkey AS item_template_id,
       CAST(0.25 AS DECIMAL(38,10)) AS drop_chance, CASE WHEN s_suppkey % 3 = 0 THEN '2.1' ELSE '2.0' END AS valid_from_version,
       CASE WHEN s_suppkey % 3 = 1 THEN '2.1' END AS valid_to_version
FROM supplier"""
VIEWS["kill_log"] = """
SELECT event_id, kind, 'crt_' || k AS creature_id, 'tpl_' || k AS item_template_id,
       CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN '2.0' ELSE '2.1' END AS game_version
FROM ev"""


def dependencies(name: str) -> list[str]:
    """Views and tables a view is built on, in an order in which they can be defined."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        if n in VIEWS:
            for used in re.findall(r"\bFROM\s+(\w+)", VIEWS[n]):
                visit(used)
        ordered.append(n)

    visit(name)
    return ordered


def with_clause(names: list[str], tables: dict[str, str] | None = None) -> str:
    """`WITH ...` text that defines the views; `tables` gives the source of each sample table.

    Without `tables` the sample tables are expected to exist as relations.
    """
    wanted: list[str] = []
    for name in names:
        wanted += [n for n in dependencies(name) if n not in wanted]
    parts = []
    for n in wanted:
        if n in VIEWS:
            parts.append(f"{n} AS ({VIEWS[n]}\n)")
        elif tables is not None:
            parts.append(f"{n} AS (SELECT * FROM {tables[n]})")
    return "WITH " + ",\n".join(parts)


_opened: dict[tuple[str, str, str], DataFrame] = {}


def sample_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One sample table; its file is listed and its schema read once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _opened:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        cores = spark.sparkContext.defaultParallelism
        if name in ROW_KEYS and df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores, ROW_KEYS[name])
        _opened[key] = df
    return _opened[key]


def view(spark: SparkSession, sf_dir: str, name: str, stream: DataFrame | None = None) -> DataFrame:
    """A view over the sample tables of one folder; `stream` replaces the events table."""
    key = (spark.sparkContext.applicationId, sf_dir, f"view {name}")
    if stream is None and key in _opened:
        return _opened[key]
    used = [n for n in dependencies(name) if n not in VIEWS]
    relations = {n: f"sample_{n}" for n in used}
    for n in used:
        table = stream if stream is not None and n == "events" else sample_table(spark, sf_dir, n)
        table.createOrReplaceTempView(relations[n])
    df = spark.sql(f"{with_clause([name], relations)}\nSELECT * FROM {name}")
    if stream is None:
        _opened[key] = df
    return df
