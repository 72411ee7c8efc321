from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart.session import build_session  # noqa: E402

T0 = dt.datetime(2026, 8, 20, 12, 0, 0)
TYPES = {"event_id": "bigint", "shard_seq": "bigint", "event_ts_utc": "timestamp", "damage": "bigint", "xp_amount": "bigint",
         "price": "bigint", "gold_amount": "bigint", "gold_given": "bigint", "gold_received": "bigint", "auction_cut": "bigint",
         "new_level": "int", "items_given": "array<string>", "items_received": "array<string>",
         "opponent_character_ids": "array<string>", "xp_total": "bigint"}
TEXT = ["server_event_id", "event_type", "server_id", "character_id", "encounter_id", "zone_id", "sub_zone_id", "slot",
        "item_instance_id", "item_template_id", "ability_id", "attack_type", "target_creature_id", "target_character_id",
        "counterpart_character_id", "trade_id", "transport_id", "encounter_kind", "creature_id", "killer_type",
        "killer_id", "outcome", "party_id", "summary_damage_done", "summary_damage_received", "merchant_id",
        "buyer_character_id", "assigned_character_id"]
SCHEMA = ", ".join([f"{k} {v}" for k, v in TYPES.items()] + [f"{k} string" for k in TEXT] + ["is_critical boolean"])
NAMES = [p.split()[0] for p in SCHEMA.split(", ")]


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                      spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture()
def events(spark):
    """Cleaned events from keyword rows; `t` is seconds after noon, ids are numbered if not given."""

    def make(*rows: dict):
        out = []
        for i, r in enumerate(rows, start=1):
            r = dict(r)
            if "t" in r:
                r["event_ts_utc"] = at(r.pop("t"))
            r.setdefault("event_id", i)
            r.setdefault("server_event_id", f"s{r['event_id']}")
            unknown = set(r) - set(NAMES)
            assert not unknown, unknown
            out.append(tuple(r.get(n) for n in NAMES))
        return spark.createDataFrame(out, SCHEMA)

    return make


def rows(df, *names):
    """Rows as sorted tuples."""
    got = [tuple(r) for r in (df.select(*names) if names else df).collect()]
    return sorted(got, key=str)
