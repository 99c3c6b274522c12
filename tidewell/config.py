"""Fixed values and declarative contracts.

Everything in the "fixed values" blocks must equal the original system's
rules for results to match; it is stated here plainly and in one place.
Contracts are plain data: the DQ engine (``operators.dq``) compiles them into
Spark aggregate expressions.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

ERROR = "ERROR"
WARN = "WARN"

# ---------------------------------------------------------------------------
# Engine constants
# ---------------------------------------------------------------------------
ROW_DRIFT_RATIO = 0.30          # row_count_drift tolerance
FUZZY_CUTOFF = 0.82             # taxonomy similarity cutoff
UNKNOWN = "unknown"             # unresolved taxonomy segment
SEGMENT_ORDER = ["geo", "channel", "objective", "product", "audience", "period", "offer"]

# Controlled campaign vocabulary (segment -> terms, in order).
TAXONOMY = {
    "geo": ["BR", "PT", "AO"],
    "channel": ["email", "push", "sms"],
    "objective": ["acquisition", "reactivation", "retention", "crosssell"],
    "product": ["sports", "casino", "both"],
    "audience": ["new", "active", "dormant", "vip"],
    "offer": ["bonus50", "bonus100", "freebet", "freespins", "cashback", "none"],
}

# Text -> boolean map used by the tolerant cast.
BOOLEAN_TEXT = {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}

# Tokens a CSV reader treats as missing (pandas defaults).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null"]

# FX.
FX_BASE = "EUR"
FX_TARGET = "BRL"
FX_QUOTES = ["USD", "EUR"]
FX_LOOKBACK_DAYS = 10
FX_RATE_FLOOR, FX_RATE_CEILING = 0.5, 20.0
FX_ROUND = 8
FX_JUMP_LIMIT = 0.10
FX_RATE_SOURCE = "frankfurter_ecb"

# Marts.
DORMANCY_DAYS = 30
DEFAULT_PRODUCT = "nenhum"
DEFAULT_OFFER = "sem_contato"
DEFAULT_TIER = "sem_faixa"
TIER_LABELS = {1: "Q1_baixo", 2: "Q2_medio", 3: "Q3_alto", 4: "Q4_muito_alto"}
# (upper bound inclusive, label); anything above the last bound is the tail label
DAY_BUCKETS = [(7, "01_ate_7"), (14, "02_8_14"), (21, "03_15_21"), (30, "04_22_30"),
               (45, "05_31_45"), (60, "06_46_60"), (84, "07_61_84")]
DAY_BUCKET_TAIL = "08_85_mais"
TARGET_TIERS = ["Q4_muito_alto", "Q3_alto"]
TARGET_DAYS = (31, 84)

CHANNELS = ["organic", "influencer", "seo", "paid_social", "affiliate", "unknown"]
DELIVERY = ["email", "push", "sms"]

# DQ check -> metric name.
CHECK_TO_METRIC = {
    "primary_key_unique": "DuplicateKeys",
    "primary_key_conflict": "DuplicateKeys",
    "duplicate_event": "DuplicateKeys",
    "reconciliation": "ReconciliationDiff",
    "not_blank": "BlankValues",
    "accepted_values": "DomainViolations",
    "timestamp_parseable": "UnparseableTimestamps",
    "not_future_dated": "FutureDatedRecords",
    "numeric_parseable": "UnparseableNumerics",
    "numeric_range": "OutOfRangeNumerics",
    "value_ceiling": "OutOfRangeNumerics",
    "value_floor": "OutOfRangeNumerics",
    "id_pattern": "FormatViolations",
    "no_surrounding_whitespace": "FormatViolations",
    "referential_integrity": "OrphanRecords",
}


@dataclass(frozen=True)
class Contract:
    """Declarative data contract for one entity (all rules optional)."""

    columns: list[str]
    expected_rows: int | None = None
    pk: str | None = None
    business_key: list[str] | None = None
    not_blank: dict[str, tuple[str, float]] = field(default_factory=dict)
    domains: dict[str, tuple[str, list[str]]] = field(default_factory=dict)
    dates: list[str] = field(default_factory=list)
    positive: list[str] = field(default_factory=list)
    non_negative: list[str] = field(default_factory=list)
    max_value: dict[str, tuple[str, float]] = field(default_factory=dict)
    min_value: dict[str, tuple[str, float]] = field(default_factory=dict)
    pattern: dict[str, str] = field(default_factory=dict)
    no_spaces: list[str] = field(default_factory=list)
    fks: dict[str, str] = field(default_factory=dict)


# ---------------------------------------------------------------------------
# Bronze contracts (raw text)
# ---------------------------------------------------------------------------
BRONZE_CONTRACTS: dict[str, Contract] = {
    "players": Contract(
        columns=["player_id", "signup_date", "acquisition_channel", "country",
                 "preferred_currency", "kyc_status", "self_excluded"],
        expected_rows=250,
        pk="player_id",
        not_blank={"player_id": (ERROR, 0.0), "country": (ERROR, 0.0),
                   "preferred_currency": (ERROR, 0.0), "acquisition_channel": (WARN, 0.15)},
        domains={"country": (WARN, ["BR", "PT", "AO"]),
                 "preferred_currency": (ERROR, ["BRL", "USD", "EUR"]),
                 "kyc_status": (WARN, ["verified", "pending", "rejected"]),
                 "self_excluded": (ERROR, ["true", "false"])},
        dates=["signup_date"],
        pattern={"player_id": r"P\d{5}"},
        no_spaces=["player_id"],
    ),
    "deposits": Contract(
        columns=["deposit_id", "player_id", "deposit_ts", "amount", "currency", "status"],
        expected_rows=1176,
        pk="deposit_id",
        business_key=["player_id", "deposit_ts", "amount", "currency", "status"],
        not_blank={"deposit_id": (ERROR, 0.0), "player_id": (ERROR, 0.0),
                   "amount": (ERROR, 0.0), "currency": (ERROR, 0.0), "status": (ERROR, 0.0)},
        domains={"currency": (ERROR, ["BRL", "USD", "EUR"]),
                 "status": (ERROR, ["confirmed", "pending", "failed"])},
        dates=["deposit_ts"],
        positive=["amount"],
        max_value={"amount": (WARN, 50_000.0)},
        pattern={"deposit_id": r"D\d{7}", "player_id": r"P\d{5}"},
        no_spaces=["deposit_id", "player_id"],
        fks={"player_id": "players.player_id"},
    ),
    "bets": Contract(
        columns=["bet_id", "player_id", "bet_ts", "stake", "currency", "product", "payout"],
        expected_rows=3702,
        pk="bet_id",
        business_key=["player_id", "bet_ts", "stake", "currency", "product", "payout"],
        not_blank={"bet_id": (ERROR, 0.0), "player_id": (ERROR, 0.0), "stake": (ERROR, 0.0),
                   "payout": (ERROR, 0.0), "currency": (ERROR, 0.0)},
        domains={"currency": (ERROR, ["BRL", "USD", "EUR"]),
                 "product": (ERROR, ["sports", "casino"])},
        dates=["bet_ts"],
        positive=["stake"],
        non_negative=["payout"],
        max_value={"stake": (WARN, 50_000.0), "payout": (WARN, 500_000.0)},
        pattern={"bet_id": r"B\d{7}", "player_id": r"P\d{5}"},
        no_spaces=["bet_id", "player_id"],
        fks={"player_id": "players.player_id"},
    ),
    "campaigns": Contract(
        columns=["campaign_id", "campaign_name", "created_date", "status"],
        expected_rows=12,
        pk="campaign_id",
        not_blank={"campaign_id": (ERROR, 0.0), "campaign_name": (WARN, 0.20)},
        domains={"status": (WARN, ["active", "paused", "archived"])},
        dates=["created_date"],
        pattern={"campaign_id": r"C\d{3}"},
        no_spaces=["campaign_id"],
    ),
    "campaign_touchpoints": Contract(
        columns=["touchpoint_id", "player_id", "campaign_id", "channel", "event_ts", "event_type"],
        expected_rows=1260,
        pk="touchpoint_id",
        business_key=["player_id", "campaign_id", "channel", "event_ts", "event_type"],
        not_blank={"touchpoint_id": (ERROR, 0.0), "player_id": (ERROR, 0.0),
                   "campaign_id": (ERROR, 0.0)},
        domains={"channel": (ERROR, ["email", "push", "sms"]),
                 "event_type": (ERROR, ["sent", "open", "click"])},
        dates=["event_ts"],
        pattern={"touchpoint_id": r"T\d{7}", "player_id": r"P\d{5}", "campaign_id": r"C\d{3}"},
        no_spaces=["touchpoint_id", "player_id", "campaign_id"],
        fks={"player_id": "players.player_id", "campaign_id": "campaigns.campaign_id"},
    ),
}

ENTITIES = list(BRONZE_CONTRACTS)

# FX contract.
FX_CONTRACT = Contract(
    columns=["rate_date", "from_currency", "to_currency", "rate", "source_rate_date",
             "is_carried_forward", "rate_source", "fetched_at"],
    not_blank={"rate_date": (ERROR, 0.0), "from_currency": (ERROR, 0.0),
               "to_currency": (ERROR, 0.0), "rate": (ERROR, 0.0)},
    domains={"from_currency": (ERROR, ["BRL", "USD", "EUR"]),
             "to_currency": (ERROR, ["BRL"]),
             "rate_source": (WARN, [FX_RATE_SOURCE])},
    positive=["rate"],
    min_value={"rate": (ERROR, FX_RATE_FLOOR)},
    max_value={"rate": (ERROR, FX_RATE_CEILING)},
    business_key=["rate_date", "from_currency", "to_currency"],
)

# Gold contracts.
GOLD_CONTRACTS: dict[str, Contract] = {
    "dim_date": Contract(
        columns=["date_key", "full_date", "year", "quarter", "month", "day_of_week",
                 "day_name", "is_weekend", "is_business_day"],
        pk="date_key",
        not_blank={"date_key": (ERROR, 0.0), "full_date": (ERROR, 0.0)},
        positive=["date_key", "year"],
    ),
    "dim_player": Contract(
        columns=["player_id", "signup_date_key", "acquisition_channel", "country",
                 "preferred_currency", "kyc_status", "self_excluded", "is_targetable"],
        pk="player_id",
        expected_rows=250,
        not_blank={"player_id": (ERROR, 0.0), "acquisition_channel": (ERROR, 0.0)},
        domains={"acquisition_channel": (WARN, CHANNELS)},
        pattern={"player_id": r"P\d{5}"},
        fks={"signup_date_key": "dim_date.date_key"},
    ),
    "dim_campaign": Contract(
        columns=["campaign_id", "campaign_name", "campaign_name_std", "created_date_key",
                 "status", "geo", "channel_declarado", "objective", "product", "audience",
                 "period", "offer", "is_taxonomy_compliant"],
        pk="campaign_id",
        not_blank={"campaign_id": (ERROR, 0.0)},
        domains={"offer": (WARN, ["bonus50", "bonus100", "freebet", "freespins",
                                  "cashback", "none", "unknown"]),
                 "product": (WARN, ["sports", "casino", "both", "unknown"])},
        fks={"created_date_key": "dim_date.date_key"},
    ),
    "fact_deposit": Contract(
        columns=["deposit_id", "player_id", "date_key", "deposit_ts", "currency", "status",
                 "is_confirmed", "amount", "fx_rate", "amount_brl"],
        pk="deposit_id",
        not_blank={"deposit_id": (ERROR, 0.0), "player_id": (ERROR, 0.0)},
        domains={"currency": (ERROR, ["BRL", "EUR", "USD"]),
                 "status": (ERROR, ["confirmed", "pending", "failed"])},
        positive=["amount", "amount_brl", "fx_rate"],
        fks={"player_id": "dim_player.player_id", "date_key": "dim_date.date_key"},
    ),
    "fact_bet": Contract(
        columns=["bet_id", "player_id", "date_key", "bet_ts", "product", "currency", "stake",
                 "payout", "fx_rate", "stake_brl", "payout_brl", "net_brl"],
        pk="bet_id",
        not_blank={"bet_id": (ERROR, 0.0), "player_id": (ERROR, 0.0)},
        domains={"currency": (ERROR, ["BRL", "EUR", "USD"]),
                 "product": (ERROR, ["sports", "casino"])},
        positive=["stake", "stake_brl", "fx_rate"],
        non_negative=["payout", "payout_brl"],
        fks={"player_id": "dim_player.player_id", "date_key": "dim_date.date_key"},
    ),
    "fact_touchpoint": Contract(
        columns=["touchpoint_id", "player_id", "campaign_id", "date_key", "event_ts",
                 "delivery_channel", "event_type", "is_sent", "is_open", "is_click"],
        pk="touchpoint_id",
        not_blank={"touchpoint_id": (ERROR, 0.0), "player_id": (ERROR, 0.0),
                   "campaign_id": (ERROR, 0.0)},
        domains={"delivery_channel": (ERROR, DELIVERY),
                 "event_type": (ERROR, ["sent", "open", "click"])},
        fks={"player_id": "dim_player.player_id", "campaign_id": "dim_campaign.campaign_id",
             "date_key": "dim_date.date_key"},
    ),
}

GOLD_WRITE_ORDER = ["dim_date", "dim_player", "dim_campaign",
                    "fact_deposit", "fact_bet", "fact_touchpoint"]


# ---------------------------------------------------------------------------
# Binding of the driver's test tables (our own choices, not fixed values)
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class References:
    """Reference instants: quarantine cut per entity, mart cuts."""

    quarantine: dict[str, _dt.date]
    dormancy_ref: _dt.date        # vw_player_360 / return curve reference
    touch_ref: _dt.date           # last-offer cut (strict <)


TESTDATA_REFS = References(
    quarantine={"players": _dt.date(2001, 8, 2), "deposits": _dt.date(2001, 8, 2),
                "bets": _dt.date(2001, 8, 2), "campaigns": _dt.date(2024, 2, 1),
                "campaign_touchpoints": _dt.date(2024, 2, 1)},
    dormancy_ref=_dt.date(2001, 8, 2),
    touch_ref=_dt.date(2024, 2, 1),
)
