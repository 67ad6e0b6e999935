"""Dataset specifications: one object per dataset drives decode, validation,
feature preparation, training and the prediction projection, so the three
scoring streams share a single code path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Transaction type codes (dataset 1); anything else codes to 0:
#   CASH-IN 1, CASH-OUT 2, DEBIT 3, PAYMENT 4, TRANSFER 5
# Entry mode codes (dataset 3); anything else codes to 0:
#   Contactless 1, Chip 2, Swipe 3
# Amount buckets, upper bound inclusive, in order:
#   <= 1000 "0-1000", <= 10000 "1000-10000", <= 50000 "10000-50000",
#   <= 100000 "50000-100000", <= 500000 "100000-500000", otherwise "500000+"
# Merchant destination accounts start with "M".
# Random forest: 10 trees, max depth 5, gini impurity, 32 bins.
# ---------------------------------------------------------------------------
TRANSACTION_TYPE_CODES = {"CASH-IN": 1, "CASH-OUT": 2, "DEBIT": 3, "PAYMENT": 4, "TRANSFER": 5}
ENTRY_MODE_CODES = {"Contactless": 1, "Chip": 2, "Swipe": 3}
AMOUNT_BUCKETS = [
    (1000, "0-1000"),
    (10000, "1000-10000"),
    (50000, "10000-50000"),
    (100000, "50000-100000"),
    (500000, "100000-500000"),
]
AMOUNT_BUCKET_TOP = "500000+"
MERCHANT_PREFIX = "M"
RF_PARAMS = {"numTrees": 10, "maxDepth": 5, "impurity": "gini", "maxBins": 32}

ARRIVAL_TAGS = ["year", "month", "day", "hour", "minute"]

# Field names and types of the three datasets, in stored order.
_S, _F, _I, _D = T.StringType(), T.FloatType(), T.IntegerType(), T.DoubleType()


def _struct(cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


TRANSFERS_COLS = [
    ("step", _I), ("type", _S), ("amount", _F), ("nameOrig", _S),
    ("oldbalanceOrg", _F), ("newbalanceOrig", _F), ("nameDest", _S),
    ("oldbalanceDest", _F), ("newbalanceDest", _F), ("isFraud", _I),
    ("isFlaggedFraud", _I),
]
CARD_BEHAVIOUR_COLS = [
    ("distance_from_home", _F), ("distance_from_last_transaction", _F),
    ("fraud", _I), ("ratio_to_median_purchase_price", _F),
    ("repeat_retailer", _I), ("used_chip", _I), ("used_pin_number", _I),
    ("online_order", _I),
]
CARD_TRANSACTIONS_COLS = [
    ("amt", _F), ("bin", _I), ("customer_id", _S), ("entry_mode", _S),
    ("fraud", _I), ("fraud_scenario", _I), ("post_ts", _S),
    ("terminal_id", _S), ("transaction_id", _S),
]


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    topic: str
    columns: list  # (name, DataType) of the stored table
    label: str  # label column after preparation
    features: list  # assembler inputs, in order
    required: list  # fields whose absence quarantines a record at landing
    stream_label: str = "fraud"  # the label as records carry it
    keep: list = field(default_factory=list)  # carried through scoring
    partition_cols: tuple = ("year", "month", "day")

    @property
    def required_for_scoring(self) -> list:
        """A record without a label can't train, but is scored."""
        return [c for c in self.required if c != self.stream_label]

    @property
    def table_schema(self) -> T.StructType:
        """Stored table schema (Hive layout, without partition columns)."""
        return _struct(self.columns)

    @property
    def stream_schema(self) -> T.StructType:
        """Stream record schema: arrival tags as strings, then the table columns."""
        return _struct([(t, _S) for t in ARRIVAL_TAGS] + self.columns)


TRANSFERS = DatasetSpec(
    name="transfers",
    topic="dataset1",
    columns=TRANSFERS_COLS,
    label="fraud",
    features=["amount", "amount_to_balance_ratio"],
    required=["step", "type", "amount", "nameOrig", "oldbalanceOrg", "isFraud"],
    stream_label="isFraud",
    keep=["transaction_id", "type", "amount", "nameOrig", "nameDest"],
)
CARD_BEHAVIOUR = DatasetSpec(
    name="card_behaviour",
    topic="dataset2",
    columns=CARD_BEHAVIOUR_COLS,
    label="fraud",
    features=[
        "distance_from_home", "distance_from_last_transaction",
        "ratio_to_median_purchase_price", "repeat_retailer", "used_chip",
        "used_pin_number", "online_order",
    ],
    required=[
        "distance_from_home", "distance_from_last_transaction",
        "ratio_to_median_purchase_price", "repeat_retailer", "used_chip",
        "used_pin_number", "online_order", "fraud",
    ],
)
CARD_TRANSACTIONS = DatasetSpec(
    name="card_transactions",
    topic="dataset3",
    columns=CARD_TRANSACTIONS_COLS,
    label="fraud",
    features=["amt"],
    required=["amt", "customer_id", "transaction_id", "fraud"],
    keep=["customer_id", "transaction_id"],
)

SPECS = {s.name: s for s in (TRANSFERS, CARD_BEHAVIOUR, CARD_TRANSACTIONS)}
