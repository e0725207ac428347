"""Parameters of the risk flow.

The defaults are fixed values that must equal the reference's job settings so
that a user switching over gets the same answers without passing anything.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal

# --- fixed values (reference defaults) -------------------------------------
DEFAULT_BOOTSTRAP_SERVERS = "kafka:9092"
DEFAULT_INPUT_TOPIC = "raw_transactions"
DEFAULT_OUTPUT_TOPIC = "risk_alerts"
DEFAULT_CHECKPOINT_RISK = "/checkpoints/risk_alerts"
DEFAULT_CHECKPOINT_LAKE = "/checkpoints/data_lake"
DEFAULT_DATA_LAKE_PATH = "transactions_data_lake"
DEFAULT_TX_COUNT_THRESHOLD = 10
DEFAULT_AMOUNT_THRESHOLD = "10000.0"
DEFAULT_WINDOW_DURATION = "1 minute"
DEFAULT_WATERMARK_DURATION = "5 minutes"
DEFAULT_LAKE_TRIGGER = "1 minute"
DEFAULT_ESTIMATE_SAMPLE_ROWS = 1000
DEFAULT_PROFILE_CATEGORY = "HIGH"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskParams:
    """Thresholds and event-time settings of the windowed risk aggregation.

    ``amount_threshold`` is kept as a ``Decimal`` so the comparison with the
    DECIMAL sum stays exact (no float rounding on the boundary).
    """

    tx_count_threshold: int = DEFAULT_TX_COUNT_THRESHOLD
    amount_threshold: Decimal = Decimal(DEFAULT_AMOUNT_THRESHOLD)
    window_duration: str = DEFAULT_WINDOW_DURATION
    watermark_duration: str = DEFAULT_WATERMARK_DURATION

    def __post_init__(self):
        if not isinstance(self.amount_threshold, Decimal):
            object.__setattr__(self, "amount_threshold", Decimal(str(self.amount_threshold)))

    def with_(self, **kw) -> "RiskParams":
        return replace(self, **kw)


# Thresholds under which the driver tables give non-empty answers: the events
# table is sparse (at most 2 rows per user and minute), so the defaults above
# return nothing on it. Used by the named queries, the bench and the tests.
FIXTURE_PARAMS = RiskParams(
    tx_count_threshold=4,
    amount_threshold=Decimal("300"),
    window_duration="1 day",
    watermark_duration="5 minutes",
)
