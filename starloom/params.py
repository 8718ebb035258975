"""Run parameters (the reference keeps them in a YAML file; here they are plain arguments)."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's defaults for identical results.
# Order statuses accepted by the order cleaning step, in the order they are
# inserted into dim_status (their surrogate keys follow this order):
#   delivered, shipped, processing, canceled, invoiced, approved, unavailable, created
# Minimum accepted line price (exclusive): 0.0
# Maximum share of null foreign keys in fact_orders before the gate fails: 0.01
# Loaded/staged fact ratio below which the gate warns: 0.70
# ---------------------------------------------------------------------------
DEFAULT_STATUSES: tuple[str, ...] = (
    "delivered",
    "shipped",
    "processing",
    "canceled",
    "invoiced",
    "approved",
    "unavailable",
    "created",
)

@dataclass(frozen=True)
class Params:
    valid_statuses: tuple[str, ...] = DEFAULT_STATUSES
    min_price: float = 0.0
    max_null_ratio_fact_fk: float = 0.01
    min_load_ratio: float = 0.70
    # Formats tried on time text that is neither ISO nor a slash date.
    timestamp_formats: tuple[str, ...] = ()
    # "each": every time text is read by itself. "infer": a column has the format of its first non-null
    # value in input order, other values become null.
    timestamps: str = "each"
    # Lines of a customer alias dropped by the deduplication go to the surviving customer.
    resolve_aliases: bool = False

    def __post_init__(self) -> None:
        if self.timestamps not in ("each", "infer"):
            raise ValueError(f"timestamps must be 'each' or 'infer', not {self.timestamps!r}")
