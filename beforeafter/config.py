"""Window lengths and scoring parameters.

The defaults are the fixed values of the method: a 28-day baseline before the
anchor contact, a 7-day impact window starting on the anchor day, a trailing
90-day RFM window and quintile scores.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LiftConfig:
    pre_days: int = 28
    post_days: int = 7
    rfm_days: int = 90
    buckets: int = 5
    # False keeps the documented behaviour: NTILE over recency ascending, so
    # the most recent buyers get r_score = 1.  True sorts recency descending.
    recency_best_high: bool = False

    def __post_init__(self) -> None:
        for name in ("pre_days", "post_days", "rfm_days", "buckets"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")


DEFAULT = LiftConfig()

# Sensitivity grid of the validation checklist (fixed values).
SENSITIVITY_PRE_DAYS = (14, 28, 56)
SENSITIVITY_POST_DAYS = (3, 7, 14)
