"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import UTC, datetime


@dataclass(frozen=True)
class RunConfig:
    """Parameters of the training and scoring runs.

    ``horizon_days`` is the look-ahead of the repeat-purchase label and
    ``baseline_window_days`` that of the baseline churn evaluation.
    """

    raw_path: str = "raw"
    model_version: str = "repeat30_v5"
    scoring_version: str = "scoring_rfm_v1"
    horizon_days: int = 30
    baseline_window_days: int = 90
    top_k_fraction: float = 0.10
    active_lookback_days: int = 120
    min_orders_lifetime: int = 2
    holdout_snapshots: int = 5
    min_train_snapshots: int = 5
    run_ts: datetime | None = None

    def started(self) -> RunConfig:
        """This configuration with its timestamp fixed, so that all rows of a run agree."""
        return replace(self, run_ts=self.run_ts or datetime.now(UTC).replace(tzinfo=None))

    # The wording of both notes.
    def training_notes(self, holdout_n: int) -> str:
        return (
            f"horizon_days={self.horizon_days}, active_lookback_days={self.active_lookback_days}, "
            f"min_orders_lifetime={self.min_orders_lifetime}, top_k_fraction={self.top_k_fraction}, "
            f"holdout_snapshots={holdout_n}"
        )

    def baseline_notes(self) -> str:
        return f"window_days={self.baseline_window_days}, top_k_fraction={self.top_k_fraction}"
