"""All thresholds of the method, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # fixed values: the method's limits
    min_notsold: float = 0.20
    max_notsold: float = 0.95
    min_stockout_weeks: int = 1
    pre_weeks: int = 4
    post_weeks: int = 4
    max_gap_weeks: int = 2
    min_market_pre: float = 1.0
    min_effect: float = 0.001
    iqr_multiplier: float = 1.5
    dip_alpha: float = 0.05
    min_n_for_dip: int = 4
    high_cv: float = 0.15
    medium_cv: float = 0.30
    saturation_markets: int = 150
    multimodal_penalty: float = 0.85
    min_market_count: int = 20
    share_sum_epsilon: float = 0.01
    decompose_epsilon: float = 0.001
    sniff_rows: int = 3
    max_file_mb: float = 2048.0
    reliability_low: float = 0.70
    reliability_high: float = 1.0
    pareto_target: float | None = 0.80
    top_n: int | None = None
    tier_a: float = 0.85
    tier_b: float = 0.55

    def __post_init__(self) -> None:
        if not 0 <= self.min_notsold < self.max_notsold <= 1:
            raise ValueError("not-sold shares must satisfy 0 <= min < max <= 1")
        if min(self.min_stockout_weeks, self.pre_weeks, self.post_weeks) < 1 or self.max_gap_weeks < 0:
            raise ValueError("week counts must be positive")
        if self.pareto_target is not None and not 0 < self.pareto_target <= 1:
            raise ValueError("the Pareto target must lie in (0, 1]")


DEFAULT = Params()
