"""Every tunable number of the pipeline, in one immutable place."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Params:
    # Power curve: 0.5 * density * area * v^3 * coefficient, in MW.
    air_density: float = 1.2
    swept_area: float = 5024.0
    power_coefficient: float = 0.45
    # Site feeds report power as a fraction of this rating, in MW.
    rated_power: float = 4.5
    # Residual z-score.
    zscore_threshold: float = 2.0
    # Isolation forest.
    contamination_rate: float = 0.15
    trees: int = 200
    max_samples: int = 256
    seed: int = 42
    # Share of anomalous readings above which a turbine is rated.
    faulty_rate: float = 0.6
    review_rate: float = 0.3
    # Length of a summary window.
    summary_window: str = "24 hours"

    def __post_init__(self) -> None:
        if not 0.0 < self.contamination_rate < 1.0:
            raise ValueError("contamination_rate must lie strictly between 0 and 1")
        if self.seed < 0:
            raise ValueError("seed must not be negative")
        if self.trees < 1 or self.max_samples < 1:
            raise ValueError("trees and max_samples must be positive")

    @classmethod
    def from_config(cls, config: Mapping[str, Any] | None = None) -> Params:
        """Build from a plain mapping, e.g. ``{"zscore_threshold": 3.0}``.

        Keys of other jobs that share the mapping are passed over with a warning.
        """
        given = dict(config or {})
        known = {field.name for field in fields(cls)}
        for name in sorted(set(given) - known):
            log.warning("ignoring the unknown parameter %s", name)
        return cls(**{name: given[name] for name in given if name in known})
