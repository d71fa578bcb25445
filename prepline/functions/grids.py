"""Parameter grids."""

from __future__ import annotations

import numpy as np


def log_grid(low: float, high: float, num: int) -> list[float]:
    """``num`` values from 10**low to 10**high, evenly spaced in the exponent."""
    return [float(v) for v in np.logspace(low, high, num=num)]


def linear_grid(low: float, high: float, num: int) -> list[float]:
    return [float(v) for v in np.linspace(low, high, num)]
