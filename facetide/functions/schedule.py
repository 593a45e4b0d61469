from __future__ import annotations

from pyspark.sql import Column, functions as F

from facetide.functions._util import as_column

# Fixed values of the learning-rate schedule.
DECAY_STEPS = 3000
DECAY_RATE = 0.9


def decayed_lr(
    step: Column | str, lr: float, decay_steps: int = DECAY_STEPS, rate: float = DECAY_RATE
) -> Column:
    """Staircase exponential decay: ``lr * rate ** floor(step / decay_steps)``."""
    return F.lit(float(lr)) * F.pow(F.lit(float(rate)), F.floor(as_column(step) / decay_steps))
