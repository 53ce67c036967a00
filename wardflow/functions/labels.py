"""Labels, date differences and score functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HORIZONS = (30, 60, 90, 120, 180)


def horizon_label(days: Column, n_days: int, inclusive: bool = False) -> Column:
    """1 when the gap lies below the horizon, else 0; no next admission gives 0."""
    hit = days <= n_days if inclusive else days < n_days
    return F.when(hit, 1).otherwise(0)


def horizon_labels(days: Column, horizons=HORIZONS, prefix: str = "OUTPUT_LABEL_") -> list[Column]:
    return [horizon_label(days, n).alias(f"{prefix}{n}") for n in horizons]


def mask_elective(next_type: Column, value: Column) -> Column:
    """NULL when the next admission is planned; an unknown next type keeps the value."""
    return F.when(next_type == "ELECTIVE", None).otherwise(value)


def day_gap(later: Column, earlier: Column) -> Column:
    """Calendar days between two times."""
    return F.datediff(later, earlier)


def month_gap(later: Column, earlier: Column) -> Column:
    """Month boundaries between two times."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def month_label(next_time: Column, time: Column, months: int = 6) -> Column:
    """1 when a later admission starts within ``months`` month boundaries."""
    return F.when((next_time != time) & (month_gap(next_time, time) <= months), 1).otherwise(0)


def sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def at_threshold(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability >= threshold, 1).otherwise(0)


def argmax(scores: Column) -> Column:
    """Position of the first largest element, from 0."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def log_loss(label: Column, probability: Column, floor: float = 1e-12) -> Column:
    """Binary cross-entropy of one row; probabilities are kept off 0 and 1 by ``floor``.

    NULL when the label or the probability is unknown.
    """
    p = F.when(probability.isNotNull(), F.greatest(F.least(probability, F.lit(1 - floor)), F.lit(floor)))
    return -F.when(label == 1, F.log(p)).when(label == 0, F.log(1 - p))


def first_as_int(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1)).cast("int")
