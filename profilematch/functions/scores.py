"""Score columns: rounding, clipping, display formats, accuracy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are compared after rounding to this many places, so that the order in which a sum was
# taken cannot change a ranking.
RANK_PLACES = 10


def rank_score(score: Column | str) -> Column:
    return F.round(score, RANK_PLACES)


def clip01(score: Column | str) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def fixed(score: Column | str, places: int) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.format_string(f"%.{places}f", c)


def percent(share: Column | str) -> Column:
    c = F.col(share) if isinstance(share, str) else share
    return c * 100.0


def percent_text(share: Column | str) -> Column:
    return F.concat(fixed(percent(share), 2), F.lit("%"))


def accuracy(label: Column | str, prediction: Column | str) -> Column:
    a = F.col(label) if isinstance(label, str) else label
    b = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.avg((a == b).cast("double"))
