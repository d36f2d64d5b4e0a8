"""Rules for numbers, times, arrays and vectors as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ten(score: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(10.0), F.when(score > 10, score / 10).otherwise(score))), 1)


def score_or_default(score: Column, default: float = 5.0) -> Column:
    """0 to 10 with one decimal; scores above 10 are on a scale of 100; what is no number has the default."""
    return _ten(F.coalesce(score.try_cast("double"), F.lit(default)))


def score_or_null(score: Column) -> Column:
    """Like :func:`score_or_default`; what is no number stays null."""
    number = score.try_cast("double")
    return F.when(number.isNotNull(), _ten(number))


def share(value: Column) -> Column:
    """0 to 1; what is no number is 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value.try_cast("double"), F.lit(0.0))))


def clamp_similarity(value: Column) -> Column:
    """Three decimals, at most 9.999."""
    return F.least(F.round(value, 3), F.lit(9.999))


def unit(vector: Column) -> Column:
    """The vector by its length; null if it has none."""
    vector = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(vector, lambda x: x / norm))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 for vectors of different sizes and for those without length."""
    a, b = a.cast("array<double>"), b.cast("array<double>")
    return F.when(F.size(a) == F.size(b), F.coalesce(dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0)), F.lit(0.0))).otherwise(0.0)


def known_first(items: Column, allowed: Column, most: int) -> Column:
    """Allowed items in their order, each once, at most ``most``; null gives an empty array."""
    return F.slice(F.array_distinct(F.array_intersect(F.coalesce(items, F.array().cast("array<string>")), allowed)), 1, most)


def moment(text: Column) -> Column:
    """A time from ISO text; null, empty and unreadable text give null, times without a zone are UTC."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")))


def older_than(time: Column, now: Column, days: int) -> Column:
    """Strictly older; a null time is never old."""
    return F.coalesce(time < now - F.expr(f"INTERVAL {days} DAYS"), F.lit(False))


def missing_names(**columns: Column) -> Column:
    """Names of the columns that are blank, in the given order, joined by a comma."""
    return F.array_join(F.filter(F.array(*[F.when(F.trim(F.coalesce(c.cast("string"), F.lit(""))) == "", F.lit(n)) for n, c in columns.items()]), lambda x: x.isNotNull()), ", ")
