"""Scalars to model numbers. -1 stands for "not mentioned"."""

from pyspark.sql import Column, functions as F

from ..schemas import (
    ANXIETY_BANDS, ANXIETY_FLOOR_BAND, ANXIETY_NO_BAND, DEFAULT_LEVEL,
    LEVEL_DIMENSION, RATING_PENALTY, SPECIALTY_CODES, UNKNOWN,
)
from .text import strip


def encode_specialty(value: Column) -> Column:
    code = strip(F.upper(value.cast("string")))
    branches = F.lit(None).cast("int")
    for name, number in SPECIALTY_CODES.items():
        branches = F.when(code == name, number).otherwise(branches)
    return F.coalesce(branches, F.lit(SPECIALTY_CODES["UNK"]))


def encode_flag(value: Column) -> Column:
    """A word that is no truth value counts as false."""
    return F.coalesce(value.try_cast("boolean"), F.lit(False)).cast("int")


def encode_sex(value: Column) -> Column:
    """Raw letters; lower case is not a known letter."""
    return F.when(value == "M", 1).when(value == "F", 0).otherwise(UNKNOWN)


def keep_sex_code(value: Column) -> Column:
    """Numbers that are already encoded."""
    code = value.try_cast("int")
    return F.when(code.isin(1, 0), code).otherwise(UNKNOWN)


def encode_optional_int(value: Column) -> Column:
    """Truncates toward zero; null, NaN, words and what no int holds mean unknown."""
    number = value.try_cast("double")
    whole = F.when(~F.isnan(number), number).try_cast("int")
    return F.coalesce(whole, F.lit(UNKNOWN))


def encode_anxiety(value: Column) -> Column:
    number = value.try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(0.0))


def level_label(level: Column) -> Column:
    """C1..C5; any other number is shown as it is."""
    return F.when(level.between(1, 5), F.concat(F.lit("C"), level.cast("string"))).otherwise(
        level.cast("string")
    )


def level_attributes(level: Column) -> Column:
    """Code, name, colours and longest wait; an unknown level counts as level 3.

    Five fixed rows, so an array literal replaces a join.
    """
    rows = F.array(*[
        F.struct(
            F.lit(code).alias("codigo"), F.lit(name).alias("nombre"),
            F.lit(colour).alias("color"), F.lit(back).alias("bg"),
            F.lit(minutes).alias("max_espera_min"),
        )
        for _, code, name, colour, back, minutes in LEVEL_DIMENSION
    ])
    known = F.when(level.between(1, 5), level).otherwise(DEFAULT_LEVEL).cast("int")
    return F.element_at(rows, known)


def anxiety_band(score: Column) -> Column:
    band = F.when(score.isNull(), ANXIETY_NO_BAND)
    for bound, name in ANXIETY_BANDS:
        band = band.when(score >= bound, name)
    return band.otherwise(ANXIETY_FLOOR_BAND)


def display_number(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def urgency_bar(value: Column) -> Column:
    return F.least(display_number(value), F.lit(100.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Exact decimal seconds, so rounding is half away from zero."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")


def rating(confidence: Column, predicted: Column, annotated: Column) -> Column:
    """Confidence less a quarter per level of disagreement, on a 0-10 scale."""
    reference = annotated_or_predicted(annotated, predicted)
    gap = F.abs(predicted - reference).cast("decimal(3,0)")
    kept = confidence.cast("decimal(20,15)") - gap * F.lit(RATING_PENALTY).cast("decimal(3,2)")
    floored = F.greatest(kept, F.lit(0).cast("decimal(20,15)"))
    return F.round(floored * F.lit(10).cast("decimal(2,0)"), 1).cast("double")


def annotated_or_predicted(annotated: Column, predicted: Column) -> Column:
    return F.coalesce(F.nullif(annotated, F.lit(0)), predicted)
