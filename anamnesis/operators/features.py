"""Feature table: encoding for the dataset, for training and for evaluation."""

from pyspark.sql import DataFrame, functions as F

from ..functions.encoding import (
    encode_anxiety, encode_flag, encode_optional_int, encode_sex,
    encode_specialty, keep_sex_code,
)
from ..schemas import ENRICHED, FEATURES, FLAGS, ORIGIN_ON_DEMAND, SPECIALTY_CODES, TARGET, UNKNOWN

DATASET_COLUMNS = [
    "guid", "especialidad", "origen", "edad", "sexo", "dolor_intensidad",
    *FLAGS, "score_urgencia", "score_ansiedad", TARGET,
]


def dataset_rows(cases: DataFrame, results: DataFrame, exclude_simulated: bool = False) -> DataFrame:
    """Enriched cases with their extracted fields, not yet encoded."""
    chosen = cases.where(F.col("estado") == ENRICHED)
    if exclude_simulated:
        chosen = chosen.where(~F.col("origen").eqNullSafe(ORIGIN_ON_DEMAND))
    fields = [name for name in DATASET_COLUMNS if name not in ("especialidad", "origen")]
    return chosen.select("guid", "especialidad", "origen").join(
        results.select(*fields), "guid"
    ).select(*DATASET_COLUMNS)


def _anxiety(df: DataFrame):
    if "score_ansiedad" not in df.columns:
        return F.lit(0.0)
    return encode_anxiety(F.col("score_ansiedad"))


def encode_raw(df: DataFrame) -> DataFrame:
    """Raw extracted fields to numbers, as the stored dataset holds them."""
    changed = {
        **{name: encode_flag(F.col(name)) for name in FLAGS},
        "edad": encode_optional_int(F.col("edad")),
        "sexo": encode_sex(F.col("sexo")),
        "dolor_intensidad": encode_optional_int(F.col("dolor_intensidad")),
        "score_ansiedad": _anxiety(df),
    }
    if "especialidad" in df.columns:
        changed["especialidad"] = encode_specialty(F.col("especialidad"))
    return df.withColumns(changed)


def keep_labelled(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[TARGET, "score_urgencia"])


def training_rows_from_raw(df: DataFrame) -> DataFrame:
    encoded = encode_raw(df)
    if "especialidad" not in df.columns:
        encoded = encoded.withColumn("especialidad", F.lit(SPECIALTY_CODES["UNK"]))
    return keep_labelled(encoded).fillna(UNKNOWN, FEATURES)


def training_rows_from_encoded(df: DataFrame) -> DataFrame:
    """For a dataset read back from CSV: only gaps are filled."""
    specialty = F.lit(SPECIALTY_CODES["UNK"])
    if "especialidad" in df.columns:
        specialty = F.coalesce(F.col("especialidad"), specialty)
    filled = df.withColumns({
        **{name: F.coalesce(F.col(name).cast("int"), F.lit(0)) for name in FLAGS},
        "edad": encode_optional_int(F.col("edad")),
        "sexo": keep_sex_code(F.col("sexo")),
        "dolor_intensidad": encode_optional_int(F.col("dolor_intensidad")),
        "score_ansiedad": _anxiety(df),
        "especialidad": specialty.cast("int"),
    })
    return keep_labelled(filled).fillna(UNKNOWN, FEATURES)


def evaluation_rows(df: DataFrame) -> DataFrame:
    """The evaluation job's own fill of the stored dataset."""
    fills = {**dict.fromkeys(FLAGS, 0), **dict.fromkeys(["edad", "dolor_intensidad", "sexo"], UNKNOWN),
             "score_ansiedad": 0.0}
    return keep_labelled(df.fillna(fills))


def model_input(df: DataFrame) -> DataFrame:
    return df.select("guid", *FEATURES)
