"""Column sets, schemas and fixed values shared by every job.

The literals in this module are fixed values: they are part of the data
contract (field names, codes, thresholds) and must not drift.
"""

from pyspark.sql import types as T

# -- fixed values: model columns ---------------------------------------------
FEATURES = [
    "edad", "sexo", "dolor_intensidad", "disnea", "fiebre",
    "perdida_consciencia", "irradiacion", "antecedentes_cardiacos",
    "fumador", "score_urgencia", "score_ansiedad",
]
FLAGS = [
    "disnea", "fiebre", "perdida_consciencia",
    "irradiacion", "antecedentes_cardiacos", "fumador",
]
TARGET = "nivel_triaje"
LEVELS = [1, 2, 3, 4, 5]
UNKNOWN = -1
SPECIALTY_CODES = {"CAR": 0, "DER": 1, "GAS": 2, "GEN": 3, "MSK": 4, "RES": 5, "UNK": 6}

# -- fixed values: case states -----------------------------------------------
INGESTED = "INGESTED"
PREPROCESSING = "PREPROCESSING"
PREPROCESSED = "PREPROCESSED"
ENRICHING = "ENRICHING"
ENRICHED = "ENRICHED"
DATASET_READY = "DATASET_READY"
MODEL_TRAINED = "MODEL_TRAINED"
EVALUATED = "EVALUATED"
COMPLETED = "COMPLETADA"
ERROR_ENRICHMENT = "ERROR_ENRICHMENT"
ORIGIN_DATASET = "dataset"
ORIGIN_ON_DEMAND = "simulacion"

# -- fixed values: phases of a case, each with a start and an end time --------
PHASES = [
    "solicitud", "preprocesamiento", "extraccion_entidades", "normalizacion",
    "etiquetado", "score", "entrenamiento",
]
PHASE_TIMES = [f"{edge}_{phase}" for phase in PHASES for edge in ("inicio", "fin")]

# -- fixed values: level dimension (level, code, name, colour, background, minutes)
LEVEL_DIMENSION = [
    (1, "C1", "Inmediato", "#c62828", "#1a0a0a", 0),
    (2, "C2", "Muy Urgente", "#e65100", "#1a0e00", 10),
    (3, "C3", "Urgente", "#f9a825", "#1a1600", 60),
    (4, "C4", "Menos Urgente", "#2e7d32", "#0a1a0a", 120),
    (5, "C5", "No Urgente", "#1565c0", "#0a0f1a", 240),
]
DEFAULT_LEVEL = 3

# -- fixed values: anxiety bands, lower bounds in falling order ----------------
ANXIETY_BANDS = [(0.86, "panic"), (0.7, "high"), (0.4, "moderate")]
ANXIETY_FLOOR_BAND = "calm"
ANXIETY_NO_BAND = "none"
AUDIT_ANXIETY = 0.7
AUDIT_VERDICT = "❌ Under-triage"
AUDIT_CAUSE = "El modelo RF priorizó ansiedad sobre clínica"

# -- fixed values: scoring and training parameters -----------------------------
DEFAULT_URGENCY = 50.0
RATING_PENALTY = 0.25
TREES = 200
SEED = 42
FOLDS = 5
TEST_FRACTION = 0.2
LATENCY_CUTOFF_S = 120
LATENCY_ROWS = 50
BATCH_WINDOW = "interval 3 hours"

# -- fixed values: artifact names ----------------------------------------------
STAMP = "yyyyMMdd_HHmmss"
DATASET_PREFIX = "dataset_entrenamiento_"
MODEL_PREFIX = "modelo_"
EVALUATION_PREFIX = "evaluacion_"

REPLY = T.StructType([
    T.StructField("nivel_triaje", T.IntegerType()),
    T.StructField("score_urgencia", T.DoubleType()),
    T.StructField("score_ansiedad", T.DoubleType()),
    T.StructField("motivo_consulta", T.StringType()),
    T.StructField("entidades", T.ArrayType(T.StringType())),
    T.StructField("entidades_normalizadas", T.ArrayType(T.StringType())),
    T.StructField("edad", T.IntegerType()),
    T.StructField("sexo", T.StringType()),
    T.StructField("dolor_intensidad", T.IntegerType()),
    *[T.StructField(name, T.BooleanType()) for name in FLAGS],
    T.StructField("justificacion", T.StringType()),
])
REPLY_FIELDS = REPLY.fieldNames()

DATASET = T.StructType([
    T.StructField("guid", T.StringType()),
    T.StructField("especialidad", T.IntegerType()),
    T.StructField("origen", T.StringType()),
    T.StructField("edad", T.IntegerType()),
    T.StructField("sexo", T.IntegerType()),
    T.StructField("dolor_intensidad", T.IntegerType()),
    *[T.StructField(name, T.IntegerType()) for name in FLAGS],
    T.StructField("score_urgencia", T.DoubleType()),
    T.StructField("score_ansiedad", T.DoubleType()),
    T.StructField("nivel_triaje", T.IntegerType()),
])

CLASS_SCORES = T.StructType([
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1-score", T.DoubleType()),
    T.StructField("support", T.LongType()),
])
EVALUATION = T.StructType([
    T.StructField("modelo", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("cv_f1_macro", T.DoubleType()),
    T.StructField("cv_f1_std", T.DoubleType()),
    T.StructField("classification_report", T.StructType([
        *[T.StructField(f"C{n}", CLASS_SCORES) for n in LEVELS],
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("macro avg", CLASS_SCORES),
        T.StructField("weighted avg", CLASS_SCORES),
    ])),
    T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("under_triage_count", T.LongType()),
    T.StructField("feature_importances", T.MapType(T.StringType(), T.DoubleType())),
])
