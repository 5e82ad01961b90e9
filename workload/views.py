"""The given tables seen as interviews, cases, results and predictions.

Each view exists twice: in Spark, for the queries, and in plain SQL, for the
checks. All of them cover whole tables and whole texts.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from anamnesis.session import configure

_STATE = """CASE event_type WHEN 'signup' THEN 'INGESTED' WHEN 'view' THEN 'ENRICHED'
    WHEN 'click' THEN 'DATASET_READY' WHEN 'purchase' THEN 'COMPLETADA'
    ELSE 'ERROR_ENRICHMENT' END"""

_PHASES = [
    ("preprocesamiento", "'signup', 'view'"),
    ("extraccion_entidades", "'view', 'click'"),
    ("normalizacion", "'view', 'click'"),
    ("entrenamiento", "'click', 'purchase'"),
]
_PHASE_TIMES = ",\n".join(
    f"min(ts) FILTER (WHERE event_type IN ({kinds})) AS inicio_{phase}, "
    f"max(ts) FILTER (WHERE event_type IN ({kinds})) AS fin_{phase}"
    for phase, kinds in _PHASES
)
_CASE_NAMES = """
  CASE WHEN min(user_id) % 11 = 0 THEN NULL ELSE concat('CAS', guid, '.txt') END AS nombre_fichero,
  CASE WHEN min(user_id) % 7 = 0 THEN 'simulacion' ELSE 'dataset' END AS origen"""

_SPECIALTY = """CASE doc_id % 8 WHEN 0 THEN 'CAR' WHEN 1 THEN 'der ' WHEN 2 THEN 'GAS'
    WHEN 3 THEN 'GEN' WHEN 4 THEN 'MSK' WHEN 5 THEN 'RES' WHEN 6 THEN 'XYZ' END"""

_FILE_NAME = """concat(CASE doc_id % 8 WHEN 0 THEN 'CAR' WHEN 1 THEN 'der' WHEN 2 THEN 'GAS'
    WHEN 3 THEN '1GEN' WHEN 4 THEN 'MSK' WHEN 5 THEN 'r_es' WHEN 6 THEN 'caso_suave_' ELSE '99' END,
    CAST(doc_id AS {text}), '.txt')"""

_RESULTS = f"""
SELECT concat('doc-', CAST(d.doc_id AS {{text}})) AS guid, d.doc_id, d.lang, d.source, d.n_chars,
  {_SPECIALTY.replace('doc_id', 'd.doc_id')} AS especialidad,
  CASE WHEN d.n_chars % 9 = 0 THEN NULL ELSE CAST(d.n_chars % 95 AS INT) END AS edad,
  CASE d.doc_id % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 3 THEN 'm' WHEN 4 THEN 'F' END AS sexo,
  CASE WHEN d.n_chars % 3 = 0 THEN NULL ELSE CAST(d.n_chars % 11 AS INT) END AS dolor_intensidad,
  CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE d.lang = 'en' END AS disnea,
  d.n_chars % 5 = 0 AS fiebre, l.toxic = 1 AS perdida_consciencia,
  d.n_chars % 7 = 0 AS irradiacion, d.lang = 'es' AS antecedentes_cardiacos,
  d.doc_id % 3 = 0 AS fumador,
  CASE WHEN d.doc_id % 4 = 0 THEN NULL WHEN d.doc_id % 4 = 1 THEN ''
    ELSE concat('motivo ', d.source) END AS motivo_consulta,
  concat('nota ', d.lang) AS justificacion,
  CASE WHEN d.doc_id % 29 = 0 THEN NULL ELSE CAST((d.n_chars % 1001) AS DOUBLE) / 10 END AS score_urgencia,
  CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE CAST((d.doc_id * 37 % 101) AS DOUBLE) / 100 END AS score_ansiedad,
  CASE WHEN l.toxic = 1 AND l.quality = 0 THEN 1 WHEN l.toxic = 1 THEN 2 WHEN l.quality = 0 THEN 4
    WHEN d.n_chars % 8 = 0 THEN 5 ELSE 3 END AS nivel_triaje
FROM {{documents}} d JOIN {{labels}} l ON d.doc_id = l.doc_id"""

# What is told in an interview: the same for every document, labelled or not.
_INTERVIEWS = _RESULTS.replace(
    "l.toxic = 1 AS perdida_consciencia", "coalesce(l.toxic = 1, false) AS perdida_consciencia"
).replace("}} d JOIN", "}} d LEFT JOIN").replace("} d JOIN", "} d LEFT JOIN")

_PREDICTIONS = """
SELECT r.*, CASE WHEN doc_id % 19 = 0 THEN NULL ELSE least(5, greatest(1, nivel_triaje +
    CASE WHEN doc_id % 7 = 0 THEN 1 WHEN doc_id % 13 = 0 THEN -1 ELSE 0 END)) END AS prediccion_modelo,
  CAST(40 + doc_id % 60 AS DOUBLE) / 100 AS confianza
FROM {results} r"""

_DOC_CASES = f"""
SELECT concat('doc-', CAST(doc_id AS {{text}})) AS guid,
  CASE WHEN doc_id % 10 = 0 THEN NULL ELSE {_FILE_NAME} END AS nombre_fichero,
  {_SPECIALTY} AS especialidad,
  CASE WHEN doc_id % 9 = 0 THEN 'simulacion' WHEN doc_id % 9 = 1 THEN NULL ELSE 'dataset' END AS origen,
  CASE doc_id % 4 WHEN 0 THEN 'INGESTED' WHEN 3 THEN 'COMPLETADA' ELSE 'ENRICHED' END AS estado
FROM {{documents}}"""

_PLANTED_LINES = [
    ("edad IS NOT NULL", "concat('P: I am ', CAST(edad AS {text}), ' years old.')"),
    ("sexo = 'M'", "'P: I am a man.'"),
    ("sexo = 'F'", "'P: I am a woman.'"),
    ("dolor_intensidad IS NOT NULL",
     "concat('P: The pain is ', CAST(dolor_intensidad AS {text}), ' out of 10.')"),
    ("disnea", "'P: I have shortness of breath.'"),
    ("NOT disnea", "'P: I have no shortness of breath.'"),
    ("fiebre", "'P: Tengo fiebre.'"),
    ("NOT fiebre", "'P: Estoy sin fiebre.'"),
    ("perdida_consciencia", "'P: I passed out.'"),
    ("irradiacion", "'P: I have chest pain that goes to my jaw.'"),
    ("antecedentes_cardiacos", "'P: Tuve un infarto.'"),
    ("NOT antecedentes_cardiacos", "'P: Mi madre tuvo un infarto.'"),
    ("fumador", "'P: I smoke.'"),
    ("NOT fumador", "'P: I don''t smoke.'"),
]
_PLANTED = "concat(" + ", ".join(
    f"CASE WHEN {test} THEN concat({{newline}}, {line}) ELSE '' END" for test, line in _PLANTED_LINES
) + ")"

# Lines are tagged in turn as doctor, patient and continuation; commas bring
# odd white space, and turns lie four line ends apart.
_SPARK_TEXT = r"""array_join(transform(
    split(replace(replace(text, '. ', '.\n'), ', ', ',\t  '), '\n'),
    (l, i) -> concat(CASE i % 3 WHEN 0 THEN 'D: ' WHEN 1 THEN ' P:  ' ELSE '' END, l)), '\n\n\n\n')"""
_CHECK_TEXT = """array_to_string(list_transform(
    string_split(replace(replace(text, '. ', '.' || chr(10)), ', ', ',' || chr(9) || chr(160) || ' '), chr(10)),
    lambda l, i: concat(CASE (i - 1) % 3 WHEN 0 THEN 'D: ' WHEN 1 THEN ' P:  ' ELSE '' END, l)),
    chr(10) || chr(10) || chr(10) || chr(10))"""


class Tables:
    """Spark side. Views are lazy; a query pays for what it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def sql(self, text: str, **frames) -> DataFrame:
        return self.spark.sql(text, **frames)

    documents = property(lambda self: self.table("documents"))
    labels = property(lambda self: self.table("labels"))
    events = property(lambda self: self.table("events"))
    conversations = property(lambda self: self.table("conversations"))
    benchmark = property(lambda self: self.table("benchmark"))

    @cached_property
    def state_log(self) -> DataFrame:
        return self.events_as_log(self.events)

    def events_as_log(self, events: DataFrame) -> DataFrame:
        return events.selectExpr(
            "concat(CAST(user_id AS STRING), '-', date_format(ts, 'yyyyMMdd')) AS guid",
            f"{_STATE} AS estado", "CAST(ts AS TIMESTAMP) AS ts", "event_id AS seq",
            "event_type", "user_id",
        )

    @cached_property
    def cases(self) -> DataFrame:
        return self.sql(f"""
            SELECT guid, max_by(estado, struct(ts, seq)) AS estado,
              min(ts) AS inicio_solicitud, max(ts) AS fin_solicitud, {_PHASE_TIMES}, {_CASE_NAMES}
            FROM {{log}} GROUP BY guid""", log=self.state_log)

    @cached_property
    def results(self) -> DataFrame:
        return self.sql(
            _RESULTS.replace("{text}", "STRING"), documents=self.documents, labels=self.labels
        )

    @cached_property
    def interviews(self) -> DataFrame:
        return self.sql(
            _INTERVIEWS.replace("{text}", "STRING"), documents=self.documents, labels=self.labels
        )

    @cached_property
    def predictions(self) -> DataFrame:
        return self.sql(_PREDICTIONS, results=self.results)

    @cached_property
    def doc_cases(self) -> DataFrame:
        return self.sql(_DOC_CASES.replace("{text}", "STRING"), documents=self.documents)

    @cached_property
    def transcripts(self) -> DataFrame:
        """One row per document: name, and the whole text as a dialogue."""
        return self.documents.selectExpr(
            "doc_id", "concat('doc-', CAST(doc_id AS STRING)) AS guid",
            f"{_FILE_NAME.replace('{text}', 'STRING')} AS nombre_fichero", f"{_SPARK_TEXT} AS texto",
        )

    @cached_property
    def planted(self) -> DataFrame:
        """All transcripts with the fields of an interview told in the patient's words."""
        lines = _PLANTED.replace("{newline}", r"'\n'").replace("{text}", "STRING").replace("don''t", r"don\'t")
        told = self.interviews.selectExpr("guid", "doc_id", f"{lines} AS lines")
        texts = self.transcripts.select("doc_id", "nombre_fichero", "texto")
        return told.join(texts, "doc_id").selectExpr(
            "guid", "doc_id", "nombre_fichero", "concat(texto, lines) AS texto"
        )

    @cached_property
    def turns(self) -> DataFrame:
        return self.conversations.selectExpr(
            "conv_id", "turn", "concat(CASE role WHEN 'user' THEN 'P: ' WHEN 'assistant' THEN 'D: ' "
            "ELSE '' END, text) AS line",
        )


# The characters that count as white space, in the checker's
# own notation.
CHECK_SPACES = (
    r"\t\v\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
CHECK_SPACE_LIST = " || ".join(
    f"chr({code})" for code in
    [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)

CHECK_VIEWS = {
    "state_log": f"""SELECT concat(CAST(user_id AS VARCHAR), '-', strftime(ts, '%Y%m%d')) AS guid,
        {_STATE} AS estado, ts, event_id AS seq, event_type, user_id FROM events""",
    "cases": f"""SELECT guid, arg_max(estado, row(ts, seq)) AS estado, min(ts) AS inicio_solicitud,
        max(ts) AS fin_solicitud, {_PHASE_TIMES}, {_CASE_NAMES} FROM state_log GROUP BY guid""",
    "results": _RESULTS.replace("{text}", "VARCHAR").format(documents="documents", labels="labels"),
    "interviews": _INTERVIEWS.replace("{text}", "VARCHAR").format(documents="documents", labels="labels"),
    "predictions": _PREDICTIONS.format(results="results"),
    "doc_cases": _DOC_CASES.replace("{text}", "VARCHAR").format(documents="documents"),
    "transcripts": f"""SELECT doc_id, concat('doc-', CAST(doc_id AS VARCHAR)) AS guid,
        {_FILE_NAME.replace('{text}', 'VARCHAR')} AS nombre_fichero, {_CHECK_TEXT} AS texto FROM documents""",
    "clean": f"""SELECT doc_id, guid, nombre_fichero, trim(regexp_replace(regexp_replace(texto,
        '[{CHECK_SPACES}]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), {CHECK_SPACE_LIST}) AS texto
        FROM transcripts""",
    "patient": """SELECT doc_id, guid, nombre_fichero, texto AS full_text, array_to_string(list_transform(
        list_filter(string_split(texto, chr(10)), lambda l: starts_with(trim(l), 'P:')),
        lambda l: trim(substr(trim(l), 3))), ' ') AS texto FROM clean""",
    "turns": """SELECT conv_id, turn, concat(CASE role WHEN 'user' THEN 'P: ' WHEN 'assistant' THEN 'D: '
        ELSE '' END, text) AS line FROM conversations""",
}


def with_views(body: str) -> str:
    """The check as one statement: the views it uses, then its body."""
    needed, text = set(), body
    while True:
        found = {name for name in CHECK_VIEWS if name not in needed and name in text}
        if not found:
            break
        needed |= found
        text += " ".join(CHECK_VIEWS[name] for name in found)
    parts = [f"{name} AS ({sql})" for name, sql in CHECK_VIEWS.items() if name in needed]
    body = body.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body
