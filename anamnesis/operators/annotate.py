"""Texts to structured findings.

Two annotators share one output. ``rule_fields`` is the offline default: plain
column expressions, so it runs at scan speed inside the JVM. ``annotate`` calls
an injected client (for instance a model server) from the executors.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import chat_messages, request_envelope, strip
from ..schemas import FLAGS, REPLY_FIELDS
from . import lexicon as lex

RAW_REPLY = "guid string, raw string, annotate_error string"


def _any(text: Column, phrases: list[str]) -> Column:
    """Whether any phrase occurs; the search stops at the first that does."""
    test = F.contains(text, F.lit(phrases[0]))
    for phrase in phrases[1:]:
        test = test | F.contains(text, F.lit(phrase))
    return test


def _which(text: Column, phrases: list[str]) -> Column:
    """The first listed phrase that occurs, or null."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(phrase)), phrase) for phrase in phrases])


def _any_word(words: Column, listed: list[str]) -> Column:
    return _any(words, [f" {word} " for word in listed])


def _as_words(text: Column) -> Column:
    """Text in which every word has a blank on both sides."""
    blank = F.lit(" ")
    return F.concat(blank, F.translate(text, lex.MARKS, " " * len(lex.MARKS)), blank)


def _matched(text: Column, anchors: list[str], pattern: str, group: int = 0) -> Column:
    """A regex that only runs where one of its anchors occurs."""
    found = F.when(_any(text, anchors), F.regexp_extract(text, pattern, group))
    return F.nullif(found, F.lit(""))


def _without(text: Column, anchors: list[str], pattern: str) -> Column:
    return F.when(_any(text, anchors), F.regexp_replace(text, pattern, " ")).otherwise(text)


def _number_word(word: Column) -> Column:
    pairs = [F.lit(item) for pair in lex.NUMBER_WORDS.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), word)


def _number(text: Column, anchors: list[str], pattern: str, group: int = 1) -> Column:
    """The digits a regex finds as a number, null without; the regex is named, and so run, once."""
    return F.when(_any(text, anchors), F.regexp_extract(text, pattern, group)).try_cast("int")


def _word_number(text: Column, anchors: list[str], pattern: str, group: int = 1) -> Column:
    return _number_word(F.when(_any(text, anchors), F.regexp_extract(text, pattern, group)))


def _age(text: Column) -> Column:
    in_words = _word_number(text, ["años"], lex.AGE_WORDS) + F.coalesce(
        _word_number(text, ["años"], lex.AGE_WORDS, 2), F.lit(0)
    )
    return F.coalesce(
        _number(text, lex.YEAR_ANCHORS, lex.AGE_IN_YEARS),
        _number(text, lex.AGE_TOLD_ANCHORS, lex.AGE_TOLD),
        in_words,
    )


def _pain(text: Column) -> Column:
    return F.coalesce(
        _number(text, lex.TEN_ANCHORS, lex.PAIN_OF_TEN),
        _number(text, lex.PAIN_ANCHORS, lex.PAIN_DIGITS),
        _number_word(F.regexp_extract(text, lex.PAIN_WORDS, 1)),
    )


def _number_in(answer: Column) -> Column:
    """The number in the patient's answer to a question, in digits or words."""
    digits = F.regexp_extract(answer, lex.ANSWERED_NUMBER, 1).try_cast("int")
    tens, units = (F.regexp_extract(answer, lex.ANSWERED_WORDS, group) for group in (1, 2))
    return F.coalesce(digits, _number_word(tens) + F.coalesce(_number_word(units), F.lit(0)))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns by a one-row generator: what is referred to often would be inlined, and run, each time."""
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.drop(*columns).select("*", F.inline(F.array(row)))


def _level() -> Column:
    """Most urgent rule first, so the first hit is the answer. Feelings are not
    consulted: clinical signs alone set the level."""
    pain = F.col("dolor_intensidad")
    return (
        F.when(F.col("perdida_consciencia") | F.col("_vital"), 1)
        .when(F.col("_chest").isNotNull() & (F.col("disnea") | F.col("irradiacion")), 2)
        .when(F.col("_acute"), 2)
        .when((pain >= 7) | F.col("disnea") | F.col("_high_fever") | F.col("_trauma"), 3)
        .when(pain.between(1, 6) | F.col("fiebre") | F.col("_symptom"), 4)
        .otherwise(5)
    )


# Urgency per level, and what each sign adds within the level.
URGENCY_BASE = {1: 95.0, 2: 80.0, 3: 50.0, 4: 25.0, 5: 5.0}
URGENCY_PER_PAIN = 0.5
URGENCY_PER_FLAG = 2.0


def _urgency() -> Column:
    base = F.lit(None).cast("double")
    for level, value in URGENCY_BASE.items():
        base = F.when(F.col("nivel_triaje") == level, value).otherwise(base)
    signs = F.lit(0)
    for name in FLAGS:
        signs = signs + F.col(name).cast("int")
    extra = F.coalesce(F.col("dolor_intensidad"), F.lit(0)) * URGENCY_PER_PAIN + signs * URGENCY_PER_FLAG
    return F.least(base + extra, F.lit(100.0))


def rule_fields(df: DataFrame, text: str, dialogue: str | None = None) -> DataFrame:
    """Adds the reply fields, taken from the whole text by rules; a null text
    has neither level nor urgency. With ``dialogue``, the column with both
    speakers' lines, age and pain are also read from answers to the doctor's
    questions, where the patient's words alone do not tell.

    ``_raw`` is the text in lower case, ``_said`` the same without denials and
    relatives, ``_words`` that with blanks around words. Each finding is kept
    as the phrase that gave it away, which later becomes the entity.
    """
    raw, said, words = F.col("_raw"), F.col("_said"), F.col("_words")
    plain = F.regexp_replace(_without(raw, lex.RELATIVES, lex.RELATIVE), lex.DENIED, " ")
    pain = F.col("_pain")
    findings = {
        "_dyspnea": F.coalesce(_which(raw, lex.DYSPNEA_IDIOMS), _which(said, lex.DYSPNEA_NOUNS)),
        "_fever": F.coalesce(_which(said, lex.FEVER), _matched(said, lex.DEGREE_ANCHORS, lex.FEVER_DEGREES)),
        "_unconscious": _which(said, lex.UNCONSCIOUS),
        "_radiating": _which(said, lex.RADIATING),
        "_cardiac": _which(said, lex.CARDIAC_HISTORY),
        "_chest": F.coalesce(_which(said, lex.CHEST_PAIN), _matched(said, ["dolor"], lex.CHEST_PAIN_APART)),
        "_tachycardia": _which(said, lex.TACHYCARDIA),
    }
    raw_words = F.col("_raw_words")
    asked_age = asked_pain = F.lit(None).cast("int")
    if dialogue is not None:
        lines = F.col("_lines")
        df = _once(df, _lines=F.lower(F.col(dialogue)))
        df = _once(df, _age_answer=F.when(_any(lines, lex.AGE_ASKED_ANCHORS), F.regexp_extract(lines, lex.AGE_ASKED, 1)),
                   _pain_answer=F.when(_any(lines, lex.PAIN_ASKED_ANCHORS), F.regexp_extract(lines, lex.PAIN_ASKED, 1)))
        df = _once(df, _asked_age=_number_in(F.col("_age_answer")), _asked_pain=_number_in(F.col("_pain_answer")))
        asked_age, asked_pain = F.col("_asked_age"), F.col("_asked_pain")
    scalars = {
        "edad": F.coalesce(_age(F.col("_years")), F.when(asked_age.between(0, 120), asked_age)),
        "sexo": F.when(_any_word(raw_words, lex.FEMALE_WORDS), "F").when(_any_word(raw_words, lex.MALE_WORDS), "M"),
        "dolor_intensidad": F.coalesce(F.when(pain.between(0, 10), pain), F.when(asked_pain.between(0, 10), asked_pain)),
        "fumador": _any_word(words, lex.SMOKER_WORDS),
        "_vital": _any(raw, lex.VITAL_THREAT),
        "_acute": _any(said, lex.ACUTE)
        | _matched(said, lex.SATURATION_ANCHORS, lex.LOW_SATURATION).isNotNull(),
        "_high_fever": _matched(said, lex.DEGREE_ANCHORS, lex.HIGH_FEVER_DEGREES).isNotNull(),
        "_trauma": _any_word(words, lex.TRAUMA_WORDS),
        "_symptom": _any_word(words, lex.SYMPTOM_WORDS),
        "score_ansiedad": F.when(_any(raw, lex.PANIC), 0.95).when(_any(raw, lex.ANXIOUS), 0.75)
        .when(_any(raw, lex.WORRIED), 0.5).otherwise(0.2),
    }
    flags = {
        "disnea": "_dyspnea", "fiebre": "_fever", "perdida_consciencia": "_unconscious",
        "irradiacion": "_radiating", "antecedentes_cardiacos": "_cardiac",
    }
    lowered = _once(df, _raw=F.lower(F.col(text)))
    lowered = _once(lowered, _said=plain, _years=_without(raw, lex.YEAR_ANCHORS, lex.NOT_AN_AGE), _pain=_pain(raw))
    leveled = (
        _once(_once(lowered, _words=_as_words(said), _raw_words=_as_words(raw)), **findings, **scalars)
        .withColumns({name: F.col(source).isNotNull() for name, source in flags.items()})
        .withColumn("nivel_triaje", F.when(raw.isNotNull(), _level()))
        .withColumn("score_urgencia", F.when(raw.isNotNull(), _urgency()))
    )
    terms = F.filter(
        F.array(*[
            F.struct(F.col(column).alias("raw"), F.lit(norm).alias("norm"))
            for column, norm in lex.ENTITY_TERMS.items()
        ]),
        lambda term: term["raw"].isNotNull(),
    )
    found = F.array_join(F.col("entidades_normalizadas"), ", ")
    return (
        leveled.withColumn("_terms", terms)
        .withColumns({
            "entidades": F.col("_terms.raw"),
            "entidades_normalizadas": F.col("_terms.norm"),
            "motivo_consulta": strip(F.regexp_extract(text, r"^[^.!?\n]*", 0)),
        })
        .withColumn("justificacion", F.concat(
            F.lit("C"), F.col("nivel_triaje").cast("string"),
            F.when(F.length(found) > 0, F.concat(F.lit(": "), found)).otherwise(": sin signos de alarma"),
        ))
        .withColumns({"urgencia_ausente": F.lit(False), "reply_error": F.lit(None).cast("string")})
        .drop("_raw", "_said", "_years", "_pain", "_words", "_raw_words", "_terms", "_lines", "_age_answer", "_pain_answer", "_vital", "_acute", "_high_fever",
              "_trauma", "_symptom", "_asked_age", "_asked_pain", *findings)
    )


def reply_json(columns: list[str] = REPLY_FIELDS) -> Column:
    """Reply fields as the JSON an annotator returns, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def rule_replies(df: DataFrame, text: str, dialogue: str | None = None) -> DataFrame:
    """The rule annotator in the shape of an injected one: guid and raw reply."""
    columns = [text] if dialogue is None else [text, dialogue]
    return rule_fields(df.select("guid", *columns), text, dialogue).select(
        "guid", reply_json().alias("raw"), F.lit(None).cast("string").alias("annotate_error")
    )


Client = Callable[[list[str]], list[str]]


@dataclass(frozen=True)
class Pace:
    """How calls are made, per task: texts in a call (None: a whole batch), texts a second
    at most, and how a busy service is waited for: ``attempts`` in all, the first
    wait, doubled from then on up to the longest. Busy is an error that says so in
    one of the words."""

    texts_per_call: int | None = None
    per_second: float | None = None
    attempts: int = 6
    first_wait: float = 1.0
    longest_wait: float = 60.0
    busy_words: tuple[str, ...] = ("429", "too many", "rate limit", "overloaded")


def request_text(text: Column, template: str | None = None, examples: Sequence[tuple[str, str]] = (), model: str = "") -> Column:
    """What a client is sent: the bare text or, with a template, the whole request."""
    return text if template is None else request_envelope(model, chat_messages(template, examples, text))


def annotate(
    df: DataFrame, text: str, connect: Callable[[], Client], partitions: int | None = None,
    template: str | None = None, examples: Sequence[tuple[str, str]] = (), model: str = "", pace: Pace = Pace(),
) -> DataFrame:
    """Raw replies of an injected client.

    ``connect`` runs once per partition and returns a function from texts to
    replies. A call that fails because the service is busy is made again after a
    wait, as ``pace`` says. A call that fails otherwise is repeated row by row; a row
    that still fails comes back with its error, so one bad text never stops the job.
    Calls cost far more than moving texts, so rows are dealt by the hash of their
    guid into ``partitions``, by default as many as the session runs at once; a task
    that is run again gets the same rows. Write the result out before using it
    twice: calls are costly and may differ.

    With a ``template`` the client gets whole requests instead of bare texts:
    JSON with the model's name, the worked ``examples`` as earlier turns, and the
    text in the template's place.
    """
    source = df.select("guid", request_text(F.col(text), template, examples, model).alias("text"))
    source = source.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism, "guid")
    # Functions and plain values travel to the executors by value, so this package
    # need not be installed there.
    size, per_second, attempts = pace.texts_per_call, pace.per_second, pace.attempts
    first_wait, longest_wait, busy_words = pace.first_wait, pace.longest_wait, pace.busy_words

    def paced(client):
        import time

        free = 0.0

        def call(texts):
            nonlocal free
            wait = first_wait
            for attempt in range(1, attempts + 1):
                if per_second:
                    now = time.monotonic()
                    if free > now:
                        time.sleep(free - now)
                    free = max(now, free) + len(texts) / per_second
                try:
                    replies = client(texts)
                    if len(replies) != len(texts):
                        raise ValueError("one reply per text expected")
                    return replies
                except Exception as error:
                    said = f"{type(error).__name__} {error}".lower()
                    if attempt == attempts or not any(word in said for word in busy_words):
                        raise
                    time.sleep(wait)
                    wait = min(2 * wait, longest_wait)

        return call

    def outcomes(call, texts):
        try:
            return [(reply, None) for reply in call(texts)]
        except Exception as error:  # noqa: BLE001 - a failed row is data, not a failed job
            said = f"{type(error).__name__}: {error}"
            if len(texts) == 1 or any(word in said.lower() for word in busy_words):
                return [(None, said)] * len(texts)
            return [outcomes(call, [text])[0] for text in texts]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = paced(connect())
        for batch in batches:
            texts = batch["text"].tolist()
            step = size or len(texts) or 1
            outcome = [one for at in range(0, len(texts), step) for one in outcomes(call, texts[at:at + step])]
            yield pd.DataFrame({
                "guid": batch["guid"],
                "raw": pd.Series([raw for raw, _ in outcome], index=batch.index, dtype=object),
                "annotate_error": pd.Series([err for _, err in outcome], index=batch.index, dtype=object),
            })

    return source.mapInPandas(run, RAW_REPLY)
