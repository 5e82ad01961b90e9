"""Text cleaning, dialogue turns, names and keys."""

from pyspark.sql import Column, functions as F

from ..schemas import SPECIALTY_CODES, STAMP

# Every character that counts as white space, apart from the
# newline, and the characters that end a line. Java's \s is ASCII only, so the
# class is spelled out.
SPACES = (
    "\t\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
PATIENT_TAG = "P:"
PLACEHOLDER = "{transcripcion}"

_ODD_SPACES = SPACES.replace(" ", "")
_PATIENT_LINE = f"(?:^|\\n)[{SPACES}]*{PATIENT_TAG}[{SPACES}]*((?:[^\\n]*[^\\n{SPACES}])?)"


def strip(text: Column) -> Column:
    """Remove white space of any script from both ends."""
    return F.btrim(text, F.lit(SPACES + "\n"))


def unix_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def clean_text(text: Column) -> Column:
    """One blank per run of white space, at most one empty line, no outer space.

    Odd spaces become blanks first: a regex class of them all is several times
    slower than the plain mapping followed by a regex on blanks.
    """
    blanks = F.translate(text, _ODD_SPACES, " " * len(_ODD_SPACES))
    collapsed = F.regexp_replace(blanks, "  +", " ")
    return strip(F.regexp_replace(collapsed, "\n{3,}", "\n\n"))


def patient_turns(text: Column, cleaned: bool = True) -> Column:
    """The stripped contents of the patient's lines, as an array.

    Only lines that begin with the exact tag count; continuation lines do not.
    Cleaned text has no line end but the newline, raw text may.
    """
    if not cleaned:
        text = F.translate(text, LINE_ENDS, "\n" * len(LINE_ENDS))
    return F.regexp_extract_all(text, F.lit(_PATIENT_LINE), F.lit(1))


def patient_text(text: Column, cleaned: bool = True) -> Column:
    return F.array_join(patient_turns(text, cleaned), " ")


def text_to_annotate(patient: Column, full: Column) -> Column:
    """The patient's words, or the whole text when the patient has none."""
    return F.when(F.length(patient) > 0, patient).otherwise(full)


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1")


def specialty_at_ingest(name: Column) -> Column:
    """First three letters found anywhere in the stem."""
    letters = F.regexp_replace(file_stem(name), r"[^\p{L}]", "")
    return F.substring(F.upper(letters), 1, 3)


def specialty_at_scoring(name: Column) -> Column:
    """Letters among the first three characters, if they form a known code."""
    head = F.substring(F.coalesce(name, F.lit("")), 1, 3)
    code = F.upper(F.regexp_replace(head, r"[^\p{L}]", ""))
    return F.when(code.isin(*SPECIALTY_CODES), code).otherwise("UNK")


def specialty_in_job(given: Column, name: Column) -> Column:
    """The given code, else the first three characters, unchecked."""
    return F.coalesce(given, F.upper(F.substring(name, 1, 3)))


def object_key(folder: Column, name: Column) -> Column:
    return F.concat_ws("/", folder, name)


def object_url(base: str, bucket: str, key: Column) -> Column:
    return F.concat_ws("/", F.lit(base.rstrip("/")), F.lit(bucket), key)


def stable_guid(name: Column, content: Column) -> Column:
    """An id that is the same each time a job is run again on the same file."""
    return F.sha2(F.concat(name, F.lit("\n"), content), 256)


def version_stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


def demo_label(name: Column) -> Column:
    """Menu label of a sample file: no extension, blanks for underscores."""
    return F.replace(F.replace(name, F.lit(".txt"), F.lit("")), F.lit("_"), F.lit(" "))


def join_segments(segments: Column) -> Column:
    """Ordered speech segments to one text."""
    return F.array_join(F.transform(segments, strip), " ")


def fill_template(template: Column, text: Column) -> Column:
    return F.replace(template, F.lit(PLACEHOLDER), text)


def chat_messages(template: str, examples: list[tuple[str, str]], text: Column) -> Column:
    """The worked examples as user and assistant turns, then the text in hand."""
    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    turns = []
    for sample, answer in examples:
        turns.append(message("user", F.lit(template.replace(PLACEHOLDER, sample))))
        turns.append(message("assistant", F.lit(answer)))
    turns.append(message("user", fill_template(F.lit(template), text)))
    return F.array(*turns)


def request_envelope(model: str, messages: Column) -> Column:
    """A deterministic chat request as JSON."""
    return F.to_json(F.struct(
        F.lit(model).alias("model"),
        messages.alias("messages"),
        F.lit(0).alias("temperature"),
        F.struct(F.lit("json_object").alias("type")).alias("response_format"),
    ))
