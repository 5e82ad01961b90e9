"""Secret scans: strong patterns, and weak candidates that other parts of a credential bear out."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import computed, materialize, unreserved

#: The strong kinds in the order in which spans of one start are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
SHORTEST_VALUE, SHORTEST_ACCESS = 8, 16

#: Weak kinds, each one part of a credential; alone they are ordinary text. An access key that is
#: an identifier (AKIA) is no secret part, or it would bear itself out.
IDENTIFIER = r"""(?i:access_?key_?id|key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
SECRET = r"""(?i:passphrase|credential|pwd|private_?key|auth_?key|secret_?(?:access_?)?key|access_?key(?!["']?\x20*[:=]\x20*["']?(?-i:AKIA[A-Z0-9]{12})))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{4,}|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"""
LONG_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{40}"
ENDPOINT = r"""(?i:https?|jdbc:[a-z]{1,20}|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[^\x00-\x20"'<>]+|(?i:endpoint|hostname)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:/-]{4,}|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])"""

ADDRESS = r"[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\."

#: What a text must hold, in small letters, for a pattern to be tried on it at
#: all; and the patterns of parts that have no such words.
HINTS = {
    "assign": ["passw", "secret", "token", "api_key", "apikey"],
    "access": ["akia"],
    "identifier": ["key_id", "keyid", "client_id", "clientid", "account_id", "accountid", "user_name", "username", "login"],
    "secret": ["passphrase", "credential", "pwd", "private_key", "privatekey", "auth_key", "authkey",
               "secret_key", "secretkey", "access_key", "accesskey"],
    "endpoint": ["://", "endpoint", "hostname"],
}
BARE = {"hex": HEX, "secret": LONG_RUN, "endpoint": ADDRESS}

KINDS = ["assign", "access", "hex", "identifier", "secret", "endpoint"]
PATTERNS = dict(zip(KINDS, [ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT]))
STRONG = 3
#: Which part of a credential a kind is.
PARTS = {"identifier": [1, 3], "secret": [0, 2, 4], "endpoint": [5]}
RUN = 256
#: What tells the different texts of a doc_id apart.
KEY = ["doc_id", "text_hash", "text_length"]


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _matches(texts: DataFrame) -> DataFrame:
    """Adds per kind the matches ``m_kind``, and ``g_kind``, the text's pieces between them.

    Spark gives matches without places; the pieces between them, from the same
    leftmost search, give the places by their lengths. A text is cut only where
    it has a match, and a pattern of many branches is tried only where the text
    holds one of its words.
    """
    texts = computed(texts, small=F.lower("text"))
    columns = {}
    for kind, pattern in PATTERNS.items():
        hints = [F.contains("small", F.lit(word)) for word in HINTS.get(kind, [])]
        hints += [F.col("text").rlike(BARE[kind])] if kind in BARE else []
        has = reduce(Column.__or__, hints) & F.col("text").rlike(pattern)
        columns[f"m_{kind}"] = F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        columns[f"g_{kind}"] = F.when(has, F.split("text", pattern, -1)).otherwise(F.array().cast("array<string>"))
    return computed(texts, **columns)


def _starts(df: DataFrame, kind: str, length, name: str) -> DataFrame:
    """Adds array ``name``: where each match starts, in the unit that ``length`` measures.

    A running total in runs of 256, so that a text full of matches costs little
    more than their number.
    """
    step, run, upto = f"_s_{name}", f"_r_{name}", f"_u_{name}"
    df = computed(df, **{step: F.zip_with(
        F.slice(f"g_{kind}", F.lit(1), F.size(f"m_{kind}")), F.col(f"m_{kind}"),
        lambda gap, match: F.struct(length(gap).cast("long").alias("gap"), (length(gap) + length(match)).cast("long").alias("both")))})
    n_runs = F.ceil(F.size(step) / RUN).cast("int")
    runs = F.when(F.size(step) > 0, F.sequence(F.lit(0), n_runs - 1)).otherwise(F.array().cast("array<int>"))
    df = computed(df, **{run: F.transform(runs, lambda r: _sum(F.transform(F.slice(step, r * RUN + 1, F.lit(RUN)), lambda s: s.both)))})
    df = computed(df, **{upto: F.transform(run, lambda _, r: _sum(F.slice(run, F.lit(1), r)))})
    return computed(df, **{name: F.transform(step, lambda s, i: (
        F.get(upto, (i / RUN).cast("int"))
        + _sum(F.transform(F.slice(step, (i / RUN).cast("int") * RUN + 1, i % RUN), lambda x: x.both)) + s.gap))}).drop(step, run, upto)


def _passes(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(match, ASSIGN, 1)) >= SHORTEST_VALUE
    if kind == "access":
        return F.length(match) >= SHORTEST_ACCESS
    if kind == "secret":
        return ~match.rlike("^[0-9a-f]+$")
    return F.lit(True)


def _spans(number: int, kind: str) -> Column:
    def span(match: Column, i: Column) -> Column:
        start, at = F.get(f"c_{kind}", i), F.get(f"b_{kind}", i)
        return F.struct(
            start.alias("start"), F.lit(number).alias("kind"), (start + F.length(match)).alias("stop"),
            at.alias("at"), (at + F.octet_length(match)).alias("upto"), _passes(kind, match).alias("passes"))

    return F.filter(F.transform(f"m_{kind}", span), lambda p: p.passes)


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")


def _parts(df: DataFrame, *kept: str) -> DataFrame:
    """Replaces the matches by ``parts``: (start, kind, stop) in code points, (at, upto) in bytes."""
    for kind in KINDS:
        df = _starts(df, kind, F.length, f"c_{kind}")
        df = _starts(df, kind, F.octet_length, f"b_{kind}")
    columns = [_spans(number, kind) for number, kind in enumerate(KINDS)]
    return df.select(*kept, *KEY, F.concat(*columns).alias("parts"))


def _texts(docs: DataFrame, *kept: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(*kept, "doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"), F.length(text).alias("text_length"))


def _linked(found: DataFrame, reach: int) -> DataFrame:
    """KEY, copies and spans from the ``parts`` of texts."""
    # Equal rows become one before anything is spread out.
    found = found.groupBy(*KEY).agg(F.count("*").alias("copies"), F.first("parts").alias("parts"))
    spread = found.select(*KEY, "copies", F.explode_outer("parts").alias("p")).select(*KEY, "copies", "p.*")
    near = Window.partitionBy(*KEY).orderBy("start").rangeBetween(-reach, reach)
    has = {name: F.max(F.col("kind").isin(kinds)).over(near) for name, kinds in PARTS.items()}
    spread = spread.withColumns({f"has_{name}": c for name, c in has.items()})
    linked = (
        F.when(F.col("kind") < STRONG, True)
        .when(F.col("kind") == 3, F.col("has_secret"))
        .when(F.col("kind") == 4, F.col("has_identifier"))
        .otherwise(F.col("has_identifier") & F.col("has_secret")))
    span = F.when(F.col("kind").isNotNull() & linked, F.struct("start", "kind", "stop", "at", "upto"))
    return spread.groupBy(*KEY).agg(F.first("copies").alias("copies"), F.sort_array(F.collect_list(span)).alias("spans"))


def scan(docs: DataFrame, reach: int = 400) -> DataFrame:
    """Secrets of each different text of a doc_id, over whole texts.

    Rows: doc_id, text_hash and text_length (which tell a doc_id's texts apart),
    ``copies`` (how many equal rows there are) and ``spans``, an array of
    (start, kind, stop, at, upto), ordered. Strong kinds always count. The weak
    parts of a credential are joined by interval: an identifier counts if a
    secret starts within ``reach`` code points of it in the same text, a secret
    if an identifier does, an endpoint if both do; strong kinds serve as
    identifiers (access) and secrets (assign, hex) too. The interval join is a
    range window over a text's parts, so no pairs are made.

    Null and empty texts have no spans; a null doc_id is a value like others;
    extra columns are ignored; an empty table gives no rows.
    """
    return _linked(_parts(_matches(_texts(docs))), reach)


def listed(spans: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.kind), s.start, s.stop)), ",")


def report(docs: DataFrame, reach: int = 400) -> DataFrame:
    """Per row of ``docs``: doc_id, the numbers of strong spans, the hash of their list, and all spans."""
    found = scan(docs, reach)
    strong = F.filter("spans", lambda s: s.kind < STRONG)
    counts = [_count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:STRONG])]
    rows = found.select(
        "doc_id", *counts, F.sha2(listed(strong).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        F.sequence(F.lit(1).cast("long"), "copies").alias("copies"))
    return rows.withColumn("copies", F.explode("copies")).drop("copies")


def redacted(docs: DataFrame, mark: str = "[REDACTED]", reach: int = 400) -> DataFrame:
    """``docs`` with every span of a text replaced by ``mark``; other texts and columns as they are.

    Spans that overlap or touch are replaced together. Texts are searched once and
    written beside the parts found; those without any part go on from there, the
    others alone meet their spans. A text is cut by byte offsets, so one with many
    spans is walked once. Null and empty texts and null ids stay; repeated rows
    stay repeated; all columns stay, whatever their names, but for names that begin
    with _llm_, which are refused; an empty table gives no rows.
    """
    row = F.struct(*unreserved(docs).columns)
    found = materialize(_parts(_matches(_texts(docs, row.alias("_llm_row"))), "_llm_row"), "secret-parts")
    clean, suspect = found.where(F.size("parts") == 0), found.where(F.size("parts") > 0)
    spans = _linked(suspect.select(*KEY, "parts"), reach).where(F.size("spans") > 0)
    # Merge what overlaps: a span opens a new cut if it starts behind all before it.
    order = Window.partitionBy(*KEY).orderBy("s.at", "s.upto").rowsBetween(Window.unboundedPreceding, -1)
    cuts = spans.select(*KEY, F.explode("spans").alias("s")).withColumn("past", F.max("s.upto").over(order))
    cut = F.struct(F.col("s.at").alias("at"), F.coalesce("past", F.lit(0).cast("long")).alias("past"), F.col("past").isNull().alias("opens"))
    cuts = cuts.groupBy(*KEY).agg(F.sort_array(F.collect_list(cut)).alias("cuts"), F.max("s.upto").alias("end"))
    cuts = cuts.select(*(F.col(name).alias(f"of_{name}") for name in KEY), "cuts", "end")
    same = reduce(Column.__and__, (suspect[name].eqNullSafe(cuts[f"of_{name}"]) for name in KEY))
    both = suspect.join(cuts, same, "left").select(F.col("_llm_row.*"), F.col("cuts").alias("_llm_cuts"), F.col("end").alias("_llm_end"))
    data = F.col("text").cast("binary")
    piece = lambda at, n: F.substring(data, (at + 1).cast("int"), n.cast("int")).cast("string")
    pieces = F.transform("_llm_cuts", lambda c: F.when((c.at > c.past) | c.opens, F.concat(
        F.when(c.at > c.past, piece(c.past, c.at - c.past)).otherwise(F.lit("")), F.lit(mark))).otherwise(F.lit("")))
    rest = F.coalesce(piece(F.col("_llm_end"), F.octet_length("text") - F.col("_llm_end")), F.lit(""))
    text = F.when(F.col("_llm_cuts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return clean.select("_llm_row.*").unionByName(both.withColumn("text", text).select(*docs.columns))
