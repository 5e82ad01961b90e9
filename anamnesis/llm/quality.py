"""Quality rules by document, tightened by what the rules say about the whole host."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_BLANK, computed, materialize, unreserved, words

#: Characters that count as symbols (fixed value).
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """A text fails its base below ``min_words`` or above ``max_repeated`` per cent of repeated words.

    It is doubtful beyond any of the other limits; that alone rejects nothing,
    but of a host whose shrunk rate of doubtful texts is above ``max_host_rate``
    only texts that are not doubtful stay.
    """
    min_words: int = 50
    max_repeated: int = 50
    doubtful_repeated: int = 20
    doubtful_symbols: int = 10
    doubtful_lines: int = 30
    shortest_words: int = 2
    longest_words: int = 20
    max_host_rate: float = 0.5


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, n_lines and the counts) of every row, whole texts; a null text is empty.

    Two windows of three words are equal if their 64-bit hashes are. A text's
    windows are sorted within its row; a window is repeated if a neighbour
    equals it, and its three words are marked by position.
    """
    base = docs.select("doc_id", F.col(host).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    cut = computed(
        base, words=words(F.col("text")),
        lines=F.filter(F.split("text", "\n"), lambda line: line.rlike(NOT_BLANK)),
        n_symbols=(F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]++", ""))).cast("long"),
    ).drop("text")
    hashed = computed(
        cut, n_words=F.size("words").cast("long"), word_chars=F.length(F.array_join("words", "")).cast("long"),
        n_lines=F.size("lines").cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        windows=F.sort_array(F.transform(
            F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
            lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")))),
    ).drop("words", "lines")
    again = F.filter("windows", lambda w, i: w.h.eqNullSafe(F.get("windows", i - 1).h) | w.h.eqNullSafe(F.get("windows", i + 1).h))
    marked = F.flatten(F.transform(again, lambda w: F.array(w.i, w.i + 1, w.i + 2)))
    return hashed.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.size(F.array_distinct(marked)).cast("long").alias("n_repeat_words"))


def _verdicts(limits: Limits) -> dict[str, Column]:
    n, chars = F.col("n_words"), F.col("word_chars")
    failed = (n < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeated * n)
    doubtful = (
        failed | (100 * F.col("n_repeat_words") > limits.doubtful_repeated * n)
        | (100 * F.col("n_symbols") > limits.doubtful_symbols * chars)
        | (100 * F.col("n_dup_lines") > limits.doubtful_lines * F.col("n_lines"))
        | (chars < limits.shortest_words * n) | (chars > limits.longest_words * n)
    )
    return {"base_failed": failed, "doubtful": doubtful}


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) from hosts (n, bad) by moments: the spread between hosts beyond chance.

    Without any spread to judge by (one host, no failures, failures only) the
    prior weighs as much as two documents.
    """
    row = hosts.agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("hosts"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("spread"),
    ).first()
    if not row["n"]:
        return 1.0, 1.0
    mean = row["bad"] / row["n"]
    chance = mean * (1 - mean)
    room = row["n"] - row["squares"] / row["n"] - (row["hosts"] - 1)
    if chance == 0 or room <= 0:
        return 2 * mean, 2 * (1 - mean)
    spread = row["spread"] - row["bad"] * row["bad"] / row["n"]
    share = min(max((spread / chance - (row["hosts"] - 1)) / room, 1e-6), 1 - 1e-6)
    weight = 1 / share - 1
    return mean * weight, (1 - mean) * weight


def host_rates(found: DataFrame) -> DataFrame:
    """(of, host_rate) of every host of rows (host, doubtful): failures are summed by host before the
    shuffle, and a host's rate is shrunk towards the corpus by a beta prior fitted to all hosts."""
    hosts = found.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("doubtful").cast("long")).alias("bad"))
    alpha, beta = beta_prior(hosts)
    return hosts.select(F.col("host").alias("of"), ((F.col("bad") + alpha) / (F.col("n") + alpha + beta)).alias("host_rate"))


def judged(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """Measures, ``base_failed``, ``doubtful``, ``host_rate`` and ``kept`` of every row.

    Host verdicts are joined back to the measures. A null host is a host of its
    own; null and empty texts fail their base; repeated rows count as often as
    they stand; extra columns are ignored; an empty table gives no rows.
    """
    found = materialize(measures(docs, host).withColumns(_verdicts(limits)), "measures")
    rates = host_rates(found)
    named = found.join(rates, found["host"].eqNullSafe(rates["of"]), "left").drop("of")
    return named.withColumn("kept", ~F.col("base_failed") & ~((F.col("host_rate") > limits.max_host_rate) & F.col("doubtful")))


def passing(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, as they are.

    Texts are not shuffled: rows that pass their base are written once beside
    their verdicts, and only doubtful ones meet the mistrusted hosts. Nulls, empty
    texts and hosts are treated as by ``judged``; repeated rows stay repeated; all
    columns stay, whatever their names, but for names that begin with _llm_,
    which are refused; an empty table gives no rows.
    """
    rows = unreserved(docs).select(F.struct(*docs.columns).alias("doc_id"), F.col(host).alias("_llm_host"), "text")
    found = measures(rows, "_llm_host").withColumns(_verdicts(limits)).select(
        "host", "doubtful", F.when(~F.col("base_failed"), F.col("doc_id")).alias("row"))
    found = materialize(found, "verdicts")
    rates = host_rates(found)
    mistrusted = rates.where(F.col("host_rate") > limits.max_host_rate)
    stay = found.where(F.col("row").isNotNull())
    doubtful = stay.where("doubtful")
    doubtful = doubtful.join(mistrusted, doubtful["host"].eqNullSafe(mistrusted["of"]), "left_anti")
    return stay.where("not doubtful").select("row.*").unionByName(doubtful.select("row.*"))


def host_sql(limits: Limits = Limits()) -> str:
    """The check of the contract's columns in SQL."""
    word, blank = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"
    return rf"""
    WITH cut AS (
      SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '{word}') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM documents),
    windows AS (
      SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
      FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS i FROM cut)),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
    marked AS (SELECT r, count(DISTINCT i + d) AS n FROM again CROSS JOIN (VALUES (0), (1), (2)) AS t(d) GROUP BY r),
    counted AS (
      SELECT cut.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '{blank}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(marked.n, 0) AS BIGINT) AS n_repeat_words
      FROM cut LEFT JOIN marked USING (r)),
    ruled AS (
      SELECT *, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeated} * n_words AS base_failed,
             n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.doubtful_repeated} * n_words
             OR 100 * n_symbols > {limits.doubtful_symbols} * word_chars
             OR 100 * n_dup_lines > {limits.doubtful_lines} * n_lines
             OR word_chars < {limits.shortest_words} * n_words OR word_chars > {limits.longest_words} * n_words AS doubtful
      FROM counted),
    hosts AS (SELECT source, count(*) AS n, sum(doubtful::INT)::DOUBLE AS bad FROM ruled GROUP BY source),
    moments AS (
      SELECT sum(bad) / sum(n) AS mean, count(*) - 1 AS free, sum(n)::DOUBLE AS total, sum(n * n)::DOUBLE AS squares,
             sum(bad * bad / n) - sum(bad) * sum(bad) / sum(n) AS spread FROM hosts),
    weights AS (
      SELECT mean, CASE WHEN mean * (1 - mean) = 0 OR total - squares / total - free <= 0 THEN 2.0
        ELSE 1 / least(greatest((spread / (mean * (1 - mean)) - free) / (total - squares / total - free), 1e-6), 1 - 1e-6) - 1 END AS w
      FROM moments),
    rates AS (SELECT source, (bad + mean * w) / (n + w) AS rate FROM hosts, weights)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT (rate > {limits.max_host_rate} AND doubtful) AS kept
    FROM ruled JOIN rates ON ruled.source IS NOT DISTINCT FROM rates.source
    """
