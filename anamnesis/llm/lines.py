"""Lines that many documents share, and which lines of each document stay without them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BLANKS, computed, materialize, partitions

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What tells a document from others wherever it is joined: its id and the hash of its text.
DOCUMENT = ["doc_id", "text_hash"]
#: 96 bits tell keys apart: chance alone makes two of a trillion alike with odds of one in a hundred thousand.
KEY = ["h", "g"]


def ascii_lower(text: Column) -> Column:
    """A-Z in small letters, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("text_hash", F.xxhash64("text"))


def occurrences(docs: DataFrame, least_chars: int = 1) -> DataFrame:
    """(block, h, g, doc_id, text_hash, row, position, is_first) of every line with a key of ``least_chars`` or more.

    No text goes on from here, only hashes of keys, dealt into ranges of hashes and
    sorted there by document and position. So the lines of one key stream by in
    order, and the first of each document is told by its neighbour alone. A key
    that fills a large part of the corpus is parted between documents, as the
    ranges are of key and document; a row counts as a document of its own, so
    repeated rows part as well.
    """
    numbered = _named(docs).withColumn("row", F.monotonically_increasing_id())
    lines = computed(numbered, lines=F.split(ascii_lower(F.col("text")), "\n")).drop("text")
    keys = computed(lines, keys=F.transform("lines", lambda line: F.btrim(line, F.lit(BLANKS)))).drop("lines")
    long_enough = lambda line: line.key_chars >= least_chars
    marks = F.filter(F.transform("keys", lambda key, i: F.struct(
        F.xxhash64(key).alias("h"), F.hash(key).alias("g"), i.alias("position"), F.char_length(key).alias("key_chars"))), long_enough)
    rows = keys.select(*DOCUMENT, "row", F.explode(marks).alias("m")).select("m.h", "m.g", *DOCUMENT, "row", "m.position")
    within = [*KEY, *DOCUMENT, "row"]
    dealt = rows.repartitionByRange(partitions(docs.sparkSession), *within)
    # The ranges already hold a document's lines of one key together: this window sorts, and shuffles nothing.
    number = F.row_number().over(Window.partitionBy(*within).orderBy("position"))
    return dealt.withColumn("is_first", number == 1).withColumn("block", F.spark_partition_id())


def shared_keys(found: DataFrame, least_documents: int = 10) -> DataFrame:
    """(block, h, g) of the keys that stand in ``least_documents`` or more, for every block that holds them.

    Documents are counted before the shuffle. As blocks are ranges of keys, a key
    stands in all blocks from its first to its last.
    """
    counts = found.groupBy(*KEY).agg(
        F.sum(F.col("is_first").cast("long")).alias("n_documents"), F.min("block").alias("low"), F.max("block").alias("high"))
    return counts.where(F.col("n_documents") >= least_documents).select(F.explode(F.sequence("low", "high")).alias("block"), *KEY)


def bitmaps(docs: DataFrame, least_documents: int = 10, least_chars: int = 1) -> DataFrame:
    """(doc_id, text_hash, n_dropped, zeros) of the documents that lose lines.

    ``zeros`` is the compressed bitmap of the lines that stay: (start, size) of
    each run of zeros, counted from line 0; all other lines are ones. A document
    without a row keeps every line.
    """
    found = materialize(occurrences(docs, least_chars), "line-occurrences")
    # By block and key, so that a key with many lines is parted here as well.
    gone = found.join(shared_keys(found, least_documents), ["block", *KEY], "left_semi")
    # Rows equal in id and text have the same lines: one bitmap serves them all.
    dropped = gone.groupBy(*DOCUMENT).agg(F.sort_array(F.collect_set("position")).alias("at"))
    heads = F.filter("at", lambda x, i: ~(F.get("at", i - 1) + 1).eqNullSafe(x))
    tails = F.filter("at", lambda x, i: ~(F.get("at", i + 1) - 1).eqNullSafe(x))
    cut = computed(dropped, heads=heads, tails=tails)
    runs = F.zip_with("heads", "tails", lambda head, tail: F.struct(head.alias("start"), (tail - head + 1).alias("size")))
    return cut.select(*DOCUMENT, F.size("at").cast("long").alias("n_dropped"), runs.alias("zeros"))


def kept_lines(docs: DataFrame, least_documents: int = 10, least_chars: int = 1) -> DataFrame:
    """doc_id, text, n_lines, n_dropped and kept_text of every row of ``docs``.

    Texts are split at \\n; the key of a line is the line without blanks at its
    ends, with A-Z in small letters. Keys of ``least_chars`` code points or more
    that stand in ``least_documents`` or more documents lose all their lines; the
    others stay, joined by \\n. Each row counts as a document, repeated ones
    too. Null and empty texts are one empty line; a null doc_id is a value like
    others; extra columns are ignored; an empty table gives no rows.

    Whole texts are shuffled once at most, to meet their bitmaps.
    """
    zeros = bitmaps(docs, least_documents, least_chars).select(
        F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_text"), "n_dropped", "zeros")
    texts = _named(docs)
    both = texts.join(zeros, texts["doc_id"].eqNullSafe(zeros["of_id"]) & (texts["text_hash"] == zeros["of_text"]), "left")
    both = computed(both.select("doc_id", "text", "n_dropped", "zeros"), lines=F.split("text", "\n"))

    def ones(start: Column, stop: Column) -> Column:
        return F.when(stop > start, F.array_join(F.slice("lines", start + 1, stop - start), "\n"))

    def end(i: Column) -> Column:
        run = F.get("zeros", i)
        return F.coalesce(run["start"] + run["size"], F.lit(0))

    pieces = F.concat(
        F.transform("zeros", lambda run, i: ones(end(i - 1), run["start"])),
        F.array(ones(end(F.size("zeros") - 1), F.size("lines"))))
    # A run of zeros at either end leaves no piece there: array_join passes over nulls.
    return both.select(
        "doc_id", "text", F.size("lines").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("zeros").isNull(), F.col("text")).otherwise(F.array_join(pieces, "\n")).alias("kept_text"))


def digests(docs: DataFrame, least_documents: int = 10, least_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row; see ``kept_lines``."""
    return kept_lines(docs, least_documents, least_chars).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def sql(least_documents: int = 10, least_chars: int = 1) -> str:
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
    k AS (SELECT r, i, line, translate(regexp_replace(regexp_replace(line, '^[ 	-
]+', ''), '[ 	-
]+$', ''),
                 '{CAPITALS}', '{SMALL}') AS key FROM l),
    n AS (SELECT key FROM k WHERE length(key) >= {least_chars} GROUP BY key HAVING count(DISTINCT r) >= {least_documents}),
    s AS (SELECT k.r, count(*) AS n_lines, count(n.key) AS n_dropped,
                 coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE n.key IS NULL), '') AS kept
          FROM k LEFT JOIN n ON k.key = n.key GROUP BY k.r)
    SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256
    FROM d JOIN s USING (r)
    """
