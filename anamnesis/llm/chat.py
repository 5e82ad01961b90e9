"""Chat formatting from every participant's point of view."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import before, in_order

#: Marks of the template, and the roles that set the scene and have no view of their own.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SCENE = ("system", "tool")


def _speaker() -> Column:
    """A role as it may stand in a header: one line, no marks, no blanks; null and blank are ``unknown``."""
    name = F.regexp_replace(F.regexp_replace(F.coalesce("role", F.lit("")), r"<\|", "< |"), r"[\x00-\x20\x7F]+", "_")
    return F.when(F.trim(F.coalesce("role", F.lit(""))) == "", "unknown").otherwise(name)


def _names(turns: DataFrame) -> DataFrame:
    """(of, raw, speaker): one name for each role of a conversation; roles that look alike are told apart.

    The second of them, in the order of the roles, is called ``name (2)``; no role
    looks like that, as blanks are taken out.
    """
    roles = turns.select(F.col("conv_id").alias("of"), F.col("role").alias("raw"), _speaker().alias("clean")).distinct()
    number = F.row_number().over(Window.partitionBy("of", "clean").orderBy(F.col("raw").asc_nulls_first()))
    numbered = roles.withColumn("number", number)
    return numbered.select("of", "raw", F.when(F.col("number") == 1, F.col("clean")).otherwise(
        F.concat("clean", F.lit(" ("), F.col("number").cast("string"), F.lit(")"))).alias("speaker"))


def perspectives(turns: DataFrame, scene: tuple[str, ...] = SCENE) -> DataFrame:
    """Every dialogue rendered once per participant, as segments in order.

    ``turns`` has conv_id, turn, role, text. For each conversation and each of
    its speakers outside ``scene``, every turn gives a row: conv_id,
    ``perspective`` (the name of the speaker who is the assistant), ``position`` (from 0),
    ``segment`` (header, text, end mark), ``starts`` (its offset in code points
    in the rendered dialogue), and ``mask_from`` and ``mask_to``, the offsets of
    what is learned: the text and end mark of the assistant's own turns, null
    elsewhere. Others are users with their names; scene turns keep their role.
    Every different role is a speaker of its own, null too; those whose names would
    be alike are numbered. The rendered dialogue is the segments in the order of
    position.

    A conversation may hold any share of all rows: turns are sorted in blocks of
    consecutive keys, a running length is kept within a block, and the lengths
    of the blocks before are added. Turns of one number are ordered by role and
    text; null turns come first, a null text is empty, a null conv_id is a
    conversation like others, repeated rows stay, the marks inside a text are
    broken up by a blank; other columns are ignored; an empty table and
    conversations of scene turns alone give no rows.
    """
    text = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|", "< |"), r"\|>", "| >")
    names, said = _names(turns), turns.select("conv_id", "turn", "role", text.alias("body"))
    clean = said.join(names, said["conv_id"].eqNullSafe(names["of"]) & said["role"].eqNullSafe(names["raw"])).select(
        "conv_id", "turn", "speaker", "body")
    # The last key tells repeated rows apart, so that they may lie in several blocks.
    ordered = in_order(
        clean.withColumn("place", F.monotonically_increasing_id()),
        F.col("conv_id"), F.col("turn"), F.col("speaker"), F.xxhash64("body"), F.col("place"))
    talkers = ordered.where(~F.col("speaker").isin(list(scene))).select(
        F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    seen = ordered.join(talkers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("speaker") == F.col("perspective")
    header = F.concat(
        F.lit(OPEN), F.when(own, F.lit("assistant")).when(F.col("speaker").isin(list(scene)), F.col("speaker"))
        .otherwise(F.concat(F.lit("user name="), F.col("speaker"))), F.lit("\n"))
    seen = seen.withColumn("header", header).withColumn("segment", F.concat("header", "body", F.lit(CLOSE))).withColumn(
        "length", F.length("segment").cast("long"))

    keys = ["conv_id", "perspective"]
    totals = seen.groupBy(*keys, "block").agg(F.sum("length").alias("chars"), F.count("*").alias("rows"))
    totals = before(before(totals, keys, "block", "chars", "chars_before"), keys, "block", "rows", "rows_before")
    offsets = totals.select(*(F.col(k).alias(f"t_{k}") for k in [*keys, "block"]), "chars_before", "rows_before")
    # Nulls of conv_id and turn come first, as in the order of the blocks.
    window = Window.partitionBy(*keys, "block").orderBy("turn", "speaker", F.xxhash64("body"), "place")
    running = F.coalesce(F.sum("length").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = seen.withColumn("inside", running).withColumn("row", F.row_number().over(window) - 1)
    placed = placed.join(
        offsets, (F.col("block") == F.col("t_block")) & F.col("conv_id").eqNullSafe(F.col("t_conv_id"))
        & (F.col("perspective") == F.col("t_perspective")))
    starts = F.col("inside") + F.col("chars_before")
    return placed.select(
        "conv_id", "perspective", (F.col("row") + F.col("rows_before")).cast("long").alias("position"), "segment",
        starts.alias("starts"), F.when(own, starts + F.length("header")).alias("mask_from"),
        F.when(own, starts + F.col("length")).alias("mask_to"))


def training_rows(turns: DataFrame, most_chars: int = 1 << 20, scene: tuple[str, ...] = SCENE) -> DataFrame:
    """(conv_id, perspective, part, text, masks): the dialogues of ``perspectives`` as rows to train on.

    ``masks`` are the (start, stop) of what is learned, in code points of ``text``.
    A dialogue is cut between segments into parts: a segment belongs to the part in
    which it starts, by steps of ``most_chars``; so a row holds that much and the
    rest of one segment at most, however long the dialogue is. Odd rows are treated
    as by ``perspectives``.
    """
    segments = perspectives(turns, scene).withColumn("part", F.floor(F.col("starts") / most_chars).cast("long"))
    grouped = segments.groupBy("conv_id", "perspective", "part").agg(
        F.array_sort(F.collect_list(F.struct("position", "segment", "mask_from", "mask_to"))).alias("s"), F.min("starts").alias("begin"))
    masks = F.transform(F.filter("s", lambda s: s.mask_from.isNotNull()), lambda s: F.struct(
        (s.mask_from - F.col("begin")).alias("start"), (s.mask_to - F.col("begin")).alias("stop")))
    return grouped.select("conv_id", "perspective", "part", F.array_join(F.transform("s", lambda s: s.segment), "").alias("text"), masks.alias("masks"))


SQL = r"""
    WITH n AS (
      SELECT conv_id, turn, role,
             CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown'
                  ELSE regexp_replace(replace(role, '<|', '< |'), '[\x00-\x20\x7F]+', '_', 'g') END AS clean,
             replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS body
      FROM conversations),
    c AS (
      SELECT conv_id, turn, body, CASE WHEN k = 1 THEN clean ELSE clean || ' (' || k || ')' END AS speaker
      FROM (SELECT *, dense_rank() OVER (PARTITION BY conv_id, clean ORDER BY role NULLS FIRST) AS k FROM n)),
    s AS (
      SELECT c.conv_id, c.turn, t.perspective, c.speaker = t.perspective AS own,
             '<|im_start|>' || CASE WHEN c.speaker = t.perspective THEN 'assistant' WHEN c.speaker IN ('system', 'tool') THEN c.speaker
               ELSE 'user name=' || c.speaker END || chr(10) AS header, c.body || '<|im_end|>' || chr(10) AS rest
      FROM c JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM c WHERE speaker NOT IN ('system', 'tool')) t
        ON c.conv_id IS NOT DISTINCT FROM t.conv_id),
    p AS (
      SELECT *, length(header || rest) AS n,
             row_number() OVER w - 1 AS position, sum(length(header || rest)) OVER w AS upto
      FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn ROWS UNBOUNDED PRECEDING))
    SELECT conv_id, perspective, CAST(position AS BIGINT) AS position, header || rest AS segment,
           CAST(upto - n AS BIGINT) AS starts,
           CASE WHEN own THEN CAST(upto - n + length(header) AS BIGINT) END AS mask_from,
           CASE WHEN own THEN CAST(upto AS BIGINT) END AS mask_to
    FROM p
"""
