"""Mixing sources to target weights by pivotal rounding of fractional copies."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import before, computed, in_order, materialize, unreserved, word_count
from pyspark.sql.window import Window

WEIGHTS = (5, 2, 1)
#: Documents whose fractions one task step pairs off. A block's size is random about this.
BLOCK = 64
#: Fractions that differ by less are one.
ALIKE = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) from rows (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``total`` times all sizes; none gets more than ``most`` times its size, and
    what exceeds is shared again by weight. Sources are ranked in blocks, not
    in one task; each round of sharing is one aggregation to a single row.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ordered = in_order(sources, F.col("source").isNull(), F.col("source"))
    counts = before(ordered.groupBy("block").agg(F.count("*").alias("rows")), [], "block", "rows", "ahead")
    rank = F.row_number().over(Window.partitionBy("block").orderBy(F.col("source").isNull(), "source"))
    ranked = ordered.withColumn("rank", rank).join(counts, "block").withColumn("rank", F.col("rank") + F.col("ahead") - 1)
    weighed = materialize(ranked.select("source", "source_size", "n", F.get(
        F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights)).cast("int")).alias("weight")), "sources")
    # A weight's worth of words only grows while sources reach their caps: each round closes at least one.
    budget = total * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    worth, closed = 0.0, -1
    while True:
        full = F.col("weight") * worth >= most * F.col("source_size")
        row = weighed.agg(
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0.0)).alias("given"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(full).alias("closed")).first()
        if not row["open"] or row["closed"] == closed:
            break
        closed, worth = row["closed"], (budget - row["given"]) / row["open"]
    target = F.least(F.col("weight") * worth, most * F.col("source_size"))
    return weighed.select("source", "source_size", "n", target.cast("double").alias("target"))


def _chance(*of: Column) -> Column:
    """A number from 0 up to 1 that depends on nothing but ``of``."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / float(1 << 53)


OPEN = "struct<unit:bigint,size:double,mass:double>"
DONE = "array<struct<unit:bigint,extra:int>>"


def _decide(state: Column, new: Column, seed: int) -> Column:
    """Pairs the next unit of a block with all units after it, taken together.

    All of them are fractional by the same ``share``. Words move between the two
    until one is whole or empty: raising the unit by ``up`` or lowering it by
    ``down``, with chances down and up to up + down, keeps their sum and leaves
    every expectation as it was; what the rest gives or gets is spread evenly
    over its words. If the unit is decided, the next one is paired; if it is the
    rest that is whole or empty, the unit stays open.
    """
    size, share, done = new["size"], state["share"], state["done"]
    room = F.greatest(state["room"] - size, F.lit(0.0))
    mass, rest = share * size, share * room
    up, down = F.least(size - mass, rest), F.least(mass, room - rest)
    raised = _chance(new["unit"], F.lit("raise"), F.lit(seed)) * (up + down) < down

    def decided(extra: Column, left: Column) -> Column:
        more = F.concat(done, F.array(F.struct(new["unit"].alias("unit"), extra.cast("int").alias("extra"))))
        return F.struct(room.alias("room"), F.least(F.greatest(left, F.lit(0.0)), F.lit(1.0)).alias("share"), state["open"].alias("open"), more.alias("done"))

    def stays(at: Column, left: float) -> Column:
        unit = F.struct(new["unit"].alias("unit"), size.alias("size"), at.alias("mass"))
        return F.struct(room.alias("room"), F.lit(left).alias("share"), unit.alias("open"), done.alias("done"))

    return (
        F.when(state["open"].isNotNull(), decided(share > 0.5, share))
        .when(room <= 0, stays(mass, 0.0))
        .when(raised & (size - mass <= rest), decided(F.lit(1), (rest - up) / room))
        .when(raised, stays(mass + rest, 0.0))
        .when(mass <= room - rest, decided(F.lit(0), (rest + down) / room))
        .otherwise(stays(mass - (room - rest), 1.0)))


def _deal(units: Column, seed: int) -> Column:
    """(open, done) of units that share one fraction, from large to small."""
    first = F.get(units, F.lit(0))
    start = F.struct(
        F.aggregate(units, F.lit(0.0), lambda t, u: t + u["size"]).alias("room"), (first["mass"] / first["size"]).alias("share"),
        F.lit(None).cast(OPEN).alias("open"), F.array().cast(DONE).alias("done"))
    return F.aggregate(units, start, lambda s, u: _decide(s, u, seed), lambda s: F.struct(s["open"].alias("open"), s["done"].alias("done")))


def _pair(state: Column, new: Column, seed: int) -> Column:
    """For units of unlike fractions: moves words between the carried unit and the next until one of the two is whole or empty.

    Raising one by ``a`` or the other by ``b``, with chances b and a to a + b,
    keeps their sum and leaves each unit's expectation as it was.
    """
    one = state["open"]
    a = F.least(one["size"] - one["mass"], new["mass"])
    b = F.least(one["mass"], new["size"] - new["mass"])
    raise_one = _chance(one["unit"], new["unit"], F.lit("raise"), F.lit(seed)) * (a + b) <= b
    one_full = one["size"] - one["mass"] <= new["mass"]
    new_full = new["size"] - new["mass"] <= one["mass"]

    def unit(of: Column, mass: Column) -> Column:
        return F.struct(of["unit"].alias("unit"), of["size"].alias("size"), mass.alias("mass"))

    def after(done: Column, extra: int, stays: Column, mass: Column) -> Column:
        decided = F.struct(done["unit"].alias("unit"), F.lit(extra).alias("extra"))
        return F.struct(unit(stays, mass).alias("open"), F.concat(state["done"], F.array(decided)).alias("done"))

    return F.when(
        raise_one,
        F.when(one_full, after(one, 1, new, new["mass"] - a)).otherwise(after(new, 0, one, one["mass"] + a)),
    ).otherwise(
        F.when(new_full, after(new, 1, one, one["mass"] - b)).otherwise(after(one, 0, new, new["mass"] + b)))


def _fold(units: Column, seed: int) -> Column:
    """(open, done): the one unit of an array still fractional, and the extra copies of the others."""
    first = F.get(units, F.lit(0))
    start = F.struct(
        F.struct(first["unit"].alias("unit"), first["size"].alias("size"), first["mass"].alias("mass")).alias("open"),
        F.array().cast(DONE).alias("done"))
    return F.aggregate(F.slice(units, F.lit(2), F.greatest(F.size(units) - 1, F.lit(0))), start, lambda s, u: _pair(s, u, seed))


def rounded(units: DataFrame, largest: int, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """(source, unit, extra 0 or 1) from units (source, unit, size, mass), 0 < mass < size.

    ``mass`` is the expected number of words beyond whole copies; ``largest`` is
    the number of units of the largest source. A tree of rounds: each deals a source's open
    units by hash into blocks of about ``block``, pairs them off there from large
    to small until one is open, mostly a small one, and hands that on. In a block
    of equal fractions, as nearly all are in the first round, a unit is paired with
    the rest of its block as a whole; where fractions differ, with the next. A source's words are kept to the last
    unit, which is rounded to the nearer side; so a source is off its target by
    half of one document at most. Rounds: the logarithm of ``largest`` to base
    ``block``.
    """
    decided, level, open_units = [], 0, units
    while True:
        blocks = max(1, -(-largest // block))
        dealt = open_units.withColumn("part", F.pmod(F.xxhash64("unit", F.lit(seed + level)), F.lit(blocks)).cast("int"))
        folded = dealt.groupBy("source", "part").agg(
            F.sort_array(F.collect_list(F.struct("size", "unit", "mass")), asc=False).alias("units"))
        first = F.get("units", F.lit(0))
        alike = F.forall("units", lambda u: F.abs(u["mass"] / u["size"] - first["mass"] / first["size"]) < ALIKE)
        units, at = F.col("units"), seed + level
        fold = F.when(alike, _deal(units, at)).otherwise(_fold(units, at)) if level == 0 else _fold(units, at)
        folded = computed(folded, f=fold).select("source", "f")
        folded = materialize(folded, "pivotal-round")
        decided.append(folded.select("source", F.explode("f.done").alias("d")).select("source", "d.unit", "d.extra"))
        open_units = folded.select("source", "f.open.*")
        if blocks == 1:
            break
        largest, level = blocks, level + 1
    last = open_units.select("source", "unit", (2 * F.col("mass") >= F.col("size")).cast("int").alias("extra"))
    for part in decided:
        last = last.unionByName(part)
    return last


#: What rows have in common that count as one document.
KEY = ["doc_id", "source", "text_hash", "size"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), F.xxhash64("text").alias("text_hash"),
                       word_count(F.col("text")).alias("size"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """(doc_id, source, text_hash, size, rows, source_size, target, copies, odd) per different document.

    Rows equal in doc_id, source and text are one document, of ``rows`` rows. A
    source's copies a row, target over source size, are dealt as whole copies and a
    fraction. Of equal rows the fraction gives whole rows one more; what is then left
    of it, less than a row, is rounded by moving words between documents
    (``rounded``). ``copies`` is what every row gets, ``odd`` how many of the rows get
    one more. Documents without words get the whole copies. All chances come from
    hashes of the rows, so a rerun, or a task run twice, gives the same.
    """
    sizes = materialize(_keyed(docs).groupBy(*KEY).agg(F.count("*").alias("rows")), "sizes")
    shares = materialize(targets(sizes.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, total, most), "targets")
    largest = shares.agg(F.max("n")).first()[0] or 0
    named = sizes.join(shares.withColumnRenamed("source", "of"), sizes["source"].eqNullSafe(F.col("of"))).drop("of", "n")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    named = named.withColumn("rate", rate).withColumn("unit", F.xxhash64(*KEY))
    due = F.when(F.col("size") > 0, (F.col("rate") - F.floor("rate")) * F.col("rows")).otherwise(F.lit(0.0))
    named = named.withColumn("whole", F.floor(due)).withColumn("left", due - F.floor(due))
    words = F.col("size").cast("double")
    units = named.where("left > 0").groupBy("source", "unit").agg(F.sum(words).alias("size"), F.sum(words * F.col("left")).alias("mass"))
    extra = rounded(units, largest, seed)
    extra = extra.select(F.col("source").alias("of"), F.col("unit").alias("u"), "extra")
    both = named.join(extra, (named["unit"] == extra["u"]) & named["source"].eqNullSafe(extra["of"]), "left")
    return both.select(*KEY, "rows", "source_size", "target", F.floor("rate").cast("long").alias("copies"),
                       (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("long").alias("odd"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target and taken (words the mix takes, repeats counted).

    A null text has size 0, a null source is a source like others (the last), of
    equal rows some may be taken once more than others, extra columns are ignored,
    an empty table gives no rows.
    """
    found = plan(docs, **settings).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    copies = F.col("copies") + (F.col("row") <= F.col("odd")).cast("long")
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Where some of the rows equal in doc_id, source and text are taken once more, it
    is the one whose columns hash least that is taken for all of them. Nulls, empty
    texts and repeated rows are else treated as by ``mix``. All columns stay,
    whatever their names, but for names that begin with _llm_, which are refused;
    an empty table gives no rows.
    """
    found = plan(unreserved(docs), **settings).where("copies > 0 or odd > 0")
    found = found.select(*(F.col(name).alias(f"_llm_{name}") for name in (*KEY, "copies", "odd", "rows")))
    row = F.struct(*docs.columns)
    keyed = docs.select(row.alias("_llm_row"), F.col("doc_id").alias("_llm_d"), F.col("source").alias("_llm_s"), F.xxhash64("text").alias("_llm_t"))
    both = keyed.join(found, keyed["_llm_d"].eqNullSafe(found["_llm_doc_id"]) & keyed["_llm_s"].eqNullSafe(found["_llm_source"])
                      & (keyed["_llm_t"] == found["_llm_text_hash"]))
    every = F.col("_llm_copies") + F.when(F.col("_llm_rows") == 1, F.col("_llm_odd")).otherwise(F.lit(0))
    again = both.where("_llm_rows > 1 and _llm_odd > 0").groupBy("_llm_d", "_llm_s", "_llm_t").agg(
        F.min_by("_llm_row", F.xxhash64(*(f"_llm_row.`{name}`" for name in _hashable(docs)))).alias("_llm_row"), F.first("_llm_odd").alias("_llm_times"))
    times = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n))
    taken = both.where(every > 0).withColumn("_llm_copy", times(every)).select("_llm_row.*")
    return taken.unionByName(again.withColumn("_llm_copy", times(F.col("_llm_times"))).select("_llm_row.*"))


def _hashable(docs: DataFrame) -> list[str]:
    return [name for name, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
