"""Near-duplicate documents by SimHash, found with ball hashing that meets in the middle."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, unreserved
from .components import components

SEED = 42
#: The three blocks of a fingerprint: lowest bit and width.
BLOCKS = [(0, 22), (22, 21), (43, 21)]
WIDEST = 22
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a whole text, as a signed number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:min(at + CHUNK, n) + shingle - 1]
        pieces = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [part]
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(p), SEED) for p in pieces], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keys: list[str] | None = None) -> DataFrame:
    """``keys`` (doc_id by default) of each row with its fingerprint ``fp``; a null text is empty."""
    keys = keys or ["doc_id"]
    source = docs.select(*keys, F.col("text").cast("binary").alias("text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in source.select(*keys).dtypes) + ", fp bigint"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keys))
            fps = pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fps], [*keys, "fp"])

    return source.mapInArrow(hashed, schema)


def _turned(bits: Column, by: int) -> Column:
    """A rotation to the right."""
    return F.shiftrightunsigned(bits, by).bitwiseOR(F.shiftleft(bits, 64 - by)) if by else bits


def _low(width: int) -> Column:
    return F.lit((1 << width) - 1).cast("long")


def _by_block(of) -> Column:
    """What ``of(lowest bit, width)`` gives for the block that a key names in its last two bits."""
    k = F.col("key").bitwiseAND(_low(2))
    return F.when(k == 0, of(*BLOCKS[0])).when(k == 1, of(*BLOCKS[1])).otherwise(of(*BLOCKS[2]))


def _flips(bits: Column, masks: list[int]) -> Column:
    return F.array(*(bits.bitwiseXOR(F.lit(m).cast("long")) for m in masks))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _masks(width: int, weights: tuple[int, ...], shift: int = 0) -> list[int]:
    from itertools import combinations

    return [_signed(sum(1 << (i + shift) for i in c)) for w in weights for c in combinations(range(width), w)]


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` at 3 or fewer differing bits.

    Every pair in reach is linked or joined through links, and every link is
    verified. Half of three bits is one flip on either side and one bit left
    over, so each fingerprint is emitted three times, each time with one block of
    21 or 22 bits set apart, and within radius one on the other bits: 131 keys
    each. Under a key (block, other bits) two fingerprints are within two bits
    besides their blocks. So

    * equal blocks are within reach: each row is linked to the next;
    * blocks one bit apart are within reach: the first rows of the two are linked;
    * blocks two or three bits apart matter only where all differing bits lie in
      the block (else another block shows the pair as above): rows emitted without
      a flip meet in the middle again, one bit against two.

    All links are chains and stars, so a dense group of copies costs what its
    members cost, not its pairs. Only keys that two fingerprints share live on
    after the one large shuffle; chance alone shares three keys in ten billion pairs.
    """
    rows = None
    for k, (lowest, width) in enumerate(BLOCKS):
        turned = fps.select(_turned(F.col("fp"), lowest).alias("r"))
        bare = F.col("r").bitwiseAND(F.lit(~((1 << width) - 1))).bitwiseOR(F.lit(k).cast("long"))
        part = turned.select("r", F.explode(_flips(bare, [0, *_masks(64 - width, (1,), width)])).alias("key"))
        rows = part if rows is None else rows.unionByName(part)
    # One sort serves: neighbours in the order of (key, block, rest) tell which keys are shared.
    order = Window.partitionBy("key").orderBy("block", "r")
    shared = (
        rows.withColumn("block", _by_block(lambda _, width: F.col("r").bitwiseAND(_low(width))))
        .withColumn("last", F.lag("r").over(order)).withColumn("next", F.lead("r").over(order))
        .where("last is not null or next is not null")
    )
    shared = materialize(shared.select("key", "block", "r", "last"), "shared-keys")

    def back(r: str) -> Column:
        return _by_block(lambda lowest, _: _turned(F.col(r), 64 - lowest if lowest else 0))

    same_block = F.col("last").isNotNull() & (_by_block(lambda _, width: F.col("last").bitwiseAND(_low(width))) == F.col("block"))
    chain = shared.where(same_block).select(back("r").alias("a"), back("last").alias("b"))

    first = shared.where(~same_block).select("key", "block", back("r").alias("a"))
    up = first.select("key", F.col("a").alias("b"), F.explode(_flips(F.col("block"), _masks(WIDEST, (1,)))).alias("block"))
    beside = first.join(up, ["key", "block"]).where("a > b").select("a", "b")

    unflipped = _by_block(lambda _, width: F.shiftrightunsigned(F.col("r").bitwiseXOR(F.col("key")), width)) == 0
    plain = shared.where(unflipped).select("key", "block", back("r").alias("a"))
    by_block = Window.partitionBy("key").orderBy("block")
    plain = (
        plain.withColumn("under", F.lag("block").over(by_block)).withColumn("over", F.lead("block").over(by_block))
        .where("under is not null or over is not null").drop("under", "over")
    )
    near = plain.select("key", "a", F.explode(_flips(F.col("block"), _masks(WIDEST, (0, 1)))).alias("block"))
    centre = near.groupBy("key", "block").agg(F.min("a").alias("b"))
    far = plain.select("key", "a", F.explode(_flips(F.col("block"), _masks(WIDEST, (1, 2)))).alias("block"))
    inside = far.join(centre, ["key", "block"]).where("a <> b").select("a", "b")

    found = chain.unionByName(beside).unionByName(inside)
    found = found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return found.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 3)


def groups(prints: DataFrame) -> DataFrame:
    """From rows (doc_id, fp): one row per fingerprint with ``component_id`` and ``root``.

    The first is the smallest doc_id of all documents reachable over links of 3 or
    fewer bits. Null doc_ids count only where there is no other, and groups of
    repeated or null doc_ids may share it; ``root``, the smallest fingerprint
    reachable, tells them apart. Equal fingerprints are one node, so a group of
    exact copies is one row from the first shuffle on.
    """
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = materialize(components(links(nodes.select("fp"))), "roots")
    named = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row of ``docs``.

    Words are runs of non-blanks after lower-casing A-Z; null and empty texts have
    fingerprint zero and link like others; repeated rows stay repeated, a
    repeated doc_id is kept with each of its texts; extra columns are ignored;
    an empty table gives no rows.
    """
    prints = materialize(fingerprints(docs, shingle), "doc-fingerprints")
    return prints.join(groups(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Keeps of each near-duplicate group the row with the smallest doc_id (nulls last, then by content).

    Groups are those of ``near_duplicates``: null and empty texts are one group;
    of repeated rows one stays; unrelated texts under one doc_id, or without one,
    are groups of their own. All columns stay, whatever their names, but for names
    that begin with _llm_, which are refused; an empty table gives no rows.
    """
    unreserved(docs)
    hashable = [name for name, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    named = docs.withColumn("_llm_row", F.xxhash64(*(docs[name] for name in hashable)))
    prints = materialize(fingerprints(named, shingle, ["doc_id", "_llm_row"]), "doc-fingerprints")
    grouped = prints.join(groups(prints), "fp")
    kept = grouped.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_llm_row")).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("_llm_id"), F.col("kept._llm_row").alias("_llm_kept"))
    found = named.join(kept, (named["_llm_row"] == kept["_llm_kept"]) & named["doc_id"].eqNullSafe(kept["_llm_id"]), "left_semi")
    return found.dropDuplicates(["doc_id", "_llm_row"]).select(*docs.columns)
