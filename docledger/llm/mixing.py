"""Mixing sources to target weights, by DataFrame functions alone.

Sizes (words) are summed by source; sources in code point order, null last, get the weights in turn and share
the whole; a source's target is at most `cap` times its size, and the excess is shared again by weight
until none is above.  A document is emitted floor(rate) times, rate = target / size of its source, plus
one more time with probability equal to the fraction: where the hash of its id and of `seed` is below it, one draw a
document.  So a source's words come near its target as far as chance has it: the fewer and the more unequal its
documents, the less near.

Null text: size 0.  Null source: a source of its own.  Null id: hashed as the empty text.  Repeated rows
draw alike and are emitted each.  A source of size 0: rate 0.  Empty tables: an empty result.

Scale: the only wide data are documents, read twice and never shuffled where the table of sources is small
(its row count is checked against `broadcast_sources`; beyond it documents meet their source's rate in one of `SALT`
shares, so that a source with a third of all rows is no single task).  The ranking of sources is a range sort with
per-partition offsets; levelling is a few sums over that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.llm.shared import WORD, written


def n_words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


#: Shares that a source's documents are dealt into where the sources are too many to broadcast.
SALT = 64


def draw(id_col: str, seed: int) -> Column:
    """A number in [0, 1) from the id and a seed."""
    text = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"#{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def ranked(sources: DataFrame) -> DataFrame:
    """The rows with rank, 0 up: a range sort, then each partition's rows after those of the partitions before."""
    ordered = sources.orderBy(F.col("source").isNull(), "source")
    # The id's upper bits are the partition's number, its lower 33 bits the row's place in it.
    ordered = written(ordered.withColumn("at", F.monotonically_increasing_id()), "ranked").withColumn("part", F.shiftright("at", 33))
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    others = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    before = counts.select("part", F.coalesce(F.sum("n").over(others), F.lit(0)).alias("before"))
    return ordered.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("at") - F.shiftleft(F.col("part"), 33)).drop("part", "at", "before")


def targets(sources: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """source, source_size, target: weighted shares of the whole, levelled under cap times the source's size."""
    turn = F.pmod("rank", F.lit(len(weights))).cast("int")
    table = written(ranked(sources).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double")), "weighted")
    most = F.col("source_size") * F.lit(float(cap))
    level = 0.0
    while True:  # the level only rises; a source once at its cap stays there
        full = F.col("weight") * F.lit(level) >= most if level else F.lit(False)
        row = table.agg(F.sum("source_size").alias("all"), F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)).alias("held"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        if not row["all"] or not row.open:
            break
        new = (row["all"] - row.held) / row.open
        if new <= level * (1 + 1e-12):
            break
        level = new
    return table.select("source", "source_size", F.least(F.col("weight") * F.lit(level), most).alias("target"))


def mixed_copies(documents: DataFrame, weights=(1, 2, 3), cap=3, id_col="doc_id", text_col="text", source_col="source", seed=0, broadcast_sources=100_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, size, source_size, target, copies, and the columns to carry; a row for each row."""
    docs = documents.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), n_words(text_col).alias("_size"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    sizes = written(docs.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size")), "sources")
    aim = targets(sizes, tuple(weights), cap)
    rate = F.least(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0), F.lit(float(cap)))
    rated = written(aim.select("source", "source_size", "target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("part")), "rates")
    same = (F.coalesce("_source", F.lit("")) == F.coalesce("source", F.lit(""))) & (F.col("_source").isNull() == F.col("source").isNull())
    if rated.count() <= broadcast_sources:
        out = docs.join(F.broadcast(rated), same, "left")
    else:
        shares = rated.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        out = docs.withColumn("_a", F.pmod(F.xxhash64("_id", "_size"), F.lit(SALT)).cast("int")).join(shares, same & (F.col("_a") == F.col("_b")), "left")
    copies = (F.col("whole") + F.when(draw("_id", seed) < F.col("part"), 1).otherwise(0)).cast("int")
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"), *[F.col(f"_c_{c}") for c in carry])


def mix(documents: DataFrame, **options) -> DataFrame:
    """The documents, whole rows, each as often as the mix takes it."""
    names = documents.columns
    out = mixed_copies(documents, carry=tuple(names), **options).where("copies > 0")
    again = out.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select(*[F.col(f"_c_{c}").alias(c) for c in names])
