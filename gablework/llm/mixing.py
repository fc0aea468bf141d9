"""Mixing of sources to target weights by Pareto order sampling.

Targets: sources share all words by weight, none above max_copies times its size; what a source can't take is
shared again by weight. Within a source a document's expected copies are in proportion to its class (by default longer
documents are of higher classes), up to max_copies, at the rate that makes the expected words the target. The whole part
is allocated for certain. For the rest, documents are ranked by q = (u / (1 - u)) / (p / (1 - p)) with u a uniform number
from the document's hash and p the remaining expected copies, and the first in that order are taken until the source's
words come nearest to its target: a sample of fixed size in words with unequal inclusion probabilities.

The cut in a source's ranking is found by radix steps: words are summed by source and slice of the ranking, the slice
that holds the cut is kept, and it is sliced again. So no source, however large, is sorted or gathered by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gablework.llm.common import materialize

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
MAX_COPIES, WEIGHTS = 3, (1, 2, 3)
#: A document's class is its size's number of binary digits, from LEAST_CLASS to MOST_CLASS, on top of BASE_CLASS: one of thousands of
#: words is expected about twice as often as one of a few.
BASE_CLASS, LEAST_CLASS, MOST_CLASS = 8, 0, 16
#: Each radix step cuts what is left of a source's ranking into 2**BITS slices.
BITS, STEPS = 10, 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) from the md5 of the document's id, with 48 bits."""
    digits = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, max_copies: int = MAX_COPIES, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """For a table of sources (source, source_size), their targets: source, source_size, target.

    Sources in order of code points, null last, weigh weights[0], weights[1], ... and again. Each round fixes the
    sources whose share is above max_copies times their size; only totals come to the driver."""
    # Places in the order of all sources: within a range of sources, and the sources of the ranges before.
    order = F.col("source").asc_nulls_last()
    ranged = materialize(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "mix-sources")
    # One row for each range, so this window and its broadcast hold as many rows as the write had tasks.
    before = ranged.groupBy("part").agg(F.count("*").alias("k")).select(F.col("part").alias("of"), (F.sum("k").over(Window.orderBy("part")) - F.col("k")).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    at = ranged.join(F.broadcast(before), F.col("part") == F.col("of")).select("source", "source_size", weight.cast("long").alias("weight"))
    at = materialize(at, "mix-sources")
    share = F.lit(0.0)
    total = at.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n
    free, weight_sum, fixed = total, None, -1
    while True:
        capped = F.col("source_size") * max_copies < (F.lit(float(free)) * F.col("weight") / F.lit(float(weight_sum)) if weight_sum else F.lit(float("-inf")))
        got = at.agg(F.count_if(capped).alias("n"), F.sum(F.when(capped, F.col("source_size") * max_copies)).alias("cap"), F.sum(F.when(~capped, F.col("weight"))).alias("w")).first()
        free, weight_sum = total - (got.cap or 0), got.w
        share = F.lit(float(free)) * F.col("weight") / F.lit(float(weight_sum or 1))
        if got.n == fixed or not weight_sum:
            break
        fixed = got.n
    return at.select("source", "source_size", F.least(F.col("source_size") * F.lit(float(max_copies)), share).alias("target"))


def mix(docs: DataFrame, max_copies: int = MAX_COPIES, weights: tuple[int, ...] = WEIGHTS, seed: int = 0, relative: str | None = None) -> DataFrame:
    """How much of each document the mix takes: doc_id, source, size, source_size, target, copies, taken.

    relative: a column with a document's class within its source, a whole number from 1 to 64 (others count as the nearest, null as 1); by
    default by its size. Copies never exceed max_copies.
    Null texts count as empty, a null source is a source of its own, repeated rows of one doc_id and size are ranked
    alike and taken together, other columns are ignored, and an empty table gives none."""
    sized = materialize(_sized(docs, seed, relative), "mix-sizes")
    return _decide(sized, _plan(sized, max_copies, weights), max_copies).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, max_copies: int = MAX_COPIES, weights: tuple[int, ...] = WEIGHTS, seed: int = 0) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, with the columns of docs. Texts are not shuffled:
    a document's copies follow from its own hash and its source's totals and cut."""
    goal = _plan(materialize(_sized(docs, seed, None), "mix-sizes"), max_copies, weights)
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *_sized_columns(seed, None))
    decided = _decide(held, goal, max_copies)
    # Each row once for each copy.
    return decided.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def _sized_columns(seed: int, relative: str | None) -> list[Column]:
    size = words(F.col("text"))
    digits = F.length(F.bin(size)) * (size > 0).cast("int")
    own = F.coalesce(F.col(relative).cast("long"), F.lit(1)) if relative else F.lit(BASE_CLASS) + F.least(F.greatest(digits, F.lit(LEAST_CLASS)), F.lit(MOST_CLASS))
    return [F.col("doc_id"), F.col("source"), size.alias("size"), uniform(F.col("doc_id"), seed).alias("u"), F.least(F.greatest(own, F.lit(1)), F.lit(64)).cast("long").alias("own")]


def _sized(docs: DataFrame, seed: int, relative: str | None) -> DataFrame:
    return docs.select(*_sized_columns(seed, relative))


#: What documents of one source are ranked by.
_KEY = ("rank", "tie", "size")


def _ranked(sized: DataFrame, goal: DataFrame, max_copies: int) -> DataFrame:
    """With expected and certain copies and the place in the Pareto ranking, in [0, 1)."""
    # One row a source: Spark broadcasts it only while it is small.
    at = sized.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    expected = F.least(F.lit(float(max_copies)), F.col("rate") * F.col("own"))
    at = at.withColumn("expected", expected).withColumn("certain", F.floor("expected"))
    p = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), F.col("expected") - F.col("certain")))
    q = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    tie = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    return at.withColumn("rank", q / (1 + q)).withColumn("tie", tie).withColumn("extra", F.col("expected") > F.col("certain"))


def _plan(sized: DataFrame, max_copies: int, weights: tuple[int, ...]) -> DataFrame:
    """For each source: source_size, target and cut, the last place of the ranking that is taken."""
    levels = materialize(sized.groupBy("source", "own").agg(F.sum("size").alias("n")), "mix-classes")
    goal = targets(levels.groupBy("source").agg(F.sum("n").alias("source_size")), max_copies, weights)
    goal = _rated(goal, levels, max_copies)
    at = _ranked(sized, goal, max_copies)
    wanted = at.groupBy("source").agg((F.max("target") - F.sum(F.col("certain") * F.col("size"))).alias("wanted"))
    cut = _cuts(at.where("extra"), wanted)
    inner = at.where("extra").join(cut.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).where(_path(STEPS) == F.col("slice"))
    inner = inner.groupBy("source", *_KEY).agg(F.sum("size").alias("n"), F.max("before_slice").alias("before_slice"), F.max("wanted").alias("wanted"))
    order = Window.partitionBy("source").orderBy(*_KEY)
    start = F.col("before_slice") + F.sum("n").over(order) - F.col("n")
    last = inner.withColumn("takes", start + F.col("n") / 2.0 <= F.col("wanted")).groupBy("source").agg(F.max(F.when(F.col("takes"), F.struct(*_KEY))).alias("last"), F.min("rank").alias("least"))
    # If nothing in the cut's slice is taken, the cut lies just before it.
    cut = last.select(F.col("source").alias("of"), F.coalesce("last", F.struct(F.col("least").alias("rank"), F.lit(-(1 << 63)).alias("tie"), F.lit(-1).cast("long").alias("size"))).alias("cut"))
    return materialize(goal.join(cut, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"), "mix-plan")


def _rated(goal: DataFrame, levels: DataFrame, max_copies: int) -> DataFrame:
    """With each source's rate: copies expected of a document for each unit of its class, so that the words expected are the
    target though no document is above max_copies. levels: words by source and class (own), of which there are few."""
    up, down = (Window.partitionBy("of").orderBy(F.col("own").asc() if k else F.col("own").desc()) for k in (1, 0))
    at = levels.withColumnRenamed("source", "of").withColumn("above", F.sum("n").over(down) - F.col("n")).withColumn("inside", F.sum(F.col("n") * F.col("own")).over(up))
    at = goal.join(at, F.col("source").eqNullSafe(F.col("of")))
    # All classes above one are at max_copies; it is the highest one that is not above it then.
    rate = (F.col("target") - F.col("above") * F.lit(float(max_copies))) / F.col("inside")
    fits = (F.col("inside") > 0) & (rate * F.col("own") <= max_copies)
    all_full = F.max("source_size") > 0
    best = at.groupBy("of").agg(F.max(F.when(fits, F.struct("own", rate.alias("rate"))))["rate"].alias("rate"), F.when(all_full, F.lit(float(max_copies))).otherwise(0.0).alias("most"))
    rated = goal.join(best, F.col("source").eqNullSafe(F.col("of")))
    return materialize(rated.select("source", "source_size", "target", F.coalesce("rate", "most").alias("rate")), "mix-rates")


def _decide(sized: DataFrame, goal: DataFrame, max_copies: int) -> DataFrame:
    at = _ranked(sized, goal, max_copies)
    more = F.when(F.col("extra") & (F.struct(*_KEY) <= F.col("cut")), 1).otherwise(0)
    return at.withColumn("copies", F.col("certain") + more)


def _path(steps: int) -> Column:
    """The slice of the ranking, after so many radix steps, as one number."""
    return F.least(F.lit((1 << BITS * steps) - 1), F.floor(F.col("rank") * float(1 << BITS * steps)))


def _cuts(ranked: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each source, the slice that holds the cut and the words before it: source, slice, before_slice, wanted."""
    # A slice in which the running words pass the wanted ones; sources that want all end in their last slice.
    state = wanted.select("source", F.lit(0).cast("long").alias("slice"), F.lit(0).cast("long").alias("before_slice"), "wanted")
    for step in range(1, STEPS + 1):
        of = state.withColumnRenamed("source", "of")
        inside = ranked.join(of, F.col("source").eqNullSafe(F.col("of"))).where(_path(step - 1) == F.col("slice")) if step > 1 else ranked.join(of, F.col("source").eqNullSafe(F.col("of")))
        slices = inside.groupBy("source", _path(step).alias("next")).agg(F.sum("size").alias("n"), F.max("before_slice").alias("base"), F.max("wanted").alias("wanted"))
        order = Window.partitionBy("source").orderBy("next")
        running = slices.withColumn("start", F.col("base") + F.sum("n").over(order) - F.col("n"))
        # The last slice that starts at or before the wanted words holds the cut.
        state = running.where((F.col("start") <= F.col("wanted")) | (F.col("start") == F.col("base"))).groupBy("source").agg(F.max_by(F.struct("next", "start", "wanted"), "next").alias("at"))
        state = materialize(state.select("source", F.col("at.next").alias("slice"), F.col("at.start").alias("before_slice"), F.col("at.wanted").alias("wanted")), "mix-cuts")
    return state
