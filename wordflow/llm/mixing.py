"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. A document is expected in so many copies as
its source's target asks for, more of them the longer it is: its whole copies are
certain, and what is left over is its chance of one more. Documents are ranked by
random odds divided by the odds of their chance, and each source takes them in
this order until its words are used up, so a sample has a fixed size, not an
expected one. Only DataFrame functions are used.

The rank is a whole number. Where a source's order is cut is found digit by digit
from sums per source and digit, so no task ever sorts the documents of a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordflow.llm.common import packed, unpacked, written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
# Ranks have 53 bits, row numbers 63; both are cut into digits of about 13, from the first one down.
RANK_BITS = 53
DIGITS = [("rank", shift) for shift in (40, 27, 13, 0)] + [("number", shift) for shift in (50, 37, 24, 12, 0)]
TICKET_BITS = 52
RESULTS = ["size", "source_size", "target", "taken"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ticket(identity: Column, text: Column, seed: str = SEED) -> Column:
    """A whole number of ``TICKET_BITS`` bits that follows from the row alone."""
    told = F.concat(
        F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))
    )
    return F.conv(F.substring(F.md5(told), 1, TICKET_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Sources in the order of their code points, null last, have the ``weights`` in
    turn and share the words of all. A target over ``most`` times its source stops
    there; its excess goes to the others by weight. A source stops if its limit per
    unit of weight is not more than what is left for it and all sources that stop
    later, so one pass in the order of these limits says which do.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    shares = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.select(
        "source",
        "source_size",
        (most * F.col("source_size")).cast("double").alias("limit"),
        F.get(shares, place % len(weights)).alias("weight"),
    )
    turn = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("weight").over(turn.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything).cast("double")
    judged = weighed.select("*", total.alias("total"), before.alias("before"), behind.alias("behind")).withColumn(
        "stops", F.col("limit") * F.col("behind") <= (F.col("total") - F.col("before")) * F.col("weight")
    )
    stopped = F.sum(F.when(F.col("stops"), F.col("limit")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(everything)
    share = (F.col("total") - stopped) / open_weight * F.col("weight")
    return judged.select(
        "source", "source_size", F.when(F.col("stops"), F.col("limit")).otherwise(share).alias("target")
    )


def copies_by_preference(classes: DataFrame, targets: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """``source, preference, source_size, target, whole, chance, left`` per source and preference.

    Expected copies are in proportion to the preference, ``most`` of them at most,
    and give the target: ``whole`` are certain, ``chance`` is that of one more, and
    ``left`` the words that the chances have to bring.
    """
    known = classes.join(targets, classes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    source = Window.partitionBy("source")
    falling = source.orderBy(F.col("preference").desc())
    before = F.coalesce(F.sum("words").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    preferred = F.col("words") * F.col("preference")
    judged = known.select(
        "*",
        preferred.alias("preferred"),
        before.alias("before"),
        F.sum(preferred).over(falling.rowsBetween(0, Window.unboundedFollowing)).alias("behind"),
    ).withColumn("full", (F.col("target") - most * F.col("before")) * F.col("preference") >= most * F.col("behind"))
    full_words = F.sum(F.when(F.col("full"), F.col("words")).otherwise(0)).over(source)
    open_preferred = F.sum(F.when(F.col("full"), 0).otherwise(F.col("preferred"))).over(source)
    rate = (F.col("target") - most * full_words) / F.nullif(open_preferred, F.lit(0))
    copies = F.when(F.col("full"), F.lit(float(most))).otherwise(
        F.least(F.lit(float(most)), F.coalesce(rate, F.lit(0.0)) * F.col("preference"))
    )
    dealt = judged.withColumn("copies", copies).withColumn("whole", F.floor("copies"))
    certain = F.sum(F.col("whole") * F.col("words")).over(source)
    return dealt.select(
        "source", "preference", "source_size", "target", "whole",
        (F.col("copies") - F.col("whole")).alias("chance"),
        (F.col("target") - certain).alias("left"),
    )


def pareto_rank(ticket_: Column, chance: Column) -> Column:
    """Random odds by the odds of the chance, as a whole number of ``RANK_BITS`` bits in the same order."""
    random = (ticket_ + 0.5) / float(1 << TICKET_BITS)
    odds = random / (1 - random) / (chance / (1 - chance))
    whole = F.floor(odds / (1 + odds) * float(1 << RANK_BITS))
    return F.least(whole, F.lit((1 << RANK_BITS) - 1))


def cuts(ranked: DataFrame) -> DataFrame:
    """``source, rank, number, last``: the first row of each source's order that does not fit.

    ``ranked`` has ``source, rank, number, size, left``. ``last`` says that the row
    is taken all the same, as the source comes nearer to its target with it. There
    is no row for sources whose documents all fit.
    """
    left = ranked.select("source", "rank", "number", "size", "left", F.lit(0).cast("bigint").alias("passed"))
    for name, shift in DIGITS:
        digit = F.call_function("shiftright", F.col(name), F.lit(shift))
        sums = left.groupBy("source", "left", "passed", digit.alias("digit")).agg(F.sum("size").alias("words"))
        order = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        upto = sums.withColumn("upto", F.col("passed") + F.sum("words").over(order))
        crossed = (F.col("upto") - F.col("words") <= F.col("left")) & (F.col("upto") > F.col("left"))
        cut = upto.filter(crossed).select(
            F.col("source").alias("s"), F.col("digit").alias("d"), (F.col("upto") - F.col("words")).alias("p")
        )
        inside = left.join(cut, left["source"].eqNullSafe(cut["s"]) & (digit == cut["d"]))
        left = written(inside.select("source", "rank", "number", "size", "left", F.col("p").alias("passed")), "cuts")
        rows, sources = left.agg(F.count("*"), F.count_distinct(F.struct("source"))).first()
        if rows == sources:
            break
    nearer = 2 * (F.col("left") - F.col("passed")) >= F.col("size")
    return left.select("source", "rank", "number", nearer.alias("last"))


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    carry: DataFrame | None = None,
    seed: str = SEED,
) -> DataFrame:
    """The rows with ``size, source_size, target, taken``: words of the row, its source, its source's target, the mix.

    ``taken`` is a whole number of copies of the row's words, ``most`` at most. The
    preference of a row is the number of binary digits of its words, so longer
    documents are a little likelier. The words that a source takes differ from its
    target by half a document at most. What is drawn follows from ``seed`` and the
    rows' ids and texts, so that another run takes the same.

    Null, empty and blank texts have no words and are never taken; a null source is
    a source, the last one. Rows without an id are drawn by their text; of repeated
    rows some may be taken more often than others. ``carry`` (a selection of
    ``docs``) says which columns come back, those named like results replaced. An
    empty table stays empty. A table of one row per source, and one per source and
    preference (64 at most), are all that is put in order as a whole.
    """
    carried = docs if carry is None else carry
    text = F.col(f"`{text_column}`")
    size = word_count(text)
    rows = written(
        docs.select(
            packed(carried),
            F.col(f"`{source_column}`").cast("string").alias("source"),
            size.alias("size"),
            F.length(F.bin(size)).cast("bigint").alias("preference"),
            ticket(F.col(f"`{id_column}`"), text, seed).alias("ticket"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "measured",
    )
    classes = written(rows.groupBy("source", "preference").agg(F.sum("size").alias("words")), "classes")
    sizes = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = written(copies_by_preference(classes, source_targets(sizes, weights, most), most), "plan")

    def planned(frame: DataFrame, plan: DataFrame) -> DataFrame:
        same = frame["source"].eqNullSafe(plan["source"]) & (frame["preference"] == plan["preference"])
        return frame.join(plan, same).drop(plan["source"], plan["preference"])

    drawn = planned(rows.filter("size > 0").drop("row"), plan.filter("chance > 0"))
    rank = pareto_rank(F.col("ticket"), F.col("chance"))
    cut = cuts(drawn.select("source", rank.alias("rank"), "number", "size", "left"))
    ends = cut.select(
        F.col("source").alias("s"), F.struct("rank", "number").alias("end"), F.col("last").cast("bigint").alias("last")
    )
    ended = plan.join(ends, plan["source"].eqNullSafe(ends["s"]), "left").drop("s")
    at = F.struct(rank.alias("rank"), F.col("number"))
    more = (
        F.when(F.col("chance") <= 0, 0)
        .when(F.col("end").isNull() | (at < F.col("end")), 1)
        .when(at == F.col("end"), F.col("last"))
        .otherwise(0)
    )
    taken = F.when(F.col("size") > 0, F.col("size") * (F.col("whole") + more)).otherwise(0).cast("bigint")
    made = planned(rows, written(ended, "ends")).select("row", "size", "source_size", "target", taken.alias("taken"))
    return made.select(unpacked(carried.columns, RESULTS))
