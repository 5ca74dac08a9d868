"""Mixing sources to target weights, in DataFrame expressions only.

Sizes are summed per source and the targets follow from them in closed form: with the sources in
ascending order of ceiling / weight, a source stands at its ceiling exactly if all targets at its
own ratio together don't exceed the budget, which running sums over the sorted sources tell. The
excess of those at their ceilings thereby goes to the others by weight. A source's rate is
target / size; each document is emitted floor(rate) times, and once more if a hash of its id, as
a number in [0, 1), is below the fraction.

Documents never move for this: each task adds up its own documents per source, so a source that
holds a third of all rows is one row a task, and the rates come to the documents by a join whose
small side is broadcast only after its bytes were summed; beyond that Spark shuffles, and splits
the hot sources' partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed

#: Weights of the sources in their order (repeating), the share of all sizes that
#: the mix takes as a fraction, and the ceiling of a source as a multiple of its size.
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)
CEILING = 2
#: Bytes of source names and rates that are broadcast; beyond them both sides are shuffled.
BROADCAST_BYTES = 32 << 20
#: Words are maximal runs of all but ASCII white space; possessive, so runs are never tried twice.
WORD = r"[^\x20\x09-\x0D]++"
_WHOLE = "decimal(38,0)"


def n_words(text: str | Column) -> Column:
    """Words of a text; null and empty texts have none. Runs become one letter each and the white
    space goes, so no array of a very long text's words is made."""
    c = F.col(text) if isinstance(text, str) else text
    runs = F.regexp_replace(F.coalesce(c, F.lit("")), WORD, "w")
    return F.length(F.translate(runs, " \t\n\x0b\x0c\r", "")).cast("long")


def running(df: DataFrame, order: Sequence[Column], totals: dict[str, Column], mark: str = "__part") -> DataFrame:
    """``df`` with running totals (each row included) in the given order over the whole frame.

    Rows are dealt in ranges of the order, each range adds up on its own, and only one row a range
    is summed over all ranges. The dealt rows are checkpointed, as their ranges come from a sample.
    Rows equal in ``order`` follow each other in any order.
    """
    dealt = checkpointed(df.repartitionByRange(*order).withColumn(mark, F.spark_partition_id()))
    sums = dealt.groupBy(mark).agg(*[F.sum(c).alias(f"{n}__before") for n, c in totals.items()])
    earlier = Window.orderBy(mark).rowsBetween(Window.unboundedPreceding, -1)
    before = F.broadcast(sums.select(F.col(mark), *[  # one row a range
        F.coalesce(F.sum(f"{n}__before").over(earlier), F.lit(0)).alias(f"{n}__before") for n in totals]))
    own = Window.partitionBy(mark).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (dealt.join(before, mark)
            .select(*df.columns, *[(F.col(f"{n}__before") + F.sum(c).over(own)).alias(n) for n, c in totals.items()]))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE,
            ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, target, rate) from one row a source (source, source_size).

    Sources weigh by their place in code point order, null last. Sums and comparisons are of
    whole numbers (decimals), so that neither rounding nor the order of additions matters.
    """
    up, down = share
    common = math.lcm(*weights)
    ranked = running(sizes, [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")
    pick = lambda values: F.get(F.array(*[F.lit(v).cast(_WHOLE) for v in values]), turn)
    weighed = ranked.select("source", F.col("source_size").cast(_WHOLE).alias("size"), pick(weights).alias("weight"),
                            pick([common // w for w in weights]).alias("inverse"))
    most = F.col("size") * ceiling
    # Ascending ceiling / weight, as a whole number.
    ordered = running(weighed, [(F.col("size") * F.col("inverse")).asc(), F.col("source").asc_nulls_last()],
                      {"most_upto": most, "weight_upto": F.col("weight")})
    all_size, all_weight = (F.lit(x).cast(_WHOLE) for x in ordered.agg(F.sum("size"), F.sum("weight")).first())
    # At this source's own ratio: the ceilings of those before it, and that ratio for it and all after.
    before, after = F.col("most_upto") - most, all_weight - F.col("weight_upto") + F.col("weight")
    capped = (F.col("weight") * before + most * after) * down <= F.col("weight") * all_size * up
    ordered = ordered.withColumn("capped", capped)
    gone, left = (F.lit(x).cast(_WHOLE) for x in ordered.agg(
        F.sum(F.when(F.col("capped"), most).otherwise(0)), F.sum(F.when(~F.col("capped"), F.col("weight")))).first())
    level = (F.col("weight") * (all_size * up - gone * down)).cast("double") / (left * down).cast("double")
    target = F.when(F.col("capped"), most.cast("double")).otherwise(level)
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("size").cast("double")).otherwise(F.lit(0.0))
    return (ordered.withColumn("target", target)
            .select("source", F.col("size").cast("long").alias("source_size"), "target", rate.alias("rate")))


def draw(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the parts alone: 52 bits of an MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def planned(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0,
            weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, ceiling: int = CEILING) -> DataFrame:
    """``docs`` (as the struct column ``doc``) with ``size``, ``source_size``, ``target``, ``rate``
    and ``copies``: how often the mix takes the document.

    Null and empty texts have size 0; rows without a source are a source of their own, the last;
    an empty table gives an empty one. Rows that share an id share their draw, so each of them
    counts, taken together or left together; a null id draws by its text. Other
    columns, whatever their names, stay inside ``doc``.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("size"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = checkpointed(targets(sizes, weights, share, ceiling))
    weight = rates.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64)).first()[0] or 0
    small = F.broadcast(rates) if weight <= BROADCAST_BYTES else rates
    side = small.withColumnRenamed("source", "rated")
    key = F.when(F.col(f"doc.`{id_col}`").isNull(), F.col(f"doc.`{text}`")).otherwise(F.lit(""))
    extra = draw(seed, F.col(f"doc.`{id_col}`"), key) < F.col("rate") - F.floor("rate")
    return (rows.join(side, F.col("source").eqNullSafe(F.col("rated")))
            .withColumn("copies", F.floor("rate").cast("long") + extra.cast("long"))
            .select("doc", "size", "source_size", "target", "rate", "copies"))


def mix(docs: DataFrame, copy_col: str = "copy", **how) -> DataFrame:
    """The mixed documents: each with its columns as often as :func:`planned` says, and which copy
    (from 1) the row is in ``copy_col``, which takes the place of a column of that name."""
    taken = planned(docs, **how).filter("copies > 0")
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c != copy_col]
    return taken.select(*kept, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy_col))
