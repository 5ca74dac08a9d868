"""S4, second half: CSV records whose quoted fields span lines, from splittable files.

A line alone doesn't tell whether it begins inside a quoted field, but it tells what it does to
either state: the state behind it is fixed, kept or swapped. These effects compose, so each split
adds up its own lines, one row a split is added up per file, and every line then knows the state it
begins in. Lines that neither begin nor end inside a field are records already; only the others
are grouped and put together, also across the edges of splits. Nothing reads a file in one task.

Quoting follows the usual CSV readers: a quote opens a field only at its start, ``""`` inside a
quoted field stands for a quote, and a quote further inside an unquoted field is plain text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.semantics import NA_TOKENS, na_to_null

# One field, closed: quoted (plain text may follow the closing quote), unquoted, or empty. All
# loops are possessive, so a line of any length is matched in one pass without recursion.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_CLOSED = rf"\A{_FIELD}(?:,{_FIELD})*+\z"
_CLOSED_LATER = rf'\A[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+\z'

#: Bytes that one record may hold: beyond them a stray quote is likelier than a field.
MAX_RECORD_BYTES = 64 << 20


def line_effect(line: Column) -> tuple[Column, Column]:
    """What a line does to the state (0 outside, 1 inside a quoted field): (the state it leaves
    whatever it met, else null; whether it swaps the state, 0 or 1)."""
    quoted = line.contains('"')
    after_out = F.when(quoted, (~line.rlike(_CLOSED)).cast("int")).otherwise(F.lit(0))
    after_in = F.when(quoted, (~line.rlike(_CLOSED_LATER)).cast("int")).otherwise(F.lit(1))
    return (F.when(after_out == after_in, after_out),
            ((after_out == 1) & (after_in == 0)).cast("int"))


def _state_before(df: DataFrame, keys: Sequence[str], order: str, fixed: str, swap: str) -> DataFrame:
    """Adds what the rows before a row (of its keys, in order) do together: ``told`` (the state
    they leave, if some row fixes it, else null) and ``swaps`` (0 or 1, where none does)."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    seen = df.withColumn("__upto", F.sum(swap).over(upto))
    last = F.last(F.when(F.col(fixed).isNotNull(), F.struct(F.col(fixed).alias("state"), F.col("__upto").alias("at"))),
                  ignorenulls=True).over(before)
    seen = seen.withColumn("__last", last)
    count = F.col("__upto") - F.col(swap)
    return (seen.withColumn("told", ((F.col("__last.state") + count - F.col("__last.at")) % 2).cast("int"))
            .withColumn("swaps", (count % 2).cast("int")).drop("__upto", "__last"))


def records(lines: DataFrame, max_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """(file, pos, line, is_header): the records of ``lines`` (the same columns, ``pos`` a struct of
    split start and place within the split), each at its first line's place, its lines joined by
    a newline.

    A file that ends inside a quoted field, or a record of over ``max_bytes``, raises when the
    records are read, as the text behind a stray quote can't be told from a field.
    """
    split = F.col("pos").getField(lines.schema["pos"].dataType.names[0])
    place = F.col("pos").getField(lines.schema["pos"].dataType.names[1])
    fixed, swap = line_effect(F.col("line"))
    rows = lines.select("file", split.alias("split"), place.alias("place"), "line", "is_header",
                        fixed.alias("fixed"), swap.alias("swap"))
    rows = _state_before(rows, ["file", "split"], "place", "fixed", "swap")
    # What a whole split does, and so the state each split begins in.
    after = F.struct(F.coalesce("fixed", (F.col("told") + F.col("swap")) % 2).alias("fixed"),
                     ((F.col("swaps") + F.col("swap")) % 2).alias("swap"))
    ends = rows.groupBy("file", "split").agg(F.max_by(after, "place").alias("e")).select("file", "split", "e.*")
    enters = (_state_before(ends.withColumn("swap", F.when(F.col("fixed").isNull(), F.col("swap")).otherwise(F.lit(0))),
                            ["file"], "split", "fixed", "swap")
              .select("file", "split", F.coalesce("told", "swaps").alias("enter")))
    state = F.coalesce("told", (F.col("enter") + F.col("swaps")) % 2)
    known = (rows.join(enters, ["file", "split"]).withColumn("state", state)
             .withColumn("next", F.coalesce("fixed", (F.col("state") + F.col("swap")) % 2))
             .select("file", "split", "place", "line", "is_header", "state", "next"))
    alone = known.filter("state = 0 AND next = 0").select("file", F.struct("split", "place").alias("pos"), "line", "is_header")
    # Lines of longer records: each belongs to the last line before it that begins outside a field.
    longer = known.filter("state <> 0 OR next <> 0")
    starts = F.when(F.col("state") == 0, F.struct("split", "place"))
    own = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    longer = longer.withColumn("first", F.last(starts, ignorenulls=True).over(own))
    lasts = longer.groupBy("file", "split").agg(F.max(starts).alias("last"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("file", "split", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    longer = (longer.join(carried, ["file", "split"])
              .withColumn("pos", F.coalesce("first", "carried")).drop("first", "carried"))
    checked = longer.groupBy("file", "pos").agg(
        F.sum(F.octet_length("line") + 1).alias("size"), F.max_by("next", F.struct("split", "place")).alias("open"))
    fault = (F.when(F.col("open") != 0, F.raise_error(F.concat(F.lit("quoted field without an end in "), "file")))
             .when(F.col("size") > max_bytes, F.raise_error(F.concat(F.lit("record too long in "), "file"))))
    sound = checked.filter(fault.cast("boolean").isNull()).select("file", "pos")
    part = F.struct("split", "place", "line", "is_header")
    joined = longer.join(sound, ["file", "pos"]).groupBy("file", "pos").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return alone.unionByName(joined.select(
        "file", "pos", F.array_join("parts.line", "\n").alias("line"), F.col("parts")[0]["is_header"].alias("is_header")))


def parse_records(rows: DataFrame, names: Sequence[str], na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """(file, pos, <columns>) of record texts, every column as text with the missing-value tokens
    as null. Missing fields are null, surplus ones are dropped."""
    ddl = ", ".join("`{}` STRING".format(n.replace("`", "``")) for n in names)
    parsed = rows.select("file", "pos", F.from_csv("line", F.lit(ddl), {"escape": '"'}).alias("r"))
    return parsed.select("file", "pos", *[
        na_to_null(F.col("r").getField(n), na_tokens).alias(n) for n in names])
