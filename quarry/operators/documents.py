"""Q1 for nested documents: a declared shape compiled to expressions over VARIANT values.

A shape says what a JSON value must be: ``Num``, ``Text``, ``Flag``, ``Rec`` (an object with
required and optional fields), ``Many`` (an array) or ``Either`` of several shapes. JSON types
count, so ``"5"`` is no number. :func:`problems` turns a shape into one expression that lists every
rule a document breaks; array items are judged inside their array, so no document is exploded,
shuffled or read twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Num:
    """A JSON number, within bounds (inclusive)."""
    least: float | None = None
    most: float | None = None


@dataclass(frozen=True)
class Text:
    """A JSON string that a pattern finds, of at least so many characters."""
    pattern: str | None = None
    shortest: int = 0


@dataclass(frozen=True)
class Flag:
    """A JSON boolean."""


@dataclass(frozen=True)
class Rec:
    """A JSON object: fields that must be there, and fields that are judged if they are."""
    required: Mapping[str, Shape]
    optional: Mapping[str, Shape] = field(default_factory=dict)

    def fields(self) -> dict[str, Shape]:
        return {**self.required, **self.optional}


@dataclass(frozen=True)
class Many:
    """A JSON array of at least so many items, each of one shape."""
    item: Shape
    fewest: int = 0


@dataclass(frozen=True)
class Either:
    """A value that fits one of several shapes."""
    shapes: tuple[Shape, ...]


Shape = Num | Text | Flag | Rec | Many | Either


def rule_names(shape: Shape, path: str = "") -> Iterator[str]:
    """Every rule of a shape, in its order, as :func:`problems` names them."""
    if isinstance(shape, Either):
        yield f"{path} fits"
        return
    yield f"{path} type"
    if isinstance(shape, Num):
        yield from [f"{path} {n}" for n, v in (("least", shape.least), ("most", shape.most)) if v is not None]
    elif isinstance(shape, Text):
        yield from [f"{path} {n}" for n, v in (("shortest", shape.shortest), ("pattern", shape.pattern)) if v]
    elif isinstance(shape, Many):
        yield from [f"{path} fewest"] if shape.fewest else []
        yield from rule_names(shape.item, f"{path}[]")
    elif isinstance(shape, Rec):
        for name, inner in shape.fields().items():
            below = f"{path}.{name}" if path else name
            if name in shape.required:
                yield f"{below} required"
            yield from rule_names(inner, below)


_NONE = "array<string>"


def _first(*cases: tuple[Column, str]) -> Column:
    """The name of the first case that holds, in an array; no case, an empty array."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for test, name in cases:
        out = out.when(F.coalesce(test, F.lit(False)), F.lit(name))
    return F.array_compact(F.array(out))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def problems(shape: Shape, value: Column, path: str = "") -> Column:
    """The rules that a value (VARIANT, there) breaks, as array<string>; a rule that several items
    of an array break is there once for each."""
    kind = F.schema_of_variant(value)
    if isinstance(shape, Either):
        bad = F.lit(True)
        for one in shape.shapes:
            bad = bad & (F.size(problems(one, value, path)) > 0)
        return _first((bad, f"{path} fits"))
    if isinstance(shape, Num):
        number = F.try_variant_get(value, "$", "double")
        cases = [(~(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")), f"{path} type")]
        if shape.least is not None:
            cases.append((number < F.lit(float(shape.least)), f"{path} least"))
        if shape.most is not None:
            cases.append((number > F.lit(float(shape.most)), f"{path} most"))
        return _first(*cases)
    if isinstance(shape, Text):
        text = F.try_variant_get(value, "$", "string")
        cases = [(kind != "STRING", f"{path} type")]
        if shape.shortest:
            cases.append((F.length(text) < shape.shortest, f"{path} shortest"))
        if shape.pattern:
            cases.append((~text.rlike(shape.pattern), f"{path} pattern"))
        return _first(*cases)
    if isinstance(shape, Flag):
        return _first((kind != "BOOLEAN", f"{path} type"))
    if isinstance(shape, Many):
        def judge_items(items: Column) -> Column:
            own = _first((items.isNull(), f"{path} type"), (F.size(items) < shape.fewest, f"{path} fewest"))
            below = F.flatten(F.transform(items, lambda x: problems(shape.item, x, f"{path}[]")))
            return F.concat(own, F.coalesce(below, F.array().cast(_NONE)))

        return _once(F.try_variant_get(value, "$", "array<variant>"), judge_items)
    fields = {n: F.try_variant_get(value, f"$['{n}']", "variant").alias(f"f{i}") for i, n in enumerate(shape.fields())}
    there = F.lit(False)
    for child in fields.values():
        there = there | child.isNotNull()
    is_rec = there | F.try_variant_get(value, "$", "map<string,variant>").isNotNull()

    def judge(rec: Column) -> Column:
        parts = [_first((~rec["is_rec"], f"{path} type"))]
        for i, (name, inner) in enumerate(shape.fields().items()):
            below, child = f"{path}.{name}" if path else name, rec[f"f{i}"]
            missing = _first((rec["is_rec"] & child.isNull(), f"{below} required")) if name in shape.required else F.array().cast(_NONE)
            parts.append(F.when(child.isNull(), missing).otherwise(problems(inner, child, below)))
        return F.concat(*parts)

    return _once(F.struct(*fields.values(), is_rec.alias("is_rec")), judge)


def read_documents(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """(value string, doc variant): JSON documents, one a line, or one a file with ``multi_line``
    (a pretty-printed file is one document, hence one task). What isn't JSON has a null ``doc``."""
    text = spark.read.text(path, wholetext=multi_line).filter(F.col("value").rlike(r"\S"))
    return text.select("*", F.try_parse_json("value").alias("doc"))


def judged(docs: DataFrame, shape: Shape, doc: str = "doc", out: str = "violations") -> DataFrame:
    """``docs`` with the rules each document breaks; one that isn't JSON breaks ``json``."""
    return docs.withColumn(out, F.when(F.col(doc).isNull(), F.array(F.lit("json")))
                           .otherwise(problems(shape, F.col(doc))))


def rule_counts(tagged: DataFrame, shape: Shape, violations: str = "violations") -> DataFrame:
    """(rule, violations, documents) for every rule of the shape, zeros included: how often it is
    broken, and in how many documents."""
    # explode_outer, as a filter on the violations would be pushed below them and judge every document twice
    found = (tagged.select(F.col(violations).alias("v"))
             .select(F.explode_outer(F.transform(F.array_distinct("v"), lambda r: F.struct(
                 r.alias("rule"), F.size(F.filter("v", lambda x: x == r)).cast("long").alias("n")))).alias("e"))
             .filter("e IS NOT NULL").groupBy("e.rule").agg(F.sum("e.n").alias("n"), F.count(F.lit(1)).alias("d")))
    names = tagged.sparkSession.createDataFrame([(n,) for n in ["json", *rule_names(shape)]], "rule string")
    zero = F.lit(0).cast("long")
    return (F.broadcast(names).join(found, "rule", "left")  # the shape's rules
            .select("rule", F.coalesce("n", zero).alias("violations"), F.coalesce("d", zero).alias("documents")))


def assert_documents(tagged: DataFrame, shape: Shape, violations: str = "violations") -> None:
    """Raises if any document breaks any rule (the source's behaviour)."""
    bad = rule_counts(tagged, shape, violations).filter("violations > 0").collect()  # the shape's rules
    if bad:
        raise ValueError("schema validation failed: " + ", ".join(f"{r.rule}={r.violations}" for r in bad))
