"""Consistency rules of summary documents (VER-6).

A document is one row, and every rule is evaluated inside it: no shuffle, any number of
documents in one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions.json import parse_document
from eventflow.session import work_dir
from eventflow.sources.large_json import element_value

# The rules in the order in which they are applied. Rules 6 to 10 run element
# by element, so among them the element's position comes before the rule's number.
RULES = {
    1: "file exists",
    2: "document parses",
    3: "top level is an object",
    4: "required fields present",
    5: "scenarios is an array",
    6: "element is an object",
    7: "id is a string",
    8: "id is unique",
    9: "passed is a boolean",
    10: "elapsed_ms is an integer",
    11: "scenarios_passed is the number of passed runs",
    12: "penalty_ms is the time of the failed runs",
}
REQUIRED = ("scenarios_passed", "scenarios_total", "penalty_ms", "scenarios")
LONG_INTEGERS = r"^DECIMAL\((19|2[0-9]|3[0-8]),0\)$"
ELEMENT = ("id", "passed", "elapsed_ms")


def all_violations(documents: DataFrame) -> DataFrame:
    """Every violation of each document, one row each.

    ``documents`` has columns ``submission`` and ``text``, a null text being a missing file.
    Returns submission, position (of the element, null for rules on the whole document),
    rule, detail, stated (the value in the document) and computed (what it should be, for
    rules that compute one). A document that cannot be read that far has the one violation
    that stops the reading. Documents are read as variants: plain JSON inference would turn a
    ``passed`` of mixed types into strings and hide the violation.
    """
    # From a plain explode the optimiser infers a filter on the number of violations, and moves it to
    # the texts: every expression would be written out, and worked out, for each of its uses.
    each = _judged(documents).select("submission", F.explode_outer(F.sort_array("violations")).alias("v"))
    return each.where(F.col("v").isNotNull()).select(
        "submission", "v.position", "v.rule", _described(F.col("v.rule")).alias("detail"), "v.stated", "v.computed"
    )


def first_violations(documents: DataFrame) -> DataFrame:
    """``rule`` and element ``position`` of each document's first violation, nulls if valid."""
    first = F.array_min("violations")
    judged = _judged(documents).select("submission", first.alias("v"))
    return judged.select(
        "submission", "v.rule", "v.position", _described(F.col("v.rule")).alias("detail"), F.col("v").isNull().alias("valid")
    )


def _described(rule: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in RULES.items() for x in pair])
    return F.when(rule.isNotNull(), F.element_at(names, rule))


def _violation(rule: int | Column, position: Column | None = None, stated: Column | None = None, computed: Column | None = None) -> Column:
    """Ordered as violations are found: what stops the reading, elements by position, totals."""
    rule = F.lit(rule) if isinstance(rule, int) else rule
    place = F.lit(None).cast("int") if position is None else position
    text = F.lit(None).cast("string")
    stage = F.when(rule <= 5, 0).when(rule <= 10, 1).otherwise(2)
    return F.struct(
        stage.alias("stage"), F.coalesce(place, F.lit(-1)).alias("at"), rule.alias("rule"), place.alias("position"),
        (text if stated is None else stated).alias("stated"), (text if computed is None else computed).alias("computed"),
    )


def _text(v: Column) -> Column:
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def _judged(documents: DataFrame) -> DataFrame:
    """``submission`` and the array of its violations, in no order.

    The kind of a value is asked for where it is small: that of a document would describe all of it.
    """
    parsed = documents.select("submission", "text", parse_document(F.col("text")).alias("doc"))
    found = _top_level(parsed)
    elements = F.try_variant_get("scenarios", "$", f"array<{_struct(ELEMENT)}>")
    facts = found.withColumn("members", elements).withColumn(
        "elements", F.transform(F.coalesce("members", F.array().cast(f"array<{_struct(ELEMENT)}>")), _facts)
    )
    # Few elements are wrong; only of these is it told how.
    wrong = F.filter("elements", lambda e: ~(e["is_object"] & e["id"].isNotNull() & e["passed"].isNotNull() & e["elapsed_ms"].isNotNull()))
    kinds = F.try_variant_get("scenarios", "$", "array<variant>")
    each = F.flatten(F.transform(wrong, lambda e: _element_violations(e, _kind(F.get(kinds, e["position"])), _raw_text)))
    passed = F.size(F.filter("elements", lambda e: e["passed"]))
    judged = facts.withColumns({"penalty": _penalty(), "passed": passed, "stop": _stop(F.col("members").isNotNull())}).withColumn(
        "violations",
        F.when(F.col("stop").isNotNull(), F.array("stop")).otherwise(F.concat(each, _second_uses(), _totals(F.col("passed"), F.col("penalty")))),
    )
    return judged.select("submission", "violations")


def _struct(names: tuple[str, ...]) -> str:
    return f"struct<{','.join(f'{name}:variant' for name in names)}>"


def _top_level(parsed: DataFrame) -> DataFrame:
    """What rules 1 to 5 look at; all required members are looked up at once."""
    top = F.try_variant_get("doc", "$", _struct(REQUIRED))
    found = parsed.select("submission", "text", F.col("doc").isNull().alias("unreadable"), top.alias("top"))
    return found.select(
        "submission", "text", "unreadable", F.col("top").isNotNull().alias("is_object"), *[F.col("top")[name].alias(name) for name in REQUIRED]
    )


def _stop(is_array: Column) -> Column:
    """The violation that stops the reading of a document, rules 1 to 5."""
    lacking = reduce(Column.__or__, [F.col(name).isNull() for name in REQUIRED])
    missing = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED]))
    return (
        F.when(F.col("text").isNull(), _violation(1))
        .when(F.col("unreadable"), _violation(2))
        .when(~F.col("is_object"), _violation(3))
        .when(lacking, _violation(4, stated=F.concat(F.lit("missing: "), F.array_join(missing, ", "))))
        .when(~is_array, _violation(5, stated=_kind(F.col("scenarios"))))
    )


def _totals(passed: Column, penalty: Column) -> Column:
    """Rules 11 and 12."""
    return F.array_compact(F.array(
        F.when(~_states("scenarios_passed", passed), _violation(11, stated=_text(F.col("scenarios_passed")), computed=passed.cast("string"))),
        F.when(~_states("penalty_ms", penalty), _violation(12, stated=_text(F.col("penalty_ms")), computed=penalty.cast("string"))),
    ))


def large_violations(documents: DataFrame, elements: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """``all_violations`` of documents of any size, as ``read_large_documents`` gives them.

    A document's elements are rows of many tasks: rules on one element look at its row, the
    others at sums and first positions per id, which combine on the map side. ``expected``
    (column ``document``) adds those that should be there and are not. ``submission`` is the
    document. The kind of a large part, where that is stated, is the one of its outline.
    """
    blank = F.col("text").rlike(r"^[\x20\x09\x0A\x0D]*$")
    value = element_value(F.col("text"), F.col("bracket"))
    path = work_dir(documents.sparkSession, "json-elements")
    position = (F.col("number") - F.col("part")).cast("int")
    facts = elements.withColumn("value", value).withColumn("f", _facts(F.try_variant_get("value", "$", _struct(ELEMENT)), position))
    f = F.col("f")
    told = F.struct(
        *[f[name].alias(name) for name in ("position", "is_object", *ELEMENT)],
        F.when(~f["is_object"], _kind(F.col("value"))).alias("kind"),
        *[F.when(f[name].isNull(), _text(f[f"{name}_raw"])).alias(f"{name}_text") for name in ELEMENT],
    )
    facts.select(
        F.col("document").alias("submission"), "part", blank.alias("blank"), F.col("value").isNull().alias("unreadable"),
        F.when(F.col("value").isNotNull(), told).alias("e"),
    ).write.parquet(path)
    rows = documents.sparkSession.read.parquet(path)

    parts = rows.groupBy("submission", "part").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("blank").alias("blanks"), F.count_if(F.col("unreadable") & ~F.col("blank")).alias("faults")
    )
    # An empty part has one element of blanks; nowhere else may there be one.
    broken = parts.groupBy("submission").agg(
        F.bool_or((F.col("faults") > 0) | ((F.col("blanks") > 0) & (F.col("n") > 1))).alias("broken")
    )
    texts = documents.select(F.col("document").alias("submission"), "readable", F.coalesce("outline", F.lit("")).alias("text"))
    if expected is not None:
        names = expected.select(F.col("document").alias("submission")).distinct()
        texts = names.join(texts, "submission", "full_outer")
    # A row per document, small enough to be joined by broadcasting, read more than once.
    whole = work_dir(documents.sparkSession, "json-outlines")
    texts.join(broken, "submission", "left").select(
        "submission", "text", (F.col("readable") & ~F.coalesce("broken", F.lit(False))).alias("readable")
    ).write.parquet(whole)
    read = documents.sparkSession.read.parquet(whole).select(
        "submission", "text", F.when(F.col("readable"), parse_document(F.col("text"))).alias("doc")
    )
    is_array = F.coalesce(_kind(F.col("scenarios")).startswith("ARRAY"), F.lit(False))
    outlines = _top_level(read).withColumn("stop", _stop(is_array))
    checked = outlines.where(F.col("stop").isNull()).select(
        "submission", F.try_variant_get("scenarios", "$[0]", "bigint").alias("part")
    )
    runs = rows.where(~F.col("blank")).join(checked, ["submission", "part"]).select("submission", "e")

    ids = runs.where(F.col("e.id").isNotNull()).select("submission", F.col("e.id").alias("id"), F.col("e.position").alias("position"))
    used = ids.groupBy("submission", "id").agg(F.min("position").alias("earliest"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    again = ids.join(used, ["submission", "id"]).where(F.col("position") > F.col("earliest"))
    sums = runs.groupBy("submission").agg(
        F.count_if("e.passed").alias("passed"),
        F.sum(F.when(~F.col("e.passed"), F.coalesce("e.elapsed_ms", F.lit(0).cast("decimal(38,0)")))).alias("penalty"),
    )
    none = F.lit(0).cast("decimal(38,0)")
    summed = outlines.where(F.col("stop").isNull()).join(sums, "submission", "left").withColumns({
        "passed": F.coalesce("passed", F.lit(0)), "penalty": F.coalesce(F.col("penalty").cast("decimal(38,0)"), none),
    })
    found = [
        outlines.where(F.col("stop").isNotNull()).select("submission", F.col("stop").alias("v")),
        runs.select("submission", F.explode(_element_violations(F.col("e"), F.col("e.kind"), _kept_text)).alias("v")),
        again.select("submission", _violation(8, F.col("position"), F.col("id")).alias("v")),
        summed.select("submission", F.explode(_totals(F.col("passed"), F.col("penalty"))).alias("v")),
    ]
    violations = reduce(DataFrame.unionByName, found)
    return violations.select(
        "submission", "v.position", "v.rule", _described(F.col("v.rule")).alias("detail"), "v.stated", "v.computed"
    )


def _facts(e: Column, position: Column) -> Column:
    """An element's members as typed values, null where the type is wrong, and as they are. ``e`` is null if it is no object."""
    none = F.lit(0).cast("decimal(38,0)")
    return F.struct(
        position.alias("position"),
        e.isNotNull().alias("is_object"),
        F.when(_kind(e["id"]) == "STRING", F.try_variant_get(e["id"], "$", "string")).alias("id"),
        F.when(_kind(e["passed"]) == "BOOLEAN", F.try_variant_get(e["passed"], "$", "boolean")).alias("passed"),
        # A missing time counts as 0, a null or any other type is a violation.
        F.when(e["elapsed_ms"].isNull(), none)
        .when(_is_integer(e["elapsed_ms"]), F.try_variant_get(e["elapsed_ms"], "$", "decimal(38,0)"))
        .alias("elapsed_ms"),
        *[e[name].alias(f"{name}_raw") for name in ELEMENT],
    )


def _raw_text(e: Column, name: str) -> Column:
    return _text(e[f"{name}_raw"])


def _kept_text(e: Column, name: str) -> Column:
    return e[f"{name}_text"]


def _element_violations(e: Column, kind: Column, text: Callable[[Column, str], Column]) -> Column:
    at = e["position"]
    own = F.array_compact(F.array(*[
        F.when(e[name].isNull(), _violation(rule, at, text(e, name))) for rule, name in ((7, "id"), (9, "passed"), (10, "elapsed_ms"))
    ]))
    return F.when(e["is_object"], own).otherwise(F.array(_violation(6, at, kind)))


def _second_uses() -> Column:
    """Rule 8 at every position whose id an earlier element has: neighbours after sorting by id.

    The sorted array is bound once, as the only element of an array that is transformed. Where
    no id is repeated, which is told without sorting, it is empty.
    """
    ids = F.filter(F.transform("elements", lambda e: e["id"]), lambda i: i.isNotNull())
    all_used = F.filter("elements", lambda e: e["id"].isNotNull())
    used = F.when(F.size(F.array_distinct(ids)) < F.size(ids), all_used).otherwise(F.slice("elements", 1, 0))
    by_id = F.sort_array(F.transform(used, lambda e: F.struct(e["id"].alias("id"), e["position"].alias("position"))))

    def repeated(ids: Column) -> Column:
        following = F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))
        pairs = F.arrays_zip(ids.alias("a"), following.alias("b"))
        again = F.filter(pairs, lambda p: p["a"]["id"] == p["b"]["id"])
        return F.transform(again, lambda p: _violation(8, p["b"]["position"], p["b"]["id"]))

    return F.element_at(F.transform(F.array(by_id), repeated), 1)


def _penalty() -> Column:
    return F.aggregate(
        F.filter("elements", lambda e: ~e["passed"]),
        F.lit(0).cast("decimal(38,0)"),
        lambda total, e: (total + F.coalesce(e["elapsed_ms"], F.lit(0))).cast("decimal(38,0)"),
    )


def _states(field: str, actual: Column) -> Column:
    """Whether the document states this integer."""
    stated = F.try_variant_get(F.col(field), "$", "decimal(38,0)")
    return F.coalesce(_is_integer(F.col(field)) & (stated == actual), F.lit(False))


def _is_integer(v: Column) -> Column:
    kind = _kind(v)
    return (kind == "BIGINT") | kind.rlike(LONG_INTEGERS)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)
