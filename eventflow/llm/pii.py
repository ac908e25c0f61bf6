"""Personal data: candidates from patterns, judged by boosted trees."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import stored, text_or_empty

KINDS = ["email", "ip", "card", "phone"]
# Exact rules. Each finds what its plain form finds (see the tests), in linear time: a run of
# characters is tried from its start only, and repetitions don't give back what they took.
LOCAL = "A-Za-z0-9._%+-"
EXACT = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of further candidates, which overlap with the exact ones and each other.
LOOSE = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]{{1,64}}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{{1,63}}+"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,2}[0-9]{4}){3}(?:[\x20._/-]{1,2}[0-9]{1,3})?(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])\(?[0-9]{1,4}\)?(?:[\x20.()-]{0,3}[0-9]{2,4}){2,5}+(?![0-9])",
}
MAY_HOLD = r"[0-9@]|[(\[]at[)\]]"
DOCUMENT = "document"
CONTEXT = 24
# Share of the labelled candidates that is held back for thresholds.
HELD_BACK = 4
PRECISION = 0.95
TREES, DEPTH = 10, 4
# Words before a number that say what it is.
CUES = {
    "phone_cue": r"(?i)(?:tel|phone|call|mobile|fax|cell|whatsapp)[^A-Za-z]*$",
    "card_cue": r"(?i)(?:card|visa|mastercard|amex|credit|account)[^A-Za-z]*$",
    "address_cue": r"(?i)(?:mail|contact|write|ip|host|server|address)[^A-Za-z]*$",
    "other_cue": r"(?i)(?:isbn|issn|doi|version|order|invoice|serial|token|page|no)[^A-Za-z]*$",
}


def _digits(column: str = "found") -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check; null or empty does not."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).when(d >= "5", d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2),
    )
    total = F.aggregate(each, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))
    return (F.length(digits) > 0) & (total % 10 == 0)


def octets(address: Column) -> Column:
    """Whether each part of a dotted number is at most 255, whatever zeros it begins with."""
    return F.forall(
        F.split(address, r"\."),
        lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
        & (F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255),
    )


def matches(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """All candidates of all rules with their positions, and a row for each document.

    Returns row (a number, ``row`` if that is given), doc_id, kind, exact, start, end (code points), found, left,
    right (the context). The text is read once. Pieces between matches and the matches give
    positions; these are summed up per document and rule over rows of a few dozen characters.
    """
    text = F.col("text")
    rules = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(exact).alias("exact"), F.lit(rule).alias("pattern"))
        for exact, named in ((True, EXACT), (False, LOOSE)) for kind, rule in named.items()
    ])
    document = F.array(F.struct(F.lit(DOCUMENT).alias("kind"), F.lit(True).alias("exact"), F.lit("$^").alias("pattern")))
    asked = F.when(
        text.rlike(MAY_HOLD), F.concat(document, F.filter(rules, lambda r: F.rlike(text, r["pattern"])))
    ).otherwise(document)
    number = F.monotonically_increasing_id() if row is None else row
    rows = docs.select("doc_id", text_or_empty().alias("text"), number.alias("row"))
    split = rows.select("row", "doc_id", "text", F.explode(asked).alias("rule")).select(
        "row", "doc_id", "rule.kind", "rule.exact",
        F.when(F.col("rule.kind") != DOCUMENT, F.split("text", F.col("rule.pattern"), -1)).alias("between"),
        F.when(F.col("rule.kind") != DOCUMENT, F.regexp_extract_all("text", F.col("rule.pattern"), F.lit(0))).alias("found"),
    )
    pairs = F.when(
        F.col("found").isNotNull(),
        F.arrays_zip(F.col("between"), F.col("found"), F.slice("between", 2, F.size("between")).alias("after")),
    ).otherwise(F.array(F.struct(F.lit("").alias("between"), F.lit("").alias("found"), F.lit("").alias("after"))))
    each = split.select("row", "doc_id", "kind", "exact", F.posexplode(pairs).alias("at", "pair")).select(
        "row", "doc_id", "kind", "exact", "at", F.char_length("pair.between").alias("gap"), F.col("pair.found").alias("found"),
        F.right("pair.between", F.lit(CONTEXT)).alias("left"), F.left("pair.after", F.lit(CONTEXT)).alias("right"),
    ).where(F.col("found").isNotNull())
    table = stored(each, "matches")
    order = Window.partitionBy("row", "kind", "exact").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.char_length("found")).over(order)
    placed = table.where(F.col("kind") != DOCUMENT).withColumn("end", end).withColumn(
        "start", F.col("end") - F.char_length("found")
    )
    nothing = table.where(F.col("kind") == DOCUMENT).withColumns({"start": F.lit(0).cast("bigint"), "end": F.lit(0).cast("bigint")})
    columns = ["row", "doc_id", "kind", "exact", "start", "end", "found", "left", "right"]
    return placed.select(*columns).unionByName(nothing.select(*columns))


def verified() -> Column:
    """Whether a match of an exact rule is what it looks like."""
    digits = _digits()
    return (
        F.when(F.col("kind") == "ip", octets(F.col("found")))
        .when(F.col("kind") == "card", F.length(digits).between(13, 19) & luhn(digits))
        .when(F.col("kind") == "phone", F.length(digits).between(9, 15))
        .otherwise(F.lit(True))
    )


def candidates(found: DataFrame) -> DataFrame:
    """Each different span of a document and kind once, with a label where rules give one.

    1: an exact match that is verified. 0: an exact match that is not, or a span that
    overlaps with verified data of another kind. Null: a looser form of something.
    """
    spans = found.where(F.col("kind") != DOCUMENT)
    merged = spans.groupBy("row", "doc_id", "kind", "start", "end", "found").agg(
        F.max("exact").alias("exact"), F.max("left").alias("left"), F.max("right").alias("right")
    )
    base = F.col("exact") & verified()
    judged = merged.withColumn("base", base)
    # Verified spans that a span overlaps with begin before its end and end after its start. The
    # furthest end among those that begin earlier, and the earliest start from here on, tell. Both
    # look back, the second in the order reversed: a window that looks ahead starts anew at each row.
    kind, place = F.col("kind"), ("start", "end", "kind")
    before = Window.partitionBy("row").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(*map(F.desc, place)).rowsBetween(Window.unboundedPreceding, -1)
    for other in KINDS:
        own = F.col("base") & (kind == other)
        judged = judged.withColumn(
            f"near_{other}",
            F.coalesce(F.max(F.when(own, F.col("end"))).over(before) > F.col("start"), F.lit(False))
            | F.coalesce(F.min(F.when(own, F.col("start"))).over(after) < F.col("end"), F.lit(False)),
        )
    others = F.lit(False)
    own = F.lit(False)
    for other in KINDS:
        others = others | ((kind != other) & F.col(f"near_{other}"))
        own = own | ((kind == other) & F.col(f"near_{other}"))
    label = F.when(F.col("base"), 1.0).when(F.col("exact") | others, 0.0)
    return judged.select(
        "row", "doc_id", "kind", "start", "end", "found", "left", "right", "base",
        label.alias("label"), (own | others).alias("overlaps"),
    )


def features(spans: DataFrame) -> tuple[DataFrame, list[str]]:
    """Numbers on the form of each span and on what stands beside it."""
    digits = _digits()
    before, after = F.right("left", F.lit(1)), F.left("right", F.lit(1))
    columns = {f"is_{k}": F.col("kind") == k for k in KINDS} | {
        "digits": F.length(digits),
        "characters": F.char_length("found"),
        "letters": F.char_length(F.regexp_replace("found", "[^A-Za-z]", "")),
        "different": F.size(F.array_distinct(F.split(digits, ""))),
        "groups": F.size(F.split("found", "[^0-9]+")),
        "blanks": F.char_length(F.regexp_replace("found", "[^ ]", "")),
        "brackets": F.char_length(F.regexp_replace("found", r"[^()\[\]]", "")),
        "dots": F.char_length(F.regexp_replace("found", r"[^.]", "")),
        "luhn": luhn(digits),
        "octets": F.when(F.col("kind") == "ip", octets(F.col("found"))).otherwise(F.lit(False)),
        "letter_before": before.rlike("[A-Za-z]"),
        "mark_before": before.rlike(r"[#$%/=_:.-]"),
        "letter_after": after.rlike("[A-Za-z]"),
        "mark_after": after.rlike(r"[#$%/=_:-]"),
    } | {name: F.col("left").rlike(cue) for name, cue in CUES.items()}
    return spans.withColumns({n: F.coalesce(c.cast("double"), F.lit(0.0)) for n, c in columns.items()}), list(columns)


@dataclass
class Judge:
    """Boosted trees and, per kind, the score from which a span is redacted (None: from none)."""

    trees: GBTClassificationModel | None
    thresholds: dict[str, float]


def _scored(spans: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    made, names = features(spans)
    given = VectorAssembler(inputCols=names, outputCol="features").transform(made)
    return trees.transform(given).withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction", *names
    )


def fit(spans: DataFrame) -> Judge:
    """Trees on all labelled spans but those held back by a hash, which the thresholds come from.

    Spans of equal features and label are one row with their number as its weight, so what the
    trees are fitted on grows with the different forms only.
    A kind's threshold is the least score (in hundredths) from which spans held back are
    right with ``PRECISION``. Without both labels there are no trees, and nothing is added.
    """
    labelled, names = features(spans.where(F.col("label").isNotNull()))
    held_back = (F.pmod(F.xxhash64("kind", "found", "left"), F.lit(HELD_BACK)) == 0).alias("held")
    forms = stored(
        labelled.groupBy(held_back, "kind", "label", *names).agg(F.count(F.lit(1)).cast("double").alias("n")), "labelled"
    )
    held = F.col("held")
    if forms.where(~held).select("label").distinct().count() < 2:
        return Judge(None, {})
    given = VectorAssembler(inputCols=names, outputCol="features").transform(forms)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, weightCol="n").fit(given.where(~held))
    scored = trees.transform(given.where(held)).withColumn("score", vector_to_array("probability")[1])
    # At most a hundred rows a kind.
    counts = (
        scored.groupBy("kind", F.floor(F.col("score") * 100).alias("bin"))
        .agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n"))
    )
    above = Window.partitionBy("kind").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    enough = counts.withColumns({"right": F.sum("right").over(above), "n": F.sum("n").over(above)}).where(
        (F.col("right") >= F.col("n") * PRECISION) & (F.col("bin") >= 50)
    )
    found = enough.groupBy("kind").agg((F.min("bin") / 100).alias("threshold")).collect()
    return Judge(trees, {r.kind: r.threshold for r in found})


def added(spans: DataFrame, judge: Judge) -> DataFrame:
    """Spans without a rule's label that the trees accept, the best first, unless one that is kept overlaps.

    None overlaps with verified data. Spans that overlap from one to the next are a chain;
    only chains of several spans are sorted out, each by itself.
    """
    open_ones = spans.where(F.col("label").isNull() & ~F.col("overlaps"))
    if not judge.thresholds:
        return open_ones.limit(0).withColumn("score", F.lit(0.0)).drop("label", "overlaps")
    least = F.create_map(*[F.lit(x) for pair in judge.thresholds.items() for x in pair])
    accepted = _scored(open_ones, judge.trees).where(F.col("score") >= F.coalesce(F.try_element_at(least, F.col("kind")), F.lit(2.0)))
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    earlier = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    chained = accepted.withColumn("new", F.coalesce((earlier <= F.col("start")).cast("int"), F.lit(1))).withColumn(
        "chain", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    columns = [c for c in chained.columns if c not in ("new", "chain", "label", "overlaps")]
    ranked = F.struct(
        (-F.col("score")).alias("_score"), (F.col("start") - F.col("end")).alias("_length"), F.col("start").alias("_start"),
        F.col("kind").alias("_kind"), F.struct(*columns).alias("span"),
    )
    together = chained.groupBy("row", "chain").agg(F.array_sort(F.collect_list(ranked)).alias("ranked"))
    spans_of = F.transform("ranked", lambda r: r["span"])
    kept = F.aggregate(
        spans_of, F.slice(spans_of, 1, 0),
        lambda kept, s: F.when(
            F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])), kept
        ).otherwise(F.array_append(kept, s)),
    )
    return together.select(F.explode(F.when(F.size("ranked") > 1, kept).otherwise(spans_of)).alias("span")).select("span.*")


def personal_data(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """Personal data of each text: those that exact rules verify, and those that trees add.

    Returns a row per input row: row (``row``, of different numbers, if given), doc_id, base and spans, arrays of (order, start, end,
    kind), sorted by kind as listed in ``KINDS``, then start; ends are exclusive, positions
    are code points. Base spans stay whatever the trees say. Null and empty texts have none;
    repeated rows get equal results, ids may be null; an empty table gives no rows. Very long
    texts are read whole, and the spans of one text are compared in linear time; other columns
    are not looked at. Texts are read once; what is shuffled are matches.
    """
    found = stored(matches(docs, row), "placed")
    spans = stored(candidates(found), "spans")
    more = added(spans, fit(spans))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    columns = ["row", F.struct(order.alias("order"), "start", "end", "kind").alias("span"), "base"]
    chosen = spans.where("base").select(*columns).unionByName(more.select(*columns))
    per = chosen.groupBy("row").agg(
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("span")))).alias("base"),
        F.array_sort(F.collect_set("span")).alias("spans"),
    )
    none = F.array().cast("array<struct<order:bigint,start:bigint,end:bigint,kind:string>>")
    documents = found.where(F.col("kind") == DOCUMENT).select("row", "doc_id")
    return documents.join(per, "row", "left").select(
        "row", "doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")
    )


def redact(docs: DataFrame, mark: str = "[{kind}]") -> DataFrame:
    """Id and text of each document with its personal data replaced by a mark of their kind.

    A row for each input row, also if ids repeat or are missing; null text becomes empty text.
    Other columns are left out.
    """
    rows = stored(docs.select("doc_id", text_or_empty().alias("text"), F.monotonically_increasing_id().alias("row")), "texts")
    joined = rows.join(personal_data(rows, F.col("row")).select("row", "spans"), "row")
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    state = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))
    text = F.aggregate(
        ordered, state,
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
            F.concat(a["done"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.replace(F.lit(mark), F.lit("{kind}"), s["kind"])).alias("done"),
            s["end"].alias("at"),
        )),
        lambda a: F.concat(a["done"], F.substring(F.col("text"), a["at"] + 1, F.char_length("text"))),
    )
    return joined.select("doc_id", F.coalesce(text, "text").alias("text"))
