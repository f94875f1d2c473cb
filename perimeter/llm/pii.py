"""Personal data by scored candidates (DataFrame functions and Spark ML only).

Generators propose spans. The strict ones give the base spans, which always stay. The
loose ones, of high recall, also accept masked forms (``a (at) b.example``, ``10[.]1[.]2[.]3``,
numbers grouped by other signs) and overlap. Gradient-boosted trees score every loose
candidate by its format and context, and a threshold per kind, calibrated on all labelled
candidates that training has not seen, selects what is added.

Candidates that pass the test of their kind (checksum, octets, number of digits, form of an
address) and lie in no strict span of another kind are what the model decides. The others are
known to be wrong. Features describe the unmasked value and what stands around it. They leave out
what only tells strict forms from loose ones and the test itself, as labels would make the trees
learn just that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from perimeter.llm.shared import Scratch

KINDS = ("email", "ip", "card", "phone")

# The strict forms. Where a run of characters can't match from its first place, it can't from
# a later one, so look-behind and possessive repeats only save time.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:@|[\x20]?(?:\[at\]|\(at\)|\{at\})[\x20]?)"
_DOT = r"(?:\.|[\x20]?(?:\[dot\]|\(dot\)|\{dot\}|\[\.\])[\x20]?)"
LOOSE = {
    "email": rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++{_AT}[a-z0-9-]++(?:{_DOT}[a-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\.)[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,2}[0-9]{4}){2}[\x20./_-]{0,2}[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:00|\+\x20?)?[(]?[0-9]{2,4}[)]?[\x20./-][0-9]{3,4}[\x20./-]?[0-9]{3,5}(?![0-9A-Za-z])",
}
# What looks like an address at first, but has no domain: only a negative example.
NEAR = {"email": rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++{_AT}[a-z0-9-]++(?!{_DOT}[a-z0-9-])"}
# The form of an address: at most 64 characters before the sign, labels, a top-level domain.
_ADDRESS = (
    r"(?i)^(?=[^@]{1,64}@)[a-z0-9_%+-]++(?:\.[a-z0-9_%+-]++)*+"
    r"@(?:(?!-)[a-z0-9-]{1,63}+(?<!-)\.)+(?:[a-z]{2,63}|xn--[a-z0-9-]+)$"
)
# A text without this can't hold the kind: a cheap test before the patterns.
_NEEDS = {"email": r"@|(?i:\Wat\W)", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
_CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|addr)\b",
    "card": r"(?i)\b(?:card|credit|visa|mastercard|payment|account)\b",
    "phone": r"(?i)\b(?:phone|tel|mobile|call|fax)\b",
}
REACH = 24
FEATURES = (
    "length", "digits", "letters", "groups", "longest_group", "shortest_group", "signs",
    "distinct_digits", "context", "word_before", "word_after",
)
# The trees are fitted on about so many candidates per kind and label, drawn by hash, and on at
# most half of them; all others calibrate, by a histogram of scores with so many bins.
MAX_SAMPLE = 2_500
PRECISION = 0.995
BINS = 1_000
ROUNDS, DEPTH, SEED = 12, 3, 7


# Matches whose places are summed up together.
BLOCK = 64
_SPAN = "array<struct<start:int,value:string,before:string,after:string>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where it is used in lambdas."""
    return F.transform(F.array(value), use)[0]


def located(text: Column, pattern: str) -> Column:
    """array<struct<start,value,before,after>> of the leftmost matches, 0-based code points.

    What lies between matches is what a split leaves, so lengths give the places, and the ends
    of those pieces what stands around a match: up to ``REACH`` characters before it and one after
    it, as far as the next match. Places are summed in blocks, so the work grows with the text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def steps(gaps: Column, found: Column) -> Column:
        next_gaps = F.slice(gaps, 2, F.size(found))
        pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("value")))
        return F.zip_with(
            pairs,
            next_gaps,
            lambda p, g: F.struct(
                F.length(p["gap"]).alias("gap"),
                p["value"].alias("value"),
                F.right(p["gap"], F.lit(REACH)).alias("before"),
                F.left(g, F.lit(1)).alias("after"),
            ),
        )

    def width(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + F.length(x["value"]))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        span = F.struct(start.alias("start"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"))
        return F.struct(
            (start + F.length(x["value"])).alias("at"), F.concat(done["spans"], F.array(span)).alias("spans")
        )

    def placed(block: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), F.array().cast(_SPAN).alias("spans"))
        return F.aggregate(block, first, step, lambda done: done["spans"])

    def starts(blocks: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        return F.aggregate(
            F.transform(blocks, width),
            first,
            lambda done, n: F.struct(
                (done["at"] + n).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts")
            ),
            lambda done: done["starts"],
        )

    def cut(steps: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
        return F.transform(numbers, lambda n: F.slice(steps, n * BLOCK + 1, BLOCK))

    def all_placed(blocks: Column) -> Column:
        return F.flatten(F.zip_with(blocks, starts(blocks), placed))

    def from_matches(found: Column) -> Column:
        spans = _let(steps(F.split(text, pattern, -1), found), lambda s: _let(cut(s), all_placed))
        return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(_SPAN))

    return _let(found, from_matches)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def luhn_ok(number: Column) -> Column:
    """Luhn check of a text of digits."""
    each = F.split(F.reverse(number), "")
    values = F.transform(
        each,
        lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
            d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def octets_ok(value: Column) -> Column:
    """Four numbers of at most 255, with any number of leading zeros."""
    parts = F.filter(F.split(value, r"[^0-9]+"), lambda p: p != "")
    small = F.forall(parts, lambda p: p.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (F.size(parts) == 4) & small


def _passes(kind: str, value: Column) -> Column:
    count = F.length(digits(value))
    if kind == "ip":
        return octets_ok(value)
    if kind == "card":
        return count.between(13, 19) & luhn_ok(digits(value))
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def _plain(kind: str, value: Column) -> Column:
    """The value without masks."""
    if kind not in ("email", "ip"):
        return value
    dots = r"(?i)[\x20]?(?:[\[({]dot[\])}]|\[\.\]|\(\.\))[\x20]?"
    return F.regexp_replace(
        F.regexp_replace(value, r"(?i)[\x20]?[\[({]at[\])}][\x20]?", "@"), dots, "."
    )


def _address_ok(value: Column) -> Column:
    return F.when(F.length(value) <= 320, value.rlike(_ADDRESS)).otherwise(False)


def _sound(kind: str, value: Column) -> Column:
    """Whether the content of an unmasked value can be of the kind."""
    return _address_ok(value) if kind == "email" else _passes(kind, value)


def _if_possible(kind: str, text: Column, spans: Column) -> Column:
    none = F.array().cast(_SPAN)
    return F.when(text.rlike(_NEEDS[kind]), spans).otherwise(none)


def base_spans(text: Column, kind: str) -> Column:
    """The strict spans of a kind, as ``located`` gives them."""
    return _if_possible(
        kind, text, F.filter(located(text, STRICT[kind]), lambda s: _passes(kind, s["value"]))
    )


def _number(condition: Column) -> Column:
    return condition.cast("double")


def _described(kind: str, spans: Column) -> Column:
    """Spans with kind, end, features and whether their content can be of the kind."""

    def describe(span: Column) -> Column:
        value = _plain(kind, span["value"])
        before, after = span["before"], span["after"]
        number = digits(value)
        groups = F.transform(
            F.filter(F.split(value, r"[^0-9]+"), lambda g: g != ""), lambda g: F.length(g)
        )
        features = {
            "length": F.length(value),
            "digits": F.length(number),
            "letters": F.length(F.regexp_replace(value, r"[^A-Za-z]", "")),
            "groups": F.size(groups),
            "longest_group": F.coalesce(F.array_max(groups), F.lit(0)),
            "shortest_group": F.coalesce(F.array_min(groups), F.lit(0)),
            "signs": F.length(F.regexp_replace(value, r"[A-Za-z0-9\x20]", "")),
            "distinct_digits": F.size(F.array_distinct(F.split(number, ""))),
            "context": before.rlike(_CONTEXT[kind]),
            "word_before": before.rlike(r"[\p{L}0-9_=/\"'-]$"),
            "word_after": after.rlike(r"[\p{L}0-9_=/\"'-]"),
        }
        numbers = [features[name].cast("int").cast("double") for name in FEATURES]
        return F.struct(
            F.lit(kind).alias("kind"),
            span["start"].alias("start"),
            (span["start"] + F.length(span["value"])).alias("end"),
            _sound(kind, value).alias("passes"),
            F.array(*numbers).alias("features"),
        )

    return F.transform(spans, describe)


def candidates(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row, doc_id, base and loose (arrays of described spans) per document."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), whole.alias("text")
    )
    body = F.col("text")

    def loose(kind: str) -> Column:
        found = located(body, LOOSE[kind])
        return F.concat(found, located(body, NEAR[kind])) if kind in NEAR else found

    base = [_described(kind, base_spans(body, kind)) for kind in KINDS]
    more = [_described(kind, _if_possible(kind, body, loose(kind))) for kind in KINDS]
    return rows.select("row", "doc_id", F.concat(*base).alias("base"), F.concat(*more).alias("loose"))


def apart(found: DataFrame) -> DataFrame:
    """row, kind, start, end, passes, features of the loose candidates outside strict spans of their kind.

    One that lies in a strict span of another kind doesn't pass. Strict spans of a kind don't
    overlap, so of those that begin no later the last one decides, and of the others the first.
    """
    spans = found.select("row", F.explode(F.concat(
        F.transform("base", lambda c: F.struct(F.lit(True).alias("strict"), c.alias("c"))),
        F.transform("loose", lambda c: F.struct(F.lit(False).alias("strict"), c.alias("c"))),
    )).alias("s")).select("row", "s.strict", "s.c.*")
    upward = W.partitionBy("row").orderBy("start").rangeBetween(W.unboundedPreceding, W.currentRow)
    downward = W.partitionBy("row").orderBy(F.desc("start")).rangeBetween(W.unboundedPreceding, W.currentRow)

    def strict(kind: str) -> Column:
        return F.col("strict") & (F.col("kind") == kind)

    ends = {kind: F.max(F.when(strict(kind), F.col("end"))).over(upward) for kind in KINDS}
    begins = {kind: F.min(F.when(strict(kind), F.col("start"))).over(downward) for kind in KINDS}
    placed = spans.select(
        "*",
        *(F.coalesce(c, F.lit(-1)).alias(f"last_{kind}") for kind, c in ends.items()),
        *(F.coalesce(c, F.lit((1 << 31) - 1)).alias(f"next_{kind}") for kind, c in begins.items()),
    ).where("NOT strict")
    own = F.lit(False)
    inside = F.lit(False)
    for kind in KINDS:
        here = F.col("kind") == kind
        own = own | (here & ((F.col(f"last_{kind}") > F.col("start")) | (F.col(f"next_{kind}") < F.col("end"))))
        inside = inside | (~here & (F.col(f"last_{kind}") >= F.col("end")))
    return placed.where(~own).select("row", "kind", "start", "end", (F.col("passes") & ~inside).alias("passes"), "features")


def _labelled(found: DataFrame, loose: DataFrame) -> DataFrame:
    """Strict spans that pass against strict and loose ones that don't, with a hash in [0, 1).

    Loose candidates that pass are what the model decides; they have no label.
    """
    columns = ("row", "kind", "start", "features")
    strict = found.select("row", F.explode("base").alias("c")).select("row", "c.*")
    strict = strict.select(*columns, _number(F.col("passes")).alias("label"))
    wrong = loose.where("NOT passes").select(*columns, F.lit(0.0).alias("label"))
    labelled = strict.unionByName(wrong)
    order = F.pmod(F.xxhash64("row", "start", "kind"), F.lit(1 << 30)) / (1 << 30)
    return labelled.withColumn("order", order)


def _vectors(rows: DataFrame) -> DataFrame:
    named = rows.select(
        "*",
        *(F.col("features")[n].alias(f"_{name}") for n, name in enumerate(FEATURES)),
        *(_number(F.col("kind") == kind).alias(f"_{kind}") for kind in KINDS),
    )
    names = [f"_{name}" for name in (*FEATURES, *KINDS)]
    return VectorAssembler(inputCols=names, outputCol="vector").transform(named).drop(*names)


def _scored(model, rows: DataFrame) -> DataFrame:
    return model.transform(_vectors(rows)).withColumn("score", vector_to_array("probability")[1])


def _threshold(bins: dict[int, tuple[int, int]]) -> float | None:
    """The lowest bin edge from which ``PRECISION`` of the labelled scores are strict; None if none is.

    ``bins`` has strict and all candidates per filled bin. Empty ones belong to what lies above.
    """
    best, strict, total = None, 0, 0
    for bin_ in range(BINS, -1, -1):
        more = bins.get(bin_, (0, 0))
        strict, total = strict + more[0], total + more[1]
        if strict and strict >= PRECISION * total:
            best = bin_ / BINS
    return best


def fit(found: DataFrame, loose: DataFrame, scratch: Scratch):
    """The model, if both labels are drawn, and the threshold per kind that can be calibrated.

    Kinds and labels are drawn separately, so a rare kind is fitted and calibrated whatever
    there is of others. The counts that give thresholds are at most ``BINS`` + 1 per kind.
    """
    labelled = _labelled(found, loose)
    cells = {
        (r["kind"], r["label"]): r["count"] for r in labelled.groupBy("kind", "label").count().collect()
    }
    share = F.lit(0.0)
    for (kind, label), count in cells.items():
        here = (F.col("kind") == kind) & (F.col("label") == label)
        share = F.when(here, F.lit(min(0.5, MAX_SAMPLE / count))).otherwise(share)
    fitted = F.col("order") < share
    sample = scratch.store(labelled.where(fitted), "sample")
    if sample.select("label").distinct().count() < 2:
        return None, {}
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=ROUNDS, maxDepth=DEPTH, seed=SEED
    )
    model = trees.fit(_vectors(sample))
    histogram = (
        _scored(model, labelled.where(~fitted))
        .groupBy("kind", F.floor(F.col("score") * BINS).cast("int").alias("bin"))
        .agg(F.sum("label").alias("strict"), F.count(F.lit(1)).alias("total"))
    )
    bins: dict[str, dict[int, tuple[int, int]]] = {}
    for r in histogram.collect():
        bins.setdefault(r["kind"], {})[r["bin"]] = (int(r["strict"]), r["total"])
    limits = {kind: _threshold(filled) for kind, filled in bins.items()}
    return model, {kind: limit for kind, limit in limits.items() if limit is not None}


def find(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base and added: arrays of struct<kind,start,end> by kind as listed, then start.

    One row per row of ``documents``, also for repeated or null ids. Null and empty texts
    have no spans. Offsets count code points, the end is exclusive. Added are the loose
    candidates that pass the test of their kind and reach its threshold. A kind without threshold
    (no strict span held out, or no score is sure enough) adds all that pass, at every size.
    """
    scratch = Scratch(documents.sparkSession, "pii")
    found = scratch.store(candidates(documents, doc_id, text), "candidates")
    outside = scratch.store(apart(found), "loose")
    model, limits = fit(found, outside, scratch)
    plain = "transform(base, c -> struct(c.kind AS kind, c.start AS start, c.end AS end))"
    rows = found.select("row", "doc_id", F.expr(plain).alias("base"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    passing = outside.where("passes")
    limit = reduce(
        lambda rest, kind: F.when(F.col("kind") == kind, F.lit(limits[kind])).otherwise(rest),
        limits,
        F.lit(0.0),
    )
    chosen = _scored(model, passing).where(F.col("score") >= limit) if limits else passing
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    added = (
        chosen.groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct(place.alias("place"), "start", "end", "kind"))).alias("added"))
        .select("row", F.expr("transform(added, c -> struct(c.kind AS kind, c.start AS start, c.end AS end))").alias("added"))
    )
    return rows.join(added, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined, by kind as listed, then start and end."""
    order = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        spans,
        lambda s: F.struct(F.array_position(order, s["kind"]).alias("p"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return F.array_join(
        F.transform(
            F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        ),
        ",",
    )


def redact(documents: DataFrame, spans: Column, text: str = "text", mark: str = "*") -> DataFrame:
    """Overwrites the given spans of ``text`` with as many marks, keeping all other offsets."""
    masked = F.aggregate(
        spans,
        F.col(text),
        lambda done, s: F.overlay(done, F.repeat(F.lit(mark), s["end"] - s["start"]), s["start"] + 1),
    )
    return documents.withColumn(text, masked)
