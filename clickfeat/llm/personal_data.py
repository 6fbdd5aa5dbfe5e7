"""Personal data spans: wide generators, boosted trees over their candidates, calibrated thresholds.

DataFrame functions only; the trees are Spark's own. Fixed base rules give spans that always stay.
Wider generators propose overlapping candidates: other spellings of the same kinds. Candidates that
match a base rule's pattern are labelled by whether they pass its check; of each that passes, a spoiled
copy (a wrong check digit, a number out of range, too few digits, no domain) in the same context is
labelled false, since texts hold few near misses. All of them train the trees, counted by distinct
features, so that the table the trees read does not grow with the corpus.
A fold of documents is held out; the threshold of a kind is the least score at which the fold's
candidates are right often enough. Kinds whose fold is too small to tell add nothing.

Patterns are written without backtracking over runs, so that long texts take linear time: a span
starts at a run's first character (or where the last span ended) and repeats are possessive.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import keep, query, table

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]++"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_AT = r"(?:@| ?[\[({]at[\])}] ?)"
_DOT = r"(?:\.| ?[\[({]dot[\])}] ?)"
#: Wider than the base rules, and not without false finds.
GENERATORS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++{_AT}{_LABEL}(?:{_DOT}{_LABEL})++",
    "ip": r"(?<![0-9.])[0-9]{1,4}+(?:\.[0-9]{1,4}+){3}+(?![0-9.])"
    r"|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}[ ./-]?[0-9]{4}[ ./-]?[0-9]{4}[ ./-]?[0-9]{1,7}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}+|00[0-9]{1,3}+)?[ .-]?\(?[0-9]{2,4}+\)?[ .-]"
    r"[0-9]{3,4}+[ .-][0-9]{3,4}+(?![0-9])",
}
#: A text without this holds no span of the kind that passes: implied by the base rule and its check.
BASE_TRIGGERS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){15}", "phone": r"\+[0-9]"}
#: A text without this holds no candidate of the kind's generator.
TRIGGERS = {"email": r"@|[\[({]at[\])}]", "ip": "[0-9A-Fa-f][.:]", "card": "[0-9]{4}", "phone": "[0-9]{3}"}
CONTEXT = 32
CUES = {
    "mail": r"mail|contact|write to|kontakt|correo|courriel",
    "net": r"\bip\b|address|host|server|client|adresse",
    "pay": r"card|credit|visa|master|amex|karte|tarjeta|carte|payment|account",
    "call": r"phone|tel|call|mobile|cell|fax|telefon|llame|appel",
}
FEATURES = (
    "kind_no", "length", "digits", "letters", "separators", "groups", "at", "plus", "brackets", "checksum",
    "octets", "before", "after", *(f"cue_{c}" for c in CUES),
)
TREES = 12
DEPTH = 3
#: Share of a fold's candidates above a threshold that must be right, and least labels of each sort.
PRECISION = 0.99
LEAST_LABELS = 20
#: One document in so many is in the held-out fold; scores are compared in so many steps.
FOLDS = 4
STEPS = 50

_SPAN = "array<struct<start:int,end:int,value:string,prior:string,next:string>>"


def _spans(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` with code point bounds, what stands before each and the next character.

    The text between the matches gives the bounds, in time linear in the text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    n = F.size(found)
    joined = F.zip_with(
        F.zip_with(F.slice(gaps, F.lit(1), n), found, lambda g, v: F.struct(g.alias("g"), v.alias("v"))),
        F.slice(gaps, F.lit(2), n),
        lambda x, after: F.struct(
            F.char_length(x["g"]).alias("gap"),
            x["v"].alias("value"),
            F.right(x["g"], F.lit(CONTEXT)).alias("prior"),
            F.left(after, F.lit(1)).alias("next"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPAN})").alias("out"))

    def step(so_far: Column, x: Column) -> Column:
        first = so_far["at"] + x["gap"]
        last = first + F.char_length(x["value"])
        one = F.struct(
            first.alias("start"), last.alias("end"), x["value"], x["prior"], x["next"]
        ).cast("struct<start:int,end:int,value:string,prior:string,next:string>")
        return F.struct(last.alias("at"), F.concat(so_far["out"], F.array(one)).alias("out"))

    return F.aggregate(joined, start, step, lambda total: total["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a text of at most 19 digits pass the check of card numbers."""
    turned = F.split(F.reverse(_digits(value)), "")
    doubled = F.transform(
        F.filter(turned, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (2 * d.cast("int")) % 10 + F.floor(2 * d.cast("int") / 10).cast("int")
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _octets(value: Column) -> Column:
    return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")


def passes(kind: str, value: Column) -> Column:
    """The base rule's check on a span that its pattern has found."""
    n = F.length(_digits(value))
    if kind == "ip":
        return _octets(value)
    if kind == "card":
        return F.when(n.between(16, 19), luhn(value)).otherwise(False)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _matches_base(kind: str, value: Column) -> Column:
    return value.rlike(f"^(?:{BASE[kind]})$")


def _sort_of(char: Column) -> Column:
    """0 for none or white space, 1 for a letter, 2 for a digit, 3 for anything else."""
    return (
        F.when(F.coalesce(char, F.lit("")).rlike(r"^\s?$"), 0)
        .when(char.rlike(r"^\p{L}$"), 1)
        .when(char.rlike("^[0-9]$"), 2)
        .otherwise(3)
    )


def _features(kind: str, span: Column) -> Column:
    value = span["value"]
    count = lambda cls: F.length(F.regexp_replace(value, f"[^{cls}]", ""))
    few = F.length(_digits(value)).between(12, 19)
    columns = {
        "kind_no": F.lit(KINDS.index(kind)),
        "length": F.least(F.char_length(value), F.lit(64)),
        "digits": F.least(count("0-9"), F.lit(32)),
        "letters": F.least(count("A-Za-z"), F.lit(64)),
        "separators": F.least(count(r" .\-/:"), F.lit(16)),
        "groups": F.least(F.size(F.split(value, r"[ .\-/:]++")), F.lit(16)),
        "at": value.contains("@").cast("int"),
        "plus": value.startswith("+").cast("int"),
        "brackets": F.least(count(r"\[\](){}"), F.lit(8)),
        "checksum": F.when(few, luhn(value).cast("int")).otherwise(-1),
        "octets": _octets(value).cast("int"),
        "before": _sort_of(F.right(span["prior"], F.lit(1))),
        "after": _sort_of(span["next"]),
    }
    columns |= {f"cue_{c}": F.lower(span["prior"]).rlike(p).cast("int") for c, p in CUES.items()}
    return F.struct(*[columns[f].cast("double").alias(f) for f in FEATURES])


def _passing(kind: str):
    return lambda span: passes(kind, span["value"])


def _bounds(number: int):
    return lambda span: F.struct(
        F.lit(number).alias("kind_no"), span["start"].alias("start"), span["end"].alias("end")
    )


def _candidate(kind: str):
    """Bounds, label (null where no base rule has a say) and features of a span."""

    def described(span: Column) -> Column:
        judged = F.when(
            _matches_base(kind, span["value"]), passes(kind, span["value"]).cast("double")
        )
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind_no"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            judged.alias("label"),
            _features(kind, span).alias("features"),
        )

    return described


def _spoiled(kind: str, value: Column) -> Column:
    """A span's text changed so that it fails the kind's check."""
    if kind == "email":
        return F.regexp_replace(value, "@.*$", "@host")
    if kind == "ip":
        return F.regexp_replace(value, "^[0-9]++", "355")
    if kind == "phone":
        return F.left(value, F.lit(6))
    last = F.translate(F.right(value, F.lit(1)), "0123456789", "1234567890")
    return F.concat(F.left(value, F.char_length(value) - 1), last)


def _near_miss(kind: str):
    def described(span: Column) -> Column:
        spoiled = F.struct(
            _spoiled(kind, span["value"]).alias("value"),
            span["prior"].alias("prior"),
            span["next"].alias("next"),
        )
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind_no"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            F.lit(0.0).alias("label"),
            _features(kind, spoiled).alias("features"),
        )

    return described


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_row, _id, base, candidates`` of each row, in one scan; text is not kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base, wide = [], []
    for number, kind in enumerate(KINDS):
        none = F.expr(f"cast(array() as {_SPAN})")
        raw = F.when(text.rlike(BASE_TRIGGERS[kind]), _spans(text, BASE[kind])).otherwise(none)
        good = F.filter(raw, _passing(kind))
        base.append(F.transform(good, _bounds(number)))
        wide.append(F.transform(good, _near_miss(kind)))
        more = F.when(text.rlike(TRIGGERS[kind]), _spans(text, GENERATORS[kind])).otherwise(none)
        wide.append(F.transform(more, _candidate(kind)))
    return docs.select(
        F.col(id_col).alias("_id"),
        F.concat(*base).alias("base"),
        F.concat(*wide).alias("candidates"),
        F.monotonically_increasing_id().alias("_row"),
    )


def fit_trees(labelled: DataFrame):
    """Boosted trees on ``features, label, n`` (how often they occur); None without both labels."""
    sides = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if min(sides.get(0.0, 0), sides.get(1.0, 0)) < LEAST_LABELS:
        return None
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH,
        maxBins=32, seed=5, subsamplingRate=1.0,
    )
    return trees.fit(_vectors(labelled))


def _vectors(rows: DataFrame) -> DataFrame:
    flat = rows.select("*", *[F.col(f"features.{f}").alias(f"f_{f}") for f in FEATURES])
    built = VectorAssembler(inputCols=[f"f_{f}" for f in FEATURES], outputCol="vector").transform(flat)
    return built.drop(*[f"f_{f}" for f in FEATURES])


def _scored(trees, rows: DataFrame) -> DataFrame:
    step = F.floor(F.element_at(vector_to_array("probability"), 2) * STEPS).cast("int")
    return trees.transform(_vectors(rows)).withColumn("step", step)


def thresholds(scored: DataFrame) -> dict[int, int]:
    """The least step of the score for each kind at which the held-out labels are right enough."""
    steps = scored.groupBy("features.kind_no", "step").agg(
        F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("good")
    )
    by_kind: dict[int, list] = {}
    for row in steps.collect():  # at most kinds x steps
        by_kind.setdefault(int(row["kind_no"]), []).append((row["step"], row["n"], row["good"]))
    chosen = {}
    for kind, rows in by_kind.items():
        total = good = 0
        labels = sum(n for _, n, _ in rows)
        right = sum(g for _, _, g in rows)
        if min(right, labels - right) < LEAST_LABELS:
            continue
        for step, n, g in sorted(rows, reverse=True):
            total, good = total + n, good + g
            if good < PRECISION * total:
                break
            chosen[kind] = step
    return chosen


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, base, added``, arrays of ``kind_no, start, end``.

    Bounds are in code points of the whole text, end exclusive; kinds are numbered as in :data:`KINDS`.
    Added spans meet the threshold of their kind and touch no base span. Null text counts as empty and has
    no spans; repeated rows and null ids each keep their row; other columns are not read. An empty table
    gives no rows, and a table without labels of both sorts no added spans.
    """
    found = keep(_found(docs, id_col, text_col), "spans")
    one = F.col("candidates")
    rows = found.select("_row", "base", F.explode(one).alias("c")).select(
        "_row", "base", "c.kind_no", "c.start", "c.end", "c.label", "c.features"
    )
    known = rows.filter("label IS NOT NULL").groupBy(
        (F.pmod(F.xxhash64("_row"), F.lit(FOLDS)) == 0).alias("held"), "features", "label"
    )
    known = keep(known.agg(F.count("*").cast("double").alias("n")), "labelled-features")
    trees = fit_trees(known.filter("NOT held"))
    limits = thresholds(_scored(trees, known.filter("held"))) if trees else {}
    none = F.expr("cast(array() as array<struct<kind_no:int,start:int,end:int>>)")
    if not limits:
        return found.select(F.col("_id").alias("doc_id"), "base", none.alias("added"))
    # Candidates that a base rule has judged stay as it says.
    open_rows = rows.filter("label IS NULL").filter(
        ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    )
    scored = _scored(trees, open_rows)
    passed = F.lit(False)
    for kind, step in limits.items():
        passed = passed | ((F.col("kind_no") == kind) & (F.col("step") >= step))
    added = scored.filter(passed).groupBy("_row").agg(
        F.collect_list(F.struct("kind_no", "start", "end")).alias("added")
    )
    return found.join(added, "_row", "left").select(
        F.col("_id").alias("doc_id"), "base", F.coalesce("added", none).alias("added")
    )


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, by kind as listed, then start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[redacted]") -> DataFrame:
    """``docs`` with every base span of the text replaced by ``mark``; overlapping spans by one."""
    text = F.col(text_col)
    spans = [
        F.transform(F.filter(_spans(text, BASE[kind]), _passing(kind)), _bounds(0)) for kind in KINDS
    ]

    def step(so_far: Column, span: Column) -> Column:
        gap = F.substring(text, so_far["at"] + 1, span["start"] - so_far["at"])
        apart = F.concat(so_far["out"], gap, F.lit(mark))
        return F.struct(
            F.greatest(so_far["at"], span["end"]).alias("at"),
            F.when(span["start"] >= so_far["at"], apart).otherwise(so_far["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(
        done["out"], F.substring(text, done["at"] + 1, F.char_length(text))
    )
    return docs.withColumn(
        text_col, F.aggregate(F.array_sort(F.concat(*spans)), start, step, rest)
    )


@query()
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda span: span["kind_no"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, n))).cast("bigint").alias(f"n_{kind}")
        for n, kind in enumerate(KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )
