"""Personal data by candidate gradient boosting, with DataFrame functions only.

Patterns of high recall propose spans, which may overlap. Boosted trees judge each by its format and context, and a
threshold per kind, calibrated on examples the trees did not see, selects what is added to the spans of the
strict rules. Everything happens inside a row: texts are neither shuffled nor cut, and repeated rows do not meet.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KINDS = ("email", "ip", "card", "phone")
# The patterns of the strict rules. Runs are possessive, so that long ones need no stack, and start
# where a run starts or where the match before ended, so that they are read once; neither changes what is found.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[ -]?[0-9])++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Generators of candidates: kind, pattern, what a text must hold.
_GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}"
              r"(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| ?\{dot\} ?| dot )[A-Za-z0-9-]{2,24}){1,4}", "at"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{2,24}){1,4}", " dot "),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])", ""),
    ("card", r"(?<![0-9])[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", ""),
    ("card", r"(?<![0-9])3[47][0-9]{2}([ .-])[0-9]{6}\1[0-9]{5}(?![0-9])", ""),
    ("phone", r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])", "+"),
    ("phone", r"(?<![0-9+])\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])", "+"),
    ("phone", r"(?<![0-9+(])(?<!\+[0-9]{1,3} )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", ""),
    ("phone", r"(?<![0-9])00[0-9]{2}[ .-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])", ""),
    ("ip", r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])", ":"),
)
_CONTEXT = 32
_CUES = {"email": "mail|contact|write", "ip": r"\bip\b|host|server|login|address", "card": "card|visa|credit|amex|pay",
         "phone": "phone|call|tel|mobile|fax|whatsapp"}
_COUNTERCUES = r"order|invoice|isbn|serial|version|part|sku|ticket|tracking|reference|article|figure|page|no\.|#"
_GROUP = 256  # matches whose positions are summed up together

SPAN = "struct<start:int,kind:int,end:int>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """An array expression over a value that is evaluated once."""
    return F.flatten(F.transform(F.array(value), body))


def _offsets(lengths: Column) -> Column:
    """Sums of all earlier elements, in groups, so that long lists are not copied for each of their elements."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(lengths) - 1, F.lit(0)), F.lit(_GROUP))
    sums = F.transform(starts, lambda s: F.aggregate(F.slice(lengths, s + 1, _GROUP), F.lit(0), lambda a, x: a + x))
    add = lambda xs: F.aggregate(
        xs, F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all")),
        lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"])).alias("all")))["all"]
    return F.flatten(F.zip_with(starts, add(sums), lambda s, base: F.transform(
        add(F.slice(lengths, s + 1, _GROUP)), lambda x: x + base)))


def find(text: Column, pattern: str) -> Column:
    """All matches of a pattern as array of (start, end, match), in code points, end exclusive.

    The text between matches and the matches alternate, so their lengths add up to the positions.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def place(hits: Column, gaps: Column) -> Column:
        steps = F.zip_with(gaps, hits, lambda g, h: g + F.length(h))
        return _bound(steps, lambda steps: F.zip_with(
            F.zip_with(_offsets(steps), gaps, lambda at, g: at + g), hits,
            lambda start, h: F.struct(start.alias("start"), (start + F.length(h)).alias("end"), h.alias("match"))))

    return _bound(F.struct(gaps.alias("gaps"), hits.alias("hits")), lambda b: F.when(
        F.size(b["hits"]) > 0, place(b["hits"], F.slice(b["gaps"], 1, F.size(b["hits"])))).otherwise(none))


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _strict(text: Column) -> dict[str, Column]:
    """Spans of the strict rules by kind; each pattern runs only on texts that can match."""
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    digits = text.rlike("[0-9][ .-]?[0-9]")
    found = {
        "email": F.when(F.instr(text, "@") > 0, find(text, _EMAIL)),
        "ip": F.when(digits & text.rlike(r"[0-9]\.[0-9]"), F.filter(
            find(text, _IP), lambda m: m["match"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))),
        "card": F.when(digits, F.filter(find(text, _CARD), lambda m: F.length(_digits(m["match"])).between(12, 19)
                                        & _luhn(_digits(m["match"])))),
        "phone": F.when(F.instr(text, "+") > 0, F.filter(
            find(text, _PHONE), lambda m: F.length(_digits(m["match"])).between(9, 15))),
    }
    return {k: F.coalesce(v, none) for k, v in found.items()}


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))


def _features(text: Column, kind: str, m: Column, strict: Column) -> Column:
    """Format and context of a candidate as an array of doubles."""
    match, digits = m["match"], _digits(m["match"])
    before = F.lower(F.substring(text, F.greatest(m["start"] - _CONTEXT, F.lit(0)) + 1, F.least(m["start"], F.lit(_CONTEXT))))
    left = F.when(m["start"] > 0, F.substring(text, m["start"], F.lit(1))).otherwise(" ")
    right = F.substring(text, m["end"] + 1, F.lit(1))
    inside = lambda same: F.exists(strict, lambda s: (s["start"] < m["end"]) & (s["end"] > m["start"])
                                   & ((s["kind"] == KINDS.index(kind)) if same else (s["kind"] != KINDS.index(kind))))
    flags = [
        *[F.lit(k == kind) for k in KINDS],
        _luhn(digits), match.startswith("+"), match.contains("("),
        match.rlike(r"^\+?[0-9]+$"), match.rlike(r"^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"),
        match.rlike(r"\(at\)|\[at\]|\{at\}"), match.rlike(r"(?: dot |\.)[A-Za-z]{2,6}$|[\(\[{]dot[\)\]}] ?[A-Za-z]{2,6}$"),
        match.rlike("^[3-6]"), match.rlike(r"^\+?(\d)(?:[ ().-]*\1)+$"),
        left.rlike(r"[A-Za-z0-9_$#=/.-]"), right.rlike(r"[A-Za-z0-9_=/-]"),
        before.rlike(_CUES[kind]), before.rlike(_COUNTERCUES), inside(True), inside(False),
    ]
    numbers = [F.length(digits), F.length(match) - F.length(digits)]
    return F.array(*[F.coalesce(f, F.lit(False)).cast("double") for f in flags], *[n.cast("double") for n in numbers])


def _described(text: Column, kind: str, pattern: str, strict: Column) -> Column:
    return F.transform(find(text, pattern), lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"),
        _features(text, kind, m, strict).alias("features")))


def candidates(text: Column, strict: Column) -> Column:
    """Proposals of all generators as array of (start, kind, end, features); ``strict`` holds the strict spans."""
    kind_type = "array<struct<start:int,kind:int,end:int,features:array<double>>>"
    parts = []
    digits = text.rlike("[0-9]{2}")
    for kind, pattern, needs in _GENERATORS:
        ready = (F.instr(text, needs) > 0) if needs else F.lit(True)
        ready = ready & (text.rlike(r"[(\[{]at[)\]}]| at ") if kind == "email" else digits)
        parts.append(F.when(ready, _described(text, kind, pattern, strict)).otherwise(F.array().cast(kind_type)))
    return F.concat(*parts)


# Labelled examples, our own: marked spans are personal data, other candidates are not.
# Lines at even and odd places differ in values only: the trees are grown on the former, thresholds set on the latter.
_EXAMPLES = """
reach me at <phone:+1 (499) 555-0103> 4111111111111112 tomorrow
reach me at <phone:+1 (212) 555-0188> 5500000000000005 tomorrow
words before <phone:+1 (499) 555-0103> <card:4111111111111111> and after
words before <phone:+1 (310) 555-0142> <card:5500000000000004> and after
number <phone:+44 20 7946 0958> 1234567812345678 on file
number <phone:+49 30 901820> 8765432187654321 on file
text <phone:+33 1 70 18 99 00> <card:4012888888881881> more
text <phone:+34 91 123 45 67> <card:6011111111111117> more
call <phone:(212) 555-0147> after six
call <phone:(415) 555-0199> after six
phone <phone:212-555-0147> or mail
phone <phone:415.555.0199> or mail
my mobile is <phone:0044 20 7946 0958> now
my mobile is <phone:0049 30 901820 77> now
order 212-555-0147 was shipped
order 415-555-0199 was shipped
part 800 555 0100 of the serial list
part 877 555 0111 of the serial list
write to <email:jane.doe (at) mail.example.com> please
write to <email:max.m (at) post.example.org> please
contact <email:joe [at] example [dot] org> today
contact <email:ann [at] example [dot] net> today
mail <email:kim{at}example.net> soon
mail <email:lee{at}example.com> soon
write to <email:ann at example dot org> or call
write to <email:bob at example dot net> or call
the list (at) noon.thereafter ends
the bell [at] six.afterwards rang
look (at) this.one again
stop [at] that.two here
card <card:4111-1111-1111-1111> expires soon
card <card:5500-0000-0000-0004> expires soon
visa <card:4012 8888 8888 1881> was charged
visa <card:4222 2222 2222 2220> was charged
pay with <card:3782 822463 10005> if you can
pay with <card:3714-496353-98431> if you can
isbn 9780306406157 in the list
isbn 9783161484100 in the list
tracking 1234567890123456 left the depot
tracking 6543210987654321 left the depot
id=4111111111111112345 stored
id=5500000000000005432 stored
hash 0641917484093982477 and value
hash 8417982079974123456 and value
credit 4111.1111.1111.1112 is wrong
credit 5500.0000.0000.0005 is wrong
paid <card:4111.1111.1111.1111> by card
paid <card:5500.0000.0000.0004> by card
host <ip:2001:0db8:85a3:0000:0000:8a2e:0370:7334> replied
host <ip:fe80:0000:0000:0000:0202:b3ff:fe1e:8329> replied
time 12:30:45:11:22:33:44:55 was noted in order
time 10:20:30:40:50:16:17:18 was noted in order
serial 0000 0000 0000 0000 was blank
serial 1111 1111 1111 1111 was blank
figure 123 456 7890 and page 321 654 0987
figure 234 567 8901 and page 432 765 1098
"""
_TREES, _DEPTH = 16, 3


def _examples(spark: SparkSession) -> DataFrame:
    """Candidates of the examples: fold, kind, features, label."""
    rows = []
    for i, line in enumerate(x for x in _EXAMPLES.split("\n") if x):
        plain, gold, at = "", [], 0
        for m in re.finditer(r"<(\w+):(.*?)>", line):
            plain += line[at:m.start()]
            gold.append(f"{len(plain)}:{KINDS.index(m[1])}:{len(plain) + len(m[2])}")
            plain += m[2]
            at = m.end()
        rows.append((i % 2, plain + line[at:], gold))
    texts = spark.createDataFrame(rows, "fold int, text string, gold array<string>").coalesce(1)
    strict = texts.select("*", _all_strict(F.col("text")).alias("strict"))
    made = strict.select("fold", "gold", F.explode(candidates(F.col("text"), F.col("strict"))).alias("c"))
    name = F.concat_ws(":", "c.start", "c.kind", "c.end")
    return made.select("fold", F.col("c.kind").alias("kind"), "c.features",
                       F.array_contains("gold", name).cast("double").alias("label"))


def _all_strict(text: Column) -> Column:
    return F.concat(*[_spans(found, k) for k, found in _strict(text).items()])


def _tree_sql(lines: list[str], features: str) -> str:
    """A tree, as the library prints it, as a CASE expression."""
    line = lines.pop(0)
    if m := re.fullmatch(r"Predict: (\S+)", line):
        return f"{float(m[1])!r}D"
    m = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
    below = _tree_sql(lines, features)
    lines.pop(0)  # Else
    return f"CASE WHEN {features}[{m[1]}] <= {float(m[2])!r}D THEN {below} ELSE {_tree_sql(lines, features)} END"


_MODELS: dict[str, tuple[str, tuple[float, ...]]] = {}


def _model(spark: SparkSession) -> tuple[str, tuple[float, ...]]:
    """Margin of a candidate x as SQL, and the least margin to select, by kind; fitted once per application.

    A threshold lies between the examples of its kind that the trees did not see: above all that are no personal
    data. A kind without an accepted example above those is never added.
    """
    key = spark.sparkContext.applicationId
    if key not in _MODELS:
        examples = _examples(spark).withColumn("vector", array_to_vector("features")).cache()
        grown = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=_TREES, maxDepth=_DEPTH, stepSize=0.3,
                              minInstancesPerNode=1, seed=5).fit(examples.where("fold = 0"))
        lines = [x.strip() for x in grown.toDebugString.split("\n") if re.match(r"\s+(If|Else|Predict)", x)]
        margin = " + ".join(f"{float(w)!r}D * ({_tree_sql(lines, 'x.features')})" for w in grown.treeWeights)
        held = examples.where("fold = 1").select(
            "kind", "label", F.expr(f"transform(array(struct(features)), x -> {margin})[0]").alias("margin")).collect()
        examples.unpersist()
        limits = []
        for kind in range(len(KINDS)):
            bad = max((r.margin for r in held if r.kind == kind and not r.label), default=-1.0)
            good = min((r.margin for r in held if r.kind == kind and r.label and r.margin > bad), default=None)
            limits.append(1e9 if good is None else (good + bad) / 2)
        _MODELS[key] = margin, tuple(limits)
    return _MODELS[key]


def spans(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, strict, selected): arrays of (start, kind number, end), in order of start and kind.

    ``selected`` holds the strict spans and the candidates that the trees accept, but for those inside a strict
    span of their own kind. Null and empty texts have none. One row comes out per input row.
    """
    spark = docs.sparkSession
    margin, limits = _model(spark)
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text.alias("text")).select("doc_id", "text", _all_strict(F.col("text")).alias("strict"))
    proposed = found.select("doc_id", "text", "strict", candidates(F.col("text"), F.col("strict")).alias("c"))
    least = f"element_at(array({', '.join(f'{x!r}D' for x in limits)}), x.kind + 1)"
    accepted = F.expr(f"filter(c, x -> {margin} >= {least})")
    outside = F.filter(accepted, lambda c: ~F.exists("strict", lambda s: (s["kind"] == c["kind"]) & (s["start"] <= c["start"]) & (s["end"] >= c["end"])))
    added = F.transform(outside, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return proposed.select("doc_id", "text", F.array_sort("strict").alias("strict"),
                           F.array_sort(F.array_distinct(F.concat("strict", added))).alias("selected"))


def _named(found: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one per input row.

    Counts and base_sha256 are of the strict spans, ``spans`` lists all selected ones as kind:start:end.
    Other columns are ignored.
    """
    found = spans(docs)
    counts = [F.expr(f"size(filter(strict, s -> s.kind = {i}))").cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_named("strict"), 256).alias("base_sha256"), _named("selected").alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with each selected span replaced by its kind in brackets; of overlapping spans the outer, first ones count."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    ordered = F.array_sort(F.transform("selected", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    step = lambda a, s: F.when(s["start"] >= a["at"], F.struct(
        (-s["back"]).alias("at"), F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]),
                                           F.element_at(names, s["kind"] + 1)).alias("out"))).otherwise(a)
    done = F.aggregate(ordered, start, step)
    bound = F.transform(F.array(done), lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return spans(docs).select("doc_id", bound[0].alias("text"))
