"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers, names and units of documents and benchmark items become typed placeholders. Windows of the resulting
templates are hash-joined, matches are lined up per diagonal (document position minus item position), and each value
of the item must stand for one value of the document. So a question is found again after its numbers or names were changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postmill.llm.common import hinted, kept

#: Tokens in a window, and tokens in a row that prove a copy (or the whole item, if it is shorter).
WINDOW = 8
COPIED = 13
#: Items with fewer tokens are no questions and are not looked for.
LEAST_TOKENS = 4
UNITS = ("mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound "
         "pounds oz ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes "
         "hour hours day days week weeks month months year years percent degree degrees dollar dollars euro euros cent "
         "cents usd eur gbp mph kmh kph watt watts kw kwh volt volts joule joules")


#: Capitalised words that are no names, wherever they stand.
COMMON = ("A About After All An And Another Any Are As At Be Because Before Both But By Can Compute Could Did Do Does During Each "
          "Every Explain Find For From Give Given Had Has Have He Her His How However I If In Into Is It Its Let Many May Most My "
          "Name No Not Now Of On Once One Or Our Over She Should Since So Some Suppose Than That The Their Then There These They "
          "This Those Though To Under Until Was We Were What When Where Which While Who Whom Whose Why Will With Would You Your")


def canonical(text: Column) -> Column:
    """Tokens between single blanks, lower-cased: words, and ``#12``, ``@name``, ``%unit`` for values of slots.

    A number is one value with its separators and decimals. A name is a run of capitalised words that are not in COMMON, wherever
    it stands (``@first_second``); a unit is one of UNITS behind a number.
    """
    plain = text
    for mark in "#@%_\u066b":
        plain = F.replace(plain, F.lit(mark), F.lit(" "))
    named = F.regexp_replace(  # asks for a capital first, which most places are not
        plain, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{M}}\p{{N}}])(?!(?:{'|'.join(COMMON.split())})(?![\p{{L}}\p{{M}}]))\p{{Lu}}[\p{{Ll}}\p{{M}}]+(?![\p{{L}}\p{{M}}])", "@$0%")
    runs = F.regexp_replace(named, r"%(?:\s+|-)@", "_")
    whole = F.regexp_replace(F.lower(F.replace(runs, F.lit("%"), F.lit(" "))), "[,'\u2019\u202f](?<=[0-9].)(?=[0-9]{3}(?![0-9]))", "")
    decimal = F.regexp_replace(whole, "[.,](?<=[0-9].)(?=[0-9])", "\u066b")
    numbered = F.regexp_replace(decimal, "[0-9]+(?:\u066b[0-9]+)*", " #$0 ")
    words = F.trim(F.regexp_replace(numbered, r"[^a-z0-9#@_\u066b\p{L}\p{M}\p{N}]+", " "))
    return F.regexp_replace(words, rf"(#[0-9\u066b]+) (?=(?:{'|'.join(UNITS.split())})(?: |$))", "$1 %")


def _is_slot(token: Column) -> Column:
    return F.substring(token, 1, 1).isin("#", "@", "%")


def _tokens(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but text, tokens, and marks: the tokens with slots reduced to their marks."""
    rest = [c for c in docs.columns if c != "text"]
    return docs.select(*rest, canonical(F.col("text")).alias("canon")).select(
        *rest, F.split("canon", " ").alias("tokens"), F.split(F.regexp_replace("canon", "([#@%])[^ ]+", "$1"), " ").alias("marks"))


def _windows(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows (doc_id, pos, h) of each window of ``sizes`` tokens: a narrow row a window, made and hashed in generated code."""
    first = min(sizes)
    length = F.size("marks")
    placed = _tokens(docs).select("doc_id", "marks", F.explode(F.when(length >= first, F.sequence(F.lit(0), length - first))).alias("pos"))
    if len(sizes) == 1:
        return placed.select("doc_id", "pos", F.xxhash64(F.slice("marks", F.col("pos") + 1, first)).alias("h"))
    placed = placed.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size")).where("pos + size <= size(marks)")
    return placed.select("doc_id", "pos", F.xxhash64(F.slice("marks", F.col("pos") + 1, F.col("size"))).alias("h"))


def _slots(docs: DataFrame, places: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows (doc_id, pos, h, slots) of the windows at the given (doc_id, pos), with the values of their slots in order."""
    asked = kept(places.groupBy(F.col("doc_id").alias("asked_id")).agg(F.collect_set("pos").alias("places")))  # no longer than a text
    n = asked.agg(F.sum(F.size("places"))).first()[0] or 0
    found = _tokens(docs.join(hinted(asked, n), F.col("doc_id").eqNullSafe(F.col("asked_id"))))

    def of(size: int) -> Column:
        def window(pos: Column) -> Column:
            spelled = F.array_join(F.slice("tokens", pos + 1, size), " ")
            return F.struct(pos.alias("pos"), F.xxhash64(F.slice("marks", pos + 1, size)).alias("h"),
                            F.regexp_extract_all(spelled, F.lit("[#@%][^ ]*"), F.lit(0)).alias("slots"))

        return F.transform(F.filter("places", lambda pos: pos + size <= F.size("marks")), window)

    windows = F.concat(*map(of, sizes))
    return found.select("doc_id", F.explode(windows).alias("w")).select("doc_id", "w.*")


def _numberings(items: DataFrame) -> DataFrame:
    """Rows (item_id, numbering, tokens, n_tokens): an item as it stands, and in lower case if that parts a run of names."""
    cut = lambda text: F.split(canonical(text), " ")
    both = items.select("item_id", cut(F.col("text")).alias("s"), cut(F.lower("text")).alias("l")).select("item_id", F.explode(F.array(
        F.struct(F.lit(0).alias("numbering"), F.col("s").alias("tokens")),
        F.struct(F.lit(1).alias("numbering"), F.when(F.size("s") != F.size("l"), F.col("l")).alias("tokens")))).alias("x"))
    return both.select("item_id", "x.*").where("tokens[0] <> ''").withColumn("n_tokens", F.size("tokens"))


def _item_windows(items: DataFrame, window: int, least_tokens: int) -> DataFrame:
    """Windows of items in every form a copy may have: single names also as words, for a copy in lower case, and the first
    word also as a name (``=@word``, which only the same word fits), for a copy that begins a sentence with it."""
    common = [x.lower() for x in COMMON.split()]
    size = F.least("n_tokens", F.lit(window))
    t = F.col("t")
    other = F.when(t.startswith("@") & ~t.contains("_"), F.substring(t, 2, 1 << 30)).when(
        (F.col("i") == 0) & ~F.substring(t, 1, 1).isin("#", "@", "%") & ~t.isin(*common) & t.rlike(r"^\p{L}[\p{L}\p{M}]+$"), F.concat(F.lit("=@"), t))
    tokens = _numberings(items).where(F.col("n_tokens") >= least_tokens).select(
        "item_id", "numbering", "n_tokens", F.posexplode("tokens").alias("i", "t")).withColumn("other", other).groupBy(
        "item_id", "numbering", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("i", "t", "other"))).alias("tokens"))
    placed = tokens.select("*", F.explode(F.sequence(F.lit(0), F.col("n_tokens") - size)).alias("item_pos")).select(
        "item_id", "numbering", "n_tokens", "item_pos", F.slice("tokens", F.col("item_pos") + 1, size).alias("w"))
    bit = lambda mask, k: F.get(F.array(*[F.lit(1 << j) for j in range(window)]), k).bitwiseAND(mask)
    forms = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << window) - 1))).alias("mask")).where(
        (F.shiftrightunsigned("mask", 0) < F.pow(F.lit(2), F.size("w"))) &
        F.forall(F.transform("w", lambda x, k: (bit(F.col("mask"), k) == 0) | x["other"].isNotNull()), lambda x: x)).select(
        "*", F.transform("w", lambda x, k: F.when(bit(F.col("mask"), k) > 0, x["other"]).otherwise(x["t"])).alias("form"))
    bare = F.transform("form", lambda x: F.when(x.startswith("="), F.substring(x, 2, 1 << 30)).otherwise(x))
    slots = F.filter("form", lambda x: F.substring(x, 1, 1).isin("#", "@", "%", "="))
    h = F.xxhash64(F.transform(bare, lambda x: F.when(_is_slot(x), F.substring(x, 1, 1)).otherwise(x)))
    return forms.select("item_id", "numbering", "n_tokens", "item_pos", h.alias("h"),
                        F.when(F.size(slots) > 0, slots).alias("item_slots"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, copied: int = COPIED,
            least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """Rows (doc_id, item_id): documents that hold an item, or ``copied`` of its tokens in a row, up to slot values.

    At least as many windows of one diagonal as such a run has must match, and over those the slot values of the
    item must map to one value of the document each. The item windows are broadcast only once they
    are counted and few; documents are not shuffled before the join.
    """
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    lengths = _numberings(items).select(F.col("n_tokens").alias("n")).where(F.col("n") >= least_tokens)
    short = sorted(r.n for r in lengths.where(F.col("n") < window).distinct().collect())  # below `window` numbers
    sizes = [window, *short]
    wanted = kept(_item_windows(items, window, least_tokens))
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    n_wanted = wanted.count()
    line = ["doc_id", "item_id", "numbering", "n_tokens", (F.col("pos") - F.col("item_pos")).alias("diagonal")]
    needed = F.least(F.lit(copied), "n_tokens") - F.least(F.lit(window), "n_tokens") + 1
    # First templates alone: which places of which documents lie on a diagonal that is long enough, whatever its values.
    hits = _windows(texts, sizes).join(hinted(wanted.drop("item_slots").distinct(), n_wanted), "h")
    lines = hits.groupBy(*line).agg(F.collect_set("pos").alias("places")).where(F.size("places") >= needed)
    places = kept(lines.select("doc_id", F.explode("places").alias("pos")).distinct())
    # Then their values.
    n_slots = lambda c: F.coalesce(F.size(c), F.lit(0))
    valued = _slots(texts, places, sizes).join(hinted(wanted, n_wanted), "h").where(n_slots("slots") == n_slots("item_slots"))
    lined = valued.groupBy(*line).agg(
        F.size(F.collect_set("pos")).alias("n"),  # sets are bounded by the length of an item
        F.array_distinct(F.flatten(F.collect_set(F.when(F.size("slots") > 0, F.arrays_zip("item_slots", "slots"))))).alias("pairs"))
    function = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"]))) == F.size("pairs")
    same = F.forall("pairs", lambda p: ~p["item_slots"].startswith("=") | (p["item_slots"] == F.concat(F.lit("="), p["slots"])))
    return lined.where((F.col("n") >= needed) & function & same).select("doc_id", "item_id").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The rows of the input whose doc_id has no match; see ``report`` for the rules."""
    found = kept(matches(docs, benchmark, **options).select("doc_id").distinct())
    return docs.join(hinted(found, found.count()), docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def report(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """Rows (doc_id, contaminated, n_items, item_ids), one per input row; item_ids is ascending.

    Null and empty texts hold nothing; null and empty items, and items of fewer than ``least_tokens`` tokens, are not looked for.
    Rows that share a doc_id (also null) are judged together. Repeated items count by item_id. Other columns are
    ignored.
    """
    found = kept(matches(docs, benchmark, **options).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
                 .withColumnRenamed("doc_id", "found_id"))
    ids = docs.select("doc_id")
    kind = dict(found.dtypes)["item_ids"]
    return ids.join(found, ids["doc_id"].eqNullSafe(found["found_id"]), "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", F.array().cast(kind)).alias("item_ids"))
