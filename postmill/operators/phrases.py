"""Phrases of a dictionary in texts, leftmost and longest first: which skills a description names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postmill.sources.staging import staged

#: Dictionary rows up to which it is broadcast once counted; each is some 60 bytes there.
BROADCAST_ROWS = 1_000_000
#: A word: letters and digits, inner dots, a leading dot, and the signs of names like C++ and C#.
WORD = r"\.?[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*[+#]*"


def words(text: Column) -> Column:
    """Lower-cased words in order; everything else parts words."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def opening_words(text: Column, n: int) -> Column:
    """The first ``n`` of ``words``, or none if there are fewer; the rest of a text is not searched.

    Each word with what parts it from the one before is matched as one piece that is never tried anew, so a text is passed once at most.
    """
    text = F.lower(text)
    opening = F.regexp_substr(text, F.lit("(?s)^" + f"(?>.*?{WORD})" * n))
    return F.coalesce(F.regexp_extract_all(opening, F.lit(WORD), F.lit(0)), F.when(text.isNotNull(), F.array().cast("array<string>")))


def _keys(tokens: Column) -> tuple[Column, Column]:
    """128 bits for a run of words."""
    return F.xxhash64(tokens).alias("k1"), F.xxhash64(F.lit("phrase"), F.size(tokens), tokens).alias("k2")


def dictionary(phrases: DataFrame) -> DataFrame:
    """Rows (k1, k2, n_words, label) of a table (phrase, label): a synonym per row. A phrase with several labels has the smallest one.

    Null and wordless phrases and null labels are left out.
    """
    tokens = phrases.select(words(F.col("phrase")).alias("tokens"), "label").where("size(tokens) > 0 AND label IS NOT NULL")
    return tokens.groupBy(*_keys(F.col("tokens")), F.size("tokens").alias("n_words")).agg(F.min("label").alias("label"))


def find_phrases(rows: DataFrame, text: str, phrases: DataFrame, keep: list[str], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows (*keep, first_word, n_words, label): phrases in a text that do not overlap, the leftmost first and of those the longest.

    The runs of words that are as long as some phrase become narrow rows, made and hashed in generated code, and meet the dictionary in a
    hash join; only hits are shuffled, to choose among those of one text. A dictionary beyond ``broadcast_rows`` is joined by shuffling.
    Texts are never compared with each phrase in turn, so the cost does not grow with the dictionary. Input rows are taken one by one, whatever
    they share; null texts name nothing.
    """
    terms = staged(dictionary(phrases))  # read again for its lengths, its size and the join
    lengths = sorted(r.n_words for r in terms.select("n_words").distinct().collect())  # a few numbers
    n = terms.count()
    numbered = rows.select(*keep, F.monotonically_increasing_id().alias("row"), words(F.col(text)).alias("tokens"))
    size = F.size("tokens")
    if not lengths:
        lengths = [1]
    least = lengths[0]
    runs = numbered.select(*keep, "row", "tokens", F.explode(F.when(size >= least, F.sequence(F.lit(0), size - least))).alias("at"))
    if len(lengths) > 1:
        runs = runs.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("n")).where("at + n <= size(tokens)")
    else:
        runs = runs.withColumn("n", F.lit(least))
    keyed = runs.select(*keep, "row", "at", "n", *_keys(F.slice("tokens", F.col("at") + 1, F.col("n"))))
    side = terms.select("k1", "k2", F.col("n_words").alias("n"), "label")
    hits = keyed.join(F.broadcast(side) if n <= broadcast_rows else side, ["k1", "k2", "n"])
    longest = hits.groupBy("row", *keep, "at").agg(F.max(F.struct("n", "label")).alias("hit"))
    sorted_hits = F.array_sort(F.collect_list(F.struct("at", F.col("hit.n").alias("n"), F.col("hit.label").alias("label"))))
    found = longest.groupBy("row", *keep).agg(sorted_hits.alias("hits"))  # no longer than the text
    none = F.slice("hits", 1, 0)
    chosen = F.aggregate(
        "hits", F.struct(F.lit(0).alias("end"), none.alias("taken")),
        lambda s, h: F.when(h["at"] >= s["end"], F.struct((h["at"] + h["n"]).alias("end"), F.concat(s["taken"], F.array(h)).alias("taken"))).otherwise(s),
        lambda s: s["taken"])
    return found.select(*keep, F.explode(chosen).alias("hit")).select(
        *keep, F.col("hit.at").alias("first_word"), F.col("hit.n").alias("n_words"), F.col("hit.label").alias("label"))


def demand(found: DataFrame, row_key: str, n_rows: int | None = None) -> DataFrame:
    """Rows (label, n_rows, n_mentions): in how many rows, and how often, each label is named."""
    per_row = found.groupBy(row_key, "label").agg(F.count("*").alias("n"))
    return per_row.groupBy("label").agg(F.count("*").alias("n_rows"), F.sum("n").alias("n_mentions"))
