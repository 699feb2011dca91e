"""Column helpers for free text: whitespace, markup, missing tokens, keyword labels."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Whitespace in the sense of Unicode text plus the four ASCII separators. Always used
# together with the (?U) flag so that \s and \b look at Unicode properties.
SPACE = r"[\s\x1c-\x1f]"

# Tokens that stand for "no value" in a text cell.
MISSING_ANY_CASE = ("", "nan", "none", "unknown")
MISSING_EXACT = ("", "nan", "None", "Unknown")
UNKNOWN = "Unknown"


def strip(c: Column) -> Column:
    """Remove whitespace of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+$", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it several times in one expression.

    A plain reuse would repeat long texts and regular expressions in every branch. The body
    also stays out of the generated code of its stage: a stage with many parsers would grow
    beyond 8,000 bytes per method, which the JVM no longer compiles.
    """
    none = F.array().cast("array<int>")
    return F.aggregate(none, value, lambda bound, _: bound, body)


def computed_once(df: DataFrame, struct: Column, outputs: dict[str, str]) -> DataFrame:
    """Add fields of a costly struct expression as columns (output name: field name).

    The struct passes through a one-element array because the optimizer copies a struct
    expression into each of its field accesses, which would run a parser once per field.
    """
    parsed = F.try_element_at(F.col("_parsed"), F.lit(1))
    df = df.withColumn("_parsed", F.transform(F.array(struct), lambda x: x))
    return df.withColumns({out: parsed[field] for out, field in outputs.items()}).drop("_parsed")


def as_text(c: Column, data_type: T.DataType) -> Column:
    """String view of a column; complex types become JSON."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


# --- markup -----------------------------------------------------------------------------

def _named_entities() -> Column:
    """All names with their semicolon; names allowed without it mean the same with it."""
    table = {k: v for k, v in html5.items() if k.endswith(";")}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _bare_entity_pattern() -> str:
    """Legacy names that need no semicolon, longest first so that the longest prefix wins."""
    bare = sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True)
    return "^(" + "|".join(bare) + ")"


def _windows_1252() -> str:
    """Characters for 0x80-0x9f: read as Windows-1252, the five unassigned codes as they are."""
    return "".join(bytes([c]).decode("cp1252", errors="ignore") or chr(c) for c in range(0x80, 0xA0))


def _code_point(n: Column) -> Column:
    """Character for a numeric reference, with the HTML5 rules for invalid numbers."""
    return (
        F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd")
        .when(n.between(0x80, 0x9F), F.substr(F.lit(_windows_1252()), (n - 0x7F).cast("int"), F.lit(1)))
        .when(n == 0x0D, "\r")
        .when(
            n.between(0x01, 0x08)
            | (n == 0x0B)
            | n.between(0x0E, 0x1F)
            | (n == 0x7F)
            | n.between(0xFDD0, 0xFDEF)
            | (n % 0x10000 >= 0xFFFE),
            "",
        )
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    )


# Decimal or hexadecimal reference; numbers of more digits are outside Unicode anyway.
_NUMERIC = "^#(?:0*([0-9]+)|[xX]0*([0-9a-fA-F]+));?"


def _numeric_reference(s: Column) -> Column:
    decimal, hexadecimal = F.regexp_extract(s, _NUMERIC, 1), F.regexp_extract(s, _NUMERIC, 2)
    number = F.when(F.length(decimal).between(1, 9), decimal.cast("bigint")).when(
        F.length(hexadecimal).between(1, 7), F.conv(hexadecimal, 16, 10).cast("bigint")
    )
    return F.concat(let(number, _code_point), F.regexp_replace(s, _NUMERIC, ""))


def _named_reference(s: Column) -> Column:
    """Longest known name at the start; an unknown one keeps its ampersand."""
    table = _named_entities()
    known = F.struct(
        F.regexp_extract(s, r"^[^\t\n\f <&#;]{1,32};", 0).alias("full"),
        F.regexp_extract(s, _bare_entity_pattern(), 0).alias("bare"),
    )

    def resolve(name: Column) -> Column:
        value = F.try_element_at(table, name["full"])
        return (
            F.when(value.isNotNull(), F.concat(value, F.substr(s, F.length(name["full"]) + 1)))
            .when(
                name["bare"] != "",
                F.concat(
                    F.try_element_at(table, F.concat(name["bare"], F.lit(";"))),
                    F.substr(s, F.length(name["bare"]) + 1),
                ),
            )
            .otherwise(F.concat(F.lit("&"), s))
        )

    return let(known, resolve)


def _decode_after_ampersand(s: Column) -> Column:
    """Decode the text that followed one ``&``."""
    out = F.when(s.startswith("amp;"), F.concat(F.lit("&"), F.substr(s, F.lit(5))))
    out = out.when(s.startswith("nbsp;"), F.concat(F.lit(html5["nbsp;"]), F.substr(s, F.lit(6))))
    return out.when(s.rlike(_NUMERIC), _numeric_reference(s)).otherwise(_named_reference(s))


def unescape_html(c: Column) -> Column:
    """Resolve HTML character references in one pass, inside the JVM.

    The text is cut at ampersands and each piece decodes its own leading reference, so a
    decoded ``&`` never starts a second reference. Text without ``&`` is returned as it is.
    """
    pieces = F.split(c, "&", -1)
    decoded = F.transform(F.slice(pieces, 2, F.size(pieces)), _decode_after_ampersand)
    joined = F.concat(F.get(pieces, F.lit(0)), F.array_join(decoded, ""))
    return F.when(c.contains("&"), joined).otherwise(c)


#: Listed one by one: ranges make Java test this class many times slower.
_UNCLEAN = r"[&<\t\n\x0b\f\r\x1c\x1d\x1e\x1f]"


def clean_text(c: Column) -> Column:
    """Plain text of an HTML fragment: references resolved, tags out, whitespace collapsed.

    References are resolved before tags are removed, so an escaped tag is removed too.
    NULL becomes the empty string.
    """

    def plain(text: Column) -> Column:
        untagged = F.regexp_replace(unescape_html(text), "<[^>]+>", " ")
        return F.coalesce(F.trim(F.regexp_replace(untagged, f"(?U){SPACE}+", " ")), F.lit(""))

    def cleaned(text: Column) -> Column:
        # ASCII without "&", "<", surplus blanks and other white space is clean already, which costs less to tell.
        clean = (F.octet_length(text) == F.length(text)) & ~text.startswith(" ") & ~text.endswith(" ") & ~text.contains("  ")
        return F.when(clean & ~text.rlike(_UNCLEAN), text).otherwise(plain(text))

    return let(c, cleaned)


# --- missing values ---------------------------------------------------------------------


def null_tokens(c: Column, tokens: Sequence[str]) -> Column:
    """Turn exact matches of the given tokens into NULL."""
    return F.when(~c.isin(*tokens), c)


def is_missing(c: Column, data_type: T.DataType, tokens: Iterable[str] = MISSING_ANY_CASE,
               any_case: bool = True) -> Column:
    """Missing-value predicate for a column of any type (never NULL itself).

    Text is compared after stripping, without regard to case unless ``any_case`` is False.
    Fractional numbers are missing when NULL or NaN, arrays when NULL or empty.
    """
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        text = strip(c)
        return c.isNull() | (F.lower(text) if any_case else text).isin(*tokens)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    if isinstance(data_type, T.ArrayType):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull()


def is_missing_exact(c: Column, data_type: T.DataType = T.StringType()) -> Column:
    """Case-sensitive variant used by scores and frequency tables."""
    return is_missing(c, data_type, MISSING_EXACT, any_case=False)


def is_known(c: Column) -> Column:
    """True unless the value is exactly "Unknown"; NULL counts as known."""
    return ~c.eqNullSafe(F.lit(UNKNOWN))


# --- keywords ---------------------------------------------------------------------------


def has_word(c: Column, words: Sequence[str], flags: str = "") -> Column:
    """Does any of the words or phrases occur, delimited by word boundaries?

    Plain searches for the words come first, since most texts hold none. Without regard to case (flag i) they look at the
    lower-cased text, unless a word has a letter that the pattern also takes for one with another lower case (dotless i, long s).
    """
    alternatives = "|".join(re.escape(w).replace(r"\ ", " ").replace(r"\-", "-") for w in words)
    found = c.rlike(f"(?U{flags})\\b(?:{alternatives})\\b")
    needed = sorted({w.lower() if "i" in flags else w for w in words})
    needed = [w for w in needed if not any(v != w and v in w for v in needed)]
    if "i" in flags and any({"i", "s"} & set(w) for w in needed):
        return found
    text = F.lower(c) if "i" in flags else c
    some = text.contains(needed[0])
    for w in needed[1:]:
        some = some | text.contains(w)
    return some & found


def first_label(c: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str = UNKNOWN) -> Column:
    """Label of the first rule whose words occur in the (lower-cased) text."""

    def choose(text: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for label, words in rules:
            out = out.when(has_word(text, words), F.lit(label))
        return out.otherwise(F.lit(default))

    return let(c, choose)
