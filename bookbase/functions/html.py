"""Catalogue page markup as Column expressions.

Bounded to flat markup: a table nested inside the picked one ends it early.
"""

import re
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookbase.functions.bind import let
from bookbase.functions.text import strip

#: Names of HTML's own table with their semicolon, each between a start and an end mark, then its text.
NAMES = "".join(f"\x01{name}\x02{text}" for name, text in sorted(entities.html5.items()) if name.endswith(";")) + "\x01"

# What HTML reads the code points 128 to 159 as.
C1 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def _character(code):
    """The character that HTML reads a numeric entity of this code point as."""
    none = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(none, F.lit("\ufffd"))
        .when(code.between(128, 159), F.substring(F.lit(C1), (code - 127).cast("int"), F.lit(1)))
        .otherwise(plain)
    )


def _decoded(piece):
    """A piece of text that stood behind `&`, its entity decoded."""

    def shown(entity):
        decimal = F.regexp_extract(entity, "^#([0-9]{1,9});$", 1)
        hexadecimal = F.regexp_extract(entity, "^#[xX]([0-9a-fA-F]{1,8});$", 1)
        mark = F.concat(F.lit("\x01"), entity, F.lit("\x02"))
        at = F.instr(F.lit(NAMES), mark)
        named = F.substring_index(F.substring(F.lit(NAMES), at + F.length(mark), F.lit(8)), "\x01", 1)
        rest = F.substring(piece, F.length(entity) + 1, F.length(piece))
        return (
            F.when(entity == "", F.concat(F.lit("&"), piece))
            .when(decimal != "", F.concat(_character(decimal.cast("bigint")), rest))
            .when(hexadecimal != "", F.concat(_character(F.conv(hexadecimal, 16, 10).cast("bigint")), rest))
            .when(entity.startswith("#"), F.concat(F.lit("\ufffd"), rest))
            .when(at > 0, F.concat(named, rest))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    return let(F.regexp_extract(piece, "^(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)", 1), shown)


def unescape(c) -> Column:
    """Decode the numeric entities and all named ones of HTML, from left to right in one pass.

    Entities end in a semicolon; unknown names stay as they are. What an entity stands for is not
    decoded again.
    """

    def joined(pieces):
        rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _decoded)
        return F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))

    return let(c, lambda t: F.when(t.contains("&"), let(F.split(t, "&"), joined)).otherwise(t))


def inner_text(c) -> Column:
    """Markup removed, entities decoded, ends trimmed."""
    return strip(unescape(F.regexp_replace(c, r"(?s)<[^>]*>", "")))


def first_table(html, css_class) -> Column:
    """Markup of the first table whose class list holds `css_class`; null when there is none."""
    name = re.escape(css_class)
    value = (
        rf'(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"'
        rf"|'(?:[^']*\s)?{name}(?:\s[^']*)?'"
        rf"|{name}(?=[\s>]))"
    )
    pattern = (
        rf"(?s)<(?i:table)(?=\s)[^>]*?\s(?i:class)\s*=\s*{value}[^>]*>.*?(?:</(?i:table)\s*>|\z)"
    )
    seen = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    return F.nullif(F.regexp_extract(seen, pattern, 0), F.lit(""))


def _cell(row, tag):
    markup = F.regexp_extract(row, rf"(?s)<(?i:{tag})\b[^>]*>.*?(?:</(?i:{tag})\s*>|\z)", 0)
    return let(markup, lambda m: F.when(m != "", inner_text(m)))


def table_pairs(table) -> Column:
    """ARRAY<STRUCT<field, value>> of the rows that have both a heading and a data cell."""
    rows = F.regexp_extract_all(
        table, F.lit(r"(?s)<(?i:tr)\b[^>]*>(.*?)(?:</(?i:tr)\s*>|(?=<(?i:tr)\b)|\z)"), F.lit(1)
    )
    pairs = F.transform(rows, lambda r: F.struct(_cell(r, "th").alias("field"), _cell(r, "td").alias("value")))
    return F.filter(pairs, lambda p: p["field"].isNotNull() & p["value"].isNotNull())


def last_value(pairs, field) -> Column:
    """Value of the last pair named `field`, or an empty string."""
    kept = F.filter(pairs, lambda p: p["field"] == F.lit(field))
    return F.coalesce(F.try_element_at(kept, F.lit(-1))["value"], F.lit(""))


def all_values(pairs, field) -> Column:
    """Every value of the pairs named `field`, in page order."""
    return F.transform(F.filter(pairs, lambda p: p["field"] == F.lit(field)), lambda p: p["value"])


def first_element_text(html, tag) -> Column:
    """Text of the first `tag` element; an empty string when there is none."""
    pattern = rf"(?s)<(?i:{tag})\b[^>]*>(.*?)</(?i:{tag})\s*>"
    return inner_text(F.regexp_extract(html, pattern, 1))


def root_language(html) -> Column:
    """The `lang` attribute of the root element; an empty string when there is none."""
    return F.regexp_extract(html, r"""(?s)<(?i:html)\b[^>]*?\s(?i:lang)\s*=\s*["']?([^"'\s>]+)""", 1)
