"""HTML to text."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterloom.functions.text import bind, constant_map, strip_blank

# Comments, and elements whose text is not shown; one that is not closed reaches to the end.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*+>|\z)|<style\b.*?(?:</style\s*+>|\z)"
# A tag may hold ">" inside quoted attributes; an unbalanced quote ends at ">".
TAG = (
    r"""<[a-zA-Z/!?][^<>"']*+(?:"[^"<]*+"[^<>"']*+|'[^'<]*+'[^<>"']*+)*+>"""
    r"""|<[a-zA-Z/!?][^>]*>"""
)
ENTITY = r"^(?:#([0-9]++);?|#[xX]([0-9a-fA-F]++);?|([A-Za-z][A-Za-z0-9]*+);)"


def _code_point(number: Column) -> Column:
    """The character of a code point; one that is not a character gives U+FFFD."""
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    units = F.lpad(F.hex(F.when(valid, number).otherwise(0xFFFD)), 8, "0")
    return F.decode(F.unhex(units), "UTF-32")


def unescape(text: Column) -> Column:
    """Replace character references. Text without "&" is left as it is."""
    named = constant_map({name[:-1]: char for name, char in html5.items() if name.endswith(";")})

    def number(digits: Column, base: int, most: int) -> Column:
        """The value of all the digits; more of them than any character has give no character."""
        bare = F.ltrim(digits, F.lit("0"))
        return F.when(F.length(bare) > most, -1).otherwise(F.conv(F.concat(F.lit("0"), bare), base, 10).cast("long"))

    def after_ampersand(piece: Column) -> Column:
        decimal = F.regexp_extract(piece, ENTITY, 1)
        hexadecimal = F.regexp_extract(piece, ENTITY, 2)
        char = (
            F.when(decimal != "", _code_point(number(decimal, 10, 7)))
            .when(hexadecimal != "", _code_point(number(hexadecimal, 16, 6)))
            .otherwise(F.try_element_at(named, F.regexp_extract(piece, ENTITY, 3)))
        )
        return F.coalesce(
            F.concat(char, F.regexp_replace(piece, ENTITY, "")), F.concat(F.lit("&"), piece)
        )

    def replace_all(text: Column) -> Column:
        pieces = F.transform(
            F.split(text, "&"),
            lambda piece, pos: F.when(pos == 0, piece).otherwise(after_ampersand(piece)),
        )
        return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)

    return bind(text, replace_all)


def _without_tags(text: Column) -> Column:
    """The text without its tags, in time that grows with its length.

    No tag begins behind the last ">". Before it every "<" of a tag finds an end, and what has been read
    in search of it is removed with the tag, but for one look at the quotes up to the next "<".
    """
    tail = F.substring_index(text, ">", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    return F.concat(F.regexp_replace(head, TAG, ""), tail)


def html_text(html: Column) -> Column:
    """The text content of a page or an HTML body, trimmed."""
    return strip_blank(unescape(bind(F.regexp_replace(html, HIDDEN, ""), _without_tags)))
