"""Text expressions shared by the header, body and token steps."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a blank strip removes (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ASCII_WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCTUATION_RUN = r"[!-/:-@\[-`{-~]+"

# The line breaks other than "\n" and the pair "\r\n".
OTHER_LINE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def _accent_table() -> tuple[str, str]:
    """Latin letters that decompose to one ASCII letter plus marks, and that letter."""
    accented, plain = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base, *marks = unicodedata.normalize("NFKD", chr(code))
        if marks and base.isascii() and base.isalpha() and all(map(unicodedata.combining, marks)):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, UNACCENTED = _accent_table()


def bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def constant_map(entries: dict[str, str]) -> Column:
    """A map literal from two short strings; its separators must not be in the entries."""
    return F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in entries.items())), F.lit("\x02"), F.lit("\x01"))


def constant_list(items: Sequence[str]) -> Column:
    return F.split(F.lit("\x02".join(items)), "\x02")


def valid_text(value: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 become U+FFFD."""
    return F.make_valid_utf8(value.cast("string"))


def strip_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def unify_lines(text: Column) -> Column:
    """One break character for all line ends, and no break after the last line."""
    paired = F.replace(text, F.lit("\r\n"), F.lit("\n"))

    def translated(text: Column) -> Column:
        """Most texts hold none of the other breaks, and a look for them is quicker than a translation."""
        breaks = F.translate(text, OTHER_LINE_BREAKS, "\n" * len(OTHER_LINE_BREAKS))
        return F.when(text.rlike(f"[{OTHER_LINE_BREAKS}]"), breaks).otherwise(text)

    single = bind(paired, translated)
    return bind(single, lambda t: F.when(t.endswith("\n"), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t))


def length_between(text: Column, bounds: tuple[int, int]) -> Column:
    return F.length(text).between(*bounds)


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION_RUN, "")


def fold_accents(text: Column) -> Column:
    """Lower-case and drop the accents of Latin letters; ASCII text has none."""
    return bind(
        F.lower(text),
        lambda t: F.when(F.length(t) == F.octet_length(t), t).otherwise(F.translate(t, ACCENTED, UNACCENTED)),
    )
