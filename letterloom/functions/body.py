"""Body cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterloom.functions.text import bind, unify_lines
from letterloom.options import HEADER_HINT_PATTERN, SEPARATOR_PATTERN

# What the first two characters of a hit of the default patterns are, in any case; a quick test before the words,
# written out because Java folds the case of every character it tests otherwise.
HIT_START = "(?=[-_*=tsfcbTSFCB\u017f][-_*=ourcOURC])"
# The line or two that introduce quoted history, in the languages mail programs use.
QUOTE_INTRO = (
    r"[ \t]*(?:On|Le|Am|Op|El|Il|Den|Em) [^\n]*(?:\n[^\n]*)?"
    r"(?:wrote|a écrit|schrieb|schreef|escribió|ha scritto|skrev|escreveu) ?:[ \t]*(?=\n|\z)"
    r"|[ \t]*-+ ?Original Message ?-+[^\n]*"
)
# An introduction whose next line with text is quoted.
MARKED_INTRO = rf"(\A|\n)(?:{QUOTE_INTRO})(?=\n(?:[ \t]*\n)*+[ \t]*>)"


def cut_inline(
    text: Column,
    separator: str = SEPARATOR_PATTERN,
    header_hint: str = HEADER_HINT_PATTERN,
) -> Column:
    """The lines before the first one that looks like the start of another message."""
    known = (separator, header_hint) == (SEPARATOR_PATTERN, HEADER_HINT_PATTERN)
    hit = rf"{HIT_START if known else ''}(?iu:{separator}|{header_hint})"

    def whole_lines(parts: Column) -> Column:
        head = F.get(parts, F.lit(0))
        broken = F.length(F.substring_index(head, "\n", -1))
        return F.when(F.size(parts) == 1, head).otherwise(
            F.substring(head, F.lit(1), F.length(head) - broken - 1)
        )

    return bind(F.split(unify_lines(text), hit, 2), whole_lines)


def strip_quotes(text: Column) -> Column:
    """The text without the history it quotes.

    Where an introduction stands before quoted lines, it goes with all quoted lines of the text, and what is
    written between and below them stays, blank lines too. One that nothing quoted follows ends the text:
    its history has no marks. Quoted and blank lines at the end go in any case; other quoted lines stay where
    nothing introduces them. A quoted introduction is a quoted line. No text left is empty; null stays null.
    """

    def remaining(marked: Column) -> Column:
        cut = F.regexp_replace(marked["lines"], rf"(?s)(?:\A|\n)(?:{QUOTE_INTRO}).*\z", "")
        answer = F.regexp_replace(F.regexp_replace(cut, r"(?md)^[ \t]*>[^\n]*(?:\n|\z)", ""), r"\A(?:[ \t]*\n)++", "")
        return F.regexp_extract(F.when(marked["led"], answer).otherwise(cut), r"(?s)\A(?:.*\n)?[ \t]*[^>\s][^\n]*", 0)

    def marks(whole: Column) -> Column:
        # an introduction becomes a quoted line like those it stands before
        lines = F.when(F.contains(whole, F.lit(">")), F.regexp_replace(whole, MARKED_INTRO, "$1>")).otherwise(whole)
        return bind(lines, lambda quoted: bind(F.struct(quoted.alias("lines"), (quoted != whole).alias("led")), remaining))

    return bind(text, marks)
