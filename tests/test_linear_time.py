"""Long hostile inputs: no pattern may take time that grows faster than the text."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from letterloom.functions.addresses import parse_address, parse_address_list
from letterloom.functions.body import cut_inline, strip_quotes
from letterloom.functions.headers import all_headers, clean_subject
from letterloom.functions.html import html_text
from letterloom.functions.tagging import tag_patterns

LONG, SHORT = 10_000_000, 1_000_000


def repeated(unit, size):
    return (unit * (size // len(unit) + 1))[:size]


@pytest.fixture(scope="module")
def seconds(spark):
    """Seconds for one text, after the expression has run on a short one, so that compiling does not count."""

    def run(function, text):
        for value in (text[:10], text):
            df = spark.createDataFrame([(value,)], "text string")
            started = time.monotonic()
            df.select(F.xxhash64(function(F.col("text")))).collect()
        return time.monotonic() - started

    return run


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<a '\">", "<", "<!--", "<script ", "</script ", "a>"])
def test_html(seconds, unit):
    assert seconds(html_text, repeated(unit, LONG)) < 5


@pytest.mark.parametrize("unit", ["a", "a ", "<", "@", '"', "a@"])
def test_addresses(seconds, unit):
    assert seconds(parse_address, repeated(unit, LONG)) < 5
    assert seconds(lambda c: F.size(parse_address_list(c)), repeated(unit, SHORT)) < 5


@pytest.mark.parametrize("unit", ["]", "] ", "[ ", "( ", " ", "RE ", "a.b-", "1,", "www.", ">\n", "-", "On x ", "On x\n", "On x wrote:\n", "On x wrote:\n>\n", "\n ", "wrote:"])
def test_other_patterns(seconds, unit):
    text = repeated(unit, SHORT) + "x"
    for function in (clean_subject, cut_inline, strip_quotes, tag_patterns, lambda c: F.size(all_headers(c))):
        assert seconds(function, text) < 5


def test_tags_as_before(column):
    """Each "<" of a tag takes the text up to its end, quotes observed; behind the last ">" nothing is a tag."""
    cases = {
        '<a title="1 > 0">x</a>': "x",
        "a <b <c> d": "a  d",
        "<a 'x>y": "y",
        '<a "><b>z': "z",
        "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
        "end <a": "end <a",
        "x > y <a": "x > y <a",
        "<": "<",
        "": "",
        None: None,
    }
    assert column(list(cases), html_text) == list(cases.values())


def test_closing_brackets_of_subjects(column):
    cases = {"x ]]] ": "x ", "x ]]] y": "x ]]] y", "[x]": "[x", "RE: ]]]x": "x", "]": "", "a] b]]": "a] b"}
    assert column(list(cases), clean_subject) == list(cases.values())
