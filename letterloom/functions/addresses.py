"""Address expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterloom.functions.text import bind

# Patterns without repeated groups: Java walks those by recursion, and a long header would
# exhaust the stack.
SIDES = r"(?s)^(\"[^\"\\]*\"|[^\"@]+)@([^@]+)$"
DOT_ATOM = r"(?i)^[-!#$%&'*+/=?^_`{}|~0-9a-z.]+$"
LABEL = r"(?i)^[a-z0-9-]+$"
LITERAL = r"^\[\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\]$"
#: Stands between list items; a code point that is no character.
ITEM_END = "\ufdd0"


def _dotted(domain: Column) -> Column:
    """Two labels or more; those before the last have 63 characters at most and no hyphen at an end."""

    def all_good(labels: Column) -> Column:
        def good(label: Column, pos: Column) -> Column:
            inner = (F.length(label) <= 63) & ~label.startswith("-") & ~label.endswith("-")
            return label.rlike(LABEL) & F.when(pos < F.size(labels) - 1, inner).otherwise(F.length(label) >= 2)

        return (F.size(labels) >= 2) & F.forall(F.transform(labels, good), lambda ok: ok)

    return bind(F.split(domain, r"\."), all_good)


def is_address(text: Column) -> Column:
    """A dot-atom or quoted local part at a dotted domain, an IPv4 literal or localhost.

    Text without an "@" is none, and no pattern is tried on it.
    """
    local, domain = F.regexp_extract(text, SIDES, 1), F.regexp_extract(text, SIDES, 2)

    def holds(sides: Column) -> Column:
        local, domain = sides["local"], sides["domain"]
        edges = local.startswith(".") | local.endswith(".") | F.contains(local, F.lit(".."))
        named = (local.rlike(DOT_ATOM) & ~edges) | local.startswith('"')
        return named & ((F.lower(domain) == "localhost") | domain.rlike(LITERAL) | _dotted(domain))

    sides = F.struct(local.alias("local"), domain.alias("domain"))
    return F.contains(text, F.lit("@")) & bind(sides, holds)


def list_items(text: Column) -> Column:
    """The header cut at commas outside quotes; a quote without a partner ends an item."""

    def marked(runs: Column) -> Column:
        def rebuilt(run: Column, pos: Column) -> Column:
            outside = F.replace(run, F.lit(","), F.lit(ITEM_END))
            return (
                F.when(pos % 2 == 0, outside)
                .when(pos == F.size(runs) - 1, F.concat(F.lit(ITEM_END), outside))
                .otherwise(F.concat(F.lit('"'), run, F.lit('"')))
            )

        return F.array_join(F.transform(runs, rebuilt), "")

    items = F.split(bind(F.split(text, '"'), marked), ITEM_END)
    return F.filter(items, lambda item: F.length(item) > 0)


def parse_address(text: Column) -> Column:
    """The address inside a header value, or null.

    Mail archives write ``a () b ! com``; that is undone first.
    """
    plain = F.when(
        F.contains(text, F.lit(" () ")),
        F.replace(F.replace(text, F.lit(" () "), F.lit("@")), F.lit(" ! "), F.lit(".")),
    ).otherwise(text)

    def bare(text: Column) -> Column:
        """The first run of visible characters with an "@" inside it, by one cut at the white space."""
        runs = F.when(F.contains(text, F.lit("@")), F.split(text, r"\s+"))
        return F.get(F.filter(runs, lambda run: F.contains(F.substring(run, F.lit(2), F.length(run) - 2), F.lit("@"))), F.lit(0))

    def inside(text: Column) -> Column:
        angle = F.nullif(F.regexp_extract(text, r"<([^<>]*)>", 1), F.lit(""))
        return F.btrim(F.coalesce(angle, bare(text)))

    return bind(bind(plain, inside), lambda found: F.when(is_address(found), found))


def valid_addresses(text: Column, then: Callable[[Column], Column] = lambda address: address) -> Column:
    """Valid addresses of a list header in order, each passed through ``then``."""
    found = F.filter(F.transform(list_items(text), parse_address), lambda a: a.isNotNull())
    return F.transform(found, then)


def parse_address_list(
    text: Column, then: Callable[[Column], Column] = lambda address: address
) -> Column:
    """The same, null when none is left."""
    return bind(valid_addresses(text, then), lambda found: F.when(F.size(found) > 0, found))


def join_addresses(addresses: Column) -> Column:
    """One string; a missing list, or one of only empty items, is empty."""
    joined = bind(
        addresses, lambda a: F.when(F.exists(a, lambda item: item != ""), F.btrim(F.array_join(a, ", ")))
    )
    return F.coalesce(joined, F.lit(""))
