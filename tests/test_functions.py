"""Column functions on small tables of cases."""

from __future__ import annotations

import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from letterloom.functions.addresses import is_address, join_addresses, parse_address, parse_address_list
from letterloom.functions.body import cut_inline, strip_quotes
from letterloom.functions.dates import parse_date
from letterloom.functions.hashing import hash_address, keyed_hash
from letterloom.functions.headers import all_headers, clean_subject, has_required, message_id, read_headers
from letterloom.functions.html import html_text, unescape
from letterloom.functions.tagging import fill_surrogates, tag_patterns
from letterloom.functions.text import fold_accents, length_between, strip_punctuation, unify_lines
from letterloom.functions.tokens import plural_stem, words


def test_parse_address(column):
    cases = {
        "plain@post.example": "plain@post.example",
        "\"Parts Desk\" <desk@parts-and-more.example>'": "desk@parts-and-more.example",
        "Post Room </O=HOUSE/OU=EAST/CN=POST>": None,
        "<\"'old-name'@far.example'\"@near.example>": "\"'old-name'@far.example'\"@near.example",
        "List Keeper <keeper-list () lists ! example>": "keeper-list@lists.example",
        "A Name Alone": None,
        "word @start end@ mid@dle.example more@after.example": "mid@dle.example",
        "@a@b.example x@y.example": None,
        "": None,
        None: None,
        "a@localhost": "a@localhost",
        "a@[127.0.0.1]": "a@[127.0.0.1]",
        "a@nodot": None,
        "two@@at.com": None,
    }
    assert column(list(cases), parse_address) == list(cases.values())


@pytest.mark.parametrize(
    "text, expected",
    [
        ("one@first.example, Two Second <two@second.example>", ["one@first.example", "two@second.example"]),
        (None, None),
        ("", None),
        ("<Post Room </O=HOUSE/OU=EAST/CN=POST>", None),
        ("Ann Able <ann@able.example>, <Post Room </O=HOUSE/OU=EAST/CN=POST>", ["ann@able.example"]),
        ("<\"'old-name'@far.example'\"@near.example>", ["\"'old-name'@far.example'\"@near.example"]),
        ('"Doe, John" <a@b.com>,c@d.org', ["a@b.com", "c@d.org"]),
        ('stray " quote <a@b.com>, c@d.org', None),
    ],
)
def test_address_list(column, text, expected):
    got = column([text], parse_address_list)[0]
    if text and text.startswith("stray"):
        assert got is None or set(got) <= {"a@b.com", "c@d.org"}
    else:
        assert got == expected


def test_long_address_list(column):
    """Thousands of quoted names must not exhaust the matcher's stack."""
    text = ", ".join(f'"Last{i}, First" <u{i}@example.com>' for i in range(20_000))
    assert len(column([text], parse_address_list)[0]) == 20_000


def test_join_addresses(column):
    lists = [["a@b.c", "d@e.f"], ["", ""], [], None, ["a@b.c", ""]]
    assert column(lists, join_addresses, "array<string>") == ["a@b.c, d@e.f", "", "", "", "a@b.c,"]


def test_parse_date(column):
    def utc(*fields):
        return dt.datetime(*fields)

    cases = {
        "Tue, 3 Mar 2015 07:08:09 UT": utc(2015, 3, 3, 7, 8, 9),
        None: None,
        "": None,
        "Xx, 17 xxX 2009 20:14:00 +0100": None,
        "<a@b.example>": None,
        "Sat, 9 Jul 2011 12:13:14 +0200": utc(2011, 7, 9, 10, 13, 14),
        "Mon, 14 May 2001 16:39:00 -0700 (PDT)": utc(2001, 5, 14, 23, 39),
        "14 May 2001 16:39 EST": utc(2001, 5, 14, 21, 39),
        "14 May 01 16:39:05 GMT": utc(2001, 5, 14, 16, 39, 5),
        "14 May 70 16:39:05 GMT": utc(1970, 5, 14, 16, 39, 5),
        "14-May-2001 16:39:05": utc(2001, 5, 14, 16, 39, 5),
        "Wed, 15 Dec 2010    59:10 -0500": None,
        "31 Feb 2010 10:00:00 +0000": None,
    }
    got = column(list(cases), lambda c: F.date_format(parse_date(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == [v and v.strftime("%Y-%m-%d %H:%M:%S") for v in cases.values()]


def test_clean_subject(column):
    cases = {
        None: "", "": "", "Fwd:": "", "Re: The new shelves...": "The new shelves...",
        "Een gewone mededeling": "Een gewone mededeling",
        "Miami": "Miam", "software": "softwa", "core: b": "cob", "RE: FW: [FYI] x": "x", "Αντ ΑΠ: κείμενο": "Αντ κείμενο",
    }
    assert column(list(cases), clean_subject) == list(cases.values())
    assert column(["Re: Fwd: core: b", "Miami"], lambda c: clean_subject(c, anchored=True)) == ["core: b", "Miami"]


def test_message_id(column):
    given = ["<a@b>", '"c@d"', " e@f ", "<half"]
    assert column(given, lambda c: message_id(c, F.lit("x"))) == ["a@b", "c@d", "e@f", "<half"]
    made = column([None, ""], lambda c: message_id(c, F.lit("x")))
    assert made == ["gen-" + hashlib.sha256(b"x").hexdigest()] * 2


def test_headers(column):
    head = "Subject: one\r\nTo: a@b.c,\r\n\td@e.f\r\nX-Other: 1\r\nnot a header\r\nSUBJECT:two: 2"
    rows = column([head], all_headers)[0]
    assert [(r["pos"], r["name"], r["value"]) for r in rows] == [
        (0, "Subject", "one"), (1, "To", "a@b.c, d@e.f"), (2, "X-Other", "1"), (3, "SUBJECT", "two: 2"),
    ]
    assert len(column([head], read_headers)[0]) == 3
    heads = ["To: a\nFrom:\nSubject:", "To: a\nFrom: b", "to: a\nFROM: b\nsubject: c"]
    assert column(heads, lambda c: has_required(read_headers(c))) == [True, False, True]


def test_cut_inline(column):
    cases = {
        "one\ntwo\n": "one\ntwo", "one\n\n": "one\n", "": "", "\n": "", "a\r\nb\rc\x0bd\x0ce\x85f\u2028g": "a\nb\nc\nd\ne\nf\ng",
        "one\nTo: x\ntwo": "one", "To: x": "", "a\n\n----\nb": "a\n", "photo: no": "", "subconscious": "",
        "a\n--- b\n*_*_": "a\n--- b", "x" * 50_000: "x" * 50_000, "l\n" * 50_000: "\n".join("l" * 50_000), "end\r\n": "end",
        "a\nFROM: b": "a",
    }
    assert column(list(cases), cut_inline) == list(cases.values())
    assert column(["a\n#cut\nb----"], lambda c: cut_inline(c, "#cut", "Nothing:")) == ["a"]


def test_unify_lines(column):
    assert column(["a\r\n", "\r\n\n", None], unify_lines) == ["a", "\n", None]


def test_strip_quotes(column):
    cases = {
        "Hello\n\nOn Mon, Ann wrote:\n> hi": "Hello",
        "Hello\nOn Mon, 1 Jan 2024,\nAnn <a@b.c> wrote:\nhi": "Hello",
        "Hello\n> quoted\n\n> more\n": "Hello",
        "> first\nanswer\n> last": "> first\nanswer",
        "> only\n> quotes": "",
        "Text\n-----Original Message-----\nold": "Text",
        "Am 1.1.2024 schrieb:\nalt": "",
        "On time, as I wrote: yes": "On time, as I wrote: yes",
        "On Mon, Ann wrote:\n> a\nfirst answer\n\n> b\n\nsecond\n> c\n": "first answer\n\n\nsecond",
        "Hi,\nOn Mon, Ann\n<a@b.c> wrote:\n \n\n > a\nbelow": "Hi,\n \n\nbelow",  # blank lines stay
        "x\nLe lundi, Ann a écrit :\n> a\n\n\nbas\nEl lunes, Bo escribió:\ntodo": "x\n\n\nbas",
        "x\n> On Mon, Ann wrote:\ny": "x\n> On Mon, Ann wrote:\ny",
        "On Mon, Ann wrote:\n> Bo wrote:\n>> a\nyes": "yes",
        "On Mon, Ann wrote:\n\n": "",
        "": "",
        None: None,
    }
    assert column(list(cases), strip_quotes) == list(cases.values())
    assert column(["x\n" + "> q\n" * 100_000], strip_quotes) == ["x"]
    assert column(["On a wrote:\n" + " \n" * 300_000 + "> q\n" * 300_000 + "x"], strip_quotes) == ["x"]


def test_html_text(column):
    table = '<table><tr><td align="center"><img src="logo.jpg"></td></tr><tr><td>Here is a string.</td></tr></table>'
    cases = {
        table: "Here is a string.",
        '<a title="x > y">link</a>': "link",
        "<!-- no -->a<script>if (a<b) {}</script>b<STYLE>p{}</STYLE >c": "abc",
        "&lt;b&gt; &amp;amp; &#233;&#xe9; &eacute;&hearts; &bogus; & &#128512;&#0;": "<b> &amp; éé é♥ &bogus; & 😀�",
        "3 < 4 and 5 > 4": "3 < 4 and 5 > 4",
        None: None,
    }
    assert column(list(cases), html_text) == list(cases.values())
    assert column(["a&b;c"], unescape) == ["a&b;c"]


def test_length_gate(column):
    texts = ["x" * n for n in (249, 250, 5000, 5001)]
    assert column(texts, lambda c: length_between(c, (250, 5000))) == [False, True, True, False]


def pbkdf2(text: str, salt: str) -> str:
    return hashlib.pbkdf2_hmac("sha512", text.encode(), salt.encode(), 1, 8).hex()


def test_keyed_hash(column):
    texts = ["", "6666 digits", "a@b.c", "é☃😀", "x" * 128, "x" * 129, "é" * 100, "\x00\x36\x5c", "".join(map(chr, range(1, 127)))]
    assert column(texts, lambda c: keyed_hash(c, "pepper", "pbkdf2")) == [pbkdf2(t, "pepper") for t in texts]
    want = [hashlib.sha256(("pepper" + t).encode()).hexdigest()[:16] for t in texts]
    assert column(texts, lambda c: keyed_hash(c, "pepper")) == want


def test_hash_address(column):
    got = column(["a@b", "x@a@b", "no at"], lambda c: hash_address(c, "s", "pbkdf2"))
    want = [("a", "@", "b"), ("x@a", "@", "b"), ("", "", "no at")]
    assert got == [pbkdf2(local, "s") + at + pbkdf2(domain, "s") for local, at, domain in want]


def test_tag_patterns(column):
    cases = {
        "mail a.b@c.org now": "mail EMAIL now",
        "see https://x.org/a?b=1, or www.y.com": "see URL or URL",
        "1 2 3 and -4.5 or 1,000": "NUM NUM NUM and NUM or NUM",
        "ten Twenty tension 5cee mail5": "NUM NUM tension 5cee mail5",
        "12.5x a-5": "NUM.5x a-NUM",
    }
    assert column(list(cases), tag_patterns) == list(cases.values())


def test_fill_surrogates(column):
    text = "PERSON met ORG, NUM times; UPDATE at TIME. PERSONAL EMAIL"
    first = column([text], lambda c: fill_surrogates(c, F.lit("k"), "s"))[0]
    assert first == column([text], lambda c: fill_surrogates(c, F.lit("k"), "s"))[0]
    assert first != column([text], lambda c: fill_surrogates(c, F.lit("k"), "other"))[0]
    words_left = first.replace(",", " ").replace(";", " ").replace(".", " ").split()
    assert "UPDATE" in words_left and "PERSONAL" in words_left
    assert not {"PERSON", "ORG", "NUM", "TIME", "EMAIL"} & set(words_left)


def test_tokens(column):
    assert column(["Hi, there!  You're\n ok", None, "", "..."], words) == [["hi", "there", "youre", "ok"], [""], [""], [""]]
    stems = {"ponies": "pony", "eies": "eies", "horses": "horse", "shoes": "shoes", "cats": "cat", "bus": "bus",
             "glass": "glass", "s": "s", "ies": "ies", "es": "es", "dog": "dog"}
    assert column(list(stems), plural_stem) == list(stems.values())


def test_fold_and_punctuation(column):
    assert column(["Éa ÇÑ ø", "ABC"], fold_accents) == ["ea cn ø", "abc"]
    import string

    assert column([f"a{string.punctuation}b…"], strip_punctuation) == ["ab…"]


def test_patterns_without_recursion(column):
    """Each would take a stack frame per turn if a repeated group were walked by recursion."""
    n = 100_000
    cases = {"a@b" + ".c" * n: "EMAIL", "b." * n + "com": "URL", "1" + ".2" * n: "NUM", "1.5x 2,3": "NUM.5x NUM", "see example.com...": "see URL..."}
    assert column(list(cases), tag_patterns) == list(cases.values())
    assert column(["a." * n + "a@b.co", "a@" + "b." * n + "co", "a" * n], is_address) == [True, True, False]
    assert column(['"q" ' * n + "<x@y.co>, b@c.de"], parse_address_list) == [["x@y.co", "b@c.de"]]
    assert column(["<a" + " b='>'" * n + ">x", "x<script>alert(1)", "x<!-- y"], html_text) == ["x", "x", "x"]
    assert column(["&#x00000e9;&#00000233;&apos;&hellip;&#" + "9" * n + ";"], html_text) == ["éé'…\ufffd"]
    assert column(["Re: " * 60 + "Re: news"], lambda c: clean_subject(c, anchored=True)) == ["news"]


def test_words_with_an_at_are_those_of_a_split(column):
    """Cutting out the words with an "@" finds the words of a split at the breaks, in time that grows with the text."""
    from catalog.queries import WORD_WITH_AT

    texts = ["a@b.co,(x@y.org) <q@z.de>;'w@v.io'\tno\n@@ p@q@r.com \u00e9@\u00e9.com a@", "", None, "@", "none", "z" * 2_000_000 + " a@b.co"]
    want = [t and [w for w in re.split(r"""[ \n\t,;<>()"']""", t) if "@" in w] for t in texts]
    got = column(texts, lambda c: F.regexp_extract_all(c, F.lit(WORD_WITH_AT), F.lit(0)))
    assert got == [w if t is not None and t != "" else ([] if t == "" else None) for t, w in zip(texts, want)]


def test_cuts_are_found_in_any_case(column):
    """The quick test before the words passes every place where one of them starts."""
    from letterloom.options import HEADER_HINT_PATTERN, SEPARATOR_PATTERN

    starts = ["To:", "tO:", "SUBJECT:", "subject:", "\u017fubject:", "fRom:", "cC:", "BC", "bcc", "----", "=_*-", "___", "t o:"]
    texts = [f"first line\nsecond {start} x\u2028end\r" for start in starts]
    slow = re.compile(f"(?iu)(?:{SEPARATOR_PATTERN}|{HEADER_HINT_PATTERN})")
    want = ["first line" if slow.search(t) else "first line\n" + t.split("\n")[1].replace("\u2028", "\n").rstrip("\r") for t in texts]
    assert column(texts, cut_inline) == want
