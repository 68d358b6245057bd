"""DuckDB SQL for the queries.

Fields of the mail messages are taken from the columns the messages were made
of. Text rules are written over lists of lines, not with the patterns the Spark
side uses.
"""

from __future__ import annotations

from letterloom.functions.headers import SUBJECT_MARKS
from letterloom.functions.tagging import COUNTRIES, FIRST_NAMES, LAST_NAMES, NUMBER_WORDS
from letterloom.functions.text import PUNCTUATION, WHITESPACE

from catalog.mail import REPLY, mail_sql
from catalog.queries import EVENT_DAY, MATRIX_DAY
from catalog.tables import LEMMAS, SALT


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NL = "chr(10)"
SEGMENT = q(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+")
INTRO = r"^[ \t]*(On|Le|Am|Op|El|Il|Den|Em) "
WROTE = r"(wrote|a écrit|schrieb|schreef|escribió|ha scritto|skrev|escreveu) ?:[ \t]*$"


def cut_ctes(source: str, text: str, name: str) -> str:
    """CTEs that end in ``name``: ``source`` plus ``cut``, the lines before an inline message."""
    breaks = q(r"\r\n|[\n\r\x0b\x0c\x1c-\x1e]|\x{85}|\x{2028}|\x{2029}")
    hit = q(r"[-_*=]{4,}"), q(r"(?i)To:|Subject:|From:|Cc:|Bcc?")
    return f"""
{name}_a as (select *, string_split_regex({text}, {breaks}) as raw_lines from {source}),
{name}_b as (select *, case when raw_lines[-1] = '' then raw_lines[:len(raw_lines) - 1] else raw_lines end as lines
  from {name}_a),
{name}_c as (select *, list_position(list_transform(lines,
  lambda l: regexp_matches(l, {hit[0]}) or regexp_matches(l, {hit[1]})), true) as hit from {name}_b),
{name} as (select * exclude (raw_lines, lines, hit), case when {text} is null then null else
  coalesce(array_to_string(case when coalesce(hit, 0) = 0 then lines else lines[1:hit - 1] end, {NL}), '') end as cut
  from {name}_c)"""


def intro_sql(lines: str, i: str) -> tuple[str, str]:
    """Whether line ``i`` introduces history: with the next line, or alone."""
    two = f"(regexp_matches({lines}[{i}], {q(INTRO)}) and regexp_matches(coalesce({lines}[{i} + 1], ''), {q(WROTE)}))"
    one = (
        f"(regexp_matches({lines}[{i}], {q(INTRO + '.*' + WROTE)}) "
        f"or regexp_matches({lines}[{i}], {q('^[ \\t]*-+ ?Original Message ?-+')}))"
    )
    return two, one


def quote_ctes(source: str, text: str, name: str) -> str:
    """CTEs that end in ``name``: ``source`` plus ``unquoted``, the text without quoted history.

    Each line has a mark: q quoted, b blank, t text. An introduction whose following marks are blanks and
    then a quote becomes a quoted line; the first one left ends the text.
    """
    two, one = intro_sql("lines", "i")
    more, alone = intro_sql("fresh", "i")
    quoted, blank = q("^[ \\t]*>"), q("^[ \\t]*$")
    return f"""
{name}_a as (select *, string_split({text}, {NL}) as lines from {source}),
{name}_b as (select *, array_to_string(list_transform(lines, lambda l:
  case when regexp_matches(l, {quoted}) then 'q' when regexp_matches(l, {blank}) then 'b' else 't' end), '') as marks
  from {name}_a),
{name}_c as (select *, list_transform(range(1, len(lines) + 1), lambda i:
  case when {two} and regexp_matches(substr(marks, i + 2), '^b*q') then 2
  when {one} and regexp_matches(substr(marks, i + 1), '^b*q') then 1 else 0 end) as led from {name}_b),
{name}_d as (select *, list_transform(range(1, len(lines) + 1), lambda i:
  case when led[i] > 0 or (i > 1 and led[i - 1] = 2) then '>' else lines[i] end) as fresh from {name}_c),
{name}_e as (select *, list_position(list_transform(range(1, len(fresh) + 1), lambda i: {more} or {alone}), true) as hit
  from {name}_d),
{name}_f as (select *, case when coalesce(hit, 0) = 0 then fresh else fresh[1:hit - 1] end as above from {name}_e),
{name}_g as (select *, case when list_max(led) > 0
  then list_filter(above, lambda l: not regexp_matches(l, {quoted})) else above end as kept from {name}_f),
{name}_h as (select *, case when list_max(led) > 0 then coalesce(list_min(list_filter(range(1, len(kept) + 1),
  lambda i: not regexp_matches(kept[i], {blank}))), 1) else 1 end as first,
  list_max(list_filter(range(1, len(kept) + 1), lambda i: regexp_matches(kept[i], {q("^[ \\t]*[^>\\s]")}))) as last
  from {name}_g),
{name} as (select * exclude (lines, marks, led, fresh, hit, above, kept, first, last), case when {text} is null then null
  when last is null then '' else array_to_string(kept[first:last], {NL}) end as unquoted from {name}_h)"""


# The SQL side's own patterns.
ADDRESS = (
    r"(?i)^([-!#$%&'*+/=?^_`{}|~0-9a-z]+(\.[-!#$%&'*+/=?^_`{}|~0-9a-z]+)*|\"[^\"\\]*\")"
    r"@(localhost|([a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z0-9-]{2,}|\[[0-9]{1,3}(\.[0-9]{1,3}){3}\])$"
)
HIDDEN = r"(?is)<!--.*?(-->|\z)|<script.*?(</script>|\z)|<style.*?(</style>|\z)"
TAG = r"<[A-Za-z/!?]([^<>\"']|\"[^\"<]*\"|'[^'<]*')*>|<[A-Za-z/!?][^>]*>"


def html_sql(html: str) -> str:
    text = f"regexp_replace(regexp_replace({html}, {q(HIDDEN)}, '', 'g'), {q(TAG)}, '', 'g')"
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        text = f"replace({text}, {q(name)}, {q(char)})"
    return f"trim({text}, {q(WHITESPACE)})"


def number_sql(words: bool = True) -> str:
    inner = "|".join((r"[+-]?[0-9]+(?:[.,/:][0-9]+)*", *NUMBER_WORDS)) if words else r"[+-]?[0-9]+(?:[.,/:][0-9]+)*"
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_])(?:{inner})($|[^\p{{L}}\p{{N}}_])"


EMAIL = q(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
URL = q(
    r"(?i)(?:https?|ftp)://[^\s<>\"']+|www\.[^\s<>\"']+|(?:[a-z0-9-]+\.)+(?:com|org|net|edu|gov|info)\b"
)


def tag_sql(text: str) -> str:
    """Neighbouring numbers share a boundary character, so numbers take two passes."""
    text = f"regexp_replace({text}, {EMAIL}, 'EMAIL', 'g')"
    text = f"regexp_replace({text}, {URL}, 'URL', 'g')"
    for _ in range(2):
        text = f"regexp_replace({text}, {q(number_sql())}, '\\1NUM\\2', 'g')"
    return text


def surrogate_sql(text: str, key: str) -> str:
    def pool(names: tuple[str, ...], draw: str) -> str:
        return f"([{', '.join(map(q, names))}])[({draw}) % {len(names)} + 1]"

    draw = f"cast('0x' || substr(sha256({q(SALT + '|')} || {key} || '|' || cast(i - 1 as varchar)), 1, 8) as bigint)"
    return f"""array_to_string(list_transform(regexp_extract_all({text}, {SEGMENT}), lambda s, i:
  case when s = 'PERSON' then {pool(FIRST_NAMES, draw)}
  when s in ('GPE', 'NORP', 'FAC', 'LOC') then {pool(COUNTRIES, draw)}
  when s = 'ORG' then {pool(LAST_NAMES, f"{draw} // {len(FIRST_NAMES)}")}
  when s in ('NUM', 'QUANTITY', 'ORDINAL', 'CARDINAL') then cast({draw} % 10000 as varchar)
  when s = 'EMAIL' then lower({pool(FIRST_NAMES, draw)}) || '@example.org'
  when s = 'URL' then 'https://www.example.com/' || cast({draw} % 10000 as varchar)
  else s end), '')"""


def entity_ctes(source: str, key: str, text: str, name: str) -> str:
    """CTEs that end in ``name``: ``source`` plus ``tagged``, names replaced, the longest first."""
    word = r"[\p{L}\p{N}_]+"
    run = q(rf"\p{{Lu}}[\p{{L}}\p{{N}}_]* {word} {word}")
    return f"""
{name}_o as (select unnest(regexp_extract_all(text, {run})) as o, string_split(o, ' ') as p from benchmark),
{name}_n as (select surface, min(label) as label, len(regexp_extract_all(surface, {SEGMENT})) as span from (
  select p[1] as surface, 'PERSON' as label from {name}_o
  union all select concat_ws(' ', p[2], p[3]), 'GPE' from {name}_o union all select o, 'ORG' from {name}_o)
  where surface <> '' group by surface),
{name}_s as (select {key}, regexp_extract_all({text}, {SEGMENT}) as segs from {source}),
{name}_w as (select {key}, segs, unnest(range(1, len(segs) + 1)) as spot from {name}_s),
{name}_c as (select {key}, spot, span, array_to_string(segs[spot:spot + span - 1], '') as surface
  from {name}_w cross join (select distinct span from {name}_n)
  where spot + span - 1 <= len(segs) and regexp_matches(segs[spot], {q(f"^{word}$")})),
{name}_m as (select c.{key}, list({{'spot': c.spot, 'span': c.span, 'label': n.label}}
  order by length(c.surface) desc, c.spot) as found
  from {name}_c c join {name}_n n on c.surface = n.surface and c.span = n.span group by c.{key}),
{name}_k as (select {key}, list_reduce(list_transform(found, lambda m: [m]), lambda acc, x:
  case when len(list_filter(acc, lambda k: k.spot < x[1].spot + x[1].span and x[1].spot < k.spot + k.span)) > 0
  then acc else acc || x end) as kept from {name}_m),
{name}_p as (select w.{key}, w.spot, w.segs[w.spot] as seg, k.spot as start, k.label
  from {name}_w w left join (select {key}, unnest(kept, recursive := true) from {name}_k) k
  on w.{key} = k.{key} and w.spot >= k.spot and w.spot < k.spot + k.span),
{name}_t as (select {key}, string_agg(case when start is null then seg when start = spot then label else '' end, ''
  order by spot) as tagged from {name}_p group by {key}),
{name} as (select s.*, coalesce(t.tagged, s.{text}) as tagged from {source} s left join {name}_t t on s.{key} = t.{key})"""


def hash_sql(text: str) -> str:
    return f"substr(sha256({q(SALT)} || {text}), 1, 16)"


def address_hash_sql(address: str) -> str:
    local = f"regexp_extract({address}, '(?s)^(.*)@', 1)"
    domain = f"regexp_extract({address}, '(?s)([^@]*)$', 1)"
    at = f"case when contains({address}, '@') then '@' else '' end"
    return f"({hash_sql(local)} || {at} || {hash_sql(domain)})"


ADDRESSES = """
case when doc_id % 13 = 2 then 'a' || doc_id || '@b.com' else 'sender' || doc_id || '@' || source || '.example.com' end
  as from_address,
case when to_value is null then [] when doc_id % 12 = 5
  then ['user' || doc_id || '@example.com', 'peer' || doc_id || '@example.org']
  when doc_id % 12 = 7 then ['john' || doc_id || '@example.com'] else ['user' || doc_id || '@example.com'] end as to_list,
case when cc_value is null then [] else ['good' || doc_id || '@example.com', 'other' || doc_id || '@example.net'] end
  as cc_list,
case when bcc_value is null then [] else ['hidden' || doc_id || '@example.com'] end as bcc_list,
case when doc_id % 15 = 0 then 'gen-' || sha256(trim(value, chr(9) || chr(10) || chr(13) || ' '))
  else 'm' || doc_id || '@mail.example.com' end as message_id,
case when doc_id % 9 < 2 then '' else strftime(make_timestamp(sent_secs * 1000000), '%Y-%m-%d %H:%M:%S') end as date,
regexp_replace(subject_decoded, """ + q(f"(?i){SUBJECT_MARKS}") + """, '', 'g') as subject,
strftime(make_timestamp(day_secs * 1000000), '%Y-%m-%d') as processed_date,
case kind when 'alternative' then 'text/html' when 'plain' then 'text/plain' when 'base64' then 'text/plain' end
  as content_type
"""


def part_text(stripped: bool) -> str:
    plain = f"rtrim(full_text, {q(' ' + chr(9) + chr(10) + chr(11) + chr(12) + chr(13))})" if stripped else "full_text"
    return f"case kind when 'alternative' then html when 'base64' then full_text when 'plain' then {plain} end"


def messages_ctes(stripped: bool = True) -> str:
    """CTEs that end in ``messages``: the message columns of every document, with its reason."""
    return f"""{mail_sql()},
fields as (select *, {ADDRESSES}, {part_text(stripped)} as part from mail),
{cut_ctes("fields", "part", "cuts")},
shown as (select *, case when content_type = 'text/html' then {html_sql("cut")} else cut end as visible from cuts),
{quote_ctes("shown", "visible", "clean")},
messages as (select *, case when to_value is null then 'missing_header'
  when kind = 'bad_base64' then 'defect:InvalidBase64PaddingDefect' when kind = 'bad_charset' then 'no_body'
  when length(cut) not between 250 and 5000 then 'length_pre'
  when length(unquoted) not between 200 and 50000 then 'length_final' end as reason, unquoted as body,
  array_to_string(to_list, ', ') as to_addresses, coalesce(array_to_string(cc_list, ', '), '') as cc_addresses,
  coalesce(array_to_string(bcc_list, ', '), '') as bcc_addresses from clean)"""


COLUMNS = "message_id, date, from_address, to_addresses, cc_addresses, bcc_addresses, subject, body"


def published(columns: str, where: str = "reason is null", stripped: bool = True) -> str:
    return f"with {messages_ctes(stripped)} select {columns} from messages where {where}"


def from_mail(columns: str, tail: str = "") -> str:
    return f"with {mail_sql()}, fields as (select *, {ADDRESSES} from mail) select {columns} from fields {tail}"


HEADER_LIST = """list_filter([
  {'name': 'From', 'value': from_value}, {'name': 'To', 'value': to_value}, {'name': 'Cc', 'value': cc_value},
  {'name': 'Bcc', 'value': bcc_value}, {'name': 'Date', 'value': date_value}, {'name': 'Message-ID', 'value': id_value},
  {'name': 'Subject', 'value': first_subject}, {'name': 'Subject', 'value': subject_value},
  {'name': 'MIME-Version', 'value': '1.0'}, {'name': 'Content-Type', 'value': type_value},
  {'name': 'Content-Transfer-Encoding', 'value': encoding_value}], lambda h: h.value is not null)"""

PLAIN_PART = """doc_id, 0 as part_no, 0 as depth, cast(null as bigint) as parent"""

TEXT_FIELDS = """texts as (select doc_id, 'subject' as field, split_part(text, '.', 1) as text from documents
  union all select doc_id, 'body', text from documents)"""


def words_sql(text: str) -> str:
    bare = f"trim(regexp_replace(translate(lower({text}), {q(PUNCTUATION)}, ''), '[\\t\\n\\x0b\\f\\r ]+', ' ', 'g'))"
    return f"case when coalesce(length({text}), 0) = 0 then [''] else string_split({bare}, ' ') end"


VOCABULARY = f"""terms as (select distinct lower(trim(term, {q(WHITESPACE)})) as term
  from (select unnest({words_sql("text")}) as term from benchmark)),
vocabulary as (select term, row_number() over (order by term) - 1 as idx from terms where term <> '')"""

TOKENS = f"""{TEXT_FIELDS},
tokens as (select doc_id, field, unnest(w) as token, unnest(range(len(w))) as pos
  from (select doc_id, field, {words_sql("text")} as w from texts))"""

STEM = """case when regexp_matches(token, '[^ea]ies$') then regexp_replace(token, 'ies$', 'y')
  when token like '%ies' then token when regexp_matches(token, '[^aeo]es$') then regexp_replace(token, 'es$', 'e')
  when token like '%es' then token when regexp_matches(token, '[^us]s$') then regexp_replace(token, 's$', '')
  else token end"""

LEMMATISED = f"""{TOKENS},
lemmas(token, lemma) as (values {", ".join(f"({q(a)}, {q(b)})" for a, b in LEMMAS.items())}),
lemmatised as (select t.*, coalesce(l.lemma, {STEM.replace("token", "t.token")}) as lemma
  from tokens t left join lemmas l on t.token = l.token)"""

KEEPS = r"""not (regexp_matches(token, '^[+-]?[0-9]+$') or token in ('zero', 'one', 'two', 'three', 'four', 'five',
  'six', 'seven', 'eight', 'nine', 'ten', 'eleven', 'twelve', 'thirteen', 'fourteen', 'fifteen', 'sixteen', 'seventeen',
  'eighteen', 'nineteen', 'twenty', 'thirty', 'forty', 'fifty', 'sixty', 'seventy', 'eighty', 'ninety', 'hundred', 'thousand',
  'million', 'billion', 'trillion')
  or regexp_matches(token, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+')
  or regexp_matches(token, '(?i)^(?:https?|ftp)(?:://)?|^www')) and length(lemma) >= 3"""

PROCESSED = f"""{VOCABULARY}, {LEMMATISED},
kept as (select l.* from lemmatised l join vocabulary v on l.lemma = v.term where {KEEPS}),
processed as (select t.doc_id, t.field, coalesce(string_agg(k.lemma, ' ' order by k.pos), '') as text
  from texts t left join kept k on t.doc_id = k.doc_id and t.field = k.field group by t.doc_id, t.field)"""


def counts_ctes(source: str, key: str) -> str:
    """CTEs that end in ``counted``: words of ``source`` on the folded vocabulary."""
    return f"""folded as (select strip_accents(lower(term)) as word, min(idx) as idx from vocabulary group by 1),
spoken as (select {key}, unnest(regexp_extract_all(strip_accents(lower(text)), {q(r"[\p{L}\p{N}_]{2,}")})) as word
  from {source}),
counted as (select {key}, idx, count(*) as cnt from spoken join folded using (word) group by {key}, idx)"""


SPARSE = """select t.doc_id, t.field, coalesce(string_agg(cast(idx as varchar), ' ' order by idx), '') as indices,
  coalesce(string_agg(cast(cnt as varchar), ' ' order by idx), '') as counts
  from texts t left join counted c on t.doc_id = c.doc_id and t.field = c.field group by t.doc_id, t.field"""

HALVES = """case when row_number() over (order by doc_id) <= count(*) over () // 2 then 'train' else 'test' end"""

MAIL_TEXTS = f"with {mail_sql()}"


def _number_count(text: str) -> str:
    """Numbers in a text that has lost its addresses and URLs."""
    marked = text
    for _ in range(2):
        marked = f"regexp_replace({marked}, {q(number_sql(words=False))}, '\\1' || chr(1) || '\\2', 'g')"
    return f"length({marked}) - length(replace({marked}, chr(1), ''))"


EML = (
    f"trim(array_to_string(['Message-Id: ' || message_id, 'Date: ' || date, 'From: ' || from_address, "
    f"'To: ' || to_addresses, 'Cc: ' || cc_addresses, 'Bcc: ' || bcc_addresses, 'Subject: ' || subject, '', body], "
    f"{NL}), {q(WHITESPACE)})"
)

ORACLE = {
    # sources and sinks
    "stream_ingest": published(f"{COLUMNS}, processed_date"),
    "stream_outcomes": published(
        "doc_id, case when reason is null then 'accepted' else 'rejected' end as outcome, reason, "
        "case when reason is null then length(body) end as n",
        "true",
    ),
    "dir_ingest": published(
        "doc_id, case when reason is null then case when doc_id % 15 = 0 then "
        "'gen-' || sha256(value || chr(10)) else message_id end end as message_id, "
        "case when reason is null then subject end as subject, reason, "
        "case when reason is null then sha256(body) end as body_hash",
        "true",
        stripped=False,
    ),
    "day_partition_scan": f"select event_id, event_type from events where cast(ts as date) = date '{EVENT_DAY}'",
    "column_scan": "select doc_id, lang from documents",
    "parquet_roundtrip": published(f"doc_id, {COLUMNS}"),
    "eml_render": published(f"doc_id, {EML} as eml"),
    "eml_files": f"select sha256(eml || chr(10) || chr(10)) as eml_hash, count(*) as files "
    f"from ({published(f'{EML} as eml')}) group by 1",
    "feature_export": f"""with {PROCESSED}, {counts_ctes("processed", "doc_id, field")}, sparse as ({SPARSE}),
halves as (select doc_id, {HALVES} as split from documents)
select doc_id, '{MATRIX_DAY}' as matrix_date, field, split, indices, counts from sparse join halves using (doc_id)""",
    "feature_rows": f"""with {PROCESSED}, {counts_ctes("processed", "doc_id, field")}, sparse as ({SPARSE}),
halves as (select doc_id, case when row_number() over (order by cast(doc_id // 3 as varchar), doc_id)
  <= count(*) over () // 2 then 'train' else 'test' end as split from documents)
select 'documents/0/' || doc_id as row_id, cast(doc_id // 3 as varchar) as message_id, field, split, indices, counts
from sparse join halves using (doc_id)""",
    # streaming steps
    "payload_decode": f"{MAIL_TEXTS} select doc_id, value as text from mail",
    "message_records": published(
        "doc_id, "
        + ", ".join(f"case when reason is null then {c} end as {c}" for c in COLUMNS.split(", ") if c != "date")
        + ", case when reason is null then date else '' end as date, processed_date, reason",
        "true",
    ),
    "message_null_rows": published(
        "doc_id, case when reason is null then message_id end as message_id, processed_date", "true"
    ),
    "messages_hashed": published(
        f"doc_id, {address_hash_sql('message_id')} as message_id, {address_hash_sql('from_address')} as from_address, "
        + ", ".join(
            f"coalesce(array_to_string(list_transform({n}_list, lambda a: {address_hash_sql('a')}), ', '), '') "
            f"as {n}_addresses"
            for n in ("to", "cc", "bcc")
        )
    ),
    "messages_anonymised": f"""with {messages_ctes()},
{entity_ctes("messages", "doc_id", "body", "bodies")},
{entity_ctes("messages", "doc_id", "subject", "subjects")},
both_tagged as (select b.* exclude (tagged), b.tagged as tagged_body, s.tagged as tagged_subject
  from bodies b join subjects s on b.doc_id = s.doc_id),
filled as (select * exclude (subject, body),
  {surrogate_sql(tag_sql("tagged_body"), "'body|email|0|' || doc_id")} as body,
  {surrogate_sql(tag_sql("tagged_subject"), "'subject|email|0|' || doc_id")} as subject
  from both_tagged where coalesce(reason, 'length_final') = 'length_final')
select doc_id, {address_hash_sql('message_id')} as message_id, date, {address_hash_sql('from_address')} as from_address,
  {", ".join(f"coalesce(array_to_string(list_transform({n}_list, lambda a: {address_hash_sql('a')}), ', '), '') as {n}_addresses" for n in ("to", "cc", "bcc"))},
  subject, body, processed_date from filled where length(body) between 200 and 50000""",
    "ingest_date": "select event_id, strftime(ts, '%Y-%m-%d') as processed_date from events",
    "rejects_by_reason": published("reason, count(*) as messages", "reason is not null group by reason"),
    "accepted_by_day": published(
        "processed_date, count(*) as messages, cast(sum(length(body)) as bigint) as characters",
        "reason is null group by processed_date",
    ),
    # headers
    "header_explode": f"{MAIL_TEXTS}, listed as (select doc_id, {HEADER_LIST} as h from mail) "
    "select doc_id, unnest(range(len(h))) as pos, unnest(list_transform(h, lambda x: x.name)) as name, "
    "unnest(list_transform(h, lambda x: x.value)) as value from listed",
    "header_last_wins": from_mail(
        "doc_id, id_value as message_id_header, date_value as date_header, from_value as from_header, "
        "to_value as to_header, cc_value as cc_header, bcc_value as bcc_header, subject_value as subject_header"
    ),
    "required_headers": from_mail("doc_id, to_value is not null as complete"),
    "header_decode": from_mail("doc_id, subject_decoded as subject_header"),
    "from_address": from_mail("doc_id, from_address as address"),
    "recipient_list": from_mail(
        "doc_id, "
        + ", ".join(
            f"case when len({n}_list) > 0 then array_to_string({n}_list, ', ') end as {n}_list" for n in ("to", "cc", "bcc")
        )
    ),
    "recipients_long": from_mail(
        "doc_id, role, pos, address",
        "cross join lateral ("
        + " union all ".join(
            f"select '{n}' as role, unnest(range(len({n}_list))) as pos, unnest({n}_list) as address"
            for n in ("to", "cc", "bcc")
        )
        + ")",
    ),
    "address_valid": f"""{MAIL_TEXTS} select doc_id, len(list_filter(string_split(
  translate(full_text, {q(chr(10) + chr(9) + ',;<>()"' + "'")}, '          '), ' '),
  lambda w: regexp_matches(w, {q(ADDRESS)}))) as valid from mail""",
    "date_parse": from_mail("doc_id, date as sent"),
    "subject_clean": from_mail("doc_id, subject"),
    "message_ids": from_mail(
        "doc_id, case when doc_id % 15 = 0 then 'gen-' || sha256(value) else message_id end as message_id"
    ),
    # bodies
    "mime_parts": f"""{MAIL_TEXTS}
select doc_id, 0 as part_no, 0 as depth, cast(null as bigint) as parent,
  case kind when 'alternative' then 'multipart/alternative' else 'text/plain' end as content_type,
  case kind when 'alternative' then null when 'bad_charset' then 'x-unknown-9' else 'utf-8' end as charset,
  case when kind in ('plain', 'base64') then full_text end as payload,
  case kind when 'bad_charset' then 'charset' when 'bad_base64' then 'InvalidBase64PaddingDefect' end as error from mail
union all select doc_id, 1, 1, 0, 'text/plain', 'utf-8', full_text, null from mail where kind = 'alternative'
union all select doc_id, 2, 1, 0, 'text/html', 'utf-8', html, null from mail where kind = 'alternative'""",
    "core_body": from_mail(
        "doc_id, case when to_value is not null then case kind when 'alternative' then 'text/html' else 'text/plain' end "
        "end as content_type, case when to_value is null then null when kind = 'bad_charset' then 'no_body' "
        "when kind = 'bad_base64' then 'defect:InvalidBase64PaddingDefect' end as reason"
    ),
    "body_decode": from_mail(f"doc_id, case when to_value is not null then {part_text(False)} end as text"),
    "body_clean": published("doc_id, body", "to_value is not null and length(cut) between 250 and 5000", stripped=False),
    "inline_cut": f"{MAIL_TEXTS}, {cut_ctes('mail', 'full_text', 'cuts')} select doc_id, cut as body from cuts",
    "length_gate_pre": f"{MAIL_TEXTS}, {cut_ctes('mail', 'full_text', 'cuts')} "
    "select doc_id, length(cut) between 250 and 5000 as passes from cuts",
    "length_gate_final": "select doc_id, length(text) between 200 and 50000 as passes from documents",
    "html_to_text": f"select page_id, {html_sql('html')} as text from pages",
    "reply_strip": f"with replies as (select doc_id, {REPLY} as reply from documents), "
    f"{quote_ctes('replies', 'reply', 'quotes')} select doc_id, unquoted as body from quotes",
    "quote_strip": f"{MAIL_TEXTS}, {quote_ctes('mail', 'full_text', 'quotes')} select doc_id, unquoted as body from quotes",
    # anonymisation
    "salted_hash": f"{MAIL_TEXTS} select doc_id, {hash_sql('full_text')} as hash from mail",
    "salted_hash_pbkdf2": f"""{MAIL_TEXTS} select doc_id, full_text is not null as formed,
  min(doc_id) over (partition by full_text) as first_doc_id from mail""",
    "address_hash": from_mail(f"doc_id, {address_hash_sql('from_address')} as address"),
    "entity_tag": f"with {entity_ctes('documents', 'doc_id', 'text', 'names')} select doc_id, tagged as text from names",
    "pattern_tag": f"{MAIL_TEXTS} select doc_id, {tag_sql('full_text')} as text from mail",
    "pii_counts": f"""with bare as (select lang, text, regexp_replace(text, {EMAIL}, '', 'g') as no_mail,
  regexp_replace(no_mail, {URL}, '', 'g') as no_url from documents)
select lang, cast(sum(len(regexp_extract_all(text, {EMAIL}))) as bigint) as emails,
  cast(sum(len(regexp_extract_all(no_mail, {URL}))) as bigint) as urls,
  cast(sum({_number_count("no_url")}) as bigint) as numbers from bare group by lang""",
    "surrogate_fill": f"{MAIL_TEXTS} select doc_id, {surrogate_sql(tag_sql('full_text'), 'cast(doc_id as varchar)')} as text "
    "from mail",
    # records
    "flat_records": f"""{MAIL_TEXTS} select doc_id, id_value as message_id, case when date_value is null then '' else
  strftime(make_timestamp(sent_secs * 1000000), '%Y-%m-%d %H:%M:%S') end as date, from_value as from_address,
  coalesce(to_value, '') as to_addresses, coalesce(cc_value, '') as cc_addresses, coalesce(bcc_value, '') as bcc_addresses,
  title as subject, text as body from mail""",
    "tidy_rows": f"{MAIL_TEXTS} select doc_id, lead as subject, first_subject as draft from mail where lead <> ''",
    # features
    "vocab_build": f"with {VOCABULARY} select term, idx from vocabulary",
    "vocab_from_documents": f"""with spoken as (select distinct unnest({words_sql("text")}) as term from documents),
cleaned as (select distinct lower(trim(term, {q(WHITESPACE)})) as term from spoken)
select term, row_number() over (order by term) - 1 as idx from cleaned where term <> ''""",
    "punct_strip": f"select doc_id, translate(text, {q(PUNCTUATION)}, '') as text from documents",
    "tokens": f"with {TOKENS} select doc_id, field, token, count(*) as cnt from tokens group by all",
    "lemmatize": f"with {LEMMATISED} select token, lemma, count(*) as cnt from lemmatised group by all",
    "token_filter": f"with {PROCESSED} select doc_id, field, lemma, count(*) as cnt from kept group by all",
    "processed_texts": f"with {PROCESSED} select doc_id, field, text from processed",
    "bow_count": f"with {VOCABULARY}, {TEXT_FIELDS}, {counts_ctes('texts', 'doc_id, field')} "
    "select doc_id, field, idx, cnt from counted",
    "bow_sparse": f"with {VOCABULARY}, {TEXT_FIELDS}, {counts_ctes('texts', 'doc_id, field')} {SPARSE}",
    "conversation_bow": f"with {VOCABULARY}, {counts_ctes('conversations', 'conv_id, turn')} "
    "select conv_id, idx, cast(sum(cnt) as bigint) as cnt from counted group by conv_id, idx",
    "order_rank": "select o_orderkey, row_number() over (order by o_orderkey) as rank, count(*) over () as orders from orders",
    "split_halves": f"select doc_id, {HALVES} as split from documents",
}

ORACLE["stream_restart"] = ORACLE["stream_outcomes"]
