"""The driver's documents written as RFC 822 messages, one message per document.

The expressions are SQL both engines run, so the expected value of every field
is known without parsing anything. They only add columns; no document is left
out, and its whole text is in the message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


FIRST_SECOND = 1_704_067_200  # 2024-01-01 00:00:00 UTC
ID = "cast(doc_id as string)"
NL = "chr(10)"


def _spark(name: str, *args: str) -> str:
    return {
        "base64": "replace(base64(cast({0} as binary)), chr(13) || chr(10), '')",
        "mail_date": "date_format(timestamp_seconds({0}), 'EEE, dd MMM yyyy HH:mm:ss')",
        "instant": "timestamp_seconds({0})",
    }[name].format(*args)


def _duck(name: str, *args: str) -> str:
    return {
        "base64": "to_base64(encode({0}))",
        "mail_date": "strftime(make_timestamp(({0}) * 1000000), '%a, %d %b %Y %H:%M:%S')",
        "instant": "make_timestamp(({0}) * 1000000)",
    }[name].format(*args)


def layers(fn) -> list[dict[str, str]]:
    """Column expressions; each layer may use the columns of the ones before."""
    return [
        {
            "title": f"trim(translate(split_part(text, '.', 1), {NL} || chr(13) || chr(9), '   '))",
            "lead": f"case when doc_id % 3 = 0 then 'See https://example.com/a?id=' || {ID} "
            f"|| ' for ' || {ID} || ' items.' || {NL} else '' end",
            "tail": f"case when doc_id % 4 = 2 then {NL} || '-----Original Message-----' || {NL} "
            f"|| 'From: someone' || {NL} || 'An older text.' "
            f"when doc_id % 4 = 3 then {NL} || 'On Mon, 1 Jan 2024 at 10:00, Ann wrote:' || {NL} "
            f"|| '> quoted line' || {NL} || {NL} || '> another one' else '' end",
            "kind": "case when doc_id % 14 = 9 then 'bad_base64' when doc_id % 16 = 11 then 'bad_charset' "
            "when doc_id % 5 = 0 then 'base64' when doc_id % 6 = 1 then 'alternative' else 'plain' end",
            "day_secs": f"{FIRST_SECOND} + (doc_id % 30) * 86400",
            "sent_secs": f"{FIRST_SECOND} + (doc_id % 30) * 86400 + (doc_id * 7919) % 86400",
        },
        {
            "full_text": "lead || text || tail",
            "subject_text": "case when doc_id % 7 = 0 then 'Re: ' || title "
            "when doc_id % 7 = 1 then 'Fwd: Re: ' || title else title end",
        },
        {
            "from_value": f"case when doc_id % 13 = 2 then 'Corinna <a' || {ID} || ' () b ! com>' "
            f"else '\"Sender ' || {ID} || '\" <sender' || {ID} || '@' || source || '.example.com>' end",
            "to_value": f"case when doc_id % 10 = 3 then null "
            f"when doc_id % 12 = 5 then 'user' || {ID} || '@example.com, peer' || {ID} || '@example.org' "
            f"when doc_id % 12 = 7 then '\"Doe, John\" <john' || {ID} || '@example.com>' "
            f"else 'user' || {ID} || '@example.com' end",
            "cc_value": f"case when doc_id % 9 = 4 then 'good' || {ID} || '@example.com, not-an-address, other' "
            f"|| {ID} || '@example.net' end",
            "bcc_value": f"case when doc_id % 17 = 6 then 'hidden' || {ID} || '@example.com' end",
            "date_value": "case when doc_id % 9 = 0 then null "
            "when doc_id % 9 = 1 then 'Pn, 29 paX 2007 21:13:00 +0100' "
            f"when doc_id % 9 = 2 then {fn('mail_date', 'sent_secs - 28800')} || ' -0800 (PST)' "
            f"when doc_id % 9 = 3 then {fn('mail_date', 'sent_secs')} || ' GMT' "
            f"else {fn('mail_date', 'sent_secs + 3600')} || ' +0100' end",
            "id_value": f"case when doc_id % 15 = 0 then null else '<m' || {ID} || '@mail.example.com>' end",
            "first_subject": "case when doc_id % 11 <> 0 and doc_id % 8 = 1 then 'draft of ' || source end",
            "subject_value": f"case when doc_id % 11 = 0 then '=?UTF-8?B?' || {fn('base64', 'subject_text')} || '?=' "
            "when doc_id % 19 = 4 then '=?ISO-8859-1?Q?caf=E9?= ' || subject_text else subject_text end",
            "subject_decoded": "case when doc_id % 11 <> 0 and doc_id % 19 = 4 then 'café ' || subject_text "
            "else subject_text end",
            "html": "'<html><head><style>p{margin:0}</style></head><body><p class=\"a>b\">' || "
            "replace(replace(replace(full_text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p></body></html>'",
            "packed": f"{fn('base64', 'full_text')}",
        },
        {
            "type_value": "case kind when 'bad_charset' then 'text/plain; charset=x-unknown-9' "
            "when 'alternative' then 'multipart/alternative; boundary=\"=-cut-here\"' "
            "else 'text/plain; charset=utf-8' end",
            "encoding_value": "case when kind in ('base64', 'bad_base64') then 'base64' "
            "when kind <> 'alternative' then '8bit' end",
            "cut_packed": "replace(packed, '=', '')",
        },
        {
            "payload": "case kind when 'base64' then packed "
            "when 'bad_base64' then case when length(cut_packed) % 4 = 0 then cut_packed || 'QQ' else cut_packed end "
            f"when 'alternative' then concat_ws({NL}, '--=-cut-here', 'Content-Type: text/plain; charset=utf-8', "
            "'Content-Transfer-Encoding: 8bit', '', full_text, '--=-cut-here', 'Content-Type: text/html; charset=utf-8', "
            "'Content-Transfer-Encoding: 8bit', '', html, '--=-cut-here--', '') else full_text end",
            "headers": f"concat_ws({NL}, 'From: ' || from_value, "
            f"'To: ' || replace(to_value, ', peer', ',' || {NL} || chr(9) || 'peer'), "
            "'Cc: ' || cc_value, 'Bcc: ' || bcc_value, 'Date: ' || date_value, 'Message-ID: ' || id_value, "
            "'Subject: ' || first_subject, 'Subject: ' || subject_value, 'MIME-Version: 1.0', "
            "'Content-Type: ' || type_value, 'Content-Transfer-Encoding: ' || encoding_value)",
        },
        {"value": f"headers || {NL} || {NL} || payload"},
    ]


#: Documents as replies, in SQL that both engines read: answers between quoted lines, introductions that wrap,
#: history without marks, quoted introductions, answers above and below.
REPLY = f"""case doc_id % 6
  when 0 then concat_ws({NL}, 'On Mon, 1 Jan 2024, Ann wrote:', '> a question', '> and its end', '', text, '', '>', '> another', 'Bye', '> -- ')
  when 1 then concat_ws({NL}, 'Hi,', text, 'On Mon, 1 Jan 2024 at 10:00, Ann Example', '<ann@example.com> wrote:', '', ' ', '> old', 'below ' || source)
  when 2 then concat_ws({NL}, '> not introduced', text, '> nor this', 'end', '> last', '')
  when 3 then concat_ws({NL}, text, 'El lun, 1 ene 2024, Ann escribió:', 'all of this is old', '> and this', text)
  when 4 then concat_ws({NL}, 'Le lun. 1 janv. 2024, Ann a écrit :', '> Op ma 1 jan. 2024 Bob schreef:', '>> oldest', text, '> tail', '',
    '-----Original Message-----', 'From: someone', text)
  else concat_ws({NL}, text, '-----Original Message-----', '> From: Ann', '> ' || source, 'the answer', 'On a day', 'in May', '> wrote:') end"""


def mail_documents(documents: DataFrame) -> DataFrame:
    """Documents with every fixture column."""
    for layer in layers(_spark):
        documents = documents.selectExpr("*", *[f"{sql} as `{name}`" for name, sql in layer.items()])
    return documents


def as_kafka_rows(documents: DataFrame) -> DataFrame:
    """Documents as Kafka rows, plus ``doc_id``."""
    return mail_documents(documents).select(
        F.col("doc_id").cast("string").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("email").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.timestamp_seconds("day_secs").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        "doc_id",
    )


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_kafka_rows(read_documents(spark, sf_dir))


def mail_sql() -> str:
    """The same columns for DuckDB, as the CTE ``mail``."""
    ctes, last = [], "documents"
    steps = layers(_duck)
    for number, layer in enumerate(steps):
        name = "mail" if number == len(steps) - 1 else f"mail{number}"
        columns = ", ".join(f'{sql} as "{column}"' for column, sql in layer.items())
        ctes.append(f"{name} as (select *, {columns} from {last})")
        last = name
    return ", ".join(ctes)
