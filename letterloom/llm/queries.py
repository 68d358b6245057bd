"""The registered queries of the operators in this folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.llm.byte_pairs import encode_byte_pairs
from letterloom.llm.common import table, work_folder
from letterloom.llm.exact_dedup import exact_groups
from letterloom.llm.filter_audit import audit_filters
from letterloom.llm.html_text import extract_pages
from letterloom.llm.packing import pack_documents
from letterloom.llm.periodic import find_runs
from letterloom.llm.pieces import encode_pieces
from letterloom.llm.pii import span_digest
from letterloom.llm.quality import rate_documents
from letterloom.llm.sharding import grown_tree, shard_rows
from letterloom.llm.simhash import simhash_groups
from letterloom.llm.vector_graph import linked_vectors
from letterloom.llm.warc import page_records

SHARDS = 24
BYTE_BPE = {
    "tokenizer_json": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks_file": public_tokenizers.path("byte_bpe_50k.tiktoken"),
}
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 by key, and where each row is with one more shard."""
    rows = shard_rows(table(spark, sf_dir, "documents"), grown_tree(SHARDS), grown_tree(SHARDS + 1))
    return rows.withColumn("law", F.lit("key"))


def op2_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), **BYTE_BPE)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(table(spark, sf_dir, "pages"), work_folder(spark, "warc"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_pieces(table(spark, sf_dir, "documents"), PIECE_MODEL)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        # spans lie side by side, so the last end is the number of bytes they cover
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("covered_bytes"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text): about every tenth text, chosen by its id, ends in a run of words that the id fixes."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    told = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    told = told.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    told = told.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("if(n > 0, int(g % n), 0)"))
    told = told.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    repeated = F.expr("transform(sequence(0, n - 1), i -> words[if(i < a, i, a + (i - a) % p)])")
    planted = F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return told.select("doc_id", planted.alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # the run of the most periods, compared as fractions; runs are sorted, so the first of equals stays
    best = F.expr("aggregate(runs, get(runs, 0), (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return rows.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_byte_pairs(table(spark, sf_dir, "documents"), BYTE_BPE["tokenizer_json"], public_tokenizers.PATTERN)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_vector_links, op3_packing, op4_quality, op5_pii, op6_exact_dedup, op7_page_text, op8_warc,
        op9_simhash, op10_pieces, op11_filter_audit, op12_periodic, op13_byte_pairs,
    )
}


def _tree_sql(node, key: str = "k") -> str:
    """The choice of a shard as nested CASE expressions over the same draws."""
    if node.shard is not None:
        return str(node.shard)
    if len(node.children) == 1:
        return _tree_sql(node.children[0], key)
    draws = [
        f"-ln((('0x' || substr(md5({key} || '@{c.name}'), 1, 13))::bigint + 0.5::double) / {2**52}::double) / {c.weight}::double"
        for c in node.children
    ]
    least = f"list_position([{', '.join(draws)}], list_min([{', '.join(draws)}]))"
    cases = " ".join(f"when {k + 1} then {_tree_sql(c, key)}" for k, c in enumerate(node.children))
    return f"case {least} {cases} end"


ORACLE: dict[str, str] = {
    "op2_vector_links": """
        with recursive v as (
            select vec_id, embedding::double[] as e from embeddings where embedding is not null
        ), u as (
            select vec_id, e from v
            where list_sum(list_transform(e, lambda x: x * x)) > 0 and isfinite(list_sum(list_transform(e, lambda x: x * x)))
              and len(list_filter(e, lambda x: x is null)) = 0
        ), links as (
            select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id
            where list_cosine_similarity(a.e, b.e) >= 0.9
        ), walk as (
            select a, b from links union select w.a, l.b from walk w join links l on w.b = l.a
        )
        select e.vec_id, coalesce(n, 0)::bigint as n_links, least(coalesce(m, e.vec_id), e.vec_id) as component_id,
            least(coalesce(m, e.vec_id), e.vec_id) = e.vec_id as kept
        from embeddings e
        left join (select a, count(*) as n from links group by a) c on c.a = e.vec_id
        left join (select a, min(b) as m from walk group by a) w on w.a = e.vec_id
    """,
    "op6_exact_dedup": r"""
        with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents)
        select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
            doc_id = min(doc_id) over same as kept, sha256(body) as text_sha256
        from t window same as (partition by body)
    """,
    "op8_warc": """
        with t as (select page_id, encode(coalesce(html, '')) as data from pages),
        f as (
            select page_id, octet_length(data) as size, sha256(data) as digest,
                min(page_id) over (partition by data) as first from t
        )
        select page_id, size as payload_bytes, digest as payload_digest,
            case when size >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
            case when size >= 100 and page_id <> first then first end as refers_to
        from f
    """,
    # every order and step played through over the documents' sets of failures; the Shapley sums are those of all steps
    "op11_filter_audit": r"""
        with d as (
            select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body,
                list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
            from documents
        ), l as (
            select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
        ), f as (
            select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, len(w) < 100 as a,
                100 * len(list_distinct(w)) < 80 * len(w) as b,
                100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 10 * length(body) as c,
                regexp_matches(body, '[#$%&*|]') as d,
                coalesce(d.doc_id > min(d.doc_id) over (partition by body), false) as e
            from d left join l on l.doc_id = d.doc_id
        ), masks as (
            select part, case when a then 'A' else '' end || case when b then 'B' else '' end || case when c then 'C' else '' end
                || case when d then 'D' else '' end || case when e then 'E' else '' end as fails,
                count(*) as n, sum(good) as good, sum(toxic) as toxic
            from f group by all
        ), letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x), orders as (
            select p.x || q.x || r.x || s.x || t.x as filter_order
            from letters p, letters q, letters r, letters s, letters t
            where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
        ), steps as (
            select part, filter_order, step, filter_order[step] as filter,
                sum(case when not has_before and not has then n else 0 end)::bigint as kept,
                sum(case when not has_before and has then n else 0 end)::bigint as removed,
                sum(case when has_before and has then n else 0 end)::bigint as redundant,
                sum(case when fails = filter_order[step] then n else 0 end)::bigint as unique_fails,
                sum(case when not has_before and has then good else 0 end)::bigint as good_lost,
                sum(case when not has_before and has then toxic else 0 end)::bigint as toxic_lost
            from (
                select *, contains(fails, filter_order[step]) as has,
                    len(list_filter(string_split(fails, ''), lambda x: x <> '' and contains(filter_order[:step - 1], x))) > 0 as has_before
                from masks, orders, (select unnest(range(1, 6))::int as step)
            ) group by part, filter_order, step
        )
        select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            sum(removed) over (partition by part, filter)::bigint as shapley
        from steps
    """,
    # the checksum a byte at a time through its table of 256 values; shards here are one slot bucket each
    "op1_sharding": f"""
        with lut as (
            select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, x: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as l
            from (select unnest(range(256))::bigint as i)
        ), t as (
            select doc_id, encode(coalesce(text, '')) as data, coalesce(doc_id::varchar, 'null') as k from documents
        ), placed as (
            select doc_id, octet_length(data) + 8 as size,
                xor(4294967295, list_reduce(
                    list_prepend(4294967295::bigint, list_transform(range(octet_length(data)),
                        lambda p: ('0x' || substr(hex(data), (2 * p + 1)::bigint, 2))::bigint)),
                    lambda c, x: xor(c >> 8, l[xor(c & 255, x) + 1])
                )) as text_crc32,
                {_tree_sql(grown_tree(SHARDS))} as shard, {_tree_sql(grown_tree(SHARDS + 1))} as grown_shard
            from t, lut
        )
        select doc_id, size, text_crc32, shard, grown_shard, 'key' as law,
            row_number() over (partition by shard order by doc_id, size, text_crc32) - 1 as slot
        from placed
    """,
}
