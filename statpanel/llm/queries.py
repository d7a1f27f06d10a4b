"""Registered queries of this subpackage and their SQL: thin digests of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from statpanel.llm import (
    divergence, fill_in_middle, html, lexicon, licenses, lines, near_duplicates, neighbours, packing, personal, syncmers, toxicity, warc,
)
from statpanel.llm.common import table
from statpanel.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), VOCABULARY))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    name = lexicon.build_lexicon(docs, VOCABULARY)
    return lexicon.round_trip(docs, VOCABULARY, name).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op4_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.against_next(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "first")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs, machine)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    read = warc.read_archives(spark, path)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("personal")
    counts = [F.size(personal.of_kinds(spans, (kind,))).cast("long").alias(f"n_{kind}") for kind in personal.BASE]
    base = F.sha2(personal.listed(personal.of_kinds(spans, personal.BASE)), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, personal.listed(spans).alias("spans"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    whole = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(whole, 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_html": op2_html,
    "op3_lexicon": op3_lexicon,
    "op4_syncmers": op4_syncmers,
    "op5_licenses": op5_licenses,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_toxicity": op7_toxicity,
    "op8_lines": op8_lines,
    "op9_warc": op9_warc,
    "op10_nearest": op10_nearest,
    "op11_personal": op11_personal,
    "op12_divergence": op12_divergence,
    "op13_fill_in_middle": op13_fill_in_middle,
}

#: SQL where it can express a query. The others are tested against brute force, round trips or held-out labels.
ORACLE: dict[str, str] = {
    "op9_warc": """
        with digested as (
            select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
        chunked as (
            select *, min(page_id) over (partition by html) as first,
                list_transform(range(8), lambda i: cast('0x' || substr(hex, cast(5 * i + 1 as int), 5) as int)) as chunks
            from digested)
        select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes,
            array_to_string(list_transform(chunks, lambda v: array_to_string(list_transform([15, 10, 5, 0],
                lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> b) & 31) + 1, 1)), '')), '') as payload_digest,
            case when page_id > first then 'revisit' else 'response' end as record_type,
            case when page_id > first then first end as refers_to
        from chunked""",
    "op12_divergence": r"""
        with rows as (
            select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
        words as (
            select doc, lang, source, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from rows),
        kept as (select lang, term, count(*) as n from words group by lang, term having count(distinct doc) >= 30),
        langs as (select lang, count(*) as v, sum(n) as n from kept group by lang),
        sources as (select distinct lang, source from rows),
        counts as (select lang, source, term, count(*) as c from words semi join kept using (lang, term) group by all),
        sizes as (select lang, source, sum(c) as n from counts group by all),
        shares as (
            select s.lang, s.source, k.term, coalesce(c.c, 0) as c,
                1 + (1000000000::hugeint * (coalesce(c.c, 0) + 5)) // (coalesce(z.n, 0) + 5 * l.v) as p,
                1 + (1000000000::hugeint * (k.n + 5)) // (l.n + 5 * l.v) as q
            from sources s join kept k using (lang) join langs l using (lang)
            left join sizes z using (lang, source) left join counts c using (lang, source, term)),
        terms as (select lang, source, term as item, cast(p - q as bigint) as value from shares where c > 0 and p > q),
        distances as (
            select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        pairs as (
            select a.lang, a.source, b.source as item, cast(coalesce(d.value, 0) as bigint) as value
            from sources a join sources b on a.lang = b.lang and a.source <> b.source
            left join distances d on d.lang = a.lang and d.source = a.source and d.item = b.source),
        ranked as (
            select lang, source, 'term' as part, item, value,
                cast(row_number() over (partition by lang, source order by value desc, item) as int) as rank from terms
            qualify rank <= 50
            union all
            select lang, source, 'pair' as part, item, value,
                cast(row_number() over (partition by lang, source order by value desc, item) as int) as rank from pairs)
        select * from ranked""",
    "op13_fill_in_middle": r"""
        with hashed as (
            select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as hex from documents),
        drawn as (
            select doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as units,
                list_transform(range(4), lambda i: cast('0x' || substr(hex, cast(8 * i + 1 as int), 8) as bigint)) as h
            from hashed),
        cuts as (
            select *, len(units) as n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as a,
                greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as b,
                case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 100 then 'plain'
                    when h[4] % 100 < 50 then 'spm' else 'psm' end as form
            from drawn),
        parts as (
            select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle, array_to_string(units[b + 1:], '') as suffix
            from cuts)
        select doc_id, cast(n as bigint) as n, form,
            case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
            case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
            sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
            sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256
        from parts""",
}
