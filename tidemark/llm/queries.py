"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, ann_forest, bpe, decontamination, language_id, license_scan, mixing, quality, simhash, spelling,
    suffix_dedup, toxicity, warc_revisit,
)
from tidemark.llm.common import held_out, table


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_toxic_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", held_out())


def op2_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = suffix_dedup.without_repeats(docs, length=50)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return ann_forest.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op4_license_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    return language_id.label(docs.select("doc_id", "text"), model).withColumn("held_out", held_out())


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "copies")


def op7_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, RANKS).withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = bpe.decode(encoded, RANKS)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_simhash_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train_lines(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model)


def crawl_records(pages: DataFrame) -> DataFrame:
    """Crawl records derived from `pages`: what a crawler that comes by in order of page_id would have written.

    Each page gives a full response, a revisit an hour later and one under a decorated URL half a minute before; the
    validators agree, differ or are missing in turn. Each visit also fetches the host's robots.txt, in full every tenth
    time, so a common host has one URL with very many records.
    """
    second = F.col("page_id") * 60
    etag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    day = F.concat(F.lit("day "), F.floor(F.col("page_id") / 100).cast("string"))
    host = F.regexp_extract("url", r"^([A-Za-z]+://[^/?#]*)", 1)
    turn, tenth = F.col("page_id") % 5, F.floor(F.col("page_id") / 10)

    def headers(at: Column, length: Column, age: int) -> Column:
        return F.create_map(
            F.lit("Date"), at.cast("string"), F.lit("Content-Length"), length.cast("string"),
            F.lit("Cache-Control"), F.lit(f"max-age={age}"),
        )

    def record(n: int, url: Column, at: Column, status: Column, tag: Column, modified: Column, digest: Column, head: Column):
        return F.struct(
            (F.col("page_id") * 4 + n).alias("record_id"), url.alias("url"), F.timestamp_seconds(at).alias("captured"),
            status.cast("int").alias("status"), tag.cast("string").alias("etag"),
            modified.cast("string").alias("last_modified"), digest.cast("string").alias("digest"), head.alias("headers"),
        )

    none, length = F.lit(None), F.octet_length("html")
    seen = F.when(turn == 0, F.concat(F.lit("W/"), etag)).when(turn == 1, F.lit('"other"')).when(turn == 4, etag)
    robots_full = F.col("page_id") % 10 == 0
    robots_tag = F.concat(F.lit('"'), host, F.lit("-"), tenth.cast("string"), F.lit('"'))
    return pages.select(
        F.inline(
            F.array(
                record(
                    0, F.col("url"), second, F.lit(200), F.when(turn != 3, etag), day, F.md5(F.col("html").cast("binary")),
                    headers(second, length, 60),
                ),
                record(
                    1, F.col("url"), second + 3600, F.lit(304), seen, F.when(turn == 2, day), none,
                    headers(second + 3600, F.lit(0), 120),
                ),
                record(
                    2, F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("?utm_medium=mail#again")), second - 30,
                    F.lit(304), etag, none, none, headers(second - 30, F.lit(0), 240),
                ),
                record(
                    3, F.concat(host, F.lit("/robots.txt")), second, F.when(robots_full, 200).otherwise(304), robots_tag,
                    none, F.when(robots_full, F.md5(robots_tag.cast("binary"))), headers(second, F.col("page_id"), 600),
                ),
            )
        )
    )


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisit.resolve(crawl_records(table(spark, sf_dir, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(F.array_sort(lines), "; "))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_winnowed_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), length=10)
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), "contaminated")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_LEVEL, PIECES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxic_instances": op1_toxic_instances,
    "op2_suffix_repeats": op2_suffix_repeats,
    "op3_forest_neighbours": op3_forest_neighbours,
    "op4_license_blocks": op4_license_blocks,
    "op5_language_spans": op5_language_spans,
    "op6_source_mix": op6_source_mix,
    "op7_word_bpe": op7_word_bpe,
    "op8_simhash_bit_sliced": op8_simhash_bit_sliced,
    "op9_line_quality": op9_line_quality,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_winnowed_benchmark": op12_winnowed_benchmark,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op6_source_mix": """
        with sized as (
            select doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
                   ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as hash
            from documents
        ),
        sources as (select source, sum(size)::bigint as source_size from sized group by source),
        weighed as (
            select *, 2.0::double * source_size as cap,
                   [5.0::double, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
            from sources
        ),
        levels as (
            select *, cap / weight as ratio,
                   (1.5::double * (select sum(source_size) from sources)::double
                    - coalesce(sum(cap) over (order by cap / weight, source nulls last
                                              rows between unbounded preceding and 1 preceding), 0))
                   / sum(weight) over (order by cap / weight, source nulls last
                                       rows between current row and unbounded following) as level
            from weighed
        ),
        final as (
            select level from levels where cap >= level * weight order by ratio, source nulls last limit 1
        ),
        targets as (
            select source, source_size,
                   coalesce(least(cap, (select level from final) * weight), cap)::double as target
            from levels
        ),
        planned as (
            select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as copies from targets
        ),
        ranked as (
            select s.doc_id, s.size, s.hash, p.source_size, p.target, p.copies,
                   sum(s.size) over (partition by s.source order by s.hash
                                     range between unbounded preceding and current row) as upto,
                   p.target - p.copies * p.source_size as budget
            from sized s join planned p on s.source is not distinct from p.source
        )
        select doc_id, size, source_size, target,
               (size * (copies + case when upto <= budget then 1 else 0 end))::bigint as taken
        from ranked
    """,
    "op10_warc_revisits": """
        with visits as (
            select *, page_id * 60 as second, '"' || md5(html) || '"' as tag, 'day ' || (page_id // 100) as day,
                   regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) as host, strlen(html) as length
            from pages
        ),
        records as (
            select page_id * 4 as record_id, url, second, 200 as status, case when page_id % 5 <> 3 then tag end as etag,
                   day as last_modified, md5(html) as digest, length::varchar as length, 60 as age
            from visits
            union all
            select page_id * 4 + 1, url, second + 3600, 304,
                   case page_id % 5 when 0 then 'W/' || tag when 1 then '"other"' when 4 then tag end,
                   case when page_id % 5 = 2 then day end, null, '0', 120
            from visits
            union all
            select page_id * 4 + 2, regexp_replace(url, '[?#].*$', '') || '?utm_medium=mail#again', second - 30, 304, tag,
                   null, null, '0', 240
            from visits
            union all
            select page_id * 4 + 3, host || '/robots.txt', second, case when page_id % 10 = 0 then 200 else 304 end,
                   '"' || host || '-' || (page_id // 10) || '"', null,
                   case when page_id % 10 = 0 then md5('"' || host || '-' || (page_id // 10) || '"') end,
                   page_id::varchar, 600
            from visits
        ),
        cut as (
            select *, regexp_replace(trim(url), '#.*$', '') as bare from records
        ),
        parts as (
            select *, lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)) as site,
                   regexp_replace(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') as path,
                   list_sort(list_filter(
                       string_split(regexp_extract(bare, '\\?(.*)$', 1), '&'),
                       lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)')
                   )) as asked
            from cut
        ),
        keyed as (
            select *, regexp_replace(regexp_replace(site, ':(80|443)$', ''), '^www\\.', '') || path
                      || case when len(asked) > 0 then '?' || array_to_string(asked, '&') else '' end as url_key
            from parts
        ),
        stored as (
            select *, last_value(case when status = 200 then struct_pack(
                          record_id := record_id, etag := etag, last_modified := last_modified, digest := digest,
                          length := length) end ignore nulls)
                      over (partition by url_key order by second, record_id
                            rows between unbounded preceding and 1 preceding) as old
            from keyed
        ),
        judged as (
            select *, case
                when old is null then 'missing'
                when etag is not null and old.etag is not null then
                    case when regexp_replace(etag, '^W/', '') = regexp_replace(old.etag, '^W/', '')
                         then 'resolved' else 'changed' end
                when last_modified is not null and old.last_modified is not null then
                    case when last_modified = old.last_modified then 'resolved' else 'changed' end
                else 'unchecked' end as outcome
            from stored where status = 304
        )
        select record_id, url_key, outcome,
               case when outcome in ('resolved', 'unchecked') then old.record_id end as refers_to,
               case when outcome in ('resolved', 'unchecked') then old.digest end as digest,
               case when outcome in ('resolved', 'unchecked') then
                    'cache-control: max-age=' || age || '; content-length: ' || old.length || '; date: ' || second
               end as headers
        from judged
    """,
    "op12_winnowed_benchmark": """
        with items as (
            select coalesce(item_id::varchar, '') as item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
            from benchmark
        ),
        sized as (select *, least(10, len(words)) as length from items where len(words) > 0),
        placed as (select *, unnest(range(1, len(words) - length + 2)) as start from sized),
        windows as (
            select distinct item_id, length, array_to_string(words[start : start + length - 1], ' ') as span from placed
        ),
        docs as (
            select row_number() over () as row, doc_id, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as words
            from documents
        ),
        starts as (
            select row, words, length, unnest(range(1, len(words) - length + 2)) as start
            from docs, (select distinct length from windows) where len(words) >= length
        ),
        spans as (
            select row, start, length, array_to_string(words[start : start + length - 1], ' ') as span from starts
        ),
        hits as (
            select distinct row, start, length, item_id from spans join windows using (length, span)
        ),
        places as (select distinct row, unnest(range(start, start + length)) as place from hits),
        per_place as (select row, count(*) as n_hit from places group by row),
        per_item as (
            select row, count(*) as n_items, string_agg(item_id, ',' order by item_id) as listed
            from (select distinct row, item_id from hits) group by row
        )
        select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
               coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from docs left join per_place using (row) left join per_item using (row)
    """,
}
