"""The operators of this subpackage over the whole sample tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    bpe,
    cover_tree,
    decontaminate,
    hard_negatives,
    html_text,
    langid,
    licenses,
    repeats,
    resampling,
    secret_scan,
    sharding,
    simhash,
    warc,
)
from orderlens.llm.common import table

VOCABULARY = "byte_bpe_50k.tiktoken"
SHARDS = 24


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op5_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.learn(docs))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the law of near equal bytes; a number of shards more would deal all groups anew."""
    sharded = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return sharded.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_simhash_near_dedup,
        op3_benchmark_decontamination,
        op4_html_extraction,
        op5_byte_level_bpe,
        op6_embedding_near_dedup,
        op7_language_id,
        op8_license_scans,
        op9_secret_scans,
        op10_suffix_array_dedup,
        op11_sharding,
        op12_hard_negative_mining,
        op13_importance_resampling,
    )
}

# CRC-32 of the bytes of w, a string of two hexadecimal digits a byte.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(regexp_extract_all(w, '..'), lambda x: ('0x' || x)::bigint)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""

ORACLE: dict[str, str] = {
    "op1_warc": """
        with digested as (
            select page_id, url, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                   sha256(coalesce(html, '')) as payload_digest
            from pages),
        firsts as (
            select *, case when payload_bytes >= 100
                           then min(page_id) over (partition by payload_digest) end as first
            from digested)
        select page_id, payload_bytes, payload_digest,
               case when page_id is distinct from first and first is not null then 'revisit' else 'response' end
                   as record_type,
               case when page_id is distinct from first then first end as refers_to,
               url
        from firsts""",
    "op6_embedding_near_dedup": """
        with recursive valid as (
            select vec_id, label, cast(embedding as double[]) as v
            from embeddings
            where label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links as (
            select a.vec_id as a, b.vec_id as b
            from valid a join valid b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
            where list_cosine_similarity(a.v, b.v) >= 0.93),
        reach as (
            select vec_id as a, vec_id as b from embeddings
            union
            select reach.a, links.b from reach join links on reach.b = links.a),
        components as (select a as vec_id, min(b) as component_id from reach group by a),
        counts as (select a as vec_id, count(*) as n_links from links group by a)
        select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
        from embeddings join components using (vec_id) left join counts using (vec_id)""",
    "op11_sharding": f"""
        with recursive sized as (
            select doc_id, coalesce(text, '') as content, octet_length(encode(content)) + 8 as size,
                   hex(encode(content)) as w
            from documents),
        grouped as (
            select content, sum(size)::bigint as group_size,
                   row_number() over (order by sum(size) desc, min(doc_id)) as turn
            from sized group by content),
        dealt as (
            select 0::bigint as turn, list_transform(range(24), lambda x: 0::bigint) as loads, -1::bigint as shard
            union all
            select turn + 1,
                   list_transform(loads, lambda load, i: case when i = least then load + group_size else load end),
                   least - 1
            from (select dealt.turn, loads, group_size, list_position(loads, list_min(loads)) as least
                  from dealt join grouped on grouped.turn = dealt.turn + 1))
        select doc_id, size::bigint as size, {_CRC32}::bigint as text_crc32, 'bytes' as law, shard::int as shard,
               row_number() over (partition by shard order by doc_id) - 1 as slot, null::int as grown_shard
        from sized join grouped using (content) join dealt using (turn)""",
    "op12_hard_negative_mining": """
        with usable as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as fellow,
                   list_inner_product(a.v, b.v)::bigint as score
            from usable a join usable b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
        positives as (
            select anchor_id, other_id as positive_id, score as positive_score from scored where fellow
            qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
        hard as (
            select anchor_id, positive_id, positive_score, other_id as negative_id, score as negative_score,
                   row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as rank
            from positives join scored using (anchor_id)
            where not fellow and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
        select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
        from hard where rank <= 5""",
    "op13_importance_resampling": f"""
        with split as (
            select 'd' as kind, doc_id as id, text from documents
            union all select 't', item_id, text from benchmark),
        words as (
            select kind, id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word
            from split),
        hashed as (
            select word, {_CRC32} % 10000 as bucket
            from (select distinct word, hex(encode(word)) as w from words)),
        counted as (
            select bucket, count(*) filter (kind = 'd') as s, count(*) filter (kind = 't') as t
            from words join hashed using (word) group by bucket),
        gains as (
            select bucket, floor(1000 * ln((t + 1.0::double) * (sum(s) over () + 10000)
                                           / ((s + 1.0::double) * (sum(t) over () + 10000)))) as gain
            from counted),
        weighed as (
            select id as doc_id, count(*) as n, floor(sum(gain) / count(*)) as mean
            from words join hashed using (word) join gains using (bucket) where kind = 'd' group by id),
        scored as (
            select doc_id, coalesce(n, 0) as n_features, coalesce(mean, 0)::bigint as weight,
                   weight + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double)
                       / 4294967296)))::bigint as score
            from documents left join weighed using (doc_id)),
        placed as (
            select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place
            from scored)
        select doc_id, n_features, weight, score,
               case when n_features >= 20 and place <= count(*) filter (n_features >= 20) over () * 10 // 100
                    then place end as rank
        from placed""",
}
