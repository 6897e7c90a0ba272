"""The registered queries of the corpus operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.llm import bpe, decontam, langid, lines, lm, quality, repair, secrets, simhash, substrings, urls, warc, whitening
from panelflow.llm.base import table
from panelflow.session import scratch_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=False)
    return coded.withColumnRenamed("id", "doc_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return clean.select("doc_id", F.col("n_lines_").alias("n_lines"), F.col("n_removed_").alias("n_removed"), "text")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.withColumnRenamed("id", "doc_id").drop("text_hash", "d2")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "p_block")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    samples = langid.learn(docs.filter(~held_out), "text", "lang", "doc_id")
    got = langid.predict(docs.withColumn("doc_id", F.struct("doc_id", held_out.alias("held_out"))), samples)
    return got.select("id.doc_id", "id.held_out", "lang_pred", "score")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return near.select(
        F.col("id").alias("doc_id"), simhash.hex64(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives below the shared folder, then reads them by two scans with pushed predicates.

    The digest and size of a response are those of the payload read back, checked against its
    header; of a revisit, those its headers state.
    """
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.register(spark)
    warc.page_records(pages).write.format("warc").mode("append").save(path)
    read = spark.read.format("warc")
    full = read.load(path).filter("record_type = 'response'")
    short = read.option("payload", "false").load(path).filter("record_type = 'revisit'")
    digest = F.sha2("payload", 256)
    stated = F.regexp_replace("payload_digest", "^sha256:", "")
    same = (digest == stated) & (F.octet_length("payload") == F.col("payload_bytes"))
    full = full.withColumn("digest", F.when(same, digest).otherwise(F.raise_error("a payload differs from its header").cast("string")))
    rows = full.drop("payload").unionByName(short.withColumn("digest", stated).drop("payload"))
    kind = pages.schema["page_id"].dataType
    return rows.select(
        warc.page_of(F.col("record_id")).cast(kind).alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        warc.page_of(F.col("refers_to")).cast(kind).alias("refers_to"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return clean.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32).withColumnRenamed("id", "vec_id")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repair_reports(turns, "id", copies=F.col("copies")).withColumnRenamed("id", "conv_id")


def op13_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    got = lm.score(docs, "doc_id", "text", ~F.col("held_out"))
    return got.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_bpe,
        op3_line_dedup,
        op4_quality,
        op5_urls,
        op6_language,
        op7_simhash_near_dedup,
        op8_warc,
        op9_decontamination,
        op10_substring_dedup,
        op11_whitening,
        op12_repair,
        op13_lm,
    )
}

#: The others hash by functions that SQL lacks, or learn from the data; they have brute-force tests.
ORACLES: dict[str, str] = {
    "op8_warc": """
        with p as (
          select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
          from pages),
        f as (select payload_digest as digest, min(page_id) as first_id from p group by 1)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
        from p join f on payload_digest = digest""",
    "op9_decontamination": r"""
        with dw as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        iw as (
          select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
        item as (select item_id, w, least(10, len(w)) as k from iw where len(w) > 0),
        win as (
          select distinct item_id, k, array_to_string(w[i : i + k - 1], ' ') as s
          from (select *, unnest(range(1, len(w) - k + 2)) as i from item)),
        sizes as (select distinct k from win),
        dwin as (
          select doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') as s
          from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from dw, sizes where len(w) >= k)),
        hits as (select doc_id, dwin.k as k, i, item_id from dwin join win on dwin.k = win.k and dwin.s = win.s),
        hit_words as (
          select doc_id, count(distinct p) as n_hit
          from (select doc_id, unnest(range(i, i + k)) as p from (select distinct doc_id, k, i from hits)) group by 1),
        hit_items as (
          select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
          from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by 1)
        select dw.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from dw left join hit_words on dw.doc_id = hit_words.doc_id left join hit_items on dw.doc_id = hit_items.doc_id""",
    "op10_substring_dedup": r"""
        with dw as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        win as (
          select doc_id, i, array_to_string(w[i : i + 19], ' ') as s
          from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from dw where len(w) >= 20)),
        later as (
          select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as place from win)
          where place > 1),
        gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from later),
        words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from dw),
        kept as (
          select words.doc_id, string_agg(word, ' ' order by words.p) as kept, count(*) as n_kept
          from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p
          where gone.p is null group by 1)
        select dw.doc_id, len(w) as n_words, len(w) - coalesce(n_kept, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from dw left join kept on dw.doc_id = kept.doc_id""",
}
