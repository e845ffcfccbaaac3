"""Registered queries of the operators: thin digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_pieces(docs: DataFrame) -> DataFrame:
    from bankmart.llm.pack import pack_documents

    return pack_documents(docs, tokenizer_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_pieces(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85).withColumnRenamed("id", "doc_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.line_dedup import drop_repeated_lines

    return drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("n_lines_").cast("long").alias("n_lines"), F.col("n_deleted_").cast("long").alias("n_deleted"), "text")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents")).withColumns(
        {c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    from bankmart.llm.toxicity import THRESHOLD, score_toxicity

    return score_toxicity(docs, labels, train_on=lambda c: ~held_out(c)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.hnsw import nearest

    return nearest(table(spark, sf_dir, "embeddings"), lambda c: c % 20 == 0)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.html_extract import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.pii import BASE, KINDS, find_pii, joined

    return find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index("secret"))).cast("long").alias("n_secret"),
        F.size("spans").cast("long").alias("n_spans"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.hard_negatives import mine

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), lambda c: c % 100 == 0)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.suffix_dedup import drop_repeats

    return drop_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bankmart.llm.prefix_trie import ordered_turns, prefix_trie, shared_heads

    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie(*shared_heads(ordered_turns(table(spark, sf_dir, "conversations")), 20, head, 3))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_ngram_join": op2_ngram_join,
    "op3_line_dedup": op3_line_dedup,
    "op4_licenses": op4_licenses,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_hnsw": op7_hnsw,
    "op8_warc": op8_warc,
    "op9_html": op9_html,
    "op10_pii": op10_pii,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op8_warc": """
        with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
        d as (select page_id, octet_length(payload) as n, sha1(payload) as digest from p),
        k as (select *, case when n >= 1000 then max(page_id) over (partition by digest) end as kept from d)
        select page_id, n as payload_bytes, digest as payload_digest,
               case when kept is distinct from page_id and kept is not null then 'revisit' else 'response' end as record_type,
               case when kept is distinct from page_id then kept end as refers_to
        from k""",
    "op11_hard_negatives": """
        with e as (
          select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                 list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
          from embeddings where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
          select a.vec_id as anchor_id, a.label as own, b.vec_id, b.label,
                 coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::bigint as score
          from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
        p as (
          select anchor_id, vec_id as positive_id, score as positive_score from s where own = label
          qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select p.anchor_id, p.positive_id,
               (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id))::int as rank,
               s.vec_id as negative_id, p.positive_score, s.score as negative_score
        from p join s on s.anchor_id = p.anchor_id and s.own <> s.label
          and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
        qualify rank <= 5""",
    "op12_suffix_dedup": """
        with b as (select doc_id, encode(coalesce(text, '')) as raw from documents),
        w as (
          select doc_id, start, row_number() over (partition by md5(raw[start + 1:start + 100]) order by doc_id, start) > 1 as again
          from (select doc_id, raw, unnest(range(octet_length(raw) - 99)) as start from b where octet_length(raw) >= 100)),
        i as (
          select doc_id, start, case when start <= lag(start) over (partition by doc_id order by start) + 100 then 0 else 1 end as opens
          from w where again),
        r as (
          select doc_id, nth, min(start) as start, max(start) + 100 as stop
          from (select *, sum(opens) over (partition by doc_id order by start) as nth from i) group by doc_id, nth),
        g as (
          select doc_id, start, stop, coalesce(lag(stop) over (partition by doc_id order by start), 0) as before,
                 lead(start) over (partition by doc_id order by start) is null as last from r),
        k as (
          select b.doc_id, sum(stop - start) as n_removed, count(*) as n_spans,
                 string_agg(hex(raw[before + 1:start]) || case when last then hex(raw[stop + 1:octet_length(raw)]) else '' end, '' order by start) as kept
          from g join b on b.doc_id = g.doc_id group by b.doc_id)
        select b.doc_id, octet_length(raw)::bigint as n_bytes, coalesce(k.n_removed, 0)::bigint as n_removed,
               coalesce(k.n_spans, 0)::bigint as n_spans, sha256(coalesce(unhex(k.kept), raw)) as kept_sha256
        from b left join k on k.doc_id = b.doc_id""",
    # crc32 by bits: 3988292384 is the reversed polynomial
    "op13_prefix_trie": """
        with t as (
          select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
                 row_number() over (partition by conv_id order by turn nulls first,
                   sha256(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as p,
                 count(*) over (partition by conv_id) as n
          from conversations where conv_id is not null),
        ids as (select c, any_value(n) as n, c - c % 20 as base, c::varchar as s from t group by c),
        v as (
          select c, n, base, xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(length(s)), lambda i: ascii(s[i + 1])::bigint)),
                   lambda a, x: list_reduce(list_concat([xor(a, x)], range(8)), lambda z, q: xor(z >> 1, (z & 1) * 3988292384::bigint))),
                 4294967295::bigint) % 4 as h
          from ids),
        l as (select v.*, least(v.h, coalesce(ids.n, 0)) as taken from v left join ids on ids.c = v.base),
        turns as (
          select l.c, t.p + 1 as depth, role, text from l join t on t.c = l.base and t.p < l.h
          union all
          select l.c, t.p - l.h + l.taken + 1, role, text from l join t on t.c = l.c and t.p >= l.h),
        paths as (
          select c, depth, text, string_agg(sha256(octet_length(encode(role))::varchar || ':' || role || text), ',') over (partition by c order by depth) as path
          from turns),
        members as (select *, min(c) over (partition by depth, path) as name from paths
                    union all select c, 0, null, null, min(c) over () from l),
        nodes as (
          select depth, name, count(*) as n_convs, coalesce(len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')), 0) as words
          from members group by depth, name),
        up as (select n.*, m.name as parent from nodes n left join members m on m.c = n.name and m.depth = n.depth - 1),
        kids as (select depth - 1 as depth, parent as name, count(*) as n_children from up where depth > 0 group by all),
        own as (select up.*, coalesce(n_children, 0) as n_children from up left join kids on kids.depth = up.depth and kids.name = up.name),
        sums as (
          select m.depth, m.name, count_if(o.n_children = 0) as n_leaves, sum((o.n_convs - 1) * o.words) as saved
          from own o join members m on m.c = o.name and m.depth <= o.depth group by m.depth, m.name),
        ends as (
          select depth, name, sha256(string_agg(c::varchar, ',' order by c)) as digest
          from members m where depth = (select max(depth) from members x where x.c = m.c) group by depth, name)
        select o.name as conv_id, o.depth::bigint as depth, o.parent as parent_conv_id, o.n_convs, o.n_children,
               s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, coalesce(e.digest, sha256('')) as ends_sha256
        from own o join sums s on s.depth = o.depth and s.name = o.name
        left join ends e on e.depth = o.depth and e.name = o.name""",
}
