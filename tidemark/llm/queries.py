"""Registered queries of the training-data operators, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination, extraction, language, lexical, licenses, neighbours, packing, periodic, quality, sharding, simhash,
    toxicity, warc,
)
from tidemark.llm.common import fold, read

SHARDS = 24


def op1_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op2_quality_rules(spark, sf_dir):
    return quality.score_quality(read(spark, sf_dir, "documents"))


def op3_html_extraction(spark, sf_dir):
    return extraction.extract(read(spark, sf_dir, "pages"))


def op4_benchmark_decontamination(spark, sf_dir):
    found = decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontamination.items_digest(F.col("items")).alias("items_sha256"), "contaminated",
    )


def op5_license_scan(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents"))


def op6_language_id(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    learnt = language.train(documents, fold(F.col("doc_id"), 4) != 2)
    return language.identify(documents, learnt).withColumn("held_out", fold(F.col("doc_id"), 4) == 2)


def op7_rendezvous_sharding(spark, sf_dir):
    rows = sharding.assign(read(spark, sf_dir, "documents"), [1.0] * SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_packing(spark, sf_dir):
    return packed(packing.pack(read(spark, sf_dir, "documents")))


def packed(pieces):
    length = F.shiftright(F.octet_length("piece"), 2).cast("long")
    return pieces.select(
        "doc_id", "start", length.alias("length"), F.crc32("piece").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset",
    )


def op9_toxicity(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    learn = fold(F.col("doc_id"), 3) != 1
    model = toxicity.train(documents, read(spark, sf_dir, "labels"), learn)
    scored = documents.select("doc_id", (~learn).alias("held_out"), toxicity.score(model, documents).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op10_warc_revisits(spark, sf_dir):
    found = warc.round_trip(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_lexical_search(spark, sf_dir):
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def with_planted_runs(documents):
    """``text`` as asked for: of every tenth document by crc32 of its id, the words from a place on repeat in a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = documents.select("doc_id", "text", g.alias("g"), F.when((h % 10 == 0) & F.col("text").isNotNull(), split).alias("w"))
    n = F.size("w")
    rows = rows.select("doc_id", "text", "g", "w", F.when(n > 0, F.col("g") % n).alias("a"))
    p = F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    rows = rows.select("doc_id", "text", "w", F.col("a").cast("int").alias("a"), p.cast("int").alias("p"))
    a, p = F.col("a"), F.col("p")
    planted = F.transform("w", lambda w, i: F.when(i < a, w).otherwise(F.get(F.col("w"), a + (i - a) % p)))
    return rows.select("doc_id", F.when(a.isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    documents = with_planted_runs(read(spark, sf_dir, "documents"))
    found = documents.select("doc_id", periodic.periodic_runs(F.col("text")).alias("f"))
    line = F.transform("f.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    line = F.array_join(F.transform(line, lambda t: F.concat(t, F.lit("\n"))), "")
    exponent = F.floor(1000 * F.col("f.best.length") / F.col("f.best.period"))
    return found.select(
        "doc_id", F.size("f.runs").cast("long").alias("n_runs"), "f.best.start", "f.best.length", "f.best.period",
        exponent.alias("exponent_milli"), F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("f.collapsed", 256).alias("collapsed_sha256"),
    )


def op13_nearest_neighbours(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_quality_rules, op3_html_extraction, op4_benchmark_decontamination, op5_license_scan,
        op6_language_id, op7_rendezvous_sharding, op8_packing, op9_toxicity, op10_warc_revisits,
        op11_lexical_search, op12_periodic_runs, op13_nearest_neighbours,
    )
}

# crc32 of UTF-8 text, byte by byte from its table (reflected polynomial 0xEDB88320)
_CRC_SQL = """crc_table as (
    select list(list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by n) as t
    from range(256) r(n)),
crc as (
    select text, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(strlen(text)),
        lambda i: ('0x' || substr(hex(encode(text)), (2 * i + 1)::int, 2))::bigint)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as crc
    from (select distinct coalesce(text, '') as text from documents), crc_table)"""

ORACLE = {
    "op4_benchmark_decontamination": r"""
with words as (
    select d.*, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents) d),
items as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where text is not null),
grams as (
    select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as g
    from (select *, least(len(w), 10) as size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
          from items where len(w) > 0)),
runs as (
    select r, size, i, array_to_string(w[i:i + size - 1], ' ') as g
    from (select r, size, w, unnest(range(1, len(w) - size + 2)) as i
          from words, (select distinct size from grams) where len(w) >= size)),
hits as (select r, i, runs.size, item_id from runs join grams on runs.g = grams.g and runs.size = grams.size),
marked as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + size)) as p from hits) group by r),
listed as (
    select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct r, item_id::varchar as item_id from hits where item_id is not null) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join marked using (r) left join listed using (r)""",
    "op7_rendezvous_sharding": f"""
with {_CRC_SQL},
keyed as (
    select doc_id, coalesce(text, '') as text, coalesce('k' || doc_id::varchar, 'n') as k from documents),
costs as (
    select doc_id, text, k, s,
           -ln((('0x' || substr(md5(k || '/' || s::varchar), 1, 12))::bigint::double + 0.5) / 281474976710656.0) as cost
    from keyed, range({SHARDS + 1}) g(s)),
placed as (
    select doc_id, text, k, arg_min(s, cost) filter (s < {SHARDS}) as shard, arg_min(s, cost) as grown_shard
    from (select *, row_number() over () as n from keyed) join costs using (doc_id, text, k)
    group by doc_id, text, k, n),
sized as (select doc_id, k, strlen(text) + 8 as size, crc, shard, grown_shard from placed join crc using (text)),
rows as (
    select *, ('0x' || substr(md5(concat_ws('/', 'bucket', k, size::varchar, crc::bigint::varchar)), 1, 8))::bigint
              % {sharding.BUCKETS} as bucket
    from sized)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'key' as law, shard::int as shard,
       row_number() over (partition by shard order by bucket, doc_id, size, crc) - 1 as slot,
       grown_shard::int as grown_shard
from rows""",
    "op10_warc_revisits": """
with p as (
    select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest from pages),
f as (select digest, min(page_id) as first from p where n >= 100 group by digest)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
       case when first is null or page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from p left join f using (digest)""",
    "op11_lexical_search": r"""
with t as (
    select r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from (select row_number() over () as r, * from documents where text is not null)),
d as (select r, doc_id, w, len(w)::bigint as n from t where len(w) > 0),
c as (select count(*)::bigint as docs, sum(n)::bigint as terms from d),
items as (
    select i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from (select row_number() over () as i, * from benchmark where text is not null)),
q as (select i, item_id, term, count(*)::bigint as repeats from (select i, item_id, unnest(w) as term from items) group by all),
p as (
    select r, doc_id, n, term, count(*)::bigint as tf
    from (select r, doc_id, n, unnest(w) as term from d) where term in (select term from q) group by all),
weighted as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
    from p, c group by term, docs),
scored as (
    select i, item_id, r, doc_id,
           sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::bigint
           as score
    from q join p using (term) join weighted using (term), c group by all)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by i order by score desc, doc_id nulls last) as rank from scored where score > 0)
where rank <= 10""",
    "op12_periodic_runs": r"""
with crc_table as (
    select list(list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by n) as t
    from range(256) r(n)),
d as (
    select row_number() over () as r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
           xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''),
               lambda x: ascii(x)::bigint)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as h
    from documents, crc_table),
s as (select *, len(w) as n, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a from d),
e as (select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from s),
words as (
    select r, i, n, case when a is null or i < a then w[i + 1] else w[(a + (i - a) % p + 1)::bigint] end as word
    from (select *, unnest(range(n)) as i from e)),
pairs as (
    select x.r, y.i - x.i as q, x.i from words x join words y on x.r = y.r and x.word = y.word and y.i > x.i
    where 3 * (y.i - x.i) <= x.n),
islands as (
    select r, q, min(i) as start, count(*) + q as length
    from (select *, i - row_number() over (partition by r, q order by i) as island from pairs)
    group by r, q, island having count(*) + q >= greatest(24, 3 * q)),
runs as (select r, start, length, min(q) as period from islands group by r, start, length),
listed as (
    select r, count(*) as n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
    from runs group by r),
best as (
    select * from runs qualify row_number() over (partition by r order by length / period desc, start, period) = 1),
dropped as (select distinct r, unnest(range(start + period, start + length)) as i from runs),
kept as (
    select r, string_agg(word, ' ' order by i) as collapsed
    from words anti join dropped using (r, i) group by r)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length,
       period::bigint as period, (1000 * length // period)::bigint as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from d left join listed using (r) left join best using (r) left join kept using (r)""",
}
