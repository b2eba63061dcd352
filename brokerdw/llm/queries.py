"""One query per operator over the whole tables, with the columns agreed for it, and its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerdw.llm import bpe, divergence, fingerprints, hnsw, katz, languages, license, lines, mixing, nearcopies, resampling, shards, toxicity
from brokerdw.llm.common import ship_package

NEIGHBOURS = 10
MODEL_ORDER = 3
QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.scan(read(spark, sf_dir, "documents"))
    starts = F.transform(F.filter("spans", lambda s: s["base"]), lambda s: s["start"])
    label = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        label(F.filter("spans", lambda s: s["base"])).alias("base_labels"),
        label(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )


@query("op3_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    both = bpe.decode(bpe.encode(read(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


MIX_SQL = f"""
with rows as (
  select doc_id, source, md5('{mixing.SEED}:' || coalesce(cast(doc_id as varchar), '')) as k,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
sizes as (select source, sum(size)::bigint as source_size from rows group by source),
numbered as (select *, [5, 2, 1][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::bigint as w from sizes),
ratios as (select *, source_size * 3 as lim, (source_size * 3)::double / w as ratio from numbered),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(lim) over earlier, 0))::double
      / (sum(w) over () - coalesce(sum(w) over earlier, 0))::double as level
  from ratios window earlier as (order by ratio, source nulls first rows between unbounded preceding and 1 preceding)),
final as (select arg_min(level, ratio) as f from levels where ratio > level),
targets as (select source, source_size,
  case when ratio <= level then lim::double else (select f from final) * w end as target from levels),
placed as (
  select doc_id, size, source_size, target,
    coalesce(sum(size) over (partition by r.source order by k rows between unbounded preceding and 1 preceding), 0) as b,
    case when source_size > 0 then floor(target / source_size) else 0 end as e
  from rows r join targets t on r.source is not distinct from t.source)
select doc_id, size, source_size, target,
  cast(e * size + greatest(0, least(floor(target - e * source_size) - b, size)) as bigint) as taken from placed
"""


@query("op6_mixing", MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


# CRC-32 by its table, which eight halvings of every byte give.
SHARD_SQL = f"""
with recursive halved(i, step, c) as (
  select i, 0, i::bigint from range(256) t(i)
  union all
  select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from halved where step < 8),
tab as (select list(c order by i) as t from halved where step = 8),
rows as (
  select row_number() over () as r, doc_id, coalesce('=' || source, '') as g, strlen(coalesce(text, '')) + 1 as size,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda h: (strpos('0123456789ABCDEF', h[1]) * 16 + strpos('0123456789ABCDEF', h[2]) - 17)::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32,
    md5('{shards.SEED}:' || coalesce(cast(doc_id as varchar), '')) as k
  from documents, tab),
spread as (
  select *, (row_number() over (partition by g order by k, text_crc32, size) - 1 + 0.5::double)
    / count(*) over (partition by g) as part from rows),
placed as (
  select *, row_number() over (order by part, g, k, text_crc32, size) - 1 as b, count(*) over () as n from spread)
select doc_id, size::bigint as size, text_crc32, 'rows' as law, (b * {shards.SHARDS} // n)::int as shard,
  b - ((b * {shards.SHARDS} // n) * n + {shards.SHARDS - 1}) // {shards.SHARDS} as slot, null::int as grown_shard
from placed
"""


@query("op8_sharding", SHARD_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(read(spark, sf_dir, "documents"))


@query("op10_hnsw")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    index = hnsw.build_index(vectors, copies=NEIGHBOURS + 1)
    return hnsw.search(vectors.filter("vec_id % 100 = 0"), index, NEIGHBOURS)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (toxicity.fold(F.col("doc_id"), 4) == toxicity.HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op2_katz")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(read(spark, sf_dir, "documents"), MODEL_ORDER)


@query("op4_near_copies")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearcopies.cluster(read(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    removed = lines.repeated_lines(docs).select(F.col("doc_id").alias("_id"), F.col("tie").alias("_t"), "removed")
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    sized = docs.select("doc_id", F.xxhash64("text").alias("tie"), count.alias("n_lines"))
    joined = sized.join(removed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_t")), "left")
    return joined.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"),
    )


@query("op7_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.shown(F.col("sketch")).alias("fingerprint"),
        fingerprints.shown(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


DIVERGENCE_SQL = f"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as words from documents),
words as (select r, lang, source, unnest(words) as term from docs),
kept as (select lang, term from words group by lang, term having count(distinct r) >= {divergence.LEAST}),
sizes as (select lang, count(*) as v from kept group by lang),
counts as (select lang, source, term, count(*)::hugeint as n from words semi join kept using (lang, term) group by all),
groups as (
  select g.lang, g.source, coalesce(sum(n), 0)::hugeint as whole, coalesce(any_value(v), 0)::hugeint as v
  from (select distinct lang, source from docs) g
  left join counts c on g.lang = c.lang and g.source = c.source left join sizes s on g.lang = s.lang group by all),
langs as (select lang, sum(whole)::hugeint as whole from groups group by lang),
shares as (
  select g.lang, g.source, k.term, coalesce(n, 0) as n,
    1 + ({divergence.SCALE} * (coalesce(n, 0) + {divergence.ADD})::hugeint) // (g.whole + {divergence.ADD} * g.v) as p
  from groups g join kept k on g.lang = k.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
wholes as (
  select c.lang, term, 1 + ({divergence.SCALE} * (sum(n) + {divergence.ADD})::hugeint) // (any_value(l.whole) + {divergence.ADD} * any_value(v)) as q
  from counts c join langs l on c.lang = l.lang join sizes s on s.lang = c.lang group by c.lang, term),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(abs(x.p - y.p)), 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source
  left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term group by all),
above as (
  select s.lang, s.source, 'term' as part, s.term as item, (p - q)::bigint as value
  from shares s join wholes w on s.lang = w.lang and s.term = w.term where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (from pairs union all by name from above))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {divergence.TOP_TERMS}
"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


# CRC-32 by its table, which eight halvings of every byte give; words are hashed once each.
RESAMPLING_SQL = f"""
with recursive halved(i, step, c) as (
  select i, 0, i::bigint from range(256) t(i)
  union all
  select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from halved where step < 8),
tab as (select list(c order by i) as t from halved where step = 8),
texts as (
  select 'd' as side, row_number() over () as r, text from documents
  union all select 't', row_number() over (), text from benchmark),
words as (
  select side, r, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w from texts),
hashed as (
  select w, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(strlen(w)),
      lambda i: (strpos('0123456789ABCDEF', hex(w)[2 * i + 1]) * 16 + strpos('0123456789ABCDEF', hex(w)[2 * i + 2]) - 17)::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {resampling.BUCKETS} as b
  from (select distinct w from words), tab),
counted as (
  select b, count(*) filter (side = 'd') as s, count(*) filter (side = 't') as t from words join hashed using (w) group by b),
wholes as (select sum(s)::double as ss, sum(t)::double as tt from counted),
gains as (
  select b, floor(1000 * ln(((t + 1)::double * (ss + {resampling.BUCKETS})) / ((s + 1)::double * (tt + {resampling.BUCKETS}))))::bigint as g
  from counted, wholes),
sums as (
  select r, count(*) as n, sum(g)::bigint as g from words join hashed using (w) join gains using (b) where side = 'd' group by r),
weighed as (
  select d.doc_id, coalesce(n, 0)::bigint as n_features, coalesce((g - ((g % n) + n) % n) // n, 0)::bigint as weight,
    ('0x' || substr(sha256('{resampling.SEED}:' || coalesce(cast(d.doc_id as varchar), '')), 1, 8))::bigint as h
  from (select row_number() over () as r, doc_id from documents) d left join sums using (r)),
scored as (
  select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score,
    n_features >= {resampling.LEAST_WORDS} as fit from weighed),
ranked as (select *, row_number() over (partition by fit order by score desc, doc_id) as rank from scored)
select doc_id, n_features, weight, score,
  case when fit and rank <= (select count(*) filter (fit) * {resampling.PERCENT} // 100 from scored) then rank end as rank
from ranked
"""


@query("op13_resampling", RESAMPLING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = languages.identify(docs, languages.fit(docs))
    return found.select("doc_id", languages.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "langs", "shares")
