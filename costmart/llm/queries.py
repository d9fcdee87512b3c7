"""Registered queries: each operator over its whole table, with production
parameters, reduced to the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, line_dedup, maxent, minmax, ngram_join, orchard, pii, quality, repair, secret_scan, sharding, tiling, toxicity
from .common import fold, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.histogram_sort(table(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary())


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), toxicity.scorer(spark, model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op6_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = tiling.contamination(docs, table(spark, sf_dir, "benchmark"))
    small = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    joined = small.join(found, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")), "left")
    return joined.select("doc_id", F.col("c_key").isNotNull().alias("contaminated"), F.coalesce("max_coverage", F.lit(0.0)).alias("coverage"),
                         F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.mark(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("rewritten", F.col("row").getField("text"), F.lit(""))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(text, 256).alias("text_sha256"))


ORACLE_SQL["op10_line_dedup"] = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents),
solid as (
  select doc_id, i, line, row_number() over (partition by doc_id order by i) as j
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
windows as (
  select doc_id, j, i1, i2, i3, row_number() over (partition by l1, l2, l3 order by doc_id, j) as seen
  from (select doc_id, j, line as l1, i as i1,
               lead(line) over w as l2, lead(i) over w as i2, lead(line, 2) over w as l3, lead(i, 2) over w as i3
        from solid window w as (partition by doc_id order by j))
  where l3 is not null),
gone as (
  select distinct doc_id, unnest([i1, i2, i3]) as i from windows where seen > 1),
counts as (select doc_id, count(*) as n_removed from gone group by doc_id),
sizes as (select doc_id, count(*) as n_lines from solid group by doc_id),
rest as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.i) as text
  from lines l left join gone g on l.doc_id = g.doc_id and l.i = g.i where g.i is null group by l.doc_id)
select d.doc_id, coalesce(s.n_lines, 0) as n_lines, coalesce(c.n_removed, 0) as n_removed,
       sha256(coalesce(r.text, '')) as text_sha256
from documents d left join sizes s on d.doc_id = s.doc_id left join counts c on d.doc_id = c.doc_id
left join rest r on d.doc_id = r.doc_id
"""


@query
def op8_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


def _linked_sql(words: int, columns: str) -> str:
    """Documents linked by shingles of so many words, by all pairs and reachability."""
    shingle = " || chr(10) || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(words))
    return f"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) < {words} then [array_to_string(w, chr(10))]
         else list_transform(range(1, len(w) - {words - 2}), lambda i: {shingle}) end) as s
  from texts where len(w) > 0),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (
  select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach as (
  select doc_id as node, doc_id as root from documents
  union
  select l.y, r.root from reach r join both_ways l on r.node = l.x)
select {columns}
from documents d left join sizes s on s.doc_id = d.doc_id
join (select node, min(root) as component_id from reach group by node) c on c.node = d.doc_id
"""


ORACLE_SQL["op6_minmax_dedup"] = _linked_sql(2, "d.doc_id, coalesce(s.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept")


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2).drop("label")


def _vector_codes_sql() -> str:
    """The codebooks of each round, and every part's nearest entry, over (row, part, place in the part, component)."""
    def nearest(name: str, books: str) -> str:
        return f"""
{name} as (
  select r, p, arg_min(e, d * 1000 + e) as e, min(d) as d
  from (select x.r, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) as d from x join {books} b on b.p = x.p and b.j = x.j group by x.r, x.p, b.e)
  group by r, p)"""

    def means(name: str, books: str, near: str) -> str:
        return f"""
{name} as (
  select b.p, b.e, b.j, coalesce(m.v, b.v) as v
  from {books} b left join (
    select n.p, n.e, x.j, cast(floor(cast(sum(x.v) as double) / count(*)) as bigint) as v
    from {near} n join x on x.r = n.r and x.p = n.p group by n.p, n.e, x.j) m on m.p = b.p and m.e = b.e and m.j = b.j)"""

    return f"""
with kept as (
  select vec_id, label, embedding as v, row_number() over (order by vec_id) as r from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
x as (
  select r, cast(floor((i - 1) / (n / 16)) as bigint) as p, cast((i - 1) % (n / 16) as bigint) as j, cast(floor(256 * cast(c as double)) as bigint) as v
  from (select r, len(v) as n, unnest(v) as c, generate_subscripts(v, 1) as i from kept)),
b0 as (select p, r - 1 as e, j, v from x where r <= 64),
{nearest("n0", "b0")}, {means("b1", "b0", "n0")}, {nearest("n1", "b1")}, {means("b2", "b1", "n1")}, {nearest("n2", "b2")},
codes as (select r, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error from n2 group by r),
rows as (select k.vec_id, k.label, c.code, c.error from kept k join codes c on c.r = k.r),
labels as (select label, cast(sum(error) as bigint) as label_error from rows group by label),
books as (select sha256(string_agg(cast(v as varchar), ',' order by p, e, j)) as codebooks_sha256 from b2)
select rows.vec_id, rows.code, rows.error, labels.label_error, books.codebooks_sha256
from rows join labels on rows.label is not distinct from labels.label, books
"""


ORACLE_SQL["op11_vector_codes"] = _vector_codes_sql()


@query
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_groups(table(spark, sf_dir, "documents"), words=5, percent=80)


ORACLE_SQL["op12_ngram_join"] = _linked_sql(5, "d.doc_id, coalesce(s.n, 0) as n_shingles, c.component_id")


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digest(repair.damage(table(spark, sf_dir, "conversations")))
