"""The queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.llm import ann, chat, jaccard, lm, mixing, packing, quality, rules, toxicity, urls

#: (verdict, host/path) of the url filter.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # The labels only say yes or no: grade 2 is a toxic document that is marked as of bad quality too.
    return toxicity.score_severity(docs, toxicity.severity_model(docs, read(spark, sf_dir, "labels"), graver_col="quality"))


def op2_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm.score_corpus(read(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})  # sums in any order round alike


def op3_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op4_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(read(spark, sf_dir, "documents"))


def op5_quadratic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.quality_model(docs, read(spark, sf_dir, "labels")))


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge_rules(read(spark, sf_dir, "documents"))


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed_copies(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionAll(more)
    out = chat.format_conversations(turns).withColumns({"turns": chat.parse(F.col("formatted")), "loss": chat.learned(F.col("segments"))})
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity_severity, op2_backoff_automaton, op3_swap_packing, op4_lsh_forest_join, op5_quadratic_quality, op6_weak_supervision, op7_url_cascade, op8_source_mix, op9_posting_lists, op10_chat_format, pipeline)
}

#: crc32 of the id as text, bit by bit.
_CRC32 = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)))"""

OP2_SQL = f"""
with d as (
  select row_number() over () as r, doc_id, {_CRC32} % 7 = 2 as held_out,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') || [' '] as ws
  from documents),
u as (select r, doc_id, held_out, unnest(ws) as w, generate_subscripts(ws, 1) as k from d),
t as (select *, coalesce(lag(w) over o, ' ') as a, case when k > 1 then coalesce(lag(w, 2) over o, ' ') end as z from u window o as (partition by r order by k)),
one as (select w, count(*) as c from t where not held_out group by w),
two as (select a, w, count(*) as c from t where not held_out group by a, w),
three as (select z, a, w, count(*) as c from t where not held_out and z is not null group by z, a, w),
n as (select cast(coalesce(sum(c), 0) as bigint) as n, count(*) as v from one),
p as (
  select t.r, t.doc_id, t.held_out, coalesce(one.c, 0) as c1, n.n, (coalesce(one.c, 0) + 1.0::double) / (n.n + n.v + 1) as p1,
    coalesce(ca.c, 0) as ca, coalesce(two.c, 0) as c2, coalesce(cz.c, 0) as cz, coalesce(three.c, 0) as c3
  from t cross join n left join one on one.w = t.w left join one ca on ca.w = t.a left join two on two.a = t.a and two.w = t.w
    left join two cz on cz.a = t.z and cz.w = t.a left join three on three.z = t.z and three.a = t.a and three.w = t.w),
q as (select *, case when ca > 0 then (c2 + 2000 * p1) / (ca + 2000) else p1 end as p2 from p)
select doc_id, held_out, count(*) as n_tokens, count(*) filter (c1 > 0) as n_known, any_value(n) as train_tokens,
  round(sum(log10(p1)), 6) as base_score, round(sum(log10(case when cz > 0 then (c3 + 10 * p2) / (cz + 10) else p2 end)), 6) as score
from q group by r, doc_id, held_out
"""

OP4_SQL = """
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws
  from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where c + 1e-9 >= 0.8 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select a as node, a as root from e union select e.b, r.root from r join e on e.a = r.node),
m as (select node, min(root) as root from r group by node)
select d.doc_id, coalesce(m.root, d.doc_id) as class_id, (select count(*) from e where e.a = d.doc_id) as n_links
from documents d left join m on m.node = d.doc_id
"""

OP7_SQL = """
with u as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
r as (select * from (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) as t(verdict, h, p)),
f as (
  select u.page_id, r.h || r.p as rule, r.verdict, row_number() over (partition by u.page_id order by length(r.h || r.p) desc) as k
  from u join r on (u.host = r.h or suffix(u.host, '.' || r.h)) and starts_with(u.path, r.p))
select u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from u left join f on f.page_id = u.page_id and f.k = 1
"""


def _op8_sql(weights=(1, 2, 3), cap=3, seed=0) -> str:
    draw = f"(cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '#{seed}'), 1, 8) as bigint) / 4294967296.0)"
    return f"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size, [{', '.join(map(str, weights))}][1 + (row_number() over (order by source nulls last) - 1) % {len(weights)}] as w from d group by source),
c as (select *, {cap}.0 * source_size / w as top, sum(source_size) over () as total from s),
o as (select *, coalesce(sum({cap}.0 * source_size) over (order by top, source rows between unbounded preceding and 1 preceding), 0) as held,
        sum(w) over (order by top, source rows between current row and unbounded following) as free,
        row_number() over (order by top, source) as place from c),
l as (select coalesce(arg_min((total - held) / free, place), 1e300) as level from o where (total - held) / free <= top),
t as (select source, source_size, least(w * (select level from l), {cap}.0 * source_size) as target from s),
x as (select source, source_size, target, case when source_size > 0 then least(target / source_size, {cap}.0) else 0 end as rate from t)
select d.doc_id, d.size, x.source_size, round(x.target, 4) as target,
  cast(d.size * (floor(x.rate) + case when {draw} < x.rate - floor(x.rate) then 1 else 0 end) as bigint) as taken
from d join x on d.source is not distinct from x.source
"""


OP10_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
b as (select *, case when role = lag(role) over (partition by conv_id order by turn, role, text) then 0 else 1 end as fresh,
  regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|<SYS>>|</SYS>>|\|[a-z_]+\|>)', '\1\\\2\3', 'g') as safe from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
  sum(length(safe) + case when fresh = 1 then length('<|im_start|>') + length(url_encode(role)) + 1 + length('<|im_end|>') + 1 else length('<|im_sep|>') end)::bigint as formatted_chars
from b group by conv_id
"""

ORACLES: dict[str, str] = {
    "op2_backoff_automaton": OP2_SQL,
    "op4_lsh_forest_join": OP4_SQL,
    "op7_url_cascade": OP7_SQL,
    "op8_source_mix": _op8_sql(),
    "op10_chat_format": OP10_SQL,
}
