"""Queries of the reports, orders and stage tables, with their SQL; part of the catalogue."""

from __future__ import annotations

from difflib import SequenceMatcher

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions import fixed
from docledger.operators import calibration, crossref, inventory, linkage, reports
from docledger.plans import fixtures as fx
from docledger.plans.catalogue import ORDERS, _pay_records, _payments, components_sql, count, ledger_sql, query
from docledger.plans.fixtures import read
from docledger.sources import files
from docledger.storage import save_bytes, shared_dir

# ---- orders ----------------------------------------------------------------------------------------------------


def _placed(rows: DataFrame, by: str | None, keys: list) -> DataFrame:
    """The rows with their place in the order, within groups that make the check distributed."""
    return rows.withColumn("place", F.rank().over((Window.partitionBy(by) if by else Window.partitionBy(F.lit(1))).orderBy(*keys)).cast("long"))


@query("""with d as (select doc_id, source, nullif(doc_id % 13, 0) as m, source || '/' || doc_id || '.pdf' as path from documents)
  select doc_id as document_id, rank() over (partition by source order by m nulls first, path) as place from d""")
def q_catalog_order(spark, sf_dir):
    """Documents of a source in the catalogue's order."""
    path = F.concat("source", F.lit("/"), F.col("doc_id"), F.lit(".pdf"))
    rows = read(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("document_id"), F.nullif(F.col("doc_id") % 13, F.lit(0)).alias("month_number"), path.alias("relative_path"))
    return _placed(rows, "source", reports.catalog_order()).select("document_id", "place")


@query("""select l_orderkey * 10 + l_linenumber as line, rank() over (partition by l_suppkey order by 'D' || l_partkey, l_quantity, l_returnflag) as place from lineitem""")
def q_export_order(spark, sf_dir):
    """Entities by path, page and type."""
    line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line")
    rows = read(spark, sf_dir, "lineitem").select(line, "l_suppkey", F.concat(F.lit("D"), F.col("l_partkey")).alias("relative_path"), F.col("l_quantity").alias("page_number"), F.col("l_returnflag").alias("entity_type"))
    return _placed(rows, "l_suppkey", reports.export_order("entity_type")).select("line", "place")


@query("""select lang, source, count(*) as documents, rank() over (partition by lang order by count(*) desc, source nulls first) as place from documents group by lang, source""")
def q_count_order(spark, sf_dir):
    """Summaries, the largest first."""
    rows = read(spark, sf_dir, "documents").groupBy("lang", "source").agg(count().alias("documents"))
    return _placed(rows, "lang", reports.count_order("documents", "source"))


@query("""with d as (select user_id, 'F' || event_id as path, event_id % 20 as pages from events)
  select path, rank() over (partition by user_id order by pages desc, path) as place from d""")
def q_job_order(spark, sf_dir):
    """Files of a user in the order in which they are worked on."""
    rows = read(spark, sf_dir, "events").select("user_id", F.concat(F.lit("F"), F.col("event_id")).alias("path"), (F.col("event_id") % 20).alias("pages"))
    return _placed(rows, "user_id", reports.job_order()).select("path", "place")


# ---- linkage with names ------------------------------------------------------------------------------------------

NAMES = ["ANA RUIZ LOPEZ", "ANA RUIZ PEREZ", "COMERCIAL DEL GOLFO", "JOSE HUERTA"]


def named_ledger(spark, sf_dir) -> DataFrame:
    """The ledger with beneficiaries: some equal, some alike, some unlike; transfers have none.  Folders of banks lack a month."""
    k = F.regexp_extract("record_key", r"(\d+)", 1).cast("long")
    pick = lambda i: F.element_at(F.array(*map(F.lit, NAMES)), (i % len(NAMES) + 1).cast("int"))
    kind = F.col("record_type")
    name = F.when(kind == fixed.POLICY, pick(k)).when(kind == fixed.CHEQUE, pick(k + (k % 3 == 1).cast("int"))).when(kind == fixed.BANK, pick(k + 2 * (k % 2)))
    path = F.when(kind == fixed.BANK, F.concat(F.lit("Bancos/"), F.col("document_id"), F.lit(".pdf"))).otherwise(F.col("relative_path"))
    sure = F.when(k % 4 == 0, "media").otherwise("alta")
    return fx.ledger(spark, sf_dir).withColumns({"beneficiary": name, "relative_path": path, "confidence": sure})


def _similarity(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    return max(len(x & y) / len(x | y), SequenceMatcher(None, a, b).ratio())


def named_sql() -> str:
    """The named ledger, its candidates, links, components, bank matches and cases."""
    words = {n: " ".join(w for w in n.split() if w not in fixed.NAME_STOPWORDS) for n in NAMES}
    sims = ", ".join(f"('{a}', '{b}', {_similarity(words[a], words[b])!r})" for a in NAMES for b in NAMES)
    names = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
    pick = lambda i: f"{names}[1 + ({i}) % {len(NAMES)}]"
    close = "(case when gap <= 3 then 15 when gap <= 8 then 10 when gap <= 15 then 5 else 0 end)"
    return f"""sims as (select * from (values {sims}) as t(a, b, sim)),
  l0 as (select *, cast(regexp_extract(record_key, '(\\d+)', 1) as bigint) as k from {ledger_sql()}),
  l as materialized (select record_key, record_type, document_id, page_number, amount, d, folio, evidence, k,
      case record_type when '{fixed.POLICY}' then {pick('k')} when '{fixed.CHEQUE}' then {pick('k + case when k % 3 = 1 then 1 else 0 end')} when '{fixed.BANK}' then {pick('k + 2 * (k % 2)')} end as name,
      case when record_type = '{fixed.BANK}' then 'Bancos' else period end as period, (case when record_type = '{fixed.BANK}' then 'Bancos' else period end) || '/' || document_id || '.pdf' as path,
      case when k % 4 = 0 then 'media' else 'alta' end as confidence from l0),
  pc as (select p.record_key as s, c.record_key as t, abs(p.page_number - c.page_number) as gap, abs(p.d - c.d) as days, p.amount = c.amount as same, coalesce(sim, 0) as sim,
      coalesce(p.evidence = c.folio, false) and abs(p.page_number - c.page_number) <= 15 as hit
    from l p join l c on p.document_id = c.document_id left join sims on a = p.name and b = c.name where p.record_type = '{fixed.POLICY}' and c.record_type = '{fixed.CHEQUE}'),
  ct as (select c.record_key as s, t.record_key as t, abs(c.page_number - t.page_number) as gap, abs(c.d - t.d) as days, c.amount = t.amount as same, coalesce(c.folio = t.folio, false) as hit
    from l c join l t on c.document_id = t.document_id where c.record_type = '{fixed.CHEQUE}' and t.record_type = '{fixed.TRANSFER}'),
  pt as (select p.record_key as s, t.record_key as t, abs(p.page_number - t.page_number) as gap, abs(p.d - t.d) as days
    from l p join l t on p.document_id = t.document_id and p.amount = t.amount where p.record_type = '{fixed.POLICY}' and t.record_type = '{fixed.TRANSFER}'),
  cand as (
    select s, t, 'poliza_cheque' as relation, hit, (case when hit then 70 else 0 end) + (case when same then 25 else 0 end) + (case when sim >= 0.82 then 25 when sim >= 0.62 then 12 else 0 end) + {close}
      + (case when days = 0 then 10 when days <= 3 then 5 else 0 end) as score from pc where (hit and (same or sim >= 0.62 or gap <= 8)) or (same and (gap <= 8 or sim >= 0.62))
    union all select s, t, 'cheque_transferencia', hit, (case when hit then 55 else 0 end) + (case when same then 35 else 0 end) + (case when days = 0 then 20 when days <= 3 then 10 else 0 end)
      + (case when gap <= 3 then 15 when gap <= 8 then 8 else 0 end) from ct where hit or same
    union all select s, t, 'poliza_transferencia', false, 45 + (case when days = 0 then 25 when days <= 3 then 15 else 0 end) + (case when gap <= 8 then 10 else 0 end) from pt),
  rk as (select *, row_number() over lw as rl, lead(score) over lw as nl, row_number() over rw as rr, lead(score) over rw as nr from cand
    window lw as (partition by relation, hit, s order by score desc, s, t), rw as (partition by relation, hit, t order by score desc, s, t)),
  dec as materialized (select s, t, relation, score, rl = 1 and (nl is null or score >= nl + 10) and (hit or (rr = 1 and (nr is null or score >= nr + 10) and score >= 75)) as taken from rk),
  {components_sql()},
  bc as (select c.record_key as s, b.record_key as t, comp.root, least(100, 35 + (case when abs(b.d - c.d) = 0 then 30 when abs(b.d - c.d) <= 3 then 24 else 15 end) + (case when coalesce(sim, 0) >= 0.86 then 35 when coalesce(sim, 0) >= 0.7 then 22 else 0 end)
      + (case when c.record_type = '{fixed.TRANSFER}' then 10 else 0 end)) as score, row(c.document_id, c.page_number, c.record_key) as o, row(b.document_id, b.page_number, b.record_key) as bo
    from l b join l c on b.amount = c.amount and abs(b.d - c.d) <= 7 join comp on comp.node = c.record_key left join sims on sims.a = b.name and sims.b = c.name
    where b.record_type = '{fixed.BANK}' and c.record_type in ('{fixed.CHEQUE}', '{fixed.TRANSFER}')),
  b1 as (select * from (select *, row_number() over (partition by t, root order by score desc, o) as k from bc) where k = 1),
  b2 as (select *, row_number() over w as k2, lead(score) over w as nx from b1 window w as (partition by t order by score desc, o)),
  b3 as (select *, score >= 75 and (nx is null or score >= nx + 10) as able from b2 where k2 = 1),
  alld as materialized (select s, t, relation, score, taken from dec union all select s, t, 'registro_movimiento_bancario', score, able and row_number() over (partition by root, able order by score desc, bo) = 1 from b3),
  e2 as (select s as a, t as b from alld where taken union select t, s from alld where taken),
  w2 as (select record_key as node, record_key as root from l union select e.b, w.root from w2 w join e2 e on e.a = w.node),
  fin as materialized (select node, min(root) as root from w2 group by node),
  m as materialized (select l.*, fin.root, row(l.document_id, l.page_number, l.record_key) as o from l join fin on fin.node = l.record_key),
  links as (select substr(sha256(s || '|' || t || '|' || relation), 1, 24) as link_id, s, t, relation, least(score, 100) as score, case when taken then 'aceptado' else 'sugerido' end as status from alld where score >= 55),
  sug as (select k, count(*) as n from (select s as k from links where status = 'sugerido' union all select t from links where status = 'sugerido') group by 1),
  acc as (select fin.root, count(*) as n from links join fin on fin.node = s where status = 'aceptado' group by 1),
  vals as (select root, 'amount' as what, record_type, cast(amount as varchar) as v, o from m where amount is not null union all select root, 'day', record_type, cast(d as varchar), o from m
    union all select root, 'name', record_type, name, o from m where name is not null),
  best as (select root, what, v from (select root, what, v, row_number() over (partition by root, what order by turn, n desc, o) as k from
      (select root, what, v, record_type, count(*) as n, min(o) as o, list_position(case what when 'name' then {_list(fixed.NAME_ORDER)} else {_list(fixed.VALUE_ORDER)} end, record_type) as turn from vals group by root, what, v, record_type)
      where turn is not null) where k = 1),
  cases as materialized (select m.root, 'TR-' || upper(substr(sha256(string_agg(record_key, '|' order by record_key)), 1, 16)) as case_id, 'pago' as case_type, list(distinct record_type) as types, arg_min(period, o) as period,
      count(*) as record_count, count(distinct document_id) as document_count, coalesce(sum(sug.n), 0) as suggested, count(distinct amount) <= 1 as amount_consistent from m left join sug on sug.k = record_key group by m.root),
  told as materialized (select c.*, coalesce(acc.n, 0) as accepted, a.v as amount, d.v as day, n.v as name, len(types) > 1 as several, list_contains(types, '{fixed.BANK}') as banked,
      case when len(types) > 1 and list_contains(types, '{fixed.BANK}') then 'conciliado_banco' when len(types) > 1 then 'trazabilidad_documental' else 'sin_conciliar' end as status
    from cases c left join acc using (root) left join best a on a.root = c.root and a.what = 'amount' left join best d on d.root = c.root and d.what = 'day' left join best n on n.root = c.root and n.what = 'name')"""


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_LINK = "link_id, a.record_type as source_type, a.path as source_path, a.page_number as source_page, a.amount as source_amount, b.record_type as target_type, b.path as target_path, b.page_number as target_page, b.amount as target_amount"
_ENDS = "links join l a on a.record_key = s join l b on b.record_key = t"


def _traced(spark, sf_dir):
    rows = named_ledger(spark, sf_dir)
    found, links, inside = linkage.reconcile(rows)
    return rows, found, links, inside


@query(f"""with recursive {named_sql()}
  select case_id, status, case when accepted > 0 then 'alta' else 'media' end as confidence, period, cast(day as date) as operation_date, cast(amount as decimal(18,2)) as amount, name as beneficiary,
    array_to_string(list_filter({_list(fixed.STAGES)}, lambda x: list_contains(types, x)), '|') as stages,
    array_to_string(list_filter([case when not list_contains(types, '{fixed.POLICY}') then '{fixed.POLICY}' end, case when not list_contains(types, '{fixed.CHEQUE}') and not list_contains(types, '{fixed.TRANSFER}') then 'medio_pago' end,
      case when not banked then '{fixed.BANK}' end], lambda x: x is not null), '|') as missing_stages,
    cast(record_count as integer) as record_count, cast(document_count as integer) as document_count, cast(accepted as integer) as accepted_links, cast(suggested as integer) as suggested_links, amount_consistent from told""")
def q_named_cases(spark, sf_dir):
    """Cases of a ledger with names, by the whole similarity of names: stages, values and period."""
    found = _traced(spark, sf_dir)[1]
    joined = {c: F.array_join(c, "|") for c in ("stages", "missing_stages")}
    return found.withColumns(joined).drop("case_type")


@query(f"with recursive {named_sql()} select {_LINK}, relation, cast(score as integer) as score, status from {_ENDS}")
def q_link_pairs(spark, sf_dir):
    """Links with both records, names counted."""
    rows, _, links, _ = _traced(spark, sf_dir)
    return reports.link_pairs(links, rows).drop("source_key", "target_key", "confidence", "reasons")


@query(f"with recursive {named_sql()} select {_LINK}, relation, cast(score as integer) as score from {_ENDS} where status = 'sugerido'")
def q_suggested_links(spark, sf_dir):
    rows, _, links, _ = _traced(spark, sf_dir)
    return reports.suggested(reports.link_pairs(links, rows)).drop("source_key", "target_key", "confidence", "reasons", "status")


@query(f"with recursive {named_sql()} select case_id, period, cast(amount as decimal(18,2)) as amount, rank() over (partition by period order by cast(day as date), case_id) as place from told where status = 'sin_conciliar'")
def q_pending_cases(spark, sf_dir):
    """Payments without a match, in the cases' order."""
    rows = reports.pending_cases(_traced(spark, sf_dir)[1])
    return _placed(rows, "period", reports.case_order()).select("case_id", "period", "amount", "place")


@query(f"""with recursive {named_sql()}, t as (select period, count(*) as cases, count_if(record_count > 1) as traced, count_if(status = 'conciliado_banco') as reconciled, cast(coalesce(sum(cast(amount as decimal(18,2))), 0) as decimal(28,2)) as candidate_amount from told group by period)
  select *, rank() over (order by coalesce(try_cast(regexp_extract(period, '^(\\d+)', 1) as integer), 99), period) as place from t""")
def q_monthly_cases(spark, sf_dir):
    """Payments by month folder; folders without a number come last."""
    return _placed(reports.monthly_cases(_traced(spark, sf_dir)[1]), None, reports.month_order("period"))


@query(f"""with recursive {named_sql()} select (select count(*) from l) as source_records, count(*) as cases, count(*) as payment_cases, cast(0 as bigint) as payroll_cases, count_if(record_count > 1) as linked_cases, count_if(status = 'conciliado_banco') as bank_reconciled,
    count_if(status = 'trazabilidad_documental') as document_traces, count_if(status = 'sin_conciliar') as unreconciled_payments, (select count(*) from links where status = 'aceptado') as accepted_links, (select count(*) from links where status = 'sugerido') as suggested_links from told""")
def q_case_summary(spark, sf_dir):
    rows, found, links, _ = _traced(spark, sf_dir)
    return reports.case_summary(rows, found, links)


@query(f"""with recursive {named_sql()}, s as (select root, record_type, list_sort(list(distinct amount)) as amounts, list_position({_list(fixed.STAGES)}, record_type) as turn from m group by root, record_type),
  st as (select root, string_agg(record_type || '=' || array_to_string(amounts, ','), '|' order by turn) as amounts from s group by root), mm as (select root, string_agg(record_key, '|' order by path, page_number, record_type, record_key) as members from m group by root)
  select case_id, st.amounts, mm.members from told join st using (root) join mm using (root)""")
def q_case_members(spark, sf_dir):
    """The records of each case in order, and its amounts by stage."""
    rows, _, _, inside = _traced(spark, sf_dir)
    members = reports.case_members(rows, inside).select("case_id", F.array_join(F.transform("members", lambda r: r["record_key"]), "|").alias("members"))
    told = F.transform("stages", lambda s: F.concat(s["record_type"], F.lit("="), F.array_join(F.transform(s["amounts"], lambda a: a.cast("string")), ",")))
    return reports.amounts_by_stage(rows, inside).select("case_id", F.array_join(told, "|").alias("amounts")).join(members, "case_id")


@query(f"""with recursive {named_sql()}, t as (select period as folder, record_type, count(*) as records, count_if(confidence = 'alta') as high, count_if(confidence <> 'alta') as review, count(amount) as with_amount, cast(coalesce(sum(amount), 0) as decimal(28,2)) as candidate_amount from l group by 1, 2)
  select *, rank() over (partition by record_type order by coalesce(try_cast(regexp_extract(folder, '^(\\d+)', 1) as integer), 99), folder) as place from t""")
def q_monthly_records(spark, sf_dir):
    """Records by month folder and type, in the folders' order."""
    return _placed(reports.monthly_records(named_ledger(spark, sf_dir)), "record_type", reports.month_order("folder"))


@query(f"with recursive {named_sql()} select record_key, confidence from l where confidence <> 'alta'")
def q_for_review(spark, sf_dir):
    return reports.for_review(named_ledger(spark, sf_dir)).select("record_key", "confidence")


@query(f"""with recursive {named_sql()} select 'cases' as name, count(*) as n from told union all select 'links', count(*) from links union all select 'records', count(*) from l union all select 'case_records', count(*) from fin union all select 'totals', 3""")
def q_stage_tables(spark, sf_dir):
    """The tables of a stage, checked, written and read back; and settings upserted."""
    rows, found, links, inside = _traced(spark, sf_dir)
    folder = f"{shared_dir(spark)}/docledger/stage"
    tables = {"records": rows.drop("extra"), "cases": found, "links": links, "case_records": inside}
    paths: dict[str, str] = {}

    def save(name: str, table: DataFrame) -> None:
        import uuid

        paths[name] = f"{folder}-{uuid.uuid4().hex}/{name}"
        table.write.parquet(paths[name])

    reports.save_stage(tables, reports.TRACE_REFERENCES, save)
    told = reports.metadata({"rows": F.col("cases"), "linked": F.col("linked_cases")}, reports.case_summary(rows, found, links))
    old = spark.createDataFrame([("rows", "0"), ("source", "x")], "key string, value string")
    settings = inventory.replaced(old, told, ["key"])
    parts = [spark.read.parquet(p).agg(count().alias("n")).select(F.lit(k).alias("name"), "n") for k, p in paths.items()]
    parts.append(settings.agg(F.countDistinct("key").alias("n")).select(F.lit("totals").alias("name"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


# ---- catalogue and states ------------------------------------------------------------------------------------------


@query("""with d as (select n_chars as pages, ['completed', 'already_completed', 'failed'][1 + doc_id % 3] as status, lang as primary_type, case when doc_id % 7 = 0 then 'baja' else 'alta' end as confidence, case when doc_id % 11 = 0 then 'x' else '' end as warning from documents)
  select count(*) as documents, cast(coalesce(sum(pages), 0) as bigint) as pages, count_if(status <> 'failed') as completed, count_if(confidence = 'baja') as to_review, count_if(warning <> '') as warnings,
    (select string_agg(primary_type || '=' || n, '|' order by primary_type) from (select primary_type, count(*) as n from d where primary_type is not null group by 1)) as by_type from d""")
def q_catalog_summary(spark, sf_dir):
    i = F.col("doc_id")
    rows = read(spark, sf_dir, "documents").select(F.col("n_chars").alias("pages"), F.element_at(F.array(*map(F.lit, ("completed", "already_completed", "failed"))), (1 + i % 3).cast("int")).alias("status"), F.col("lang").alias("primary_type"), F.when(i % 7 == 0, "baja").otherwise("alta").alias("confidence"), F.when(i % 11 == 0, "x").otherwise("").alias("warning"))
    told = F.array_join(F.transform(F.array_sort(F.map_entries("by_type")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|")
    return reports.catalog_summary(rows).withColumn("by_type", told)


@query("select conv_id as document_id, turn as page_number from conversations where conv_id % 4 <> 1")
def q_cached_pages(spark, sf_dir):
    """Stored pages of documents whose result is unchanged."""
    pages = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("page_number"), "text")
    docs = pages.select("document_id").distinct().withColumn("hash", F.sha2(F.col("document_id").cast("string"), 256))
    known = docs.withColumn("hash", F.when(F.col("document_id") % 4 == 1, "old").otherwise(F.col("hash")))
    return reports.cached_pages(docs, known, pages).select("document_id", "page_number")


@query("""select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id // 7 desc, event_type desc, event_id desc) as k from events) where k = 1""")
def q_latest(spark, sf_dir):
    """The latest row of each key; equally late ones by their other columns."""
    rows = read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", F.floor(F.col("event_id") / 7).alias("turn"))
    return inventory.latest(rows, ["user_id"], "turn").select("user_id", "event_id", "event_type")


@query("""with e as (select event_id as k, 'F' || event_id as path, event_id % 3 <> 0 as same, event_id % 5 <> 0 as known, event_id % 4 = 0 as working from events)
  select path, case when known and same and not working then 'completed' else 'pending' end as status, known and not same as changed, case when known then 'R' || k end as result_path from e""")
def q_inventory(spark, sf_dir):
    """Files with their earlier state; results are carried on."""
    k = F.col("event_id")
    files = read(spark, sf_dir, "events").select(k, F.concat(F.lit("F"), k).alias("path"), F.lit(1).alias("size"), F.sha2(k.cast("string"), 256).alias("hash"))
    state = files.where(k % 5 != 0).select("path", F.when(k % 3 != 0, F.col("hash")).otherwise("old").alias("hash"), F.when(k % 4 == 0, "processing").otherwise("completed").alias("status"), F.concat(F.lit("R"), k).alias("result_path"))
    return inventory.inventory(files, state).select("path", "status", "changed", "result_path")


@query("""with e as (select event_id as k, case event_type when 'click' then 'completed' when 'view' then 'already_completed' when 'purchase' then 'failed' when 'signup' then 'encrypted' else 'pending' end as status from events),
  r as (select *, k % 6 <> 0 and k % 7 <> 0 and k % 8 <> 0 and k % 9 <> 0 as reusable from e)
  select k, reusable, case when status in ('completed', 'already_completed') and reusable then 'already_completed' when status in ('failed', 'encrypted') then 'keep_error' else 'run' end as action,
    case when k % 2 = 0 then 'skip' when status in ('completed', 'already_completed') and reusable then 'already_completed' else 'run' end as only_failed from r""")
def q_take_up(spark, sf_dir):
    """What a batch takes up: results that are whole are reused."""
    k = F.col("k")
    rows = fx.states(spark, sf_dir).select(F.col("event_id").alias("k"), "status", "pages").withColumns({"result_path": F.concat(F.lit("R"), k), "text_path": F.concat(F.lit("T"), k), "result_hash": F.sha2(k.cast("string"), 256), "text_hash": F.sha2(k.cast("string"), 256), "previous": F.when(k % 2 == 1, "failed")})
    results = rows.where(k % 6 != 0).select(F.col("result_path").alias("path"), F.when(k % 7 == 0, "x").otherwise(F.col("result_hash")).alias("hash"), F.when(k % 8 == 0, F.col("pages") + 1).otherwise(F.col("pages")).alias("pages"))
    texts = rows.where(k % 9 != 0).select(F.col("text_path").alias("path"), F.col("text_hash").alias("hash"), F.lit(None).cast("long").alias("pages"))
    told = inventory.reusable(rows, results.unionAll(texts))
    other = inventory.take_up(told, only_failed=True).select("k", F.col("action").alias("only_failed"))
    return inventory.take_up(told).select("k", "reusable", "action").join(other, "k")


@query("""select * from (values (1, 'RECIBO uno'), (2, ''), (3, 'año ' || chr(10) || 'tres')) as t(page_number, text)""")
def q_page_source(spark, sf_dir):
    """The pages of a document file, written and read back."""
    path = save_bytes(spark, "RECIBO uno\f\faño \ntres\f\n".encode(), "D1.TXT")
    return files.read_pages(spark, path).select("page_number", "text")


# ---- audits ----------------------------------------------------------------------------------------------------------


@query(f"""select k as field_id, case when k % 23 = 0 then 'pagina_desconocida' when c % 10 = 0 then 'documento_desconocido' when c % 10 = 1 then 'documento_cambiado' when k % 3 = 0 and k % 5 = 0 then 'sin_evidencia_textual'
    when k % 3 <> 0 and k % 7 = 0 then 'sin_fragmento' end as problem from {ORDERS}""")
def q_field_audit(spark, sf_dir):
    """Fields against the pages and documents that they were read from."""
    o, k, c = fx.orders(spark, sf_dir).select("k", "c"), F.col("k"), F.col("c")
    page = F.concat(F.lit("p"), k)
    fields_ = o.select(k.alias("field_id"), page.alias("page_id"), F.lit("importe").alias("kind"), F.concat(F.lit("Valor  "), k).alias("expected"), F.concat(F.lit("VALOR "), k).alias("observed"), (k % 3 == 0).alias("exact"))
    pages = o.where(k % 23 != 0).select(page.alias("page_id"), F.concat(F.lit("d"), c).alias("path"), F.lit(1).alias("page"))
    docs = o.where(c % 10 != 0).select("c").distinct().select(F.concat(F.lit("d"), c).alias("path"), F.lit("h").alias("hash"), F.when(c % 10 == 1, "g").otherwise("h").alias("hash_now"))
    broken_ = F.when(k % 3 == 0, k % 5 == 0).otherwise(k % 7 == 0)
    texts = o.select(page.alias("page_id"), F.when(broken_, F.concat(F.lit("x VALOR "), k, F.lit("9 y"))).otherwise(F.concat(F.lit("x VALOR "), k, F.lit(", y"))).alias("text"))
    texts = texts.withColumn("text", F.when(F.col("text").endswith("9 y"), "x nada y").otherwise(F.col("text")))
    return reports.field_audit(fields_, pages, docs, texts).select("field_id", "problem")


@query("""with p as (select unnest([1, 2, 3, 4]) as n), r as (select 'ABCD'[n] as profile, p.n from p), q as (select c_custkey as i from customer),
  t as (select profile, i, n, case when (i + n) % 5 = 0 then null else (i + n) % 3 <> 0 end as consistent from r, q)
  select profile, count_if(consistent) as consistent, count_if(not consistent) as inconsistent, count_if(consistent is null) as unreadable, 2 * count_if(not consistent) as marked from t group by profile""")
def q_total_control(spark, sf_dir):
    """Totals against their parts, in four profiles and for every customer's page."""
    i, n = F.col("c_custkey"), F.col("n")
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))).alias("n"))
    rows = rows.withColumn("profile", F.concat(F.substring(F.lit("ABCD"), n, F.lit(1)), F.lit("-"), i))  # a page of its own in each profile
    part = F.when((i + n) % 5 == 0, "l0.00").otherwise("10.00")
    total = F.when((i + n) % 3 == 0, "31.00").otherwise("30.00")
    field = lambda f, raw: rows.select("profile", F.lit(f).alias("field_id"), raw.alias("raw"), F.array().cast("array<string>").alias("validators"), F.lit(False).alias("requires_review"))
    few = spark.createDataFrame([(28, 27)], "total_field int, first_field int")
    second = rows.select("profile", F.lit(28).alias("total_field"), F.lit("$ 20.00").alias("value"))
    controls, marked = calibration.total_control(field(27, part).unionAll(field(28, total)), few, second)
    name = F.left("profile", F.lit(1)).alias("profile")
    seen = controls.groupBy(name).agg(F.count_if("consistent").alias("consistent"), F.count_if(~F.col("consistent")).alias("inconsistent"), F.count_if(F.col("consistent").isNull()).alias("unreadable"))
    return seen.join(marked.groupBy(name).agg(F.count_if("requires_review").alias("marked")), "profile")


@query(f"""select k as field_id, case when k % 3 = 0 then 'page' when k % 3 = 1 then 'crop' when amount > 200000 then 'page' else 'crop' end as source from {ORDERS}""")
def q_chosen_reading(spark, sf_dir):
    """Of two readings of a field, the better scored one; equal scores: the crop's."""
    rows = fx.orders(spark, sf_dir).select(F.col("k").alias("field_id"), (F.col("k") % 3).alias("m"), F.col("amount").cast("double").alias("a"))
    page = rows.where("m <> 1").select("field_id", F.lit("p").alias("raw"), F.col("a").alias("score"))
    crop = rows.where("m <> 0").select("field_id", F.lit("c").alias("raw"), F.lit(200000.0).alias("score"))
    return calibration.chosen_reading(page, crop).select("field_id", "source")


# ---- payments --------------------------------------------------------------------------------------------------------

#: excel_row, account, amount, status of the amount, outcome, proof and whether the proof shows the amount.
_SHEET = [
    (1, "A1", "100.00", "numerico", "vinculado", "100.00", False),
    (2, "A1", "100.00", "numerico", "vinculado", "100.00", False),
    (3, "A2", "50.00", "recuperado_separadores", "ambiguo", "70.00", False),
    (4, "A3", "80.00", "numerico", "vinculado", "90.00", False),
    (5, "A4", "80.00", "numerico", "vinculado", "95.00", True),
    (6, "A5", None, "invalido", "sin_coincidencia", None, False),
    (7, "A6", "10.00", "numerico", "ambiguo", "10.00", False),
    (8, "a6", "10.00", "numerico", "ambiguo", "10.00", False),
    (9, "A7", "5.00", "numerico", "vinculado", "5.005", False),
]


def _sheet(spark):
    rows = spark.createDataFrame(_SHEET, "excel_row int, account string, amount string, amount_status string, match_status string, paid string, amount_in_paid_evidence boolean")
    money = lambda c: F.col(c).cast("decimal(18,2)")
    rows = rows.withColumns({"amount": money("amount"), "paid_amount": money("paid"), "month": F.lit("ENE"), "concept": F.lit("Obra"), "matched_path": F.concat(F.lit("p"), F.col("excel_row")), "paid_page": F.col("excel_row")})
    return rows.withColumn("paid_difference", (F.col("paid_amount") - F.col("amount")).cast("decimal(18,2)"))


@query("""select * from (values ('importe_como_texto', '3', cast(50 as decimal(18,2)), 'alta', true, 'p3'), ('duplicado_probable', '1|2', cast(-100 as decimal(18,2)), 'alta', true, 'p1'), ('duplicado_probable', '7|8', cast(-10 as decimal(18,2)), 'media', true, 'p7'),
    ('diferencia_con_pago_documentado', '4', cast(10 as decimal(18,2)), 'media', false, 'p4, página 4'), ('diferencia_con_pago_documentado', '9', cast(0.01 as decimal(18,2)), 'media', false, 'p9, página 9')) as t(kind, rows, adjustment, confidence, counts, evidence)""")
def q_findings_kinds(spark, sf_dir):
    """All kinds of findings of a small sheet, against the rows worked out by hand."""
    rows = _sheet(spark)
    found = crossref.findings(rows, rows)
    return found.select("kind", F.array_join(F.transform("excel_rows", lambda r: r.cast("string")), "|").alias("rows"), "adjustment", "confidence", F.col("affects_confirmed_total").alias("counts"), "evidence")


@query("""select 9 as rows, cast(435 as decimal(28,2)) as sum_of_rows, cast(-60 as decimal(28,2)) as confirmed_adjustment, cast(435 as decimal(28,2)) as worksheet_total, cast(375 as decimal(28,2)) as adjusted_total, cast(625 as decimal(28,2)) as gap,
  5 as linked_rows, 3 as ambiguous_rows, 1 as unmatched_rows, 3 as confirmed_findings, 2 as review_findings""")
def q_payment_summary(spark, sf_dir):
    rows = _sheet(spark)
    found = crossref.findings(rows, rows)
    return reports.payment_summary(crossref.control_totals(rows, found, stated_total=0, target=1000), rows, found)
