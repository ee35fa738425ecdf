"""The named queries over the driver's tables, and the SQL they are held against.

Each entry is a function of (spark, sf_dir) and, where SQL can express it, an independent SQL text over the same
tables.  Sums of money are decimals; counts are long; arrays are joined to text where engines differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.functions import fields, fixed
from docledger.functions import text as x
from docledger.operators import calibration, catalog, crossref, extract, inventory, linkage, merge, search
from docledger.operators.components import components
from docledger.plans import fixtures as fx
from docledger.plans.fixtures import read
from docledger.storage import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _bigint(sql: str) -> str:
    """count_if(...) as bigint; its own type is wider."""
    start = sql.find("count_if(")
    if start < 0:
        return sql
    end, depth = start + len("count_if("), 1
    while depth:
        depth += {"(": 1, ")": -1}.get(sql[end], 0)
        end += 1
    return sql[:start] + "cast(" + sql[start:end].replace("count_if", "countif", 1) + " as bigint)" + _bigint(sql[end:])


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = _bigint(sql)
        return f

    return add


count = lambda: F.count(F.lit(1))

ORDERS = """(select o_orderkey as k, o_custkey as c, cast(o_totalprice as decimal(18,2)) as amount,
  cast(cast(o_orderdate as date) + interval 240 month as date) as d, o_orderstatus as status, o_orderpriority as priority from orders)"""


# ---- summaries -----------------------------------------------------------------------------------------------


@query(f"""select status as record_type, count(*) as records, count(distinct c) as documents, count_if(amount > 200000) as high, count_if(amount <= 200000) as review,
  cast(sum(case when k % 10 <> 0 then amount end) as decimal(28,2)) as candidate_amount, count_if(k % 10 <> 0) as with_amount from {ORDERS} group by 1""")
def q_record_summary(spark, sf_dir):
    """Records by type: confidence, documents, amounts."""
    amount = F.when(F.col("k") % 10 != 0, F.col("amount"))
    return fx.orders(spark, sf_dir).groupBy(F.col("status").alias("record_type")).agg(count().alias("records"), F.countDistinct("c").alias("documents"), F.count_if(F.col("amount") > 200000).alias("high"), F.count_if(F.col("amount") <= 200000).alias("review"), F.sum(amount).cast("decimal(28,2)").alias("candidate_amount"), F.count(amount).alias("with_amount"))


@query(f"select cast(month(d) as integer) as month_number, status as record_type, count(*) as records, cast(sum(amount) as decimal(28,2)) as candidate_amount from {ORDERS} group by 1, 2")
def q_month_type_totals(spark, sf_dir):
    """Records and candidate amounts by month and record type."""
    return fx.orders(spark, sf_dir).groupBy(F.month("day").alias("month_number"), F.col("status").alias("record_type")).agg(count().alias("records"), F.sum("amount").cast("decimal(28,2)").alias("candidate_amount"))


@query("select lang as entity_type, count(*) as entities, count(distinct source) as documents from documents group by 1")
def q_entity_summary(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(F.col("lang").alias("entity_type")).agg(count().alias("entities"), F.countDistinct("source").alias("documents"))


@query("""select l_partkey as part, l_suppkey as supplier, count(*) as occurrences, count(distinct l_orderkey) as documents, min(l_orderkey) as first_document
  from lineitem where l_returnflag <> 'R' group by 1, 2 having count(*) > 1""")
def q_recurrent_values(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").groupBy(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"))
    return rows.agg(count().alias("occurrences"), F.countDistinct("l_orderkey").alias("documents"), F.min("l_orderkey").alias("first_document")).where("occurrences > 1")


@query(f"""select coalesce(nullif(case when c % 3 = 0 then c_name else '' end, ''), nullif(c_mktsegment, ''), 'nadie') as person, count(*) as receipts, count(distinct c) as documents, min(d) as first_day, max(d) as last_day,
  cast(sum(case when status = 'F' then amount else 0 end) as decimal(28,2)) as net from {ORDERS} o join customer on c_custkey = c group by 1""")
def q_person_summary(spark, sf_dir):
    """Payroll by person: the first identity that is there."""
    people = read(spark, sf_dir, "customer")
    name = F.when(F.col("c") % 3 == 0, F.col("c_name")).otherwise("")
    person = F.coalesce(F.nullif(name, F.lit("")), F.nullif(F.col("c_mktsegment"), F.lit("")), F.lit("nadie"))
    rows = fx.orders(spark, sf_dir).join(people, F.col("c_custkey") == F.col("c"))
    return rows.groupBy(person.alias("person")).agg(count().alias("receipts"), F.countDistinct("c").alias("documents"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum(F.when(F.col("status") == "F", F.col("amount")).otherwise(0)).cast("decimal(28,2)").alias("net"))


@query("""with p as (select conv_id, count(*) as pages, sum(length(coalesce(text, ''))) as chars, count_if(trim(coalesce(text, '')) <> '') as filled from conversations group by 1)
  select conv_id as document_id, cast(pages as integer) as pages, cast(chars as bigint) as text_characters, cast(filled as integer) as pages_with_text,
    case when filled = 0 or chars = 0 then 'sin_texto' when filled / pages >= 0.95 and chars / pages >= 100 then 'amplia' when filled / pages >= 0.7 and chars / pages >= 40 then 'parcial' else 'baja' end as coverage from p""")
def q_catalog_rollup(spark, sf_dir):
    """Documents from pages, with the coverage of their text."""
    return catalog.roll_up(read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").cast("int").alias("page_number"), "text"))


@query("select lang, source, count(*) as documents, cast(sum(n_chars) as bigint) as pages from documents group by grouping sets ((lang), (source), ())")
def q_catalog_grouping(spark, sf_dir):
    """Documents by language, by source and in all."""
    return catalog.summary(read(spark, sf_dir, "documents").withColumn("pages", F.col("n_chars")), ["lang", "source"])


@query("select doc_id, upper(strip_accents(replace(coalesce(text, ''), 'ß', 'ss'))) as folded from documents")
def q_fold_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", x.fold(F.coalesce("text", F.lit(""))).alias("folded"))


@query("""with w as (select doc_id, unnest(regexp_extract_all(upper(replace(text, 'ß', 'ss')), '[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ]{3,}')) as term, generate_subscripts(regexp_extract_all(upper(replace(text, 'ß', 'ss')), '[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ]{3,}'), 1) as pos from documents),
  n as (select doc_id, term, count(*) as occurrences, min(pos) as pos from w where lower(strip_accents(term)) not in (""" + ", ".join(f"'{w}'" for w in fixed.STOPWORDS) + """) group by 1, 2),
  r as (select *, row_number() over (partition by doc_id order by occurrences desc, pos) as rank from n)
  select doc_id as document_id, term, occurrences, cast(rank as integer) as rank from r where rank <= 15""")
def q_frequent_terms(spark, sf_dir):
    return catalog.terms(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), "text"))


_RULES = [("Alfa", "name", "^SRC1", 6), ("Alfa", "text", "THE", 4), ("Beta", "name", "5$", 8), ("Beta", "text", "DER", 5), ("Gama", "text", "QUE", 4), ("Gama", "text", "MENTE", 5)]


@query("""with s as (select doc_id, (case when regexp_matches(upper(source), '^SRC1') then 6 else 0 end) as an, (case when regexp_matches(upper(source), '5$') then 8 else 0 end) as bn,
    (case when contains(t, 'THE') then 4 else 0 end) as at_, (case when contains(t, 'DER') then 5 else 0 end) as bt, (case when contains(t, 'QUE') then 4 else 0 end) + (case when contains(t, 'MENTE') then 5 else 0 end) as gt
    from (select *, upper(strip_accents(replace(coalesce(text, ''), 'ß', 'ss'))) as t from documents)),
  u as (select doc_id, 'Alfa' as type, 1 as turn, an + at_ as score, an as named from s union all select doc_id, 'Beta', 2, bn + bt, bn from s union all select doc_id, 'Gama', 3, gt, 0 from s),
  r as (select *, row_number() over (partition by doc_id order by score desc, turn) as k, lead(score) over (partition by doc_id order by score desc, turn) as next, max(named) over (partition by doc_id) as top_name from u),
  l as (select doc_id, count_if(named > 0 and named = top_name) as leaders, arg_min(type, case when named > 0 and named = top_name then turn else 9 end) as named_type, string_agg(case when score >= 4 then type end, '|' order by score desc, turn) as contained_types from r group by 1),
  c as (select r.doc_id, r.type, r.score, l.*, case when r.score < 4 then 'baja' when leaders = 1 then 'alta' when r.score >= 8 and r.score - next >= 3 then 'alta' when r.score - next >= 2 then 'media' else 'baja' end as confidence from r join l using (doc_id) where k = 1)
  select doc_id as document_id, case when confidence = 'baja' then 'Otros / requiere revisión' when leaders > 0 then named_type else type end as primary_type, confidence, coalesce(contained_types, '') as contained_types from c""")
def q_classify_rules(spark, sf_dir):
    """Classification with rules of its own over the corpus: names are sources."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.col("source").alias("file_name"), "text")
    return catalog.classify(docs, _RULES, limit=2**30).select("document_id", "primary_type", "confidence", F.array_join("contained_types", "|").alias("contained_types"))


@query(f"select k, case when k % 7 = 0 then null else d end as parsed, case when k % 5 = 0 then d else null end as spoken from {ORDERS}")
def q_date_parse(spark, sf_dir):
    """Days rendered in three formats, some impossible, parsed back."""
    o = fx.orders(spark, sf_dir)
    names = F.array(*[F.lit(k) for k, v in fixed.MONTHS.items() if len(k) > 3 or k == "MAYO"])
    spoken = F.concat(F.dayofmonth("day").cast("string"), F.lit(" de "), F.lower(F.element_at(names, F.month("day"))), F.lit(" de "), F.year("day").cast("string"))
    text = F.when(F.col("k") % 7 == 0, F.lit("31/02/2021")).when(F.col("k") % 3 == 0, F.date_format("day", "yyyy-MM-dd")).when(F.col("k") % 3 == 1, F.date_format("day", "d/M/yyyy")).otherwise(F.date_format("day", "dd-MM-yy"))
    return o.select("k", x.normalize_date(text).alias("parsed"), F.when(F.col("k") % 5 == 0, x.normalize_date(spoken)).alias("spoken"))


@query(f"""select k, case when k % 19 = 0 and k % 17 <> 0 then null else amount end as amount,
  case when k % 17 = 0 then (case when amount >= 1000 then 'recuperado_separadores' else 'numerico' end) when k % 19 = 0 then 'invalido' else 'numerico' end as amount_status from {ORDERS} where k % 3 = 0""")
def q_amount_parse(spark, sf_dir):
    """Amounts of a sheet: plain, with damaged separators, unreadable."""
    return fx.payments(spark, sf_dir).select(F.col("excel_row").cast("long").alias("k"), x.parse_amount(F.col("amount_raw")).alias("p")).select("k", "p.amount", F.col("p.status").alias("amount_status"))


# ---- extraction ----------------------------------------------------------------------------------------------


@query(f"""with o as (select * from {ORDERS}),
  e as (select k, 'importe' as entity_type, cast(amount as varchar) as normalized_value, case k % 4 when 0 then 'neto del recibo' when 2 then 'importe total' else 'importe mencionado' end as label from o
    union all select k, 'importe', cast(amount * 2 as varchar), 'total' from o where k % 4 = 3
    union all select k, 'fecha', cast(d as varchar), 'fecha numérica' from o
    union all select k, 'folio_referencia', case k % 4 when 0 then 'ABCDEF01-2345-4678-9ABC-' || lpad(cast(k as varchar), 12, '0') when 2 then 'L-' || lpad(cast(k as varchar), 8, '0') else 'P-' || lpad(cast(k as varchar), 8, '0') end, 'folio o referencia' from o where k % 4 <> 1
    union all select k, 'uuid', 'ABCDEF01-2345-4678-9ABC-' || lpad(cast(k as varchar), 12, '0'), 'UUID fiscal' from o where k % 4 = 0
    union all select k, 'cuenta', '0123456789', 'cuenta etiquetada' from o where k % 4 = 2)
  select entity_type, normalized_value, label, count(*) as n from e group by 1, 2, 3""")
def q_entity_extract(spark, sf_dir):
    """Entities of all four kinds of rendered papers; a policy has an amount on two lines and their total."""
    pages = fx.vouchers(spark, sf_dir).withColumn("document_id", F.col("k").cast("string")).drop("month_number", "year", "k", "amount", "day")
    return extract.entities(pages).groupBy("entity_type", "normalized_value", "label").agg(count().alias("n"))


@query("""with c as (select c_custkey as k, 'XAB' || strftime(date '2001-01-01' + cast(c_custkey % 9000 as integer), '%y%m%d') || 'A1' || (c_custkey % 10) as rfc, 'LOMA' || case when c_custkey % 3 = 0 then '991399' else '850203' end || 'HVZRNS0' || (c_custkey % 10) as curp,
    lpad(cast(c_custkey as varchar), 18, '7') as clabe from customer)
  select k as document_id, 'rfc' as entity_type, rfc as normalized_value, 'RFC' as label, 'alta' as confidence, 'RFC ' || rfc || ' CURP ' || curp || ' CLABE ' || clabe as snippet from c
  union all select k, 'curp', curp, case when k % 3 = 0 then 'CURP con posible error OCR' else 'CURP' end, case when k % 3 = 0 then 'media' else 'alta' end, 'RFC ' || rfc || ' CURP ' || curp || ' CLABE ' || clabe from c
  union all select k, 'clabe', clabe, 'CLABE o número de 18 dígitos', 'alta', 'RFC ' || rfc || ' CURP ' || curp || ' CLABE ' || clabe from c""")
def q_identity_entities(spark, sf_dir):
    """Tax and person identities and bank keys of rendered pages, with their snippets."""
    k = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), (k % 9000).cast("int")), "yyMMdd")
    rfc = F.concat(F.lit("XAB"), day, F.lit("A1"), k % 10)
    curp = F.concat(F.lit("LOMA"), F.when(k % 3 == 0, "991399").otherwise("850203"), F.lit("HVZRNS0"), k % 10)
    text = F.concat(F.lit(" :RFC "), rfc, F.lit("\nCURP\t"), F.lower(curp), F.lit("  CLABE "), F.lpad(k.cast("string"), 18, "7"), F.lit(" ;\n"))
    pages = read(spark, sf_dir, "customer").select(k.alias("document_id"), F.lit("x.pdf").alias("relative_path"), F.lit(1).alias("page_number"), text.alias("text"))
    out = extract.entities(pages).where("entity_type in ('rfc', 'curp', 'clabe')")
    snippet = F.regexp_replace("snippet", "CURP (\\S+)", F.concat(F.lit("CURP "), F.upper(F.regexp_extract("snippet", "CURP (\\S+)", 1))))
    return out.select("document_id", "entity_type", "normalized_value", "label", "confidence", snippet.alias("snippet"))


@query(f"select k, sha256('orden|D' || c || '|' || k) as record_key, substr(sha256('P' || k || '|C' || k || '|r'), 1, 24) as link_id, 'TR-' || upper(substr(sha256('A' || k || '|B' || k), 1, 16)) as case_id from {ORDERS}")
def q_record_keys(spark, sf_dir):
    k = F.col("k").cast("string")
    return fx.orders(spark, sf_dir).select("k", x.record_key(F.lit("orden"), F.concat(F.lit("D"), F.col("c")), k).alias("record_key"), x.link_id(F.concat(F.lit("P"), k), F.concat(F.lit("C"), k), F.lit("r")).alias("link_id"), x.case_id(F.array(F.concat(F.lit("B"), k), F.concat(F.lit("A"), k))).alias("case_id"))


@query(f"""with o as (select *, cast(k as varchar) as t, 'D' || c as document_id from {ORDERS})
  select case k % 4 when 0 then 'recibo_nomina' when 1 then 'cheque' when 2 then 'lote_transferencia' else 'poliza_orden_pago' end as record_type, document_id, cast(k % 40 as integer) as page_number,
    case when k % 4 in (1, 2) then 'alta' else 'media' end as confidence, amount,
    case k % 4 when 1 then strftime(d, '%d/%m/%Y') else cast(d as varchar) end as operation_date, case k % 4 when 1 then 'PROVEEDOR DEL NORTE' when 3 then 'PROVEEDOR DEL SUR' end as beneficiary,
    case k % 4 when 1 then t when 2 then 'L-' || lpad(t, 8, '0') when 3 then 'P-' || lpad(t, 8, '0') end as folio,
    sha256(case k % 4 when 0 then 'recibo_nomina|' || document_id || '|ABCDEF01-2345-4678-9ABC-' || lpad(t, 12, '0') when 1 then 'cheque|' || document_id || '|cheque:' || t
      when 2 then 'lote_transferencia|' || document_id || '|L-' || lpad(t, 8, '0') || '|' || amount else 'poliza_orden_pago|' || document_id || '|P-' || lpad(t, 8, '0') end) as record_key
  from o""")
def q_voucher_records(spark, sf_dir):
    """Typed records of rendered papers, against the columns they were rendered from."""
    pages = fx.vouchers(spark, sf_dir).drop("k", "amount", "day")
    return extract.records(pages).select("record_type", "document_id", "page_number", "confidence", "amount", "operation_date", "beneficiary", "folio", "record_key")


@query("""with e as (select user_id, event_id, cast(value as decimal(18,2)) + 1000 as amount, row_number() over (partition by user_id order by event_id) as pos from events where event_type = 'purchase')
  select 'U' || user_id as document_id, amount, '2024-01-' || lpad(cast(1 + event_id % 28 as varchar), 2, '0') as operation_date, 'R' || lpad(cast(event_id as varchar), 8, '0') as reference, 'salida' as direction from e""")
def q_statement_blocks(spark, sf_dir):
    """Bank movements of rendered statements: one block for each anchor line."""
    e = read(spark, sf_dir, "events").where("event_type = 'purchase'")
    day = F.lpad((1 + F.col("event_id") % 28).cast("string"), 2, "0")
    line = F.concat(day, F.lit("/ENE "), day, F.lit("/ENE T17 SPEI ENVIADO BANORTE "), F.format_number(F.col("value").cast("decimal(18,2)") + 1000, 2), F.lit("\nREF. R"), F.lpad(F.col("event_id").cast("string"), 8, "0"), F.lit("\nJUAN LOPEZ\n"))
    pages = e.groupBy(F.concat(F.lit("U"), F.col("user_id")).alias("document_id")).agg(F.concat(F.lit("ESTADO DE CUENTA\nREFERENCIA BANCARIA\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("l")))), lambda s: s["l"]), "")).alias("text"))
    pages = pages.select("document_id", F.lit("x.pdf").alias("relative_path"), F.lit(1).alias("page_number"), "text", F.lit(2024).alias("year"))
    return extract.bank_records(pages).select("document_id", "amount", "operation_date", "reference", F.col("extra")["direccion"].alias("direction"))


@query("""with p as (select l_orderkey as k, l_linenumber as page, l_partkey as ordinal, case when l_returnflag = 'R' then null else l_shipmode end as beneficiary, l_linestatus as s from (select *, 'M' || l_suppkey % 7 as l_shipmode from lineitem))
  select 'K' || k as record_key, arg_min(beneficiary, page * 100000000 + ordinal * 10 + case when beneficiary is null then 9 else cast(substr(beneficiary, 2) as integer) end) filter (where beneficiary is not null) as beneficiary, min(page) as page_number, case when max(case when s = 'F' then 1 else 0 end) = 1 then 'alta' else 'media' end as confidence,
    list_aggregate(list_sort(list(distinct page)), 'string_agg', ',') as evidence_pages from p group by k""")
def q_record_merge(spark, sf_dir):
    """Copies of a record on several pages: the first values, all pages, the best confidence."""
    rows = read(spark, sf_dir, "lineitem").select(F.concat(F.lit("K"), F.col("l_orderkey")).alias("record_key"), F.col("l_linenumber").alias("page_number"), F.struct("l_partkey", (F.col("l_suppkey") % 7).alias("s")).alias("ordinal"), F.when(F.col("l_returnflag") != "R", F.concat(F.lit("M"), F.col("l_suppkey") % 7)).alias("beneficiary"), F.when(F.col("l_linestatus") == "F", "alta").otherwise("media").alias("confidence"))
    return merge.merge_records(rows).select("record_key", "beneficiary", "page_number", "confidence", F.array_join("evidence_pages", ",").alias("evidence_pages"))


_RECORD_NAMES = f"""(select 'N' || k as record_key, 'D' || c as document_id, cast(k % 40 as integer) as page, 'CURP' || c % 400 as curp, case when k % 2 = 0 then 'RFC' || c % 300 end as rfc, case when k % 3 <> 0 then 'PERSONA ' || (c % 5 + k % 2) end as beneficiary from {ORDERS})"""


@query(f"""with r as {_RECORD_NAMES}, i as (select *, curp as identity from r union all select *, rfc from r where rfc is not null),
  n as (select identity, beneficiary, count(*) as n, min(row(document_id, page, record_key)) as seen from i where beneficiary is not null group by 1, 2),
  v as (select i.record_key, n.beneficiary, sum(n.n) as n, min(n.seen) as seen from i join n using (identity) where i.beneficiary is null group by 1, 2),
  w as (select *, row_number() over (partition by record_key order by n desc, seen) as k from v)
  select r.record_key, coalesce(r.beneficiary, w.beneficiary) as beneficiary, cast(w.n as bigint) as inferred_name_support from r left join w on w.record_key = r.record_key and w.k = 1""")
def q_identity_consensus(spark, sf_dir):
    """Names missing on receipts, from the receipts that share an identity."""
    o = fx.orders(spark, sf_dir)
    rows = o.select(F.concat(F.lit("N"), F.col("k")).alias("record_key"), F.concat(F.lit("D"), F.col("c")).alias("document_id"), (F.col("k") % 40).cast("int").alias("page_number"), F.lit(fixed.PAYROLL).alias("record_type"), F.concat(F.lit("CURP"), F.col("c") % 400).alias("curp"), F.when(F.col("k") % 2 == 0, F.concat(F.lit("RFC"), F.col("c") % 300)).alias("rfc"), F.when(F.col("k") % 3 != 0, F.concat(F.lit("PERSONA "), F.col("c") % 5 + F.col("k") % 2)).alias("beneficiary"))
    return merge.infer_names(rows).select("record_key", "beneficiary", "inferred_name_support")


def ledger_sql(round_to: int | None = None) -> str:
    a = "amount" if not round_to else f"cast(round(amount / {round_to}) * {round_to} as decimal(18,2))"
    part = lambda kind, letter, keep, amount, page, days, folio, evidence, doc: f"select '{letter}' || k as record_key, '{kind}' as record_type, {doc} as document_id, cast({page} as integer) as page_number, cast({amount} as decimal(18,2)) as amount, d + cast({days} as integer) as d, {folio} as folio, {evidence} as evidence, month(d) || '. Mes' as period from {ORDERS} where {keep}"
    doc = "'D' || c"
    return "(" + " union all ".join([
        part(fixed.POLICY, "P", "true", a, "k % 40", "0", "null", "case when k % 4 = 0 then cast(k as varchar) end", doc),
        part(fixed.CHEQUE, "C", "k % 3 <> 0", f"{a} + case when k % 5 = 0 then 1 else 0 end", "k % 40 + k % 12", "k % 9", "cast(k as varchar)", "null", doc),
        part(fixed.TRANSFER, "T", "k % 11 = 0", a, "k % 40 + k % 7", "k % 4", "case when k % 2 = 0 then cast(k as varchar) end", "null", doc),
        part(fixed.BANK, "B", "k % 7 = 0", a, "k % 40", "k % 10", "null", "null", "'S' || k % 100"),
    ]) + ")"


def links_sql(round_to: int | None = None) -> str:
    """Internal links of the ledger, without names: candidates, decisions."""
    return f"""l as materialized (select * from {ledger_sql(round_to)}),
  pc as (select p.record_key as s, c.record_key as t, 'poliza_cheque' as relation, abs(p.page_number - c.page_number) as gap, abs(p.d - c.d) as days, p.amount = c.amount as same, p.evidence is not null and p.evidence = c.folio and abs(p.page_number - c.page_number) <= 15 as hit
    from l p join l c on p.document_id = c.document_id where p.record_type = '{fixed.POLICY}' and c.record_type = '{fixed.CHEQUE}'),
  ct as (select c.record_key as s, t.record_key as t, 'cheque_transferencia' as relation, abs(c.page_number - t.page_number) as gap, abs(c.d - t.d) as days, c.amount = t.amount as same, coalesce(c.folio = t.folio, false) as hit
    from l c join l t on c.document_id = t.document_id where c.record_type = '{fixed.CHEQUE}' and t.record_type = '{fixed.TRANSFER}'),
  pt as (select p.record_key as s, t.record_key as t, 'poliza_transferencia' as relation, abs(p.page_number - t.page_number) as gap, abs(p.d - t.d) as days, true as same, false as hit
    from l p join l t on p.document_id = t.document_id and p.amount = t.amount where p.record_type = '{fixed.POLICY}' and t.record_type = '{fixed.TRANSFER}'),
  cand as (
    select s, t, relation, hit, (case when hit then 70 else 0 end) + (case when same then 25 else 0 end) + (case when gap <= 3 then 15 when gap <= 8 then 10 when gap <= 15 then 5 else 0 end) + (case when days = 0 then 10 when days <= 3 then 5 else 0 end) as score from pc where (hit and (same or gap <= 8)) or (same and gap <= 8)
    union all select s, t, relation, hit, (case when hit then 55 else 0 end) + (case when same then 35 else 0 end) + (case when days = 0 then 20 when days <= 3 then 10 else 0 end) + (case when gap <= 3 then 15 when gap <= 8 then 8 else 0 end) from ct where hit or same
    union all select s, t, relation, hit, 45 + (case when days = 0 then 25 when days <= 3 then 15 else 0 end) + (case when gap <= 8 then 10 else 0 end) from pt),
  rk as (select *, row_number() over lw as rl, lead(score) over lw as nl, row_number() over rw as rr, lead(score) over rw as nr from cand
    window lw as (partition by relation, hit, s order by score desc, s, t), rw as (partition by relation, hit, t order by score desc, s, t)),
  dec as materialized (select s, t, relation, score, case when hit then rl = 1 and (nl is null or score >= nl + 10) else rl = 1 and (nl is null or score >= nl + 10) and rr = 1 and (nr is null or score >= nr + 10) and score >= 75 end as taken from rk)"""


LINK_COLUMNS = "substr(sha256(s || '|' || t || '|' || relation), 1, 24) as link_id, s as source_key, t as target_key, relation, cast(least(score, 100) as integer) as score, case when taken then 'aceptado' else 'sugerido' end as status"


def _links(links: DataFrame) -> DataFrame:
    return links.select("link_id", "source_key", "target_key", "relation", "score", "status")


def _chosen(rows):
    return linkage.choose(linkage.policy_cheque(rows, x.word_overlap).unionByName(linkage.cheque_transfer(rows)).unionByName(linkage.policy_transfer(rows)))


def _ledger_decided(spark, sf_dir, round_to=None):
    rows = linkage.prepared(fx.ledger(spark, sf_dir, round_to))
    return rows, written(_chosen(rows), "inside")


@query(f"with {links_sql()} select {LINK_COLUMNS} from dec where score >= 55")
def q_internal_links(spark, sf_dir):
    """Links inside documents: policy, cheque and transfer pairs under the margins."""
    return _links(linkage.link_rows(_ledger_decided(spark, sf_dir)[1]))


@query(f"with {links_sql(10_000)} select relation, case when taken then 'aceptado' else 'sugerido' end as status, count(*) as links, cast(sum(least(score, 100)) as bigint) as points from dec where score >= 55 group by 1, 2")
def q_ambiguous_links(spark, sf_dir):
    """The same with rounded amounts, where many pairs tie."""
    links = linkage.link_rows(_ledger_decided(spark, sf_dir, 10_000)[1])
    return links.groupBy("relation", "status").agg(count().alias("links"), F.sum("score").alias("points"))


def components_sql() -> str:
    return """edge as (select s as a, t as b from dec where taken union select t, s from dec where taken),
  walk as (select record_key as node, record_key as root from l union select e.b, w.root from walk w join edge e on e.a = w.node),
  comp as materialized (select node, min(root) as root from walk group by node)"""


@query(f"with recursive {links_sql()}, {components_sql()} select node as record_key, root from comp where node in (select a from edge)")
def q_components(spark, sf_dir):
    """Components of the accepted links."""
    taken = _ledger_decided(spark, sf_dir)[1].where("taken")
    return components(taken.select(F.col("source_key").alias("a"), F.col("target_key").alias("b"))).withColumnRenamed("node", "record_key")


BANK_SQL = f"""bc as (select c.record_key as s, b.record_key as t, comp.root, 35 + (case when abs(b.d - c.d) = 0 then 30 when abs(b.d - c.d) <= 3 then 24 else 15 end) + (case when c.record_type = '{fixed.TRANSFER}' then 10 else 0 end) as score, row(c.document_id, c.page_number, c.record_key) as o, row(b.document_id, b.page_number, b.record_key) as bo
    from l b join l c on b.amount = c.amount and abs(b.d - c.d) <= 7 join comp on comp.node = c.record_key where b.record_type = '{fixed.BANK}' and c.record_type in ('{fixed.CHEQUE}', '{fixed.TRANSFER}')),
  b1 as (select * from (select *, row_number() over (partition by t, root order by score desc, o) as k from bc) where k = 1),
  b2 as (select *, row_number() over w as k2, lead(score) over w as nx from b1 window w as (partition by t order by score desc, o)),
  b3 as (select *, score >= 75 and (nx is null or score >= nx + 10) as able from b2 where k2 = 1),
  bank as materialized (select s, t, 'registro_movimiento_bancario' as relation, score, able and row_number() over (partition by root, able order by score desc, bo) = 1 as taken from b3)"""


@query(f"with recursive {links_sql(10_000)}, {components_sql()}, {BANK_SQL} select {LINK_COLUMNS} from bank where score >= 55")
def q_bank_interval_match(spark, sf_dir):
    """Bank rows against records of equal (rounded) amounts within seven days, across documents."""
    # Written, as the tables that `fold` takes days and names through stand in a plan wherever these are used.
    rows = linkage.prepared(fx.ledger(spark, sf_dir, 10_000)).select("record_key", "record_type", "document_id", "page_number", "amount", "folio", "reference", "evidence", "day", "name")
    rows = written(rows, "prepared").withColumn("ordinal", F.struct("document_id", "page_number", "record_key"))
    matched = linkage.bank_matches(rows, linkage.linked(_chosen(rows).where("taken")), x.word_overlap)
    return _links(linkage.link_rows(matched))


CASES_SQL = f"""{links_sql()}, {components_sql()}, {BANK_SQL},
  alld as materialized (select s, t, relation, score, taken from dec union all select s, t, relation, score, taken from bank),
  e2 as (select s as a, t as b from alld where taken union select t, s from alld where taken),
  w2 as (select record_key as node, record_key as root from l union select e.b, w.root from w2 w join e2 e on e.a = w.node),
  fin as materialized (select node, min(root) as root from w2 group by node),
  sug as (select k, count(*) as n from (select s as k from alld where score >= 55 and not taken union all select t from alld where score >= 55 and not taken) group by 1),
  acc as (select f.root, count(*) as n from alld a join fin f on f.node = a.s where a.taken and a.score >= 55 group by 1),
  g as (select f.root, list_sort(list(l.record_key)) as keys, list(distinct l.record_type) as types, count(*) as record_count, count(distinct document_id) as document_count, count(distinct amount) as amounts, coalesce(sum(sug.n), 0) as suggested from l join fin f on f.node = l.record_key left join sug on sug.k = l.record_key group by 1)"""


@query(f"""with recursive {CASES_SQL}
  select 'TR-' || upper(substr(sha256(list_aggregate(keys, 'string_agg', '|')), 1, 16)) as case_id, 'pago' as case_type,
    case when len(types) > 1 and list_contains(types, '{fixed.BANK}') then 'conciliado_banco' when len(types) > 1 then 'trazabilidad_documental' else 'sin_conciliar' end as status,
    case when coalesce(acc.n, 0) > 0 then 'alta' else 'media' end as confidence, cast(record_count as integer) as record_count, cast(document_count as integer) as document_count, cast(coalesce(acc.n, 0) as integer) as accepted_links, cast(suggested as integer) as suggested_links, amounts <= 1 as amount_consistent
  from g left join acc using (root)""")
def q_cases(spark, sf_dir):
    """Cases: components after the bank step."""
    found, _, _ = linkage.reconcile(fx.ledger(spark, sf_dir), x.word_overlap)
    return found.select("case_id", "case_type", "status", "confidence", "record_count", "document_count", "accepted_links", "suggested_links", "amount_consistent")


@query(f"""with recursive {CASES_SQL}, k as (select s as k from alld where taken and score >= 55 union select t from alld where taken and score >= 55)
  select record_type, count(*) as total, count(k.k) as linked, round(100 * count(k.k) / count(*), 2) as percent from l left join k on k.k = l.record_key group by 1""")
def q_link_coverage(spark, sf_dir):
    rows = fx.ledger(spark, sf_dir)
    return linkage.link_coverage(rows, linkage.reconcile(rows, x.word_overlap)[1])


@query(f"""with recursive {CASES_SQL}
  select count(*) as cases, count_if(len(types) > 1) as linked_cases, count_if(len(types) > 1 and list_contains(types, '{fixed.BANK}')) as reconciled, (select count(*) from alld where taken and score >= 55) as accepted_links, (select count(*) from alld where not taken and score >= 55) as suggested_links from g""")
def q_trace_summary(spark, sf_dir):
    found, links, _ = linkage.reconcile(fx.ledger(spark, sf_dir), x.word_overlap)
    counts = links.agg(F.count_if(F.col("status") == "aceptado").alias("accepted_links"), F.count_if(F.col("status") == "sugerido").alias("suggested_links"))
    sums = found.agg(count().alias("cases"), F.count_if(F.size("stages") > 1).alias("linked_cases"), F.count_if(F.col("status") == "conciliado_banco").alias("reconciled"))
    return sums.crossJoin(counts)  # one row by one row


@query(f"""with l as (select * from {ledger_sql()}), b as (select distinct document_id, amount, record_type from l where record_type in ('{fixed.CHEQUE}', '{fixed.TRANSFER}')),
  s as (select document_id, amount, string_agg(record_type, ',' order by record_type) as cross_support from b group by 1, 2)
  select l.record_key, s.cross_support from l join s using (document_id, amount) where l.record_type = '{fixed.POLICY}'""")
def q_corroboration(spark, sf_dir):
    """Policies whose amount a cheque or transfer of the document repeats."""
    return merge.corroborate(fx.ledger(spark, sf_dir)).where("cross_support is not null").select("record_key", F.array_join("cross_support", ",").alias("cross_support"))


# ---- payments ------------------------------------------------------------------------------------------------


def _payments(spark, sf_dir):
    p = fx.payments(spark, sf_dir).withColumn("p", x.parse_amount(F.col("amount_raw")))
    return p.select("excel_row", "account", "origin", "month", F.col("p.amount").alias("amount"), F.col("p.status").alias("amount_status"), "concept")


PAY_SQL = f"""pay as (select cast(k as integer) as excel_row, cast(month(d) as integer) as m, k, c, priority, status, case when k % 19 = 0 and k % 17 <> 0 then null else amount end as amount, k % 17 = 0 and amount >= 1000 as saved from {ORDERS} where k % 3 = 0)"""


RANK_SQL = f"""{PAY_SQL}, rec as (select month(d) as m, month(d) || '. Mes/D' || c || '.pdf' as path, 'D' || c as doc, cast(k as varchar) as folio, k, amount, cast(k % 40 as integer) as page from {ORDERS} where k % 2 = 0),
  uniq as (select m, amount, min(path) as path from (select distinct m, amount, path from rec) group by 1, 2 having count(*) = 1),
  path as (select distinct m, path, regexp_extract(path, 'D(\\d+)', 1) as num from rec),
  hit as (select p.excel_row, t.path, 80 * (case when t.num = cast(p.k as varchar) then 1 else 0 end) + 65 * (case when p.k <> 0 and exists (select 1 from rec r where r.path = t.path and r.k = p.k) then 1 else 0 end)
      + 25 * (case when exists (select 1 from rec r where r.path = t.path and r.amount = p.amount) then 1 else 0 end) + 40 * (case when u.path = t.path then 1 else 0 end) as score
    from pay p join path t on t.m = p.m left join uniq u on u.m = p.m and u.amount = p.amount),
  r as (select *, row_number() over w as rank, lead(score) over w as nx from hit where score >= 55 window w as (partition by excel_row order by score desc, path desc))"""


@query(f"""with {RANK_SQL}
  select excel_row, path as relative_path, cast(score as integer) as score, cast(rank as integer) as rank, first(coalesce(nx >= score - 10, false)) over (partition by excel_row order by rank) as ambiguous from r qualify rank <= 3""")
def q_payment_rank(spark, sf_dir):
    """Sheet rows ranked against the documents of their month."""
    pairs = crossref.scored(_payments(spark, sf_dir), crossref.document_index(_pay_records(spark, sf_dir)))
    return crossref.ranked(pairs).select("excel_row", "relative_path", "score", "rank", "ambiguous")


def _pay_records(spark, sf_dir):
    """Cheque records of every second order, with the order's key as folio."""
    o = fx.orders(spark, sf_dir).where("k % 2 = 0")
    none = F.lit(None).cast("string")
    path = F.concat(F.month("day").cast("string"), F.lit(". Mes/D"), F.col("c"), F.lit(".pdf"))
    return o.select(F.concat(F.lit("C"), F.col("k")).alias("record_key"), F.lit(fixed.CHEQUE).alias("record_type"), path.alias("relative_path"), (F.col("k") % 40).cast("int").alias("page_number"), "amount", F.col("k").cast("string").alias("folio"), none.alias("concept"), none.alias("evidence"))


#: The best document of each row, and the record of it that proves the payment: an exact amount on the first page, else the last page.
MATCHED_SQL = f"""{RANK_SQL},
  best as (select excel_row, path, score, coalesce(nx >= score - 10, false) as unclear from r where rank = 1),
  asked as (select p.*, list_extract({['ENE', 'FEB', 'MAR', 'ABR', 'MAY', 'JUN', 'JUL', 'AGO', 'SEP', 'OCT', 'NOV', 'DIC']}, p.m) as month,
      case when amount is null then 'invalido' when saved then 'recuperado_separadores' else 'numerico' end as amount_status from pay p),
  shown as (select b.excel_row, 'C' || c.k as key, c.page, c.amount as found, coalesce(c.amount = a.amount, false) as exact
    from best b join asked a using (excel_row) join rec c on c.path = b.path),
  proof as (select excel_row, case when count(distinct found) = 1 then any_value(found) end as paid, max(page) as paid_page,
      first(struct_pack(key, page, found) order by exact desc, case when exact then page else -page end, key) as e from shown group by 1)"""


@query(f"""with {MATCHED_SQL}
  select p.excel_row, cast(p.k as varchar) as account, 'banco' as origin, p.month, p.amount, p.amount_status, 'SERVICIO ' || p.priority as concept,
    case when b.score is null then 'sin_coincidencia' when b.unclear then 'ambiguo' else 'vinculado' end as match_status,
    case when b.score is null then 'baja' when b.unclear or b.score < 80 then 'media' else 'alta' end as match_confidence,
    cast(coalesce(b.score, 0) as integer) as match_score, b.path as matched_path, v.e.key as matched_record_key,
    case when v.e is not null then '{fixed.CHEQUE}' end as matched_type, v.e.page as matched_page, v.e.found as source_amount,
    cast(v.e.found - p.amount as decimal(18,2)) as amount_difference, v.paid as paid_amount, v.paid_page,
    cast(v.paid - p.amount as decimal(18,2)) as paid_difference, false as amount_in_paid_evidence
  from asked p left join best b using (excel_row) left join proof v using (excel_row)""")
def q_payment_match(spark, sf_dir):
    """Sheet rows with their match, proof and differences."""
    out, _ = crossref.matched(_payments(spark, sf_dir), _pay_records(spark, sf_dir))
    return out.drop("match_reasons", "paid_amounts")


@query("""select 'A' || l_partkey as account, l_suppkey % 12 as month, cast(l_quantity as decimal(18,2)) as amount, count(*) as n, min(l_orderkey * 10 + l_linenumber) as first_row
  from lineitem where l_quantity is not null group by l_partkey, l_suppkey % 12, l_quantity having count(*) > 1""")
def q_duplicates(spark, sf_dir):
    """Sheet rows of equal account, month, amount and concept."""
    rows = read(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("excel_row"), F.concat(F.lit("A"), F.col("l_partkey")).alias("account"), (F.col("l_suppkey") % 12).alias("month"), F.col("l_quantity").cast("decimal(18,2)").alias("amount"), F.lit("x").alias("concept"))
    return crossref.duplicates(rows).select("account", "month", "amount", "n", F.array_min("rows").alias("first_row"))


@query(f"""with {PAY_SQL} select 'importe_como_texto' as kind, count(*) as n, cast(sum(amount) as decimal(28,2)) as adjustment from pay where saved""")
def q_findings(spark, sf_dir):
    """Findings of a sheet whose rows are matched with nothing: amounts kept as text."""
    rows = _payments(spark, sf_dir)
    none = F.lit(None)
    unmatched = rows.withColumns({"match_status": F.lit("sin_coincidencia"), "matched_path": none.cast("string"), "paid_amount": none.cast("decimal(18,2)"), "paid_page": none.cast("int"), "paid_difference": none.cast("decimal(18,2)"), "amount_in_paid_evidence": F.lit(False)})
    return crossref.findings(rows, unmatched).groupBy("kind").agg(count().alias("n"), F.sum("adjustment").cast("decimal(28,2)").alias("adjustment"))


@query(f"""with {PAY_SQL}, t as (select count(*) as rows, cast(sum(amount) as decimal(28,2)) as s, cast(sum(case when saved then amount else 0 end) as decimal(28,2)) as f from pay)
  select rows, s as sum_of_rows, f as confirmed_adjustment, s as worksheet_total, cast(s + f as decimal(28,2)) as adjusted_total, cast(1000000 - s - f as decimal(28,2)) as gap from t""")
def q_control_totals(spark, sf_dir):
    rows = _payments(spark, sf_dir)
    found = rows.where("amount_status = 'recuperado_separadores'").select(F.lit(True).alias("affects_confirmed_total"), F.col("amount").alias("adjustment"))
    return crossref.control_totals(rows, found, stated_total=0, target=1_000_000)


# ---- readings ------------------------------------------------------------------------------------------------


@query(f"""select k, case when k % 6 = 0 then 'sin_lectura' when k % 6 = 1 then (case when k % 100 < 75 then 'baja_confianza' else '' end) when k % 6 = 2 then concat_ws('|', case when k % 100 < 75 then 'baja_confianza' end, 'formato_invalido', 'confusion_alfanumerica')
    when k % 6 = 3 then (case when k % 100 < 75 then 'baja_confianza' else '' end) when k % 6 = 4 then concat_ws('|', case when k % 100 < 75 then 'baja_confianza' end, 'fecha_invalida') else (case when k % 100 < 75 then 'baja_confianza' else '' end) end as issues,
  case when k % 9 = 0 then 'discrepante' when k % 6 in (2, 4) then 'formato_invalido' when k % 6 = 0 then 'requiere_revision' when k % 100 < 75 then 'baja_confianza' else 'coincidente' end as comparison from {ORDERS}""")
def q_validate_fields(spark, sf_dir):
    """Readings with known faults: their issues, and how two readings compare."""
    o, m = fx.orders(spark, sf_dir), F.col("k") % 6
    kind = F.when(m.isin(1, 2), "importe").when(m.isin(3, 4), "fecha").otherwise("cuenta")
    raw = F.when(m == 0, F.lit("  ")).when(m == 1, F.concat(F.lit("$ "), fx.money(F.col("amount")))).when(m == 2, F.lit("1O0.0")).when(m == 3, F.date_format("day", "dd/MM/yyyy")).when(m == 4, F.lit("31/02/2021")).otherwise(F.lit("1234567890"))
    other = F.when(F.col("k") % 9 == 0, F.concat(raw, F.lit("9"))).otherwise(raw)
    sure = (F.col("k") % 100).cast("double")
    return o.select("k", F.array_join(fields.validate_field(kind, raw, sure), "|").alias("issues"), fields.compare_readings(kind, raw, other, sure).alias("comparison"))


_WORDS = """(select doc_id, pos, w as text, cast(40 + (doc_id * 7 + pos * 13) % 60 as double) as confidence, cast(pos % 50 as double) as x0, cast(pos // 50 as double) as y0, cast(length(w) as double) as wd, cast(case when pos % 5 = 0 then 9 else 1 end as double) as ht
  from (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) - 1 as pos from (select doc_id, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda v: v <> '') as ws from documents)))"""


def _words(spark, sf_dir):
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(words).alias("ordinal", "text"))
    x0, y0 = (F.col("ordinal") % 50).cast("double"), F.floor(F.col("ordinal") / 50).cast("double")
    high = F.when(F.col("ordinal") % 5 == 0, 9.0).otherwise(1.0)
    return rows.select(F.col("doc_id").alias("page_id"), "ordinal", "text", (40 + (F.col("doc_id") * 7 + F.col("ordinal") * 13) % 60).cast("double").alias("confidence"), F.array(x0, y0, x0 + F.length("text"), y0 + high).alias("box"))


@query(f"""with w as {_WORDS}, b as (select *, trim(lower(text), '.,:$()') as bare from w)
  select doc_id as page_id, round(sum(confidence * length(text)) / sum(length(text)), 3) as confidence, count(distinct case when bare in ({', '.join(f"'{h}'" for h in fixed.HEADERS)}) then bare end) as headers,
    round(count_if(bare in ({', '.join(f"'{h}'" for h in fixed.COMMON)}) or regexp_full_match(bare, '\\d[\\d.,/:-]*')) / count(*), 3) as plausible_ratio, round(count_if(length(text) > 2 and wd > ht) / greatest(1, count_if(length(text) > 2)), 3) as horizontal_word_ratio from b group by 1""")
def q_reading_score(spark, sf_dir):
    """Readings scored from their words; the oracle holds the parts of the score."""
    words = _words(spark, sf_dir)
    return calibration.score_readings(words, ["page_id"]).select("page_id", "confidence", F.col("headers").cast("long").alias("headers"), "plausible_ratio", "horizontal_word_ratio")


_PATTERNS_SQL = " + ".join(f"len(regexp_extract_all(text, '{p}'))" for p in [
    # An amount, without looking around: the signs beside it are taken too.
    r"(?:^|[^\d.])(?:\$\d[\d,]{0,20}\.\d{2}|\d{1,3}(?:,\d{3})+\.\d{2}|\d{1,12}\.\d{2})(?:$|[^\d.])",
    r"\b\d{1,2}/\d{1,2}/\d{4}\b",
    *fixed.READING_PATTERNS,
])


@query(f"""with w as {_WORDS}, a as (select *, trim(lower(text), '.,:$()') as bare, unnest([0, 90, 180, 270]) as angle from w),
  t as (select doc_id, angle, sum(greatest(confidence - (angle + 90 * (doc_id % 4)) % 360 / 9.0::double, 0) * length(text)) / sum(length(text)) as c,
      sum(length(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g'))) as signs, sum({_PATTERNS_SQL}) as hits,
      count(distinct case when bare in ({', '.join(f"'{h}'" for h in fixed.HEADERS)}) then bare end) as headers,
      count_if(bare in ({', '.join(f"'{h}'" for h in fixed.COMMON)}) or regexp_full_match(bare, '\\d[\\d.,/:-]*')) / count(*) as p,
      count_if(length(text) > 2 and wd > ht) / greatest(1, count_if(length(text) > 2)) as h from a group by 1, 2),
  s as (select *, round(0.55::double * c + 8 * ln(1 + signs) + 25 * p + 3 * least(headers, 10) + 2 * ln(1 + hits) + 30 * h, 4) as score from t),
  k as (select *, lead(score) over o as second, row_number() over o as place from s window o as (partition by doc_id order by score desc, angle)),
  m as (select *, (score - second) / greatest(abs(score), 1) as margin from k where place = 1),
  u as (select *, margin < 0.06 or round(c, 3) < 35 or signs < 15 as unclear from m)
  select doc_id as page_id, angle, round(margin, 4) as margin, unclear as ambiguous, case when unclear then 'baja' when margin > 0.18 then 'alta' else 'media' end as confidence from u""")
def q_orientation(spark, sf_dir):
    """The best of four angles of each page, whose words are read the worse the further an angle is from the page's own."""
    angles = F.explode(F.array(*map(F.lit, (0, 90, 180, 270))))
    off = F.pmod(F.col("angle") + 90 * (F.col("page_id") % 4), F.lit(360))
    words = _words(spark, sf_dir).withColumn("angle", angles).withColumn("confidence", F.col("confidence") - off / 9)
    return calibration.choose_orientation(calibration.score_readings(words, ["page_id", "angle"]))


@query(f"""with w as {_WORDS} select doc_id as page_id, f.id as field_id, string_agg(text, ' ' order by pos) as raw, round(avg(confidence), 6) as confidence from w, (values (1, 0.0, 0.0, 20.0, 4.0), (2, 30.0, 2.0, 60.0, 6.0)) as f(id, a, b, c, d)
  where x0 + wd / 2 between a and c and y0 + ht / 2 between b and d group by 1, 2""")
def q_roi_words(spark, sf_dir):
    """Words whose centre lies in a page's regions."""
    pages = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id")).distinct()
    box = lambda *v: F.array(*map(F.lit, v))
    region = F.explode(F.array(F.struct(F.lit(1).alias("field_id"), box(0.0, 0.0, 20.0, 4.0).alias("region")), F.struct(F.lit(2).alias("field_id"), box(30.0, 2.0, 60.0, 6.0).alias("region"))))
    regions = pages.select("page_id", region.alias("r")).select("page_id", "r.field_id", "r.region")
    return calibration.region_text(_words(spark, sf_dir), regions).withColumn("confidence", F.round("confidence", 6))


@query("""with r as (select doc_id, 'P' || (doc_id % 4) as profile, case when quality = 1 then 'bueno' else 'malo' end as kind, doc_id % 3 <> 0 as exact, doc_id % 5 = 0 as review from labels)
  , a as (select profile, kind, count(*) as total, count_if(exact) as exact, count_if(not exact and not review) as unnoticed from r group by grouping sets ((profile, kind), (profile)))
  select a.profile, a.kind, a.total, a.exact, a.unnoticed, round(100 * a.exact / a.total, 2) as percent, a.exact - coalesce(b.exact, 0) as change from a left join a b on b.profile = 'P0' and b.kind is not distinct from a.kind""")
def q_profile_accuracy(spark, sf_dir):
    """Accuracy of reading profiles in all and by kind, against a baseline."""
    rows = read(spark, sf_dir, "labels").select(F.concat(F.lit("P"), F.col("doc_id") % 4).alias("profile"), F.when(F.col("quality") == 1, "bueno").otherwise("malo").alias("kind"), (F.col("doc_id") % 3 != 0).alias("exact"), (F.col("doc_id") % 5 == 0).alias("requires_review"))
    return calibration.profile_accuracy(rows, "P0")


@query(f"""with w as (select k, k % 6 as m, k % 15 as n, greatest(0, k % 100 - 10) as c from {ORDERS})
  select k, round(case when n = 0 then 0 else c end + case when m in (1, 3, 5) then 20 when m = 2 then -15 else 0 end - 2 * greatest(0, n - 12), 4)::double as score from w""")
def q_crop_score(spark, sf_dir):
    """Regions scored by the value read and the confidence of their words."""
    o, m = fx.orders(spark, sf_dir), F.col("k") % 6
    kind = F.when(m.isin(1, 2), "importe").when(m.isin(3, 4), "fecha").otherwise("cuenta")
    raw = F.when(m == 0, F.lit("  ")).when(m == 1, F.concat(F.lit("$ "), fx.money(F.col("amount")))).when(m == 2, F.lit("1O0.0")).when(m == 3, F.date_format("day", "dd/MM/yyyy")).when(m == 4, F.lit("31/02/2021")).otherwise(F.lit("1234567890"))
    sure = F.array_repeat((F.col("k") % 100 - 10).cast("double"), (F.col("k") % 15).cast("int"))
    return o.select("k", F.round(fields.crop_score(kind, raw, sure), 4).alias("score"))


@query("""with r as (select case when quality = 1 then 'bueno' else 'malo' end as kind, 'D' || (doc_id % 10) as document, doc_id % 3 <> 0 as exact from labels),
  a as (select 'total' as level, null as name, count(*) as fields, count_if(exact) as exact from r union all select 'tipo', kind, count(*), count_if(exact) from r group by kind union all select 'documento', document, count(*), count_if(exact) from r group by document)
  select level, name, fields, exact, round(100 * exact / fields, 2) as percent from a""")
def q_accuracy_breakdown(spark, sf_dir):
    """Accuracy in all, by kind of field and by document."""
    rows = read(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "bueno").otherwise("malo").alias("kind"), F.concat(F.lit("D"), F.col("doc_id") % 10).alias("document"), (F.col("doc_id") % 3 != 0).alias("exact"))
    return calibration.accuracy_breakdown(rows)


@query("""with e as (select 'ABCD'[cast(1 + event_id % 4 as integer)] as profile, user_id as page_id, event_type, cast(round(value, 2) as decimal(18,2)) as seconds from events),
  o as (select coalesce(sum(seconds), 0) as shared from e where event_type = 'view'),
  t as (select profile, sum(seconds) + case when profile = 'A' then 0 else any_value(shared) end as total, count(distinct page_id) as pages from e, o where event_type <> 'view' group by profile)
  select profile, cast(total as decimal(18,2)) as total_seconds, round(cast(total as double) / pages, 2) as seconds_per_page from t""")
def q_reading_timings(spark, sf_dir):
    """Seconds by reading profile, with the shared orientation."""
    e = read(spark, sf_dir, "events").select(F.substring(F.lit("ABCD"), (1 + F.col("event_id") % 4).cast("int"), F.lit(1)).alias("profile"), F.col("user_id").alias("page_id"), "event_type", F.round("value", 2).cast("decimal(18,2)").alias("seconds"))
    return calibration.timings(e.where("event_type <> 'view'"), e.where("event_type = 'view'"))


@query("""select 'C' || conv_id as path, turn as page, sha256('C' || conv_id) as original_hash, conv_id % 5 <> 0 as intact, case when turn % 7 = 6 then 0 else length(coalesce(text, '')) end as characters_before, length(coalesce(text, '') || '!') as characters_after
  from conversations where conv_id % 3 <> 0""")
def q_page_audit(spark, sf_dir):
    """Pages before and after a run, and whether their originals are intact."""
    path = F.concat(F.lit("C"), F.col("conv_id"))
    pages = read(spark, sf_dir, "conversations").select("conv_id", path.alias("path"), F.col("turn").alias("page"), F.coalesce("text", F.lit("")).alias("text"))
    files = pages.select("conv_id", "path").distinct().withColumn("hash", F.sha2("path", 256))
    states = files.select("path", "hash", F.when(F.col("conv_id") % 3 == 0, "failed").otherwise("completed").alias("status"))
    found = files.select("path", F.when(F.col("conv_id") % 5 == 0, "x").otherwise(F.col("hash")).alias("hash"))
    out = inventory.page_audit(pages.where("page % 7 <> 6"), pages.withColumn("text", F.concat("text", F.lit("!"))), states, found)
    return out.withColumns({c: F.col(c).cast("long") for c in ("characters_before", "characters_after")})


# ---- search, states, sets --------------------------------------------------------------------------------------


@query("""with t as (select doc_id, unnest(string_split_regex(upper(strip_accents(replace(coalesce(text, ''), 'ß', 'ss'))), '[^\\p{L}\\p{N}]+')) as token from documents)
  select doc_id as document_id, 1 as page_number, count(*) as hits from t where token in ('THE', 'AND') group by 1 having count(distinct token) = 2""")
def q_fulltext(spark, sf_dir):
    """Pages that hold all the terms."""
    pages = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.lit(1).alias("page_number"), "text")
    return search.match(search.token_index(pages), ["the", "and"])


@query("""select case when status not in ('completed', 'already_completed') then 'ocr_pending' when k % 2 = 0 and k % 3 <> 0 then 'reused' when k % 2 = 0 then 'reclassified' else 'analyzed' end as action, count(*) as documents
  from (select event_id as k, case event_type when 'click' then 'completed' when 'view' then 'already_completed' when 'purchase' then 'failed' when 'signup' then 'encrypted' else 'pending' end as status from events) group by 1""")
def q_incremental(spark, sf_dir):
    """What an incremental catalogue run does with each document."""
    s = fx.states(spark, sf_dir).select(F.col("event_id").alias("document_id"), "status", F.sha2(F.col("event_id").cast("string"), 256).alias("hash"))
    known = s.select("document_id", F.when(F.col("document_id") % 2 == 0, F.col("hash")).otherwise("x").alias("hash"), F.when(F.col("document_id") % 3 == 0, 1).otherwise(2).alias("schema_version"))
    return inventory.actions(s, known, 2).groupBy("action").agg(count().alias("documents"))


@query("""with s as (select case event_type when 'click' then 'completed' when 'view' then 'already_completed' when 'purchase' then 'failed' when 'signup' then 'encrypted' else 'pending' end as status, event_id % 20 as pages, cast(round(value, 2) as decimal(18,2)) as sec from events),
  t as (select count(*) as total, count_if(status = 'completed') as completed, count_if(status = 'already_completed') as already_completed, count_if(status in ('failed', 'encrypted')) as failed, count_if(status = 'pending') as pending, cast(sum(case when status in ('completed', 'already_completed') then pages else 0 end) as bigint) as pages, sum(case when status in ('completed', 'already_completed') then sec else 0 end) as sec from s)
  select total, completed, already_completed, failed, pending, pages, cast(sec as decimal(18,2)) as seconds from t""")
def q_batch_summary(spark, sf_dir):
    out = inventory.batch_summary(fx.states(spark, sf_dir).withColumn("seconds", F.col("seconds").cast("decimal(18,2)")))
    return out.select("total", "completed", "already_completed", "failed", "pending", "pages", F.col("seconds").cast("decimal(18,2)").alias("seconds"))


@query("""select 'solo_documentos' as side, count(*) as n from (select doc_id from documents except select doc_id from labels) union all select 'ambos', count(*) from (select doc_id from documents intersect select doc_id from labels)
  union all select 'hash_distinto', count(*) from documents where doc_id % 7 = 0""")
def q_set_diff(spark, sf_dir):
    """Set difference, intersection, and a frozen set verified by hashes."""
    docs, labels = read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select("doc_id")
    told = lambda df, side: df.agg(count().alias("n")).select(F.lit(side).alias("side"), "n")
    frozen = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.sha2("text", 256).alias("hash"))
    changed = frozen.withColumn("hash", F.when(F.col("name") % 7 == 0, "x").otherwise(F.col("hash")))
    return told(docs.exceptAll(labels.intersect(docs)), "solo_documentos").unionAll(told(docs.intersect(labels), "ambos")).unionAll(told(inventory.frozen_mismatches(frozen, changed), "hash_distinto"))


@query("""select user_id as document_id, cast(event_id % 20 as integer) as page_number, count(*) as warnings from events where event_type in ('error', 'purchase') and event_type = 'error' group by 1, 2""")
def q_log_warnings(spark, sf_dir):
    """Log lines that lead with a page number and tell of trouble."""
    lines = read(spark, sf_dir, "events").select(F.col("user_id").alias("document_id"), F.concat(F.lit("  "), (F.col("event_id") % 20).cast("string"), F.lit(" [tess] "), F.col("event_type")).alias("line"))
    return inventory.log_warnings(lines).select("document_id", "page_number", F.size("warnings").cast("long").alias("warnings"))


@query("""select conv_id as document_id, string_agg(coalesce(text, ''), chr(10) || chr(12) || chr(10) order by turn) as text from conversations group by 1""")
def q_page_text(spark, sf_dir):
    """Whole texts of documents, pages separated by form feeds."""
    return catalog.page_text(read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("page_number"), "text"))


@query(f"select k, 'file:///x/' || replace('D ' || c, ' ', '%20') || '.pdf#page=' || k % 40 as link, '[\"' || status || '\",\"' || priority || '\"]' as signals from {ORDERS}")
def q_nested_export(spark, sf_dir):
    """Links to pages and nested columns as JSON."""
    path = F.concat(F.lit("/x/D "), F.col("c").cast("string"), F.lit(".pdf"))
    return fx.orders(spark, sf_dir).select("k", x.local_link(path, F.col("k") % 40).alias("link"), F.to_json(F.array("status", "priority")).alias("signals"))


@query("""select cast(2 as integer) as excel_row, 'POL 12' as account, 'caja' as origin, '1/2/2021' as date_text, 'FEB' as month, '93.198.98' as amount_raw, 'obra' as concept,
  cast(93198.98 as decimal(18,2)) as amount, 'recuperado_separadores' as amount_status, cast(93198.98 as decimal(18,2)) as stated_total""")
def q_sheet_source(spark, sf_dir):
    """A payment workbook, written and read back with its total row."""
    import io
    import zipfile

    from docledger.sources import sheet
    from docledger.storage import save_bytes

    cells = [("cuenta", "origen", "fecha", "mes", "importe", "concepto"), ("POL 12", "caja", "1/2/2021", "FEB", "93.198.98", "obra"), ("", "", "", "", "", ""), ("TOTAL", "", "", "", "93198.98", "")]
    body = "".join(f"<row r='{r}'>" + "".join(f"<c r='{col}{r}' t='inlineStr'><is><t>{v}</t></is></c>" for col, v in zip("ABCDEF", row) if v) + "</row>" for r, row in enumerate(cells, 1))
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet><sheetData>{body}</sheetData></worksheet>")
    path = save_bytes(spark, book.getvalue(), "pagos.xlsx")
    rows, total = sheet.payment_rows(sheet.read_sheets(spark, path))
    return rows.crossJoin(total)  # one total row


from docledger.plans import reports  # noqa: E402, F401  adds its queries to the catalogue
