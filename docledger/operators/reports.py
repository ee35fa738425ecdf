"""What users read: ordered exports, review lists, pending cases, links with both records, summaries, stage tables.

Orders are lists of sort keys, so an export sorts by them and a window may rank by them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.functions import fixed
from docledger.operators.inventory import SUCCESS

# ---- orders ----------------------------------------------------------------------------------------------------


def catalog_order() -> list[Column]:
    """Documents: by month (none first) and path."""
    return [F.col("month_number").asc_nulls_first(), F.col("relative_path").asc_nulls_first()]


def export_order(kind: str) -> list[Column]:
    """Entities and records: by path, page and type."""
    return [F.col(c).asc_nulls_first() for c in ("relative_path", "page_number", kind)]


def count_order(counted: str, name: str) -> list[Column]:
    """Summaries: the largest first, equal ones by name."""
    return [F.desc(counted), F.col(name).asc_nulls_first()]


def case_order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("period", "operation_date", "case_id")]


def month_order(folder: str) -> list[Column]:
    """Month folders by the number they lead with; those without one last, by name."""
    number = F.nullif(F.regexp_extract(folder, r"^(\d+)", 1), F.lit("")).cast("decimal(38,0)")
    return [F.coalesce(number, F.lit(99)), F.col(folder).asc_nulls_first()]


def job_order() -> list[Column]:
    """Jobs: those of most pages first, equal ones by path."""
    return [F.desc("pages"), F.col("path").asc_nulls_first()]


# ---- lists for review --------------------------------------------------------------------------------------------


def for_review(records: DataFrame) -> DataFrame:
    return records.where(~F.coalesce(F.col("confidence") == "alta", F.lit(False)))


def unclassified(documents: DataFrame) -> DataFrame:
    return documents.where("confidence = 'baja'")


def with_warning(documents: DataFrame) -> DataFrame:
    return documents.where(F.coalesce("warning", F.lit("")) != "")


def pending_cases(cases: DataFrame) -> DataFrame:
    """Payments that nothing was found for."""
    return cases.where("case_type = 'pago' and status = 'sin_conciliar'")


def link_pairs(links: DataFrame, records: DataFrame) -> DataFrame:
    """The links with type, path, page and amount of both records."""
    told = {"type": "record_type", "path": "relative_path", "page": "page_number", "amount": "amount"}
    side = lambda s: records.select(F.col("record_key").alias(f"{s}_key"), *[F.col(c).alias(f"{s}_{n}") for n, c in told.items()])
    return links.join(side("source"), "source_key").join(side("target"), "target_key")


def suggested(pairs: DataFrame) -> DataFrame:
    return pairs.where("status = 'sugerido'")


def case_members(records: DataFrame, case_records: DataFrame) -> DataFrame:
    """case_id, members: the records of each case by path, page and type.  A case's records are few."""
    order = F.struct("relative_path", "page_number", "record_type", "record_key")
    return case_records.join(records, "record_key").groupBy("case_id").agg(F.array_sort(F.collect_list(order)).alias("members"))


def amounts_by_stage(records: DataFrame, case_records: DataFrame) -> DataFrame:
    """case_id, stages: an entry for each type of record in stage order, with its distinct amounts in order."""
    rows = case_records.join(records, "record_key").groupBy("case_id", "record_type").agg(F.array_sort(F.collect_set("amount")).alias("amounts"))
    turn = F.array_position(F.array(*map(F.lit, fixed.STAGES)), F.col("record_type"))
    listed = F.array_sort(F.collect_list(F.struct(turn.alias("turn"), "record_type", "amounts")))
    pairs = F.transform(listed, lambda s: F.struct(s["record_type"].alias("record_type"), s["amounts"].alias("amounts")))
    return rows.groupBy("case_id").agg(pairs.alias("stages"))


# ---- summaries ---------------------------------------------------------------------------------------------------


def _sum(amount: Column) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(28,2)")


def monthly_records(records: DataFrame) -> DataFrame:
    """folder, record_type, records, high, review, with_amount, candidate_amount."""
    folder = F.split_part("relative_path", F.lit("/"), F.lit(1)).alias("folder")
    high = F.coalesce(F.col("confidence") == "alta", F.lit(False))
    rows = records.groupBy(folder, "record_type")
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(high).alias("high"), F.count_if(~high).alias("review"), F.count("amount").alias("with_amount"), _sum(F.col("amount")).alias("candidate_amount"))


def monthly_cases(cases: DataFrame) -> DataFrame:
    """period, cases, traced, reconciled, candidate_amount of payments."""
    rows = cases.where("case_type = 'pago'").groupBy("period")
    traced = F.count_if(F.col("record_count") > 1).alias("traced")
    reconciled = F.count_if(F.col("status") == "conciliado_banco").alias("reconciled")
    return rows.agg(F.count(F.lit(1)).alias("cases"), traced, reconciled, _sum(F.col("amount")).alias("candidate_amount"))


def _one_row(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.crossJoin(b), parts)  # aggregates of one row each


def case_summary(records: DataFrame, cases: DataFrame, links: DataFrame) -> DataFrame:
    """One row: records, cases by kind and outcome, links."""
    n = lambda name, c=None: (F.count(F.lit(1)) if c is None else F.count_if(c)).alias(name)
    kind, status = F.col("case_type"), F.col("status")
    found = cases.agg(
        n("cases"),
        n("payment_cases", kind == "pago"),
        n("payroll_cases", kind == "nomina"),
        n("linked_cases", F.col("record_count") > 1),
        n("bank_reconciled", status == "conciliado_banco"),
        n("document_traces", status == "trazabilidad_documental"),
        n("unreconciled_payments", (kind == "pago") & (status == "sin_conciliar")),
    )
    return _one_row(records.agg(n("source_records")), found, links.agg(n("accepted_links", status == "aceptado"), n("suggested_links", status == "sugerido")))


def catalog_summary(documents: DataFrame) -> DataFrame:
    """One row: documents, pages, read, to review, warnings, and the number of documents of each type as a map."""
    low, warned = F.col("confidence") == "baja", F.coalesce("warning", F.lit("")) != ""
    sums = documents.agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum("pages"), F.lit(0)).cast("long").alias("pages"),
        F.count_if(F.col("status").isin(*SUCCESS)).alias("completed"),
        F.count_if(low).alias("to_review"),
        F.count_if(warned).alias("warnings"),
    )
    kinds = documents.groupBy("primary_type").agg(F.count(F.lit(1)).alias("n")).where("primary_type is not null")
    by_type = kinds.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("primary_type", "n")))).alias("by_type"))  # types are few
    return _one_row(sums, by_type)


def payment_summary(totals: DataFrame, matches: DataFrame, found: DataFrame) -> DataFrame:
    """The control totals' row with the outcomes of the matching and the findings that count and that don't."""
    status = F.col("match_status")
    counts = matches.agg(*[F.count_if(status == s).alias(n) for n, s in (("linked_rows", "vinculado"), ("ambiguous_rows", "ambiguo"), ("unmatched_rows", "sin_coincidencia"))])
    sure = F.col("affects_confirmed_total")
    return _one_row(totals, counts, found.agg(F.count_if(sure).alias("confirmed_findings"), F.count_if(~sure).alias("review_findings")))


# ---- stage tables ------------------------------------------------------------------------------------------------


def cached_pages(documents: DataFrame, catalog: DataFrame, pages: DataFrame) -> DataFrame:
    """The stored pages of documents whose result is the one that was read; documents, catalog: document_id, hash."""
    same = documents.join(catalog.select("document_id", "hash"), ["document_id", "hash"], "left_semi").select("document_id")
    return pages.join(same, "document_id", "left_semi")


def broken(child: DataFrame, parent: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """The child's values of a column that no parent has; null refers to nothing."""
    keys = parent.select(F.col(key or column).alias(column))
    return child.where(F.col(column).isNotNull()).select(column).distinct().join(keys, column, "left_anti")


class BrokenReference(ValueError):
    pass


def save_stage(tables: dict[str, DataFrame], references: list[tuple[str, str, str, str]], save) -> None:
    """Check that every reference (child, column, parent, key) holds, then save each table by `save(name, table)`."""
    for child, column, parent, key in references:
        lost = broken(tables[child], tables[parent], column, key).limit(3).collect()
        if lost:
            raise BrokenReference(f"{child}.{column} refers to no {parent}.{key}: {[r[0] for r in lost]}")
    for name, table in tables.items():
        save(name, table)


#: (child, column, parent, key) of the stages' tables.
EXTRACTION_REFERENCES = [("entities", "document_id", "documents", "document_id"), ("records", "document_id", "documents", "document_id")]
TRACE_REFERENCES = [
    ("links", "source_key", "records", "record_key"),
    ("links", "target_key", "records", "record_key"),
    ("case_records", "record_key", "records", "record_key"),
    ("case_records", "case_id", "cases", "case_id"),
]


def metadata(values: dict[str, Column], one: DataFrame) -> DataFrame:
    """key, value rows (as text) of a one-row DataFrame, to upsert into a table of settings."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


# ---- integrity of an audit -----------------------------------------------------------------------------------------


def field_audit(fields: DataFrame, pages: DataFrame, documents: DataFrame, texts: DataFrame) -> DataFrame:
    """Fields with their page and document, and `problem`: why a row may not be trusted, null if it may.

    fields: field_id, page_id, kind, expected, observed, exact; pages: page_id, path, page; documents: path, hash,
    hash_now (as the file has it); texts: page_id, text.  A field read right must be in the page's text as words of its own,
    in either case; one read wrong must be there as it was read.
    """
    words = lambda c: F.btrim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+", " "))
    rows = fields.join(pages, "page_id", "left").join(documents, "path", "left").join(texts.withColumnRenamed("text", "page_text"), "page_id", "left")
    text = F.concat(F.lit(" "), F.regexp_replace(words(F.col("page_text")), r"(?U)[^\w\s]", " "), F.lit(" "))
    bare = F.concat(F.lit(" "), F.regexp_replace(words(F.col("expected")), r"(?U)[^\w\s]", " "), F.lit(" "))
    squeezed = lambda c: F.regexp_replace(c, " +", " ")
    seen = squeezed(text).contains(squeezed(bare))
    problem = (
        F.when(F.col("path").isNull(), "pagina_desconocida")
        .when(F.col("hash").isNull(), "documento_desconocido")
        .when(~F.col("hash").eqNullSafe(F.col("hash_now")), "documento_cambiado")
        .when(F.col("exact") & ~F.coalesce(seen, F.lit(False)), "sin_evidencia_textual")
        .when(~F.col("exact") & (F.coalesce("observed", F.lit("")) != "") & ~F.coalesce(F.col("page_text").contains(F.col("observed")), F.lit(False)), "sin_fragmento")
    )
    return rows.withColumn("problem", problem).drop("page_text")
