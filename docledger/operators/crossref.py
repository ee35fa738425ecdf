"""External payment rows against documents: scores, ranks, the record that proves a payment, findings.

A row and a document meet by month and by one of: a number of the path, a folio, an amount, or a number in the
evidence: four equi-joins whose keys are put together, so no month is multiplied out.  (A concept alone gives
ten points, under the 55 that count.)  Payments: excel_row, account, origin, month, amount, amount_status, concept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions import fixed
from docledger.functions import text as x
from docledger.operators.linkage import points

MARGIN, LEAST, SURE = 10, 55, 80


def document_index(records: DataFrame) -> DataFrame:
    """One row a path: month, numbers of the path, amounts, folios, words and evidence of its records."""
    order = F.struct("page_number", "record_key")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.coalesce("evidence", F.lit("")).alias("e")))), lambda s: s["e"]), " ")
    concepts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.concat_ws(" ", "concept", "evidence").alias("c")))), lambda s: s["c"]), " ")
    out = records.groupBy("relative_path").agg(F.collect_set("amount").alias("amounts"), F.collect_set(F.when(F.coalesce("folio", F.lit("")) != "", x.identifier(F.col("folio")))).alias("folios"), x.fold(joined).alias("evidence"), x.concept_words(concepts).alias("words"))
    numbers = F.array_distinct(F.transform(F.regexp_extract_all("evidence", F.lit(r"\b(?:CH|TRANSF|FOLIO)\s*[:#-]?\s*(\d+)\b"), F.lit(1)), x.identifier))
    return out.withColumns({"month": x.path_month(F.col("relative_path")), "numbers": x.path_numbers(F.col("relative_path")), "stem": x.fold(x.file_stem(F.col("relative_path"))), "told": numbers})


def _asked(payments: DataFrame) -> DataFrame:
    month = F.coalesce(x.month_number(F.left(x.fold(F.coalesce("month", F.lit(""))), F.lit(3))), F.lit(0))
    return payments.select("excel_row", F.col("amount").alias("asked"), month.alias("month"), x.identifier(F.col("account")).alias("ident"), x.fold(F.coalesce("account", F.lit(""))).startswith("POL").alias("policy"), x.concept_words(F.col("concept")).alias("asked_words"))


def scored(payments: DataFrame, documents: DataFrame) -> DataFrame:
    """excel_row, relative_path, score, reasons of the pairs that score enough."""
    rows = _asked(payments)
    in_month = documents.select("month", "relative_path", F.explode("amounts").alias("a")).groupBy("month", "a").agg(F.count(F.lit(1)).alias("n"), F.min("relative_path").alias("only_path")).where("n = 1")
    money = documents.select("month", "relative_path", F.explode(F.transform("amounts", lambda a: F.concat(F.lit("a"), a.cast("string")))).alias("key"))
    ids = documents.select("month", "relative_path", F.explode(F.transform(F.array_union(F.array_union("numbers", "folios"), "told"), lambda n: F.concat(F.lit("n"), n))).alias("key"))
    wanted = rows.select("excel_row", "month", F.explode(F.array_compact(F.array(F.concat(F.lit("n"), F.col("ident")), F.concat(F.lit("a"), F.col("asked").cast("string"))))).alias("key"))
    met = wanted.join(money.unionAll(ids), ["month", "key"]).select("excel_row", "relative_path").distinct()
    pairs = met.join(rows, "excel_row").join(documents.drop("month"), "relative_path")
    pairs = pairs.join(in_month.select("month", F.col("a").alias("asked"), "only_path"), ["month", "asked"], "left")
    has = F.array_contains
    in_path = has("numbers", F.col("ident"))
    named = F.col("policy") & F.col("stem").contains("POLIZA") & in_path
    known = F.col("ident") != "0"
    share = F.size(F.array_intersect("asked_words", "words")) / F.when(F.size("asked_words") > 0, F.size("asked_words"))
    exact = F.coalesce(has("amounts", F.col("asked")), F.lit(False))
    score, reasons = points(
        ("poliza_en_nombre_archivo", named, 100), ("identificador_en_nombre_archivo", ~F.col("policy") & in_path, 80), ("folio_exacto", known & has("folios", F.col("ident")), 65), ("identificador_en_evidencia", known & has("told", F.col("ident")), 55),
        ("importe_exacto", exact, 25), ("importe_unico_en_mes", exact & (F.col("only_path") == F.col("relative_path")), 40), ("concepto_coincidente", share >= 0.6, 10),
    )
    return pairs.where(~F.col("policy") | named).select("excel_row", "relative_path", score.alias("score"), reasons.alias("reasons")).where(F.col("score") >= LEAST)


def ranked(pairs: DataFrame, keep: int = 3) -> DataFrame:
    """The best documents of each row: rank, ambiguous (the second within the margin), status."""
    w = Window.partitionBy("excel_row").orderBy(F.desc("score"), F.desc("relative_path"))
    out = pairs.withColumns({"rank": F.row_number().over(w), "next": F.lead("score").over(w)}).where(F.col("rank") <= keep)
    out = out.withColumn("ambiguous", F.first(F.coalesce(F.col("next") >= F.col("score") - MARGIN, F.lit(False))).over(w))
    return out.withColumn("status", F.when((F.col("rank") == 1) & ~F.col("ambiguous"), "aceptado").otherwise("sugerido")).drop("next")


def matched(payments: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a row for each payment with its match and evidence, the links of up to three documents)."""
    links = ranked(scored(payments, document_index(records)))
    best = links.where("rank = 1").select("excel_row", "relative_path", "score", "reasons", "ambiguous")
    paid_rank = F.when(F.col("record_type") == fixed.TRANSFER, 3).when(F.col("record_type") == fixed.CHEQUE, 2).when(F.col("record_type") == fixed.BANK, 1).otherwise(0)
    rows = payments.select("excel_row", "amount").join(best, "excel_row").join(records.select("relative_path", "record_key", "record_type", "page_number", F.col("amount").alias("found"), "evidence").withColumn("paid_rank", paid_rank), "relative_path")
    exact = F.coalesce(F.col("found") == F.col("amount"), F.lit(False))
    # Proof: an exact amount first (in page order), else a payment (best type, last page), else the first record.
    kind = F.when(exact, 0).when(F.col("paid_rank") > 0, 1).otherwise(2)
    page = F.when(exact | (F.col("paid_rank") == 0), F.col("page_number")).otherwise(-F.col("page_number"))
    order = F.struct(kind.alias("k"), F.when(exact, 0).otherwise(-F.col("paid_rank")).alias("t"), page.alias("p"), F.col("record_key"))
    shown = F.format_number(F.col("amount"), 2)
    is_paid = F.col("paid_rank") > 0
    proof = rows.groupBy("excel_row").agg(
        F.min_by(F.struct("record_key", "record_type", "page_number", "found"), order).alias("e"), F.array_sort(F.collect_set(F.when(is_paid, F.col("found")))).alias("paid_amounts"), F.min_by("page_number", F.when(is_paid & F.col("found").isNotNull(), F.struct(-F.col("paid_rank"), -F.col("page_number")))).alias("paid_page"),
        F.coalesce(F.max(is_paid & F.coalesce(F.col("evidence").contains(shown), F.lit(False))), F.lit(False)).alias("amount_in_paid_evidence"),
    )
    paid = F.when(F.size("paid_amounts") == 1, F.element_at("paid_amounts", 1))
    status = F.when(F.col("score").isNull(), "sin_coincidencia").when(F.col("ambiguous"), "ambiguo").otherwise("vinculado")
    sure = F.when(F.col("score").isNull(), "baja").when(F.col("ambiguous") | (F.col("score") < SURE), "media").otherwise("alta")
    out = payments.join(best, "excel_row", "left").join(proof, "excel_row", "left").withColumn("paid_amount", paid)
    out = out.select(*payments.columns, status.alias("match_status"), sure.alias("match_confidence"), F.coalesce("score", F.lit(0)).cast("int").alias("match_score"), F.coalesce("reasons", F.array().cast("array<string>")).alias("match_reasons"), F.col("relative_path").alias("matched_path"), F.col("e.record_key").alias("matched_record_key"), F.col("e.record_type").alias("matched_type"), F.col("e.page_number").alias("matched_page"), F.col("e.found").alias("source_amount"), (F.col("e.found") - F.col("amount")).cast("decimal(18,2)").alias("amount_difference"), "paid_amounts", "paid_amount", "paid_page", (F.col("paid_amount") - F.col("amount")).cast("decimal(18,2)").alias("paid_difference"), F.coalesce("amount_in_paid_evidence", F.lit(False)).alias("amount_in_paid_evidence"))
    return out, links


def duplicates(payments: DataFrame) -> DataFrame:
    """Groups of rows of equal account, month, amount and concept: account, amount, rows, n."""
    keys = [x.fold(F.coalesce("account", F.lit(""))).alias("a"), F.col("month"), F.col("amount"), x.fold(F.coalesce("concept", F.lit(""))).alias("c")]
    out = payments.where("amount is not null").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("excel_row")).alias("rows"), F.min_by("account", "excel_row").alias("account"))
    return out.where("n > 1").select("account", "month", "amount", "rows", "n")


def findings(payments: DataFrame, matches: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """kind, excel_rows, account, current_amount, proposed_amount, adjustment, confidence, affects_confirmed_total, evidence.

    `expected`: corrections known from elsewhere, as rows of these columns, taken as they are.
    """
    money = lambda c: c.cast("decimal(18,2)")
    none = F.lit(None).cast("decimal(18,2)")

    def found(rows, kind, numbers, current, proposed, adjustment, sure, counts, evidence):
        return rows.select(F.lit(kind).alias("kind"), numbers.alias("excel_rows"), "account", money(current).alias("current_amount"), money(proposed).alias("proposed_amount"), money(adjustment).alias("adjustment"), sure.alias("confidence"), F.lit(counts).alias("affects_confirmed_total"), evidence.alias("evidence"))

    one = F.array("excel_row")
    text = found(matches.where("amount_status = 'recuperado_separadores'"), "importe_como_texto", one, none, F.col("amount"), F.col("amount"), F.lit("alta"), True, F.col("matched_path"))
    where = matches.select(F.col("excel_row").alias("first_row"), "match_status", "matched_path")
    twice = duplicates(payments).withColumn("first_row", F.element_at("rows", 1)).join(where, "first_row", "left")
    extra = F.col("n") - 1
    double = found(twice, "duplicado_probable", F.col("rows"), F.col("amount") * F.col("n"), F.col("amount"), -F.col("amount") * extra, F.when(F.col("match_status") == "vinculado", "alta").otherwise("media"), True, F.col("matched_path"))
    known = text.unionByName(double)
    if expected is not None:
        known = known.unionByName(expected)
    told = known.select(F.explode("excel_rows").alias("excel_row")).distinct()
    rest = matches.join(told, "excel_row", "left_anti").where((F.abs("paid_difference") >= F.lit("0.01").cast("decimal(3,2)")) & ~F.col("amount_in_paid_evidence"))
    differs = found(rest, "diferencia_con_pago_documentado", one, F.col("amount"), F.col("paid_amount"), F.col("paid_difference"), F.lit("media"), False, F.concat_ws(", página ", "matched_path", F.col("paid_page").cast("string")))
    return known.unionByName(differs)


def control_totals(payments: DataFrame, found: DataFrame, stated_total=None, target=None) -> DataFrame:
    """One row: rows, sum, the sheet's total (a stated 0 counts as none), confirmed adjustment, adjusted total and gap."""
    sums = payments.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(28,2)").alias("sum_of_rows"))
    fix = found.agg(F.coalesce(F.sum(F.when(F.col("affects_confirmed_total"), F.col("adjustment"))), F.lit(0)).cast("decimal(28,2)").alias("confirmed_adjustment"))
    stated = F.lit(stated_total).cast("decimal(28,2)")
    total = F.when(stated != 0, stated).otherwise(F.col("sum_of_rows"))
    out = sums.crossJoin(fix).withColumn("worksheet_total", total)  # one row by one row
    out = out.withColumn("adjusted_total", (F.col("worksheet_total") + F.col("confirmed_adjustment")).cast("decimal(28,2)"))
    return out.withColumn("gap", (F.lit(target).cast("decimal(28,2)") - F.col("adjusted_total")).cast("decimal(28,2)"))
