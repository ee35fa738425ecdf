"""Documents and their pages: roll-up, dates, terms, classification, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions import fixed
from docledger.functions import text as x


def roll_up(pages: DataFrame) -> DataFrame:
    """One row a document: pages, characters, pages with text, coverage."""
    n = F.length(F.coalesce("text", F.lit("")))
    out = pages.groupBy("document_id").agg(F.count(F.lit(1)).cast("int").alias("pages"), F.sum(n).cast("long").alias("text_characters"), F.count_if(F.btrim(F.coalesce("text", F.lit(""))) != "").cast("int").alias("pages_with_text"))
    return out.withColumn("coverage", x.coverage_label(F.col("pages"), F.col("pages_with_text"), F.col("text_characters")))


def page_text(pages: DataFrame, separator: str = "\n\f\n") -> DataFrame:
    """document_id, text: the pages in order with a separator between."""
    parts = F.array_sort(F.collect_list(F.struct("page_number", F.coalesce("text", F.lit("")).alias("text"))))
    return pages.groupBy("document_id").agg(F.array_join(F.transform(parts, lambda p: p["text"]), separator).alias("text"))


def dates(texts: DataFrame) -> DataFrame:
    """document_id, date, occurrences: days written in numbers (20yy) or in Spanish; impossible days are dropped."""
    f = x.fold(F.col("text"))
    names = "|".join(k for k in fixed.MONTHS if len(k) > 3 or k == "MAYO")
    numeric = F.transform(F.regexp_extract_all(f, F.lit(r"(?<!\d)(\d{1,2}[/-]\d{1,2}[/-]20\d{2})(?!\d)"), F.lit(1)), x.numeric_date)
    written = rf"(?<!\d)(\d{{1,2}})\s+DE\s+({names})\s+DE\s+(20\d{{2}})"
    spoken = F.transform(F.regexp_extract_all(f, F.lit(f"({written})"), F.lit(1)), lambda d: x.make_day(F.regexp_extract(d, written, 1), x.month_number(F.regexp_extract(d, written, 2)).cast("string"), F.regexp_extract(d, written, 3)))
    rows = texts.select("document_id", F.explode(F.concat(numeric, spoken)).alias("date")).where("date is not null")
    return rows.groupBy("document_id", "date").agg(F.count(F.lit(1)).alias("occurrences"))


def document_year(documents: DataFrame, found: DataFrame, default: int = 2021) -> DataFrame:
    """document_id, year: the path's, else the commonest of the dates found, else of date_min or date_max, else the default."""
    years = found.groupBy("document_id", F.year("date").alias("y")).agg(F.sum("occurrences").alias("n"), F.min("date").alias("first"))
    best = years.groupBy("document_id").agg(F.max_by("y", F.struct("n", -F.unix_date("first"))).alias("seen"))
    year_of = lambda c: F.when(F.col(c).cast("string").rlike("^20[0-9]{2}"), F.left(F.col(c).cast("string"), F.lit(4)).cast("int"))
    path = F.nullif(F.regexp_extract(F.coalesce("relative_path", F.lit("")), r"(20\d{2})", 1), F.lit("")).cast("int")
    extra = [year_of(c) for c in ("date_min", "date_max") if c in documents.columns]
    return documents.join(best, "document_id", "left").select("document_id", F.coalesce(path, "seen", *extra, F.lit(default)).alias("year"))


def terms(texts: DataFrame, limit: int = 15) -> DataFrame:
    """document_id, term, occurrences, rank: the commonest words of four letters or more, the first seen of equals."""
    words = F.regexp_extract_all(F.upper("text"), F.lit("([A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ]{3,})"), F.lit(1))
    rows = texts.select("document_id", F.posexplode(words).alias("pos", "term")).where(~F.lower(x.fold(F.col("term"))).isin(*fixed.STOPWORDS))
    counted = rows.groupBy("document_id", "term").agg(F.count(F.lit(1)).alias("occurrences"), F.min("pos").alias("pos"))
    order = Window.partitionBy("document_id").orderBy(F.desc("occurrences"), "pos")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).drop("pos")


def classify(documents: DataFrame, rules=None, limit: int = 150_000) -> DataFrame:
    """document_id, primary_type, confidence, contained_types, scores (struct type, score; best first).

    Documents: document_id, file_name, text.  All rules are one projection over the document, without a join:
    sums of the points of the patterns found in the folded name and the folded beginning of the text.
    """
    rules = fixed.CLASS_RULES if rules is None else rules
    kinds = list(dict.fromkeys(r[0] for r in rules))
    docs = documents.select("document_id", x.fold(F.coalesce("file_name", F.lit(""))).alias("name"), F.left(x.fold(F.left(F.coalesce("text", F.lit("")), F.lit(limit))), F.lit(limit)).alias("text"))

    def total(kind: str, where: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.col(w).rlike("(?s)" + p), points).otherwise(0) for k, w, p, points in rules if k == kind and w in where], F.lit(0))

    rows = docs.select("document_id", F.array(*[F.struct(total(k, ("name", "text")).alias("score"), F.lit(-i).alias("turn"), total(k, ("name",)).alias("named"), F.lit(k).alias("type")) for i, k in enumerate(kinds)]).alias("all"))
    ordered = F.reverse(F.array_sort("all"))  # equal scores in the rules' order
    rows = rows.withColumn("all", ordered)
    first, second = F.element_at("all", 1), F.element_at("all", 2)
    leaders = F.filter("all", lambda s: (s["named"] > 0) & (s["named"] == F.array_max(F.transform("all", lambda t: t["named"]))))
    lead = F.array_max(F.transform(leaders, lambda s: s["turn"]))
    named_type = F.element_at(F.filter(leaders, lambda s: s["turn"] == lead), 1)["type"]
    margin = first["score"] - second["score"]
    by_margin = F.when((first["score"] >= 8) & (margin >= 3), "alta").when(margin >= 2, "media").otherwise("baja")
    sure = F.when(first["score"] < 4, "baja").when(F.size(leaders) == 1, "alta").otherwise(by_margin)
    kind = F.when(sure == "baja", fixed.OTHER).when(F.size(leaders) > 0, named_type).otherwise(first["type"])
    contained = F.transform(F.filter("all", lambda s: s["score"] >= 4), lambda s: s["type"])
    return rows.select("document_id", kind.alias("primary_type"), sure.alias("confidence"), contained.alias("contained_types"), F.transform(F.filter("all", lambda s: s["score"] > 0), lambda s: F.struct(s["type"].alias("type"), s["score"].alias("score"))).alias("scores"))


def catalog(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """One row a document: roll-up, period, class, dates (the 50 first) and terms (15).  Documents: document_id, relative_path."""
    texts = page_text(pages)
    found = dates(texts)
    listed = found.groupBy("document_id").agg(F.min("date").alias("date_min"), F.max("date").alias("date_max"), F.slice(F.array_sort(F.collect_list(F.struct("date", "occurrences"))), 1, 50).alias("detected_dates"))
    words = terms(texts).groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term", "occurrences"))), lambda t: F.struct(t["term"].alias("term"), t["occurrences"].alias("occurrences"))).alias("frequent_terms"))
    kinds = classify(texts.join(documents.select("document_id", F.substring_index("relative_path", "/", -1).alias("file_name")), "document_id", "left")).drop("scores")
    period = x.folder_period(F.col("relative_path"))
    out = documents.select("document_id", "relative_path", period.alias("p")).select("document_id", "relative_path", "p.month_number", "p.folder")
    return reduce(lambda a, b: a.join(b, "document_id", "left"), [roll_up(pages), kinds, listed, words], out)


def summary(documents: DataFrame, by: list[str]) -> DataFrame:
    """Documents and pages by columns, each total and the grand total: grouping sets."""
    sets = [[F.col(c)] for c in by]
    out = documents.groupingSets(sets + [[]], *map(F.col, by)) if hasattr(documents, "groupingSets") else documents.rollup(*by)
    return out.agg(F.count(F.lit(1)).alias("documents"), F.sum("pages").cast("long").alias("pages"))
