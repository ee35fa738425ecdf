"""Readings of pages: scores, orientation, profiles held against a reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions import fields, fixed


def score_readings(words: DataFrame, by: list[str]) -> DataFrame:
    """Score of each reading (page and angle, say) from its words: text, confidence, box, ordinal; counted word by word.

    0.55 mean confidence + 8 ln(1 + letters and digits) + 25 plausible share + 3 headers (10 at most)
    + 2 ln(1 + typed patterns) + 30 share of words wider than high.
    """
    rows = words.where(F.btrim("text") != "")
    bare = F.btrim(F.lower("text"), F.lit(".,:$()"))
    patterns = [fixed.MONEY, r"\b\d{1,2}/\d{1,2}/\d{4}\b", *fixed.READING_PATTERNS]
    n = F.length("text")
    box = lambda i: F.element_at("box", i)
    eligible = (n > 2) & F.col("box").isNotNull()
    wide = eligible & (box(3) - box(1) > box(4) - box(2))
    plausible = bare.isin(*fixed.COMMON) | bare.rlike(r"^\d[\d.,/:-]*$")
    hits = sum((F.regexp_count("text", F.lit(p)) for p in patterns), F.lit(0))
    out = rows.groupBy(*by).agg(
        (F.sum(F.greatest(F.coalesce("confidence", F.lit(0.0)), F.lit(0.0)) * n) / F.sum(n)).alias("c"), F.sum(F.length(F.regexp_replace("text", r"(?U)[^\p{L}\p{N}]", ""))).alias("alphanumeric"), (F.count_if(plausible) / F.count(F.lit(1))).alias("p"),
        F.size(F.collect_set(F.when(bare.isin(*fixed.HEADERS), bare))).alias("headers"), F.sum(hits).alias("valid_patterns"), (F.count_if(wide) / F.greatest(F.count_if(eligible), F.lit(1))).alias("h"),
    )
    score = 0.55 * F.col("c") + 8 * F.log1p("alphanumeric") + 25 * F.col("p") + 3 * F.least("headers", F.lit(10)) + 2 * F.log1p("valid_patterns") + 30 * F.col("h")
    return out.select(*by, F.round(score, 4).alias("score"), F.round("c", 3).alias("confidence"), "alphanumeric", F.round("p", 3).alias("plausible_ratio"), "headers", "valid_patterns", F.round("h", 3).alias("horizontal_word_ratio"))


def choose_orientation(readings: DataFrame, page: str = "page_id") -> DataFrame:
    """The best angle of each page, its margin over the second and how sure it is."""
    w = Window.partitionBy(page).orderBy(F.desc("score"), "angle")
    rows = readings.withColumns({"k": F.row_number().over(w), "second": F.lead("score").over(w)}).where("k = 1")
    margin = (F.col("score") - F.col("second")) / F.greatest(F.abs("score"), F.lit(1.0))
    unclear = F.coalesce(margin < 0.06, F.lit(False)) | (F.col("confidence") < 35) | (F.col("alphanumeric") < 15)
    sure = F.when(unclear, "baja").when(margin > 0.18, "alta").otherwise("media")
    return rows.select(page, "angle", F.round(margin, 4).alias("margin"), unclear.alias("ambiguous"), sure.alias("confidence"))


def upright_conclusive(readings: DataFrame) -> DataFrame:
    """Readings at 0 degrees good enough to spare the other three."""
    return readings.where((F.col("confidence") >= 45) & (F.col("alphanumeric") >= 100) & (F.col("horizontal_word_ratio") >= 0.8) & (F.col("plausible_ratio") >= 0.15))


def region_text(words: DataFrame, regions: DataFrame) -> DataFrame:
    """page_id, field_id, raw, confidence: words whose centre lies in a region, in reading order."""
    inside = words.join(regions, "page_id")
    inside = inside.where(fields.centre_inside(F.col("box"), F.col("region")))
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "text")))
    return inside.groupBy("page_id", "field_id").agg(F.array_join(F.transform(ordered, lambda s: s["text"]), " ").alias("raw"), F.avg("confidence").alias("confidence"))


def field_records(readings: DataFrame) -> DataFrame:
    """Readings (profile, kind, raw, expected, confidence) with value, error type, exactness and issues."""
    value = fields.normalize(F.col("raw"))
    error = fields.reading_error(F.col("raw"), F.col("expected"))
    issues = fields.validate_field(F.col("kind"), F.col("raw"), F.col("confidence"))
    return readings.withColumns({"normalized": value, "error_type": error, "exact": error == "sin_error", "validators": issues, "requires_review": F.size(issues) > 0})


def total_control(readings: DataFrame, constraints: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(controls, readings): whether a total is the sum of two parts in each profile, and the readings marked where it isn't.

    readings: profile, field_id, raw, validators, requires_review; constraints: total_field, first_field;
    second: profile, total_field, value of the part that is no field itself.  `consistent` is null where a number is unreadable.
    """
    side = lambda n: readings.select("profile", F.col("field_id").alias(f"{n}_field"), F.col("raw").alias(n))
    rows = side("first").join(constraints, "first_field").join(side("total"), ["profile", "total_field"]).join(second, ["profile", "total_field"], "left")
    controls = rows.withColumn("consistent", fields.check_total(F.col("total"), F.array("first", "value"))).withColumnRenamed("value", "second")
    wrong = controls.where(~F.col("consistent")).select("profile", F.explode(F.array("total_field", "first_field")).alias("field_id")).distinct()
    marked = readings.join(wrong.withColumn("off", F.lit(True)), ["profile", "field_id"], "left")
    off = F.coalesce("off", F.lit(False))
    told = F.when(off, F.array_append("validators", F.lit("total_inconsistente_control_parcial"))).otherwise(F.col("validators"))
    return controls, marked.withColumns({"validators": told, "requires_review": F.col("requires_review") | off}).drop("off")


def chosen_reading(page: DataFrame, crop: DataFrame) -> DataFrame:
    """Of each field, the page's reading where it scores more than the crop's, else the crop's (field_id, raw, score)."""
    both = crop.join(page.select("field_id", F.struct("raw", "score").alias("p")), "field_id", "full")
    better = F.coalesce(F.col("p.score") > F.col("score"), F.col("p").isNotNull() & F.col("score").isNull())
    return both.select("field_id", F.when(better, F.col("p.raw")).otherwise(F.col("raw")).alias("raw"), F.when(better, "page").otherwise("crop").alias("source"))


def profile_accuracy(records: DataFrame, baseline: str) -> DataFrame:
    """Accuracy of each profile, in all and by kind (null: all), unnoticed errors, and the change against a baseline."""
    wrong = ~F.col("exact")
    sums = [F.count(F.lit(1)).alias("total"), F.count_if("exact").alias("exact"), F.count_if(wrong & ~F.col("requires_review")).alias("unnoticed")]
    out = records.rollup("profile", "kind").agg(*sums, F.grouping_id().alias("g")).where("g < 3").drop("g")
    base = out.where(F.col("profile") == baseline).select("kind", F.col("exact").alias("base"))
    joined = out.join(base, out["kind"].eqNullSafe(base["kind"]), "left").drop(base["kind"])
    return joined.withColumns({"percent": F.round(100 * F.col("exact") / F.col("total"), 2), "change": F.col("exact") - F.coalesce("base", F.lit(0))}).drop("base")


def promising(accuracy: DataFrame, analytic: DataFrame, total=85.0, amounts=80.0, pages=9) -> DataFrame:
    """Profiles that meet all three marks; analytic: profile, analytic_pages."""
    of = lambda kind, least: accuracy.where((F.col("kind").isNull() if kind is None else F.col("kind") == kind) & (F.col("percent") >= least)).select("profile")
    return of(None, total).intersect(of("importe", amounts)).intersect(analytic.where(F.col("analytic_pages") >= pages).select("profile"))


def recommended(accuracy: DataFrame) -> DataFrame:
    """The best profile: most exact, then fewest unnoticed errors, then the first by name."""
    return accuracy.where("kind is null").orderBy(F.desc("exact"), "unnoticed", "profile").limit(1)


def best_variant(variants: DataFrame, by: list[str], plain: str = "gray", lead: float = 1.02) -> DataFrame:
    """The best variant of each group; another than the plain one only if it beats it by the lead."""
    w = Window.partitionBy(*by)
    plain_score = F.max(F.when(F.col("variant") == plain, F.col("score"))).over(w)
    weighed = F.when((F.col("variant") != plain) & (F.col("score") <= plain_score * lead), F.lit(None)).otherwise(F.col("score"))
    order = Window.partitionBy(*by).orderBy(F.desc_nulls_last("weighed"), "variant")
    return variants.withColumn("weighed", weighed).withColumn("k", F.row_number().over(order)).where("k = 1").drop("k", "weighed")


def accuracy_breakdown(records: DataFrame) -> DataFrame:
    """Accuracy of fields (kind, document, exact) in all, by kind and by document, in one pass: level, name, fields, exact, percent."""
    level = F.grouping_id("kind", "document")
    out = records.groupingSets([["kind"], ["document"], []], "kind", "document").agg(level.alias("g"), F.count(F.lit(1)).alias("fields"), F.count_if("exact").alias("exact"))
    named = F.when(F.col("g") == 1, "tipo").when(F.col("g") == 2, "documento").otherwise("total")
    return out.select(named.alias("level"), F.when(F.col("g") == 1, F.col("kind")).when(F.col("g") == 2, F.col("document")).alias("name"), "fields", "exact", F.round(100 * F.col("exact") / F.col("fields"), 2).alias("percent"))


def timings(runs: DataFrame, orientation: DataFrame, plain: str = "A") -> DataFrame:
    """profile, total_seconds, seconds_per_page of runs (profile, page_id, seconds).

    Every profile but the plain one bears the seconds of the shared orientation (seconds: decimal, one row each).
    """
    shared = orientation.agg(F.coalesce(F.sum("seconds"), F.lit(0)).alias("shared"))
    out = runs.groupBy("profile").agg(F.sum("seconds").alias("own"), F.countDistinct("page_id").alias("pages")).crossJoin(F.broadcast(shared))  # one row
    total = F.coalesce("own", F.lit(0)) + F.when(F.col("profile") == plain, 0).otherwise(F.col("shared"))
    return out.select("profile", F.round(total, 2).cast("decimal(18,2)").alias("total_seconds"), F.round(F.try_divide(total, F.col("pages")).cast("double"), 2).alias("seconds_per_page"))
