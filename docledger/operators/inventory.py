"""Files and their states: inventory, incremental reuse, what is pending, batch summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: States that count as success, and as failure.
SUCCESS = ["completed", "already_completed"]
FAILURES = ["failed", "encrypted", "signed", "validation_failed"]


#: What a result is known by; carried on when the file has changed, so that it can be replaced.
RESULT = ["result_path", "result_hash", "text_path", "text_hash"]


def inventory(files: DataFrame, state: DataFrame) -> DataFrame:
    """Files (path, size, hash, and pages if counted) with their earlier state.

    Kept where the hash is equal (an interrupted `processing` starts again), else pending.  What the state tells of a
    result is carried on in either case.
    """
    carried = [c for c in RESULT if c in state.columns]
    old = state.select("path", F.col("hash").alias("old_hash"), F.col("status").alias("old_status"), *carried)
    same = F.coalesce(F.col("old_hash") == F.col("hash"), F.lit(False))
    status = F.when(same & (F.col("old_status") != "processing"), F.col("old_status")).otherwise("pending")
    more = ["pages"] * ("pages" in files.columns)
    out = files.join(old, "path", "left")
    return out.select(F.sha2(F.col("path"), 256).alias("id"), "path", "size", "hash", *more, status.alias("status"), (F.col("old_hash").isNotNull() & ~same).alias("changed"), *carried)


def reusable(rows: DataFrame, results: DataFrame, with_text: bool = True) -> DataFrame:
    """The rows with `reusable`: whether the result that the state tells of is there, whole and of as many pages.

    rows: pages, result_path, result_hash, text_path, text_hash; results: path, hash, pages (null for a text) of files as they are.
    """
    now = lambda p: results.select(F.col("path").alias(f"{p}_path"), F.col("hash").alias(f"{p}_now"), F.col("pages").alias(f"{p}_pages"))
    good = (F.col("result_hash") == F.col("result_now")) & (F.col("pages") == F.col("result_pages"))
    out = rows.join(now("result"), "result_path", "left")
    if with_text:
        out = out.join(now("text"), "text_path", "left")
        good = good & (F.col("text_hash") == F.col("text_now"))
    return out.withColumn("reusable", F.coalesce(good, F.lit(False))).select(*rows.columns, "reusable")


def take_up(rows: DataFrame, only_failed: bool = False, retry: bool = False) -> DataFrame:
    """The rows with `action` of a batch run: skip, already_completed, keep_error, or run.

    rows: status, previous (the status before this inventory, null if new), reusable.
    """
    failed, done = F.col("status").isin(*FAILURES), F.col("status").isin(*SUCCESS)
    skipped = ~F.coalesce(F.col("previous").isin(*FAILURES), F.lit(False)) if only_failed else F.lit(False)
    left = failed if not (retry or only_failed) else F.lit(False)
    return rows.withColumn("action", F.when(skipped, "skip").when(done & F.col("reusable"), "already_completed").when(left, "keep_error").otherwise("run"))


def actions(documents: DataFrame, catalog: DataFrame, version: int) -> DataFrame:
    """document_id, action: reused (hash and version equal), reclassified (hash equal), analyzed, or ocr_pending."""
    known = catalog.select("document_id", F.col("hash").alias("old_hash"), F.col("schema_version").alias("old_version"))
    same = F.coalesce(F.col("old_hash") == F.col("hash"), F.lit(False))
    action = F.when(~F.col("status").isin(*SUCCESS), "ocr_pending").when(same & (F.col("old_version") == version), "reused").when(same, "reclassified").otherwise("analyzed")
    return documents.join(known, "document_id", "left").select("document_id", action.alias("action"))


def pending(rows: DataFrame, only_failed: bool = False, retry: bool = False) -> DataFrame:
    """What a batch run takes up."""
    if only_failed:
        return rows.where(F.col("status").isin(*FAILURES))
    wanted = ["pending", "processing", *(FAILURES if retry else [])]
    return rows.where(F.col("status").isin(*wanted))


def latest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """Upsert by the latest row of each key; of equally late ones, the last by all other columns."""
    rest = [F.col(c).desc_nulls_last() for c in rows.columns if c not in (*key, order)]
    w = Window.partitionBy(*key).orderBy(F.desc(order), *rest)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def replaced(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The old rows without the keys that the new rows have, and the new rows."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def batch_summary(rows: DataFrame) -> DataFrame:
    """One row: counts by outcome, pages, seconds, seconds a page (null if none)."""
    done = F.col("status").isin(*SUCCESS)
    pages = F.coalesce(F.sum(F.when(done, F.col("pages"))), F.lit(0))
    out = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "already_completed").alias("already_completed"), F.count_if(F.col("status").isin(*FAILURES)).alias("failed"), F.count_if(F.col("status") == "pending").alias("pending"), pages.alias("pages"), F.coalesce(F.sum(F.when(done, F.col("seconds"))), F.lit(0.0)).alias("seconds"))
    return out.withColumn("seconds_per_page", F.round(F.try_divide("seconds", "pages"), 4))


def frozen_mismatches(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Names whose hash differs or is on one side only (name, hash)."""
    e, f = expected.select("name", F.col("hash").alias("expected")), found.select("name", F.col("hash").alias("found"))
    return e.join(f, "name", "full").where(~F.col("expected").eqNullSafe(F.col("found")))


def log_warnings(lines: DataFrame, words: tuple[str, ...] = ("warning", "error", "timeout")) -> DataFrame:
    """document_id, page_number, warnings of log lines (line) that lead with a page number and tell of trouble."""
    page = F.nullif(F.regexp_extract("line", r"^\s*(\d+)\b", 1), F.lit("")).try_cast("int")
    rows = lines.withColumn("page_number", page).where(F.col("page_number").isNotNull() & F.lower("line").rlike("|".join(words)))
    return rows.groupBy("document_id", "page_number").agg(F.array_sort(F.collect_list(F.btrim("line"))).alias("warnings"))


def page_audit(original: DataFrame, result: DataFrame, states: DataFrame, found: DataFrame) -> DataFrame:
    """What a run did to each page of the result: characters before and after, and whether the original is intact.

    original, result: path, page, text; states: path, hash, status; found: path, hash as the file has now.
    Only states of success are told; a page that the original lacks has no characters before.
    """
    done = states.where(F.col("status").isin(*SUCCESS)).select("path", F.col("hash").alias("original_hash"))
    now = found.select("path", F.col("hash").alias("hash_now"))
    chars = F.length(F.coalesce("text", F.lit("")))
    before = original.select("path", "page", chars.alias("characters_before"))
    after = result.select("path", "page", chars.alias("characters_after"))
    out = after.join(done, "path").join(now, "path", "left").join(before, ["path", "page"], "left")
    intact = F.coalesce(F.col("hash_now") == F.col("original_hash"), F.lit(False))
    return out.select("path", "page", "original_hash", intact.alias("intact"), F.coalesce("characters_before", F.lit(0)).alias("characters_before"), "characters_after")
