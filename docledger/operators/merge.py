"""Consolidation of records: one row for each key, names by identity, support by equal amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions import fixed


def merge_records(records: DataFrame) -> DataFrame:
    """For each record_key the first non-empty value of each column in page order, all evidence pages, and the
    better confidence.  A group is the copies of one record in a document, which are few."""
    order = F.struct("page_number", "ordinal") if "ordinal" in records.columns else F.struct("page_number")
    names = [c for c in records.columns if c not in ("record_key", "confidence", "extra", "ordinal")]
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), order)).alias(c) for c in names]
    best = F.when(F.max((F.col("confidence") == "alta").cast("int")) == 1, "alta").otherwise(F.min_by("confidence", order)).alias("confidence")
    out = records.groupBy("record_key").agg(*firsts, best, F.array_sort(F.collect_set("page_number")).alias("evidence_pages"), *([_merged_extra(order)] if "extra" in records.columns else []))
    return out


def _merged_extra(order):
    maps = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.map_entries("extra").alias("e")))), lambda s: F.map_from_entries(s["e"]))
    earlier = F.aggregate(maps, F.create_map().cast("map<string,string>"), lambda a, m: F.map_concat(a, F.map_filter(m, lambda k, v: ~F.map_contains_key(a, k))))
    return earlier.alias("extra")


def infer_names(records: DataFrame) -> DataFrame:
    """Payroll records without a name take the one that their identities (curp, rfc) mostly have.

    A name counts once for each identity it shares; of equals, the first in record order (page, key).
    Adds inferred_name_support, null where nothing was inferred.
    """
    ids = F.array_compact(F.array(F.col("curp"), F.col("rfc")))
    pay = records.where(F.col("record_type") == fixed.PAYROLL).withColumn("identity", F.explode(ids))
    known = pay.where("beneficiary is not null").groupBy("identity", "beneficiary").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("document_id", "page_number", "record_key")).alias("seen"))
    asked = pay.where("beneficiary is null").select("record_key", "identity")
    votes = asked.join(known, "identity").groupBy("record_key", "beneficiary").agg(F.sum("n").alias("n"), F.min("seen").alias("seen"))
    best = Window.partitionBy("record_key").orderBy(F.desc("n"), "seen")
    won = votes.withColumn("place", F.row_number().over(best)).where("place = 1").select("record_key", F.col("beneficiary").alias("inferred"), F.col("n").alias("inferred_name_support"))
    out = records.join(won, "record_key", "left")
    return out.withColumn("beneficiary", F.coalesce("beneficiary", "inferred")).drop("inferred")


def corroborate(records: DataFrame) -> DataFrame:
    """Policies with a cheque or transfer of the same amount in the document become certain, and take its payee
    (the commonest, the first in order of equals) where they have none.  Adds cross_support."""
    backing = records.where(F.col("record_type").isin(fixed.CHEQUE, fixed.TRANSFER) & F.col("amount").isNotNull())
    kinds = backing.groupBy("document_id", "amount").agg(F.array_sort(F.collect_set("record_type")).alias("cross_support"))
    names = backing.where("beneficiary is not null").groupBy("document_id", "amount", "beneficiary").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page_number", "record_key")).alias("seen"))
    best = Window.partitionBy("document_id", "amount").orderBy(F.desc("n"), "seen")
    names = names.withColumn("place", F.row_number().over(best)).where("place = 1").select("document_id", "amount", F.col("beneficiary").alias("payee"))
    support = kinds.join(names, ["document_id", "amount"], "left").withColumn("record_type", F.lit(fixed.POLICY))
    out = records.join(support, ["record_type", "document_id", "amount"], "left")
    backed = F.col("cross_support").isNotNull()
    return out.withColumns({"confidence": F.when(backed, "alta").otherwise(F.col("confidence")), "beneficiary": F.coalesce("beneficiary", F.when(backed, F.col("payee")))}).drop("payee").select(*records.columns, "cross_support")
