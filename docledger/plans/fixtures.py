"""Deterministic inputs of the named queries, made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.functions import fixed


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, doc, amount, day (twenty years on), status."""
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.add_months(F.to_date("o_orderdate"), 240).alias("day"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


def money(amount: Column) -> Column:
    return F.format_number(amount, 2)


def vouchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page an order, rendered as one of four kinds of paper by the key's remainder of 4."""
    o = orders(spark, sf_dir)
    key, day = F.col("k").cast("string"), F.date_format("day", "dd/MM/yyyy")
    uuid = F.concat(F.lit("ABCDEF01-2345-4678-9ABC-"), F.lpad(key, 12, "0"))
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("\n"))
    payroll = F.concat(line("RECIBO ", F.lit("NETO DEL RECIBO: ")), line("NETO DEL RECIBO $ ", money(F.col("amount"))), line("PERCEPCIONES Y DEDUCCIONES"), line("FECHA PAGO: ", day), line("FOLIO FISCAL ", uuid))
    cheque = F.concat(line("IMPORTE $", money(F.col("amount"))), line("PAGUESE POR ESTE CHEQUE A: "), line("PROVEEDOR DEL NORTE"), line("CHEQUE NUMERO ", key), line("POR CONCEPTO DE: SERVICIOS VARIOS"), line("FECHA: ", day))
    transfer = F.concat(line("BANCA NET CASH"), line("FOLIO DEL LOTE: L-", F.lpad(key, 8, "0")), line("CUENTA DE CARGO: 0123456789"), line("IMPORTE TOTAL: $", money(F.col("amount"))), line("FECHA DE OPERACION: ", day))
    policy = F.concat(line("POLIZAS DE PAGO FOLIO: P-", F.lpad(key, 8, "0")), line(day, " BANCOS ", money(F.col("amount"))), line(day, " PROVEEDORES ", money(F.col("amount"))), line("TOTAL $ ", money(F.col("amount") * 2)), line("(PROVEEDOR DEL SUR)"))
    kind = F.col("k") % 4
    text = F.when(kind == 0, payroll).when(kind == 1, cheque).when(kind == 2, transfer).otherwise(policy)
    return o.select(F.concat(F.lit("D"), F.col("c")).alias("document_id"), F.concat(F.month("day").cast("string"), F.lit(". Mes/D"), F.col("c"), F.lit(".pdf")).alias("relative_path"), (F.col("k") % 40).cast("int").alias("page_number"), text.alias("text"), F.month("day").alias("month_number"), F.year("day").alias("year"), "k", "amount", "day")


def ledger(spark: SparkSession, sf_dir: str, round_to: int | None = None) -> DataFrame:
    """Records of four kinds from orders: a policy each; cheques, transfers and bank rows of some."""
    o = orders(spark, sf_dir)
    k, none = F.col("k"), F.lit(None).cast("string")
    amount = F.col("amount") if not round_to else (F.round(F.col("amount") / round_to) * round_to).cast("decimal(18,2)")

    def part(kind: str, letter: str, keep: Column, a: Column, page: Column, days: Column, folio: Column, evidence: Column, doc: Column) -> DataFrame:
        return o.where(keep).select(
            F.concat(F.lit(letter), k).alias("record_key"), F.lit(kind).alias("record_type"), doc.alias("document_id"), F.concat(F.month("day").cast("string"), F.lit(". Mes/"), doc, F.lit(".pdf")).alias("relative_path"), page.cast("int").alias("page_number"),
            F.lit("alta").alias("confidence"), a.cast("decimal(18,2)").alias("amount"), F.date_add("day", days.cast("int")).cast("string").alias("operation_date"), none.alias("beneficiary"), folio.alias("folio"), none.alias("reference"), none.alias("concept"), evidence.alias("evidence"),
        )

    doc = F.concat(F.lit("D"), F.col("c"))
    page = k % 40
    key = k.cast("string")
    all_ = part(fixed.POLICY, "P", F.lit(True), amount, page, F.lit(0), none, F.when(k % 4 == 0, F.concat(F.lit("PAGO CON CH-"), key)).otherwise("PAGO"), doc)
    all_ = all_.unionByName(part(fixed.CHEQUE, "C", k % 3 != 0, amount + F.when(k % 5 == 0, 1).otherwise(0), page + k % 12, k % 9, key, none, doc))
    all_ = all_.unionByName(part(fixed.TRANSFER, "T", k % 11 == 0, amount, page + k % 7, k % 4, F.when(k % 2 == 0, key), none, doc))
    return all_.unionByName(part(fixed.BANK, "B", k % 7 == 0, amount, page, k % 10, none, none, F.concat(F.lit("S"), k % 100)))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet row for every third order: the account is the order's key, the month its name; some amounts damaged."""
    names = F.create_map(*[F.lit(v) for pair in enumerate(["ENE", "FEB", "MAR", "ABR", "MAY", "JUN", "JUL", "AGO", "SEP", "OCT", "NOV", "DIC"], 1) for v in pair])
    o = orders(spark, sf_dir).where("k % 3 = 0")
    plain = F.col("amount").cast("string")
    raw = F.when(F.col("k") % 17 == 0, F.replace(money(F.col("amount")), F.lit(","), F.lit("."))).when(F.col("k") % 19 == 0, "sin dato").otherwise(plain)
    return o.select(F.col("k").cast("int").alias("excel_row"), F.col("k").cast("string").alias("account"), F.lit("banco").alias("origin"), F.element_at(names, F.month("day")).alias("month"), raw.alias("amount_raw"), F.concat(F.lit("SERVICIO "), F.col("priority")).alias("concept"), F.col("amount").alias("true_amount"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as states of files: status by the type, pages and seconds from the value."""
    e = read(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "click", "completed").when(F.col("event_type") == "view", "already_completed").when(F.col("event_type") == "purchase", "failed").when(F.col("event_type") == "signup", "encrypted").otherwise("pending")
    return e.select("event_id", "user_id", status.alias("status"), (F.col("event_id") % 20).alias("pages"), F.round("value", 2).alias("seconds"))
