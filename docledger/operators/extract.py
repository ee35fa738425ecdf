"""Pages to entities and to typed records.

Every extractor is a projection of the page text, so extraction is one narrow pass; gates are plain filters
before the costlier patterns.  Pages: document_id, relative_path, page_number, text (and month_number, year).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.functions import fixed
from docledger.functions import text as x


def held(rows: DataFrame, **values: Column) -> DataFrame:
    """The rows with more columns, each computed once: a plan may not copy them into what uses them, as into a lambda.

    Of an array of one struct, explode makes the row again.
    """
    one = F.explode(F.array(F.struct(*[v.alias(k) for k, v in values.items()])))
    return rows.select("*", one.alias("held")).select(*rows.columns, *[F.col(f"held.{k}").alias(k) for k in values])


def found_in(text: Column, pattern: str, flags: str = "(?s)") -> tuple[Column, Column, Column]:
    """Of a pattern with one group: chunks (each up to the end of a match), whole matches, and values.

    Each search starts where the match before ended and nowhere else, so a text without matches is read once.
    """
    whole = F.lit(rf"{flags}\G(?s:.*?)({pattern})")
    return F.regexp_extract_all(text, whole, F.lit(0)), F.regexp_extract_all(text, whole, F.lit(1)), F.regexp_extract_all(text, whole, F.lit(2))


def placed(chunks: Column, wholes: Column, values: Column) -> Column:
    """Array of struct(value, start, end): offsets from 0 of the whole matches."""

    def place(value: Column, k: Column) -> Column:
        end = F.aggregate(F.slice(chunks, 1, k + 1), F.lit(0), lambda a, c: a + F.length(c))
        return F.struct(value.alias("value"), (end - F.length(F.get(wholes, k))).alias("start"), end.alias("end"))

    return F.transform(values, place)


def entities(pages: DataFrame) -> DataFrame:
    """document_id, relative_path, page_number, entity_type, value, normalized_value, label, confidence, snippet.

    Of equal (type, normalised value, label) on a page the first stays.  All is done within the page's row, without a
    shuffle: the text is folded once, all patterns are searched, and what is found is told apart and put in rows.
    """
    rows = held(pages.select("document_id", "relative_path", "page_number", "text"), upper=F.upper("text"), folded=x.fold(F.col("text")))
    digits = lambda v: F.regexp_replace(v, r"\s+", "")
    sure = lambda v: F.coalesce(x.valid_embedded_date(v), F.lit(False))
    always = lambda label: lambda n, m: (F.lit(label), F.lit("alta"))
    identity = lambda name, good: lambda n, m: (F.when(good(n), name).otherwise(f"{name} con posible error OCR"), F.when(good(n), "alta").otherwise("media"))

    def amount_label(n: Column, m: Column) -> tuple[Column, Column]:
        before = x.fold(F.substring(F.col("text"), F.greatest(m["start"] - 70, F.lit(0)) + 1, F.least(m["start"], F.lit(70))))
        (first, told), *rest = fixed.AMOUNT_LABELS
        label = reduce(lambda c, pair: c.when(before.contains(pair[0]), pair[1]), rest, F.when(before.contains(first), told))
        return label.otherwise("importe mencionado"), F.when(label.isNotNull() | m["value"].contains("$"), "alta").otherwise("media")

    kinds = [  # type, text searched, pattern, normalised value, (label, confidence), what is kept
        ("rfc", "upper", fixed.RFC, digits, identity("RFC", sure), None),
        ("curp", "upper", fixed.CURP, digits, identity("CURP", lambda n: sure(n) & n.rlike(r"\d$")), None),
        ("clabe", "upper", fixed.CLABE, lambda v: v, always("CLABE o número de 18 dígitos"), None),
        ("uuid", "upper", fixed.UUID, lambda v: v, always("UUID fiscal"), None),
        ("cuenta", "folded", fixed.ACCOUNT, lambda v: F.regexp_replace(v, r"\D", ""), always("cuenta etiquetada"), lambda n: F.length(n).between(8, 20)),
        ("folio_referencia", "folded", fixed.FOLIO, lambda v: F.btrim(F.upper(v), F.lit("-_/")), always("folio o referencia"), lambda n: F.length(n) >= 4),
        ("fecha", "folded", fixed.DATE, lambda v: x.numeric_date(v).cast("string"), always("fecha numérica"), None),
        ("importe", "text", fixed.MONEY, lambda v: x.money_value(v).cast("string"), amount_label, None),
    ]
    names = ("chunks", "wholes", "values")
    rows = held(rows, **{f"{n}{i}": c for i, k in enumerate(kinds) for n, c in zip(names, found_in(F.col(k[1]), k[2]))})
    normal = lambda i, value: F.transform(placed(*[F.col(f"{n}{i}") for n in names]), lambda m: F.struct(m["value"].alias("value"), m["start"].alias("start"), m["end"].alias("end"), value(m["value"]).alias("normalized_value")))
    rows = held(rows, **{f"found{i}": normal(i, k[3]) for i, k in enumerate(kinds)})

    def told(i: int, kind: str, scanned: str, label, keep) -> Column:
        kept = F.filter(F.col(f"found{i}"), lambda m: m["normalized_value"].isNotNull() & (keep(m["normalized_value"]) if keep else F.lit(True)))

        def entity(m: Column) -> Column:
            says, confidence = label(m["normalized_value"], m)
            return F.struct(F.lit(kind).alias("entity_type"), m["value"].alias("value"), m["normalized_value"].alias("normalized_value"), says.alias("label"), confidence.alias("confidence"), F.lit(scanned).alias("scanned"), m["start"].alias("start"), m["end"].alias("end"))

        return F.transform(kept, entity)

    rows = held(rows, found=F.concat(*[told(i, kind, scanned, label, keep) for i, (kind, scanned, _, _, label, keep) in enumerate(kinds)]))
    same = lambda e: F.struct(e["entity_type"], e["normalized_value"], e["label"])
    rows = held(rows, told=F.transform("found", same))
    first = F.filter("found", lambda e, i: F.array_position(F.col("told"), same(e)) == i + 1)
    out = rows.select("document_id", "relative_path", "page_number", "text", F.explode(first).alias("e"))
    return out.select("document_id", "relative_path", "page_number", *[F.col(f"e.{c}").alias(c) for c in ("entity_type", "value", "normalized_value", "label", "confidence")], x.snippet(F.col("text"), F.col("e.start"), F.col("e.end")).alias("snippet"))


_FIELDS = ["operation_date", "beneficiary", "account_source", "account_destination", "bank", "folio", "reference", "concept", "rfc", "curp", "uuid"]
RECORD_COLUMNS = ["record_key", "record_type", "document_id", "relative_path", "page_number", "confidence", "amount", *_FIELDS, "evidence", "extra"]


def _records(rows: DataFrame, kind: str, discriminator: Column, evidence: Column, extra: dict[str, Column] | None = None, **fields: Column) -> DataFrame:
    """The record columns; what an extractor doesn't set is null; empty extras are left out."""
    pairs = [F.struct(F.lit(k).alias("key"), F.nullif(v.cast("string"), F.lit("")).alias("value")) for k, v in (extra or {}).items()]
    kept = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())) if pairs else F.create_map().cast("map<string,string>")
    values = {k: F.nullif(fields[k].cast("string"), F.lit("")) if k in fields else F.lit(None).cast("string") for k in _FIELDS}
    return rows.select(
        x.record_key(F.lit(kind), F.col("document_id"), discriminator).alias("record_key"), F.lit(kind).alias("record_type"), "document_id", "relative_path", "page_number", fields["confidence"].alias("confidence"),
        fields["amount"].cast("decimal(18,2)").alias("amount"), *[v.alias(k) for k, v in values.items()], F.left(x.clean_space(evidence), F.lit(1000)).alias("evidence"), kept.alias("extra"),
    )


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def payroll_records(pages: DataFrame, issuer_rfc: str = "MEZ850101AH7") -> DataFrame:
    """One a page at most.  The issuer's own RFC is taken only if there is no other."""
    text, f = F.col("text"), F.col("f")
    rows = held(pages, f=x.fold(text)).where(f.contains("NETO DEL RECIBO") & (f.contains("CURP") | f.contains("PERCEPCIONES")))
    rfcs = F.transform(F.regexp_extract_all(F.upper(text), F.lit(fixed.RFC), F.lit(1)), lambda v: F.regexp_replace(v, r"\s+", ""))
    named = F.coalesce(x.first_group(text, r"\b\d{3}\s*-\s*([^|\n]{4,80}?)(?=\s+(?:Ejercicio|RFC|Periodo)|[|\n])"), x.first_group(text, r"\b\d{3}\s*-\s*([A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ ]{3,60})"))
    rows = held(rows, **{
        "rfc": F.coalesce(F.try_element_at(F.filter(rfcs, lambda v: v != issuer_rfc), F.lit(1)), F.try_element_at(rfcs, F.lit(-1))),
        "curp": F.nullif(F.regexp_extract(F.upper(text), fixed.CURP, 1), F.lit("")),
        "uuid": F.nullif(F.regexp_extract(F.upper(text), fixed.UUID, 1), F.lit("")),
        "who": x.clean_person_name(named),
        "net": x.first_money(f, r"NETO\s+DEL\s+RECIBO\s*\$?\s*(\(?\s*\$?\s*\d[\d, ]*\.\d{2}\s*\)?)"),
        "day": x.date_text(x.first_group(f, r"FECHA\s+PAGO\s*[:|]?\s*[^\d]*(\d{1,2}/(?:[A-Z]{3}|\d{1,2})/20\d{2})")),
    })
    valid = F.coalesce(x.valid_embedded_date(F.col("rfc")), F.lit(False)) | F.coalesce(x.valid_embedded_date(F.col("curp")), F.lit(False))
    sure = F.col("who").isNotNull() & F.col("net").isNotNull() & valid
    key = F.coalesce(F.col("uuid"), F.concat(_text(F.col("curp")), F.lit("|"), _text(F.col("day")), F.lit("|"), _text(F.col("net"))))
    extra = {"periodo": x.first_group(f, r"PERIODO\s+([^\n]{4,80})"), "puesto": x.first_group(text, r"PUESTO\s*:\s*([^\n]{3,80})"), "departamento": x.first_group(text, r"DEPTO\s*:\s*([^\n]{3,80})")}
    return _records(rows, fixed.PAYROLL, key, F.left(text, F.lit(1400)), extra, confidence=F.when(sure, "alta").otherwise("media"), amount=F.col("net"), operation_date=F.col("day"), beneficiary=F.col("who"), rfc=F.col("rfc"), curp=F.col("curp"), uuid=F.col("uuid"), concept=F.lit("Recibo de nómina"))


def cheque_payee(f: Column) -> Column:
    """The first candidate line that looks like a payee: on the order line, the four below, or behind "a favor de"."""
    order = r"(?s)PAGUESE[^\n]{0,60}CHEQUE[^\n]{0,60}?(?:A|DE)\s*:\s*([^\n]*)"
    rest = F.regexp_extract(f, order + r"(.*)$", 2)
    below = F.slice(F.split(rest, "\n"), 1, 5)
    candidates = F.concat(F.array(F.regexp_extract(f, order, 1)), below, F.regexp_extract_all(f, F.lit(r"A\s+FAVOR\s+DE\s*:\s*\n?\s*([^\n]{3,100})"), F.lit(1)))
    cleaned = F.transform(F.filter(F.transform(candidates, x.clean_space), lambda c: (c != "") & ~c.contains("FECHA")), lambda c: x.clean_space(F.get(F.split(c, r"\s+(?:[A-Z+<>|\[\]]{0,12}\s*)?\d{1,3}(?:,\d{3})*\.\d{2}", 2), F.lit(0))))
    good = F.filter(cleaned, lambda c: (F.length(c) >= 4) & c.rlike("[A-Z]{3}") & ~c.rlike(r"^\d") & ~c.rlike("PESO|MONEDA NACIONAL|CUENTA NO"))
    return F.left(F.try_element_at(good, F.lit(1)), F.lit(100))


def cheque_records(pages: DataFrame) -> DataFrame:
    text, f = F.col("text"), F.col("f")
    rows = held(pages, f=x.fold(text)).where(f.contains("PAGUESE") | f.contains("FAVOR"))
    rows = held(rows, who=cheque_payee(f)).where("who is not null")
    at = F.length(F.regexp_extract(f, r"(?s)^(.*?)PAGUESE[^\n]{0,100}CHEQUE", 1))
    begin = F.greatest(at - 250, F.lit(0))
    near = F.when(f.rlike(r"PAGUESE[^\n]{0,100}CHEQUE"), F.substring(f, begin + 1, at + 500 - begin))
    amount = F.coalesce(x.money_value(F.nullif(F.regexp_extract(near, fixed.MONEY, 1), F.lit(""))), x.first_money(f, r"CANTIDAD\s+DE[^$\d]{0,60}(\$?\s*\d[\d, ]*\.\d{2})"))
    rows = held(rows, **{
        "cheque": F.coalesce(x.first_group(f, r"\bCH\s*[:;-]?\s*[-A-Z ]*?(\d{1,8})"), x.first_group(f, r"CHEQUE\s+NUMERO\s+(\d{1,8})"), x.first_group(F.col("relative_path"), r"(?:^|[/\\])CH[- _](\d{1,8})")),
        "paid": amount,
        "about": x.first_group(f, r"POR\s+CONCEPTO\s+DE\s*:\s*([^\n]{4,300})"),
    })
    loose = F.concat(F.col("who"), F.lit("|"), _text(F.col("paid")), F.lit("|"), F.left(_text(F.col("about")), F.lit(80)))
    key = F.coalesce(F.concat(F.lit("cheque:"), F.col("cheque")), loose)
    sure = F.col("cheque").isNotNull() & F.col("paid").isNotNull()
    account = F.regexp_replace(x.first_group(f, r"(?:CTA|NO\.?\s+DE\s+CUENTA)\s*:\s*(\d[\d ]{7,20})"), r"\D", "")
    return _records(rows, fixed.CHEQUE, key, F.left(text, F.lit(1800)), confidence=F.when(sure, "alta").otherwise("media"), amount=F.col("paid"), operation_date=x.first_group(f, r"FECHA\s*:\s*([^\n]{5,40})"), beneficiary=F.col("who"), account_source=account, folio=F.col("cheque"), concept=F.col("about"))


def transfer_records(pages: DataFrame, portal: str = "NET CASH", bank: str = "BBVA") -> DataFrame:
    text, f = F.col("text"), F.col("f")
    rows = held(pages, f=x.fold(text)).where(f.contains(portal) & f.contains("FOLIO"))
    rows = held(rows, **{
        "lot": x.first_group(f, r"FOLIO(?:\s+DEL\s+LOTE)?\s*:\s*([A-Z0-9-]{4,40})"),
        "single": x.first_group(f, r"FOLIO\s+UNICO\s*:\s*([A-Z0-9-]{8,60})"),
        "paid": F.coalesce(x.first_money(f, r"IMPORTE\s+TOTAL\s*:\s*(\$?\s*\d[\d, ]*\.\d{2})"), x.first_money(f, r"CIFRA\s+DE\s+CONTROL\s*:\s*(\$?\s*\d[\d, ]*\.\d{2})")),
    }).where("lot is not null and (paid is not null or single is not null)")
    key = F.concat(F.col("lot"), F.lit("|"), _text(F.col("paid")))
    extra = {"registros": x.first_group(f, r"NUMERO\s+DE\s+REGISTROS\s*:\s*(\d+)"), "estado": x.first_group(f, r"ESTADO\s*:\s*([^\n]{3,40})")}
    account = F.regexp_replace(x.first_group(f, r"CUENTA\s+DE\s+CARGO\s*:\s*(\d[\d ]{7,20})"), r"\D", "")
    day = x.date_text(x.first_group(f, r"FECHA\s+DE\s+(?:OPERACION|APLICACION)\s*:\s*([^\n]{5,30})"))
    return _records(rows, fixed.TRANSFER, key, F.left(text, F.lit(1800)), extra, confidence=F.when(F.col("paid").isNotNull(), "alta").otherwise("media"), amount=F.col("paid"), operation_date=day, account_source=account, bank=F.lit(bank), folio=F.col("lot"), reference=F.col("single"), concept=x.first_group(f, r"DESCRIPCION\s*:\s*([^\n]{3,120})"))


def mode(values: Column) -> Column:
    """struct(n, value) of the commonest element of an array, the first seen of equals; null if empty."""
    distinct = F.array_distinct(values)
    counted = F.transform(distinct, lambda v, k: F.struct(F.size(F.filter(values, lambda w: w == v)).alias("n"), (-k).alias("k"), v.alias("value")))
    return F.array_max(counted)


def policy_records(pages: DataFrame, own_names: tuple[str, ...] = ("MUNICIPIO DE EMILIANO ZAPATA",)) -> DataFrame:
    """A repeated amount (the commonest, then the smallest) beats a labelled total."""
    text, f = F.col("text"), F.col("f")
    rows = held(pages, f=x.fold(text)).where(f.contains("POLIZAS DE PAGO FOLIO") | f.rlike(r"\bORDEN\s+PAGO\b"))
    rows = held(rows, number=x.first_group(f, r"FOLIO\s*:\s*([A-Z0-9-]{5,30})")).where("number is not null")
    amounts = F.filter(F.transform(F.regexp_extract_all(text, F.lit(fixed.MONEY), F.lit(1)), x.money_value), lambda a: a > 0)
    counted = F.transform(F.array_distinct(amounts), lambda a: F.struct(F.size(F.filter(amounts, lambda b: b == a)).alias("n"), (-a).alias("minus")))
    words = "PAGADO|PEGADO|EJERCIDO|DEVENGADO|AUTORIZADA" + "".join("|" + n for n in own_names)
    inside = F.filter(F.regexp_extract_all(f, F.lit(r"\(([A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ ]{4,100})\)"), F.lit(1)), lambda v: ~v.rlike(words))
    inside = F.filter(F.transform(inside, x.clean_space), lambda v: F.size(F.split(v, " ")) >= 2)
    days = F.filter(F.transform(F.regexp_extract_all(f, F.lit(fixed.DATE), F.lit(1)), x.numeric_date), lambda d: d.isNotNull() & (F.coalesce(F.col("month_number"), F.lit(0)).isin(0) | (F.month(d) == F.col("month_number"))))
    rows = held(rows, **{
        "repeated": F.array_max(F.filter(counted, lambda c: c["n"] >= 2)),
        "total": x.first_money(f, r"\bTOTAL\s*\$?\s*(\$?\s*\d[\d, ]*\.\d{2})"),
        "labelled": F.nullif(x.clean_space(F.split_part(x.first_group(f, r"AUXILIAR\s+([^\n]{3,100})"), F.lit("ESTATUS"), F.lit(1))), F.lit("")),
        "guessed": mode(inside),
    })
    paid = F.coalesce(-F.col("repeated.minus"), F.col("total")).cast("decimal(18,2)")
    method = F.when(F.col("repeated").isNotNull(), "repeated_ledger_amount").when(F.col("total").isNotNull(), "labeled_total")
    extra = {
        "amount_method": method, "amount_occurrences": F.coalesce(F.col("repeated.n"), F.when(F.col("total").isNotNull(), 1)),
        "beneficiary_method": F.when(F.col("labelled").isNotNull(), "auxiliar_label").when(F.col("guessed").isNotNull(), "parenthetical_candidate"),
        "beneficiary_occurrences": F.when(F.col("labelled").isNotNull(), 1).otherwise(F.col("guessed.n")),
    }
    day = F.coalesce(F.try_element_at(days, F.lit(1)), x.date_text(x.first_group(f, r"FECHA\s+TRAMITE\s*:\s*([^\n]{5,30})")))
    return _records(rows, fixed.POLICY, F.col("number"), F.left(text, F.lit(1800)), extra, confidence=F.when(F.col("repeated").isNull() & F.col("total").isNotNull(), "alta").otherwise("media"), amount=paid, operation_date=day, beneficiary=F.coalesce(F.col("labelled"), F.col("guessed.value")), folio=F.col("number"), concept=x.first_group(f, r"OBSERVACIONES\s+([^\n]{5,300})"))


def bank_records(pages: DataFrame) -> DataFrame:
    """Any number a page: an anchor line and the block to the next one, or 700 characters beyond its own end."""
    f = F.col("f")
    rows = held(pages, f=x.fold(F.col("text"))).where(f.contains("ESTADO DE CUENTA") & (f.contains("SPEI") | f.contains("REFERENCIA")))
    anchor = r"(^[ \t]*\d{2}/[A-Z]{3}[ \t]+\d{2}/[A-Z]{3}[ \t]+[A-Z0-9]{2,4}[ \t]+[^\n]{4,240}$)"
    found = held(held(rows, **dict(zip(("chunks", "wholes", "values"), found_in(f, anchor, "(?m)")))), a=placed(F.col("chunks"), F.col("wholes"), F.col("values"))).select("*", F.posexplode("a").alias("k", "m"))
    part = lambda i: F.regexp_extract(F.col("m.value"), r"^[ \t]*(\d{2})/([A-Z]{3})[ \t]+\d{2}/[A-Z]{3}[ \t]+([A-Z0-9]{2,4})[ \t]+([^\n]{4,240})$", i)
    end = F.coalesce(F.get(F.col("a"), F.col("k") + 1)["start"], F.least(F.length(f), F.col("m.end") + 700))
    found = held(found, **{"block": F.substring(f, F.col("m.start") + 1, end - F.col("m.start")), "about": x.clean_space(part(4)), "code": part(3), "day": x.make_day(part(1), x.month_number(part(2)).cast("string"), F.col("year").cast("string"))})
    found = found.withColumn("paid", x.money_value(F.nullif(F.regexp_extract(F.col("about"), fixed.MONEY, 1), F.lit("")))).where("paid is not null")
    lines = F.filter(F.transform(F.split(F.col("block"), "\n"), x.clean_space), lambda c: c != "")
    names = F.filter(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), lambda c: F.length(c).between(5, 100) & c.rlike("^[A-ZÑ ]+$") & ~c.rlike("BANCOMER|INSTITUCION|SPEI|PAGINA"))
    found = found.withColumn("ref", x.first_group(F.col("block"), r"REF\.?\s*([A-Z0-9 ]{4,30})"))
    place = F.concat(F.lit("|"), F.col("page_number").cast("string"), F.lit("|"), F.col("m.start").cast("string"))
    key = F.concat(_text(F.col("day")), F.lit("|"), _text(F.col("ref")), F.lit("|"), _text(F.col("paid")), F.when(F.col("ref").isNull(), place).otherwise(""))
    way = F.when(F.col("about").contains("ENVIADO"), "salida").when(F.col("about").contains("RECIBIDO"), "entrada")
    return _records(found, fixed.BANK, key, F.col("block"), {"codigo": F.col("code"), "direccion": way}, confidence=F.when(F.col("ref").isNotNull(), "alta").otherwise("media"), amount=F.col("paid"), operation_date=F.col("day"), beneficiary=F.try_element_at(names, F.lit(-1)), account_destination=F.regexp_extract(F.col("block"), r"(?<!\d)(\d{18,20})(?!\d)", 1), bank=x.first_group(F.col("about"), r"SPEI\s+(?:ENVIADO|RECIBIDO)\s+([A-Z]+)"), reference=F.col("ref"), concept=F.col("about"))


EXTRACTORS = [payroll_records, cheque_records, transfer_records, policy_records, bank_records]


def records(pages: DataFrame, extractors=None) -> DataFrame:
    """All extractors' records of all pages."""
    have = pages
    for name, kind in (("month_number", "int"), ("year", "int"), ("relative_path", "string")):
        if name not in pages.columns:
            have = have.withColumn(name, F.lit(None).cast(kind))
    return reduce(DataFrame.unionByName, [e(have) for e in extractors or EXTRACTORS])
