from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docledger.functions import fields
from docledger.functions import text as x


def one(spark, column, **values):
    kinds = {str: "string", int: "int", float: "double", list: "array<string>", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize("raw, amount, status", [("93.198.98", "93198.98", "recuperado_separadores"), ("1,234.50", "1234.50", "recuperado_separadores"), ("$ 12.5", "12.50", "numerico"), ("", None, "vacio"), (None, None, "vacio"), ("abc", None, "invalido"), ("1.234.567", None, "invalido")])
def test_amounts(spark, raw, amount, status):
    got = one(spark, x.parse_amount(F.col("a")), a=raw)
    assert (got.amount, got.status) == (amount and Decimal(amount), status)


@pytest.mark.parametrize("raw, day", [("2021-07-30", "2021-07-30"), ("30 de julio de 2021", "2021-07-30"), ("30 DE JULIO DE 2021", "2021-07-30"), ("3/3/21", "2021-03-03"), ("31/02/2024", None), ("15/Nov/2021", None), (None, None)])
def test_dates(spark, raw, day):
    assert str(one(spark, x.normalize_date(F.col("a")), a=raw)) == str(day)


def test_date_text_and_embedded(spark):
    assert str(one(spark, x.date_text(F.col("a")), a="15/Nov/2021")) == "2021-11-15"
    assert one(spark, x.valid_embedded_date(F.col("a")), a="ABCD210230XX1") is False
    assert one(spark, x.valid_embedded_date(F.col("a")), a="ABCD210228XX1") is True


def test_money(spark):
    assert one(spark, x.money_value(F.col("a")), a="($ 1,234.50)") == Decimal("-1234.50")
    assert one(spark, x.money_value(F.col("a")), a="x") is None


def test_paths(spark):
    assert tuple(one(spark, x.folder_period(F.col("a")), a="9. Septiembre/x.pdf")) == (9, "9. Septiembre")
    assert tuple(one(spark, x.folder_period(F.col("a")), a="Sin mes/x.pdf")) == (None, "Sin mes")
    assert one(spark, x.path_month(F.col("a")), a="9-x/y") == 0
    assert one(spark, x.path_numbers(F.col("a")), a="9. S/CH 00428_12.pdf") == ["428", "12"]
    assert one(spark, x.identifier(F.col("a")), a="POL 000") == "0"


def test_names(spark):
    assert one(spark, x.normalize_name(F.col("a")), a="María de la Luz Núñez") == "MARIA LUZ NUNEZ"
    sim = x.name_similarity(F.col("a"), F.col("b"))
    assert one(spark, sim, a="TIDE", b="DIET") == 0.25 and one(spark, sim, a="DIET", b="TIDE") == 0.5
    assert one(spark, sim, a="", b="X") == 0
    assert one(spark, x.fold(F.col("a")), a="çãß œ Ǆa\u0301") .startswith("CASS ")
    assert one(spark, x.clean_person_name(F.col("a")), a="JUAN PEREZ RFC") == "JUAN PEREZ"
    assert one(spark, x.clean_person_name(F.col("a")), a="JUAN 3") is None


def test_fields(spark):
    issues = lambda kind, raw, sure=90.0: one(spark, fields.validate_field(F.lit(kind), F.col("r"), F.lit(sure)), r=raw)
    assert issues("importe", "1,234.50") == [] and issues("importe", "") == ["sin_lectura"]
    assert issues("importe", "1O.00", 50.0) == ["baja_confianza", "formato_invalido", "confusion_alfanumerica"]
    assert issues("fecha", "31/02/2021") == ["fecha_invalida"] and issues("fecha", "enero de 2021") == []
    assert issues("cuenta", "1.2.3.4") == [] and issues("folio", "A-O1") == ["ambiguedad_alfanumerica"]
    total = lambda t, p: one(spark, fields.check_total(F.col("t"), F.col("p")), t=t, p=p)
    assert total("46,638.00", ["23,319.00", "23,319.00"]) is True and total("523,319.00", ["23,319.00", "23,319.00"]) is False and total("x", ["1.00"]) is None
    value = lambda k, r: one(spark, fields.extract_value(F.lit(k), F.col("r")), r=r)
    assert value("cuenta", "no 12 cta 123456 fin") == "123456" and value("importe", "total $ 1,200.00 x") == "$ 1,200.00" and value("folio", "nada") == "nada"
    assert one(spark, fields.reading_error(F.col("a"), F.col("b")), a="1,234.50", b="1234.50") == "separadores_o_formato"


def test_boxes(spark):
    box = F.array(*map(F.lit, (0.1, 0.2, 0.3, 0.4)))
    turned = one(spark, fields.rotate_box(fields.rotate_box(fields.rotate_box(fields.rotate_box(box, F.lit(90)), F.lit(90)), F.lit(90)), F.lit(90)))
    assert turned == pytest.approx([0.1, 0.2, 0.3, 0.4])
    assert one(spark, fields.rotate_box(box, F.lit(270))) == pytest.approx(one(spark, fields.rotate_box(fields.rotate_box(box, F.lit(180)), F.lit(90))))
    assert one(spark, fields.page_jobs(F.lit(8), F.lit(2), F.lit(5.0), F.lit(6))) == 3
