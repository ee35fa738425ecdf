import zipfile
from decimal import Decimal

from pyspark.sql import functions as F

from docledger.functions import fields, fixed, text
from docledger.operators import calibration, catalog, crossref, extract, inventory, linkage, merge, search
from docledger.operators.components import components
from docledger.sources import files, sheet
from docledger.storage import remove_written, written, written_in_buckets
from docledger.streaming import pages as stream

PAGE = "document_id string, relative_path string, page_number int, text string, month_number int, year int"


def pages(spark, *texts, path="7. Julio/x.pdf"):
    return spark.createDataFrame([("D1", path, i, t, 7, 2021) for i, t in enumerate(texts, 1)], PAGE)


PAYROLL = "123 - JUAN PEREZ LOPEZ RFC\nRFC: PELJ800101AB1 CURP PELJ800101HVZRPN09\nPERIODO QUINCENA 1\nFECHA PAGO: 15/JUL/2021\nPERCEPCIONES\nNETO DEL RECIBO $ 4,251.00\n"
CHEQUE = "$ 4,251.00\nPAGUESE POR ESTE CHEQUE A:\nPROVEEDORA DEL SUR\nCTA: 12345678 CH: 428\nPOR CONCEPTO DE: OBRA\nFECHA: 30 DE JULIO DE 2021\n"
BANK = "ESTADO DE CUENTA\n05/JUL 05/JUL T17 SPEI ENVIADO BANORTE 1,500.00\nREF. 0012345 ABC\n012345678901234567\nMARIA LOPEZ\n06/JUL 06/JUL C02 DEPOSITO 20.00\nREFERENCIA\n"
POLICY = "POLIZAS DE PAGO FOLIO: EG-00123\n02/07/2021 4,251.00\n03/07/2021 4,251.00\nTOTAL $ 8,502.00\n(PROVEEDORA DEL SUR)\nPAGO CON CH-428\n"


def test_extract(spark):
    rows = {r.record_type: r for r in extract.records(pages(spark, PAYROLL, CHEQUE, POLICY)).collect()}
    assert rows[fixed.PAYROLL].beneficiary == "JUAN PEREZ LOPEZ" and rows[fixed.PAYROLL].amount == Decimal("4251.00") and rows[fixed.PAYROLL].operation_date == "2021-07-15"
    assert rows[fixed.CHEQUE].folio == "428" and rows[fixed.CHEQUE].beneficiary == "PROVEEDORA DEL SUR" and rows[fixed.CHEQUE].confidence == "alta"
    policy = rows[fixed.POLICY]
    assert policy.amount == Decimal("4251.00") and policy.operation_date == "2021-07-02" and policy.confidence == "media" and policy.extra["amount_method"] == "repeated_ledger_amount"
    bank = sorted(extract.bank_records(pages(spark, BANK)).collect(), key=lambda r: r.operation_date)
    assert [(b.amount, b.operation_date) for b in bank] == [(Decimal("1500.00"), "2021-07-05"), (Decimal("20.00"), "2021-07-06")]
    assert bank[0].account_destination == "012345678901234567" and bank[0].beneficiary == "MARIA LOPEZ" and bank[0].extra["direccion"] == "salida"


def test_cheque_folio_of_file_name_and_copies(spark):
    text = CHEQUE.replace(" CH: 428", "").replace("POR ESTE CHEQUE", "CHEQUE")
    rows = extract.cheque_records(pages(spark, text, text, path="7. Julio/CH-428.pdf")).collect()
    assert {r.folio for r in rows} == {"428"} and len({r.record_key for r in rows}) == 1
    merged = merge.merge_records(extract.cheque_records(pages(spark, text, text))).collect()
    assert len(merged) == 1 and merged[0].evidence_pages == [1, 2]


def test_entities(spark):
    found = extract.entities(pages(spark, "IMPORTE TOTAL: $1,200.00 y 1,200.00 el 31/02/2021 y 1/2/2021 PELJ801301AB1")).collect()
    got = {(r.entity_type, r.normalized_value, r.label) for r in found}
    assert ("importe", "1200.00", "importe total") in got and ("fecha", "2021-02-01", "fecha numérica") in got and not any(v == "2021-02-31" for _, v, _ in got)
    assert ("rfc", "PELJ801301AB1", "RFC con posible error OCR") in got


def test_catalog(spark):
    texts = spark.createDataFrame([("a", "29/02/2024 y 31/02/2024"), ("b", "3 de marzo de 2021, 03/03/2021"), ("c", "")], "document_id string, text string")
    got = {(r.document_id, str(r.date), r.occurrences) for r in catalog.dates(texts).collect()}
    assert got == {("a", "2024-02-29", 1), ("b", "2021-03-03", 2)}
    docs = spark.createDataFrame([("n", "TRANSFE -38028_0001.pdf", "CHEQUE PAGUESE POR ESTE CHEQUE"), ("o", "x.pdf", "nada"), ("p", None, None)], "document_id string, file_name string, text string")
    kinds = {r.document_id: r for r in catalog.classify(docs).collect()}
    assert kinds["n"].primary_type == "Transferencia" and kinds["n"].confidence == "alta" and set(kinds["n"].contained_types) == {"Transferencia", "Cheque"}
    assert kinds["o"].primary_type == fixed.OTHER == kinds["p"].primary_type and kinds["o"].confidence == "baja"
    years = catalog.document_year(spark.createDataFrame([("a", "x"), ("b", "y/2019/z"), ("z", "w")], "document_id string, relative_path string"), catalog.dates(texts))
    assert {r.document_id: r.year for r in years.collect()} == {"a": 2024, "b": 2019, "z": 2021}
    whole = catalog.catalog(pages(spark, "uno dos tres CHEQUE", "cuatro"), spark.createDataFrame([("D1", "7. Julio/CH-1.pdf")], "document_id string, relative_path string")).first()
    assert whole.pages == 2 and whole.month_number == 7 and whole.primary_type == "Cheque"


RECORD = "record_key string, record_type string, document_id string, relative_path string, page_number int, confidence string, amount decimal(18,2), operation_date string, beneficiary string, folio string, reference string, concept string, evidence string"


def record(key, kind, page=1, amount="4251.00", day="2021-07-02", who="PROVEEDORA DEL SUR", folio=None, reference=None, evidence=None, doc="D1"):
    return (key, kind, doc, f"7. Julio/{doc}.pdf", page, "alta", Decimal(amount), day, who, folio, reference, None, evidence)


def test_trace(spark):
    rows = spark.createDataFrame([record("p", fixed.POLICY, 1, evidence="CH-428"), record("c", fixed.CHEQUE, 2, folio="428"), record("t", fixed.TRANSFER, 3, folio="428", who=None), record("b", fixed.BANK, 9, day="2021-07-03", reference="PAGO 428X", doc="S")], RECORD)
    cases, links, bridge = (d.collect() for d in linkage.reconcile(rows))
    assert len(cases) == 1 and cases[0].record_count == 4 and cases[0].status == "conciliado_banco" and cases[0].amount == Decimal("4251.00") and len(bridge) == 4
    assert sum(k.status == "aceptado" for k in links) >= 3 and len(cases) >= 4 - sum(k.status == "aceptado" for k in links)


def test_ambiguity(spark):
    rows = spark.createDataFrame([record("c1", fixed.CHEQUE, 1, folio="1"), record("c2", fixed.CHEQUE, 2, folio="2"), record("b", fixed.BANK, 9, doc="S")], RECORD)
    cases, links, _ = (d.collect() for d in linkage.reconcile(rows))
    assert len(cases) == 3 and all(k.status == "sugerido" for k in links) and links


def test_bank_matches_by_brute_force(spark):
    """Names, folios in references, types, days and components at random, with many ties."""
    import datetime
    import random
    from itertools import groupby

    draw = random.Random(7)
    day = lambda: str(datetime.date(2021, 7, 20) + datetime.timedelta(draw.randrange(40)))
    who = lambda: draw.choice([None, None, "ANA RUIZ", "ANA RUIZ SOTO", "ANA RUIZ SOTO VEGA"])
    others = [record(f"r{i}", draw.choice([fixed.CHEQUE, fixed.TRANSFER, fixed.PAYROLL]), i % 5, draw.choice(["10.00", "20.00"]), day() if i % 19 else None, who(), draw.choice([None, "1234", "5678", "ABCD"]), doc=f"D{i % 7}") for i in range(150)]
    bank = [record(f"b{i}", fixed.BANK, i % 3, draw.choice(["10.00", "20.00", "30.00"]), day(), who(), reference=draw.choice([None, "PAGO 1234", "5678 ABCD 5678"]), doc="S") for i in range(120)]
    root = {r[0]: f"r{draw.randrange(40)}" for r in others[::2]}
    rows = linkage.prepared(spark.createDataFrame(bank + others, RECORD))
    rooted = spark.createDataFrame(list(root.items()), "record_key string, root string")
    got = sorted((r.target_key, r.source_key, r.raw_score, r.taken, tuple(r.reasons)) for r in linkage.bank_matches(rows, rooted, text.word_overlap).collect())

    def words(name):
        return set((name or "").split())

    def match(b, r):
        days = abs((datetime.date.fromisoformat(b[7]) - datetime.date.fromisoformat(r[7])).days)
        mine, theirs = words(b[8]), words(r[8])
        sim = len(mine & theirs) / len(mine | theirs) if mine and theirs else 0
        named = [("beneficiario_coincidente", 35)] if sim >= 0.86 else [("beneficiario_similar", 22)] if sim >= 0.7 else []
        near = ("fecha_exacta", 30) if days == 0 else ("fecha_cercana", 24) if days <= 3 else ("fecha_en_7_dias", 15)
        signals = [("importe_exacto", 35), near, *named, *[("lote_transferencia", 10)] * (r[1] == fixed.TRANSFER), *[("folio_en_referencia_bancaria", 35)] * (r[9] in (b[10] or "").split())]
        return days <= 7, -min(100, sum(p for _, p in signals)), (r[2], r[4], r[0]), root.get(r[0], r[0]), tuple(n for n, _ in signals)

    best = []
    for b in bank:
        found = sorted(m[1:] for r in others if r[7] and r[6] == b[6] and (m := match(b, r))[0])
        if found:
            rest = [m[0] for m in found if m[2] != found[0][2]]
            able = found[0][0] <= -75 and (not rest or rest[0] - found[0][0] >= 10)
            best.append(((found[0][2], able), found[0][0], (b[2], b[4], b[0]), found[0]))
    want = []
    for _, turn in groupby(sorted(best), key=lambda m: m[0]):
        want += [(b[2], top[1][2], -top[0], able and k == 0, top[3]) for k, ((_, able), _, b, top) in enumerate(turn)]
    assert got == sorted(want) and {t for _, _, _, t, _ in got} == {True, False}


def test_bank_matches_make_no_pairs_of_records(spark):
    """Eighty bank records and eighty alike others: names are compared for kinds of records, not for 6,400 pairs."""
    made = spark.sparkContext.accumulator(0)

    def same(left, right):
        made.add(1)
        return float(left == right)

    rows = linkage.prepared(spark.createDataFrame([record(f"c{i:02}", fixed.CHEQUE, i, doc="D") for i in range(80)] + [record(f"b{i:02}", fixed.BANK, i, doc="S") for i in range(80)], RECORD))
    none = spark.createDataFrame([], "record_key string, root string")
    roots = linkage.roots(rows, spark.createDataFrame([("c00", "c01")], "source_key string, target_key string"))
    for rooted in (roots, roots.where("root <> record_key").unionByName(none)):
        before = made.value
        got = linkage.bank_matches(rows, rooted, F.udf(same, "double")).collect()
        assert len(got) == 80 and {(r.source_key, r.raw_score, r.taken) for r in got} == {("c00", 100, False)}
        assert made.value - before <= 80


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51), (51, 52), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(21)) and got[52] == 50 and len(got) == 24
    assert components(edges.limit(0)).count() == 0


def test_components_take_few_steps(spark, monkeypatch):
    """A chain of a thousand edges, in order and not: about as many steps as its logarithm."""
    import random

    from docledger.operators import components as module

    steps = []
    monkeypatch.setattr(module, "written", lambda df, label, keep=module.written: (steps.append(label), keep(df, label))[1])
    order = random.Random(1).sample(range(1001), 1001)
    for names in (range(1001), order):
        steps.clear()
        got = components(spark.createDataFrame([(names[i], names[i + 1]) for i in range(1000)], "a long, b long")).collect()
        assert {r.root for r in got} == {0} and len(got) == 1001 and steps.count("pointers") <= 18


def test_payments(spark):
    pay = spark.createDataFrame([(10, "POL 12", "x", "ENE", Decimal("5.00"), "numerico", "obra"), (11, "POL 12", "x", "ENE", Decimal("5.00"), "numerico", "OBRA"), (12, "77", "x", "FEB", Decimal("8.00"), "recuperado_separadores", "z"), (13, "88", "x", "FEB", None, "invalido", "z")], "excel_row int, account string, origin string, month string, amount decimal(18,2), amount_status string, concept string")
    rows = spark.createDataFrame([record("a", fixed.CHEQUE, amount="5.00", doc="POLIZA 12"), record("b", fixed.CHEQUE, amount="9.00", folio="77", doc="X 1")], RECORD).withColumn("relative_path", F.when(F.col("record_key") == "a", "1. E/POLIZA 12.pdf").otherwise("2. F/X 1.pdf"))
    out, links = crossref.matched(pay, rows)
    got = {r.excel_row: r for r in out.collect()}
    assert got[10].match_status == "vinculado" and got[10].match_score == 165 and got[12].match_score == 65 and got[12].paid_difference == Decimal("1.00") and got[13].match_status == "sin_coincidencia"
    assert [r.rows for r in crossref.duplicates(pay).collect()] == [[10, 11]]
    kinds = {r.kind: r for r in crossref.findings(pay, out).collect()}
    assert set(kinds) == {"importe_como_texto", "duplicado_probable"} and kinds["duplicado_probable"].adjustment == Decimal("-5.00")
    assert links.count() == 3


def test_orientation(spark):
    rows = spark.createDataFrame([("p", 0, 90.0, 80.0, 200), ("p", 90, 60.0, 80.0, 200), ("q", 0, 90.0, 80.0, 200), ("q", 180, 88.0, 80.0, 200)], "page_id string, angle int, score double, confidence double, alphanumeric int")
    got = {r.page_id: r for r in calibration.choose_orientation(rows).collect()}
    assert got["p"].angle == 0 and got["p"].confidence == "alta" and got["q"].ambiguous
    variants = spark.createDataFrame([(1, "gray", 100.0), (1, "adaptive", 101.0), (2, "gray", 100.0), (2, "adaptive", 103.0)], "f int, variant string, score double")
    assert {r.f: r.variant for r in calibration.best_variant(variants, ["f"]).collect()} == {1: "gray", 2: "adaptive"}


def test_states_and_search(spark, tmp_path):
    found = spark.createDataFrame([("a.pdf", 1, "h"), ("b.pdf", 1, "new"), ("c.pdf", 1, "h")], "path string, size int, hash string")
    state = spark.createDataFrame([("a.pdf", "h", "completed"), ("b.pdf", "old", "completed"), ("c.pdf", "h", "processing")], "path string, hash string, status string")
    assert {r.path: (r.status, r.changed) for r in inventory.inventory(found, state).collect()} == {"a.pdf": ("completed", False), "b.pdf": ("pending", True), "c.pdf": ("pending", False)}
    index = search.token_index(pages(spark, "Acción y pago", "pago"))
    assert [r.page_number for r in search.match(index, ["accion", "PAGO"]).collect()] == [1]
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "X.PDF").write_bytes(b"x")
    (tmp_path / "in" / "y.txt").write_bytes(b"y")
    assert files.discover(spark, f"file://{tmp_path}/in").count() == 1
    files.save_csv(found.limit(0), f"file://{tmp_path}/csv", "sin_registros")
    assert spark.read.csv(f"file://{tmp_path}/csv", header=True).first().estado == "sin_registros"
    assert "&lt;b&gt;" in files.html_report(spark.createDataFrame([("<b>",)], "a string"), "t")


def test_sheet_source(spark, tmp_path):
    path = tmp_path / "p.xlsx"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>POL 1</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", "<worksheet><sheetData><row r='1'><c r='A1' t='inlineStr'><is><t>Cuenta</t></is></c></row><row r='2'><c r='A2' t='s'><v>0</v></c><c r='E2'><v>5.5</v></c></row></sheetData></worksheet>")
    spark.dataSource.register(sheet.SheetSource)
    rows = spark.read.format("sheet").load(str(path)) if False else spark.read.format("sheet").option("path", str(path)).load()
    typed, total = sheet.payment_rows(rows)
    assert typed.first().account == "POL 1" and typed.first().amount == Decimal("5.50") and total.count() == 0
    assert sheet.header_faults(rows, {"A": "cuenta", "E": "importe"}).count() == 1


def test_stream(spark, tmp_path):
    rows = pages(spark, PAYROLL, CHEQUE).withColumn("seen", F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    rows.unionAll(rows).write.parquet(f"{tmp_path}/in")
    q = stream.start(stream.extracted(stream.page_stream(spark, f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_crop_score(spark):
    rows = [(1, "importe", "$ 1,200.50", [90.0, 70.0]), (2, "importe", "1O0.0", [50.0]), (3, "fecha", None, None), (4, "cuenta", "1234567890", [80.0, None] * 7), (5, "folio", "A-12", [])]
    df = spark.createDataFrame(rows, "i int, kind string, raw string, sure array<double>")
    got = {r.i: r.s for r in df.select("i", fields.crop_score(F.col("kind"), F.col("raw"), F.col("sure")).alias("s")).collect()}
    assert got == {1: 100.0, 2: 35.0, 3: 0.0, 4: 56.0, 5: 20.0}


def test_breakdown_and_timings_of_few_rows(spark):
    records = spark.createDataFrame([("importe", "a", True), ("importe", "b", False), (None, "b", None)], "kind string, document string, exact boolean")
    got = {(r.level, r.name): (r.fields, r.exact) for r in calibration.accuracy_breakdown(records).collect()}
    assert got == {("total", None): (3, 1), ("tipo", "importe"): (2, 1), ("tipo", None): (1, 0), ("documento", "a"): (1, 1), ("documento", "b"): (2, 0)}
    assert {r.fields for r in calibration.accuracy_breakdown(records.limit(0)).collect()} <= {0}
    runs = spark.createDataFrame([("A", 1, Decimal("2.00")), ("B", 1, Decimal("1.50")), ("B", 2, None)], "profile string, page_id int, seconds decimal(18,2)")
    told = {r.profile: (float(r.total_seconds), r.seconds_per_page) for r in calibration.timings(runs, runs.where("profile = 'A'")).collect()}
    assert told == {"A": (2.0, 2.0), "B": (3.5, 1.75)}
    assert {r.profile: float(r.total_seconds) for r in calibration.timings(runs, runs.limit(0)).collect()} == {"A": 2.0, "B": 1.5}


def test_page_audit(spark):
    pages = spark.createDataFrame([("a", 1, None), ("a", 2, "xy"), ("b", 1, "x")], "path string, page int, text string")
    states = spark.createDataFrame([("a", "h", "completed"), ("b", "h", "failed")], "path string, hash string, status string")
    out = inventory.page_audit(pages.where("page = 1"), pages, states, states.limit(0)).collect()
    assert sorted((r.path, r.page, r.intact, r.characters_before, r.characters_after) for r in out) == [("a", 1, False, 0, 0), ("a", 2, False, 0, 2)]


def test_pages_of_files(spark, tmp_path):
    """Pages are numbered from 1; other suffixes are left out; a parser of one's own reads other formats."""
    from docledger.sources import files

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.txt").write_text("uno\fdos")
    (tmp_path / "two.TXT").write_text("tres\f\n")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "three.pdf").write_bytes(b"x|y|z")
    rows = lambda df: sorted((r.path.rsplit("/", 1)[1], r.page_number, r.text) for r in df.collect())
    assert rows(files.read_pages(spark, str(tmp_path))) == [("one.txt", 1, "uno"), ("one.txt", 2, "dos"), ("two.TXT", 1, "tres")]
    parsed = files.read_pages(spark, str(tmp_path), ".pdf", lambda content: content.decode().split("|"))
    assert rows(parsed) == [("three.pdf", 1, "x"), ("three.pdf", 2, "y"), ("three.pdf", 3, "z")]


def test_broken_references_are_refused(spark):
    import pytest

    from docledger.operators import reports

    tables = {"links": spark.createDataFrame([("a", "b")], "source_key string, target_key string"), "records": spark.createDataFrame([("a",)], "record_key string")}
    saved = []
    with pytest.raises(reports.BrokenReference):
        reports.save_stage(tables, reports.TRACE_REFERENCES[:2], lambda name, table: saved.append(name))
    assert not saved
    reports.save_stage(tables, reports.TRACE_REFERENCES[:1], lambda name, table: saved.append(name))
    assert saved == ["links", "records"]


def test_folded_search_terms(spark):
    from docledger.operators import search

    pages = spark.createDataFrame([(1, 1, "La Acción y la canción"), (2, 1, "la accion")], "document_id int, page_number int, text string")
    found = lambda terms: {r.document_id for r in search.match(search.token_index(pages), terms).collect()}
    assert found(["acción", "ACCION"]) == {1, 2} and found(["la", "Canción"]) == {1} and found(["nada"]) == set()


def test_report_page(spark):
    rows = spark.createDataFrame([("a", "file:///x/D%201.pdf#page=2", 1), ("b'>", "javascript:alert(1)", 2), ("a", None, 3)], "kind string, page string, n int").orderBy("n")
    page = files.html_report(rows, "<t>", filters=("kind",), links=("page",))
    assert page.count("<tr>") == 4 and "<h1>&lt;t&gt;</h1>" in page and "more rows" not in page
    assert page.count("<a href=") == 1 and "<a href='file:///x/D%201.pdf#page=2'>" in page
    assert page.count("<option") == 3 and "value='=b&#x27;&gt;'" in page
    short = files.html_report(rows, "t", limit=1)
    assert short.count("<tr>") == 2 and "2 more rows are not on this page" in short
    assert files.html_report(rows.limit(0), "t", filters=("kind",)).count("<tr>") == 1


def test_csv_mark(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["x", "y"])], "a int, b array<string>")
    for mark in (True, False):
        path = tmp_path / str(mark)
        files.save_csv(rows, f"file://{path}", mark=mark)
        (file,) = path.glob("*.csv")
        assert file.read_bytes().startswith(b"\xef\xbb\xbfa,b" if mark else b"a,b")
        assert spark.read.csv(f"file://{path}", header=True, escape="\\").select("a", "b").collect() == [("1", '["x","y"]')]


def test_all_constraints_of_totals_count(spark):
    n = 1200
    field = lambda f, raw: spark.range(n).select(F.lit("A").alias("profile"), (F.col("id") * 2 + f).alias("field_id"), F.lit(raw).alias("raw"), F.array().cast("array<string>").alias("validators"), F.lit(False).alias("requires_review"))
    pairs = spark.range(n).select((F.col("id") * 2 + 1).alias("total_field"), (F.col("id") * 2).alias("first_field"))
    second = pairs.select(F.lit("A").alias("profile"), "total_field", F.lit("20.00").alias("value"))
    controls, marked = calibration.total_control(field(0, "10.00").unionAll(field(1, "31.00")), pairs, second)
    assert controls.count() == n and marked.where("requires_review").count() == 2 * n


def test_written_tables_are_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("docledger.storage.shared_dir", lambda _: f"file://{tmp_path}")  # the tables of other tests stay
    rows = spark.range(10).withColumn("k", F.col("id") % 3)
    assert written(rows, "a").count() == 10 and written_in_buckets(rows, "b", "k", 2).count() == 10
    folder = tmp_path / "docledger" / spark.sparkContext.applicationId
    assert len(list(folder.iterdir())) == 2
    remove_written(spark)
    assert not folder.exists()
    remove_written(spark)  # nothing left
    assert written(rows, "a").count() == 10
