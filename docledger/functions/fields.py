"""Validation, comparison and scoring of single readings of a field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docledger.functions import fixed
from docledger.functions.text import make_day, month_number

_LONG = [k.lower() for k, _ in fixed.MONTHS.items() if len(k) > 3 or k == "MAYO"]
_NAMES = "|".join(_LONG)


def normalize(raw: Column) -> Column:
    """Without `$`, white space collapsed; characters are never substituted."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.coalesce(raw, F.lit("")), r"\$", ""), r"\s+", " "))


def _bad_day(text: Column, pattern: str) -> tuple[Column, Column]:
    """(whether the pattern is found, whether a find of it is no day)."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    part = lambda x, i: F.regexp_extract(x, pattern, i)
    month = lambda x: F.coalesce(month_number(F.upper(part(x, 2))).cast("string"), part(x, 2))
    return F.size(found) > 0, F.exists(found, lambda x: make_day(part(x, 1), month(x), part(x, 3)).isNull())


def validate_field(kind: Column, raw: Column, confidence: Column) -> Column:
    """The issues of a reading, in a fixed order; kinds: importe, fecha, cuenta, folio."""
    v = normalize(raw)
    numeric, numeric_bad = _bad_day(v, r"\b(\d{1,3})/(\d{1,2})/(\d{4})\b")
    written, written_bad = _bad_day(F.lower(v), r"\b(\d{1,3})\s+de\s+([a-z]+)\s+(?:de|del)\s+(\d{4})\b")
    bad_day = numeric_bad | written_bad
    month_year = F.lower(v).rlike(rf"\b({_NAMES}) de \d{{4}}\b")
    is_ = lambda k: kind == k
    amount = r"^(-?(\d{1,3}(,\d{3})+|\d+)\.\d{2}|\((\d{1,3}(,\d{3})+|\d+)\.\d{2}\))$"
    malformed = (
        (is_("importe") & ~v.rlike(amount))
        | (is_("fecha") & ~bad_day & ~numeric & ~written & ~month_year)
        | (is_("cuenta") & ~v.rlike(r"^\d{10,18}$|^\d{1,4}(\.\d{1,4}){3,9}$"))
        | (is_("folio") & ~v.rlike(r"^[A-Za-z0-9]+([-/][A-Za-z0-9]+)*$"))
    )
    confused = (is_("importe") & v.rlike("[OoISBl]")) | (is_("cuenta") & v.rlike("[OoIlSB]"))
    issues = F.array_compact(
        F.array(
            F.when(confidence < 75, "baja_confianza"),
            F.when(malformed, "formato_invalido"),
            F.when(is_("fecha") & bad_day, "fecha_invalida"),
            F.when(confused, "confusion_alfanumerica"),
            F.when(is_("importe") & (F.length(F.regexp_replace(v, r"\D", "")) > 12), "longitud_atipica"),
            F.when(is_("folio") & (v.rlike(r"(?i)([OISB]\d|\d[OISBl])") | v.startswith("0P")), "ambiguedad_alfanumerica"),
        )
    )
    return F.when(v == "", F.array(F.lit("sin_lectura"))).otherwise(issues)


def compare_readings(kind: Column, left: Column, right: Column, confidence: Column) -> Column:
    issues = validate_field(kind, left, confidence)
    has = lambda x: F.array_contains(issues, x)
    return (
        F.when(normalize(left) != normalize(right), "discrepante")
        .when(has("formato_invalido") | has("fecha_invalida"), "formato_invalido")
        .when(has("baja_confianza"), "baja_confianza")
        .when(F.size(issues) > 0, "requiere_revision")
        .otherwise("coincidente")
    )


def number(raw: Column) -> Column:
    """A number of a reading, parentheses for negative; null if it is none."""
    v = F.replace(normalize(raw), F.lit(","), F.lit(""))
    inner = F.substring(v, F.lit(2), F.greatest(F.length(v) - 2, F.lit(0))).try_cast("decimal(18,2)")
    return F.when(v.startswith("("), -inner).otherwise(v.try_cast("decimal(18,2)")).cast("decimal(18,2)")


def check_total(total: Column, parts: Column) -> Column:
    """Whether the parts sum to the total within a cent; null where one is no number."""
    numbers = F.transform(parts, number)
    total_number = number(total)
    broken = total_number.isNull() | F.exists(numbers, lambda x: x.isNull())
    summed = F.aggregate(numbers, F.lit(0).cast("decimal(28,2)"), lambda a, x: (a + x).cast("decimal(28,2)"))
    return F.when(~broken, F.abs(total_number - summed) <= F.lit("0.01").cast("decimal(3,2)"))


def extract_value(kind: Column, raw: Column) -> Column:
    """The typed token of a region's text; the longest one with a digit for accounts and folios; else the text."""
    text = F.btrim(F.regexp_replace(F.coalesce(raw, F.lit("")), r"\s+", " "))
    first = lambda *ps: F.coalesce(*[F.nullif(F.regexp_extract(text, f"(?i)({p})", 1), F.lit("")) for p in ps])

    months = f"(?:{_NAMES})"
    day = first(rf"del\s+\d{{1,3}}\s+de\s+{months}\s+al\s+\d{{1,3}}\s+de\s+{months}\s+de\s+\d{{4}}", r"(?<!\d)\d{1,3}/\d{1,2}/\d{4}(?!\d)", rf"(?<!\d)\d{{1,3}}\s+de\s+{months}\s+(?:de|del)\s+\d{{4}}", rf"{months}\s+de\s+\d{{4}}")
    amount = first(r"(?<![\w,.])(?:\(\$?\s*\d[\d,]*\.\d{2}\)|\$?\s*-?\d[\d,]*\.\d{2})(?!\d|[.,]\d)")
    account, folio = r"[A-Za-z0-9](?:[A-Za-z0-9.:,]*[A-Za-z0-9])?", r"[A-Za-z0-9]+(?:[-/][A-Za-z0-9]+)*"

    def pick(pattern: str) -> Column:  # the first of the longest
        found = F.filter(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), lambda x: x.rlike(r"\d"))
        return F.try_element_at(F.filter(found, lambda x: F.length(x) == F.array_max(F.transform(found, F.length))), F.lit(1))

    return F.coalesce(F.when(kind == "fecha", day).when(kind == "importe", amount).when(kind == "cuenta", pick(account)).otherwise(pick(folio)), text)


def crop_score(kind: Column, raw: Column, confidences: Column) -> Column:
    """How well a region was read: mean confidence, more for a valid value, less for mixed-up characters and many words.

    No words: a mean of nought.  Null confidences count as nought.
    """
    issues = validate_field(kind, extract_value(kind, raw), F.lit(None).cast("double"))
    valid = ~F.arrays_overlap(issues, F.array(*map(F.lit, ("formato_invalido", "fecha_invalida", "sin_lectura"))))
    words = F.greatest(F.coalesce(F.size(confidences), F.lit(0)), F.lit(0))
    total = F.aggregate(F.coalesce(confidences, F.array().cast("array<double>")), F.lit(0.0), lambda a, c: a + F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0)))
    confused = F.array_contains(issues, "confusion_alfanumerica")
    return total / F.greatest(words, F.lit(1)) + F.when(valid, 20).otherwise(0) - F.when(confused, 15).otherwise(0) - 2 * F.greatest(words - 12, F.lit(0))


def reading_error(raw: Column, expected: Column) -> Column:
    """sin_error, omitido, separadores_o_formato or lectura_incorrecta."""
    value, aim = F.lower(normalize(raw)), F.lower(normalize(expected))
    bare = lambda x: F.regexp_replace(x, r"(?U)\W", "")
    return F.when(value == aim, "sin_error").when(value == "", "omitido").when(bare(value) == bare(F.lower(expected)), "separadores_o_formato").otherwise("lectura_incorrecta")


def rotate_box(box: Column, angle: Column) -> Column:
    """A normalised box (x0, y0, x1, y1) on a page turned by a multiple of 90 degrees."""
    x0, y0, x1, y1 = (F.element_at(box, i) for i in (1, 2, 3, 4))
    return F.when(angle == 90, F.array(1 - y1, x0, 1 - y0, x1)).when(angle == 180, F.array(1 - x1, 1 - y1, 1 - x0, 1 - y0)).when(angle == 270, F.array(y0, 1 - x1, y1, 1 - x0)).otherwise(box)


def centre_inside(word: Column, region: Column) -> Column:
    """Whether the centre of a word's box lies in a region's box."""
    mid = lambda i: (F.element_at(word, i) + F.element_at(word, i + 2)) / 2
    return mid(1).between(F.element_at(region, 1), F.element_at(region, 3)) & mid(2).between(F.element_at(region, 2), F.element_at(region, 4))


def page_jobs(requested: Column, workers: Column, free_gib: Column, cpus: Column) -> Column:
    """Pages read at a time by a worker: what was asked for, its memory slots, its processors; one at least."""
    slots = F.greatest(F.lit(1), F.floor((free_gib - 1) / 0.65))
    return F.when(free_gib.isNull(), 1).otherwise(F.greatest(F.lit(1), F.least(requested, F.floor(slots / workers), F.greatest(F.lit(1), F.floor(cpus / workers))))).cast("int")
