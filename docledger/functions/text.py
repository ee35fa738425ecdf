"""Scalar functions on text, amounts, dates, names and identifiers, as Spark columns.

All are JVM-side except `name_similarity`, whose sequence ratio has no builtin: an Arrow function that joins
run only on blocked pairs.  Null in, null out unless a function says otherwise.
"""

from __future__ import annotations

import json
import unicodedata
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.functions import fixed


def _decomposed() -> tuple[str, str, dict[str, str]]:
    """Characters with a compatibility form: those of one character with it, combining marks, and those of several.

    Syllables of Hangul, which are composed by a rule, are left as they are.
    """
    single, several, marks = [], {}, []
    for code in range(0x80, 0x10000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if not plain:
            marks.append(chr(code))
        elif plain != chr(code):
            single.append((chr(code), plain)) if len(plain) == 1 else several.update({chr(code): plain})
    return "".join(a for a, _ in single) + "".join(marks), "".join(b for _, b in single), several


_SINGLE, _PLAIN, _SEVERAL = _decomposed()
_ELLIPSIS = "\u2026"  # the only one that is common


def _ranges(characters) -> str:
    """A class of the characters as few ranges, as a search tries them one after another."""
    out: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if out and code == out[-1][1] + 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out) + "]"


#: Letters and signs of usual texts beyond ASCII, none of which is spelled out; what has others is searched for such.
_USUAL = "".join(chr(c) for c in [*range(0x80, 0x132), *range(0x2010, 0x2028), 0x20AC] if chr(c) not in _SEVERAL)
_SEVERAL_CLASS = _ranges(set(_SEVERAL) - {_ELLIPSIS})


def fold(text: Column) -> Column:
    """In compatibility form without accents, upper case."""
    table = F.from_json(F.lit(json.dumps(_SEVERAL)), "map<string,string>")  # folded into a constant; read for rare texts only
    plain = F.replace(text, F.lit(_ELLIPSIS), F.lit("..."))
    rest = F.translate(plain, _USUAL, "")
    letters = F.regexp_extract_all(plain, F.lit("(?s)(.)"), F.lit(1))
    spelled = F.array_join(F.transform(letters, lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.upper(F.translate(F.when((F.octet_length(rest) > F.length(rest)) & plain.rlike(_SEVERAL_CLASS), spelled).otherwise(plain), _SINGLE, _PLAIN))


def folded(text: str) -> str:
    """`fold` of one string on the driver, as of a search term."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).upper()


def clean_space(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"(?U)\s+", " "), F.lit(" |:;,-"))


def snippet(text: Column, start: Column, end: Column, radius: int = 100) -> Column:
    """Around the characters start..end (from 0), clamped to the text."""
    begin = F.greatest(start - radius, F.lit(0))
    return clean_space(F.substring(text, begin + 1, end + radius - begin))


def first_group(text: Column, pattern: str, flags: str = "(?im)") -> Column:
    """The first group of the first match, cleaned; null if there is none or it is empty."""
    return F.nullif(clean_space(F.regexp_extract(text, flags + pattern, 1)), F.lit(""))


def money_value(raw: Column) -> Column:
    """Amount of a rendered number: `$`, commas and blanks go, parentheses make it negative; else null."""
    negative = F.btrim(raw).startswith("(") & F.btrim(raw).endswith(")")
    digits = F.regexp_replace(raw, r"[$,()\s]", "").try_cast("decimal(18,2)")
    return F.when(negative, -digits).otherwise(digits).cast("decimal(18,2)")


def first_money(text: Column, pattern: str) -> Column:
    return money_value(F.nullif(F.regexp_extract(text, "(?ims)" + pattern, 1), F.lit("")))


def parse_amount(raw: Column) -> Column:
    """struct(amount, status): vacio, numerico, recuperado_separadores or invalido.

    A text whose last separator leaves two digits is recovered by dropping the separators before it.
    """
    text = F.regexp_replace(F.btrim(F.coalesce(raw, F.lit(""))), r"[$ ]", "")
    plain = F.when(text.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), text).try_cast("decimal(38,10)").cast("decimal(18,2)")
    whole = F.regexp_replace(F.regexp_extract(text, r"^(.*)[.,]\d\d$", 1), "[.,]", "")
    saved = F.when(whole.rlike(r"^-?\d+$"), F.concat(whole, F.lit("."), F.right(text, F.lit(2)))).try_cast("decimal(18,2)")
    status = F.when(text == "", "vacio").when(plain.isNotNull(), "numerico").when(saved.isNotNull(), "recuperado_separadores").otherwise("invalido")
    return F.struct(F.coalesce(plain, saved).alias("amount"), status.alias("status"))


def month_number(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in fixed.MONTHS.items() for x in pair])
    return F.try_element_at(table, name)


def make_day(day: Column, month: Column, year: Column) -> Column:
    """A date of three numbers; two-digit years are 20yy; null if there is no such day."""
    day, month, year = (x.try_cast("int") for x in (day, month, year))
    year = F.when(year < 100, year + 2000).otherwise(year)
    return F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year, month, day), F.lit("yyyy-MM-dd")).cast("date")


def numeric_date(text: Column) -> Column:
    """A date written d/m/y or d-m-y."""
    part = lambda i: F.nullif(F.regexp_extract(text, r"(\d{1,2})[/-](\d{1,2})[/-](20\d{2}|\d{2})", i), F.lit(""))
    return make_day(part(1), part(2), part(3))


def date_text(text: Column) -> Column:
    """A date written d/MMM/y or d/m/y, months abbreviated in Spanish."""
    part = lambda i: F.nullif(F.regexp_extract(fold(text), r"(\d{1,2})[/-]([A-Z]{3}|\d{1,2})[/-](20\d{2}|\d{2})", i), F.lit(""))
    return make_day(part(1), F.coalesce(month_number(part(2)).cast("string"), part(2)), part(3))


def normalize_date(text: Column) -> Column:
    """The first kind that is there decides: ISO, written in Spanish, numeric."""
    value = F.btrim(fold(F.coalesce(text, F.lit(""))))
    iso = lambda i: F.regexp_extract(value, r"\b(20\d{2})-(\d{2})-(\d{2})\b", i)
    written = lambda i: F.regexp_extract(value, r"(\d{1,2})\s+(?:DE\s+)?([A-Z]+)\s+(?:DE\s+)?(20\d{2})", i)
    month = month_number(written(2))
    return F.when(iso(1) != "", make_day(iso(3), iso(2), iso(1))).when(month.isNotNull(), make_day(written(1), month.cast("string"), written(3))).otherwise(numeric_date(value))


def date_distance(left: Column, right: Column) -> Column:
    return F.abs(F.datediff(left, right))


def valid_embedded_date(identity: Column) -> Column:
    """Whether the first six digits are a day of this century as yymmdd."""
    digits = F.regexp_extract(identity, r"(\d{6})", 1)
    return (digits != "") & F.try_to_timestamp(F.concat(F.lit("20"), digits), F.lit("yyyyMMdd")).isNotNull()


def clean_person_name(text: Column) -> Column:
    """The name, or null where it has digits, label words, or not two to eight words."""
    name = F.btrim(F.regexp_replace(F.btrim(clean_space(text), F.lit("._-|:;")), r"(?i)RFC$", ""))
    words = F.regexp_count(F.upper(name), F.lit(r"[A-ZÁÉÍÓÚÜÑ]{2,}"))
    return F.when(~name.rlike(r"\d") & ~fold(name).rlike(r" RFC|ISR|ASIMILADOS|PERIODO|FECHA|EJERCICIO") & words.between(2, 8), name)


def record_key(record_type: Column, document_id: Column, discriminator: Column) -> Column:
    return F.sha2(F.concat_ws("|", record_type, document_id, F.coalesce(discriminator, F.lit(""))), 256)


def link_id(source: Column, target: Column, relation: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", source, target, relation), 256), 1, 24)


def case_id(keys: Column) -> Column:
    """Of an array of record keys, in any order."""
    return F.concat(F.lit("TR-"), F.upper(F.substring(F.sha2(F.array_join(F.array_sort(keys), "|"), 256), 1, 16)))


def folder_period(path: Column) -> Column:
    """struct(month_number, folder) of the first part of a path; month null unless it leads with 1 to 12."""
    folder = F.split_part(path, F.lit("/"), F.lit(1))
    number = F.nullif(F.regexp_extract(folder, r"^\s*(\d{1,2})", 1), F.lit("")).try_cast("int")
    return F.struct(F.when(number.between(1, 12), number).alias("month_number"), folder.alias("folder"))


def path_month(path: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(path, r"^(\d{1,2})\.", 1), F.lit("")).try_cast("int"), F.lit(0))


def identifier(value: Column) -> Column:
    """The digits without leading zeros; "0" if none is left."""
    digits = F.ltrim(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"\D", ""), F.lit("0"))
    return F.when(digits == "", "0").otherwise(digits)


def file_stem(path: Column) -> Column:
    name = F.substring_index(path, "/", -1)
    return F.when(name.rlike(r".\.[^.]+$"), F.regexp_replace(name, r"\.[^.]+$", "")).otherwise(name)


def path_numbers(path: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(file_stem(path), F.lit(r"(\d+)"), F.lit(1)), identifier))


def concept_words(text: Column) -> Column:
    words = F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(r"([A-Z]{4,})"), F.lit(1))
    return F.array_except(F.array_distinct(words), F.array(*map(F.lit, fixed.CONCEPT_STOPWORDS)))


def normalize_name(text: Column) -> Column:
    words = F.split(F.regexp_replace(fold(F.coalesce(text, F.lit(""))), "[^A-Z ]", " "), " +")
    stop = F.array(*map(F.lit, fixed.NAME_STOPWORDS))
    return F.array_join(F.filter(words, lambda w: (w != "") & ~F.array_contains(stop, w)), " ")


@F.arrow_udf(T.DoubleType())
def _ratio(left: pa.Array, right: pa.Array) -> pa.Array:
    pairs = list(zip(left.to_pylist(), right.to_pylist()))
    known = {p: SequenceMatcher(None, *p).ratio() for p in set(pairs)}  # names recur
    return pa.array([known[p] for p in pairs], pa.float64())


def word_overlap(left: Column, right: Column) -> Column:
    """Jaccard similarity of the words of two normalised names; 0 where one is empty."""
    a, b = (F.array_distinct(F.split(x, " ")) for x in (left, right))
    return F.when((left == "") | (right == ""), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def name_similarity(left: Column, right: Column) -> Column:
    """The larger of word overlap and sequence ratio of two normalised names (in this order)."""
    return F.when((left == "") | (right == ""), 0.0).otherwise(F.greatest(word_overlap(left, right), _ratio(left, right)))


def coverage_label(pages: Column, pages_with_text: Column, characters: Column) -> Column:
    """sin_texto, amplia, parcial or baja by the share of pages with text and characters a page."""
    n = F.greatest(pages, F.lit(1))
    share, density = pages_with_text / n, characters / n
    empty = (F.coalesce(pages_with_text, F.lit(0)) == 0) | (F.coalesce(characters, F.lit(0)) == 0)
    return F.when(empty, "sin_texto").when((share >= 0.95) & (density >= 100), "amplia").when((share >= 0.70) & (density >= 40), "parcial").otherwise("baja")


def local_link(path: Column, page: Column) -> Column:
    """A file URI with a page fragment; the path's parts are percent-encoded."""
    encoded = F.array_join(F.transform(F.split(path, "/"), lambda p: F.replace(F.url_encode(p), F.lit("+"), F.lit("%20"))), "/")
    return F.concat(F.lit("file://"), encoded, F.when(page.isNotNull(), F.concat(F.lit("#page="), page.cast("string"))).otherwise(""))


def rejection(code: Column, message: Column) -> Column:
    """signed, encrypted or failed, by an engine's exit code and message."""
    said = F.lower(F.coalesce(message, F.lit("")))
    return F.when(said.rlike("digital ?signature|digitally signed"), "signed").when((code == 8) | said.rlike("encryptedpdf|password"), "encrypted").otherwise("failed")
