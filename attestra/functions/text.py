"""Scalar text functions as column expressions: cleaning, normalising, words, first numbers, credential masks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and their plain forms, as NFKD without marks gives them.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝºª"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyyAAAAAAEEEEIIIIOOOOOUUUUNCYoa"
#: Labels whose value is a credential, and what replaces it.
CREDENTIAL = r"(?iu)\b(usuario|user(?:name)?|contrase(?:ñ|n)a|password|clave(?: de acceso)?)(\s*[:=]\s*)(\S+)"
OMITTED, MAIL_OMITTED = "[omitido]", "[correo omitido]"
EMAIL = r"[\w.+-]+@[\w-]+(\.[\w-]+)+"
#: What every page of the slides repeats, and the address that ends a page's text.
REPEATED = r"(?iu)universidad de|cundinamarca|vigilada|mineducaci|www\.|\.edu\.co|acreditaci[oó]n de alta"
PAGE_FOOT = r"www\.ucundinamarca\.edu\.co[^\n]*"
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6, "VII": 7, "VIII": 8, "IX": 9, "X": 10}
ORDINAL = {"primer": 1, "primero": 1, "segundo": 2, "tercer": 3, "tercero": 3, "cuarto": 4, "quinto": 5, "sexto": 6, "septimo": 7, "octavo": 8, "noveno": 9, "decimo": 10}


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def strip_unicode(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Every run of white space becomes one space; zero-width signs go."""
    return strip_unicode(F.regexp_replace(F.regexp_replace(c, "[​‌‍﻿]", ""), r"(?U)\s+", " "))


def page_text(c: Column, foot: str = PAGE_FOOT) -> Column:
    """A page's text without the foot and all that follows it on its line."""
    return F.regexp_replace(c, foot, "")


def clean_page(c: Column, foot: str = PAGE_FOOT) -> Column:
    """A page's text without its foot, without blank lines, with single spaces."""
    return strip_unicode(F.regexp_replace(F.regexp_replace(page_text(c, foot), r"(?U)\n\s*\n+", "\n"), r"[ \t]+", " "))


def pages(c: Column) -> Column:
    """array<struct<pagina, texto>> of a document's text, whose pages end with form feeds; a last one that is empty is none."""
    parts = F.split(c, "\f", -1)
    kept = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.transform(kept, lambda t, k: F.struct((k + 1).alias("pagina"), t.alias("texto")))


def plain(c: Column) -> Column:
    """Lower case without accents; signs outside ASCII are dropped. Texts that have none are lowered only."""
    c = F.coalesce(c, F.lit(""))
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.regexp_replace(F.lower(F.translate(c, ACCENTED, PLAIN)), r"[^\x00-\x7f]", ""))


def label_key(c: Column) -> Column:
    """Normal form of a label: plain letters and digits with single spaces."""
    return F.trim(F.regexp_replace(plain(c), "[^a-z0-9]+", " "))


def words4(c: Column) -> Column:
    """Distinct plain words of four letters or more, in order."""
    return F.array_distinct(F.regexp_extract_all(plain(c), F.lit("[a-z]{4,}"), 0))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two arrays' distinct elements; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def first_int(c: Column) -> Column:
    return F.regexp_extract(c, r"\d+", 0).try_cast("int")


def safe_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def lookup(c: Column, table: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c]


def roman(c: Column) -> Column:
    return lookup(F.upper(F.trim(c)), ROMAN)


def ordinal(c: Column) -> Column:
    return lookup(plain(F.trim(c)), ORDINAL)


def json_or_null(c: Column) -> Column:
    """JSON text of an array, null if it is empty."""
    return F.when(F.size(c) > 0, F.to_json(c))


def hide_credentials(c: Column) -> Column:
    return F.regexp_replace(c, CREDENTIAL, "$1$2" + OMITTED)


def hide_in_cells(c: Column) -> Column:
    """hide_credentials for every cell of a table (array of arrays)."""
    return F.transform(c, lambda row: F.transform(row, hide_credentials))


def novel_lines(lines: Column, known_text: Column, boilerplate: str = REPEATED) -> Column:
    """Of an array of lines, those that say something known_text does not: six signs or more, nothing that all pages repeat,
    at least 60 % letters, and at least one word of four letters that is unknown."""
    squeezed = F.transform(lines, squeeze)

    def keeps(line: Column, known: Column) -> Column:
        letters = F.length(F.regexp_replace(line, r"(?U)[^\p{L}]", ""))
        solid = F.length(F.replace(line, F.lit(" "), F.lit("")))
        return (F.length(line) >= 6) & ~F.regexp_like(line, F.lit(boilerplate)) & (letters >= 0.6 * F.greatest(solid, F.lit(1))) & (F.size(F.array_except(words4(line), known)) > 0)

    return let(words4(known_text), lambda known: F.filter(squeezed, lambda line: keeps(line, known)))


def snippet(c: Column, n: int = 220) -> Column:
    return F.substring(F.replace(c, F.lit("\n"), F.lit(" ")), 1, n)


def file_signature(length: Column, modified: Column) -> Column:
    """size-mtime of a file listing row (read.format('binaryFile'))."""
    return F.concat_ws("-", length.cast("string"), F.unix_timestamp(modified).cast("string"))


def iso_utc(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
