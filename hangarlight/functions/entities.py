"""Character references of HTML as column expressions: numeric ones and the full named table, decoded in one pass."""

from __future__ import annotations

from functools import cache
from html.entities import html5
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of a reference, complete or not, in texts as browsers read them.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT = "�"


def _escaped(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


@cache
def _named_sql() -> str:
    """The table of names as maps of maps by a name's first character, so that a lookup passes over few keys."""
    by_first = groupby(sorted(html5.items()), key=lambda kv: kv[0][0])
    inner = [f"'{first}', map({', '.join(f"'{_escaped(k)}', '{_escaped(v)}'" for k, v in group)})" for first, group in by_first]
    return f"map({', '.join(inner)})"


#: Names that count without a semicolon, and so as the beginning of a longer one as well: their lengths.
_BARE = sorted({len(k) for k in html5 if not k.endswith(";")}, reverse=True)


def _windows_1252(k: int) -> str:
    """What a reference to one of the control codes 0x80 to 0x9f stands for."""
    try:
        return bytes([k]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(k)


def _numeric(ref: Column) -> Column:
    """The character of ``#38;`` or ``#x26;``."""
    hexadecimal = F.lower(F.substring(ref, 2, 1)) == "x"
    digits = F.regexp_replace(ref, "^#[xX]?0*|;$", "")
    base = lambda k: F.conv(digits, k, 10)
    # Longer numbers are beyond all characters.
    value = F.when(digits == "", "0").when(F.length(digits) > 10, str(0x110000)).when(hexadecimal, base(16)).otherwise(base(10))
    code = F.least(value.cast("long"), F.lit(0x110000).cast("long")).cast("int")
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    old = F.array(*[F.lit(_windows_1252(k)) for k in range(0x80, 0xA0)])
    invalid = (
        code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), REPLACEMENT)
        .when(code == 0xD, "\r")
        .when(code.between(0x80, 0x9F), F.get(old, code - 0x80))
        .when(invalid, "")
        .otherwise(character)
    )


def _named(ref: Column) -> Column:
    """The characters of a name, else those of its longest beginning that is one; as it stands if there is none."""
    table = F.try_element_at(F.expr(_named_sql()), F.substring(ref, 1, 1))
    of = lambda name: F.try_element_at(table, name)
    beginnings = [F.when(F.length(ref) > n, F.concat(of(F.substring(ref, 1, n)), F.substring(ref, F.lit(n + 1), F.length(ref)))) for n in _BARE]
    return F.coalesce(of(ref), *beginnings, F.concat(F.lit("&"), ref))


def unescape(text: Column) -> Column:
    """Each reference decoded once, so that ``&amp;lt;`` becomes ``&lt;``. The text is cut at its references and joined again."""
    refs = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))
    decoded = F.transform(refs, lambda r: F.when(r.startswith("#"), _numeric(r)).otherwise(_named(r)))
    pieces = F.split(text, REFERENCE, -1)
    joined = F.array_join(F.zip_with(pieces, decoded, lambda p, d: F.concat(p, F.coalesce(d, F.lit("")))), "")
    return F.when(text.contains("&"), joined).otherwise(text)
