"""Text columns: name keys, truncation, years inside free text."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from panelwright.schema import NAME_LENGTH

# Unicode white space plus the four ASCII separators that Java's class leaves out.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
_ASCII_BLANKS = " \t\n\v\f\r\x1c\x1d\x1e\x1f"


def casefold_key(name: Column) -> Column:
    """Join key of a name: null as '', runs of white space as one blank, trimmed, case-folded.

    Upper-casing first expands what plain ``lower`` leaves alone (``ß`` -> ``SS`` -> ``ss``).
    Capital sigma is mapped by hand because ``lower`` picks its form by position, and the
    dotless i takes a detour through a private-use character because it must survive.
    """
    folded = F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), _SPACES, " "))
    for old, new in (("ẞ", "ß"), ("ı", "\ue000")):
        folded = F.replace(folded, F.lit(old), F.lit(new))
    folded = F.upper(folded)
    for old, new in (("Σ", "σ"), ("\ue000", "ı")):
        folded = F.replace(folded, F.lit(old), F.lit(new))
    return F.lower(folded)


def upper_key(name: Column) -> Column:
    return F.upper(F.trim(name))


def exact_key(name: Column) -> Column:
    return name


@cache
def _ascii_of() -> tuple[str, str, dict[str, str]]:
    """What NFKD leaves of each sign once all but ASCII is dropped, by Python's Unicode data: signs that become
    one character, these characters, and signs that become several. The rest becomes nothing."""
    one, several = {}, {}
    for code in range(0x80, 0x110000):
        if not 0xD800 <= code < 0xE000:
            left = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
            if left:
                (one if len(left) == 1 else several)[chr(code)] = left
    return "".join(one), "".join(one.values()), several


def _class_of(signs: Iterable[str]) -> str:
    """Regular expression for one of the signs, neighbours as ranges."""
    codes, ranges = sorted(map(ord, signs)), []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def accent_fold(name: Column) -> Column:
    """NFKD, drop what is not ASCII, upper-case, strip; null as ''.

    Decomposing and then dropping all but ASCII acts on each sign alone, so a table of signs does it with
    built-in functions. Signs that become several characters (ligatures, units, fractions) are rare: only
    names that hold one are taken apart. A plain name costs one look.
    """
    one, ones, several = _ascii_of()
    text = F.coalesce(name.cast("string"), F.lit(""))
    table = F.from_json(F.lit(json.dumps(several)), MapType(StringType(), StringType()))
    apart = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")
    spelt = F.when(text.rlike(_class_of(several)), apart).otherwise(text)
    folded = F.regexp_replace(F.translate(spelt, one, ones), r"[^\x00-\x7F]", "")
    return F.btrim(F.upper(F.when(text.rlike(r"[^\x00-\x7F]"), folded).otherwise(text)), F.lit(_ASCII_BLANKS))


def first_chars(name: Column, length: int = NAME_LENGTH) -> Column:
    return F.substring(name, 1, length)


def extract_year(text: Column) -> Column:
    """First 19xx or 20xx in the text, else null."""
    found = F.regexp_extract(text.cast("string"), r"(?:19|20)\d{2}", 0)
    return F.nullif(found, F.lit("")).cast("int")
