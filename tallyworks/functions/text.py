"""Tolerant text cleaning as Column functions; none of them raises on data."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: texts that stand for no value, compared without case
MISSING = ("", "-", "--", "n/a", "null", "none", "k.a.", "k. a.")
# fixed values: parts of city names that stay lower-case
PARTICLES = ("am", "an", "auf", "bei", "der", "die", "das", "dem", "den", "im", "in", "ob", "unter", "vor", "von", "zu", "zum", "zur", "und", "a.", "d.")


@cache
def _decompositions() -> tuple[str, str, str, str]:
    """How compatibility decomposition (NFKD) without combining marks changes single characters, by that rule.

    (from, to, many, table): translate()'s arguments, marks at the end of `from` without a counterpart; a character class of
    those that become several characters, and these with what they become, each as \x01 character \x02 text. Hangul
    syllables stay as they are: what they decompose to is in no key.
    """
    one, none, many = {}, [], {}
    for code in range(0x80, 0x110000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        letter = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(plain) > 1:
            many[letter] = plain
        elif not plain:
            none.append(letter)
        elif plain != letter:
            one[letter] = plain
    members = "".join(f"\\x{{{ord(c):X}}}" for c in many)
    return "".join(one) + "".join(none), "".join(one.values()), f"[{members}]", "".join(f"\x01{c}\x02{t}" for c, t in many.items()) + "\x01"


_MISSING = rf"(?iU)^\s*({'|'.join(map(re.escape, MISSING))})\s*$"


def once(x: Column, use: Callable[[Column], Column]) -> Column:
    """use(x) with x computed once a row however often use refers to it; else the text of an expression grows with each reference."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def is_missing(x: Column) -> Column:
    return F.coalesce(F.rlike(x, F.lit(_MISSING)), F.lit(True))


def trim_text(x: Column) -> Column:
    """White space of any script at the edges goes; nothing left, or a missing marker, is null."""
    return F.when(~is_missing(x), F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))


def clean_text(x: Column) -> Column:
    """Edges trimmed, inner white space one space, missing markers null."""
    return F.when(~is_missing(x), F.btrim(F.regexp_replace(x, r"(?U)\s+", " ")))


def transliterate(x: Column) -> Column:
    """German letters spelt out; of all others what NFKD leaves without combining marks (é e, ș s, ﬁ fi, ² 2; ø, ł and ı stay)."""
    spelt_out = x
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss"), ("ẞ", "SS")):
        spelt_out = F.replace(spelt_out, F.lit(a), F.lit(b))
    before, after, many, table = _decompositions()

    def spelt(letter: Column) -> Column:
        at = F.instr(F.lit(table), F.concat(F.lit("\x01"), letter, F.lit("\x02")))
        return F.when(at > 0, F.substring_index(F.substr(F.lit(table), at + 3), "\x01", 1)).otherwise(letter)

    # the few texts with letters that become several go letter by letter
    rest = lambda t: F.when(t.rlike(many), F.array_join(F.transform(F.regexp_extract_all(t, F.lit("(?s)."), F.lit(0)), spelt), "")).otherwise(t)
    return F.when(x.rlike(r"[^\x00-\x7F]"), once(F.translate(spelt_out, before, after), rest)).otherwise(x)


def ascii_fold(x: Column) -> Column:
    return F.lower(transliterate(x))


def slugify(x: Column) -> Column:
    folded = once(clean_text(x), ascii_fold)
    out = F.regexp_replace(F.regexp_replace(folded, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return once(out, lambda t: F.when(F.length(t) > 0, t))


def name_key(*parts: Column) -> Column:
    """Folded name tokens in order, so that word order does not matter; no token: null."""
    tokens = F.sort_array(F.regexp_extract_all(ascii_fold(F.concat_ws(" ", *parts)), F.lit("[a-z0-9]+"), F.lit(0)))
    return F.when(F.size(tokens) > 0, F.array_join(tokens, " "))


def split_name(x: Column) -> Column:
    """struct(last, first) of "Last, First" or "First Last"."""
    name = clean_text(x)
    comma = F.contains(name, F.lit(","))
    words = F.split(name, " ")
    many = F.size(words) > 1
    last = F.when(comma, clean_text(F.substring_index(name, ",", 1))).otherwise(F.element_at(words, -1))
    first = F.when(comma, clean_text(F.regexp_replace(name, "^[^,]*,", ""))).otherwise(F.when(many, F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), " ")))
    return F.struct(last.alias("last"), first.alias("first"))


def _capital(word: Column) -> Column:
    """First letters of the parts between hyphens and apostrophes raised; a part in one case is lowered first."""

    def up(p: Column) -> Column:
        rest = F.substring(p, F.lit(2), F.length(p))
        return F.concat(F.upper(F.substring(p, 1, 1)), F.when((p == F.upper(p)) | (p == F.lower(p)), F.lower(rest)).otherwise(rest))

    return F.array_join(F.transform(F.regexp_extract_all(word, F.lit("[^-'’]+|[-'’]"), F.lit(0)), up), "")


def person_name(x: Column) -> Column:
    """Every part of a name capitalized."""
    return F.array_join(F.transform(F.split(clean_text(x), " "), _capital), " ")


def city_name(x: Column) -> Column:
    """Every word capitalized but for the particles after the first."""
    words = F.split(clean_text(x), " ")
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & F.lower(w).isin(*PARTICLES), F.lower(w)).otherwise(_capital(w))), " ")


def normalize_email(x: Column) -> Column:
    return F.replace(F.lower(trim_text(x)), F.lit("ß"), F.lit("ss"))


def is_email(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), F.lit(False))


def normalize_upper(x: Column) -> Column:
    return F.upper(clean_text(x))
