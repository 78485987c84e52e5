"""Controlled vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ascii_fold, clean_text, slugify, trim_text

# fixed values: the domains of the source systems
FUNDING = ("bildungsgutschein", "selbstzahler", "firmenkunde")
VARIANTS = ("vollzeit", "teilzeit", "berufsbegleitend")
EVENTS = ("module_started", "exercise_submitted", "quiz_passed", "module_completed")
STATUSES = ("angemeldet", "aktiv", "pausiert", "abgeschlossen", "abgebrochen", "storniert")
OPEN_STATUSES = STATUSES[:3]
STATES = ("Baden-Württemberg", "Bayern", "Berlin", "Brandenburg", "Bremen", "Hamburg", "Hessen", "Mecklenburg-Vorpommern", "Niedersachsen", "Nordrhein-Westfalen", "Rheinland-Pfalz", "Saarland", "Sachsen", "Sachsen-Anhalt", "Schleswig-Holstein", "Thüringen")
QUESTIONS = {"zufriedenheit_gesamt": "wochenfeedback", "tempo": "wochenfeedback", "freitext": "wochenfeedback", "nps": "abschlussfeedback", "zufriedenheit_coach": "abschlussfeedback", "weiterempfehlung_grund": "abschlussfeedback"}
RANGES = {"zufriedenheit_gesamt": (1, 5), "zufriedenheit_coach": (1, 5), "tempo": (1, 5), "nps": (0, 10)}
LIGHTS = {"gruen": "green", "g": "green", "green": "green", "gelb": "yellow", "yellow": "yellow", "rot": "red", "r": "red", "red": "red"}
TRUE, FALSE = ("true", "1", "yes", "y", "ja", "j", "wahr"), ("false", "0", "no", "n", "nein", "falsch")


def standardize(x: Column, allowed: tuple[str, ...] | None) -> Column:
    """struct(value, status): the slug, or unknown if there is none; status mapped, missing or, outside allowed, unmapped."""
    return standard(slugify(x), allowed)


def standard(slug: Column, allowed: tuple[str, ...] | None) -> Column:
    """standardize() of a slug that is there as a column, so that it is not computed for each use."""
    ok = F.lit(True) if allowed is None else slug.isin(*allowed)
    status = F.when(slug.isNull(), "missing").when(ok, "mapped").otherwise("unmapped")
    return F.struct(F.coalesce(slug, F.lit("unknown")).alias("value"), status.alias("status"))


def lookup(key: Column, table: dict[str, str]) -> Column:
    """The table's value under the key, which is computed once; a key that it lacks is null."""
    return F.try_element_at(F.create_map(*[F.lit(v) for pair in table.items() for v in pair]), key)


def _folded(s: str) -> str:
    return s.lower().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue")


def federal_state(x: Column) -> Column:
    """The state whose folded name the text is; spellings that differ in more than case and umlauts are null."""
    return lookup(ascii_fold(clean_text(x)), {_folded(s): s for s in STATES})


def traffic_light(x: Column) -> Column:
    return lookup(F.regexp_replace(ascii_fold(clean_text(x)), "[^a-z]", ""), LIGHTS)


def parse_boolean(x: Column) -> Column:
    key = F.lower(trim_text(x))
    return F.when(key.isin(*TRUE), True).when(key.isin(*FALSE), False)
