import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyworks.functions import categories as K
from tallyworks.functions import dates, numbers, text


def values(spark, fn, given):
    df = spark.createDataFrame(list(enumerate(given)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_text(spark):
    assert values(spark, text.clean_text, ["  a \t b c ", "n/a", " K.A. ", "", None, "na"]) == ["a b c", None, None, None, None, "na"]
    assert values(spark, text.ascii_fold, ["Müller", "STRASSE ẞß", "é́ ö", "Łódź"]) == ["mueller", "strasse ssss", "e o", "łodz"]
    assert values(spark, text.slugify, ["Bildungs-Gutschein ", "--", "Ä & B"]) == ["bildungs_gutschein", None, "ae_b"]
    assert values(spark, lambda x: text.name_key(x), ["Last, First", "first LAST", "..."]) == ["first last", "first last", None]
    assert values(spark, text.person_name, ["  anna-lena ", "MÜLLER", "van der berg", "McDonald", "o'neil", "d’ARC", "MÜLLER-LüDKE", None]) == ["Anna-Lena", "Müller", "Van Der Berg", "McDonald", "O'Neil", "D’Arc", "Müller-LüDKE", None]
    assert values(spark, text.city_name, ["  FRANKFURT AM MAIN ", "rothenburg OB der tauber", "neustadt in holstein", "frankfurt a. d. oder", "am see", "garmisch-partenkirchen", ""]) == ["Frankfurt am Main", "Rothenburg ob der Tauber", "Neustadt in Holstein", "Frankfurt a. d. Oder", "Am See", "Garmisch-Partenkirchen", None]
    assert values(spark, text.trim_text, ["  zwei  Worte \n", "   ", "n/a"]) == ["zwei  Worte", None, None]
    assert [tuple(v) for v in values(spark, text.split_name, ["Weber, Anna", "Anna Maria Weber", "Weber"])] == [("Weber", "Anna"), ("Weber", "Anna Maria"), ("Weber", None)]
    assert values(spark, lambda x: text.is_email(text.normalize_email(x)), [" A@B.com ", "a@b", None]) == [True, False, False]


def test_dates(spark):
    d = dt.date
    assert values(spark, dates.parse_iso_date, ["2026-01-05", "2026-1-5", "2026-02-31", None]) == [d(2026, 1, 5), None, None, None]
    assert values(spark, lambda x: dates.parse_flexible_date(x, True), ["14.06.26", "1.2.2026", "31.02.2026", "02/2026", "3/26", "2026-06-01T10:00:00", "1.1.1950"]) == [d(2026, 6, 14), d(2026, 2, 1), None, d(2026, 2, 1), d(2026, 3, 1), d(2026, 6, 1), None]
    t = lambda *a: dt.datetime(*a)
    got = values(spark, lambda x: dates.parse_local_timestamp(x).cast("timestamp_ntz"), ["2026-01-15T10:00:00", "2026-07-01 10:00", "2026-03-29T02:30:00", "2026-10-25T02:30:00", "2026-01-01T10:00:00+01:00", "x"])
    assert got == [t(2026, 1, 15, 9), t(2026, 7, 1, 8), None, None, None, None]
    assert values(spark, lambda x: dates.parse_utc_timestamp(x).cast("timestamp_ntz"), ["2026-03-01T10:00:00Z", "2026-03-01T10:00:00+02:00", "2026-03-01T10:00:00", "soon"]) == [t(2026, 3, 1, 10), t(2026, 3, 1, 8), t(2026, 3, 1, 10), None]


def test_numbers_and_categories(spark):
    assert values(spark, numbers.money, ["1.234,56", "3,5", "12.5", "1.234.567", "0,005", "x", "99999999999"]) == [Decimal("1234.56"), Decimal("3.50"), Decimal("12.50"), Decimal("1234567.00"), Decimal("0.01"), None, None]
    assert values(spark, numbers.parse_decimal, ["1.234", "-1.234", "1.234,5", "1,2,3", "nan", "+5", "- 7", "12.5", "-"]) == [Decimal(1234), Decimal("-1.234"), Decimal("1234.5"), None, None, None, Decimal(-7), Decimal("12.5"), None]
    assert [tuple(v) for v in values(spark, numbers.parse_answer, ["-1/10", "7/7,5", " 10 / 10 ", "3,5", "1/x"])] == [(Decimal(-1), Decimal(10), "ratio"), (Decimal(7), Decimal("7.5"), "ratio"), (Decimal(10), Decimal(10), "ratio"), (Decimal("3.5"), None, "number"), (None, None, "text")]
    assert values(spark, numbers.whole_number, ["5", "5.0", "5.5", "1099511627776"]) == [5, 5, None, None]
    assert [tuple(v) for v in values(spark, numbers.parse_answer, ["9", "6/10", "eleven", None])] == [(Decimal("9.00"), None, "number"), (Decimal("6.00"), 10, "ratio"), (None, None, "text"), (None, None, "missing")]
    assert values(spark, lambda x: numbers.nps_group(x.cast("int")), ["10", "8", "6", None]) == ["promoter", "passive", "detractor", None]
    assert [tuple(v) for v in values(spark, lambda x: K.standardize(x, K.STATUSES), [" Aktiv ", "", "weg"])] == [("aktiv", "mapped"), ("unknown", "missing"), ("weg", "unmapped")]
    assert values(spark, K.traffic_light, ["Grün", " R ", "gelb!", "blau", "y"]) == ["green", "red", "yellow", None, None]
    assert values(spark, K.federal_state, ["thueringen", "BADEN-württemberg", "Baden Wuerttemberg", "Wien"]) == ["Thüringen", "Baden-Württemberg", None, None]
    assert values(spark, K.parse_boolean, ["Ja", "falsch", "", "vielleicht"]) == [True, False, None, None]


def test_every_letter_decomposes(spark):
    """All characters below U+30000 but Hangul syllables, one a row, against the rule itself."""
    import unicodedata

    rows = [f"x{chr(c)}Ä" for c in range(1, 0x30000) if not 0xD800 <= c <= 0xDFFF and not 0xAC00 <= c <= 0xD7A3]
    german = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue", "ß": "ss", "ẞ": "SS"})
    want = {r: "".join(c for c in unicodedata.normalize("NFKD", r.translate(german)) if not unicodedata.combining(c)) for r in rows}
    df = spark.createDataFrame([(r,) for r in [*rows, "ﬃ😀㎏"]], "t string")
    got = {r.t: r.o for r in df.select("t", text.transliterate(df.t).alias("o")).collect()}
    assert got == want | {"ﬃ😀㎏": "ffi😀kg"}


def test_stamps_end_where_they_end(spark):
    cases = ["2026-01-05T10:00garbage", "2026-01-05T10:00Z", "2026-01-05T10:00:00+01:00", "2026-01-05 10:00:00.5", "2026-01-05T10:00"]
    assert [str(v) if v else None for v in values(spark, dates.parse_flexible_date, cases)] == [None, None, None, "2026-01-05", "2026-01-05"]
