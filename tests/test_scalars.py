import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from landledger.functions import scalars as s


def text(value):
    return F.lit(value).cast("string")


def test_null_skipping_concat(one):
    assert one(s.concat_present(text("a"), text(" "), text(None))) == ("a ",)
    assert one(s.prefixed_key("zone_", text(None)), s.prefixed_key("zone_", F.lit(0))) == (None, "zone_0")


def test_title_case_matches_python(one):
    for name in ("jean-pierre o'neil", "  ANNE  marie", "élodie d'ÎLE", "agent#007 b2b", "x.y z"):
        assert one(s.title_case(text(name))) == (name.strip(" ").title(),)


def test_title_case_on_random_names(spark):
    import random

    random.seed(7)
    names = ["".join(random.choices("abzéÉÎçAZ '-.\t\n12_日", k=random.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    for row in df.select("i", s.title_case(F.col("name")).alias("t")).collect():
        assert row.t == names[row.i].strip().title(), names[row.i]


def test_full_days_on_random_times(spark):
    import random

    random.seed(11)
    start = dt.datetime(2024, 1, 1)
    at = lambda: start + dt.timedelta(seconds=random.randint(-10**7, 10**7))
    pairs = [(i, at(), at()) for i in range(300)]
    df = spark.createDataFrame(pairs, "i int, a timestamp_ntz, b timestamp_ntz")
    for row in df.select("i", s.full_days(F.col("a"), F.col("b")).alias("d")).collect():
        _, a, b = pairs[row.i]
        assert row.d == int((b - a) / dt.timedelta(days=1))


def test_lenient_amounts_and_dates(one):
    for bad in ("abc", "", None):
        assert one(s.lenient_amount(text(bad))) == (Decimal("0.00"),)
    assert one(s.lenient_amount(text(" 12.345 "))) == (Decimal("12.35"),)
    assert one(s.lenient_date(text("zzz")), s.lenient_date(text(None)), s.lenient_date(text("2024-02-29"))) == (
        None, None, dt.date(2024, 2, 29))


def test_price_text(one):
    assert one(s.price_amount(text("12 €")), s.price_amount(text("1 250,50€")), s.price_amount(text("n/a"))) == (
        Decimal("12.00"), Decimal("1250.50"), None)
    prices = {"12,500 €": "12500.00", "1,234.50 EUR": "1234.50", "1.234,50 €": "1234.50", "12.5": "12.50",
              "1.234.567": "1234567.00", "1,234,567.8": "1234567.80", "1234,567": "1234.57", "-7,00": "-7.00",
              "1,2,3": None, "1.234,567.8": None, "": None, ",": None}
    assert one(*(s.price_amount(text(p)) for p in prices)) == tuple(
        None if v is None else Decimal(v) for v in prices.values())


def test_json_fields(one):
    doc = text('{"montantTotal": "1500.5", "total": "x"}')
    assert one(s.json_amount(doc, "montantTotal"), s.json_count(doc, "total"), s.json_amount(doc, "none")) == (
        Decimal("1500.50"), None, None)


def test_full_days_against_calendar_days(one):
    a, b = F.lit("2024-03-01 23:00:00"), F.lit("2024-03-03 01:00:00")
    a, b = a.cast("timestamp_ntz"), b.cast("timestamp_ntz")
    assert one(s.full_days(a, b), s.calendar_days(a, b), s.full_days(b, a)) == (1, 2, -1)


def test_date_keys(one):
    day = F.lit(dt.date(2021, 1, 3))
    none = F.lit(None).cast("date")
    assert one(s.date_key(day), s.date_key(none), s.date_key_or(none)) == (20210103, None, 20240101)


def test_calendar_labels(one):
    sunday = F.lit(dt.date(2021, 1, 3))
    assert one(s.weekday_number(sunday), s.weekday_fr(s.weekday_number(sunday)), s.month_fr(F.month(sunday)),
               F.weekofyear(sunday), s.quarter_label(sunday)) == (0, "Dimanche", "Janvier", 53, "Q1-2021")


def test_email_and_units(one):
    assert one(s.email_or_null(text("nobody")), s.email_or_null(text("a@b")), s.email_or_null(text(None))) == (
        None, "a@b", None)
    area = F.lit("25000").cast(s.MONEY)
    assert one(s.hectares(area, text("m2")), s.hectares(area, text("ha")), s.hectares(area, text(None))) == (
        Decimal("2.500000"), Decimal("25000.000000"), Decimal("25000.000000"))


def test_number_with_unit(one):
    amount = F.lit("1250000.00").cast(s.MONEY)
    assert one(s.number_with_unit(amount, "M FCFA")) == ("1.3M FCFA",)


def test_hash_keys(one):
    import hashlib
    digest = hashlib.md5(b"AGT_7_1").hexdigest().upper()
    assert one(s.hash_key("AGT", F.lit(7)), s.hash_key("AGT", F.lit(None).cast("int"))) == (
        f"AGT_{digest}", None)


def test_hash_range_stays_inside(spark):
    row = spark.range(2000).select(s.hash_range(F.col("id").cast("string"), 15, 45).alias("d")).agg(
        F.min("d"), F.max("d"), F.count_distinct("d")).first()
    assert tuple(row) == (15, 45, 31)
