"""Golden vectors of the text parsers, and the scalar rules."""

import pytest
from pyspark.sql import functions as F

from tasador.functions import parsing as P
from tasador.functions import scoring as S

# input, price, area, rooms
VECTORS = [
    ("350.000 €", 350000.0, 350.0, 350),
    ("1.250,50 €", 1250.5, 1.0, 1),
    ("", None, None, None),
    ("abc", None, None, None),
    (None, None, None, None),
    ("A consultar", None, None, None),
    ("Estudio", None, None, None),
    ("1,2,3", None, None, 1),
    (",", None, None, None),
    ("5,", 5.0, 5.0, 5),
    (",5", 0.5, 0.5, 5),
    ("-5", 5.0, 5.0, 5),
    ("1e5", 15.0, 1.0, 1),
    ("85 m²", 85.0, 85.0, 85),
    ("1.200 m²", 1200.0, 1.0, 1),
    ("85,5 m²", 85.5, 85.5, 85),
    ("desde, 85 m²", 0.85, None, 85),
    ("3 hab.", 3.0, 3.0, 3),
    ("350.000 € (baja 5%)", 3500005.0, 350.0, 350),
    ("0", 0.0, 0.0, 0),
    ("99999999999 hab", 99999999999.0, 99999999999.0, None),
    ("١٢٣", None, None, None),
]


def test_golden_vectors(spark):
    rows = spark.createDataFrame([(v[0],) for v in VECTORS], "t string").coalesce(1).select(
        P.parse_price(F.col("t")), P.parse_area(F.col("t")), P.parse_rooms(F.col("t"))
    ).collect()
    assert [tuple(r) for r in rows] == [v[1:] for v in VECTORS]


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("text, expected", [
    ("  gran VÍA ", "Gran Vía"), ("", "Desconocido"), ("   ", "Desconocido"), (None, "Desconocido"),
])
def test_normalize_text(spark, text, expected):
    assert one(spark, P.normalize_text(F.lit(text).cast("string"))) == (expected,)


@pytest.mark.parametrize("text, expected", [
    ("Sol, Centro", ("Sol", "Centro")), ("Sol", ("Sol", "Desconocido")),
    ("", ("Desconocido", "Desconocido")), (" Sol ,\tCentro , x", ("Sol", "Centro")),
])
def test_split_location(spark, text, expected):
    assert one(spark, *P.split_location(F.lit(text))) == expected


def test_source_slug_and_urls(spark):
    assert one(
        spark, P.source_slug(F.lit("Mi Portal.es/x-1")),
        P.absolute_url(F.lit("/a"), "https://h"), P.absolute_url(F.lit("https://o/a"), "https://h"),
        P.absolute_url(F.lit(None).cast("string"), "https://h"),
        P.synthetic_url("https://h/", F.lit(7)),
    ) == ("mi_portal_es_x-1", "https://h/a", "https://o/a", "", "https://h/7/")


def test_price_per_sqm_of_zero_area_is_null(spark):
    assert one(spark, P.price_per_sqm(F.lit(5.0), F.lit(0.0))) == (None,)


@pytest.mark.parametrize("area, band", [
    (30, (0, 1)), (45, (1, 2)), (69, (1, 2)), (70, (2, 3)), (100, (3, 4)), (140, (4, 5)), (None, (None, None)),
])
def test_room_band(spark, area, band):
    assert one(spark, *P.room_band(F.lit(area).cast("int"))) == band


def test_bathrooms(spark):
    counts = [one(spark, P.bathrooms(F.lit(r)))[0] for r in (0, 1, 3, 4, 5)]
    assert counts == [1, 1, 1, 2, 2]


def test_index_guards_nulls_and_limits(spark):
    def index(price, average):
        return one(spark, S.discount_to_average(
            F.lit(price).cast("double"), F.lit(average).cast("double")
        ))[0]

    assert index(50, 100) == 0.5
    assert index(900, 100) == -1.0
    assert index(50, None) is None and index(None, 50) is None and index(5, 0) is None


def test_index_c(spark):
    def index(price, deal=None):
        return one(spark, S.percent_below_reference(F.lit(price), F.lit(1000.0), deal))[0]

    assert (index(900.0), index(1100.0)) == (10.0, 0.0)
    assert (index(900.0, F.lit(False)), index(1100.0, F.lit(True))) == (0.0, -10.0)


@pytest.mark.parametrize("index, color", [(0.0, "#ff0050"), (1.0, "#00c850"), (-3.0, "#ff0050"), (0.25, "#bf3250")])
def test_color(spark, index, color):
    assert one(spark, S.opportunity_color(F.lit(index))) == (color,)


def test_default_date(spark):
    at = F.lit("2024-01-15 23:59:00").cast("timestamp_ntz")
    dates = one(spark, *[
        P.default_date(F.lit(d).cast("string"), at) for d in ("2024-02-01", "", None)
    ])
    assert dates == ("2024-02-01", "2024-01-15", "2024-01-15")
