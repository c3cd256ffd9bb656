import uuid
from datetime import date, datetime

import pytest

from priorview.functions import scalars as S


@pytest.fixture
def of(spark):
    def value(build, text):
        made = build("c")
        cols = made if isinstance(made, tuple) else (made,)
        got = tuple(spark.createDataFrame([(text,)], "c string").select(*[c.alias(f"v{i}") for i, c in enumerate(cols)]).first())
        return got if isinstance(made, tuple) else got[0]

    return value


@pytest.mark.parametrize("build, text, expected", [
    (S.text, "  x ", "x"), (S.text, "  ", None), (S.integer, "", 0), (S.integer, " 7 ", 7), (S.real, "", None), (S.iso_date, "2020-02-03", date(2020, 2, 3)), (S.utc_timestamp, "2026-03-18 10:20:30 UTC", datetime(2026, 3, 18, 10, 20, 30)), (S.utc_timestamp, "", None),
    (S.weight_class, "Women's Strawweight Bout", "women_strawweight"), (S.weight_class, "Light Heavyweight Title Bout", "light_heavyweight"), (S.weight_class, "Tournament Title Bout", None), (S.title_flags, "Interim Title Bout", (True, True)), (S.title_flags, None, (False, False)),
    (S.finish, " TKO - Doctor's Stoppage", "doctor_stoppage"), (S.finish, "nonsense", None), (S.clean, " a\n\t b ", "a b"), (S.without_www, "http://www.a.org/www.b", "http://a.org/www.b"),
    (S.uuid5, "http://example.org/x?y=é", str(uuid.uuid5(uuid.NAMESPACE_URL, "http://example.org/x?y=é"))), (S.landed_attempted, "121 of 193", (121, 193)), (S.landed_attempted, "---", (0, 0)),
    (S.long_date, "March 18, 2026", date(2026, 3, 18)), (S.long_date, "18.3.2026", None), (S.short_date, "--", None), (S.short_date, "Jul 02, 1990", date(1990, 7, 2)), (S.location, "Las Vegas, Nevada, USA", ("Las Vegas", "Nevada", "USA")), (S.location, "Abu Dhabi, UAE", ("Abu Dhabi", "", "UAE")), (S.location, "x", ("", "", "")),
    (S.height, "6' 0\"", (6, 0, 182.88)), (S.height, "--", (None, None, None)), (S.first_number, "185 lbs.", 185), (S.reach_cm, '73"', 185), (S.record, "Record: 27-9-0 (1 NC)", (27, 9, 0, 1)), (S.record, "?", (0, 0, 0, 0)),
    (S.split_name, "Ana  Maria Silva", ("Ana", "Maria Silva")), (S.split_name, "Ana", ("Ana", "")), (S.split_finish, "Decision - Unanimous", ("decision", "unanimous")), (S.split_finish, "KO/TKO", ("ko/tko", None)), (S.split_finish, " Technical Decision - Split ", ("technical decision", "split")), (S.split_finish, "Decision", ("decision", None)), (S.split_finish, "TKO - Doctor's Stoppage", ("tko - doctor's stoppage", None)), (S.clock, "3:21", (3, 21)), (S.clock, "--", (0, 0)),
    (S.raw_weight_class, "Light Heavyweight Bout", "heavyweight"), (S.raw_weight_class, "Women's Strawweight Bout", "women's strawweight"), (S.raw_weight_class, "Strawweight Bout", None), (S.raw_weight_class, "Women's Flyweight Bout", "flyweight"), (S.entity_of_url, "http://a/fight-details/1", "fight"), (S.entity_of_url, "http://a", "unknown"), (S.parted, "a, b,, c", ["a", "b", "c"]), (S.hrefs, '<a class="x" href="/fight-details/1">x</a> <A HREF="/y">', ["/fight-details/1", "/y"]),
])
def test_goldens(of, build, text, expected):
    assert of(build, text) == expected


def test_outcomes_clocks_and_percentages(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("W", "L", "1", "30"), ("L", "W", "0", "0"), ("D", "D", "", ""), ("NC", "NC", "", "")], "a string, b string, m string, s string")
    r, w = S.outcome("a", "b", F.lit("one"), F.lit("two"))
    assert [tuple(x) for x in df.select(r, w).collect()] == [("win", "one"), ("win", "two"), ("draw", None), ("nc", None)]
    assert [tuple(x) for x in df.select(S.clock_seconds("m", "s"), S.clock_seconds("m", "s", True)).collect()] == [(90, 90), (0, None), (0, None), (0, None)]
    assert spark.range(1).select(S.percent(F.lit(1), F.lit(8)), S.percent(F.lit(123456), F.lit(10)), S.percent(F.lit(1), F.lit(0)), S.joined(F.array(F.lit("a"), F.lit("b")))).first() == ("12.5%", "1234560.0%", "n/a", "a, b")
