"""Weather documents of every form, through VARIANT and through the declared schema."""

import json

import pytest
from conftest import logical_plan_of

from assaymill.operators import weather

RECORD = {"dt": 10, "main": {"temp": 1.5, "humidity": 40}, "wind": {"speed": 2}, "weather": [{"main": "Rain"}]}


@pytest.fixture
def flat(spark):
    def run(*docs):
        texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in docs]
        df = spark.createDataFrame(list(enumerate(texts)), "id int, payload string")
        rows, dead = weather.flatten_documents(df, keep=["id"])
        return rows, dead

    return run


def test_the_four_forms(flat):
    rows, dead = flat(
        {"dt": 1, "temp": 3, "weather_main": "Rain", "weather_description": "light"},
        {"list": [RECORD, {**RECORD, "dt": 20}], "city": {"name": "Lima", "coord": {"lat": -12, "lon": -77.5}}},
        {"list": []},
        '{"dt": 1, "temp"',
    )
    assert [(r.id, r.dt, r.temp, r.weather_main, r.city_name, r.lat) for r in rows.orderBy("id", "dt").collect()] == [
        (0, 1, 3.0, "Rain", "Patagonia", -41.81),
        (1, 10, 1.5, "Rain", "Lima", -12.0),
        (1, 20, 1.5, "Rain", "Lima", -12.0),
    ]
    assert [(r.id, r.reason) for r in dead.orderBy("id").collect()] == [(2, "empty"), (3, "broken")]
    assert dead.filter("id = 3").first().raw == '{"dt": 1, "temp"'


def test_other_forms_and_wrong_types(flat):
    rows, dead = flat(
        [RECORD, {"dt": 30, "humidity": "5", "rain": {"1h": 0.25}}],
        {"dt": "cold", "main": {"temp": "x"}, "temp": 4.5},
        {"name": "Quito", "coord": {"lat": 0.5}, "dt": 5, "dt_txt": "2024-01-01 00:00:00"},
        {"something": 1}, "5", '"text"', None, "", [], "null", {"list": [1, {"dt": 7}]},
    )
    got = {(r.id, r.dt): r for r in rows.collect()}
    assert set(got) == {(0, 10), (0, 30), (1, None), (2, 5), (10, 7)}
    assert (got[0, 30].humidity, got[0, 30].rain_1h, got[0, 10].wind_speed) == (5, 0.25, 2.0)
    assert (got[1, None].temp, got[1, None].dt_iso) == (4.5, None)
    assert (got[2, 5].city_name, got[2, 5].lat, got[2, 5].lon, got[2, 5].dt_iso) == ("Quito", 0.5, -68.91, "2024-01-01 00:00:00")
    reasons = {}
    for r in dead.collect():
        reasons.setdefault(r.id, []).append(r.reason)
    assert reasons == {
        3: ["unknown"], 4: ["unknown"], 5: ["unknown"], 6: ["broken"], 7: ["broken"], 8: ["empty"], 9: ["unknown"],
        10: ["unknown"],
    }


def test_documents_are_parsed_once(flat):
    rows, _ = flat(RECORD)
    assert logical_plan_of(rows).count("parseJson(") == 1


def test_flat_names_and_the_city_in_the_declared_schema(spark):
    docs = [{"dt": 1, "weather_main": "Rain"}, {"list": [RECORD], "city": {"name": "Lima", "coord": {"lat": -12.0}}}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")
    rows = weather.flatten_weather_json(df).orderBy("dt").collect()
    assert [(r.weather_main, r.city_name, r.lat) for r in rows] == [("Rain", "Patagonia", -41.81), ("Rain", "Lima", -12.0)]
