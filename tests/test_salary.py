import random

import pytest
from pyspark.sql import functions as F

from marketlake.plans import salary
from marketlake.plans.salary import errors, importance, shift, train_salary


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for k in range(600):
        area = rng.choice(["msk", "spb", "omsk", None])
        years = rng.choice([None, *range(10)])
        noise = rng.choice(["a", "b"])
        pay = {"msk": 300, "spb": 200, "omsk": 100, None: 50}[area] + 20 * (years or 0) + rng.random()
        out.append((k, area, noise, years, None if k % 13 == 0 else pay))
    return spark.createDataFrame(out, "id long, area string, noise string, years int, pay double")


@pytest.fixture(scope="module")
def model(rows):
    return train_salary(rows.filter("id < 450"), "pay", ["area", "noise"], ["years"], rounds=5, depth=3)


def test_model_beats_the_mean_also_on_unknown_values(spark, rows, model):
    test = rows.filter("id >= 450 and pay is not null")
    mean = rows.filter("id < 450").agg(F.avg("pay")).scalar()
    found = errors(model.predict(model.encoded(test)), "pay", mean).first()
    assert found.row_cnt == test.count() and found.model_mse < 0.2 * found.mean_mse
    odd = spark.createDataFrame([(1, "nowhere", None, None, None)], rows.schema)
    assert model.predict(model.encoded(odd)).first().predicted is not None


def test_importance_equals_a_plain_loop(rows, model, monkeypatch):
    test = rows.filter("id >= 450")
    kept = {}
    plain = salary.dense_numbers

    def numbers(held):
        kept["numbers"] = plain(held)
        return kept["numbers"]

    monkeypatch.setattr(salary, "dense_numbers", numbers)
    found = {(r.field, r.repeat): (r.mse, r.added_mse) for r in importance(model, test, "id", "pay").collect()}
    place = {r.group: r.number for r in kept["numbers"].collect()}
    data = [r.asDict() for r in model.encoded(test.filter("pay is not null")).collect()]
    total = len(data)
    assert sorted(place.values()) == list(range(total))
    at = {place[r["id"]]: r for r in data}
    spark = rows.sparkSession

    def mse(changed):
        frame = spark.createDataFrame([(r["pay"], *[float(r[c]) for c in model.fields]) for r in changed],
                                      "pay double, " + ", ".join(f"{c} double" for c in model.fields))
        return model.predict(frame).agg(F.avg((F.col("pay") - F.col("predicted")) ** 2)).first()[0]

    base = mse(data)
    assert set(found) == {(c, r) for c in model.fields for r in range(2)}
    for (field, repeat), (got, added) in found.items():
        step = shift(total, model.fields.index(field), repeat)
        want = mse([{**r, field: at[(place[r["id"]] + step) % total][field]} for r in data])
        assert got == pytest.approx(want) and added == pytest.approx(want - base)
    assert found["area", 0][1] > 100 * abs(found["noise", 0][1])


def test_importance_of_no_rows(rows, model):
    assert importance(model, rows.filter("id < 0"), "id", "pay").count() == 0
