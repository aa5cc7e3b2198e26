"""The upper end of a salary from the other fields of a vacancy, trained on a hash split."""

from pyspark.sql import functions as F

from marketlake.catalog.base import VAC, query, vacancies
from marketlake.plans.model import hash_split
from marketlake.plans.salary import errors, importance, train_salary

_TEXTS = ["name", "schedule_id", "employer_id", "area_id", "employment_form_id"]
_NUMBERS = ["salary_from", "internship", "roles"]
_TEST = "('0x' || substr(md5(event_id::varchar), 1, 7))::bigint % 100 < 20"


def _rows(spark, sf):
    vac = vacancies(spark, sf).select(
        "event_id", "name", F.col("schedule.id").alias("schedule_id"), F.col("employer.id").alias("employer_id"),
        F.col("area.id").alias("area_id"), F.col("employment_form.id").alias("employment_form_id"),
        F.col("salary.from").alias("salary_from"), "internship", F.size("professional_roles").alias("roles"),
        F.col("salary.to").alias("salary_to"))
    return hash_split(vac.filter("salary_to is not null"), F.col("event_id"))


def _model(rows):
    return train_salary(rows.filter(~F.col("is_test")), "salary_to", _TEXTS, _NUMBERS)


@query("g6_salary_error", f"""with {VAC} select count(*) as row_cnt, true as half_of_the_mean_error
from vac where salary_to is not null and {_TEST}""")
def g6_error(spark, sf):
    """Whether the squared error on held-out rows is at most half of what the training mean gives."""
    rows = _rows(spark, sf)
    model, test = _model(rows), rows.filter("is_test")
    mean = rows.filter(~F.col("is_test")).agg(F.avg("salary_to")).scalar()
    found = errors(model.predict(model.encoded(test)), "salary_to", mean)
    return found.select("row_cnt", (F.col("model_mse") <= 0.5 * F.col("mean_mse")).alias("half_of_the_mean_error"))


@query("g6_salary_importance")
def g6_importance(spark, sf):
    rows = _rows(spark, sf)
    return importance(_model(rows), rows.filter("is_test"), "event_id", "salary_to")
