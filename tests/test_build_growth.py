"""What the build rests on at size: the students' statistics made once, before the
unpivot, and cheap parsing of plain values."""

import random

from pyspark.sql import functions as F

from cohort_effects.functions import parse_date, trim_ws
from cohort_effects.operators import effects as fx
from cohort_effects.operators import enrich

SUBJECTS = {"m1": "x", "m2": "y", "m3": "x"}


def _bag(df, digits=9):
    return sorted(repr([round(v, digits) if isinstance(v, float) else v for v in r]) for r in df.collect())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_before_the_unpivot_are_those_after_it(spark):
    rng = random.Random(5)
    grade = lambda: rng.choice([None, None, 1.0, 2.5, 7.0])
    rows = [(rng.choice([None, "", "a", "b", "c", "d"]), rng.choice([None, 10, 20, 30, 40]), t, grade(), grade(), grade()) for t in range(90)]
    scores = spark.createDataFrame(rows, "student_id string, class_id long, term long, m1 double, m2 double, m3 double")
    bridge = spark.createDataFrame([(10, 1), (10, 2), (20, 2), (40, None)], "class_id long, school_id long")
    years = spark.createDataFrame([(10, 2000), (20, 2000), (30, 2001)], "class_id long, year long")
    plain = enrich.attach_context(scores, bridge, years, SUBJECTS)
    found = enrich.attach_context(scores, bridge, years, SUBJECTS, statistics=True)
    assert _bag(found.select(plain.columns)) == _bag(plain) and plain.count() > 100
    assert _bag(enrich.enrich_scores(found, None, None, SUBJECTS, attached=True)) == _bag(enrich.enrich_scores(plain, None, None, SUBJECTS, attached=True))
    for least in ((4, 2), (1, 1), (20, 2)):
        columns = [*plain.columns, "student_mean", "n_obs_student", "multi_school", "grade_dm"]
        want = fx.demean(plain, min_obs=least[0], min_groups=least[1], flag_target="school_id")
        assert _bag(fx.demean(found, min_obs=least[0], min_groups=least[1]).select(columns)) == _bag(want.select(columns))
    both = enrich.enrich_scores(found, None, None, SUBJECTS, attached=True).unionByName(
        fx.demean(found).select("student_id", "term", "subject", "class_id", "school_id", "year", "grade", "multi_school"))
    assert "Exchange" not in _plan(both) and "Join" not in _plan(both)  # read, not made again


def test_dates_and_text_as_before(spark):
    dates = ["2000-01-31", "2000-1-3", "2001-02-29", "1582-10-10", "0000-01-01", "0000-00-00", "9999-12-31", " 200-01-31", "2000-01-3 ", "2000-01-3T",
             "12000-1-12", "+200-01-31", "", None, "x", "2000-13-01", "٢٠٠٠-٠١-٠١", "2000-01-31 ", "2000-01-31\n", "\n2000-01-31", "2000-01-31\n\n"]
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    assert [r[0] for r in df.select(parse_date("d").cast("string")).collect()] == [r[0] for r in df.select(F.try_to_date("d", "yyyy-M-d").cast("string")).collect()]
    texts = ["a", " a", "a ", " a b　", "a\tb", "", " ", None, "é", "é ", "~!", "\x7fa", "a\x1f", " z", "z\x85"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = df.select(F.regexp_replace("t", r"(?U)^\s+|\s+$", "")).collect()
    assert [r[0] for r in df.select(trim_ws("t")).collect()] == [r[0] for r in want]
