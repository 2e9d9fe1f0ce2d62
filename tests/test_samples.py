"""Sample blocks: median imputation, literal rows, CSV round trip."""

from tripstar.operators.imputation import fill_with_median, sample_transform
from tripstar.operators.quality import Check, run_checks
from tripstar.sources.samples import literal_rows, literal_rows_filtered, read_passengers_csv, write_csv


def test_upper_median(spark):
    df = spark.createDataFrame([(1.0, 1, None), (2.0, 2, None), (3.0, 3, None), (4.0, None, None), (None, None, None)],
                               "a double, b int, c double")
    r = fill_with_median(df).collect()
    assert [x.a for x in r] == [1.0, 2.0, 3.0, 4.0, 3.0]  # {1,2,3,4} -> 3
    assert [x.b for x in r] == [1, 2, 3, 2, 2]  # {1,2,3} -> 2, stays int
    assert all(x.c is None for x in r)  # all null stays null


def test_literal_rows_and_their_tests(spark):
    rows = literal_rows(spark)
    assert sorted((r.id is None, r.id) for r in rows.collect()) == [(False, 1), (True, None)]
    assert [r.id for r in literal_rows_filtered(rows).collect()] == [1]
    rep = {r.test: r.failing_rows for r in run_checks(rows, [Check("m", "id", "not_null"),
                                                            Check("m", "id", "unique")]).collect()}
    assert rep == {"not_null": 1, "unique": 0}


def test_passenger_csv_transform_and_export(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n"
                    "1,0,3,A,male,22,1,0,T,7.25,,S\n2,1,1,B,female,,1,0,T,71.28,C85,C\n"
                    "3,1,3,C,female,26,0,0,T,7.92,,S\n4,1,1,D,female,35,1,0,T,53.1,C123,S\n")
    out = sample_transform(read_passengers_csv(spark, str(path)))
    assert out.columns == ["Age", "Fare", "Parch", "Pclass", "SibSp", "Survived"]
    assert sorted(r.Age for r in out.collect()) == [22.0, 26.0, 26.0, 35.0]
    write_csv(out, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 4
