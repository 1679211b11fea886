"""CSV scan with pandas-style missing tokens and a digit-first column name."""

import os


def test_csv_missing_tokens(spark, tmp_path):
    from plinth.sources.csv import scan_csv
    path = os.path.join(tmp_path, "in.csv")
    with open(path, "w") as fh:
        fh.write("Id,LotFrontage,Alley,1stFlrSF\n1,65,NA,856\n2,NA,Grvl,\n3,80,None,920\n")
    df = scan_csv(spark, path)
    types = dict(df.dtypes)
    assert types["LotFrontage"] == "bigint" and types["Alley"] == "string" and types["1stFlrSF"] == "bigint"
    rows = df.orderBy("Id").collect()
    assert [r["LotFrontage"] for r in rows] == [65, None, 80]
    assert [r["Alley"] for r in rows] == [None, "Grvl", None]
    assert [r["1stFlrSF"] for r in rows] == [856, None, 920]


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    from plinth.sources.csv import scan_csv, write_csv
    path = os.path.join(tmp_path, "q.csv")
    with open(path, "w") as fh:
        fh.write('id,note\n1,"a ""big"" one, yes"\n2,"two\nlines"\n')
    rows = [tuple(r) for r in scan_csv(spark, path, multiline=True).orderBy("id").collect()]
    assert rows == [(1, 'a "big" one, yes'), (2, "two\nlines")]
    out = write_csv(scan_csv(spark, path, multiline=True), os.path.join(tmp_path, "out"))
    assert [tuple(r) for r in scan_csv(spark, out, multiline=True).orderBy("id").collect()] == rows


def test_fixture_rows_and_planted_columns(spark):
    from pyspark.sql import functions as F
    from conftest import SF
    from plinth.sources.fixture import fixture, train_test
    fx = fixture(spark, SF)
    assert fx.count() == 1473
    train, test = train_test(spark, SF)
    assert train.count() == 1176 and "sale_price" not in test.columns
    assert fx.select(F.countDistinct("utilities")).first()[0] == 1
