"""Incremental conversion reads each file once."""

from cohortloom.streaming.convert import convert_new_files


def test_new_files_are_converted_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    args = (str(tmp_path / "in"), str(tmp_path / "out"), "id long, code long, v double", str(tmp_path / "state"), ["code"])
    (tmp_path / "in/a.csv").write_text("id,code,v\n1,7,2.5\n2,8,\n")
    assert convert_new_files(spark, *args) == 2
    (tmp_path / "in/b.csv").write_text("id,code,v\n3,9,1.0\n")
    assert convert_new_files(spark, *args) == 1
    assert convert_new_files(spark, *args) == 0
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 3 and dict(got.dtypes)["code"] == "string"
