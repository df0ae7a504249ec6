import pytest

from conftest import column
from sparkrisk.plans.prepare import load_and_prepare, with_row_id
from sparkrisk.session import scratch_root
from sparkrisk.sources import files
from sparkrisk.streaming import clean_stream


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "raw.csv"
    lines = ["feature1,feature2,kredit,mixed_type_col"]
    lines += [f"{i},{'error' if i % 9 == 0 else i * 10},{'NA' if i % 20 == 0 else i % 3 % 2},\"a,{i}\"" for i in range(1, 101)]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_read_all_text(spark, csv, tmp_path):
    df = files.read_delimited(spark, csv)
    assert df.count() == 100 and {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert df.where("kredit IS NULL").count() == 5 and column(df, "mixed_type_col")[0] == "a,1"
    other = tmp_path / "semi.csv"
    other.write_text("a;b\n1;2\n")
    assert files.read_delimited(spark, str(other), ";").first().asDict() == {"a": "1", "b": "2"}
    with pytest.raises(FileNotFoundError):
        files.read_delimited(spark, str(tmp_path / "absent.csv"))


def test_written_text_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("x, \"y\"", "1"), (None, "2")], "a string, b string")
    files.write_delimited(df, str(tmp_path / "t"))
    assert sorted(files.read_delimited(spark, str(tmp_path / "t")).collect(), key=str) == sorted(df.collect(), key=str)


def test_prepare_job(spark, csv, tmp_path):
    out = str(tmp_path / "out")
    df = load_and_prepare(spark, csv, save_to=out)
    assert df.count() == 95 and df.where("split = 'test'").count() == 29
    assert "mixed_type_col" not in df.columns and df.select("row_id").distinct().count() == 95
    assert spark.read.parquet(out + "/clean").count() == 95
    assert spark.read.parquet(out + "/split").where("split = 'train'").count() == 66
    combined = load_and_prepare(spark, csv, combined=True)
    assert "split" not in combined.columns and combined.count() == 95
    with pytest.raises(RuntimeError):
        load_and_prepare(spark, str(tmp_path / "absent.csv"))


def test_row_numbers_stay_the_same(spark):
    df = with_row_id(spark.range(50).repartition(7))
    assert df.orderBy("id").collect() == df.orderBy("id").collect()
    assert df.select("row_id").distinct().count() == 50


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "a int, split string")
    files.write_split_table(df, str(tmp_path / "s"))
    assert (tmp_path / "s" / "split=test").is_dir()
    files.write_features(df, df, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f/test")).count() == 2
    files.write_table(df, str(tmp_path / "c"), fmt="csv")
    assert files.read_delimited(spark, str(tmp_path / "c")).count() == 2
    files.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_scratch_folder_follows_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_cleaning_a_stream(spark, csv, tmp_path):
    batch = files.read_delimited(spark, csv)
    folder = str(tmp_path / "in")
    batch.write.parquet(folder)
    rows = clean_stream(spark.readStream.schema(batch.schema).parquet(folder))
    query = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start(str(tmp_path / "o"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 95


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "breaks.csv").write_text('a,b\n1,"two\nlines"\n3,"x ""y"""\n')
    rows = files.read_delimited(spark, str(tmp_path / "breaks.csv"), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", "two\nlines"), ("3", 'x "y"')]
