"""Round trips through the file sinks and sources."""

import pytest
from pyspark.errors import AnalysisException

from moodline.schemas import MESSAGE
from moodline.session import new_shared_path, shared_dir
from moodline.sources import files

TEXTS = ["plain", "two\nlines", 'a "quoted", text', "comma, here", "emoji 😊 é", "back\\slash", "trailing\r", "  spaces "]
SCHEMA = "client string, seq bigint, text string, compound_score double"


@pytest.fixture
def results(spark):
    return spark.createDataFrame([("c", i, t, 0.5) for i, t in enumerate(TEXTS)], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_json_keeps_everything(spark, tmp_path, results):
    extra = results.union(spark.createDataFrame([("c", 90, "", None), ("c", 91, None, 0.0)], SCHEMA))
    files.write_results_json(extra, str(tmp_path / "out"))
    assert rows(spark.read.schema(SCHEMA).json(str(tmp_path / "out"))) == rows(extra)


def test_csv_keeps_texts(spark, tmp_path, results):
    path = str(tmp_path / "out")
    files.write_results_csv(results, path)
    assert rows(files.read_results_csv(spark, path, SCHEMA)) == rows(results)


def test_messages_round_trip_and_missing_folder(spark, tmp_path):
    one = spark.createDataFrame(
        [("1", "text\nmore", "2025-06-05T06:47:02+00:00", "a", "en", (1, 2, 3, 4, 5, 6), [("{name=x}", "y\nz")])], MESSAGE
    )
    files.write_messages(one, str(tmp_path / "m"))
    assert rows(files.read_messages(spark, str(tmp_path / "m"))) == rows(one)
    with pytest.raises(AnalysisException):
        files.read_messages(spark, str(tmp_path / "nowhere"))


def test_missing_columns_are_null(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":"1"}\n')
    row = files.read_messages(spark, str(tmp_path)).first()
    assert (row.id, row.text, row.public_metrics) == ("1", None, None)


def test_lines_end_at_newline_only(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b'{"text":"a"}\r\n{"text":"b\\r"}\n')
    got = sorted(r.value for r in files.read_packets(spark, str(tmp_path)).collect())
    assert got == ['{"text":"a"}\r', '{"text":"b\\r"}']


def test_full_batches_sink_leaves_the_short_batch_out(spark, tmp_path):
    many = spark.createDataFrame([("c", i, "t", 0.0) for i in range(25)], SCHEMA)
    files.write_full_batches(many, str(tmp_path / "b"))
    got = spark.read.json(str(tmp_path / "b"))
    assert {r.batch_id: r["count"] for r in got.groupBy("batch_id").count().collect()} == {1: 10, 2: 10}


class Session:
    """Just what the choice of the shared folder looks at."""

    def __init__(self, configured=None, used=None, master="spark://host"):
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkContext = self
        self.master, self.used = master, used

    def getCheckpointDir(self):
        return self.used


def test_shared_folder_follows_the_session():
    assert shared_dir(Session(configured="s3a://bucket/cp", used="/other")) == "s3a://bucket/cp"
    assert shared_dir(Session(used="hdfs:///cp")) == "hdfs:///cp"
    assert new_shared_path(Session(used="hdfs:///cp"), "x").startswith("hdfs:///cp/x-")
    with pytest.raises(ValueError):
        shared_dir(Session())
