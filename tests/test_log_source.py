"""Log files as a data source: which are opened, gaps between them, and streams that go on."""

import datetime

import pytest

from tidemark.schema import LOG
from tidemark.sources import logsource


def row(scn):
    return (scn, scn, datetime.datetime(2024, 1, 1, 0, 0, scn % 60, 123456), "INSERT", 1, 0, "S", "T", "APP", f"sql é {scn}", f"R{scn}", 0, "X", 0)


class Logs:
    """Files of ten SCNs each and their manifest."""

    def __init__(self, spark, at):
        self.spark, self.at, self.manifest = spark, at, str(at / "manifest")

    def add(self, *firsts, member="a", closed=True):
        for first in firsts:
            self.spark.createDataFrame([row(s) for s in range(first, first + 10)], LOG).coalesce(1).write.mode("overwrite").parquet(str(self.at / f"{member}{first}"))
        rows = [(first, first + 10 if closed else None, str(self.at / f"{member}{first}")) for first in firsts]
        self.spark.createDataFrame(rows, "first long, next long, name string").coalesce(1).write.mode("append").parquet(self.manifest)

    def spoil(self, *firsts, member="a"):
        """Files that can't be read any more: whoever opens one fails."""
        for first in firsts:
            for file in (self.at / f"{member}{first}").glob("part-*"):
                file.write_bytes(b"spoilt")

    def stream(self, name, **more):
        rows = logsource.log(self.spark, self.manifest, stream=True, **more)
        rows.writeStream.format("parquet").option("path", str(self.at / name)).option("checkpointLocation", str(self.at / f"{name}-c")).trigger(availableNow=True).start().awaitTermination()
        return scns(self.spark.read.schema(LOG).parquet(str(self.at / name)))


def scns(df):
    return sorted(r["scn"] for r in df.select("scn").collect())


@pytest.fixture
def logs(spark, tmp_path):
    return Logs(spark, tmp_path)


def test_only_files_that_hold_the_range_are_opened(spark, logs):
    logs.add(0, 10, 20, 30, 40)
    logs.add(20, member="b")  # another member of a range
    logs.add(50, closed=False)
    assert sorted(map(tuple, logsource.log(spark, logs.manifest).where("scn = 25").collect())) == sorted(map(tuple, spark.createDataFrame([row(25)], LOG).collect()))
    logs.spoil(0, 10, 40)
    logs.spoil(20, member="b")
    with pytest.raises(Exception, match="Parquet|magic"):
        logsource.log(spark, logs.manifest).collect()
    rows = logsource.log(spark, logs.manifest)
    assert scns(rows.where("scn >= 22 AND scn < 38")) == list(range(22, 38))
    assert scns(rows.where("scn > 29 AND scn <= 31")) == [30, 31] and scns(rows.where("scn = 33 AND xid = 'X'")) == [33] and scns(rows.where("scn >= 55")) == list(range(55, 60))
    logs.spoil(20, 30)
    assert scns(logsource.log(spark, logs.manifest, from_scn=50)) == list(range(50, 60))
    assert rows.where("scn < 0").count() == 0


def test_the_same_by_sparks_reader(spark, logs):
    logs.add(0, 10, 20)
    logs.add(20, member="b")
    logs.add(30, closed=False)
    logs.spoil(0)
    logs.spoil(20, member="b")
    files = spark.read.parquet(logs.manifest)
    assert scns(logsource.read_needed(spark, files, 15)) == list(range(15, 40))
    assert logsource.read_needed(spark, files.where("first > 90"), 5).isEmpty()


def test_a_stream_opens_new_files_only(logs):
    logs.add(0, 10, 20)
    logs.add(30, closed=False)
    logs.spoil(0)
    assert logs.stream("out", from_scn=15) == list(range(15, 30))
    logs.spoil(10, 20)
    assert logs.stream("out", from_scn=15) == list(range(15, 30))  # the open file is waited for
    logs.add(30, 40)
    assert logs.stream("out", from_scn=15) == list(range(15, 50))


def test_gaps(spark, logs):
    logs.add(0, 10, 30)
    for stream in (True, False):
        with pytest.raises(Exception, match="SCN 20 was expected, the next file begins at 30"):
            logs.stream("fails") if stream else logsource.log(spark, logs.manifest).collect()
    assert logs.stream("waits", gaps="wait") == list(range(20))
    assert logs.stream("skips", gaps="skip") == scns(logsource.log(spark, logs.manifest, gaps="skip")) == [*range(20), *range(30, 40)]
    logs.add(20)
    assert logs.stream("waits", gaps="wait") == list(range(40))
    assert logsource.check_gaps([(0, 10, "a"), (5, 20, "b"), (12, 15, "c"), (20, None, "d")], "fail", 3) and logsource.check_gaps([], "fail") == []
    late = [(50, 60, "a")]
    assert logsource.check_gaps(late, "wait", 40) == [] and logsource.check_gaps(late, "fail") == late
