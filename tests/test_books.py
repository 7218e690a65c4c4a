"""Reading and writing one file per source."""

import os

from pyspark.sql import functions as F

from windrow.sources import books as B


def test_groups_by_size():
    assert B.grouped([("a", 3), ("b", 3), ("c", 9), ("d", 1), ("e", 5), ("f", 4)], 6) == [["a", "b"], ["c"], ["d", "e"], ["f"]]
    assert B.grouped([("a", 0), ("b", 0)], 6) == [["a", "b"]]
    assert B.grouped([], 6) == []


def test_one_bad_file_is_a_row(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    (folder / "12-good.txt").write_text("é" * 600)
    (folder / "deep" / "13.txt").write_bytes(b"caf\xe9 " * 200)
    (folder / "14.txt").write_bytes(b"")
    (folder / "15.txt").write_text("x" * 5000)
    (folder / "noid.txt").write_text("y" * 900)
    (folder / "16.md").write_text("z" * 900)
    files = B.read_files(spark, str(folder), glob="*.txt", filebytes=4000, splitbytes=2000).cache()
    assert {r["source_id"]: r["text"] for r in B.good(files).collect()} == {12: "é" * 600, 13: "café " * 200}
    errors = {(r["source_id"], r["error"]) for r in B.bad(files).collect()}
    assert errors == {(14, "no more than 500 characters"), (15, "larger than 4000 bytes"), (None, "no source id in the name")}
    assert files.rdd.getNumPartitions() > 1
    # A file that goes between listing and reading, and an address with nothing behind it.
    reader = B.BookReader({"path": str(folder)})
    lost = list(reader.read(B.Split([str(folder / "17.txt"), str(folder / "15.txt")])))
    assert [(r[0], r[3]) for r in lost] == [(17, "unreadable: FileNotFoundError"), (15, None)]
    os.symlink(folder / "gone", folder / "18.txt")
    assert B.bad(B.read_files(spark, str(folder / "18.txt"))).select("source_id", "error").collect() == [(18, "unreadable: FileNotFoundError")]
    one = B.read_files(spark, f"file:{folder}/12-good.txt")
    assert one.select("source_id", "error").collect() == [(12, None)]


def test_written_files_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a\r\nb\n"), (2, None), (3, "ü" * 9)], "source_id bigint, content string")
    for _ in range(2):  # a repeated write gives the same files
        B.write_files(rows, str(tmp_path / "out"))
    back = B.read_files(spark, str(tmp_path / "out"), min_chars=0)
    assert {r["source_id"]: r["text"] for r in back.collect()} == {1: "a\r\nb\n", 2: None, 3: "ü" * 9}
    assert B.bad(back).select("source_id").collect() == [(2,)]
    (tmp_path / "empty").mkdir()
    assert B.read_files(spark, str(tmp_path / "empty")).agg(F.count("*")).first()[0] == 0
