"""Files with line breaks in cells: split reads equal a read file by file."""

from __future__ import annotations

import random

import pytest

from reviewmill.sources import multiline
from reviewmill.sources.files import read_raw_csv


def cell(rng):
    kind = rng.random()
    if kind < 0.5:
        return rng.choice(["a", "12", "", "NA", " b ", "é"])
    body = "".join(rng.choice(["x", ",", '""', "\n", "line\n\n", "⭐"]) for _ in range(rng.randrange(0, 12)))
    return f'"{body}"'


def write(path, rng, n, header="id,one,two", end="\n"):
    rows = [f"r{i},{cell(rng)},{cell(rng)}" + ("\n" if rng.random() < 0.05 else "") for i in range(n)]
    path.write_text(header + end + end.join(rows) + rng.choice(["", end]), encoding="utf-8", newline="")


def rows_of(df):
    return [(r["path"].rsplit("/", 1)[1], r["id"], r["one"], r["two"]) for r in df.orderBy("path", "pos").collect()]


@pytest.mark.parametrize(("split", "n"), [(90, 25), (700, 120), (1 << 27, 300)])
def test_same_rows_in_the_same_order(spark, tmp_path, split, n):
    rng = random.Random(split)
    for k in range(2):
        write(tmp_path / f"f{k}.csv", rng, n)
    (tmp_path / "long.csv").write_text('id,one,two\nr0,a,"' + "many\nlines\n" * 40 + '"\nr1,b,c\nr2,"x\ny","z"\n')
    (tmp_path / "head.csv").write_text("id,one,two\n")
    files = sorted(str(p) for p in tmp_path.iterdir())
    whole = rows_of(read_raw_csv(spark, files))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = rows_of(read_raw_csv(spark, files, multi_line="splits"))
        tasks = spark.read.text(files).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == whole and (split > 700 or tasks > len(files))


@pytest.mark.parametrize("size", [1, 40, 10_000])
def test_chunks_of_any_size(spark, tmp_path, monkeypatch, size):
    """The two task functions in this process, under the given chunk size, over one split."""
    import pyarrow as pa

    monkeypatch.setattr(multiline, "CHUNK", size)
    rng = random.Random(size)
    write(tmp_path / "f.csv", rng, 120)
    lines = (tmp_path / "f.csv").read_bytes().removesuffix(b"\n").split(b"\n")
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * len(lines)), pa.array([0] * len(lines)), pa.array(lines, pa.binary())], ["path", "block", "line"])
    chunks = [c for part in multiline._packed(iter([batch.slice(0, 50), batch.slice(50)])) for c in part.to_pylist()]
    inside, rows, open_row = 0, [], None
    for c in chunks:
        part = pa.RecordBatch.from_pylist([{**c, "inside": inside}])
        for r in (r for cut in multiline._cut(iter([part])) for r in cut.to_pylist()):
            if r["part"] == multiline.WHOLE:
                rows.append((r["pos"], r["text"]))
            elif r["part"] == multiline.TAIL:
                open_row = (r["pos"], [r["text"]])
            else:
                open_row[1].append(r["text"])
                if r["part"] == multiline.HEAD:
                    rows.append((open_row[0], b"\n".join(open_row[1])))
        inside = (inside + c["odd"]) % 2
    whole = read_raw_csv(spark, str(tmp_path / "f.csv")).count()
    assert len(rows) == whole + 1 and rows == sorted(rows)
    assert b"".join(r.replace(b"\n", b"") for _, r in rows) == b"".join(lines)


def test_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,one\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text("one,id\n2,1\n")
    with pytest.raises(Exception, match="header differs"):
        multiline.read_csv_in_splits(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()


def test_windows_line_ends_and_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,one\r\n1,"x, y"\r\n2,\r\n', encoding="utf-8", newline="")
    rows = multiline.read_csv_in_splits(spark, [str(tmp_path / "a.csv")]).orderBy("pos").collect()
    assert [(r["id"], r["one"]) for r in rows] == [("1", "x, y"), ("2", None)]
