import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obligato.operators.blocks import scan_blocks
from obligato.sources.ledger_files import scan_ledger
from obligato.sources.records import read_lines, split_records

SCHEMA = T.StructType().add("TAFS", "string").add("LINENO", "string").add("amount", "decimal(18,2)")


@pytest.fixture
def folder(tmp_path):
    files = {
        "good one.csv": b'\xef\xbb\xbfTAFS,LINENO,amount\r\n"a\nb ""c"", d",2490,1.50\r\n\r\nx,2500,\r\n',
        "order+more.csv": b'amount,"extra",LINENO,TAFS\n 7 ,e,1000,"t"\n8,e,1,\n9,"e\n\nf",2,u\n10,e,3,v\n11,e,4,w\n12,e,5,v\n13,e,6,v\n14,e,7,v\n15,e,8,v\n16,e,9,v\nNaN?,e,10,bad\n',
        "empty.csv": b"", "header.csv": b"TAFS,LINENO,amount\n", "blank.csv": b"\n\n",
        "columns.csv": b"TAFS,Line\na,1\n", "fields.csv": b"TAFS,LINENO,amount\na,1\nb,2,3,4\nc,1,2\n",
        "open.csv": b'TAFS,LINENO,amount\na,"1,2\n' + b"more\n" * 1500, "noise.csv": random.Random(1).randbytes(3000),
    }
    for name, data in files.items():
        (tmp_path / "sub").mkdir(exist_ok=True)
        (tmp_path / ("sub" if name < "f" else "") / name).write_bytes(data)
    (tmp_path / "notes.txt").write_text("TAFS,LINENO,amount\nnot,a,ledger\n")
    return str(tmp_path)


def test_files_rows_and_reasons(spark, folder):
    scan = scan_ledger(spark, folder, SCHEMA, suffix=".csv")
    files = {r.Source_File: (r.records, r.rows, r.rejected, r.reason) for r in scan.files.collect()}
    noise = files.pop("noise.csv")
    assert noise[1] == 0 and noise[3].startswith("missing columns: TAFS")
    assert files == {
        "good one.csv": (2, 2, 0, None), "order+more.csv": (11, 10, 1, None), "empty.csv": (0, 0, 0, "empty file"),
        "header.csv": (0, 0, 0, "no rows"), "blank.csv": (0, 0, 0, "missing columns: TAFS, LINENO, amount"),
        "columns.csv": (0, 0, 0, "missing columns: LINENO, amount"), "fields.csv": (3, 0, 2, "broken records: 2 of 3"),
        "open.csv": (1, 0, 1, "broken records: 1 of 1")}
    rows = {(r.Source_File, r.TAFS, r.LINENO, None if r.amount is None else float(r.amount)) for r in scan.rows.collect()}
    assert {r for r in rows if r[0] == "good one.csv"} == {("good one.csv", 'a\nb "c", d', "2490", 1.5), ("good one.csv", "x", "2500", None)}
    assert ("order+more.csv", None, "1", 8.0) in rows and ("order+more.csv", "t", "1000", 7.0) in rows and len(rows) == 12
    assert [tuple(r) for r in scan.rejected.collect()] == [("order+more.csv", 14, "value of amount", "NaN?,e,10,bad")]


def test_missing_optional_columns_are_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("TAFS,LINENO\na,1\n")
    scan = scan_ledger(spark, str(tmp_path), SCHEMA, required=["TAFS"])
    assert [tuple(r) for r in scan.rows.collect()] == [("a", "1", None, "a.csv")]


def plain_records(text):
    """[(line, record)] by a walk over the characters."""
    out, start, line, quoted, record = [], 1, 1, False, ""
    for ch in text + ("" if text.endswith("\n") else "\n"):
        if ch == "\n" and not quoted:
            if record.removesuffix("\r"):
                out.append((start, record.removesuffix("\r")))
            line, record = line + 1, ""
            start = line
            continue
        line, quoted = line + (ch == "\n"), quoted ^ (ch == '"')
        record += ch
    return [*out, (start, record)] if quoted else out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_records_across_splits(spark, tmp_path, seed):
    """Small splits cut the file inside quoted fields."""
    rng = random.Random(seed)
    text = "".join(rng.choice(["ab", ",", '"x\n\ny"', '"q""r"', "\n", "\r\n", '"' + "long\n" * 40 + '"', "z" * 30]) for _ in range(2000)) + "\n"
    (tmp_path / "a.csv").write_bytes(text.encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 10
        got = sorted((r.line, r.record) for r in split_records(lines).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = [(n, r.rstrip("\n") if n == max(plain_records(text))[0] else r) for n, r in plain_records(text)]
    assert got == expected


def test_scan_blocks_matches_a_plain_walk(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), i // 10, i, rng.choice([None, i]), rng.randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, block int, at int, v int, n int").repartition(5)
    got = {r.at: (r.total, r.last) for r in scan_blocks(df, ["k"], "block", "at", sums={"total": F.col("n")}, lasts={"last": F.col("v")}).collect()}
    total, last = {}, {}
    for k, _, at, v, n in rows:
        last[k] = v if v is not None else last.get(k)
        assert got[at] == (total.get(k, 0), last[k])
        total[k] = total.get(k, 0) + n
    assert len(got) == 200
