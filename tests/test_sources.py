"""CSV headers: read from the first chunk of a file, lines parsed once whatever the number of headers."""

import gzip
import io
import os

import pyarrow as pa
import pytest

from isobar.sources import tables


class Counted(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        part = super().read(n)
        self.taken += len(part)
        return part


@pytest.mark.parametrize("text, line", [
    (b"A,B\n1,2\n", "A,B"), (b"A,B\r\n1,2\r\n", "A,B"), (b"\xef\xbb\xbfA,B\n", "A,B"), (b"\n  \nA,B\n1\n", "A,B"),
    (b"A,B", "A,B"), (b"", None), (b"\n\n", None), ("Größe,Ä\n1\n".encode(), "Größe,Ä"), (b"A" * 100 + b",B\nx", "A" * 100 + ",B"),
])
@pytest.mark.parametrize("chunk", [1, 3, 1 << 16])
def test_first_line(text, line, chunk):
    assert tables.first_line(io.BytesIO(text), chunk) == line


def test_bytes_read_do_not_grow_with_the_file():
    for rows in (10, 1_000_000):
        stream = Counted(b"A,B\n" + b"1,2\n" * rows)
        assert tables.first_line(stream) == "A,B" and stream.taken <= tables.CHUNK


def jvm_bytes(spark):
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_headers_of_large_files_cost_one_chunk(spark, tmp_path):
    """Files of a gigabyte that are holes behind their first lines."""
    for k in range(4):
        with open(tmp_path / f"f{k}.csv", "wb") as f:
            f.write(b"STATION,TMP\n1,2\n" if k % 2 else b"TMP,STATION\n2,1\n")
            f.truncate(1 << 30)
    before = jvm_bytes(spark)
    got = {os.path.basename(r.path): r.header for r in tables.file_headers(spark, str(tmp_path)).collect()}
    assert got == {f"f{k}.csv": "STATION,TMP" if k % 2 else "TMP,STATION" for k in range(4)}
    assert jvm_bytes(spark) - before < 1 << 20


def test_odd_names_compressed_and_empty_files(spark, tmp_path):
    (tmp_path / "with blank [1]%20é.csv").write_bytes(b"STATION,DATE,TMP\n\n1,d,\"a,b\"\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    with gzip.open(tmp_path / "packed.csv.gz", "wb") as f:
        f.write(b"\xef\xbb\xbfTMP,STATION\n+0001,2\n+0002,3\n")
    got = tables.read_raw_csv(spark, str(tmp_path))
    assert got.columns == ["STATION", "DATE", "TMP"]
    assert sorted(map(tuple, got.collect())) == [("1", "d", "a,b"), ("2", None, "+0001"), ("3", None, "+0002")]


def test_lines_equal_sparks_own_reader(spark, tmp_path):
    """Quotes, escapes, short and long lines, blanks and NULLs, below three headers."""
    rows = ['1,"a,b",x', '2,"say ""hi""",y', '3,"back \\" slash",z', "4", "5,b", "6,b,c,d", "7,,", '8,"",q', " 9 , b ,c ", "STATION,DATE,TMP"]
    body = "\n".join(rows[:-1]) + "\n"
    (tmp_path / "one.csv").write_text("STATION,DATE,TMP\n" + body)
    (tmp_path / "two.csv").write_text("STATION,DATE,TMP\n" + body)
    (tmp_path / "three.csv").write_text("DATE,STATION,TMP\n" + body)
    (tmp_path / "four.csv").write_text("TMP,other\n" + body)
    got = {c: tables.read_raw_csv(spark, str(tmp_path / f"{c}.csv")) for c in ("one", "three", "four")}
    for name, df in got.items():
        own = spark.read.option("header", True).csv(str(tmp_path / f"{name}.csv")).select(*df.columns)
        assert sorted(map(str, df.collect())) == sorted(map(str, own.collect())), name
    whole = tables.read_raw_csv(spark, str(tmp_path))
    assert whole.count() == 4 * 9
    # A header glued into the middle is no row.
    (tmp_path / "five.csv").write_text("STATION,DATE,TMP\n1,2,3\nSTATION,DATE,TMP\n4,5,6\n")
    assert tables.read_raw_csv(spark, str(tmp_path / "five.csv")).count() == 2


def test_one_scan_of_the_text_and_no_shuffle(spark, tmp_path):
    for k, header in enumerate(("STATION,TMP", "STATION,TMP", "TMP,STATION", "STATION,DATE,TMP")):
        (tmp_path / f"f{k}.csv").write_text(header + "\n1,2,3\n")
    df = tables.read_raw_csv(spark, str(tmp_path)).select("TMP")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan text") == 1 and "SortMergeJoin" not in final


def test_unreadable_address_falls_back_to_the_text_reader(spark, tmp_path, monkeypatch):
    def failing(batches):
        for batch in batches:
            none, errors = pa.nulls(batch.num_rows, pa.string()), pa.array(["no such system"] * batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("path"), none, errors], ["path", "header", "error"])

    for k, header in enumerate(("STATION,TMP", "TMP,STATION")):
        (tmp_path / f"f{k}.csv").write_text("\n" + header + "\n" + "1,2\n" * 5)
    monkeypatch.setattr(tables, "read_headers", failing)
    got = {os.path.basename(r.path): r.header for r in tables.file_headers(spark, str(tmp_path)).collect()}
    assert got == {"f0.csv": "STATION,TMP", "f1.csv": "TMP,STATION"}


def test_a_column_named_twice_is_an_error(spark, tmp_path):
    (tmp_path / "f.csv").write_text("TMP,TMP\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        tables.read_raw_csv(spark, str(tmp_path))
