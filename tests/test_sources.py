import hashlib
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scopewise.sources import files, sinks, tables
from scopewise.spec import DEFAULT_SPEC, DataQualityError

HEADER = ",".join(DEFAULT_SPEC.required)
ROWS = "GUJARAT,024,ALPHA,0101,1,10,5,16\nGOA,030,BETA,0102,0,7,1,8\n"


def write(path: Path, data: str | bytes) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data.encode() if isinstance(data, str) else data)
    return str(path)


def test_strict_scan_keeps_text(spark, tmp_path):
    data = b"\xef\xbb\xbf" + f" {HEADER.replace(',', ' , ')} ,extra\n".encode()
    data += "GUJARAT,024,,0101,1,10,5,16,x\n".encode() + b'"A ""q"" B",1,"c,d",2,,3,4,7,\n'
    df = tables.read_strict_text(spark, write(tmp_path / "a.csv", data))
    assert df.columns == [*DEFAULT_SPEC.required, "extra"]
    first, second = sorted(df.collect(), key=lambda r: r["scope_name"], reverse=True)
    assert (first["scope_id"], first["entity_name"], first["entity_code"]) == ("024", "", "0101")
    assert (second["scope_name"], second["entity_name"], second["medium"]) == ('A "q" B', "c,d", "")


def test_strict_fact(spark, tmp_path):
    fact = tables.read_strict_fact(spark, write(tmp_path / "a.csv", HEADER + "\n" + ROWS))
    assert fact.schema == DEFAULT_SPEC.fact_schema()
    assert {r["entity_code"] for r in fact.collect()} == {"0101", "0102"}


@pytest.mark.parametrize(
    ("row", "message"),
    [
        ("GOA,030,B,2,0,7.5,1,8.5", "'micro' has a fraction in 1"),
        ("GOA,030,B,2,0,x,1,8", "'micro' is no number in 1"),
        ("GOA,030,B,2,0,,1,8", "'micro' is no number in 1"),
        ("GOA,030,,2,0,7,1,8", "'entity_name' is blank in 1"),
        ("GOA,030,B,2,0,7,1,9", "differs from"),
        ("GUJARAT,024,B,0101,0,7,1,8", "Duplicate rows"),
    ],
)
def test_strict_fact_rejects(spark, tmp_path, row, message):
    path = write(tmp_path / "a.csv", f"{HEADER}\n{ROWS}{row}\n")
    with pytest.raises(DataQualityError, match=message):
        tables.read_strict_fact(spark, path)


def test_line_breaks_inside_cells_are_read_right(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b,c\n1,"x\ny",3\n4,"say ""z""",6\n')
    assert tables.has_open_quotes(spark, path)
    expected = {("1", "x\ny", "3"), ("4", 'say "z"', "6")}
    assert {tuple(r) for r in tables.read_strict_text(spark, path).collect()} == expected
    assert {tuple(r) for r in tables.read_lenient_text(spark, path)[0].collect()} == expected
    assert not tables.has_open_quotes(spark, write(tmp_path / "b.csv", 'a\n"x"\n"y ""q"""\n'))


BREAKS = [
    (str(i), f"line {i}\nnext \"quoted\" {'long ' * (i % 17)}\r\n" if i % 3 else f"plain {i}", "" if i % 5 else 'a,"b"\n\n')
    for i in range(400)
]


def quoted(rows, header="id,text,rest"):
    cell = lambda v: '"' + v.replace('"', '""') + '"' if set(v) & set('",\n\r') else v
    return "".join(f"{line}\n" for line in [header, *(",".join(map(cell, row)) for row in rows)])


@pytest.fixture
def small_blocks(spark):
    """Files are read in blocks of 700 bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "700")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("max_broadcast", [50_000, 0])
def test_records_across_many_blocks(spark, tmp_path, small_blocks, max_broadcast):
    path = write(tmp_path / "a.csv", quoted(BREAKS))
    profile = tables.block_profile(spark, path)
    assert profile.count() > 10 and tables.inside_blocks(profile).count() > 2
    found = tables.read_records(spark, path, max_broadcast=max_broadcast)
    assert found.select("value").rdd.getNumPartitions() > 1
    lines = [bytes(r["value"]).decode() + "\n" for r in found.orderBy("block", "id").collect()]
    assert "".join(lines) == quoted(BREAKS)


def test_quoted_breaks_are_read_by_several_tasks(spark, tmp_path, small_blocks):
    path = write(tmp_path / "a.csv", quoted(BREAKS))
    rows = tables.read_strict_text(spark, path)
    assert sorted(map(tuple, rows.collect())) == sorted(BREAKS)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan
    numbered = tables.read_registry(spark, path).collect()
    assert [(r["row_no"], r["id"]) for r in sorted(numbered)] == sorted(
        ((i, row[0]) for i, row in enumerate(BREAKS, 2)), key=lambda pair: pair[1]
    )


def test_one_cell_over_many_blocks(spark, tmp_path, small_blocks):
    rows = [("1", "x\n" * 3000, "a"), ("2", "y", "b"), ("3", 'q"\n' * 800, "c")]
    path = write(tmp_path / "a.csv", quoted(rows))
    assert sorted(map(tuple, tables.read_strict_text(spark, path).collect())) == rows


def test_breaks_in_files_of_several_encodings(spark, tmp_path, small_blocks):
    parts = {"utf-8-sig": "€ Ω", "cp1252": "€ ’", "latin-1": "\x81 é"}
    expected = set()
    for encoding, mark in parts.items():
        rows = [(f"{encoding} {i}", f'{mark}\n"{i}"', mark) for i in range(60)]
        write(tmp_path / f"{encoding}.csv", quoted(rows).encode(encoding))
        expected |= {(*row, encoding) for row in rows}
    assert set(map(tuple, tables.read_lenient_rows(spark, str(tmp_path)).collect())) == expected


def test_odd_quoted_files(spark, tmp_path):
    breaks = write(tmp_path / "crlf.csv", 'a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n')
    assert sorted(map(tuple, tables.read_strict_text(spark, breaks).collect())) == [("1", "x\r\ny"), ("2", "z")]
    returns = write(tmp_path / "cr.csv", 'a,b\n1,"x\ry"\n2,z\n')
    assert sorted(r["a"] for r in tables.read_strict_text(spark, returns).collect()) == ["1", "2"]
    header = write(tmp_path / "header.csv", '"a\nb",c\n1,"2\n3"\n')
    assert [tuple(r) for r in tables.read_strict_text(spark, header).collect()] == [("1", "2\n3")]
    write(tmp_path / "two" / "x.csv", 'a,b\n1,"2\n3"\n')
    write(tmp_path / "two" / "y.csv", 'b,a\n1,"2\n3"\n')
    with pytest.raises(Exception, match="header"):
        tables.read_strict_text(spark, str(tmp_path / "two")).collect()


def test_files_must_share_a_header(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y\n1,2\n")
    write(tmp_path / "b.csv", "y,x\n1,2\n")
    with pytest.raises(Exception, match="header"):
        tables.read_strict_text(spark, str(tmp_path)).collect()


def test_missing_inputs(spark, tmp_path):
    missing = str(tmp_path / "none")
    for read in (
        tables.read_strict_text, tables.read_lenient_text, tables.read_registry,
        tables.read_qualifications, files.inventory,
    ):
        with pytest.raises(FileNotFoundError):
            read(spark, missing)
    with pytest.raises(DataQualityError, match="Missing required columns: total"):
        path = write(tmp_path / "a.csv", HEADER.removesuffix(",total") + "\n")
        tables.read_strict_fact(spark, path)


NAME = "Dāhod – Île “x”"


@pytest.mark.parametrize(
    ("encoding", "text", "found"),
    [
        ("utf-8", NAME, "utf-8-sig"),
        ("utf-8-sig", NAME, "utf-8-sig"),
        ("ascii", "plain", "utf-8-sig"),
        ("cp1252", "Île – “x” €", "cp1252"),
        ("latin-1", "Île \x81", "latin-1"),
    ],
)
def test_encoding_fallback(spark, tmp_path, encoding, text, found):
    path = write(tmp_path / "a.csv", f"name,n\n{text},1\n".encode(encoding))
    df, encodings = tables.read_lenient_text(spark, path)
    assert encodings == [found]
    assert [tuple(r) for r in df.collect()] == [(text, "1")]


def test_encodings_are_told_apart_per_file(spark, tmp_path):
    write(tmp_path / "a.csv", "name\nÎle – A\n".encode("cp1252"))
    write(tmp_path / "b.csv", "name\nÎle – B\n".encode())
    df, encodings = tables.read_lenient_text(spark, str(tmp_path))
    assert encodings == ["cp1252", "utf-8-sig"]
    assert {r["name"] for r in df.collect()} == {"Île – A", "Île – B"}


def test_missing_words_are_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\nNA,x\nnull,\nnone,N/A\n")
    df, _ = tables.read_lenient_text(spark, path)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [(None, "x"), (None, None), ("none", None)], key=str
    )


def test_registry_rows_are_numbered_like_the_file(spark, tmp_path):
    lines = [f"S{i},p{i},{'' if i % 3 else 'x'}" for i in range(4000)]
    path = write(tmp_path / "r.csv", "source_id,publisher,notes\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = tables.read_registry(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["source_id"]: r["row_no"] for r in rows} == {f"S{i}": i + 2 for i in range(4000)}
    assert {r["notes"] for r in rows} == {"", "x"}


def tree(root: Path) -> dict[str, bytes]:
    content = {
        "a.csv": b"1", "_b.csv": b"22", "sub/c.bin": bytes(3_000_000), "sub/deep/d.txt": b"",
        ".hidden": b"h", "sub/.cache/e": b"e", "a-b/f": b"f",
    }
    for name, data in content.items():
        write(root / name, data)
    return content


def test_inventory(spark, tmp_path):
    content = tree(tmp_path)
    visible = {n: d for n, d in content.items() if not any(p.startswith(".") for p in n.split("/"))}
    for hidden, expected in ((False, visible), (True, content)):
        rows = files.inventory(spark, str(tmp_path), hidden).orderBy(files.path_order()).collect()
        assert [r["relative_path"] for r in rows] == sorted(expected, key=lambda n: n.split("/"))
        for r in rows:
            data = expected[r["relative_path"]]
            assert r["size_bytes"] == len(data)
            assert r["sha256"] == hashlib.sha256(data).hexdigest()


def test_inventory_of_one_file_and_of_nothing(spark, tmp_path):
    path = write(tmp_path / "one.csv", "x")
    rows = files.inventory(spark, path).collect()
    assert [(r["relative_path"], r["sha256"]) for r in rows] == [("one.csv", hashlib.sha256(b"x").hexdigest())]
    (tmp_path / "empty").mkdir()
    assert files.inventory(spark, str(tmp_path / "empty")).count() == 0


def test_folders_of_a_level_are_listed_by_many_tasks(spark, tmp_path):
    for i in range(40):
        write(tmp_path / f"data/part={i}/f.bin", bytes([i]))
    listed = files.list_files(spark, str(tmp_path))
    assert listed.count() == 40
    folders = spark.createDataFrame([(f"data/part={i}",) for i in range(40)], "relative_path string")
    root = str(tmp_path)
    dealt = folders.repartition(files._tasks(spark), "relative_path").mapInPandas(
        lambda batches: files.list_folders(batches, root), files.ENTRY_SCHEMA
    )
    assert dealt.select(F.spark_partition_id()).distinct().count() > 1


def test_inventory_csv(spark, tmp_path):
    tree(tmp_path / "t")
    out = str(tmp_path / "out")
    sinks.write_inventory(files.inventory(spark, str(tmp_path / "t")), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["relative_path", "size_bytes", "sha256"]
    assert back.count() == 5


def test_manifest_rows(spark, tmp_path):
    document = '{"files": {"k1": {"file_name": "a", "sha256": "s", "size_bytes": 3},' \
               ' "k2": {"relative_path": "d/b", "sha256": "t", "size_bytes": 4}}}'
    rows = files.read_manifest_rows(spark, write(tmp_path / "m.json", document)).collect()
    assert {tuple(r) for r in rows} == {("k1", "a", 3, "s"), ("k2", "d/b", 4, "t")}


def test_csv_keeps_edges_of_cells(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'q"x', "l,m"), ("", None, "é")], "x string, y string, z string")
    sinks.write_csv(df, str(tmp_path / "o"))
    back = tables.read_strict_text(spark, str(tmp_path / "o"))
    assert {tuple(r) for r in back.collect()} == {(" a ", 'q"x', "l,m"), ("", "", "é")}


def test_json_rows_are_deterministic(spark, tmp_path):
    df = spark.range(1).select(
        F.lit(2).alias("b"), F.lit(None).cast("string").alias("a"),
        F.struct(F.lit(1).alias("z"), F.lit(2).alias("y")).alias("s"),
    )
    sinks.write_json_rows(df, str(tmp_path / "j"))
    text = [p.read_text() for p in (tmp_path / "j").glob("*.json")]
    assert "".join(text) == '{"a":null,"b":2,"s":{"y":2,"z":1}}\n'


@pytest.mark.parametrize("entries", [1, 3, 200])
@pytest.mark.parametrize("include_hidden", [True, False])
def test_listing_does_not_depend_on_the_depth_of_a_task(tmp_path, monkeypatch, entries, include_hidden):
    monkeypatch.setattr(files, "ENTRIES_PER_FOLDER", entries)
    names = ["a.txt", "x/b.txt", "x/y/z/c.txt", "x/.h/d.txt", ".top/e.txt", "w/_f.txt", "w/.g"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    (tmp_path / "empty").mkdir()
    found, rounds = set(), 0
    folders = pd.DataFrame({"relative_path": [""]})
    while len(folders):
        level = pd.concat(files.list_folders(iter([folders]), str(tmp_path), include_hidden))
        found |= {(p, s) for p, f, s in level.itertuples(index=False) if not f}
        folders = level[level["is_folder"]][["relative_path"]]
        rounds += 1
    kept = [n for n in names if include_hidden or not any(p.startswith(".") for p in n.split("/"))]
    assert found == {(n, len(n)) for n in kept}
    assert (rounds == 1) == (entries == 200)
