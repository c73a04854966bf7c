import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scopewise.operators import digest
from scopewise.operators.metrics import entity_metrics
from scopewise.operators.provenance import Source, release_totals
from scopewise.plans import bundle, publish, release
from scopewise.plans.registry import check_registry
from scopewise.session import scratch_path
from scopewise.sources.files import inventory
from scopewise.sources.sinks import write_json_document
from scopewise.sources.tables import REGISTRY_COLUMNS, read_metrics, read_qualifications, read_strict_text, written_positions
from scopewise.spec import DEFAULT_SPEC, DataQualityError, FactSpec

HEADER = ",".join(DEFAULT_SPEC.required)
NATIONAL = (
    f"{HEADER}\nGujarat,24,ALPHA,101,20,200,30,250\nGUJARAT,24,BETA,102,20,100,10,130\n"
    "RAJASTHAN,8,JAIPUR,102,1,50,5,56\nRAJASTHAN,8,DUDU,102,0,5,1,6\n"
)
CLEAN = "\n".join(NATIONAL.split("\n")[:4]) + "\n"


def write(path: Path, text: str) -> str:
    path.write_text(text, encoding="utf-8")
    return str(path)


def qualification(path: Path, source: str, **changes) -> str:
    record = {
        "source_id": "SOURCE",
        "source_url": "https://example.org",
        "licence": "open",
        "retrieval_date": "2026-07-30",
        "source_as_of_date": None,
        "source_sha256": hashlib.sha256(Path(source).read_bytes()).hexdigest(),
        "qualification_status": "qualified_for_gujarat_scope_only",
        "privacy_classification": "public_aggregate_district_data",
    }
    record = {k: v for k, v in (record | changes).items() if v != "drop"}
    return write(path, json.dumps(record, indent=2))


@pytest.fixture
def released(spark, tmp_path):
    source = write(tmp_path / "n.csv", NATIONAL)
    record = qualification(tmp_path / "q.json", source)
    out = str(tmp_path / "out")
    header = release.write_release(spark, source, record, out, "Gujarat").first()
    return out, header


def test_release(spark, released):
    out, header = released
    assert [header[f"{c}_total"] for c in ("micro", "small", "medium", "total")] == [300, 40, 40, 380]
    assert header["national_row_count"] == 4
    assert (header["national_conflicting_groups"], header["national_conflicting_rows"]) == (1, 2)
    assert header["publication_allowed"] is False and header["qualified"] is True
    assert header["encodings"] == ["utf-8-sig"]
    assert (header["ranking_row_count"], header["dictionary_row_count"]) == (4, 18)
    assert release.verify_release(spark, out)["row_count"] == 2
    fact = read_metrics(spark, f"{out}/data/fact", DEFAULT_SPEC.keyed())
    assert fact.columns == [*DEFAULT_SPEC.required, *DEFAULT_SPEC.derived, "scope_key"]
    # Two spellings of one scope are ranked together and kept as they were.
    assert {(r["scope_name"], r["rank_total"]) for r in fact.collect()} == {("Gujarat", 1), ("GUJARAT", 2)}
    validation = spark.read.json(f"{out}/validation").first()
    assert validation["mean_share_sum"] == 100.0 and validation["highest_entity_name"] == "ALPHA"
    metadata = spark.read.json(f"{out}/data/metadata").first()
    assert metadata["retrieval_date"] == "2026-07-30" and metadata["generated_at_utc"].endswith("+00:00")
    raw_metadata = next(Path(f"{out}/data/metadata").glob("*.json")).read_text()
    assert '"source_as_of_date":null' in raw_metadata


@pytest.mark.parametrize("folder", ["data/rankings", "data/fact/scope_key=gujarat", "validation"])
def test_any_changed_file_is_found(spark, released, folder):
    out, _ = released
    victim = next(p for p in sorted(Path(out, folder).iterdir()) if p.name.startswith("part-"))
    data = bytearray(victim.read_bytes())
    data[len(data) // 2] ^= 1
    victim.write_bytes(data)
    with pytest.raises(ValueError, match="Checksum mismatch"):
        release.verify_release(spark, out)
    victim.write_bytes(data + b"x")
    with pytest.raises(ValueError, match="size mismatch"):
        release.verify_release(spark, out)


def test_lost_file_and_lost_manifest(spark, released, tmp_path):
    out, _ = released
    with pytest.raises(FileNotFoundError, match="no manifest"):
        release.verify_release(spark, str(tmp_path / "nothing"))
    next(Path(out, "data/summary").glob("*.json")).rename(tmp_path / "elsewhere")
    with pytest.raises(FileNotFoundError, match="data/summary"):
        release.verify_release(spark, out)


def test_changed_figures_and_flag(spark, released):
    out, _ = released
    header = next(Path(out, "manifest/header").glob("*.json"))
    good = header.read_text()
    crc = header.with_name(f".{header.name}.crc")
    crc.rename(crc.with_suffix(".old"))
    header.write_text(good.replace('"total_total":380', '"total_total":381'))
    with pytest.raises(ValueError, match="total_total"):
        release.verify_release(spark, out)
    header.write_text(good.replace('"publication_allowed":false', '"publication_allowed":true'))
    with pytest.raises(ValueError, match="must not allow publication"):
        release.verify_release(spark, out)


@pytest.mark.parametrize(
    ("changes", "message"),
    [
        ({"licence": "drop", "source_url": "drop"}, "lacks: licence, source_url"),
        ({"qualification_status": "pending"}, "not qualified"),
        ({"privacy_classification": "private"}, "privacy"),
        ({"source_sha256": "0" * 64}, "checksum"),
    ],
)
def test_gates(spark, tmp_path, changes, message):
    source = write(tmp_path / "n.csv", NATIONAL)
    record = qualification(tmp_path / "q.json", source, **changes)
    with pytest.raises(ValueError, match=message):
        release.write_release(spark, source, record, str(tmp_path / "out"), "Gujarat")
    assert not (tmp_path / "out").exists()


def test_a_null_field_is_not_missing(spark, tmp_path):
    source = write(tmp_path / "n.csv", NATIONAL)
    record = qualification(tmp_path / "q.json", source, licence=None)
    found = release.check_sources(inventory(spark, source), read_qualifications(spark, record), "Gujarat").first()
    assert found["licence"] is None


def test_every_file_needs_its_own_approved_record(spark, tmp_path):
    """An approved record of another file, even in the same folder, opens no gate."""
    (tmp_path / "src").mkdir()
    (tmp_path / "q").mkdir()
    one = write(tmp_path / "src/one.csv", NATIONAL)
    two = write(tmp_path / "src/two.csv", CLEAN)
    qualification(tmp_path / "q/one.json", one)
    qualification(tmp_path / "q/two.json", two, qualification_status="pending")
    records = read_qualifications(spark, str(tmp_path / "q"))
    assert release.check_sources(inventory(spark, one), records, "Gujarat").count() == 1
    for path in (two, str(tmp_path / "src")):
        with pytest.raises(ValueError, match="two.csv is not qualified"):
            release.check_sources(inventory(spark, path), records, "Gujarat")
    third = write(tmp_path / "src/three.csv", HEADER)
    with pytest.raises(ValueError, match="checksum of three.csv"):
        release.check_sources(inventory(spark, str(tmp_path / "src")), records, "Gujarat")
    qualification(tmp_path / "q/two.json", two)
    qualification(tmp_path / "q/three.json", third, source_id="ANOTHER")
    found = release.check_sources(
        inventory(spark, str(tmp_path / "src")), read_qualifications(spark, str(tmp_path / "q")), "Gujarat"
    )
    with pytest.raises(ValueError, match="different sources"):
        release.release_source(found, str(tmp_path / "src"))
    with pytest.raises(ValueError, match="pending|qualified"):
        qualification(tmp_path / "q/again.json", two, qualification_status="pending")
        release.check_sources(inventory(spark, two), read_qualifications(spark, str(tmp_path / "q")), "Gujarat")


def test_unlisted_file_is_found(spark, released):
    out, _ = released
    Path(out, "data/rankings/added.csv").write_text("x")
    with pytest.raises(ValueError, match="Not listed in the manifest: data/rankings/added.csv"):
        release.verify_release(spark, out)


def test_broken_metrics_leave_no_output(spark, tmp_path, monkeypatch):
    def broken(fact, spec):
        return entity_metrics(fact, spec).withColumn("top_10_flag", F.lit(False))

    monkeypatch.setattr(bundle, "entity_metrics", broken)
    raw = read_strict_text(spark, write(tmp_path / "c.csv", CLEAN))
    with pytest.raises(DataQualityError, match="Top-10 flags"):
        bundle.write_bundle(raw, str(tmp_path / "b"), Source("S", "c.csv"))
    assert not (tmp_path / "b").exists()


def test_snapshots_are_totalled_and_reconciled_one_by_one(fact):
    spec = FactSpec(snapshot_cols=("as_of",))
    rows = [("A", "1", "X", "1", 5, 0, 0), ("A", "1", "Y", "2", 15, 0, 0)]
    both = fact(rows).withColumn("as_of", F.lit("2025")).unionByName(fact(rows[:1]).withColumn("as_of", F.lit("2026")))
    metrics = entity_metrics(both, spec)
    totals = {r["as_of"]: (r["row_count"], r["total_total"]) for r in release_totals(metrics, spec).collect()}
    assert totals == {"2025": (2, 20), "2026": (1, 5)}
    header = release_totals(metrics, spec)
    assert release.reconcile_release(metrics, header, spec).where("not matches").isEmpty()
    one = release.reconcile_release(metrics, header.where("as_of = '2025'"), spec)
    assert {r["as_of"] for r in one.where("not matches").collect()} == {"2026"}


def test_provenance_names_the_steps_that_ran(spark, tmp_path):
    raw = read_strict_text(spark, write(tmp_path / "c.csv", CLEAN))
    steps = {}
    for target in (None, "gujarat"):
        out = str(tmp_path / f"b-{target}")
        bundle.write_bundle(raw, out, Source("S", "c.csv"), target=target, limitations=["handle with care"])
        record = spark.read.json(f"{out}/data/metadata").first()
        steps[target] = record["transformations"]
        assert record["limitations"] == ["handle with care"]
    assert "kept the rows of gujarat" in steps["gujarat"]
    assert not any("kept the rows" in step for step in steps[None])


def test_one_json_document(spark, tmp_path):
    df = spark.createDataFrame([(2, None, (1, "x"))], "b int, a string, c struct<z:int,y:string>")
    write_json_document(df, str(tmp_path / "doc"))
    (file,) = (tmp_path / "doc").glob("part-*")
    text = file.read_text()
    assert text.endswith("}\n") and "\n  " in text
    assert list(json.loads(text)) == ["a", "b", "c"] and list(json.loads(text)["c"]) == ["y", "z"]
    assert json.loads(text) == {"a": None, "b": 2, "c": {"y": "x", "z": 1}}


def test_scope_gate(spark, tmp_path):
    source = write(tmp_path / "n.csv", NATIONAL)
    record = qualification(
        tmp_path / "q.json", source, qualification_status="qualified_for_rajasthan_scope_only"
    )
    with pytest.raises(DataQualityError, match="Rajasthan has conflicting"):
        release.write_release(spark, source, record, str(tmp_path / "out"), "Rajasthan")


@pytest.mark.parametrize("fact_format", ["parquet", "csv"])
def test_bundle(spark, tmp_path, fact_format):
    raw = read_strict_text(spark, write(tmp_path / "c.csv", CLEAN))
    out = str(tmp_path / "b")
    source = Source("SRC", "c.csv", sha256="abc")
    header = bundle.write_bundle(raw, out, source, limit=1, fact_format=fact_format).first()
    assert (header["row_count"], header["ranking_row_count"]) == (3, 4)
    assert header["source_sha256"] == "abc"
    assert release.verify_release(spark, out)["fact_format"] == fact_format
    scoped = bundle.write_bundle(raw, f"{out}2", source, target="gujarat", limit=3).first()
    assert (scoped["row_count"], scoped["total_total"], scoped["ranking_row_count"]) == (2, 380, 4)


def test_bundle_joins_spellings_under_one_label(spark, tmp_path):
    raw = read_strict_text(spark, write(tmp_path / "c.csv", CLEAN))
    out = str(tmp_path / "b")
    bundle.write_bundle(raw, out, Source("S", "c.csv"))
    rows = read_metrics(spark, f"{out}/data/fact").collect()
    assert {(r["scope_name"], r["entity_name"], r["rank_total"]) for r in rows} == {
        ("GUJARAT", "ALPHA", 1), ("GUJARAT", "BETA", 2), ("RAJASTHAN", "JAIPUR", 1),
    }


def test_numeric_scope_names_stay_text(fact):
    df = fact([("024", "024", "X", "001", 1, 0, 0)])
    scratch = scratch_path(df.sparkSession, "text")
    row = bundle.write_fact(df, scratch).first()
    assert (row["scope_name"], row["scope_id"], row["entity_code"]) == ("024", "024", "001")


@pytest.mark.parametrize("fact_format", ["parquet", "csv"])
def test_facts_are_written_whole(fact, fact_format):
    rows = [(f"S{i % 3}", str(i % 3), f"E{i % 11}", str(i), i % 7, 1, 0) for i in range(200)]
    df = fact(rows)
    stored = bundle.write_fact(df, scratch_path(df.sparkSession, "range"), fmt=fact_format)
    expected = entity_metrics(df, strategy="window")
    assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()


def test_bundle_rejects(spark, tmp_path):
    raw = read_strict_text(spark, write(tmp_path / "n.csv", NATIONAL))
    out = str(tmp_path / "b")
    with pytest.raises(ValueError, match="at least 1"):
        bundle.write_bundle(raw, out, Source("S", "n.csv"), limit=0)
    with pytest.raises(DataQualityError, match="Duplicate rows"):
        bundle.write_bundle(raw, out, Source("S", "n.csv"), target="Gujarat")
    assert not Path(out).exists()


def test_processed_pair(spark, tmp_path):
    raw = read_strict_text(spark, write(tmp_path / "c.csv", CLEAN))
    fact, metadata = str(tmp_path / "fact"), str(tmp_path / "meta")
    record = bundle.write_processed(raw, fact, metadata, Source("S", "c.csv"), "GUJARAT").first()
    assert (record["row_count"], record["entity_count"], record["total_total"]) == (2, 2, 380)
    assert record["derived_columns"] == list(DEFAULT_SPEC.derived)
    assert read_metrics(spark, fact, fmt="csv").count() == 2


def test_registry_file(spark, tmp_path):
    header = ",".join(REGISTRY_COLUMNS)
    good = ["S1", *["v"] * 12]
    good[4], good[11] = "primary", "pending_validation"
    path = write(tmp_path / "r.csv", f"{header}\n{','.join(good)}\n")
    assert check_registry(spark, path).isEmpty()
    (row,) = check_registry(spark, path, strict=True).collect()
    assert row["message"] == "S1 is primary but its status is pending_validation"
    assert check_registry(spark, write(tmp_path / "e.csv", header + "\n")).first()["rule"] == "empty"
    missing = check_registry(spark, write(tmp_path / "m.csv", "source_id,notes\nx,y\n")).first()["message"]
    assert missing.startswith("Missing required columns: publisher, dataset_name")
    lines = []
    for i in range(1500):
        row = [f"S{i}", *["v"] * 12]
        row[4], row[8], row[11] = "primary", "", "approved"
        lines.append(",".join(row))
    many = check_registry(spark, write(tmp_path / "b.csv", "\n".join([header, *lines, ""])))
    assert many.count() == many.where("rule = 'incomplete_approval'").count() == 1500


@pytest.mark.parametrize("step", ["write_data_package", "check_figures"])
def test_broken_release_publishes_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch, step):
    source = write(tmp_path / "n.csv", NATIONAL)
    record = qualification(tmp_path / "q.json", source)
    out = tmp_path / "out"
    whole = getattr(release, step)

    def breaks(*args, **kwargs):
        whole(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(release, step, breaks)
        with pytest.raises(RuntimeError, match="lost"):
            release.write_release(spark, source, record, str(out), "Gujarat")
    assert not out.exists() and not list(tmp_path.glob("out.staging*"))
    with pytest.raises(FileNotFoundError, match="no manifest"):
        release.verify_release(spark, str(out))
    release.write_release(spark, source, record, str(out), "Gujarat")
    assert release.verify_release(spark, str(out))["row_count"] == 2
    with pytest.raises(FileExistsError):
        release.write_release(spark, source, record, str(out), "Gujarat")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["n.csv", "out", "q.json"]


@pytest.mark.parametrize("moves", [2])
def test_run_that_dies_while_it_publishes(spark, tmp_path, monkeypatch, moves):
    source = write(tmp_path / "n.csv", NATIONAL)
    record = qualification(tmp_path / "q.json", source)
    out = str(tmp_path / "out")
    move, done = publish._move, []

    def dies(*args):
        if len(done) == moves:
            raise OSError("gone")
        done.append(move(*args))

    with monkeypatch.context() as patch:
        patch.setattr(publish, "_move", dies)
        with pytest.raises(OSError, match="gone"):
            release.write_release(spark, source, record, out, "Gujarat")
    assert Path(out, "data").exists() and not publish.is_committed(spark, out)
    with pytest.raises(FileNotFoundError, match="no manifest"):
        release.verify_release(spark, out)
    release.write_release(spark, source, record, out, "Gujarat")
    assert release.verify_release(spark, out)["row_count"] == 2


def test_digest_of_several_files(spark):
    def tree(rows, fan_out=4):
        return digest.tree(spark.createDataFrame(rows, "relative_path string, size_bytes long, sha256 string"), fan_out)

    rows = [(f"f/{i}.csv", i, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(90)]
    nodes = tree(rows)
    root = digest.root(nodes)
    assert digest.root(tree(list(reversed(rows)))) == root
    swapped = [(rows[0][0], *rows[1][1:]), (rows[1][0], *rows[0][1:]), *rows[2:]]
    renamed = [("f/x.csv", *rows[0][1:]), *rows[1:]]
    altered = [(*rows[0][:2], rows[5][2]), *rows[1:]]
    roots = {digest.root(tree(other)) for other in (swapped, renamed, altered, rows[1:], rows[:1])}
    assert len(roots | {root}) == 6
    for row in (rows[0], rows[37], rows[89]):
        proof = digest.prove(nodes, row[0], 4)
        assert len(proof) == 4 and max(len(hashes) for _, hashes in proof) <= 4
        assert digest.proves(proof, root, *row)
        assert not digest.proves(proof, root, row[0], row[1] + 1, row[2])
        assert not digest.proves(proof, root, "f/other.csv", *row[1:])
    with pytest.raises(KeyError):
        digest.prove(nodes, "f/none.csv", 4)
    assert digest.root(tree([])) != digest.root(tree(rows[:1]))


def test_release_of_several_files_names_their_tree(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = CLEAN.strip().split("\n")
    records = tmp_path / "records"
    records.mkdir()
    for i, line in enumerate(lines[1:]):
        source = write(folder / f"{i}.csv", f"{HEADER}\n{line}\n")
        qualification(records / f"{i}.json", source)
    header = release.write_release(spark, str(folder), str(records), str(tmp_path / "out"), "Gujarat").first()
    assert header["source_sha256"] == digest.root(digest.tree(inventory(spark, str(folder))))


def test_files_in_order_of_names_hold_the_ranks_in_order(spark, tmp_path):
    """A large scope takes several files, small ones one."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 30 == 0, "SMALL").otherwise("LARGE").alias("scope_name"),
        F.lit("1").alias("scope_id"),
        F.concat(F.lit("E"), "id").alias("entity_name"),
        F.col("id").cast("string").alias("entity_code"),
        (F.col("id") % 7).alias("medium"),
        F.xxhash64("id").bitwiseAND(1023).alias("micro"),
        F.lit(0).cast("bigint").alias("small"),
    )
    fact = rows.withColumn("total", F.col("medium") + F.col("micro")).select(*DEFAULT_SPEC.required)
    path = str(tmp_path / "fact")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bundle.write_fact(fact, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = written_positions(spark, path)
    assert found.where("written_position <> rank_total").isEmpty() and found.count() == 3000
    assert found.where("scope_name = 'LARGE'").agg(F.max("file_number")).first()[0] > 2


@pytest.mark.parametrize("fact_format", ["parquet", "csv"])
def test_header_figures_are_counted_while_writing(spark, small, tmp_path, monkeypatch, fact_format):
    """No job reads the fact or the rankings again for the header, and the figures are those of a read."""
    raw = small.select(*[F.col(c).cast("string").alias(c) for c in small.columns])
    out = str(tmp_path / "out")
    expected = release_totals(small).first().asDict()

    def refused(*_):
        raise AssertionError("The header read the fact again.")

    with monkeypatch.context() as patch:
        patch.setattr(bundle, "release_totals", refused)
        header = bundle.write_bundle(raw, out, Source("S", "s.csv"), fact_format=fact_format).first()
    assert {name: header[name] for name in expected} == expected
    rankings = spark.read.option("header", True).csv(f"{out}/data/rankings").count()
    assert header["ranking_row_count"] == rankings > 0
    assert release_totals(bundle.read_metrics(spark, f"{out}/data/fact", fmt=fact_format)).first().asDict() == expected
