"""Qualified releases: gates, package, validation record, manifest, verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from scopewise.functions.text import scope_key
from scopewise.operators import digest
from scopewise.operators.conflicts import scope_qualification
from scopewise.operators.provenance import Source, release_totals, release_validation
from scopewise.operators.quality import enforce, enforce_metrics, strict_checks
from scopewise.operators.ranking import require_limit
from scopewise.operators.reconcile import verify_manifest
from scopewise.operators.scoping import load_lenient_fact
from scopewise.plans.bundle import WrittenFigures, checked_metrics, read_header, write_data_package, write_manifest
from scopewise.plans.publish import require_committed, staged
from scopewise.session import materialize, scratch_tables
from scopewise.sources.files import inventory
from scopewise.sources.sinks import write_json_rows
from scopewise.sources.tables import read_lenient_text, read_metrics, read_qualifications
from scopewise.spec import DEFAULT_SPEC, DataQualityError, FactSpec

# Fixed values of a qualification record.
REQUIRED_FIELDS = (
    "source_id",
    "source_url",
    "licence",
    "retrieval_date",
    "source_sha256",
    "qualification_status",
    "privacy_classification",
)
# Fragments of messages that callers look for.
SIZE_MISMATCH_TEXT = "size mismatch"
CHECKSUM_MISMATCH_TEXT = "Checksum mismatch"
APPROVED_PRIVACY = "public_aggregate_district_data"
CANDIDATE = "candidate_for_internal_validation"


def approved_status(target: str) -> str:
    return f"qualified_for_{target.strip().lower().replace(' ', '_')}_scope_only"


def source_records(files: DataFrame, qualifications: DataFrame) -> DataFrame:
    """Every source file with the qualification records of its checksum; null without one."""
    records = qualifications.withColumn("_recorded", F.lit(True))
    same = files["sha256"] == records["source_sha256"]
    return files.select("relative_path", "size_bytes", "sha256").join(records, same, "left")


def check_sources(
    files: DataFrame, qualifications: DataFrame, target: str, privacy: str = APPROVED_PRIVACY
) -> DataFrame:
    """The records of all source files; raises for the first file that must not be released.

    Every file needs a record of its own checksum, and every record of that
    checksum must be complete and approved.
    """
    missing = F.array_except(F.array(*[F.lit(f) for f in REQUIRED_FIELDS]), F.coalesce("fields", F.array().cast("array<string>")))
    problem = (
        F.when(F.col("_recorded").isNull(), F.lit("checksum"))
        .when(F.size("_missing") > 0, F.lit("fields"))
        .when(~F.col("qualification_status").eqNullSafe(F.lit(approved_status(target))), F.lit("status"))
        .when(~F.col("privacy_classification").eqNullSafe(F.lit(privacy)), F.lit("privacy"))
    )
    records = source_records(files, qualifications).withColumn("_missing", F.array_sort(missing))
    judged = materialize(records.withColumn("_problem", problem), "source-records")
    order = F.array_position(F.array(*[F.lit(k) for k in ("checksum", "fields", "status", "privacy")]), F.col("_problem"))
    first = judged.where("_problem IS NOT NULL").orderBy(order, "relative_path").first()
    if first is not None:
        path = first["relative_path"]
        raise ValueError(
            {
                "checksum": f"No qualification record has the checksum of {path}.",
                "fields": f"The record of {path} lacks: " + ", ".join(first["_missing"]),
                "status": f"The record of {path} is not qualified for {target}.",
                "privacy": f"The privacy class of {path} is not approved.",
            }[first["_problem"]]
        )
    return judged.drop("_recorded", "_missing", "_problem")


def files_digest(files: DataFrame) -> str:
    """One hash for source files (relative_path, size_bytes, sha256): a file's own, or the root of their hash tree."""
    first = files.select("sha256").limit(2).collect()
    return first[0]["sha256"] if len(first) == 1 else digest.root(digest.tree(files))


def release_source(records: DataFrame, source_path: str) -> Source:
    """What all files of a release share; raises if they come from different sources."""
    names = ("source_id", "source_as_of_date", "retrieval_date", "qualification_status", "source_url", "licence")
    found = records.select(*names).distinct().limit(2).collect()
    if not found:
        raise FileNotFoundError(f"No source file below {source_path}.")
    if len(found) > 1:
        raise ValueError(f"The files below {source_path} belong to different sources.")
    # A file may have several records.
    files = records.select("relative_path", "size_bytes", "sha256").distinct()
    record = found[0]
    return Source(
        source_id=record["source_id"],
        file_name=source_path.rstrip("/").rsplit("/", 1)[-1],
        sha256=files_digest(files),
        as_of_date=record["source_as_of_date"],
        retrieval_date=record["retrieval_date"],
        qualification_status=record["qualification_status"],
        source_url=record["source_url"],
        licence=record["licence"],
    )


def qualification_of_scopes(fact: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Conflict verdict per scope of a typed fact."""
    return scope_qualification(
        fact, spec.key, spec.scope_col, spec.entity_code, spec.total, spec.snapshot_cols
    )


def check_scope(qualification: DataFrame, target: str, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """The verdicts on the target scope, one per snapshot, whatever its spelling."""
    verdicts = qualification.where(scope_key(F.col(spec.scope_col)) == scope_key(F.lit(target)))
    judged = verdicts.agg(
        F.count("*").alias("n"), F.bool_and(F.col("qualified") & F.col("unique_in_scope")).alias("passed")
    ).first()
    if not judged["n"]:
        raise DataQualityError(f"No rows belong to {target}.")
    if not judged["passed"]:
        raise DataQualityError(f"{target} has conflicting or repeated keys and cannot be released.")
    return verdicts


def write_release(
    spark: SparkSession,
    source_path: str,
    qualification_path: str,
    out: str,
    target: str,
    spec: FactSpec = DEFAULT_SPEC,
    limit: int = 10,
    fact_format: str = "parquet",
    limitations: Sequence[str] = (),
) -> DataFrame:
    """Filter-then-validate release of one scope; returns the manifest header.

    Names keep the spelling of the source, so scopes are told apart by key.
    The source is parsed once and hashed once; all later steps read the stored
    columns.  Everything is written aside, verified there and then moved to
    ``out``, the manifest last: a run that breaks publishes nothing and can be
    repeated.
    """
    require_limit(limit)
    with scratch_tables(), staged(spark, out, ("data", "qualification", "validation")) as stage:
        qualifications = read_qualifications(spark, qualification_path)
        records = check_sources(inventory(spark, source_path), qualifications, target)
        source = release_source(records, source_path)

        text, encodings = read_lenient_text(spark, source_path)
        spec = spec.keyed()
        national = load_lenient_fact(text, spec)

        qualification = materialize(qualification_of_scopes(national, spec), "scopes")
        verdicts = check_scope(qualification, target, spec)
        scoped = national.where(F.col(spec.scope_col) == scope_key(F.lit(target)))
        enforce(scoped, strict_checks(spec))

        steps = (
            "checked the qualification of every source file by checksum",
            "parsed text and counts",
            "checked the rows of all scopes",
            f"kept the rows of {target}",
            "checked that no key conflicts or repeats in the scope",
        )
        metrics = checked_metrics(scoped, spec)
        written = WrittenFigures(spec)
        stored = write_data_package(metrics, stage, source, spec, limit, fact_format, steps, limitations, written)
        write_json_rows(records.drop("fields"), f"{stage}/qualification")
        write_json_rows(release_validation(stored, qualification, spec), f"{stage}/validation")
        national_figures = verdicts.select(
            *spec.snapshot_cols,
            F.col("national_rows").alias("national_row_count"),
            "national_conflicting_groups",
            "national_conflicting_rows",
            "qualified",
        )
        write_manifest(
            stored,
            stage,
            "Release candidate",
            source,
            spec,
            fact_format,
            limitations,
            national_figures,
            written,
            release_status=F.lit(CANDIDATE),
            publication_allowed=F.lit(False),
            encodings=F.array(*[F.lit(e) for e in encodings]),
        )
        check_figures(stored, read_header(spark, stage), spec)
    return read_header(spark, out)


def manifest_status(spark: SparkSession, out: str) -> DataFrame:
    """Status of every file of a package, at any depth; the manifest itself is not listed."""
    try:
        listed = spark.read.schema(
            "relative_path string, size_bytes bigint, sha256 string"
        ).csv(f"{out}/manifest/files", header=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"There is no manifest below {out}.") from error
        raise
    found = inventory(spark, out).where(~F.col("relative_path").startswith("manifest/"))
    return verify_manifest(listed, found)


def reconcile_release(
    stored: DataFrame, header: DataFrame, spec: FactSpec = DEFAULT_SPEC
) -> DataFrame:
    """Recomputed figures beside the published ones; one row per snapshot and figure.

    A snapshot that only one side has does not match.
    """
    figures = ["row_count", *[f"{c}_total" for c in (*spec.categories, spec.total)]]
    keys = [*spec.snapshot_cols, "figure"]

    def long(df: DataFrame, value: str) -> DataFrame:
        narrow = df.select(*spec.snapshot_cols, *[F.col(f).cast("bigint").alias(f) for f in figures])
        return narrow.unpivot(list(spec.snapshot_cols), figures, "figure", value)

    return (
        long(header, "published")
        .join(long(release_totals(stored, spec), "actual"), keys, "full_outer")
        .withColumn("matches", F.coalesce(F.col("published") == F.col("actual"), F.lit(False)))
    )


def check_figures(stored: DataFrame, header: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> None:
    """Raise if published figures are not those of the stored metrics."""
    wrong = reconcile_release(stored, header, spec).where("not matches").select("figure").distinct()
    names = sorted(r["figure"] for r in wrong.collect())
    if names:
        raise ValueError("The published figures differ from the data: " + ", ".join(names))


def verify_release(spark: SparkSession, out: str, spec: FactSpec = DEFAULT_SPEC) -> Row:
    """Check files, metrics, figures and the publication flag of a release.

    Returns a header row; it has one per snapshot.
    """
    require_committed(spark, out)
    bad = manifest_status(spark, out).where("status <> 'ok'").orderBy("relative_path").first()
    if bad is not None:
        path, status = bad["relative_path"], bad["status"]
        if status == "missing":
            raise FileNotFoundError(f"Listed in the manifest but lost: {path}")
        kinds = {"size_mismatch": SIZE_MISMATCH_TEXT, "checksum_mismatch": CHECKSUM_MISMATCH_TEXT}
        raise ValueError(f"{kinds.get(status, 'Not listed in the manifest')}: {path}")
    header_table = read_header(spark, out)
    header = header_table.first()
    if header["scope_column"] != spec.scope_col:
        spec = spec.keyed()
    stored = read_metrics(spark, f"{out}/data/fact", spec, header["fact_format"])
    enforce_metrics(stored, spec)
    check_figures(stored, header_table, spec)
    if "publication_allowed" in header_table.columns and not header_table.where("publication_allowed").isEmpty():
        raise ValueError("A release candidate must not allow publication.")
    return header
