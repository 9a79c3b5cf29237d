"""Landing, monitoring, latest run, sinks and the whole path from CSV to summary."""

import csv
import hashlib

import pytest
from operations_data import clean
from pyspark.sql import functions as F

from touchstone.plans.engine import validate
from touchstone.plans.monitoring import (
    NothingLandedError,
    complete_runs,
    finding_evidence,
    land_monitored,
    latest_complete_run,
    run_status,
    severity_rollup,
    status_rollup,
)
from touchstone.plans.operations import OPERATIONS
from touchstone.sources import (
    LandingError,
    destination,
    file_checksums,
    land,
    land_all,
    read_landed,
    scan_csv,
    source_checksum,
    write_accepted,
    write_findings,
    write_quarantine,
)
from touchstone.operators.scan import running_before
from touchstone.sources import landing
from touchstone.sources.landing import with_row_index

DAY = "2026-08-03"


def store(folder, data):
    folder.mkdir(parents=True, exist_ok=True)
    paths = {}
    for name, rows in data.items():
        columns = list(dict.fromkeys([*rows[0], *OPERATIONS.entity(name).required, "extra_note"]))
        path = folder / f"{name}.csv"
        with path.open("w", newline="") as handle:
            writer = csv.DictWriter(handle, columns, restval="")
            writer.writeheader()
            writer.writerows(rows)
        paths[name] = str(path)
    return paths


def test_destination_and_arguments():
    entity = OPERATIONS.entity("regions")
    assert destination(entity, DAY, "run-1", "/lake/") == f"/lake/regions/ingestion_date={DAY}/run_id=run-1"
    for bad in ({"root": " "}, {"run_id": "-x"}, {"run_id": "a/b"}, {"ingestion_date": "03/08/2026"}):
        with pytest.raises(LandingError):
            destination(entity, **({"ingestion_date": DAY, "run_id": "r", "root": "/lake"} | bad))


def test_land_checks_and_overwrite(spark, tmp_path):
    paths = store(tmp_path / "src", clean())
    root = str(tmp_path / "lake")

    def go(name, path, **options):
        return land(spark, OPERATIONS, name, path, DAY, "r1", root=root, **options)

    result = go(" Employees ", paths["employees"])
    assert (result.entity_name, result.row_count) == ("employees", 2)
    landed = spark.read.parquet(result.destination_path)
    assert "extra_note" in landed.columns and dict(landed.dtypes)["employee_id"] == "string"
    assert [r.employee_id for r in landed.orderBy("_row_index").collect()] == ["100", "101"]
    with pytest.raises(LandingError, match="already landed"):
        go("employees", paths["employees"])
    assert go("employees", paths["employees"], overwrite=True).row_count == 2
    (tmp_path / "short.csv").write_text("region_id,region_name\n1,x\n")
    with pytest.raises(LandingError, match="lacks columns: region_code"):
        go("regions", str(tmp_path / "short.csv"))
    (tmp_path / "empty.csv").write_text("region_id,region_code,region_name\n")
    with pytest.raises(LandingError, match="no data rows"):
        go("regions", str(tmp_path / "empty.csv"))
    (tmp_path / "latin.csv").write_bytes("region_id,region_code,region_name\n1,R,Café\n".encode("latin-1"))
    with pytest.raises(LandingError, match="UTF-8"):
        go("regions", str(tmp_path / "latin.csv"))
    with pytest.raises(LandingError, match="no source"):
        go("regions", str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="Unknown entity"):
        go("nothing", paths["regions"])
    with pytest.raises(LandingError, match="not so: other, regions"):
        named = {k: v for k, v in paths.items() if k != "regions"} | {"other": "x"}
        land_all(spark, OPERATIONS, named, DAY, "r", root=root)


def test_row_index_follows_file_order_across_splits(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    count = 0
    for part in range(3):
        with (folder / f"part-{part}.csv").open("w") as handle:
            handle.write("n,pad\n")
            for _ in range(4000 + part):
                handle.write(f"{count},{'x' * 40}\n")
                count += 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        source = scan_csv(spark, str(folder))
        assert source.rdd.getNumPartitions() > 6
        rows = with_row_index(source)
        assert rows.count() == count
        assert rows.where(F.col("_row_index") != F.col("n").cast("long")).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_numbering_ten_thousand_files(spark):
    rows = [(f"f{(i * 7919) % 10_000:05d}", 1 + i % 5) for i in range(10_000)]
    files = spark.createDataFrame(rows, "_file string, _rows long").repartition(6)
    summed = running_before(files, ["_file"], "_rows", "_base")
    base, expected = 0, {}
    for name, size in sorted(rows):
        expected[name] = base
        base += size
    assert {r["_file"]: r["_base"] for r in summed.collect()} == expected
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert running_before(files.limit(0), ["_file"], "_rows", "_base").isEmpty()


def test_rows_are_counted_as_they_are_written(spark, tmp_path, monkeypatch):
    paths = store(tmp_path / "src", clean())
    (tmp_path / "many").mkdir()
    for i in range(40):
        with open(tmp_path / "many" / f"p{i:02d}.csv", "w") as out:
            out.write("region_id,region_code,region_name\n" + "".join(f"{i}-{k},c,n\n" for k in range(i)))
    result = land(spark, OPERATIONS, "regions", str(tmp_path / "many"), DAY, "r1", root=str(tmp_path / "lake"))
    landed = spark.read.parquet(result.destination_path)
    assert result.row_count == sum(range(40)) == landed.count()
    got = [r["region_id"] for r in landed.orderBy("_row_index").collect()]
    assert got == [f"{i}-{k}" for i in range(40) for k in range(i)]
    assert paths


def test_checksums(spark, tmp_path):
    paths = store(tmp_path / "src", clean())
    want = {p.split("/")[-1]: hashlib.sha256(open(p, "rb").read()).hexdigest() for p in paths.values()}
    for block in (7, 8 << 20):  # many reads a file, and one
        got = {r.path.split("/")[-1]: r.checksum_sha256 for r in file_checksums(spark, paths.values(), block_bytes=block).collect()}
        assert got == want
    assert source_checksum(spark, paths["crews"]) == want["crews.csv"]
    several = source_checksum(spark, str(tmp_path / "src"))
    assert several not in want.values() and several == source_checksum(spark, str(tmp_path / "src") + "/", block_bytes=5)
    odd = tmp_path / "odd name+50%.csv"
    odd.write_bytes(b"a\n")
    assert source_checksum(spark, str(odd)) == hashlib.sha256(b"a\n").hexdigest()
    with open(paths["crews"], "a") as handle:
        handle.write(" ")
    assert source_checksum(spark, str(tmp_path / "src")) != several


def test_every_file_of_a_source_is_checked(spark, tmp_path):
    def source(name, *texts):
        (tmp_path / name).mkdir()
        for i, text in enumerate(texts):
            (tmp_path / name / f"{i}.csv").write_text(text)
        return land(spark, OPERATIONS, "regions", str(tmp_path / name), DAY, name, root=str(tmp_path / "lake"))

    first = "region_id,region_code,region_name\n1,A,x\n"
    result = source("good", first, first.replace("1,A", "2,B"))
    rows = spark.read.parquet(result.destination_path).orderBy("_row_index").collect()
    assert [(r._row_index, r.region_id, r.region_code) for r in rows] == [(0, "1", "A"), (1, "2", "B")]
    for name, other in (
        ("swapped", "region_code,region_id,region_name\nB,2,y\n"), ("lacking", "region_id,region_name\n2,y\n"),
        ("extra", "region_id,region_code,region_name,more\n2,B,y,z\n"),
    ):
        with pytest.raises(LandingError, match="differ in their header"):
            source(name, first, other)
    with pytest.raises(LandingError, match="open quote"):
        source("quoted", 'region_id,region_code,region_name\n1,A,"two\nlines"\n')
    assert source("literal", 'region_id,region_code,region_name\n1,A,5" pipe\n').row_count == 1


def test_csv_to_summary(spark, tmp_path):
    data = clean()
    data["regions"].append(dict(region_id="2", region_code="", region_name="   "))
    data["regions"].append(dict(region_id="3", region_code="R-3", region_name=""))
    paths = store(tmp_path / "src", data)
    root, table = str(tmp_path / "lake"), "monitoring_test"

    def go(sources, run, **options):
        return land_monitored(spark, OPERATIONS, sources, DAY, run, root=root, table=table, **options)

    first = go(paths, "r1")
    assert (first.status, first.landed) == ("SUCCEEDED", 12)
    assert latest_complete_run(spark, OPERATIONS, DAY, table) == "r1"
    partial = go({k: v for k, v in paths.items() if k != "crews"}, "r2")
    assert (partial.status, partial.failed) == ("PARTIAL_SUCCESS", 1)
    with pytest.raises(NothingLandedError):
        go({}, "r3")
    # A repeated run id replaces its records instead of adding to them.
    assert go(paths, "r1", overwrite=True).status == "SUCCEEDED"
    records = spark.table(table)
    assert records.count() == 36
    states = {r.run_id: r.status for r in run_status(records).collect()}
    assert states["r2"] == "PARTIAL_SUCCESS" and states["r3"] == "FAILED"
    failed = records.where("run_id = 'r2' AND status = 'FAILED'").first()
    assert failed.entity_name == "crews" and failed.error_type == "LandingError" and failed.row_count is None
    go(paths, "r4")
    assert latest_complete_run(spark, OPERATIONS, DAY, table) == "r4"
    assert complete_runs(records, "2026-01-01", 12).isEmpty()
    with pytest.raises(RuntimeError):
        latest_complete_run(spark, OPERATIONS, "2026-01-01", table)
    rollup = status_rollup(spark.table(table), "r4").first()
    assert (rollup.status, rollup.entity_count, rollup.row_count) == ("SUCCEEDED", 12, 15)

    result = validate(read_landed(spark, OPERATIONS, DAY, "r4", root=root), OPERATIONS, "s1")
    for _ in range(2):  # repeating a run leaves one copy of its output
        write_accepted(result, str(tmp_path / "accepted"))
        write_findings(result, str(tmp_path / "findings"))
        write_quarantine(result, str(tmp_path / "quarantine"))
    accepted = spark.read.parquet(str(tmp_path / "accepted" / "regions"))
    assert {r.region_id for r in accepted.collect()} == {"1", "3"}
    findings = spark.read.parquet(str(tmp_path / "findings"))
    assert {r.severity: r.finding_count for r in severity_rollup(findings, "s1").collect()} == {"Critical": 2, "Warning": 1}
    assert {r.checksum_sha256 for r in spark.table(table).where("run_id = 'r4' AND entity_name = 'crews'").collect()} == {
        hashlib.sha256(open(paths["crews"], "rb").read()).hexdigest()
    }
    shown = [(r.record_id, r.rule_id) for r in finding_evidence(findings, "s1").collect()]
    assert shown == [("2", "REG-001"), ("2", "XEN-010"), ("3", "REG-003")]
    kept = spark.read.parquet(str(tmp_path / "quarantine")).collect()
    assert [(r.run_id, r.entity, r.record_id) for r in kept] == [("s1", "regions", "2")]
    for _ in range(2):  # tables as well as folders, and other formats
        write_findings(result, "sink_findings")
        write_quarantine(result, "sink_quarantine", source_format="orc")
        write_accepted(result, "sink_accepted", source_format="orc")
    assert spark.table("sink_findings").where("run_id = 's1'").count() == findings.count()
    assert [(r.entity, r.finding_count) for r in spark.table("sink_quarantine").collect()] == [("regions", 2)]
    assert {r.region_id for r in spark.table("sink_accepted_regions").collect()} == {"1", "3"}
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("sink_")]:
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("most", [None, 0], ids=["few blocks", "many blocks"])
def test_rows_are_numbered_without_a_shuffle_where_blocks_are_few(spark, tmp_path, monkeypatch, most):
    (tmp_path / "parts").mkdir()
    for part in range(2):
        (tmp_path / "parts" / f"part-{part}.csv").write_text("n\n" + "".join(f"{part * 3000 + i}\n" for i in range(3000)))
    if most is not None:
        monkeypatch.setattr(landing, "_BROADCAST_BLOCKS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = with_row_index(scan_csv(spark, str(tmp_path / "parts")))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange hashpartitioning" in plan) == (most == 0)
        assert sorted((r._row_index, int(r.n)) for r in rows.collect()) == [(i, i) for i in range(6000)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parsed_rows_are_kept_as_columns_and_go_with_the_landing(spark, tmp_path, monkeypatch):
    paths = store(tmp_path / "in", {"regions": clean()["regions"]})
    kept = []
    monkeypatch.setattr(landing, "_kept", lambda spark: kept.append(str(tmp_path / f"kept-{len(kept)}")) or kept[-1])
    seen = []
    remove = landing._remove
    monkeypatch.setattr(landing, "_remove", lambda spark, folder: seen.append(spark.read.parquet(folder).count()) or remove(spark, folder))
    result = land(spark, OPERATIONS, "regions", paths["regions"], DAY, "kept", root=str(tmp_path / "lake"))
    assert seen == [result.row_count] == [spark.read.parquet(result.destination_path).count()]
    assert kept == [str(tmp_path / "kept-0")] and not (tmp_path / "kept-0").exists()
