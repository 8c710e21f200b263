"""Stored files: ranged and streamed reads, mixed folders, the ledger of loads."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidelines.catalog import derived
from tidelines.catalog.derived import bronze_docs, events
from tidelines.plans.silver_jobs import run_bronze_to_silver
from tidelines.schemas import AIR_QUALITY_BRONZE
from tidelines.session import staged
from tidelines.sources import bronze, files, footers, inventory, silver
from tidelines.sources.ledger import Ledger, withdraw

US = pa.timestamp("us", tz="UTC")


def _text(data: bytes, name: str = "a.gz") -> list[bytes]:
    file = pa.BufferReader(data)
    return list(files.lines(files.unpacked(file) if name.endswith(".gz") else files.blocks(file)))


@pytest.mark.parametrize("size", [7, 1 << 20])
def test_gzip_members_and_damage(monkeypatch, size):
    monkeypatch.setattr(files.blocks, "__defaults__", (size,))
    monkeypatch.setattr(files, "BLOCK", size)
    two = gzip.compress(b"one\ntwo") + gzip.compress(b"\nthree\n\n") + gzip.compress(b"") + b"\0" * 40
    assert _text(two) == [b"one", b"two", b"three"]
    long = b"\n".join(b"%d" % (k * 7919) for k in range(5000))
    packed = gzip.compress(long)
    assert _text(packed) == long.split(b"\n") and _text(long, "a") == long.split(b"\n")
    for bad, reason in ((packed[:-20], "truncated"), (b"", "empty file"), (b"no gzip at all", "incorrect header"), (packed + b"more", "header")):
        with pytest.raises(files.Damaged, match=reason):
            _text(bad)
    flipped = bytearray(packed)
    flipped[len(packed) // 2] ^= 0xFF
    with pytest.raises(files.Damaged):
        _text(bytes(flipped))


def test_documents_before_a_fault_are_kept_and_bronze_is_read_once(spark, tmp_path):
    docs = [json.dumps({"stationID": f"s{k}", "hourly": {"time": ["2024-01-01T00:00"], "pm2_5": [k]}}) for k in range(3000)]
    packed = gzip.compress("\n".join(docs).encode())
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "cut.json.gz").write_bytes(packed[: len(packed) // 2])
    (tmp_path / "b" / "plain.json").write_text("\n".join([*docs[:5], '{"stationID": ', "", docs[5]]))
    found = bronze.scan_documents(spark, str(tmp_path / "b")).select("file_path", "stationID", "reason", "_corrupt").collect()
    plain = [r for r in found if "plain" in r.file_path]
    assert sorted(r.stationID for r in plain if r.stationID) == sorted(f"s{k}" for k in range(6))
    cut = [r for r in found if "cut" in r.file_path]
    whole = [r.stationID for r in cut if r.reason is None]
    assert [r.reason for r in cut if r.reason] == ["truncated"] and whole == [f"s{k}" for k in range(len(whole))] and len(whole) > 500
    lost = {(r.file_path.rsplit("/", 1)[1], r.reason, r.documents) for r in bronze.losses(spark, str(tmp_path / "b")).collect()}
    assert lost == {("cut.json.gz", "truncated", None), ("plain.json", "malformed documents", 1)}


def test_footers_are_all_that_is_read(spark, tmp_path):
    rows = pa.table({"stationID": ["x" * 50 + str(k) for k in range(40_000)], "timestamp_utc": pa.array(range(40_000), US)})
    sink = io.BytesIO()
    pq.write_table(rows, sink, row_group_size=10_000)
    data = bytearray(sink.getvalue())
    foot = int.from_bytes(data[-8:-4], "little") + 8
    data[4 : len(data) - foot] = b"\xff" * (len(data) - foot - 4)  # no page can be read any more
    (tmp_path / "ruined.parquet").write_bytes(data)
    with open(tmp_path / "huge.parquet", "wb") as f:
        f.truncate(5 << 30)  # beyond what a binary value can hold; no footer
    got = {r.file_path.rsplit("/", 1)[1]: r for r in footers.parquet_types(spark, str(tmp_path), ["timestamp_utc", "other"]).collect()}
    assert (got["ruined.parquet"].timestamp_utc, got["ruined.parquet"].groups, got["ruined.parquet"].other) == ("timestamp", 4, None)
    assert got["huge.parquet"].error and got["ruined.parquet"].error is None


def test_mixed_folder_by_row_groups(spark, tmp_path):
    """Every stored form of the times, several row groups, floats, missing columns and a broken file in one folder."""
    base, n = 1_704_067_200_000_000, 25
    times = [base + 3_600_000_000 * k for k in range(n)]
    for year in (2023, 2024):
        folder = tmp_path / "air" / f"year={year}" / "month=01"
        folder.mkdir(parents=True)
        forms = {
            "nanos": {"timestamp_utc": pa.array([t * 1000 for t in times], pa.timestamp("ns")), "ingestion_timestamp_utc": pa.array([base * 1000] * n, pa.timestamp("ns", tz="UTC"))},
            "plain": {"timestamp_utc": pa.array(times, US), "ingestion_timestamp_utc": pa.array([base] * n, pa.timestamp("us"))},
            "text": {"timestamp_utc": pa.array(times, US), "ingestion_timestamp_utc": pa.array(["2024-01-01T00:00:00"] * n)},
        }
        for name, columns in forms.items():
            pollutant = {"no2_ugm3": pa.array([0.5] * n, pa.float32())} if name == "text" else {"nitrogen_dioxide_ugm3": [0.5] * n}
            pq.write_table(pa.table({"stationID": [name] * n, **columns, **pollutant}), folder / f"{name}.parquet", row_group_size=10)
        old = pa.table({"stationID": ["old"] * n, "timestamp_utc": pa.array(times, US), "ingestion_timestamp_utc": pa.array([base] * n, US)})
        pq.write_table(old, folder / "old.parquet", use_deprecated_int96_timestamps=True, row_group_size=10)
    read = lambda **more: silver.read_air_quality(spark, [silver.Generation(str(tmp_path / "air"))], **more)
    rows = read().collect()
    assert len(rows) == 8 * n
    assert {(r.stationID, r.nitrogen_dioxide_ugm3) for r in rows} == {("nanos", 0.5), ("plain", 0.5), ("text", 0.5), ("old", None)}
    assert {str(r.ingestion_timestamp_utc) for r in rows} == {"2024-01-01 00:00:00"}
    for name in ("nanos", "plain", "text", "old"):
        assert sorted({str(r.timestamp_utc) for r in rows if r.stationID == name})[0] == "2024-01-01 00:00:00"
        assert len({r.timestamp_utc for r in rows if r.stationID == name}) == n
    assert read(years=[2024]).count() == 4 * n
    (tmp_path / "air" / "year=2024" / "month=01" / "broken.parquet").write_bytes(b"PAR1 no parquet")
    with pytest.raises(footers.LostData, match="broken.parquet"):
        read()
    assert read(losses=str(tmp_path / "lost")).count() == 8 * n


def test_checksums_are_hashed_in_blocks(spark, tmp_path):
    data = bytes(range(256)) * 20_000
    (tmp_path / "a.parquet").write_bytes(data)
    (tmp_path / "empty.parquet").write_bytes(b"")  # Spark lists no files without content
    got = {r.name: r.md5 for r in inventory.checksums(spark, str(tmp_path)).collect()}
    assert got == {"a.parquet": hashlib.md5(data).hexdigest()}


def _drop(folder, name, station, hours):
    folder.mkdir(exist_ok=True)
    times = [f"2024-01-01T{h:02d}:00" for h in hours]
    (folder / name).write_text(json.dumps({"stationID": station, "latitude": 1.0, "longitude": 2.0, "hourly": {"time": times, "pm2_5": list(hours)}}))


def test_loads_can_be_repeated(spark, tmp_path):
    source, target, ledger = tmp_path / "b", str(tmp_path / "s"), str(tmp_path / "ledger")
    load = lambda number, **more: run_bronze_to_silver(
        spark, str(source), target, data_source="t", load_id=f"l{number}", ingested_at="2024-02-01T00:00:00", ledger=ledger, **more
    )
    held = lambda: sorted((r.stationID, r.pm2_5_ugm3, r.load_id) for r in silver.read_air_quality(spark, [silver.Generation(target)]).collect())
    _drop(source, "a b.json", "a", range(3))
    load(1)
    load(2)
    assert held() == [("a", float(h), "l1") for h in range(3)]
    assert Ledger(ledger).unfinished(spark) == []
    _drop(source, "c.json", "c", range(2))
    # A load of the new file stops between its write and its commit.
    book = Ledger(ledger)
    book.begin(spark, "l3")
    silver.write_silver(bronze.air_quality_silver(bronze.read_bronze(spark, str(source / "c.json")), data_source="t", load_id="l3", ingested_at="2024-02-01T00:00:00"), target)
    assert len(held()) == 5 and Ledger(ledger).unfinished(spark) == ["l3"]
    load(3)  # the same id again, as it never was complete
    assert held() == [("a", float(h), "l1") for h in range(3)] + [("c", float(h), "l3") for h in range(2)]
    with pytest.raises(ValueError, match="taken"):
        _drop(source, "d.json", "d", range(1))
        load(3)
    load(4)
    assert len(held()) == 6
    # A file with a new length is loaded again.
    _drop(source, "d.json", "d", range(4))
    load(5)
    assert len(held()) == 10
    assert {r.path.rsplit("/", 1)[1] for r in book.loaded(spark).collect()} == {"a b.json", "c.json", "d.json"}


def test_a_lost_file_stops_a_load_before_it_begins(spark, tmp_path):
    source, ledger = tmp_path / "b", str(tmp_path / "ledger")
    _drop(source, "a.json", "a", range(3))
    (source / "bad.json.gz").write_bytes(b"xyz")
    names = {"data_source": "t", "load_id": "l1", "ingested_at": "2024-02-01T00:00:00", "ledger": ledger}
    with pytest.raises(footers.LostData):
        run_bronze_to_silver(spark, str(source), str(tmp_path / "s"), **names)
    assert Ledger(ledger).loads(spark).count() == 0
    assert run_bronze_to_silver(spark, str(source), str(tmp_path / "s"), **names, losses=str(tmp_path / "lost")).count() == 3


def test_files_of_several_loads_are_not_withdrawn(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2)], "load_id string, x int").coalesce(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="mix"):
        withdraw(spark, str(tmp_path / "t"), ["a"])
    withdraw(spark, str(tmp_path / "nowhere"), ["a"])
    withdraw(spark, str(tmp_path / "t"), ["a", "b"])
    assert not list((tmp_path / "t").glob("*.parquet"))


def test_a_file_for_each_station_name(spark, sf_dir, tmp_path, monkeypatch):
    """Events read by several tasks still give one file a name."""
    from tidelines.catalog import job_queries

    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(6).write.parquet(f"{tmp_path}/in/events.parquet")
    monkeypatch.setattr(job_queries, "scratch_dir", lambda spark, purpose: f"{tmp_path}/out")
    rows = job_queries.station_names_in_paths(spark, f"{tmp_path}/in").collect()
    names = {p.name for p in (tmp_path / "out" / "docs").glob("name=*")}
    files = list((tmp_path / "out" / "docs").glob("name=*/*.json"))
    assert len(rows) == len(names) == len(files)
    assert sum(r.documents for r in rows) == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_documents_a_file_are_bounded(spark, tmp_path, monkeypatch):
    """A gzip file is unpacked by one task, so one task's documents make several files, and so do the staged ones."""
    monkeypatch.setattr(bronze, "DOCUMENTS", 10)
    hours = [("a", 1.0, 2.0, (["2024-01-01T00:00"], [float(k)])) for k in range(25)]
    docs = spark.createDataFrame(hours, "stationID string, latitude double, longitude double, hourly struct<time:array<string>,pm2_5:array<double>>")
    bronze.write_bronze(docs.coalesce(1), str(tmp_path / "b"))
    assert len(list((tmp_path / "b" / "year=2024" / "month=01").glob("*.json.gz"))) == 3
    names = {"data_source": "t", "load_id": "l1", "ingested_at": "2024-02-01T00:00:00"}
    rows = run_bronze_to_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), **names)
    assert sorted(r.pm2_5_ugm3 for r in rows.collect()) == [float(k) for k in range(25)]
    one = staged(spark.range(25).coalesce(1), "bounded", 10)
    assert one.count() == 25 and len(one.inputFiles()) == 3


def test_makers_of_documents_grow_with_the_events(spark, sf_dir):
    """The events are one file of one row group, which a single task reads."""
    n = events(spark, sf_dir).count()
    assert bronze_docs(spark, sf_dir).rdd.getNumPartitions() == 1
    parts = derived.dealt(events(spark, sf_dir), n // 10).rdd.glom().map(len).collect()
    assert len(parts) in (10, 11) and sum(parts) == n and max(parts) < n // 5
    assert bronze_docs(spark, sf_dir, deal=True).count() == n


def test_a_load_is_read_in_small_shares(spark, tmp_path, monkeypatch):
    key = "spark.sql.files.maxPartitionBytes"
    share = lambda: spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    before, seen, write = share(), [], silver.write_silver
    monkeypatch.setattr(silver, "write_silver", lambda *args: (seen.append(share()), write(*args)))
    _drop(tmp_path / "b", "a.json", "a", range(3))
    names = {"data_source": "t", "load_id": "l1", "ingested_at": "2024-02-01T00:00:00"}
    load = lambda target: run_bronze_to_silver(spark, str(tmp_path / "b"), str(tmp_path / target), **names)
    assert load("s").count() == 3
    assert seen == [24 << 20] and share() == before
    spark.conf.set(key, "1m")  # a smaller one of the session stays
    try:
        assert load("t").count() == 3 and seen[1:] == [1 << 20] == [share()]
        (tmp_path / "b" / "bad.json.gz").write_bytes(b"xyz")
        with pytest.raises(footers.LostData):
            load("u")
        assert share() == 1 << 20
    finally:
        spark.conf.unset(key)
    assert share() == before


def test_a_time_is_read_once(spark):
    times = ["2024-01-01T00:00", "not-a-time", None, "2024-01-01T03:00"]
    docs = spark.createDataFrame([("a", 1.0, 2.0, (times, [1.0, 2.0, 3.0]))], "stationID string, latitude double, longitude double, hourly struct<time:array<string>,pm2_5:array<double>>")
    hourly = F.struct("hourly.*", *[F.lit(None).cast("array<double>").alias(c) for c in AIR_QUALITY_BRONZE["hourly"].dataType.names if c not in ("time", "pm2_5")])
    rows = bronze.air_quality_silver(docs.withColumn("hourly", hourly), data_source="t", load_id="l", ingested_at="2024-02-01T00:00:00")
    assert [(str(r.timestamp_utc), r.pm2_5_ugm3) for r in rows.orderBy("timestamp_utc").collect()] == [("2024-01-01 00:00:00", 1.0), ("2024-01-01 03:00:00", None)]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp") == 1


def test_month_folders_of_any_year(spark, tmp_path):
    """Folders are named as a formatted time, in years of other than four digits as well."""
    rows = spark.sql("SELECT 'a' AS stationID, explode(array(TIMESTAMP'0999-01-31', TIMESTAMP'2024-12-01', TIMESTAMP'+12024-10-05')) AS timestamp_utc")
    want = {(r.y, r.m) for r in rows.select(F.date_format("timestamp_utc", "yyyy").alias("y"), F.date_format("timestamp_utc", "MM").alias("m")).collect()}
    silver.write_silver(rows, str(tmp_path / "s"))
    got = {tuple(unquote(p.split("=")[1]) for p in (f.parent.name, f.name)) for f in (tmp_path / "s").glob("year=*/month=*")}
    assert got == want
