"""Compaction: whole reads at every moment, bounded files, few files for a campaign."""


import pytest

from clickloom.schema import DAY_MS
from clickloom.streaming import snapshots
from clickloom.streaming.ingest import Tables
from test_streaming import START, event, put, run


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


@pytest.fixture
def silver(spark, tmp_path):
    """Twelve small files of the stream on one day, one on the next."""
    folder, tables = str(tmp_path / "in"), Tables(str(tmp_path / "out"))
    for k in range(12):
        put(folder, f"ad_events-{k:02d}.jsonl", [event(f"e{k}-{i}", at=1000 * i + k, campaign_id=f"c{i}") for i in range(8)])
    put(folder, "ad_events-99.jsonl", [event("next", at=DAY_MS), event("none", at=DAY_MS, campaign_id=None)])
    run(spark, folder, tables)
    return folder, tables


def test_compaction_keeps_rows_and_bounds_files(spark, silver, monkeypatch):
    folder, tables = silver
    plain = ids(spark.read.parquet(tables.silver))
    assert ids(snapshots.read_snapshot(spark, tables)) == plain and len(plain) == 98
    assert snapshots.compact(spark, tables, small_files=5, file_bytes=20_000) == 0
    assert snapshots.compact(spark, tables, small_files=5) is None  # nothing was added since
    assert ids(snapshots.read_snapshot(spark, tables)) == plain
    entries = snapshots._manifest(spark, tables, 0).where("kind = 'file'").collect()
    size = sum(e.bytes for e in entries)
    assert 1 < len(entries) <= 6 and sum(e.rows for e in entries) == 96 and size > 0
    found = snapshots.read_snapshot(spark, tables, campaign_id="c3")
    assert ids(found) == sorted(f"e{k}-3" for k in range(12))
    compacted = [f for f in found.inputFiles() if "silver_compact" in f]
    assert len(compacted) < len(entries)
    assert ids(snapshots.read_snapshot(spark, tables, first_ms=START + DAY_MS)) == ["next", "none"]
    # the stream goes on, and an older version still reads whole
    put(folder, "ad_events-more.jsonl", [event(f"m{i}", at=5_000 + i, campaign_id="c3") for i in range(3)])
    run(spark, folder, tables)
    whole = sorted(plain + ["m0", "m1", "m2"])
    assert ids(snapshots.read_snapshot(spark, tables)) == whole
    assert snapshots.compact(spark, tables, small_files=0) == 1
    assert ids(snapshots.read_snapshot(spark, tables)) == whole == ids(snapshots.read_snapshot(spark, tables, version=0))
    assert snapshots.compact(spark, tables, small_files=0) is None
    assert snapshots.expire(spark, tables, keep=1) > 0
    assert snapshots.versions(spark, tables) == [1] and ids(snapshots.read_snapshot(spark, tables)) == whole


def test_reads_during_and_after_a_failed_compaction(spark, silver, monkeypatch):
    _, tables = silver
    plain = ids(spark.read.parquet(tables.silver))
    seen = []

    def fails(*_):
        seen.append(ids(snapshots.read_snapshot(spark, tables)))
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "_publish", fails)
        with pytest.raises(OSError):
            snapshots.compact(spark, tables, small_files=5)
    assert seen == [plain] and snapshots.versions(spark, tables) == []
    assert snapshots.compact(spark, tables, small_files=5) == 0
    assert ids(snapshots.read_snapshot(spark, tables)) == plain
    with pytest.raises(RuntimeError):
        snapshots._publish(spark, tables, snapshots._manifest(spark, tables, 0), 0)
