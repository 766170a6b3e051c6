"""Files that grow, rotate and are cut back: every line is delivered once, over triggers and restarts."""

import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators.dedup import dedup  # noqa: F401
from clickloom.sources import growing
from clickloom.sources.connectors import stream_lines
from clickloom.streaming.ingest import Tables, start_ingest
from test_streaming import NOW, event


def add(path, *lines, end="\n"):
    with open(path, "a") as f:
        f.write("".join(line + "\n" for line in lines[:-1]) + (lines[-1] + end if lines else ""))


def pull(spark, source, out, **config):
    """One run of a stream of lines over all that is there now."""
    lines = stream_lines(spark, {"file_path": source, **config})
    query = (lines.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
             .trigger(**NOW).start())
    query.awaitTermination(60)
    assert query.exception() is None
    return sorted(r.value for r in spark.read.schema("value string").parquet(f"{out}/rows").collect())


def test_appended_lines_arrive_once_over_restarts(spark, tmp_path):
    source, out = str(tmp_path / "in" / "ad_events.jsonl"), str(tmp_path / "out")
    os.makedirs(tmp_path / "in")
    add(source, "a", "b")
    assert pull(spark, source, out) == ["a", "b"]
    add(source, "c", "half", end="")
    assert pull(spark, source, out) == ["a", "b", "c"]
    add(source, " whole", "", "é")
    assert pull(spark, source, out) == ["", "a", "b", "c", "half whole", "é"]
    assert pull(spark, source, out) == ["", "a", "b", "c", "half whole", "é"]


def test_rotation_between_triggers_loses_nothing(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    os.makedirs(folder)
    source = str(folder / "ad_events.jsonl")
    add(source, "a1", "a2")
    pull(spark, source, out)
    add(source, "a3")
    os.rename(source, folder / "ad_events-01.jsonl")
    add(source, "b1")
    assert pull(spark, source, out) == ["a1", "a2", "a3", "b1"]
    os.rename(source, folder / "ad_events-02.jsonl")
    add(source, "b1")  # the same first line in another file
    add(str(folder / "other.txt"), "not ours")
    assert pull(spark, source, out) == ["a1", "a2", "a3", "b1", "b1"]


def test_cut_back_file_starts_anew_and_settled_last_lines_count(spark, tmp_path):
    source, out = str(tmp_path / "in" / "e.jsonl"), str(tmp_path / "out")
    os.makedirs(tmp_path / "in")
    add(source, "a1", "a2")
    pull(spark, source, out)
    os.truncate(source, 0)
    add(source, "b1", "b2", "open", end="")
    assert pull(spark, source, out) == ["a1", "a2", "b1", "b2"]
    assert pull(spark, source, out, follow_options={"settledSeconds": 0}) == ["a1", "a2", "b1", "b2", "open"]


@pytest.mark.parametrize("split", [1, 2, 3, 7, 1000])
def test_pieces_share_out_all_lines(split, monkeypatch):
    monkeypatch.setattr(growing, "BLOCK", 4)
    rng = random.Random(split)
    lines = [bytes(rng.choice(b"xyz") for _ in range(rng.choice((0, 0, 1, 2, 5, 11)))) for _ in range(60)]
    data = b"\n".join(lines) + b"\n"

    class File(io.BytesIO):
        def read_at(self, n, at):
            self.seek(at)
            return self.read(n)

    begin = len(lines[0]) + 1
    pieces = [growing.Piece("", "", at, min(at + split, len(data)), len(data), at == begin) for at in range(begin, len(data), split)]
    got = [line for p in pieces for block in growing.lines_of(File(data), p) for line in block]
    assert got == lines[1:]


def test_lost_files_stop_the_stream(tmp_path):
    path = str(tmp_path / "e.jsonl")
    add(path, "a")
    reader = growing.GrowingReader({"path": str(tmp_path), "pattern": "e*.jsonl"})
    piece, = reader.partitions(reader.initialOffset(), reader.latestOffset())
    os.rename(path, tmp_path / "e-1.jsonl")
    assert [b.to_pydict() for b in reader.read(piece)] == [{"value": ["a"]}]
    os.remove(tmp_path / "e-1.jsonl")
    with pytest.raises(FileNotFoundError):
        list(reader.read(piece))


def test_growing_file_to_silver(spark, tmp_path):
    """Each appended line is in silver or in quarantine once, or a copy of one that is."""
    os.makedirs(tmp_path / "in")
    source, tables = str(tmp_path / "in" / "raw_ad_events.jsonl"), Tables(str(tmp_path / "out"))
    rounds = [[event("i1"), event("k1", "click", 60_000)], [event("i1"), event("i2", at=9)], [event("i3", at=10)]]
    for k, events in enumerate(rounds):
        add(source, *map(json.dumps, events), "broken")
        if k == 1:
            os.rename(source, tmp_path / "in" / "raw_ad_events-1.jsonl")
        for query in start_ingest(spark, {"file_path": source}, tables, trigger=NOW):
            query.awaitTermination(120)
            assert query.exception() is None
    assert sorted(r.event_id for r in spark.read.parquet(tables.silver).collect()) == ["i1", "i2", "i3", "k1"]
    assert spark.read.parquet(tables.quarantine).where(F.col("reason") == "malformed").count() == 3
