from __future__ import annotations

import json

from tristrata.streaming.milestones import follow_run_summary, follow_stage_seconds, read_milestones


def append(folder, name, events):
    lines = [json.dumps({"name": n, "t_seconds": t, "run_id": "r", "meta": {"k": "v"}}) for n, t in events]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_durations_follow_the_log(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    append(log, "a.json", [("load.start", 1.0), ("load.done", 3.0), ("build.start", 4.0)])
    events = read_milestones(spark, str(log))
    stages = (
        follow_stage_seconds(events).writeStream.outputMode("complete").format("memory").queryName("stages")
        .option("checkpointLocation", str(tmp_path / "c1")).start()
    )
    runs = (
        follow_run_summary(events).writeStream.outputMode("complete").format("memory").queryName("runs")
        .option("checkpointLocation", str(tmp_path / "c2")).start()
    )
    try:
        stages.processAllAvailable()
        assert [tuple(r) for r in spark.table("stages").collect()] == [("r", "load", 2.0)]
        append(log, "b.json", [("load.done", 6.0), ("build.done", 9.5)])
        stages.processAllAvailable()
        runs.processAllAvailable()
        assert {tuple(r) for r in spark.table("stages").collect()} == {("r", "load", 5.0), ("r", "build", 5.5)}
        assert [tuple(r) for r in spark.table("runs").collect()] == [("r", 5, 9.5)]
    finally:
        stages.stop()
        runs.stop()
