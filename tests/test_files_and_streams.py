"""Real files and streams."""

import json

from pyspark.sql import functions as F

from pageloom import catalog
from pageloom.operators import tasks as T
from pageloom.sources import files as S
from pageloom.streaming import tasks as ST


def test_binary_files_are_routed_by_content(spark, tmp_path, rows):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.bin").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "sub" / "b.pdf").write_bytes(b"\x89PNG\r\n\x1a\n123")
    (tmp_path / "c.png").write_bytes(b"plain words")
    got = S.route_by_content(S.scan_files(spark, str(tmp_path))).withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    assert rows(got, "name", "kind") == {("a.bin", "pdf"), ("b.pdf", "image")}


def test_indented_model_output(spark, tmp_path):
    pages = [{"layout_dets": [{"category_id": 1, "poly": [0, 0, 9, 0, 9, 5, 0, 5], "score": 0.9}], "page_info": {"page_no": 3, "height": 10, "width": 20}},
             {"layout_dets": [], "page_info": {"page_no": 4, "height": 10, "width": 20}}]
    (tmp_path / "paper.json").write_text(json.dumps(pages, indent=2))
    got = S.read_page_results(spark, str(tmp_path), multi_line=True).collect()
    assert [(r.doc_id, r.page_idx, r.det_id, r.category_id, r.poly[4], r.width) for r in got] == [("paper", 3, 1, 1, 9.0, 20)]


def test_result_texts(spark, tmp_path, rows):
    (tmp_path / "x" / "auto").mkdir(parents=True)
    (tmp_path / "x" / "auto" / "x.md").write_text("# a\n\nb")
    (tmp_path / "x" / "notes.txt").write_text("n")
    (tmp_path / "x" / "x.json").write_text("{}")
    assert rows(S.read_result_texts(spark, str(tmp_path)), "text") == {("# a\n\nb",), ("n",)}


def test_arrivals_become_tasks_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, data in (("a.PDF", b"1"), ("b.pdf", b"1"), ("c.docx", b"2")):
        (folder / name).write_bytes(data)
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").load(str(folder))
    got = ST.run_to_table(ST.submit_documents(stream), "arrivals").collect()
    assert sorted((r.route, r.status) for r in got) == [("other", "pending"), ("pdf_image", "pending")]


def test_illegal_transitions(spark):
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    steps = {1: ["pending", "processing", "completed"], 2: ["pending", "completed", "cancelled", "processing"], 3: ["processing", "pending", "processing", "failed", "completed"]}
    data = [(task, t0 + timedelta(minutes=k), k, s, "w") for task, ss in steps.items() for k, s in enumerate(ss)]
    events = spark.createDataFrame(data, "task_id bigint, ts timestamp, event_id bigint, status string, worker string")
    got = {r.task_id: (r.status, r.rejected) for r in T.task_states(events).collect()}
    assert got == {1: ("completed", 0), 2: ("cancelled", 2), 3: ("failed", 2)}


def test_stream_and_batch_agree(spark):
    t = catalog.Tables(spark, "/root/testdata/sf0.001")
    stream = ST.run_to_table(ST.task_transitions(ST.read_folder(spark, t.folder("task_events"), t.task_events)), "parity")
    last = stream.where("legal").groupBy("task_id").agg(F.max_by("status", F.struct("ts", "event_id")).alias("status"))
    batch = T.task_states(t.task_events).select("task_id", "status")
    assert last.exceptAll(batch).isEmpty() and batch.exceptAll(last).isEmpty()


def test_tasks_share_states_over_batches(spark, tmp_path):
    import os
    from datetime import datetime

    schema = "task_id bigint, ts timestamp, event_id bigint, status string, worker string"
    big = 1 << 60
    steps = [[("pending", "a"), ("processing", "w")], [("completed", "x"), ("completed", "w"), ("cancelled", "w")]]
    for day, part in enumerate(steps):
        data = [(None if k == 50 else big + k, datetime(2024, 1, 1 + day, 1, n), n, s, w) for k in range(51) for n, (s, w) in enumerate(part)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
        for f in (tmp_path / "events").glob("*.parquet"):
            os.utime(f, (f.stat().st_mtime - 100,) * 2)  # the first one is older
    events = ST.read_folder(spark, str(tmp_path / "events"), spark.createDataFrame([], schema), maxFilesPerTrigger="1")
    out = ST.run_to_table(ST.task_transitions(events, buckets=4), "shared")
    got = {(r.task_id, r.status, r.worker): r.legal for r in out.collect()}
    tasks = [*range(big, big + 50), None]
    assert got == {(t, s, w): (s, w) not in (("completed", "x"), ("cancelled", "w")) for t in tasks for part in steps for s, w in part}
    base = os.path.dirname(os.path.dirname(out.inputFiles()[0]))
    assert spark.read.format("statestore").load(f"{base}/progress").count() <= 5
