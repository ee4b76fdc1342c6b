from __future__ import annotations

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators import sessions as S
from tillstream.sources.clicks import job_clicks
from tillstream.sources.files import read_click_lines
from tillstream.streaming import sessions as stream
from tillstream.streaming.archive import SessionArchive


def click_files(folder, files=4, events=300, seed=3):
    """Events over two days in time order, spread over files, and a last one far behind."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    moments = sorted(start + timedelta(seconds=rng.uniform(0, 172_800)) for _ in range(events))
    lines = [
        {
            "event_id": str(number),
            "visitor_id": "hot" if rng.random() < 0.34 else f"v{rng.randint(1, 5)}",
            "event_type": rng.choice(["view", "AddToCart", "transaction", "other"]),
            "item_id": rng.choice([None, "1", "2"]),
            "event_ts": moment.isoformat() + "Z",
        }
        for number, moment in enumerate(moments)
    ]
    lines.append({"event_id": "end", "visitor_id": "sentinel", "event_type": "view", "event_ts": "2024-02-01T00:00:00Z"})
    size = -(-len(lines) // files)
    write_files(folder, [lines[number * size : (number + 1) * size] for number in range(files)])


def write_files(folder, parts):
    """Files of JSON lines whose times of change are in the order of ``parts``, which a stream follows."""
    folder.mkdir(exist_ok=True)
    for number, part in enumerate(parts):
        path = folder / f"{number}.jsonl"
        path.write_text("\n".join(json.dumps(line) for line in part) + "\n")
        os.utime(path, (1_700_000_000 + number * 10,) * 2)


def run(spark, tmp_path, events):
    target = tmp_path / "closed"
    query = stream.write_closed_sessions(events, str(target), str(tmp_path / "progress"))
    query.awaitTermination()
    return spark.read.parquet(str(target))


COLUMNS = ["visitor_id", "session_start_ts", "session_end_ts", "event_count", "view_count", "addtocart_count", "transaction_count", "sample_item_id"]


def test_closed_sessions_equal_the_batch_result(spark, tmp_path, rows):
    click_files(tmp_path / "clicks")
    source = str(tmp_path / "clicks")
    streamed = run(spark, tmp_path, stream.session_stream(stream.click_stream(spark, source, files_per_batch=1)))
    batch = S.summarize(job_clicks(read_click_lines(spark, source)), S.SessionRule.elapsed(30))
    assert rows(streamed.select(COLUMNS)) == rows(batch.where("visitor_id <> 'sentinel'").select(COLUMNS))


def test_redelivered_events_pass_once(spark, tmp_path):
    click_files(tmp_path / "clicks", files=1)
    (tmp_path / "clicks" / "1.jsonl").write_text((tmp_path / "clicks" / "0.jsonl").read_text())
    once = stream.once_per_event(stream.click_stream(spark, str(tmp_path / "clicks")), "60 days")
    assert run(spark, tmp_path, once).count() == 301


def test_redelivered_events_count_once(spark, tmp_path):
    click_files(tmp_path / "clicks", files=1)
    text = (tmp_path / "clicks" / "0.jsonl").read_text()
    (tmp_path / "clicks" / "0.jsonl").write_text(text + text)
    clicks = stream.click_stream(spark, str(tmp_path / "clicks"))
    closed = run(spark, tmp_path, stream.session_stream(clicks, distinct_events=True))
    assert closed.agg(F.sum("event_count")).first()[0] == 300


def all_lines(folder):
    return [json.loads(line) for path in sorted(folder.iterdir()) for line in path.read_text().splitlines()]


def batch_sessions(spark, source):
    return S.summarize(job_clicks(read_click_lines(spark, source)), S.SessionRule.elapsed(30))


@pytest.mark.parametrize("order", ["forward", "backward", "mixed"])
def test_an_archive_holds_the_batch_sessions_in_any_order(spark, tmp_path, rows, order):
    click_files(tmp_path / "clicks")
    lines = all_lines(tmp_path / "clicks")
    if order == "mixed":
        random.Random(4).shuffle(lines)
    parts = [lines[i : i + 61] for i in range(0, len(lines), 61)]
    write_files(tmp_path / order, parts[::-1] if order == "backward" else parts)
    source = str(tmp_path / order)
    archive = SessionArchive(str(tmp_path / "archive"), buckets=5)
    archive.start(stream.click_stream(spark, source, files_per_batch=1), str(tmp_path / "progress")).awaitTermination()
    assert rows(archive.sessions(spark).drop("closed")) == rows(batch_sessions(spark, source))
    late = archive.late_events(spark).count()
    assert late == archive.progress(spark).agg(F.sum("late_count")).first()[0]
    assert late == 0 if order == "forward" else late > 100
    assert archive.progress(spark).agg(F.sum("event_count")).first()[0] == 301
    # The sentinel comes a month later, so all other sessions are closed and its own is open.
    assert [r["visitor_id"] for r in archive.sessions(spark).where("not closed").collect()] == ["sentinel"]


def test_a_repeated_batch_counts_once(spark, tmp_path, rows):
    click_files(tmp_path / "clicks", files=3)
    source = str(tmp_path / "clicks")
    events = [job_clicks(read_click_lines(spark, f"{source}/{n}.jsonl")) for n in range(3)]
    archive = SessionArchive(str(tmp_path / "archive"), buckets=3)
    for number, batch in enumerate(events):
        archive.merge(batch, number)
        archive.merge(batch, number)
    assert rows(archive.sessions(spark).drop("closed")) == rows(batch_sessions(spark, source))
    assert archive.progress(spark).count() == 3


def test_a_batch_that_fails_leaves_the_sessions_before_it(spark, tmp_path, rows):
    click_files(tmp_path / "clicks", files=2)
    source = str(tmp_path / "clicks")
    first, second = (job_clicks(read_click_lines(spark, f"{source}/{n}.jsonl")) for n in range(2))
    archive = SessionArchive(str(tmp_path / "archive"), buckets=3)
    archive.merge(first, 0)
    before = rows(archive.sessions(spark))
    broken = second.withColumn("item_id", F.when(F.col("event_id") == "end", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("item_id")))
    with pytest.raises(Exception, match="lost"):
        archive.merge(broken, 1)
    assert rows(archive.sessions(spark)) == before
    archive.merge(second, 1)
    assert rows(archive.sessions(spark).drop("closed")) == rows(batch_sessions(spark, source))


def test_events_without_a_time_are_counted_apart(spark, tmp_path):
    write_files(tmp_path / "clicks", [[{"event_id": "1", "visitor_id": "v", "event_type": "view", "event_ts": None}, {"event_id": "2", "event_type": "view"}]])
    archive = SessionArchive(str(tmp_path / "archive"))
    assert archive.sessions(spark).count() == 0
    archive.merge(job_clicks(read_click_lines(spark, str(tmp_path / "clicks"))), 0)
    assert archive.sessions(spark).count() == 0
    assert tuple(archive.progress(spark).first()) == (None, 1, 0, 1, 0)
