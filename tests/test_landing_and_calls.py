"""Landing tables that are fetched once, and streams of calls with failures and restarts."""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

import pytest
from pyspark import cloudpickle

from quillwork.sources import landing
from quillwork.streaming import calls

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import test modules


def counted(folder: Path, name: str) -> None:
    """Leave a mark for a call, also from a worker."""
    (folder / f"{name}-{time.time_ns()}").touch()


def marks(folder: Path) -> list[str]:
    return sorted(p.name.rsplit("-", 1)[0] for p in folder.iterdir())


def test_objects_are_fetched_once(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "table")
    log.mkdir()

    def fetch(i):
        counted(log, i)
        if i == "bad":
            raise OSError("down")
        return None if i == "gone" else json.dumps({"id": i})

    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id string")
    first = landing.land(spark, ids("a", "b", "gone", "a", None), path, fetch)
    assert {r.id: r.content for r in first.collect()} == {"a": '{"id": "a"}', "b": '{"id": "b"}', "gone": None}
    assert landing.land(spark, ids("a", "gone", "c"), path, fetch).count() == 3 and marks(log) == ["a", "b", "c", "gone"]
    with pytest.raises(Exception, match="down"):
        landing.land(spark, ids("bad", "d", "e"), path, fetch, partitions=1)
    assert spark.read.parquet(path).count() == 4, "a broken run leaves nothing"
    assert landing.land(spark, ids("d", "e", "f", "a"), path, fetch, limit=2).count() == 3 and spark.read.parquet(path).count() == 6


def test_listings(spark):
    documents = {"u/1": '{"objectIDs": [1, 2]}', "u/2": '{"objectIDs": [2, 3]}', "u/3": '{"objectIDs": null}', "u/4": None}
    listings = spark.createDataFrame([("x", "u/1"), ("y", "u/2"), ("z", "u/3"), ("w", "u/4")], "listing string, url string")
    assert sorted(map(tuple, landing.enumerated(listings, documents.get).collect())) == [("x", "1"), ("x|y", "2"), ("y", "3")]


def test_harvest_ends_for_a_reason_and_goes_on_after_an_error(spark, tmp_path):
    down = tmp_path / "down"
    down.touch()
    log = tmp_path / "log"
    log.mkdir()

    def fetch(s, token):
        counted(log, s + token)
        if s == "broken" and token == "2" and down.exists():
            raise OSError("down")
        if s == "gone":
            return None
        k = int(token or 0)
        last = {"three": 2, "broken": 3, "long": 99, "empty": 0}[s]
        return json.dumps({"n": 0 if s == "empty" else 10, "next": str(k + 1) if k < last else ""})

    sets = spark.createDataFrame([(s,) for s in ("three", "broken", "long", "empty", "gone", "three")], "set string")
    go = lambda: {r.set: (r.pages, r.records, r.reason) for r in landing.harvest(spark, sets, str(tmp_path / "pages"), fetch, lambda c: json.loads(c)["next"], lambda c: json.loads(c)["n"], limit=45).collect()}
    want = {"three": (3, 30, "no token"), "broken": (2, 20, "error: OSError: down"), "long": (5, 50, "limit"), "empty": (1, 0, "no records"), "gone": (0, 0, "gone")}
    assert go() == want
    down.unlink()
    before = marks(log)
    assert go() == want | {"broken": (4, 40, "no token")}
    assert len(marks(log)) == len(before) + 2, "only the page that failed and those behind it are asked for"


def test_calls_keep_one_schedule(spark):
    """40 calls at 20 a second over 4 tasks: never more than the rate in any half second, and no slower than that."""
    requests = spark.createDataFrame([(i, "p") for i in range(40)], "key int, prompt string")
    rows = calls.scheduled_calls(requests, lambda p: ("x", 1), per_minute=1200, tasks=4, stamp=True).collect()
    at = sorted(r.called for r in rows)
    assert len(rows) == 40 and all(r.ok for r in rows)
    assert at[-1] - at[0] < 10 and max(sum(a <= b < a + 0.5 for b in at) for a in at[-12:]) <= 13


def test_stream_of_calls_with_failures_and_a_restart(spark, tmp_path):
    log, source, path, checkpoint = tmp_path / "log", tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    log.mkdir()
    source.mkdir()
    crash = tmp_path / "crash"

    def provider(prompt):
        counted(log, prompt)
        if prompt == "flaky" and sum(m == "flaky" for m in marks(log)) < 2:
            raise OSError("busy")
        if prompt == "never":
            raise ValueError("no")
        return prompt.upper(), len(prompt)

    def put(name, *rows):
        (source / f"{name}.json").write_text("\n".join(json.dumps({"key": k, "prompt": p}) for k, p in rows))

    def go(with_provider=provider):
        stream = spark.readStream.schema("key string, prompt string").option("maxFilesPerTrigger", 1).json(str(source))
        calls.answer_stream(stream, path, checkpoint, with_provider, per_minute=60_000, tasks=2, pause=0.01).awaitTermination()

    put("1", ("a", "one"), ("a", "one"), ("b", "flaky"), ("c", "never"), (None, "null"))
    go()
    put("2", ("a", "one"), ("d", "four"), ("c", "never"))
    crash.touch()

    def dying(prompt):
        if prompt == "four" and crash.exists():
            raise SystemExit(1)  # the worker dies, and the batch with it
        return provider(prompt)

    with pytest.raises(Exception):
        go(dying)
    assert {r.key for r in calls.successes(spark, path).collect()} == {"a", "b"}
    crash.unlink()
    go(dying)
    assert {r.key: (r.answer, r.tokens) for r in calls.successes(spark, path).collect()} == {"a": ("ONE", 3), "b": ("FLAKY", 5), "d": ("FOUR", 4)}
    assert sorted(map(tuple, calls.totals(spark, path).collect())) == [(0, 3, 2, 8), (1, 2, 1, 4)]
    assert marks(log).count("one") == 1 and marks(log).count("flaky") == 2
    before = len(marks(log))
    calls.answer_batch(spark.createDataFrame([("d", "four")], "key string, prompt string"), 1, path, provider, tasks=1)
    assert sorted(map(tuple, calls.totals(spark, path).collect())) == [(0, 3, 2, 8), (1, 1, 1, 4)] and len(marks(log)) == before + 1
