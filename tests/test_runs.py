"""Answers that are asked for once, across failures; counters, progress and cancelling of runs."""

import os
import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quire.operators import page_files
from quire.plans import answer_log as A
from quire.plans import page_steps
from quire.plans.runs import Run
from quire.sources import store

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def requests(spark, n, partitions=3):
    return spark.range(n, numPartitions=partitions).selectExpr("'B' as book_name", "concat(id, '.jpg') as file", "cast(id as string) as prompt")


def counting(folder, fails=lambda p: False, dies=lambda p: False):
    def call(prompt):
        if dies(prompt):
            os._exit(1)
        with open(f"{folder}/{prompt}", "a") as f:
            f.write("x")
        if fails(prompt):
            raise RuntimeError("unauthorized")
        return f"answer {prompt}"

    return call


def calls(folder):
    return {p: len(open(f"{folder}/{p}").read()) for p in os.listdir(folder)}


@pytest.fixture
def seen(tmp_path):
    at = tmp_path / "seen"
    at.mkdir()
    return str(at)


def test_a_result_that_is_used_twice_is_asked_for_once(spark, tmp_path, seen):
    log = str(tmp_path / "log")
    found = A.answered(requests(spark, 25), counting(seen, fails=lambda p: p == "7"), log, "text", pause=0.0)
    one, two = sorted(map(tuple, found.collect())), sorted(map(tuple, found.collect()))
    assert one == two and len(one) == 25 and {r[3:] for r in one if r[2] == "7"} == {(None, "unauthorized")}
    assert calls(seen) == {str(i): 1 for i in range(25)}
    A.answered(requests(spark, 27), counting(seen), log, "text", pause=0.0)
    assert calls(seen) == {str(i): 2 if i == 7 else 1 for i in range(27)}  # an answer in place of the error, and two new ones
    assert {(r.step, r.answered, r.failed, r.asked) for r in A.step_counts(spark, log).collect()} == {("text", 27, 0, 28)}
    A.answered(requests(spark, 2), counting(seen), log, "other", pause=0.0)
    assert calls(seen)["0"] == 2  # another step


def test_calls_across_a_failure(spark, tmp_path, seen):
    """The run dies in the middle: batches before that are kept, and the next run asks for the others; one batch a task at most is asked for again."""
    log, marker = str(tmp_path / "log"), tmp_path / "die"
    marker.write_text("")
    die = lambda p: marker.exists() and p == "57"
    wanted = requests(spark, 100, 1)
    with pytest.raises(Exception):
        A.answered(wanted, counting(seen, dies=die), log, "text", pause=0.0)
    kept = {r.file for r in A.entries(spark, log).collect()}
    assert 0 < len(kept) < 100 and all(f.split(".")[0] in calls(seen) for f in kept)
    marker.unlink()
    found = {r.file: r.answer for r in A.answered(wanted, counting(seen), log, "text", pause=0.0).collect()}
    assert found == {f"{i}.jpg": f"answer {i}" for i in range(100)}
    twice = [p for p, n in calls(seen).items() if n > 1]
    assert all(n <= 2 for n in calls(seen).values()) and not {f"{p}.jpg" for p in twice} & kept and len(twice) <= 4 * A.BATCH
    assert A.entries(spark, log).count() == 100


def test_a_task_that_is_tried_again_finds_its_batches(spark, tmp_path, seen):
    log = str(tmp_path / "log")
    assert A.ask(requests(spark, 12, 1), counting(seen), log, "text", pause=0.0) == 12
    names = sorted(os.listdir(f"{log}/answers/text"))
    os.rename(f"{log}/answers/text/{names[0]}", f"{log}/hidden")
    assert A.ask(requests(spark, 12, 1), counting(seen), log, "text", pause=0.0) in (2, 10)
    assert A.entries(spark, log).count() == 12 and not os.listdir(f"{log}/_staging")


def test_steps_with_a_log(spark, tmp_path, seen):
    images = spark.createDataFrame([("B", f"{i}.jpg", bytes([65 + i])) for i in range(4)], "book_name string, file string, content binary")
    read = counting(seen)
    texts = page_steps.page_texts(images, lambda p: read(p.strip("=")), 0.0, str(tmp_path / "log"))
    assert texts.count() == 4 and texts.filter("error is null").count() == 4 and set(calls(seen).values()) == {1}
    asked = texts.select("book_name", "file", F.explode(F.array(F.lit(1), F.lit(2))).alias("image_no"), F.lit("c").alias("caption"), F.col("text").alias("context"))
    told = page_steps.descriptions(asked, "task", lambda p: f"d {len(p)}", 0.0, str(tmp_path / "log"))
    assert told.count() == 8 and told.filter("description is not null").count() == 8
    assert A.entries(spark, str(tmp_path / "log"), f"{A.KEY}, image_no int").filter("step = 'description'").count() == 8


def test_counters_of_a_run_equal_its_counts(spark, tmp_path):
    rows = spark.range(50).select("id", F.when(F.col("id") % 7 == 0, "bad").alias("error"), (F.col("id") * 2).alias("tokens"))
    with Run(spark, "count") as run:
        run.counted(rows, tokens=F.sum("tokens")).write.parquet(str(tmp_path / "out"))
    counted = page_files.run_counts(spark.read.parquet(str(tmp_path / "out"))).first()
    assert run.counters() == {"rows": {"successes": counted.successes, "errors": counted.errors, "tokens": 2450}}
    done, total = run.progress()
    assert done == total > 0


@pytest.mark.parametrize("to", ["table", "store"])
def test_a_cancelled_run_leaves_whole_files_only(spark, tmp_path, to):
    def slow(frames):
        for f in frames:
            time.sleep(0.4)
            yield f.assign(content=[b"x"] * len(f))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    out, run, failed = str(tmp_path / "out"), Run(spark, "slow"), []
    rows = spark.range(400, numPartitions=8).selectExpr("concat('B/md/', id, '.md') as path").mapInPandas(slow, "path string, content binary")

    def work():
        try:
            with run:
                store.write(rows, out) if to == "store" else rows.write.parquet(out)
        except Exception as e:
            failed.append(e)

    thread = threading.Thread(target=work, daemon=True)
    try:
        thread.start()
        deadline = time.time() + 60
        while run.progress()[1] == 0 and thread.is_alive() and time.time() < deadline:
            time.sleep(0.1)
        time.sleep(1.5)
        run.cancel()
        thread.join(60)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert not thread.is_alive() and failed
    if to == "store":
        assert store.listing(spark, out).count() == 0
    else:
        assert not os.path.exists(f"{out}/_SUCCESS") and not [f for f in (os.listdir(out) if os.path.exists(out) else []) if f.startswith("part")]
    with pytest.raises(InterruptedError):
        run.check()
    assert spark.range(3).count() == 3  # other jobs go on
