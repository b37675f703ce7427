import os
import time
from collections import Counter

import pytest

from silverlode.operators import annotate, answers


@pytest.fixture
def prompts(spark):
    return lambda n: spark.createDataFrame([(i, 1, f"prompt {i}") for i in range(n)], "batch_id long, batch_size int, prompt string").repartition(3)


def logging_annotator(log, reply="[]", dies_at=None, others=0):
    """Writes a line per prompt answered; may end the process it runs in once, after ``others`` answers are in the log."""

    def answer(asked):
        for prompt in asked:
            if prompt == dies_at and not os.path.exists(f"{log}.died"):
                while len(open(log).readlines()) < others:
                    time.sleep(0.1)
                time.sleep(3)
                open(f"{log}.died", "w").close()
                os._exit(1)
            with open(log, "a") as out:
                out.write(f"{time.time()} {prompt}\n")
        return [reply] * len(asked)

    return answer


def calls(log):
    return Counter(line.split(" ", 1)[1].strip() for line in open(log)) if os.path.exists(log) else Counter()


def test_a_killed_run_pays_no_answer_twice(spark, tmp_path, prompts):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    annotator = logging_annotator(log, dies_at="prompt 7", others=23)
    open(log, "w").close()
    with pytest.raises(Exception):
        answers.ask(prompts(24), annotator, store)
    assert sum(calls(log).values()) == 23 and answers.read_answers(spark, store).count() == 23
    done = answers.ask(prompts(24), annotator, store).collect()
    assert calls(log) == Counter({f"prompt {i}": 1 for i in range(24)})
    assert sorted(r.batch_id for r in done) == list(range(24)) and {(r.response, r.error) for r in done} == {("[]", None)}
    answers.ask(prompts(30), annotator, store, prompts_per_call=4)
    assert set(calls(log).values()) == {1} and len(calls(log)) == 30


def test_equal_prompts_are_asked_once(spark, tmp_path):
    log = str(tmp_path / "log")
    same = spark.createDataFrame([(i, 1, "one text") for i in range(9)], "batch_id long, batch_size int, prompt string")
    assert answers.ask(same, logging_annotator(log), str(tmp_path / "store")).where("response = '[]'").count() == 9
    assert calls(log) == {"one text": 1}


def test_many_jobs(spark, tmp_path, prompts, monkeypatch):
    monkeypatch.setattr(answers, "CALLS_PER_JOB", 3)
    log = str(tmp_path / "log")
    assert answers.ask(prompts(20), logging_annotator(log), str(tmp_path / "store"), prompts_per_call=2).where("response = '[]'").count() == 20
    assert set(calls(log).values()) == {1}


def test_the_rate_holds_over_all_tasks(spark, tmp_path, prompts):
    log = str(tmp_path / "log")
    answers.ask(prompts(40), logging_annotator(log), str(tmp_path / "store"), answers.Pace(calls_per_second=20, slots=8))
    times = sorted(float(line.split()[0]) for line in open(log))
    for i, start in enumerate(times):
        # a window of a second holds the rate, and what every slot may add at its edges
        assert sum(t < start + 1 for t in times[i:]) <= 20 + 8
    assert times[-1] - times[0] >= (40 - 8) / 20 - 0.1


def test_the_bucket_spaces_calls():
    pace = answers.Pace(calls_per_second=20, slots=2)
    at = []
    limited = pace.limited(lambda prompts: at.append(time.monotonic()))
    start = time.monotonic()
    for _ in range(4):
        limited([])
    assert at[0] - start >= 0.09 and all(b - a >= 0.09 for a, b in zip(at, at[1:]))


def test_back_off_then_dead_letter(spark, tmp_path, prompts):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")

    def annotator(asked):
        with open(log, "a") as out:
            out.writelines(f"{time.time()} {prompt}\n" for prompt in asked)
        return [ValueError("no") if prompt == "prompt 1" else "not json" if prompt == "prompt 2" else "[]" for prompt in asked]

    pace = answers.Pace(tries=2, first_wait=0.5)
    first = {r.batch_id: r for r in answers.ask(prompts(4), annotator, store, pace, most_attempts=3, prompts_per_call=4).collect()}
    assert first[1].error == "ValueError: no" and first[2].error == "response is not JSON" and first[0].response == first[3].response == "[]"
    assert calls(log) == {"prompt 0": 1, "prompt 1": 2, "prompt 2": 1, "prompt 3": 1}
    tries = [float(line.split()[0]) for line in open(log) if line.endswith("prompt 1\n")]
    assert tries[1] - tries[0] >= 0.5
    stored = answers.read_answers(spark, store)
    assert answers.dead_letters(prompts(4), stored).count() == 0
    answers.ask(prompts(4), annotator, store, pace, most_attempts=3, prompts_per_call=4)
    answers.ask(prompts(4), annotator, store, pace, most_attempts=3, prompts_per_call=4)
    answers.ask(prompts(4), annotator, store, pace, most_attempts=3, prompts_per_call=4)
    dead = {r.batch_id: (r.attempts, r.error) for r in answers.dead_letters(prompts(4), answers.read_answers(spark, store)).collect()}
    assert dead == {1: (4, "ValueError: no"), 2: (3, "response is not JSON")}
    assert calls(log) == {"prompt 0": 1, "prompt 1": 4, "prompt 2": 3, "prompt 3": 1}


def test_waits_double_up_to_the_longest():
    pace = answers.Pace(first_wait=1, longest_wait=5)
    assert [pace.wait(n) for n in (1, 2, 3, 4, 9)] == [1, 2, 4, 5, 5]


def test_no_prompts(spark, tmp_path, prompts):
    assert answers.ask(prompts(1).limit(0), lambda p: 1 / 0, str(tmp_path / "store")).collect() == []


def test_a_later_answer_replaces_an_error(spark):
    rows = [("r", None, "E: x", 1, "2024-01-01"), ("r", "[]", None, 1, "2024-01-02"), ("s", "junk", None, 1, "2024-01-02"), ("s", None, "E: y", 2, "2024-01-01")]
    stored = spark.createDataFrame(rows, "request string, response string, error string, attempts int, at string")
    state = answers.answer_state(stored.withColumn("answered_at", stored["at"].cast("timestamp")))
    got = {r.request: (r.attempts, r.response, r.error) for r in state.collect()}
    assert got == {"r": (2, "[]", None), "s": (3, None, "response is not JSON")}
    assert annotate.call_annotator(lambda p: 1 / 0, ["a", "b"])[1].args == ("division by zero",)


def test_texts_of_a_written_table_are_not_written_again(spark, tmp_path, prompts, monkeypatch):
    path = str(tmp_path / "prompts")
    prompts(20).write.parquet(path)
    table = spark.read.parquet(path)

    def refused(df, label):
        raise AssertionError(f"{label} written")

    monkeypatch.setattr(answers, "materialize", refused)
    assert set(answers.waiting_requests(table, answers.read_answers(spark, str(tmp_path / "none")), 3).columns) == {"request", "batch_id"}
    done = answers.ask(table, lambda asked: ["[]"] * len(asked), str(tmp_path / "store"), prompts_per_call=7, written=True)
    assert done.where("response = '[]'").count() == 20


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_long_lists_of_requests_are_joined(spark, tmp_path, prompts, monkeypatch, broadcast):
    monkeypatch.setattr(answers, "BROADCAST_REQUESTS", broadcast)
    log = str(tmp_path / "log")
    answers.ask(prompts(20), logging_annotator(log), str(tmp_path / "store"), prompts_per_call=3)
    assert calls(log) == Counter({f"prompt {i}": 1 for i in range(20)})
