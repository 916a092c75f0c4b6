"""A guard over a set of questions: each runs as jobs of its own, with a time limit, and failures are rows."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Question = Callable[[], DataFrame]
SCHEMA = "question string, status string, detail string"


class _Run:
    """One question: its thread, its job group, and what came of it."""

    def __init__(self, spark: SparkSession, name: str, question: Question, gate: threading.Semaphore):
        self.spark, self.name, self.question, self.gate = spark, name, question, gate
        self.group = f"question-{name}-{uuid.uuid4().hex}"
        self.started: float | None = None
        self.status, self.detail = "timeout", None
        self.done, self.lock = threading.Event(), threading.Lock()
        self.thread = threading.Thread(target=inheritable_thread_target(spark)(self._work), daemon=True)

    def _end(self, status: str, detail: str | None) -> bool:
        """The first end counts; it also frees the question's place."""
        with self.lock:
            if self.done.is_set():
                return False
            self.status, self.detail = status, detail
            self.done.set()
        self.gate.release()
        return True

    def _work(self) -> None:
        self.gate.acquire()
        self.started = time.monotonic()
        self.spark.sparkContext.setJobGroup(self.group, self.name, interruptOnCancel=True)
        try:
            self._end("rows" if self.question().take(1) else "empty", None)
        except Exception as problem:  # noqa: BLE001  (a failing question is a finding, not the end of the guard)
            self._end("error", f"{type(problem).__name__}: {problem}".splitlines()[0][:200])

    def stop(self) -> None:
        """End it as timed out; its running and later jobs are cancelled."""
        if self._end("timeout", None):
            self.spark.sparkContext._jsc.sc().cancelJobGroupAndFutureJobs(self.group)


def run_questions(spark: SparkSession, questions: Mapping[str, Question], seconds: float, at_once: int = 4) -> DataFrame:
    """One row (question, status, detail) for each question, in their order.

    ``status`` is rows, empty, error (with the first line of the message) or timeout.  ``at_once`` questions run together, each in
    its own job group; the limit counts from a question's own start.  A question over the limit is cancelled, and one that hangs
    outside Spark is left behind and holds no place.  Only one row of an answer is asked for.
    """
    gate = threading.Semaphore(at_once)
    runs = [_Run(spark, name, question, gate) for name, question in questions.items()]
    for run in runs:
        run.thread.start()
    while not all(run.done.is_set() for run in runs):
        now = time.monotonic()
        for run in runs:
            if run.started is not None and not run.done.is_set() and now - run.started > seconds:
                run.stop()
        time.sleep(0.05)
    return spark.createDataFrame([(run.name, run.status, run.detail) for run in runs], SCHEMA)
