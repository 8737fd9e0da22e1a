"""Progress and report of a batch run, gathered by the run itself.

The run's counts are metrics of the very write that stores its result: no second scan of the log, no extra
job. While it runs, a watcher asks Spark how many of the job's tasks are done and works out the rate
and the time left.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import PROGRESS_EVERY_S
from .reports import report_columns

REPORT = (
    "total_files long, success long, empty long, errors long, timeouts long, total_pages long, total_chunks long, avg_duration_s double"
)


def observed(run: DataFrame) -> tuple[DataFrame, Observation]:
    """``run`` (status rows, whatever else is on them), with the counts of ``run_report`` taken as it passes by."""
    taken = Observation(f"run-{uuid.uuid4().hex}")
    return run.observe(taken, *report_columns()), taken


def observed_report(spark: SparkSession, taken: Observation) -> DataFrame:
    """The report of a run that has been written: one row, without a job. Waits for the run."""
    found = taken.get
    return spark.createDataFrame([tuple(found[c.split()[0]] for c in REPORT.split(", "))], REPORT)


@dataclass(frozen=True)
class Tick:
    elapsed_s: float
    done: int
    total: int

    @property
    def share(self) -> float:
        return self.done / self.total if self.total else 0.0

    @property
    def eta_s(self) -> float | None:
        """Time left at the rate so far; None while nothing is done."""
        return self.elapsed_s * (self.total - self.done) / self.done if self.done else None


class BatchProgress:
    """Watches the jobs started inside a ``with`` block.

    ``ticks`` are kept, and given to ``show`` as they come. Tasks of stages that have not been
    planned yet aren't known, so the total can grow while the run goes on.
    """

    def __init__(self, spark: SparkSession, every_s: float = PROGRESS_EVERY_S, show: Callable[[Tick], None] | None = None):
        self.context, self.every_s, self.show = spark.sparkContext, every_s, show
        self.group = f"watched-{uuid.uuid4().hex}"
        self.ticks: list[Tick] = []
        self._seen: dict[int, tuple[int, int]] = {}
        self._stop = threading.Event()

    def __enter__(self) -> BatchProgress:
        self._began = time.monotonic()
        self.context.setJobGroup(self.group, "watched run")
        self._thread = threading.Thread(target=self._watch, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join()
        for key in ("spark.jobGroup.id", "spark.job.description"):
            self.context.setLocalProperty(key, None)
        self._tick()

    def _watch(self) -> None:
        while not self._stop.wait(self.every_s):
            self._tick()

    def _tick(self) -> None:
        tracker = self.context.statusTracker()
        for job in tracker.getJobIdsForGroup(self.group):
            info = tracker.getJobInfo(job)
            for stage in info.stageIds if info else ():
                found = tracker.getStageInfo(stage)
                if found:
                    self._seen[stage] = (found.numCompletedTasks, found.numTasks)
        done, total = (sum(x[i] for x in self._seen.values()) for i in (0, 1))
        tick = Tick(time.monotonic() - self._began, done, total)
        self.ticks.append(tick)
        if self.show:
            self.show(tick)


def progress_line(tick: Tick) -> str:
    left = "?" if tick.eta_s is None else f"{tick.eta_s / 60:.1f}"
    return f"{tick.done}/{tick.total} tasks ({100 * tick.share:.0f} %), {left} min left"


def duration_sketches(log: DataFrame, keys: list[str], duration: str = "duration_s") -> DataFrame:
    """Mergeable KLL sketches of durations, one row a group: (keys, n, sketch)."""
    known = log.where(F.col(duration).isNotNull())
    return known.groupBy(*keys).agg(F.count("*").alias("n"), F.expr(f"kll_sketch_agg_double({duration}, 400)").alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Quantiles over any union of groups, from their sketches alone: (keys, n, p50, p95)."""
    grouped = sketches.groupBy(*keys) if keys else sketches.groupBy()
    merged = grouped.agg(F.sum("n").alias("n"), F.expr("kll_merge_agg_double(sketch)").alias("sketch"))
    at = [F.expr(f"kll_sketch_get_quantile_double(sketch, {q}D)").alias(f"p{round(100 * q)}") for q in shares]
    return merged.where("n > 0").select(*keys, "n", *at)
