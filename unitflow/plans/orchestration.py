"""Tasks in dependency order, with retries, skipping and a record of each run. Driver-side only."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

OK, FAILED, SKIPPED = "ok", "failed", "skipped"


@dataclass(frozen=True)
class Task:
    name: str
    fn: Callable[[dict], dict | None]
    needs: tuple[str, ...] = ()
    retries: int = 0
    backoff: float = 0.0


@dataclass
class TaskRun:
    name: str
    status: str
    seconds: float
    attempts: int
    error: str = ""


@dataclass
class RunResult:
    runs: list[TaskRun] = field(default_factory=list)
    context: dict = field(default_factory=dict)

    @property
    def failed_task(self) -> str | None:
        return next((r.name for r in self.runs if r.status == FAILED), None)

    def timing_table(self) -> str:
        return "\n".join(f"{r.name:<16} {r.status:<8} {r.seconds:8.2f} s  {r.attempts}" for r in self.runs)


def toposort(tasks: list[Task]) -> list[Task]:
    """Stable in the order of declaration; unknown needs and cycles are errors before anything runs."""
    by_name = {t.name: t for t in tasks}
    if len(by_name) != len(tasks):
        raise ValueError("two tasks have one name")
    for t in tasks:
        if unknown := [n for n in t.needs if n not in by_name]:
            raise ValueError(f"{t.name} needs {', '.join(unknown)}, which is no task")
    done: list[Task] = []
    names: set[str] = set()
    while len(done) < len(tasks):
        ready = next((t for t in tasks if t.name not in names and names.issuperset(t.needs)), None)
        if ready is None:
            raise ValueError(f"a cycle among {', '.join(t.name for t in tasks if t.name not in names)}")
        done.append(ready)
        names.add(ready.name)
    return done


class Orchestrator:
    def __init__(self, tasks: list[Task], spark=None, events: Path | None = None, sleep: Callable[[float], None] = time.sleep):
        self.tasks, self.spark, self.events, self.sleep = toposort(tasks), spark, events, sleep

    def attempt(self, task: Task, context: dict) -> tuple[TaskRun, dict]:
        began = time.monotonic()
        for n in range(1, task.retries + 2):
            try:
                if self.spark is not None:
                    self.spark.sparkContext.setJobGroup(task.name, task.name)
                return TaskRun(task.name, OK, time.monotonic() - began, n), task.fn(context) or {}
            except Exception as e:  # the record keeps it; dependents are skipped
                error = f"{type(e).__name__}: {e}"
                if n <= task.retries:
                    self.sleep(task.backoff * 2 ** (n - 1))
        return TaskRun(task.name, FAILED, time.monotonic() - began, task.retries + 1, error[:2000]), {}

    def run(self, context: dict | None = None) -> RunResult:
        out = RunResult(context=dict(context or {}))
        bad: set[str] = set()
        for t in self.tasks:
            if bad.intersection(t.needs):
                run = TaskRun(t.name, SKIPPED, 0.0, 0)
            else:
                run, more = self.attempt(t, out.context)
                out.context.update(more)
            if run.status != OK:
                bad.add(t.name)
            out.runs.append(run)
            if self.events:
                with self.events.open("a") as f:
                    f.write(json.dumps(asdict(run)) + "\n")
        return out
