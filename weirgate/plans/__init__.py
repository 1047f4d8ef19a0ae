"""Tasks end to end: source, shaping, targets and audits."""

from weirgate.plans.task import TaskResult, run_stream_task, run_task, run_tasks

__all__ = ["TaskResult", "run_stream_task", "run_task", "run_tasks"]
