"""Streaming jobs and their sinks."""

from viewflow.streaming.jobs import ViewJob, ingest_realtime, jobs_from_settings, run_views, work_dir
from viewflow.streaming.sinks import FileTarget, KafkaTarget, write_view

__all__ = [
    "FileTarget",
    "KafkaTarget",
    "ViewJob",
    "ingest_realtime",
    "jobs_from_settings",
    "run_views",
    "work_dir",
    "write_view",
]
