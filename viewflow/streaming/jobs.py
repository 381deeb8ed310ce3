"""Jobs: many views over shared topics in one query, and the ingest of a realtime table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from viewflow.functions.text import register_sql_functions
from viewflow.operators.enrich import Context
from viewflow.operators.ingest import ingest_rollup, prepare
from viewflow.operators.tables import TablePair, append_batch, first_batch, first_file
from viewflow.operators.views import View, apply_view
from viewflow.sources.codecs import decode_value
from viewflow.sources.topics import (
    SourceSet,
    check_topics,
    ingest_codec,
    ingest_source,
    ingest_topic,
    ingest_trigger,
    start_offset,
    topic_source,
)
from viewflow.spec import SpecError, flatten
from viewflow.streaming.sinks import Target, write_view

# One pass over everything there is, then stop.
AVAILABLE_NOW = {"availableNow": True}


_made: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """A new folder under the shared one the cluster names, or else below the warehouse, which is shared too.

    ``clean_up`` deletes it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = (shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")
    _made.append(f"{base}/viewflow-{uuid.uuid4().hex}")
    return _made[-1]


def clean_up(spark: SparkSession) -> None:
    """Drop the databases that lie in this process's work folders, then delete the folders."""
    for row in spark.sql("SHOW DATABASES LIKE 'viewflow_*'").collect():
        place = spark.catalog.getDatabase(row[0]).locationUri
        if any(folder.split(":", 1)[-1] in place for folder in _made):
            spark.sql(f"DROP DATABASE IF EXISTS {row[0]} CASCADE")
    jvm = spark.sparkContext._jvm
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class ViewJob:
    """A view, the topics it reads, how their values are decoded, and where its output goes.

    ``settings`` are the view's own section; it finds them in its context's ``config``.
    """

    view: View
    inputs: Sequence[str]
    target: Target
    input_schema: T.StructType | str | None = None
    codec: str = "struct"
    settings: Mapping[str, Any] = field(default_factory=dict)


def check_jobs(jobs: Iterable[ViewJob]) -> list[ViewJob]:
    jobs = list(jobs)
    if not jobs:
        raise SpecError("no views to run")
    for job in jobs:
        check_topics(job.inputs)
    for what, names in (
        ("view", [job.view.name for job in jobs]),
        ("output", [job.target.name for job in jobs]),
    ):
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise SpecError(f"{what} used twice: {', '.join(twice)}")
    return jobs


def job_output(
    records: DataFrame, job: ViewJob, context: Context | None = None, decoded: bool = False
) -> DataFrame:
    """One view's output from the tagged records of all topics."""
    mine = records.where(F.col("topic").isin(list(job.inputs)))
    if not decoded:
        mine = decode_value(mine, job.input_schema, job.codec)
    context = context or Context()
    return apply_view(mine, job.view, replace(context, config={**context.config, **job.settings}))


def _write_all(
    jobs: Sequence[ViewJob], write: Callable[[ViewJob], None], spark: SparkSession, parallel: int
) -> None:
    # The first alone: it fills the cache that the others then find full.
    write(jobs[0])
    jobs = jobs[1:]
    if len(jobs) < 2 or parallel == 1:
        for job in jobs:
            write(job)
        return
    # The threads carry the query's job group, so that stopping the query stops their jobs.
    with ThreadPoolExecutor(min(parallel, len(jobs))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write), job) for job in jobs]
    for one in started:
        one.result()


def jobs_from_settings(
    settings: Mapping,
    views: Mapping[str, View],
    target: Callable[[str], Target],
    input_schema: T.StructType | str | None = None,
    codec: str = "struct",
) -> list[ViewJob]:
    """Jobs from settings: a list ``view.generators`` and, under each name, ``input.topics`` and
    ``output.topic``; or, without the list, these two for the one view given.

    ``target`` makes a target of an output topic's name. A view's section, by dotted names, goes to the view.
    """
    if "view.generators" in flatten(settings):
        sections = {name: settings.get(name) for name in flatten(settings)["view.generators"]}
    elif len(views) == 1:
        sections = {name: settings for name in views}
    else:
        raise SpecError("settings for several views need the list view.generators")
    jobs = []
    for name, section in sections.items():
        if name not in views or section is None:
            raise SpecError(f"view {name!r} has no settings or no View object")
        own = flatten(section)
        missing = [key for key in ("input.topics", "output.topic") if key not in own]
        if missing:
            raise SpecError(f"view {name!r}: missing {', '.join(missing)}")
        jobs.append(ViewJob(views[name], own["input.topics"], target(own["output.topic"]), input_schema, codec, own))
    return check_jobs(jobs)


def run_views(
    jobs: Iterable[ViewJob],
    sources: SourceSet,
    checkpoint: str,
    context: Context | None = None,
    trigger: Mapping | None = None,
    parallel: int = 4,
) -> StreamingQuery:
    """Start one query that reads each topic once and feeds every view.

    All topics have the same raw schema. A view sees only the topics it lists; up to ``parallel``
    views of a batch are written at a time. A view that fails stops the query; the batch is then run
    again for all views, and targets replace what they have.
    """
    jobs = check_jobs(jobs)
    topics = list(dict.fromkeys(name for job in jobs for name in job.inputs))
    stream = sources.merged(topics)
    # Views that decode alike share the decoded values.
    alike = all((job.input_schema, job.codec) == (jobs[0].input_schema, jobs[0].codec) for job in jobs)
    if alike:
        stream = decode_value(stream, jobs[0].input_schema, jobs[0].codec)
    lookups = context.lookups.values() if context else ()
    if len(jobs) == 1 and not lookups:
        # One view that needs no batch: the scan reads its columns only.
        return write_view(job_output(stream, jobs[0], context, decoded=alike), jobs[0].target, checkpoint, trigger)
    # A batch is read more than once by several views, and by the count of hot keys before a salted join.
    shared = len(jobs) > 1 or not all(lookup.small for lookup in lookups)

    def step(batch: DataFrame, batch_id: int) -> None:
        if shared:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        now = context.measured() if context else None

        def write(job: ViewJob) -> None:
            job.target.write(job_output(batch, job, now, decoded=alike), batch_id)

        try:
            _write_all(jobs, write, batch.sparkSession, parallel)
        finally:
            if shared:
                batch.unpersist()

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .foreachBatch(step)
        .start()
    )


def ingest_realtime(
    spark: SparkSession,
    pair: TablePair,
    checkpoint: str,
    records: DataFrame | None = None,
    trigger: Mapping | None = None,
    files: int | None = None,
    folder: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start the query that fills the realtime table of a created pair.

    Reads the topic of the stream settings, or ``records`` (key, value) given instead, or the topic as files in
    ``folder``. The settings' start offset holds for a folder too: from ``largest`` on, a new checkpoint reads only files
    newer than those there at its start. Filtering and
    shaping happen before the batch is handed over, so the scan reads the needed columns only. With
    ``aggregate_metrics`` each batch is rolled up; sums over the table are the same as without.
    """
    register_sql_functions(spark)
    spec = pair.realtime_spec
    codec = "struct"
    if folder is not None:
        topic = ingest_topic(spec, folder, fmt)
        if start_offset(spec) == "latest":
            topic = replace(topic, after=first_file(spark, pair, checkpoint, folder))
        records = topic_source(spark, topic)
    if records is None:
        codec = ingest_codec(spec)
        if codec == "struct":
            raise SpecError(f"table {spec.table_name}: the stream settings name no decoder")
        records = ingest_source(spark, spec)
    schema = spec.stream.get("stream.kafka.decoder.prop.schema", spec.schema)
    rows = prepare(decode_value(records, schema, codec).select("value.*"), spec)
    first = first_batch(spark, pair, checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        if spec.aggregate_metrics:
            batch = ingest_rollup(batch, spec)
        append_batch(batch, pair, first + batch_id, files)

    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ingest_trigger(spec)))
        .foreachBatch(step)
        .start()
    )
