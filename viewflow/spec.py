"""View and table specs: dataclasses built from plain dicts. Nothing here starts a Spark job."""

from __future__ import annotations

import copy
import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import types as T

log = logging.getLogger("viewflow")

# Setting names of a table spec that shape data, and those without a meaning for Spark.
REQUIRED_SETTINGS = (
    "tableName",
    "dimensionColumns",
    "metricColumns",
    "timeUnit",
    "timeColumn",
    "retentionTimeValue",
    "retentionTimeUnit",
)
OPTIONAL_SETTINGS = (
    "dateTimeColumns",
    "sortedColumn",
    "starTreeIndexConfigs",
    "segmentPartitionConfig",
    "noDictionaryColumns",
    "bloomFilterColumns",
    "rangeIndexColumns",
    "columnsMaxLength",
    "aggregateMetrics",
    "streamConfigs",
    "tierConfigs",
    "taskConfigs",
    "transformConfigs",
    "filterConfig",
    "stringDefault",
    "emptyAsNull",
)

# Time unit name -> nanoseconds.
UNIT_NANOS = {
    "NANOSECONDS": 1,
    "MICROSECONDS": 1_000,
    "MILLISECONDS": 1_000_000,
    "SECONDS": 1_000_000_000,
    "MINUTES": 60_000_000_000,
    "HOURS": 3_600_000_000_000,
    "DAYS": 86_400_000_000_000,
}

_PERIOD_LETTER = {"d": "DAYS", "h": "HOURS", "m": "MINUTES", "s": "SECONDS"}


class SpecError(ValueError):
    """A spec that cannot be built or does not fit its schema."""


def deep_merge(base: Mapping, override: Mapping) -> dict:
    """``override`` laid over ``base``: dicts merge, everything else (lists too) is replaced."""
    merged = dict(base)
    for name, value in override.items():
        both_maps = isinstance(value, Mapping) and isinstance(merged.get(name), Mapping)
        merged[name] = deep_merge(merged[name], value) if both_maps else value
    return merged


def nest(settings: Mapping) -> dict:
    """Turn dotted names (``view.name``) into nested dicts."""
    out: dict = {}
    for name, value in settings.items():
        value = nest(value) if isinstance(value, Mapping) else value
        for part in reversed(str(name).split(".")):
            value = {part: value}
        out = deep_merge(out, value)
    return out


def flatten(settings: Mapping, prefix: str = "") -> dict[str, Any]:
    """Turn nested dicts back into dotted names."""
    flat: dict[str, Any] = {}
    for name, value in settings.items():
        if isinstance(value, Mapping):
            flat.update(flatten(value, f"{prefix}{name}."))
        else:
            flat[prefix + str(name)] = value
    return flat


def period_nanos(period: str) -> int:
    """Length of a period such as ``6h``, ``5d`` or ``12 hours``."""
    match = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", str(period))
    if match:
        amount, name = int(match[1]), match[2]
        unit = _PERIOD_LETTER.get(name) or name.upper().rstrip("S") + "S"
        if unit in UNIT_NANOS:
            return amount * UNIT_NANOS[unit]
    raise SpecError(f"not a period: {period!r}")


def period_in(period: str, unit: str) -> int:
    """Length of a period counted in ``unit``; it must be a whole number of them."""
    nanos, size = period_nanos(period), UNIT_NANOS[unit]
    if nanos % size:
        raise SpecError(f"period {period!r} is not a whole number of {unit}")
    return nanos // size


def epoch_in(moment: datetime | str | int, unit: str) -> int:
    """A moment as an epoch number in ``unit``; ints are already in ``unit``, naive times are UTC."""
    if isinstance(moment, int):
        return moment
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    since = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds
    return micros * 1_000 // UNIT_NANOS[unit]


def column(name: str, data_type: T.DataType, default: Any = None, nullable: bool = True) -> T.StructField:
    """A schema field; ``default`` stands in for null when rows are shaped for a table."""
    meta = {} if default is None or default == [] or default == {} else {"default": default}
    return T.StructField(name, data_type, nullable, meta)


def field_default(spec_field: T.StructField) -> Any:
    return spec_field.metadata.get("default")


def _as_schema(value: Any) -> T.StructType:
    if isinstance(value, T.StructType):
        return value
    if isinstance(value, Mapping):
        return T.StructType.fromJson(dict(value))
    if isinstance(value, str):
        return T.StructType.fromDDL(value)
    raise SpecError(f"cannot read a schema from {type(value).__name__}")


@dataclass(frozen=True)
class ViewSpec:
    """Name, schema and settings of one view."""

    name: str
    schema: T.StructType
    config: dict = field(default_factory=dict, compare=False)

    @classmethod
    def parse(cls, config: Mapping) -> ViewSpec:
        """Read ``view.name`` and ``view.output.schema`` (StructType, its JSON dict, or a DDL string)."""
        # A StructType is not a Mapping, so ``nest`` leaves it whole.
        settings = nest(config)
        view = settings.get("view", {})
        if not view.get("name"):
            raise SpecError("view.name is missing")
        schema = view.get("output", {}).get("schema")
        if schema is None:
            raise SpecError("view.output.schema is missing")
        return cls(view["name"], _as_schema(schema), settings)

    def realtime(self, common: str = "table", override: str = "realtime") -> TableSpec:
        """Spec of the realtime table: the ``realtime`` settings over the common ones."""
        spec = self._table(common, override)
        stream = flatten(spec.stream)
        decoder = str(stream.get("stream.kafka.decoder.class.name", ""))
        # The plain Avro decoder needs a schema; without one it takes the view's own.
        if decoder.endswith("SimpleAvroMessageDecoder"):
            stream.setdefault("stream.kafka.decoder.prop.schema", self.schema)
        spec.stream = stream
        return spec

    def offline(self, common: str = "table", override: str = "offline") -> TableSpec:
        """Spec of the offline table: the ``offline`` settings over the common ones."""
        return self._table(common, override)

    def _table(self, common: str, override: str) -> TableSpec:
        if common not in self.config:
            raise SpecError(f"settings section {common!r} is missing")
        merged = deep_merge(self.config[common], self.config.get(override, {}))
        return TableSpec.from_settings(merged, self.schema)


@dataclass(frozen=True)
class StarTree:
    """A pre-aggregation: ordered dimensions, the ones never starred, and FUNC__column pairs."""

    dims: tuple[str, ...]
    pairs: tuple[str, ...]
    no_star: tuple[str, ...] = ()
    #: A stored cube keeps no starred group of at most so many records.
    leaf_records: int = 0

    def __post_init__(self) -> None:
        unknown = set(self.no_star) - set(self.dims)
        if unknown:
            raise SpecError(f"unstarred columns are not dimensions: {sorted(unknown)}")

    @classmethod
    def from_settings(cls, settings: Mapping) -> StarTree:
        return cls(
            tuple(settings["dimensionsSplitOrder"]),
            tuple(settings["functionColumnPairs"]),
            tuple(settings["skipStarNodeCreationForDimensions"]),
            int(settings.get("maxLeafRecords", 0)),
        )


@dataclass(frozen=True)
class Tier:
    name: str
    age: str


@dataclass
class TableSpec:
    """Everything about a table that shapes its rows, their layout or their life."""

    table_name: str
    schema: T.StructType
    dimensions: list[str]
    metrics: list[str]
    time_column: str
    time_unit: str
    retention: str
    date_times: list[str] = field(default_factory=list)
    max_lengths: dict[str, int] = field(default_factory=dict)
    sorted_column: str | None = None
    star_trees: list[StarTree] = field(default_factory=list)
    partitions: dict[str, tuple[str, int]] = field(default_factory=dict)
    bloom_columns: list[str] = field(default_factory=list)
    no_dictionary_columns: list[str] = field(default_factory=list)
    range_columns: list[str] = field(default_factory=list)
    aggregate_metrics: bool = False
    stream: dict = field(default_factory=dict)
    tiers: list[Tier] = field(default_factory=list)
    bucket_period: str = "1 day"
    buffer_period: str = "2 days"
    transforms: list[tuple[str, str]] = field(default_factory=list)
    #: An expression, or a list of (column, sign, literal) that must all hold; the list reaches the scan.
    drop_when: str | list | None = None
    keep_when: str | None = None
    string_default: str = "null"
    empty_as_null: bool = False

    def __post_init__(self) -> None:
        if self.time_unit not in UNIT_NANOS:
            raise SpecError(f"unknown time unit {self.time_unit!r}")

    @classmethod
    def from_settings(cls, settings: Mapping, schema: T.StructType) -> TableSpec:
        missing = [name for name in REQUIRED_SETTINGS if settings.get(name) is None]
        if missing:
            raise SpecError(f"missing table settings: {', '.join(missing)}")
        ignored = sorted(set(settings) - set(REQUIRED_SETTINGS) - set(OPTIONAL_SETTINGS))
        if ignored:
            log.info("table %s: settings without effect here: %s", settings["tableName"], ignored)

        partitions = settings.get("segmentPartitionConfig", {}).get("columnPartitionMap", {})
        roll = settings.get("taskConfigs", {}).get("RealtimeToOfflineSegmentsTask", {})
        row_filter = settings.get("filterConfig", {})
        tiers = settings.get("tierConfigs", [])
        for tier in tiers:
            if tier.get("segmentSelectorType", "time") != "time":
                raise SpecError(f"tier {tier['name']!r}: only the time selector is known")
        return cls(
            table_name=settings["tableName"],
            schema=schema,
            dimensions=list(settings["dimensionColumns"]),
            metrics=list(settings["metricColumns"]),
            time_column=settings["timeColumn"],
            time_unit=str(settings["timeUnit"]).upper(),
            retention=f"{settings['retentionTimeValue']} {settings['retentionTimeUnit']}",
            date_times=list(settings.get("dateTimeColumns", [])),
            max_lengths={name: int(n) for name, n in settings.get("columnsMaxLength", {}).items()},
            sorted_column=settings.get("sortedColumn"),
            star_trees=[StarTree.from_settings(tree) for tree in settings.get("starTreeIndexConfigs", [])],
            partitions={
                name: (conf["functionName"], int(conf["numPartitions"])) for name, conf in partitions.items()
            },
            bloom_columns=list(settings.get("bloomFilterColumns", [])),
            no_dictionary_columns=list(settings.get("noDictionaryColumns", [])),
            range_columns=list(settings.get("rangeIndexColumns", [])),
            aggregate_metrics=bool(settings.get("aggregateMetrics", False)),
            stream=copy.copy(settings.get("streamConfigs", {})),
            tiers=[Tier(tier["name"], tier["segmentAge"]) for tier in tiers if tier.get("segmentAge")],
            bucket_period=roll.get("bucketTimePeriod", cls.bucket_period),
            buffer_period=roll.get("bufferTimePeriod", cls.buffer_period),
            transforms=[(t["columnName"], t["transformFunction"]) for t in settings.get("transformConfigs", [])],
            drop_when=row_filter.get("filterFunction"),
            keep_when=row_filter.get("keepWhen"),
            string_default=settings.get("stringDefault", "null"),
            empty_as_null=bool(settings.get("emptyAsNull", False)),
        )

    def period(self, period: str) -> int:
        return period_in(period, self.time_unit)

    def epoch(self, moment: datetime | str | int) -> int:
        return epoch_in(moment, self.time_unit)
