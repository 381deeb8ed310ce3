import pytest
from pyspark.sql import types as T

from tests.fixtures import ROW, config
from viewflow.spec import (
    SpecError,
    StarTree,
    TableSpec,
    Tier,
    ViewSpec,
    deep_merge,
    epoch_in,
    flatten,
    nest,
    period_in,
)


def test_all_settings_are_read():
    view = ViewSpec.parse(config())
    assert view.name == "myView" and view.schema == ROW
    spec = view.realtime()
    assert spec.table_name == "rows"
    assert spec.metrics == ["time_taken_millis"]
    assert spec.time_column == "creation_time_millis" and spec.time_unit == "MILLISECONDS"
    assert spec.period(spec.retention) == 3 * 86_400_000
    assert spec.period(spec.bucket_period) == 6 * 3_600_000
    assert spec.period(spec.buffer_period) == 12 * 3_600_000
    assert spec.sorted_column == "tenant_id"
    assert spec.partitions == {"tenant_id": ("HashCode", 4)}
    assert spec.star_trees == [
        StarTree(("tenant_id", "start_time_millis"), ("COUNT__name", "SUM__time_taken_millis"), leaf_records=100)
    ]
    assert spec.tiers == [Tier("old", "5d")]
    assert spec.transforms == [("bucket_start_time_millis", "time_bucket(start_time_millis, 3600000)")]
    assert spec.drop_when == "strcmp(name, 'abcd-1234') = 0"
    assert spec.bloom_columns == ["id_sha"] and spec.no_dictionary_columns == ["properties__VALUES"]
    assert spec.range_columns == ["creation_time_millis", "start_time_millis"]
    assert spec.max_lengths == {"id_sha": 64}
    assert not spec.aggregate_metrics
    assert spec.stream["stream.kafka.topic.name"] == "test-view-events"


def test_offline_overrides_common_settings():
    spec = ViewSpec.parse(config()).offline()
    assert spec.period(spec.retention) == 90 * 86_400_000
    assert spec.sorted_column == "tenant_id" and spec.drop_when is None and spec.stream == {}


def test_own_section_names():
    settings = config()
    settings["store"] = settings.pop("table")
    assert ViewSpec.parse(settings).offline("store", "none").table_name == "rows"
    with pytest.raises(SpecError):
        ViewSpec.parse(settings).offline()


@pytest.mark.parametrize("missing", ["view.name", "view.output.schema"])
def test_view_needs_name_and_schema(missing):
    settings = config()
    del settings[missing]
    with pytest.raises(SpecError, match=missing):
        ViewSpec.parse(settings)


def test_schema_as_text_or_json(spark):
    for schema in ("a STRING, b BIGINT", T.StructType.fromDDL("a STRING, b BIGINT").jsonValue()):
        parsed = ViewSpec.parse({"view": {"name": "v", "output": {"schema": schema}}})
        assert parsed.schema.names == ["a", "b"]


@pytest.mark.parametrize("name", ["tableName", "dimensionColumns", "timeUnit", "retentionTimeValue"])
def test_required_settings(name):
    settings = config()
    del settings["table"][name]
    with pytest.raises(SpecError, match=name):
        ViewSpec.parse(settings).realtime()


def test_settings_without_effect_are_told(caplog):
    with caplog.at_level("INFO", logger="viewflow"):
        ViewSpec.parse(config()).offline()
    assert "numReplicas" in caplog.text


def test_plain_avro_decoder_takes_the_views_schema():
    settings = config()
    stream = settings["realtime"]["streamConfigs"]
    stream["stream.kafka.decoder.class.name"] = "some.where.SimpleAvroMessageDecoder"
    assert ViewSpec.parse(settings).realtime().stream["stream.kafka.decoder.prop.schema"] == ROW
    stream["stream.kafka.decoder.prop.schema"] = "given"
    assert ViewSpec.parse(settings).realtime().stream["stream.kafka.decoder.prop.schema"] == "given"
    stream["stream.kafka.decoder.class.name"] = "some.where.RegistryAvroMessageDecoder"
    del stream["stream.kafka.decoder.prop.schema"]
    assert "stream.kafka.decoder.prop.schema" not in ViewSpec.parse(settings).realtime().stream


def test_merge_and_nesting():
    assert deep_merge({"a": {"x": 1, "l": [1, 2]}}, {"a": {"l": [3]}, "b": 1}) == {"a": {"x": 1, "l": [3]}, "b": 1}
    assert flatten(nest({"a.b.c": 1, "a": {"d": 2}})) == {"a.b.c": 1, "a.d": 2}


def test_periods_and_moments():
    assert period_in("6h", "MILLISECONDS") == period_in("6 hours", "MILLISECONDS") == 21_600_000
    assert period_in("5d", "HOURS") == period_in("5 DAYS", "HOURS") == 120
    with pytest.raises(SpecError):
        period_in("6h", "DAYS")
    with pytest.raises(SpecError):
        period_in("soon", "DAYS")
    assert epoch_in("1970-01-02T00:00:00", "MILLISECONDS") == 86_400_000
    assert epoch_in("1969-12-31T23:59:59.999999", "SECONDS") == -1
    assert epoch_in(12, "DAYS") == 12


def test_unknown_units_and_tiers_raise():
    with pytest.raises(SpecError):
        TableSpec("t", ROW, [], [], "a", "FORTNIGHTS", "1d")
    with pytest.raises(SpecError):
        StarTree(("a",), ("COUNT__a",), ("b",))
    settings = config()
    settings["realtime"]["tierConfigs"][0]["segmentSelectorType"] = "size"
    with pytest.raises(SpecError):
        ViewSpec.parse(settings).realtime()
