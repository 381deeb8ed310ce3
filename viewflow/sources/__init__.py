"""Topic sources and value codecs."""

from viewflow.sources.codecs import decode_value, encode_value
from viewflow.sources.topics import SourceSet, Topic, ingest_source, keyed, publish, topic_source

__all__ = [
    "SourceSet",
    "Topic",
    "decode_value",
    "encode_value",
    "ingest_source",
    "keyed",
    "publish",
    "topic_source",
]
