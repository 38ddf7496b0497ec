"""Options of the Kafka source and sink. The connector jar comes with the cluster."""

from __future__ import annotations


def source_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    """Read a topic from its beginning; positions are kept by the query's checkpoint."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}
