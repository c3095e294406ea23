"""Kafka topics; needs Spark's Kafka connector on the class path."""


def kafka_sink_options(servers, topic):
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_kafka(lines, servers, topic):
    """A ``value`` column to a topic, from the executors."""
    lines.select("value").write.format("kafka").options(**kafka_sink_options(servers, topic)).save()
