"""Message sources: stream options, topic filters, sampling, lag and offset planning."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefilters import PreFunction, input_stage, text_stage

MAX_MESSAGE_BYTES = 10_000_000
#: Offsets by topic and partition.
Offsets = dict[str, dict[str, int]]


@dataclass
class KafkaSource:
    """A Kafka data source.  ``security``: none, ssl (mTLS) or sasl_plain; certificates are always verified."""

    brokers: list[str]
    topics: list[str]
    group: str = ""
    start: str = "newest"
    security: str = "none"
    user: str = ""
    secret: str = ""
    truststore: str = ""
    keystore: str = ""
    truststore_password: str = ""
    keystore_password: str = ""
    #: Whether the login of "sasl_plain" travels over TLS.
    encrypted: bool = True
    per_trigger: int = 0

    def __post_init__(self):
        if not self.brokers or not self.topics:
            raise ValueError("brokers and topics are required")
        if self.security == "sasl_plain" and not self.user:
            raise ValueError("SASL/PLAIN needs a user")
        if self.security not in ("none", "ssl", "sasl_plain"):
            raise ValueError(f"unknown security {self.security}")

    def options(self) -> dict[str, str]:
        """Options of Spark's reader."""
        out = {
            "kafka.bootstrap.servers": ",".join(self.brokers),
            "subscribe": ",".join(self.topics),
            "startingOffsets": "earliest" if self.start in ("oldest", "earliest") else "latest",
            "kafka.max.partition.fetch.bytes": str(MAX_MESSAGE_BYTES),
            "failOnDataLoss": "false",
        }
        if self.group:
            out["kafka.group.id"] = self.group
        if self.per_trigger:
            out["maxOffsetsPerTrigger"] = str(self.per_trigger)
        if self.security == "ssl":
            out |= {"kafka.security.protocol": "SSL", "kafka.ssl.truststore.location": self.truststore, "kafka.ssl.keystore.location": self.keystore}
            stores = {"kafka.ssl.truststore.password": self.truststore_password, "kafka.ssl.keystore.password": self.keystore_password}
            out |= {name: value for name, value in stores.items() if value}
        if self.security == "sasl_plain":
            user, secret = (x.replace("\\", "\\\\").replace('"', '\\"') for x in (self.user, self.secret))
            login = f'org.apache.kafka.common.security.plain.PlainLoginModule required username="{user}" password="{secret}";'
            out |= {"kafka.security.protocol": "SASL_SSL" if self.encrypted else "SASL_PLAINTEXT", "kafka.sasl.mechanism": "PLAIN", "kafka.sasl.jaas.config": login}
        return out

    def stream(self, spark: SparkSession) -> DataFrame:
        """source, partition, offset, timestamp and raw of the unbounded stream; messages of a lone line feed are left out."""
        rows = spark.readStream.format("kafka").options(**self.options()).load()
        return without_blank(rows.select(F.col("topic").alias("source"), "partition", "offset", "timestamp", F.col("value").alias("raw")))

    def window(self, spark: SparkSession, begins: Offsets, stops: Offsets) -> DataFrame:
        """The same columns of the messages from some offsets up to others, as a table."""
        own = {k: v for k, v in self.options().items() if k not in ("subscribe", "kafka.group.id", "maxOffsetsPerTrigger")}
        rows = spark.read.format("kafka").options(**own | window_options(begins, stops)).load()
        return without_blank(rows.select(F.col("topic").alias("source"), "partition", "offset", "timestamp", F.col("value").alias("raw")))


def file_stream(spark: SparkSession, folder: str, schema: str, format: str = "parquet", files_per_trigger: int = 0) -> DataFrame:
    """A stream of the files of a folder."""
    reader = spark.readStream.schema(schema).format(format)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(folder)


def without_blank(rows: DataFrame, raw: str = "raw") -> DataFrame:
    return rows.where(F.col(raw).isNotNull() & (F.col(raw).cast("string") != "\n"))


def topic_selected(topic: str, include: list[str], exclude: list[str], legacy: list[str] | None = None) -> bool:
    """Included (an empty list includes all) and not excluded; names between slashes are patterns."""

    def named(rules: list[str]) -> bool:
        return any(re.search(r[1:-1], topic) is not None if len(r) > 2 and r.startswith("/") and r.endswith("/") else r == topic for r in rules)

    wanted = include or legacy or []
    return (not wanted or named(wanted)) and not named(exclude)


def drop_share(rows: DataFrame, rate: float, seed: int | None = None) -> DataFrame:
    """Rows less a random share; rates outside 0.01 to 0.99 drop nothing."""
    if not 0.01 <= rate <= 0.99:
        return rows
    return rows.where(F.rand(seed) * 100 >= int(rate * 100))


def drop_share_by_key(rows: DataFrame, rate: float, key: str) -> DataFrame:
    """The same share by a hash of a key: reruns drop the same rows."""
    if not 0.01 <= rate <= 0.99:
        return rows
    return rows.where(F.crc32(F.col(key).cast("string").cast("binary")) % 100 >= int(rate * 100))


def end_windows(first: Offsets, last: Offsets, most: int, skip: int = 0, latest: bool = True) -> tuple[Offsets, Offsets]:
    """Where to begin and to stop reading at most ``most`` messages of each partition's end (or beginning), after ``skip`` ones; partitions without any are left out."""
    begins: Offsets = {}
    stops: Offsets = {}
    for topic, partitions in last.items():
        for partition, end in partitions.items():
            low = first.get(topic, {}).get(partition, 0)
            stop = max(low, end - skip) if latest else min(end, low + skip + most)
            begin = max(low, stop - most) if latest else min(end, low + skip)
            if begin < stop:
                begins.setdefault(topic, {})[partition], stops.setdefault(topic, {})[partition] = begin, stop
    return begins, stops


def window_options(begins: Offsets, stops: Offsets) -> dict[str, str]:
    """Options of a bounded Kafka read (``spark.read``) of these windows."""
    return {"assign": json.dumps({t: sorted(map(int, p)) for t, p in begins.items()}), "startingOffsets": json.dumps(begins), "endingOffsets": json.dumps(stops)}


def sample_message(read: Callable[[Offsets, Offsets], DataFrame], first: Offsets, last: Offsets, functions: list[PreFunction], raw: str = "raw", latest: bool = True, most: int = 16, tries: int = 4) -> str | None:
    """One message that passes a task's text functions, as they leave it; None if there is none.

    ``read`` gives the messages from some offsets up to others.  Each try reads ``most`` messages of each partition at the topic's newest (or oldest) end, the next one twice as many
    beyond; so a topic's size does not matter.
    """
    skip = 0
    for _ in range(tries):
        begins, stops = end_windows(first, last, most, skip, latest)
        if not begins:
            return None
        rows = read(begins, stops)
        if not any(f.mode == "decompress" for f in functions):
            rows = rows.withColumn(raw, F.col(raw).cast("string"))
        rows = text_stage(input_stage(rows, functions, raw), functions, raw)
        found = rows.where(F.length(raw) > 0).select(raw).limit(1).collect()
        if found:
            return found[0][0]
        skip, most = skip + most, most * 2
    return None


def lag(ends: dict[str, dict[str, int]], committed: dict[str, dict[str, int]]) -> list[dict]:
    """Topic, partition, end, committed and lag, in order of topic and partition; nothing committed counts from 0."""
    rows = []
    for topic in sorted(ends):
        for partition in sorted(ends[topic], key=int):
            at = committed.get(topic, {}).get(partition, 0)
            rows.append({"topic": topic, "partition": int(partition), "end": ends[topic][partition], "committed": at, "lag": max(0, ends[topic][partition] - at)})
    return rows


def lag_table(spark: SparkSession, ends: Offsets, committed: Offsets) -> DataFrame:
    """The lag of each partition as a table, to be joined or watched."""
    return spark.createDataFrame([tuple(r.values()) for r in lag(ends, committed)], "topic string, partition int, end long, committed long, lag long")


def progress_lag(progress: dict) -> list[dict]:
    """The lag that a streaming query's progress tells."""
    out = []
    for source in progress.get("sources", []):
        ends, at = (json.loads(source[k]) if isinstance(source.get(k), str) else source.get(k) or {} for k in ("latestOffset", "endOffset"))
        out += lag(ends, at)
    return out


def clamped_offsets(wanted: dict[str, int], first: dict[str, int], last: dict[str, int], active_members: int = 0) -> dict[str, int]:
    """Offsets to start from, within what there is; refused while consumers are active."""
    if active_members:
        raise RuntimeError("the consumer group is active")
    return {p: min(max(o, first.get(p, 0)), last.get(p, o)) for p, o in wanted.items()}


@dataclass
class DataSource:
    id: int
    plugin: str
    settings: dict = field(default_factory=dict)
    clusters: list[str] = field(default_factory=list)


PLUGINS = ("elasticsearch", "doris", "kafka", "victoria_logs")


def decode_sources(items: list[dict], cluster: str = "") -> dict[int, DataSource]:
    """Data sources by id, the first of an id wins; settings may be JSON text; sources tied to other clusters are left out."""
    out: dict[int, DataSource] = {}
    for item in items:
        kind = item.get("plugin_type") or item.get("type") or ""
        if kind not in PLUGINS:
            continue
        settings = item.get("settings") or {}
        settings = json.loads(settings) if isinstance(settings, str) else settings
        clusters = settings.get("related_clusters") or []
        if cluster and clusters and cluster not in clusters:
            continue
        out.setdefault(item["id"], DataSource(item["id"], kind, settings, clusters))
    return out
