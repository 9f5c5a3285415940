"""Settings objects. Pure functions of a mapping: nothing reads the process
environment implicitly and there is no default password."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class TopicOptions:
    """Where the order messages come from (SRC-1..5)."""

    bootstrap_servers: str
    topic: str = "orders"
    group: str | None = None
    starting: str = "latest"
    max_per_batch: int | None = None  # 1,000,000 in the one pipeline that sets it
    min_partitions: int | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls, env: Mapping[str, str], group: str | None = None) -> "TopicOptions":
        # The setting names the jobs are configured with.
        if "KAFKA_BOOTSTRAP_SERVERS" not in env:
            raise KeyError("KAFKA_BOOTSTRAP_SERVERS is required")
        return cls(
            bootstrap_servers=env["KAFKA_BOOTSTRAP_SERVERS"],
            topic=env.get("KAFKA_TOPIC", "orders"),
            group=group,
        )

    def reader_options(self) -> dict[str, str]:
        """Options for ``spark.readStream.format("kafka")``."""
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting,
        }
        if self.group:
            opts["kafka.group.id"] = self.group
        if self.max_per_batch:
            opts["maxOffsetsPerTrigger"] = str(self.max_per_batch)
        if self.min_partitions:
            opts["minPartitions"] = str(self.min_partitions)
        opts.update(self.extra)
        return opts

    def writer_options(self) -> dict[str, str]:
        """Options for ``df.write.format("kafka")`` (publishing, ``acks=all``)."""
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "topic": self.topic,
            "kafka.acks": "all",
        }
        opts.update(self.extra)
        return opts


@dataclass(frozen=True)
class JdbcOptions:
    """A JDBC target (SNK-1..5, SRC-7)."""

    url: str
    user: str
    password: str
    table: str = "processed_orders"
    driver: str | None = None
    batch_rows: int = 1000
    max_retries: int = 5
    num_partitions: int | None = 16  # at most so many connections at once

    @classmethod
    def from_env(cls, env: Mapping[str, str], table: str = "processed_orders") -> "JdbcOptions":
        # The setting names the jobs are configured with.
        missing = [k for k in ("POSTGRES_URL", "POSTGRES_USER", "POSTGRES_PASSWORD") if k not in env]
        if missing:
            raise KeyError(f"missing settings: {', '.join(missing)}")
        return cls(
            url=env["POSTGRES_URL"],
            user=env["POSTGRES_USER"],
            password=env["POSTGRES_PASSWORD"],
            table=table,
            driver=env.get("JDBC_DRIVER"),
        )

    def writer_options(self, table: str | None = None) -> dict[str, str]:
        opts = {
            "url": self.url,
            "dbtable": table or self.table,
            "user": self.user,
            "password": self.password,
            "batchsize": str(self.batch_rows),
        }
        if self.driver:
            opts["driver"] = self.driver
        if self.num_partitions:
            opts["numPartitions"] = str(self.num_partitions)
        return opts


@dataclass(frozen=True)
class StreamOptions:
    """How a stream runs (STR-1, 2, 7, 9)."""

    name: str | None = "orders"
    checkpoint: str | None = None
    trigger: str | None = "10 seconds"
    available_now: bool = False
    partitions: int | None = None

    def trigger_kwargs(self) -> dict:
        if self.available_now:
            return {"availableNow": True}
        if self.trigger:
            return {"processingTime": self.trigger}
        return {}
