"""Topics: Kafka, or a folder of ``key, value`` Parquet files with the same shape."""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from gaugewright.sources.epochs import delete_folder, move_file, read_json, record_path, write_epoch

KAFKA_STARTING_OFFSETS = "earliest"


@dataclass(frozen=True)
class KafkaTopics:
    """Topics on a broker; needs Spark's Kafka package on the classpath.

    ``max_offsets`` bounds a micro-batch, ``min_partitions`` splits the topic's partitions
    into more tasks.
    """

    servers: str
    max_offsets: int | None = None
    min_partitions: int | None = None
    extra: dict = field(default_factory=dict)

    def options(self, topic):
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": topic,
            "startingOffsets": KAFKA_STARTING_OFFSETS,
        }
        if self.max_offsets:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return {**options, **self.extra}

    def read_stream(self, spark, topic):
        """Messages with ``partition`` and ``offset``, from the earliest on first start."""
        return (
            spark.readStream.format("kafka").options(**self.options(topic)).load()
            .select("key", "value", "topic", "partition", "offset")
        )

    def write_options(self):
        return {"kafka.bootstrap.servers": self.servers, **self.extra}

    def write(self, messages, topic):
        self.write_all(messages.select(F.lit(topic).alias("topic"), "key", "value"))

    def write_all(self, messages):
        """Each message goes to the topic it names."""
        (
            messages.select("topic", "key", "value").write.format("kafka")
            .options(**self.write_options()).save()
        )

    def write_epoch(self, messages, run, epoch):
        """A broker takes a replayed batch again; the views hide what it repeats."""
        self.write_all(messages)


@dataclass(frozen=True)
class FileTopics:
    """Topics as folders of Parquet files under ``path``; each write adds files.

    A batch is written aside and recorded, then its files are renamed into their topics under names that come from
    the batch. So a replayed batch only moves what is left to move, and readers meet each message once:

        path/topic=<t>/<run>-<epoch>-<n>.parquet             what readers see
        path/_batches/run=<query>/epoch=<n>/attempt=<id>/    files of attempts, before they are moved
        path/_batches/_records/run=<query>/epoch=<n>.json    the attempt that counts, and its files
    """

    path: str
    max_files: int | None = None
    max_bytes: int | None = None

    def folder(self, topic):
        return f"{self.path}/topic={topic}"

    def read_stream(self, spark, topic):
        reader = spark.readStream.schema("key STRING, value STRING")
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", str(self.max_files))
        elif self.max_bytes:
            reader = reader.option("maxBytesPerTrigger", str(self.max_bytes))
        return reader.parquet(self.folder(topic))

    def read(self, spark, topic):
        return spark.read.schema("key STRING, value STRING").parquet(self.folder(topic))

    def write(self, messages, topic):
        messages.select("key", "value").write.mode("append").parquet(self.folder(topic))

    def write_all(self, messages):
        """Each message goes to the topic it names."""
        (
            messages.select("topic", "key", "value").write.mode("append")
            .partitionBy("topic").parquet(self.path)
        )

    def write_epoch(self, messages, run, epoch):
        """Each message of a batch goes to the topic it names, once, however often the batch is replayed."""
        spark, batches = messages.sparkSession, f"{self.path}/_batches"
        write_epoch(messages.select("topic", "key", "value"), batches, run, epoch, ("topic",))
        for number, (name, _) in enumerate(read_json(spark, record_path(batches, run, epoch))["files"]):
            [topic] = [part for part in name.split("/") if part.startswith("topic=")]
            move_file(spark, f"{batches}/{name}", f"{self.path}/{topic}/{run}-{epoch}-{number:05d}.parquet")
        # The record stays; of the batch before, which is done, nothing is needed any more.
        if epoch > 0:
            delete_folder(spark, f"{batches}/run={run}/epoch={epoch - 1}")
            delete_folder(spark, record_path(batches, run, epoch - 1))
