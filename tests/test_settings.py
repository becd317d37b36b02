import pytest

from roadpulse.options import Options
from roadpulse.schemas import TOPICS, get_schema
from roadpulse.session import create_session, scratch_path, scratch_root, session_options
from roadpulse.sources import kafka
from roadpulse.streaming.job import parse


def test_five_topics_with_declared_types():
    assert {t: len(get_schema(t)) for t in TOPICS} == {
        "vehicle_data": 10,
        "gps_data": 6,
        "traffic_data": 6,
        "weather_data": 10,
        "emergency_data": 8,
    }
    kinds = {f.dataType.simpleString() for t in TOPICS for f in get_schema(t)}
    assert kinds == {"string", "timestamp", "double", "int"}
    assert all(f.nullable for t in TOPICS for f in get_schema(t))
    assert get_schema("vehicle_data")["location"].dataType.simpleString() == "string"


@pytest.mark.parametrize("topic", ["", "vehicle", "GPS_DATA", None])
def test_unknown_topic_is_rejected(topic):
    with pytest.raises(ValueError, match="record kinds"):
        get_schema(topic)


def test_names_and_servers_from_environment():
    plain = Options.from_env({})
    assert plain.servers == "localhost:9092"
    assert {t: plain.topic_name(t) for t in TOPICS} == {t: t for t in TOPICS}
    env = {"GPS_TOPIC": "fleet.gps", "KAFKA_BOOTSTRAP_SERVERS": "broker:29092"}
    renamed = Options.from_env(env, watermark_delay="5 minutes")
    assert renamed.topic_name("gps_data") == "fleet.gps"
    assert renamed.topic_name("vehicle_data") == "vehicle_data"
    assert renamed.servers == "broker:29092"
    assert renamed.watermark_delay == "5 minutes"


@pytest.mark.parametrize("base", ["s3a://bucket/fleet", "s3a://bucket/fleet/", "file:/data/x"])
def test_a_data_and_a_checkpoint_folder_per_topic(base):
    options = Options(base_uri=base)
    paths = {options.data_path(t) for t in TOPICS} | {options.checkpoint_path(t) for t in TOPICS}
    assert len(paths) == 10
    assert options.data_path("gps_data") == base.rstrip("/") + "/data/gps_data"
    assert options.checkpoint_path("gps_data") == base.rstrip("/") + "/checkpoints/gps_data"


def test_paths_need_a_base():
    with pytest.raises(ValueError):
        Options().data_path("gps_data")


def test_broker_source_options():
    options = Options.from_env({"GPS_TOPIC": "g"}, min_partitions=64, max_offsets_per_trigger=10**6)
    assert kafka.source_options(options, "gps_data") == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "g",
        "startingOffsets": "earliest",
        "minPartitions": "64",
        "maxOffsetsPerTrigger": "1000000",
    }
    with pytest.raises(ValueError):
        kafka.source_options(options, "g")


def test_broker_needs_its_connector(spark):
    """The connector is no part of this environment; what can be seen is that it is asked for."""
    options = Options(servers="broker:1")
    assert kafka.sink_options(options) == {"kafka.bootstrap.servers": "broker:1"}
    messages = spark.createDataFrame([(b"k", b"{}", "gps_data")], "key binary, value binary, topic string")
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.publisher(messages, options).save()
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_topic(spark, "gps_data", options)


def test_job_arguments():
    args, options = parse(
        ["--base-uri", "hdfs:/fleet", "--trigger", "1 minute", "--servers", "a:1,b:2", "--rocksdb"]
    )
    assert args.rocksdb and args.log is None
    assert options.base_uri == "hdfs:/fleet"
    assert options.trigger == "1 minute"
    assert options.servers == "a:1,b:2"
    assert options.watermark_delay == "2 minutes"


def test_session_has_no_credentials():
    options = session_options(rocksdb=True)
    assert options["spark.sql.session.timeZone"] == "UTC"
    assert "RocksDB" in options["spark.sql.streaming.stateStore.providerClass"]
    assert not [k for k in options if "key" in k.lower() or "credential" in k.lower()]


def test_session_and_scratch(spark):
    assert create_session("local[4]").conf.get("spark.sql.session.timeZone") == "UTC"
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_root(spark) == named.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(scratch_root(spark))


class _Remote:
    """A session on a cluster, as far as `scratch_root` looks."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("C", (), {"master": "yarn", "applicationId": "app-1"})


def test_a_cluster_must_name_its_shared_folder():
    assert scratch_root(_Remote("hdfs:/shared/")) == "hdfs:/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Remote(None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Remote("file:/tmp/one-machine"))
