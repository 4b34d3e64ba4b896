"""Session helpers: where shared scratch data lives, and a local session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
HUGE_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
DEFAULT_METHOD_LIMIT = "65535"
COMPILED_METHOD_LIMIT = "8000"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path under the cluster's shared folder.

    The folder is the one the session names in ``spark.checkpoint.dir``. Only a
    local session may go without it; a cluster without a shared folder is an error,
    because executors cannot see each other's disks.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def tuned(spark: SparkSession) -> SparkSession:
    """The session, set up for wide tables.

    The virtual machine does not compile methods over 8000 bytes of code. With Spark's
    default limit, one method holds the conversion of all columns of a wide table and is
    interpreted for every event; with this one, Spark splits such stages into small
    methods instead, which halves the time of the conversion. A limit set by the user is kept.
    """
    if spark.conf.get(HUGE_METHOD_LIMIT, None) in (None, DEFAULT_METHOD_LIMIT):
        spark.conf.set(HUGE_METHOD_LIMIT, COMPILED_METHOD_LIMIT)
    return spark


def local_session(cores: str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """The session used by the tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Python's note of where each column expression was written costs a third of the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)
