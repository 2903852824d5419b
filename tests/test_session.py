"""Sessions: whose checkpoint folder is used, and sessions without a context."""

import os
from types import SimpleNamespace

import pytest

from marquee import session
from marquee.operators.agg import materialize
from marquee.plans.registry import spark_queries
from tests.conftest import SF_SMALL


class Contextless:
    """A session that, like a remote one, has no SparkContext."""

    def __init__(self, inner):
        self.inner = inner

    @property
    def sparkContext(self):
        raise RuntimeError("no context here")

    def __getattr__(self, name):
        if name in ("_jvm", "_jsc"):
            raise AttributeError(name)
        return getattr(self.inner, name)


def test_scratch_is_below_the_folder_that_the_cluster_names(spark):
    named = session.checkpoint_dir(spark)
    path = session.scratch_path(spark, "x")
    assert path.startswith(named.rstrip("/") + "/")
    assert session.scratch_path(spark, "x") != path


def test_a_key_runs_without_a_context(spark):
    remote = Contextless(spark)
    named = spark.conf.get(session.CHECKPOINT_CONF)
    assert session.checkpoint_dir(remote) == named
    assert session.scratch_path(remote, "x").startswith(f"{named}/marquee-x-")
    rows = spark_queries()["recent_top_rated"](remote, SF_SMALL).collect()
    assert rows == spark_queries()["recent_top_rated"](spark, SF_SMALL).collect()
    session.remove_scratch(remote)  # the cluster cleans its own folder


def test_a_folder_is_never_made_up_on_a_cluster():
    context = SimpleNamespace(master="spark://cluster:7077", getCheckpointDir=lambda: None,
                              getConf=lambda: {}, setCheckpointDir=lambda path: pytest.fail("made up"))
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(cluster)
    named = SimpleNamespace(**vars(context) | {"getConf": lambda: {session.CHECKPOINT_CONF: "hdfs://shared/x"},
                                               "setCheckpointDir": lambda path: None})
    cluster = SimpleNamespace(sparkContext=named, conf=cluster.conf)
    assert session.ensure_checkpoint_dir(cluster) == "hdfs://shared/x"


def test_derived_tables_are_removed_with_the_scratch(spark):
    table = materialize(spark.range(10).selectExpr("id", "array(id) AS list", "CAST(id AS DECIMAL(9,2)) AS d"))
    assert table.count() == 10 and [f.dataType.simpleString() for f in table.schema] == ["bigint", "array<bigint>", "decimal(9,2)"]
    path = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    session.remove_scratch(spark)
    assert not os.path.exists(path)
