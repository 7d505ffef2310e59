"""Where stage tables go, and that settings of the user stay."""

import pytest

from shelfwise import session


class Conf(dict):
    def set(self, key, value):
        self[key] = value

    @property
    def getAll(self):
        return dict(self)


class Session:
    def __init__(self, given=None, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})
        self.sparkContext = self
        self.given = given

    def getCheckpointDir(self):
        return self.given


def test_folder_of_the_session():
    configured = Session(spark_checkpoint_dir="file:///shared/", given="file:/shared/3f-2a")
    assert session.shared_dir(configured) == "file:///shared"
    assert session.shared_dir(Session(spark_checkpoint_dir="/shared", given="hdfs:/mine/3f")) == "hdfs:/mine/3f"
    assert session.shared_dir(Session(given="/only/3f")) == "/only/3f"
    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(Session())


def test_settings_at_run_time_stay():
    spark = Session()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    session.tune(spark)
    assert spark.conf["spark.sql.adaptive.skewJoin.enabled"] == "false"
    assert spark.conf["spark.sql.adaptive.enabled"] == "true"


def test_stage_and_unstage(spark):
    table = session.stage(spark.range(5).withColumnRenamed("id", "n"), "five")
    assert table.count() == 5
    folder = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    session.unstage(table)
    import os

    assert not os.path.exists(folder)
