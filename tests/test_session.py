"""Where intermediate steps go."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from termledger.session import StepFolder, work_dir


class Conf(dict):
    """The part of a session's settings that is read."""

    def get(self, key, default=None):
        return dict.get(self, key, default)


def session(**settings):
    return SimpleNamespace(conf=Conf({f"spark.{k.replace('_', '.')}": v for k, v in settings.items()}))


def test_steps_go_to_the_folder_the_session_names(spark):
    named = Path(spark.conf.get("spark.checkpoint.dir"))
    assert work_dir(spark) == str(named)
    steps = StepFolder(spark, "probe")
    first = steps.write(spark.range(3).toDF("n"))
    second = steps.write(first.where("n > 0"))
    (folder,) = named.glob("probe-*")
    # The round before the last is gone once the last one is committed.
    assert [p.name for p in folder.iterdir()] == ["round-002"]
    assert sorted(r.n for r in second.collect()) == [1, 2]


def test_kept_rounds_stay(spark):
    named = Path(spark.conf.get("spark.checkpoint.dir"))
    steps = StepFolder(spark, "kept", keep=True)
    for _ in range(2):
        steps.write(spark.range(1).toDF("n"))
    (folder,) = named.glob("kept-*")
    assert sorted(p.name for p in folder.iterdir()) == ["round-001", "round-002"]


def test_a_cluster_must_name_the_folder():
    with pytest.raises(ValueError):
        work_dir(session(master="yarn"))
    with pytest.raises(ValueError):
        work_dir(SimpleNamespace(conf=Conf({"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/tmp/w"})))
    assert work_dir(session(master="yarn", checkpoint_dir="hdfs://shared/steps/")) == "hdfs://shared/steps"


def test_without_the_setting_steps_go_below_the_warehouse():
    shared = {"spark.master": "yarn", "spark.sql.warehouse.dir": "hdfs://shared/warehouse/"}
    assert work_dir(SimpleNamespace(conf=Conf(shared))) == "hdfs://shared/warehouse/_steps"
    local = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/tmp/w"}
    assert work_dir(SimpleNamespace(conf=Conf(local))) == "file:/tmp/w/_steps"
