from types import SimpleNamespace

import pytest

from loamline.plans import catalog
from loamline.session import checkpoint_dir
from loamline.sources.tables import table

from paths import SF_SMALL


def test_checkpoint_dir_comes_from_the_session(spark):
    path = checkpoint_dir(spark)
    assert path == spark.conf.get("spark.checkpoint.dir")


def test_checkpoint_dir_must_be_named():
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError):
        checkpoint_dir(unset)


@pytest.mark.parametrize("name", ["completed_rows", "latest_pending", "prediction_log", "flush_remaining",
                                  "daily_mae", "queue_counts", "cycle_outputs", "history_union"])
def test_building_a_query_starts_no_job(spark, name, monkeypatch):
    """The replay queries are lazy: once the table's footer is read, nothing runs before an action."""
    events = table(spark, SF_SMALL, "events")
    monkeypatch.setattr(catalog, "table", lambda spark, sf, name: events)
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        catalog.QUERIES[name](spark, SF_SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_cluster_conf_scales_partitions():
    from loamline.session import cluster_conf
    small = cluster_conf(10 * 1024**2)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = cluster_conf(100 * 1024**4)
    assert int(big["spark.sql.shuffle.partitions"]) == 819_200
    mid = cluster_conf(1024**4)
    assert int(mid["spark.sql.shuffle.partitions"]) == 8192
