"""Versioned commits: one winner, whole versions."""

import threading

import pytest

from claimward.sources import tables


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")


def staged(spark, root, batch, *names):
    df = spark.createDataFrame([(batch,)], "b string")
    return [tables.stage(df, root, "gold", name, batch) for name in names]


def now(spark, root, version=None):
    return {r.table_name: r.batch_id for r in tables.current(spark, root, version).collect()}


def test_of_two_writers_one_wins(spark, root):
    tables.publish(spark, root, staged(spark, root, "b0", "x", "y"))
    base = tables.latest_version(spark, root)
    one, two = staged(spark, root, "b1", "x", "y"), staged(spark, root, "b2", "x", "y")
    assert tables.publish(spark, root, one, base) == base + 1
    with pytest.raises(tables.PublishConflict, match="another refresh"):
        tables.publish(spark, root, two, base)
    assert now(spark, root) == {"x": "b1", "y": "b1"}
    assert [r.b for r in tables.read_published(spark, root, "gold")["x"].collect()] == ["b1"]


def test_many_writers_at_once_give_one_version(spark, root):
    start, results = threading.Barrier(8), []

    def write(content):
        start.wait()
        results.append((tables.put_if_absent(spark, f"{root}/_published/v0000000001.json", content), content))

    threads = [threading.Thread(target=write, args=(f'{{"layer": "{i}"}}\n' * 200,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [content for won, content in results if won]
    assert len(results) == 8 and len(winners) == 1
    assert open(f"{root}/_published/v0000000001.json").read() == winners[0]
    assert tables.latest_version(spark, root) == 1  # spare files are no versions


def test_a_reader_keeps_its_version_and_other_tables_stay(spark, root):
    first = tables.publish(spark, root, staged(spark, root, "b1", "x", "y"))
    second = tables.publish(spark, root, staged(spark, root, "b2", "x"))
    assert (first, second) == (1, 2)
    assert now(spark, root, first) == {"x": "b1", "y": "b1"}
    assert now(spark, root) == {"x": "b2", "y": "b1"}
    old = tables.read_published(spark, root, "gold", first)
    assert [r.b for r in old["x"].collect()] == ["b1"]
    times = {r.table_name: r.published_at for r in tables.current(spark, root).collect()}
    assert times["y"] == tables.current(spark, root, first).first().published_at <= times["x"]


def test_a_batch_id_belongs_to_one_refresh(spark, root):
    tables.claim_batch(spark, root, "20240101_000000")
    with pytest.raises(tables.PublishConflict, match="batch"):
        tables.claim_batch(spark, root, "20240101_000000")
    with pytest.raises(FileNotFoundError, match="nothing is published"):
        tables.current(spark, root)


def test_scratch_on_a_machines_own_disk_is_refused_on_a_cluster():
    from claimward.session import require_shared

    for folder, master in (("file:/w", "local[4]"), ("file:/w", "local-cluster[2,1,1024]"), ("hdfs://n/w", "yarn")):
        require_shared(folder, master)
    for master in ("yarn", "spark://host:7077", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            require_shared("file:/w", master)
