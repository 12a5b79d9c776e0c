"""Several writers of one table."""

import os
import threading
import time

import pytest

from gridtally.sinks import folders, tables
from gridtally.sinks.folders import Lease, LeaseLost, TableBusy, leased
from gridtally.sources.tables import read_parquet

SCHEMA = "id int, v int, day string"
TENANTS = "id int, v int, day string, tenant string"


def write(spark, path, *data, **more):
    source = spark.createDataFrame(list(data), SCHEMA)
    return tables.write_merge(
        source, str(path), schema=SCHEMA, keys=["day", "id"], update_cols=["v"], partition_by=["day"], **more
    )


def write_tenant(spark, path, scope, *data, **more):
    return tables.write_merge(
        spark.createDataFrame(list(data), TENANTS), str(path), schema=TENANTS, keys=["day", "id"],
        update_cols=["v"], partition_by=["day", "tenant"], scope=scope, **more,
    )


def stored(spark, path, schema=SCHEMA):
    return sorted(tuple(r) for r in read_parquet(spark, str(path), schema).collect())


def test_a_second_writer_fails_and_touches_nothing(spark, tmp_path):
    path = tmp_path / "t"
    write(spark, path, (1, 1, "a"))
    with leased(spark, str(path)):
        spark.createDataFrame([(1, 5, "a")], SCHEMA).write.partitionBy("day").parquet(f"{path}/_swap--living")
        (path / "_swap--living" / "_SUCCESS").unlink()
        with pytest.raises(TableBusy):
            write(spark, path, (1, 2, "a"))
        with pytest.raises(TableBusy):
            tables.finish_swaps(spark, str(path))
        assert (path / "_swap--living" / "day=a").exists()
        assert stored(spark, path) == [(1, 1, "a")]
    write(spark, path, (2, 2, "a"))
    assert stored(spark, path) == [(1, 1, "a"), (2, 2, "a")]


def test_upserts_at_once_lose_no_row(spark, tmp_path):
    path, failed = tmp_path / "t", []

    def one(i):
        try:
            write(spark, path, (i, i, "a"), (i, i, f"d{i}"), wait=120)
        except Exception as error:  # noqa: BLE001 - the test looks at what was raised
            failed.append(error)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert stored(spark, path) == sorted([(i, i, "a") for i in range(4)] + [(i, i, f"d{i}") for i in range(4)])
    assert not [p for p in path.iterdir() if p.name.startswith("_swap")]


def test_one_of_many_takes_the_lease(spark, tmp_path):
    leases = [Lease(spark, str(tmp_path / "t")) for _ in range(8)]
    got = []
    threads = [threading.Thread(target=lambda x=x: got.append((x.try_take(), x))) for x in leases]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    taken = [x for ok, x in got if ok]
    assert len(taken) == 1
    taken[0].check()
    taken[0].release()
    assert leases[0 if leases[0] is not taken[0] else 1].try_take()


def test_a_dead_writer_is_taken_over_and_cannot_come_back(spark, tmp_path):
    path = tmp_path / "t"
    write(spark, path, (1, 1, "a"))
    dead = Lease(spark, str(path), seconds=1000)
    dead.take()
    dead._stop.set()  # no longer renewed
    with pytest.raises(TableBusy):
        write(spark, path, (1, 2, "a"))
    old = time.time() - 10_000
    os.utime(path / dead._name(dead.number), (old, old))
    write(spark, path, (1, 2, "a"))
    with pytest.raises(LeaseLost):
        dead.check()
    new = spark.createDataFrame([(1, 9, "a")], SCHEMA)
    new.write.partitionBy("day").parquet(f"{path}/_swap--late")
    with pytest.raises(LeaseLost):
        tables._swap_in(dead.folder, "", dead)
    dead.release()  # says nothing in another's name
    assert stored(spark, path) == [(1, 2, "a")]
    # the complete swap of the late writer is finished by the next one
    write(spark, path, (3, 3, "b"))
    assert stored(spark, path) == [(1, 9, "a"), (3, 3, "b")]


def test_a_living_writer_renews(spark, tmp_path):
    with leased(spark, str(tmp_path / "t"), seconds=2) as lease:
        time.sleep(3)
        assert not Lease(spark, str(tmp_path / "t"), seconds=2).try_take()
        lease.check()


def test_scopes_do_not_meet(spark, tmp_path):
    path = tmp_path / "t"
    with leased(spark, str(path), "oh/1"):
        write_tenant(spark, path, "ap", (1, 1, "a", "ap"), (2, 2, "b", "ap"))
        with pytest.raises(TableBusy):
            write_tenant(spark, path, "oh/1", (1, 1, "a", "oh/1"))
    before = {p: p.stat().st_mtime_ns for p in path.glob("day=a/tenant=ap/*.parquet")}
    write_tenant(spark, path, "oh/1", (1, 7, "a", "oh/1"))
    write_tenant(spark, path, "oh/1", (1, 8, "a", "oh/1"), (5, 5, "a", "oh/1"))
    assert before and before == {p: p.stat().st_mtime_ns for p in path.glob("day=a/tenant=ap/*.parquet")}
    assert stored(spark, path, TENANTS) == [(1, 1, "a", "ap"), (1, 8, "a", "oh/1"), (2, 2, "b", "ap"), (5, 5, "a", "oh/1")]
    with pytest.raises(ValueError, match="ap"):
        write_tenant(spark, path, "oh/1", (1, 1, "a", "ap"))


def test_names_of_scopes_stay_hidden():
    assert folders.scope_name("a=b/c_é") == "a%3Db%2Fc%5F%E9"
