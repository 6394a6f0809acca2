"""Versions, optimistic commits, merges that touch few files, change feeds."""
import threading

import pytest
from pyspark.sql import functions as F

from saleswh.operators import commit as C
from saleswh.operators.commit import Keyed

SCHEMA = "k string, v int"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def there(frame):
    return sorted(tuple(r) for r in frame.collect())


def add(spark, *pairs):
    """A build that adds rows to what is live."""
    return lambda base: rows(spark, *pairs) if base is None else base.unionByName(rows(spark, *pairs))


def test_a_replay_builds_on_what_came_in_between(spark, scratch, monkeypatch):
    root = f"{scratch}/q"
    C.commit_on(spark, root, "h0", add(spark, ("h0", 0)))
    real = C._publish

    def stop(*_):
        raise InterruptedError

    monkeypatch.setattr(C, "_publish", stop)
    with pytest.raises(InterruptedError):  # h1 is written, not published
        C.commit_on(spark, root, "h1", add(spark, ("h1", 1)))
    monkeypatch.setattr(C, "_publish", real)
    C.commit_on(spark, root, "i0", add(spark, ("i0", 2)))
    assert C.commit_on(spark, root, "h1", add(spark, ("h1", 1))) is True
    assert there(C.read_table(spark, root)) == [("h0", 0), ("h1", 1), ("i0", 2)]
    for name in ("h0", "h1", "i0"):
        assert C.commit_on(spark, root, name, add(spark, ("again", 9))) is False


def test_the_other_order(spark, scratch, monkeypatch):
    root, real = f"{scratch}/q", C._publish
    C.commit_on(spark, root, "h0", add(spark, ("h0", 0)))
    monkeypatch.setattr(C, "_publish", lambda *_: (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        C.commit_on(spark, root, "i0", add(spark, ("i0", 2)))
    monkeypatch.setattr(C, "_publish", real)
    C.commit_on(spark, root, "h1", add(spark, ("h1", 1)))
    C.commit_on(spark, root, "i0", add(spark, ("i0", 2)))
    assert there(C.read_table(spark, root)) == [("h0", 0), ("h1", 1), ("i0", 2)]


def test_a_lost_race_is_built_again(spark, scratch):
    root, builds = f"{scratch}/q", []
    C.commit_on(spark, root, "h0", add(spark, ("h0", 0)))

    def slow(base):
        builds.append(1)
        if len(builds) == 1:  # another writer publishes while this one builds
            C.commit_on(spark, root, "i0", add(spark, ("i0", 2)))
        return add(spark, ("h1", 1))(base)

    assert C.commit_on(spark, root, "h1", slow) is True and len(builds) == 2
    assert there(C.read_table(spark, root)) == [("h0", 0), ("h1", 1), ("i0", 2)]
    fs, path = C.path_on(spark, f"{root}/v=h1")
    assert len(fs.listStatus(path)) == 1  # the lost attempt's files are gone


def test_two_parallel_writers_lose_nothing(spark, scratch):
    root = f"{scratch}/q"
    failed = []

    def work(writer):
        try:
            for i in range(4):
                C.commit_on(spark, root, f"{writer}{i}", add(spark, (f"{writer}{i}", i)))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(w,)) for w in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert there(C.read_table(spark, root)) == sorted((f"{w}{i}", i) for w in "ab" for i in range(4))
    assert C.live(spark, root).done == {"a": 3, "b": 3}


def test_schema_comes_from_the_manifest(spark, scratch):
    C.commit(rows(spark), f"{scratch}/t", 0)
    assert C.read_table(spark, f"{scratch}/t").schema == rows(spark).schema
    empty = rows(spark)
    assert C.read_table(spark, f"{scratch}/absent", empty) is empty


def table(spark, scratch, **how):
    return Keyed(spark, f"{scratch}/k", SCHEMA, ["k"], bucket=C.order_ranges("k", 100, 16), buckets=16, **how)


def keyed(spark, numbers, v=0):
    return spark.createDataFrame([(f"{n:06d}", v) for n in numbers], SCHEMA)


def test_a_merge_of_one_percent_rewrites_one_percent(spark, scratch):
    t = table(spark, scratch)
    t.merge("b0", keyed(spark, range(1600)))
    before = t.live().files
    assert len(before) == 16 and sum(f.rows for f in before) == 1600
    t.merge("b1", keyed(spark, range(300, 316), 1))
    after = t.live().files
    assert [f for f in before if f not in after] == [f for f in before if f.bucket == 3]
    assert [f.bucket for f in after if f not in before] == [3]
    assert there(t.read()) == [(f"{n:06d}", int(300 <= n < 316)) for n in range(1600)]
    assert t.merge("b1", keyed(spark, range(1600), 5)) is False


def test_new_keys_beyond_a_files_range_rewrite_nothing(spark, scratch):
    t = table(spark, scratch, files=3)
    t.merge("b0", keyed(spark, range(10)))
    first = t.live().files
    t.merge("b1", keyed(spark, range(20, 30)))
    assert set(first) < set(t.live().files)
    t.merge("b2", keyed(spark, range(40, 50)))
    assert len(t.live().files) == 3
    t.merge("b3", keyed(spark, range(60, 70)))  # now the bucket is written as one file
    assert len(t.live().files) == 1 and t.read().count() == 40


def test_merges_equal_a_plain_merge(spark, scratch):
    import random
    g, t, have = random.Random(1), Keyed(spark, f"{scratch}/m", "k string, v int, w int", ["k"], buckets=5), {}
    for b in range(4):
        new = {str(g.randrange(60)): (b, g.randrange(9)) for _ in range(25)}
        frame = spark.createDataFrame([(k, *x) for k, x in new.items()], "k string, v int, w int")
        t.merge(f"b{b}", frame, update=["v"])
        for k, (v, w) in new.items():
            have[k] = (v, have[k][1] if k in have else w)
        assert there(t.read()) == sorted((k, *x) for k, x in have.items())


def test_null_keys_never_match(spark, scratch):
    t = Keyed(spark, f"{scratch}/n", SCHEMA, ["k"], buckets=3)
    t.merge("b0", rows(spark, (None, 1), ("a", 1)))
    t.merge("b1", rows(spark, (None, 2), ("a", 2)))
    assert sorted(r.v for r in t.read().collect()) == [1, 2, 2]
    t.merge("b2", rows(spark))
    assert t.read().count() == 3


def test_matching_reads_the_touched_files_only(spark, scratch):
    t = table(spark, scratch)
    assert t.matching(keyed(spark, [1]))[0].count() == 0
    t.merge("b0", keyed(spark, range(1600)))
    found, files = t.matching(keyed(spark, [205, 210, 1105]))
    assert sorted(f.bucket for f in files) == [2, 11]
    assert {"000205", "000210", "001105"} <= {r.k for r in found.collect()} and found.count() <= 200
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,000205), LessThanOrEqual(k,001105)]" in \
        found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_changes_between_versions(spark, scratch):
    t = table(spark, scratch, keep=5)
    t.merge("b0", keyed(spark, range(250)))
    t.merge("b1", rows(spark, ("000007", 1), ("000250", 1)))
    t.merge("b2", rows(spark, ("000008", 0)), combine=lambda old, new: old.join(new, "k", "left_anti"))
    assert t.changes(None, 0).groupBy("_change").count().collect()[0]["count"] == 250
    assert sorted(map(tuple, t.changes(0, 1).collect())) == [("000007", 0, "update_before"), ("000007", 1, "update_after"), ("000250", 1, "insert")]
    assert sorted(map(tuple, t.changes(1, 2).collect())) == [("000008", 0, "delete")]
    assert sorted(map(tuple, t.changes(0, 2).collect())) == [("000007", 0, "update_before"), ("000007", 1, "update_after"),
                                                             ("000008", 0, "delete"), ("000250", 1, "insert")]
    assert t.changes(2, 2).count() == 0


def test_old_files_go_with_their_versions(spark, scratch):
    t = table(spark, scratch)
    for b in range(5):
        t.merge(f"b{b}", keyed(spark, range(50), b))
    assert C.versions(spark, t.root) == [3, 4]
    fs, path = C.path_on(spark, t.root)
    assert sorted(s.getPath().getName() for s in fs.listStatus(path)) == ["_published", "v=b3", "v=b4"]
    assert t.read().where(F.col("v") == 4).count() == 50
