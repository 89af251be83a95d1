"""Flushes of exactly N posts: across micro-batches, replays and a stop in the middle."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from canopy.sources import tables as TB
from canopy.streaming import flushes as FL
from canopy.streaming import posts as ST

SF = "/root/testdata/sf0.1"
COLS = ST.POST_SCHEMA.names


def run(spark, root, **kw):
    FL.run_flushes(spark, f"{root}/landing", f"{root}/sink", f"{root}/ckpt", **kw)
    FL.close(spark, f"{root}/sink", f"{root}/ckpt")
    return [tuple(r) for r in FL.flushes(spark, f"{root}/sink").select("lane", "flush_no", "place", *COLS).collect()]


def check(rows, every):
    """Every flush but the last of a lane is full, numbers and places have no gap."""
    places = defaultdict(lambda: defaultdict(list))
    for r in rows:
        places[r[0]][r[1]].append(r[2])
    for lane, by_flush in places.items():
        assert sorted(by_flush) == list(range(len(by_flush))), lane
        for no, got in by_flush.items():
            assert sorted(got) == list(range(1, len(got) + 1))
            assert len(got) == every if no < len(by_flush) - 1 else 1 <= len(got) <= every


def test_hundred_per_flush_with_replay_and_restart(spark, tmp_path):
    posts = TB.posts(spark, SF).select(*[F.col(f.name).cast(f.dataType) for f in ST.POST_SCHEMA]).cache()
    early = posts.where(F.col("created_utc") < posts.agg(F.avg("created_utc")).scalar())
    ST.land(early, f"{tmp_path}/landing", n_flushes=3)
    first = run(spark, tmp_path)
    check(first, FL.FLUSH_EVERY)
    assert Counter(r[3:] for r in first) == Counter(map(tuple, early.collect()))
    # everything again, the early ones as replays
    ST.land(posts, f"{tmp_path}/landing", n_flushes=2)
    second = run(spark, tmp_path)
    check(second, FL.FLUSH_EVERY)
    assert Counter(r[3:] for r in second) == Counter(map(tuple, posts.collect()))
    # what waited or left in the first run keeps its flush and place
    assert set(first) <= set(second)
    assert max(r[1] for r in second) >= 3
    assert sorted(run(spark, tmp_path), key=repr) == sorted(second, key=repr)
    posts.unpersist()


def test_nulls_ties_and_exact_multiples(spark, tmp_path):
    rows = [(None, f"n{i}", None, None, None, None, None, None, None) for i in range(4)]
    rows += [("a", f"a{i}", 'say "hi"\n', 5, "", 2**60 + 1, 0, "u", "ü\U0001F600") for i in range(8)]
    rows += [("b", None, "t", 1, "x", 1, 1, "u", "f")]
    ST.land(spark.createDataFrame(rows, ST.POST_SCHEMA), f"{tmp_path}/landing", n_flushes=2)
    got = run(spark, tmp_path, every=4)
    assert Counter(r[3:] for r in got) == Counter(rows)
    assert Counter((r[0], r[1]) for r in got) == {(None, 0): 4, ("a", 0): 4, ("a", 1): 4, ("b", 0): 1}


def test_empty(spark, tmp_path):
    ST.land(spark.createDataFrame([], ST.POST_SCHEMA), f"{tmp_path}/landing", n_flushes=1)
    assert run(spark, tmp_path) == []
