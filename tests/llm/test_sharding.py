import hashlib

from pyspark.sql import functions as F

from canopy.llm import sharding as S


def brute(rows, limit):
    """Split by key hash bits until a shard fits or its rows share all bits."""
    bits = {k: f"{int(hashlib.md5(('' if k is None else str(k)).encode()).hexdigest()[:15], 16):060b}" for k, _ in rows}
    out = {}
    todo = [("", list(range(len(rows))))]
    while todo:
        prefix, own = todo.pop()
        if sum(rows[i][1] for i in own) <= limit or len(own) == 1 or len(prefix) == 60:
            out.update({i: prefix for i in own})
        else:
            for b in "01":
                part = [i for i in own if bits[rows[i][0]][len(prefix)] == b]
                if part:
                    todo.append((prefix + b, part))
    return out


def test_against_brute_force(spark, rng):
    rows = [(k, rng.randrange(0, 90)) for k in range(300)] + [(None, 5)]
    df = spark.createDataFrame([(k, "x" * n) for k, n in rows], "doc_id long, text string").withColumn("h", F.lit(1))
    got = {(r.doc_id, r.n_bytes): r.shard for r in S.assign(df, limit=400).collect()}
    want = brute(rows, 400)
    assert got == {rows[i]: "s" + p for i, p in want.items()}


def test_a_hot_key_splits_and_every_shard_fits(spark, odd):
    hot = spark.createDataFrame([(1, "y" * 50)] * 200 + [(2, "z" * 40), (3, "w" * 999)], "doc_id long, text string")
    out = S.assign(hot, limit=300).collect()
    assert len(out) == 202
    size: dict[str, int] = {}
    for r in out:
        size[r.shard] = size.get(r.shard, 0) + r.n_bytes
    for r in out:
        assert size[r.shard] == r.shard_bytes
        assert r.shard_bytes <= 300 or (r.shard_docs == 1 and r.oversized)
    shards = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]) if a != b)


def test_at_least_so_many_shards(spark):
    df = spark.createDataFrame([(k, "x" * 10) for k in range(400)], "doc_id long, text string")
    out = S.assign(df, min_shards=20).collect()
    assert len(out) == 400 and len({r.shard for r in out}) >= 20
    assert all(r.shard_bytes <= 200 and not r.oversized for r in out)


def test_repeated_rows_of_a_split_key_are_written_once_each(spark, tmp_path):
    hot = spark.createDataFrame([(1, "y" * 50)] * 120 + [(2, "z" * 40)], "doc_id long, text string")
    S.write_shards(hot, S.assign(hot, limit=600), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.where("doc_id = 1").count() == 120 and back.where("doc_id = 2").count() == 1
    assert back.where("doc_id = 1").select("shard").distinct().count() > 4


def test_odd_rows_and_written_shards(spark, odd, none, tmp_path):
    a = S.assign(odd, limit=4000)
    assert a.count() == odd.count()
    S.write_shards(odd, a, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count()
    assert S.assign(none).count() == 0
