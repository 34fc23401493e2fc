"""External shuffle: whole, gapless, near uniform, stable, growing."""

import collections

import pytest

from conftest import SF01
from daybook.llm import sharding as sh
from llm_cases import EDGES, docs_of, edges, no_docs  # noqa: F401


@pytest.fixture(scope="module")
def placed(spark):
    return sh.op7_shards(spark, SF01).collect()


def test_digest_and_law(spark, placed):
    import zlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert len(placed) == len(texts)
    for r in placed:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 16)


def test_slots_are_gapless(placed):
    slots = collections.defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_again_gives_the_same_order(spark, placed):
    assert sorted(map(tuple, sh.op7_shards(spark, SF01).collect())) == sorted(map(tuple, placed))


def test_shard_depends_on_id_and_count_only(spark):
    from pyspark.sql import functions as F

    ids = spark.range(5000)
    got = ids.select("id", sh.shard_of(F.col("id"), 16).alias("a"), sh.shard_of(F.col("id"), 17).alias("b")).collect()
    moved = [r for r in got if r.a != r.b]
    assert all(r.b == 16 for r in moved) and 200 < len(moved) < 400
    assert max(collections.Counter(r.a for r in got).values()) < 400


def test_buckets_are_shuffled(spark):
    """Places in a bucket do not follow the order the records came in."""
    docs = docs_of(spark, [f"t{i}" for i in range(2000)])
    out = sh.external_shuffle(docs, shards=1, bucket_bytes=1 << 30).orderBy("slot").collect()
    order = sh.external_shuffle(docs, shards=1, bucket_bytes=1 << 30, seed=21).orderBy("slot").collect()
    ids = [r.doc_id for r in out]
    up = sum(a < b for a, b in zip(ids, ids[1:], strict=False))
    assert sorted(ids) == list(range(2000)) and 850 < up < 1150 and ids != [r.doc_id for r in order]


def test_many_small_buckets(spark):
    docs = docs_of(spark, [f"text {i}" for i in range(300)])
    out = sh.external_shuffle(docs, shards=2, bucket_bytes=1000).collect()
    assert len({(r.shard, r.bucket) for r in out}) > 10
    for s in (0, 1):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


def test_shards_equal_plain_rendezvous(placed):
    """Each shard draws a hash of its number and the id; the greatest wins."""
    import xxhash

    def draw(shard, key):
        seed = 42
        for part in ((sh.SEED).to_bytes(4, "little"), shard.to_bytes(4, "little"), str(key).encode()):
            seed = xxhash.xxh64_intdigest(part, seed)
        return seed - (1 << 64) if seed >> 63 else seed

    for r in placed:
        for shards, got in ((16, r.shard), (17, r.grown_shard)):
            assert got == max(range(shards), key=lambda i: (draw(i, r.doc_id), i))


def test_one_bucket_a_task_and_slots_bucket_by_bucket(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = sh.external_shuffle(docs, shards=4, bucket_bytes=100_000).withColumn("task", F.spark_partition_id()).collect()
    buckets = collections.defaultdict(list)
    for r in out:
        buckets[r.shard, r.bucket].append(r)
    assert len(buckets) > 20 and sorted(r.doc_id for r in out) == sorted(r.doc_id for r in docs.collect())
    assert len({r.task for r in out}) == len(buckets)
    begins = collections.Counter()
    for (shard, _), rows in sorted(buckets.items()):
        assert sorted(r.slot for r in rows) == list(range(begins[shard], begins[shard] + len(rows)))
        assert len({r.task for r in rows}) == 1
        begins[shard] += len(rows)


def test_edges(spark, edges):
    out = sh.external_shuffle(edges).collect()
    assert len(out) == len(EDGES) and {"doc_id", "text", "kinds", "shard", "bucket", "slot"} <= set(out[0].asDict())
    assert sorted(str(r.text) for r in out) == sorted(map(str, EDGES))
    assert len({(r.shard, r.slot) for r in out}) == len(out)


def test_empty_table(no_docs):
    assert sh.external_shuffle(no_docs).collect() == []


def test_written_shards_come_back_in_slot_order(spark, tmp_path):
    docs = docs_of(spark, [f"text {i}" for i in range(200)])
    sh.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and sorted({r.shard for r in back.select("shard").collect()}) == [0, 1, 2, 3]
    rows = spark.read.parquet(str(tmp_path / "out/shard=1")).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
