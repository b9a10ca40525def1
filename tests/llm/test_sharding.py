"""Jump hashing and slots against plain Python, and the defined cases."""

import collections
import hashlib
import random
import zlib

from meterwatch.llm import sharding


def jumped(key, shards):
    state = int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16)
    bucket, at = -1, 0
    while at < shards:
        bucket = at
        state = (state * 2862933555777941757 + 1) % 2**64
        at = int((bucket + 1) * (2.0**31 / ((state >> 33) + 1)))
    return bucket


def expected(data, shards, parts, block):
    low = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[8:16], 16)
    rows = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in data)
    placed = collections.defaultdict(list)
    for (i, size, crc), n in rows.items():
        for copy in range(n):
            b = copy // block
            placed[jumped(i, shards)].append(((low(i) + crc + b) % parts, -1 if i is None else i, size, crc, b, i))
    return sorted(
        (str(i), size, crc, shard, slot, jumped(i, shards + 1))
        for shard, members in placed.items() for slot, (_, _, size, crc, _, i) in enumerate(sorted(members, key=lambda m: m[:5]))
    )


def test_slots_as_plain_python(spark):
    rng = random.Random(1)
    data = [(i, f"text {i % 7} é") for i in range(500)] + [(7, "same")] * 900 + [(None, None), (None, ""), (3, None), (3, "x" * 100_000), (3, "text 3 é")]
    rng.shuffle(data)
    docs = spark.createDataFrame([(*r, 5, 6) for r in data], "doc_id long, text string, shard int, n int")
    for shards, parts, block in ((40, 1024, 1 << 16), (3, 5, 64), (100, 2, 7)):
        found = sharding.slots(docs, shards, parts, block).collect()
        got = sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.slot, r.grown_shard) for r in found)
        assert got == expected(data, shards, parts, block)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(5000).selectExpr("concat('doc-', id) AS doc_id", "'t' AS text", "'old' AS shard", "1 AS s", "2 AS k")
    small, large = ({r.doc_id: r.shard for r in sharding.assign(docs, n).collect()} for n in (64, 70))
    moved = {r.doc_id: (r.from_shard, r.to_shard) for r in sharding.moves(docs, 64, 70).collect()}
    assert moved == {d: (small[d], large[d]) for d in small if small[d] != large[d]}
    assert all(to >= 64 for _, to in moved.values()) and 0.05 < len(moved) / 5000 < 0.12
    assert all(small[d] == jumped(d, 64) for d in small)
    load = collections.Counter(small.values())
    assert len(load) == 64 and max(load.values()) < 2 * 5000 / 64


def test_one_shard_empty_table_and_files(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "doc_id long, text string")
    assert sorted((r.shard, r.slot) for r in sharding.slots(docs, 1).collect()) == [(0, 0), (0, 1), (0, 2)]
    assert sharding.digest(docs.limit(0)).collect() == []
    sharding.write(docs, str(tmp_path / "out"), 8, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.shard) for r in back.collect()) == sorted((i, jumped(i, 8)) for i in (1, 2, 2))
