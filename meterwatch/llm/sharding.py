"""Stable shards by jump consistent hashing, without a ring table, and a gapless place for every row in its shard.

A key's 64-bit state (the first half of the MD5 of its text) runs through the generator state * MULTIPLIER + 1. From
bucket b it jumps to floor((b + 1) * 2^31 / (the state's upper 31 bits + 1)), until it leaves the shards; the last bucket
inside is the shard. A jump beyond the last shard is the only change that one more shard brings, so rows move into the
new shard alone. Jumps rise strictly, so there are never more of them than shards; on average they are about ln(shards).
SQL has no wrapping product, so the state is kept as two 32-bit halves.

Slots: rows that are equal in all that is returned are counted first, cut into blocks of `block` copies and dealt to
PARTS parts of their shard by a hash. A part is ordered by itself and starts where the parts before it end, so that no
task orders a whole shard and a key that holds a third of all rows is spread.

Defined cases: a missing id counts as the empty text; a missing text has no bytes (size 16, crc32 0); repeated rows get
slots of their own; an empty table gives an empty table; columns of the input that are named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import let, stored

SHARDS, PARTS, BLOCK, OVERHEAD = 40, 1024, 1 << 16, 16
#: Fixed value: multiplier of the generator in the published algorithm.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = divmod(MULTIPLIER, 1 << 32)
_MASK = (1 << 32) - 1


def key_halves(column: str) -> str:
    """SQL: upper and lower half of a key's state."""
    half = lambda h, at: f"CAST(conv(substr({h}, {at}, 8), 16, 10) AS BIGINT)"
    digest = f"md5(CAST(coalesce(CAST({column} AS STRING), '') AS BINARY))"
    return let(digest, "h", f"named_struct('hi', {half('h', 1)}, 'lo', {half('h', 9)})")


def _next_state(hi: str, lo: str) -> str:
    """SQL: (hi, lo) * MULTIPLIER + 1 modulo 2^64. Factors are cut at 16 bits, so that no product passes 2^49."""
    times = lambda x, factor: f"({x} * {factor & 0xFFFF}L + shiftleft(({x} * {factor >> 16}L) & 65535L, 16))"
    low = f"({lo} * {_LOW & 0xFFFF}L + 1L)"
    mid = f"({lo} * {_LOW >> 16}L + shiftright({low}, 16))"
    return (
        f"named_struct('hi', (shiftright({mid}, 16) + {times(hi, _LOW)} + {times(lo, _HIGH)}) & {_MASK}L, "
        f"'lo', shiftleft({mid} & 65535L, 16) | ({low} & 65535L))"
    )


def jump(column: str, shards: int) -> str:
    """SQL: the shard of a key among `shards` and among one more, as a struct (shard, grown)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    moved = (
        "named_struct('hi', k.hi, 'lo', k.lo, 'shard', if(s.at < {n}, s.at, s.shard), 'grown', s.at, "
        "'at', CAST(floor((s.at + 1) * (2147483648D / (shiftright(k.hi, 1) + 1))) AS BIGINT))"
    ).format(n=shards)
    step = f"(s, i) -> if(s.at > {shards}, s, {let(_next_state('s.hi', 's.lo'), 'k', moved)})"
    start = let(key_halves(column), "k", "named_struct('hi', k.hi, 'lo', k.lo, 'shard', 0L, 'grown', 0L, 'at', 0L)")
    few = min(shards + 1, 64)
    end = f"aggregate(sequence(1, {few}), {start}, {step})"
    if shards + 1 > few:  # a key with more jumps than that goes on to the bound
        end = let(end, "e", f"if(e.at > {shards}, e, aggregate(sequence({few + 1}, {shards + 1}), e, {step}))")
    return let(end, "e", "named_struct('shard', CAST(e.shard AS INT), 'grown', CAST(e.grown AS INT))")


def assign(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """The documents with `shard`. Nothing is shuffled."""
    return docs.withColumn("shard", F.expr(f"{jump(f'`{key}`', shards)}.shard"))


def moves(docs: DataFrame, shards: int, more: int, key: str = "doc_id") -> DataFrame:
    """The documents whose shard changes when `shards` become `more`, with `from_shard` and `to_shard`."""
    if more < shards:
        raise ValueError("shards are only appended")
    placed = docs.withColumns({
        "from_shard": F.expr(f"{jump(f'`{key}`', shards)}.shard"), "to_shard": F.expr(f"{jump(f'`{key}`', more)}.shard"),
    })
    return placed.where("from_shard <> to_shard")


def write(docs: DataFrame, path: str, shards: int = SHARDS, files: int = 1, key: str = "doc_id") -> None:
    """One Parquet folder a shard, of `files` files each, so that a large shard is written by several tasks."""
    spread = F.expr(f"pmod(xxhash64(`{key}`, text), {files})")
    assign(docs, shards, key).repartition("shard", spread).write.partitionBy("shard").parquet(path)


def slots(docs: DataFrame, shards: int = SHARDS, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard and slot of every document."""
    narrow = docs.selectExpr(
        "doc_id", f"octet_length(coalesce(text, '')) + {OVERHEAD}L AS size", "crc32(coalesce(CAST(text AS BINARY), X'')) AS text_crc32"
    )
    counted = narrow.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    dealt = counted.selectExpr("*", f"inline(array({jump('doc_id', shards)}))", f"{key_halves('doc_id')}.lo AS low")
    blocks = stored(dealt.selectExpr("*", f"explode(sequence(0L, (copies - 1) DIV {block})) AS block").selectExpr(
        "doc_id", "size", "text_crc32", "shard", "grown AS grown_shard", "block",
        f"least(copies - block * {block}, {block}L) AS n", f"CAST((low + text_crc32 + block) % {parts} AS INT) AS part",
    ), "shard-blocks")
    # one row a shard and part: bounded by parameters
    starts = blocks.groupBy("shard", "part").agg(F.sum("n").alias("n")).selectExpr(
        "shard", "part", "coalesce(sum(n) OVER (PARTITION BY shard ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS start"
    )
    before = (
        "coalesce(sum(n) OVER (PARTITION BY shard, part ORDER BY doc_id, size, text_crc32, block "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before"
    )
    numbered = blocks.selectExpr("*", before).join(starts, ["shard", "part"])
    return numbered.selectExpr(
        "doc_id", "size", "text_crc32", "shard", "grown_shard", "explode(sequence(start + before, start + before + n - 1)) AS slot"
    )


def digest(docs: DataFrame) -> DataFrame:
    return slots(docs).selectExpr("doc_id", "size", "text_crc32", "'key' AS law", "shard", "slot", "grown_shard")


def _oracle() -> str:
    step = lambda c: f"xor(({c}) >> 1, 3988292384 * (({c}) & 1))"
    table = "SELECT range AS n, CAST(range AS BIGINT) AS c FROM range(256)"
    for _ in range(8):
        table = f"SELECT n, {step('c')} AS c FROM ({table})"
    # every key's jumps as rows; the state runs modulo 2^64
    return f"""
        WITH RECURSIVE crc AS (SELECT list(c ORDER BY n) AS t FROM ({table})),
        docs AS (SELECT doc_id, strlen(coalesce(text, '')) + {OVERHEAD} AS size,
            xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
              lambda h: CAST('0x' || h AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
          FROM documents, crc),
        keys AS (SELECT DISTINCT doc_id, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        jumps(doc_id, state, b, j) AS (
          SELECT doc_id, CAST('0x' || substr(h, 1, 16) AS HUGEINT), -1::BIGINT, 0::BIGINT FROM keys
          UNION ALL
          SELECT doc_id, s, j, CAST(floor((j + 1) * (2147483648::DOUBLE / CAST((s // 8589934592) + 1 AS DOUBLE))) AS BIGINT)
          FROM (SELECT *, CAST((CAST(state // 4294967296 AS HUGEINT) * {_LOW} % 4294967296 * 4294967296 + state % 4294967296 * {_LOW}
            + state % 4294967296 * {_HIGH} % 4294967296 * 4294967296 + 1) % 18446744073709551616 AS HUGEINT) AS s FROM jumps WHERE j <= {SHARDS})),
        placed AS (SELECT doc_id, CAST(max(b) FILTER (b < {SHARDS}) AS INTEGER) AS shard, CAST(max(b) AS INTEGER) AS grown_shard
          FROM jumps GROUP BY doc_id),
        dealt AS (SELECT d.*, shard, grown_shard, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS low,
            (row_number() OVER (PARTITION BY d.doc_id, size, text_crc32) - 1) // {BLOCK} AS block
          FROM docs d JOIN placed p ON p.doc_id IS NOT DISTINCT FROM d.doc_id JOIN keys k ON k.doc_id IS NOT DISTINCT FROM d.doc_id)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard, row_number() OVER (PARTITION BY shard
          ORDER BY (low + text_crc32 + block) % {PARTS}, doc_id NULLS FIRST, size, text_crc32, block) - 1 AS slot FROM dealt"""


ORACLE = _oracle()
