"""Prefix trie of conversations: ternary search trees over dictionary-encoded turns, one per range of sequences.

1. Dictionary. Distinct (role, text) turns get ids that rise with role and text. Turns look their id up by the SHA-256 of role
   and text; a turn that holds over 1/1000 of all rows (there are fewer than 1000) is looked up in a broadcast table, all
   others in a shuffled one, so that a very common turn does not land in one task.
2. Sequences. A conversation is its ids by turn (null first; ties by role, then text). Equal sequences become one row with
   the number of their conversations, the least id, and the hash over all ids, which streams over sorted parts of 256 ids.
3. Shards. Sequences are dealt over ranges of about `shard_turns` turns and kept in order. A shard builds its ternary search
   tree by inserting medians first: `low` and `high` lead to siblings, `down` to the next turn, so each tree node is a node of
   the trie. Walking the nodes backwards in order of creation, without recursion, adds members, leaves and savings up.
4. Borders. Nodes that two neighbouring shards share are the common prefixes of one's last and the other's first sequence.
   They are returned with their parts alone, merged by key (a hash chain over the ids), and their subtrees are added
   along their paths; children of shared nodes then learn their parent's id within their shard.

Defined cases: rows without a conversation id belong to no conversation and are left out; null role or text is empty; a
null turn comes first; repeated rows are turns of their own; an empty table has no nodes, not even a root; other columns are
ignored. A conversation's ids (8 bytes a turn) must fit one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import lean, let, stored

SHARD_TURNS, HOT_SHARE, CHUNK_BITS = 20_000, 1000, 8
#: Contract of the query: conversations in groups of FAMILY take up to HEADS - 1 turns of the first of their group.
FAMILY, HEADS = 5, 9
EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = {
    "shard": pa.int32(), "shared": pa.bool_(), "key": pa.string(), "parent_key": pa.string(), "path": pa.list_(pa.string()), "depth": pa.int64(),
    "turn_id": pa.int64(), "size": pa.int64(), "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "saved": pa.int64(), "ends": pa.string(),
}
_NODE_SCHEMA = (
    "shard int, shared boolean, key string, parent_key string, path array<string>, depth long, turn_id long, size long, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"
)


def encode(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations as (conv_id, ids, sizes) and the dictionary as (id, role, text, digest, size, n)."""
    rows = conversations.where("conv_id IS NOT NULL").selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text"
    )
    distinct = rows.groupBy("role", "text").agg(F.count("*").alias("n")).repartitionByRange("role", "text").sortWithinPartitions("role", "text")
    digest = "unhex(sha2(concat(octet_length(role), ':', role, text), 256)) AS digest"
    turns = stored(distinct.selectExpr(
        "monotonically_increasing_id() AS id", "role", "text", digest, "octet_length(text) AS size", "n"
    ), "trie-turns")
    total = turns.agg(F.sum("n")).first()[0] or 0
    common = turns.where(F.col("n") * HOT_SHARE > total)
    marked = stored(rows.selectExpr("conv_id", "turn", digest).join(
        F.broadcast(common.selectExpr("digest", "id", "size")), "digest", "left"
    ), "trie-marked")
    rare = marked.where("id IS NULL").drop("id", "size").join(turns.selectExpr("digest", "id", "size"), "digest")
    known = marked.where("id IS NOT NULL").unionByName(rare)
    ordered = known.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "size"))).alias("turns"))
    return ordered.selectExpr("conv_id", "turns.id AS ids", "turns.size AS sizes"), turns


def grafted(convs: DataFrame) -> DataFrame:
    """Every conversation behind the first turns of the first of its group: h = crc32(id) % HEADS of them, for its own first h."""
    own = stored(convs.selectExpr("*", f"CAST(pmod(crc32(CAST(CAST(conv_id AS STRING) AS BINARY)), {HEADS}) AS INT) AS h"), "trie-conversations")
    heads = own.selectExpr("conv_id AS head_id", f"slice(ids, 1, {HEADS - 1}) AS head_ids", f"slice(sizes, 1, {HEADS - 1}) AS head_sizes")
    both = own.join(heads, F.expr(f"head_id = conv_id - pmod(conv_id, {FAMILY})"), "left")
    put = lambda c: (
        f"concat(coalesce(slice(head_{c}, 1, h), slice({c}, 1, 0)), slice({c}, h + 1, greatest(size({c}) - h, 0))) AS {c}"
    )
    return both.selectExpr("conv_id", put("ids"), put("sizes"))


def sequences(convs: DataFrame) -> DataFrame:
    """ids, sizes, n, least and ends of every distinct sequence; `ends` hashes its conversations' ids, rising and comma-joined."""
    keyed = convs.selectExpr("*", "sha2(CAST(array_join(transform(ids, x -> CAST(x AS STRING)), ',') AS BINARY), 256) AS key")
    # at most 2 ** CHUNK_BITS conversations a row
    parts = keyed.groupBy("key", F.expr(f"shiftright(conv_id, {CHUNK_BITS})").alias("chunk")).agg(
        F.any_value("ids").alias("ids"), F.any_value("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
        F.expr("array_join(transform(sort_array(collect_list(conv_id)), x -> CAST(x AS STRING)), ',')").alias("part"),
    )

    def of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        key, open_row, done = None, None, []
        for batch in rows:
            for i, (now, n, least, part) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "n", "least", "part")), strict=True)):
                if now == key:
                    open_row[2] += n
                    open_row[3] = min(open_row[3], least)
                    open_row[4].update(b"," + part.encode())
                    continue
                if open_row:
                    done.append(open_row)
                key, open_row = now, [batch.column("ids").slice(i, 1), batch.column("sizes").slice(i, 1), n, least, hashlib.sha256(part.encode())]
            yield from out(done)
            done = []
        yield from out([open_row] if open_row else [])

    def out(done: list[list]) -> Iterator[pa.RecordBatch]:
        if done:
            ids, sizes, n, least, hashes = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.concat_arrays(sizes), pa.array(n), pa.array(least), pa.array([h.hexdigest() for h in hashes])],
                names=["ids", "sizes", "n", "least", "ends"],
            )

    in_order = parts.repartition("key").sortWithinPartitions("key", "chunk")
    return in_order.mapInArrow(of, "ids array<long>, sizes array<int>, n long, least long, ends string")


class Tree:
    """A ternary search tree over sequences of ids; node 0 is the empty prefix."""

    def __init__(self) -> None:
        self.key, self.low, self.high, self.down, self.up, self.size, self.end = [None], [-1], [-1], [-1], [-1], [0], [-1]

    def _new(self, key: int, up: int, size: int) -> int:
        for column, value in ((self.key, key), (self.low, -1), (self.high, -1), (self.down, -1), (self.up, up), (self.size, size), (self.end, -1)):
            column.append(value)
        return len(self.key) - 1

    def insert(self, ids: list[int], sizes: list[int], row: int) -> None:
        key, low, high, down = self.key, self.low, self.high, self.down
        node = 0
        for wanted, size in zip(ids, sizes, strict=True):
            at = down[node]
            if at < 0:
                at = down[node] = self._new(wanted, node, size)
            while key[at] != wanted:
                side = low if wanted < key[at] else high
                if side[at] < 0:
                    side[at] = self._new(wanted, node, size)
                at = side[at]
            node = at
        self.end[node] = row

    def path(self, ids: list[int], depth: int) -> Iterator[int]:
        """The nodes of the first `depth` turns of a sequence, the empty prefix first."""
        node = 0
        yield node
        for wanted in ids[:depth]:
            node = self.down[node]
            while self.key[node] != wanted:
                node = self.low[node] if wanted < self.key[node] else self.high[node]
            yield node


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1 so that a search tree over sorted rows gets balanced."""
    waiting = [(0, n)]
    while waiting:
        a, b = waiting.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            waiting += [(middle + 1, b), (a, middle)]


def shard_nodes(shard: int, rows: list[tuple], before: int, after: int) -> pa.RecordBatch:
    """All nodes of a shard's sorted (ids, sizes, n, least, ends); those shared with its neighbours hold their part alone."""
    tree = Tree()
    for i in medians_first(len(rows)):
        tree.insert(rows[i][0], rows[i][1], i)
    total = len(tree.key)
    paths = [list(tree.path(rows[0][0], before)), list(tree.path(rows[-1][0], after))]
    shared = bytearray(total)
    chain: dict[int, list[str]] = {}
    for path in paths:
        keys: list[str] = []
        for node in path:
            shared[node] = 1
            if node:
                keys = [*keys, hashlib.sha256(f"{keys[-1]},{tree.key[node]}".encode()).hexdigest()]
            else:
                keys = [""]
            chain[node] = keys
    n, least, children, leaves, saved = [0] * total, [None] * total, [0] * total, [0] * total, [0] * total
    for node in range(total - 1, -1, -1):  # every node after those below it
        if tree.end[node] >= 0:
            _, _, more, own, _ = rows[tree.end[node]]
            n[node] += more
            least[node] = own if least[node] is None else min(own, least[node])
        up = tree.up[node]
        if not shared[node]:
            leaves[node] += not children[node]
            saved[node] += (n[node] - 1) * tree.size[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        if node:
            n[up] += n[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
    depth = [0] * total
    for node in range(1, total):
        depth[node] = depth[tree.up[node]] + 1
    above = [bool(node and shared[tree.up[node]]) for node in range(total)]
    columns = {
        "shard": [shard] * total, "shared": [bool(s) for s in shared],
        "key": [chain[v][-1] if shared[v] else None for v in range(total)],
        "parent_key": [chain[tree.up[v]][-1] if above[v] else None for v in range(total)],
        "path": [chain[v] if shared[v] else None for v in range(total)],
        "depth": depth, "turn_id": tree.key, "size": tree.size, "conv_id": least,
        "parent_conv_id": [least[tree.up[v]] if v and not above[v] else None for v in range(total)],
        "n_convs": n, "n_children": children, "n_leaves": leaves, "saved": saved,
        "ends": [rows[e][4] if e >= 0 else None for e in tree.end],
    }
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in _NODE.items()], names=list(_NODE))


def _common(a: str, b: str) -> str:
    """SQL: length of the common prefix of two arrays; 0 where one is missing."""
    found = f"array_position(zip_with(slice({a}, 1, m), slice({b}, 1, m), (x, y) -> x <> y), true)"
    return f"coalesce({let(f'least(size({a}), size({b}))', 'm', let(found, 'd', 'CAST(if(d = 0, m, d - 1) AS INT)'))}, 0)"


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every node of the trie of (conv_id, ids, sizes): its conversations' least id, depth, last turn, and figures."""
    distinct = stored(sequences(convs), "trie-sequences")
    shards = (distinct.agg(F.sum(F.size("ids") + 1)).first()[0] or 0) // shard_turns + 1
    dealt = distinct.repartitionByRange(shards, "ids").sortWithinPartitions("ids")
    dealt = stored(dealt.withColumn("shard", F.spark_partition_id()), "trie-shards")
    # one row a shard
    ends = dealt.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
    borders = ends.selectExpr("shard", "first", "last", "lag(last) OVER (ORDER BY shard) AS before", "lead(first) OVER (ORDER BY shard) AS after").selectExpr(
        "shard", f"{_common('first', 'before')} AS before", f"{_common('last', 'after')} AS after"
    )

    def of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        held, shard, before, after = [], None, 0, 0
        for batch in rows:
            values = [batch.column(c).to_pylist() for c in ("shard", "before", "after", "ids", "sizes", "n", "least", "ends")]
            for now, low, high, *row in zip(*values, strict=True):
                if now != shard and held:
                    yield shard_nodes(shard, held, before, after)
                    held = []
                shard, before, after = now, low, high
                held.append(tuple(row))
        if held:
            yield shard_nodes(shard, held, before, after)

    in_order = dealt.join(borders, "shard").repartition("shard").sortWithinPartitions("shard", "ids")
    nodes = stored(in_order.mapInArrow(of, _NODE_SCHEMA), "trie-nodes")

    shared, own = nodes.where("shared"), nodes.where("NOT shared")
    merged = shared.groupBy("key").agg(
        *[F.any_value(c).alias(c) for c in ("parent_key", "path", "depth", "turn_id", "size")], F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.max("ends").alias("ends"),
    )
    under = merged.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    whole = stored(merged.join(under, "key", "left").withColumn("n_children", F.expr("n_children + coalesce(more, 0L)")).drop("more"), "trie-shared")
    below = whole.selectExpr("explode(path) AS key", "n_leaves + int(n_children = 0) AS n_leaves", "saved + (n_convs - 1) * size AS saved")
    sums = below.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    parents = whole.selectExpr("key AS parent_key", "conv_id AS parent_conv_id")
    border = whole.drop("n_leaves", "saved").join(sums, "key").join(parents, "parent_key", "left")
    # a shared parent's id returns to its shards, so that its children join within their shard
    told = shared.select("shard", "key").join(parents, F.expr("key = parent_key")).select("shard", "parent_key", "parent_conv_id")
    children = own.where("parent_key IS NOT NULL").drop("parent_conv_id").join(told, ["shard", "parent_key"])
    picked = ("conv_id", "depth", "turn_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends")
    every = own.where("parent_key IS NULL").select(*picked).unionByName(children.select(*picked)).unionByName(border.select(*picked))
    return every.selectExpr(*picked[:7], "saved AS saved_tokens", f"coalesce(ends, '{EMPTY}') AS ends_sha256")


def digest(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    return trie(grafted(encode(conversations)[0]), shard_turns).drop("turn_id")


def _oracle() -> str:
    step = lambda c: f"xor(({c}) >> 1, 3988292384 * (({c}) & 1))"
    table = "SELECT range AS n, CAST(range AS BIGINT) AS c FROM range(256)"
    for _ in range(8):
        table = f"SELECT n, {step('c')} AS c FROM ({table})"
    return f"""
        WITH crc AS (SELECT list(c ORDER BY n) AS t FROM ({table})),
        turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
            coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        heads AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
              lambda d: CAST(ascii(d) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {HEADS} AS h
          FROM (SELECT DISTINCT conv_id FROM turns), crc),
        every AS (SELECT h.conv_id, i, role, text FROM heads h JOIN turns t ON t.conv_id = h.conv_id - h.conv_id % {FAMILY} AND i <= h
          UNION ALL SELECT t.conv_id, i, role, text FROM turns t JOIN heads h ON h.conv_id = t.conv_id AND i > h),
        lists AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY i) AS ts FROM every GROUP BY conv_id),
        whole AS (SELECT conv_id, coalesce(ts, []) AS ts FROM heads LEFT JOIN lists USING (conv_id)),
        spots AS (SELECT conv_id, unnest(range(0, len(ts) + 1)) AS depth, ts FROM whole),
        prefixes AS (SELECT conv_id, depth, list_slice(ts, 1, depth) AS p, list_slice(ts, 1, depth - 1) AS up, depth = len(ts) AS ends FROM spots),
        nodes AS (SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n, CASE WHEN depth > 0 THEN strlen(any_value(p[-1].t)) ELSE 0 END AS size,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
          FROM prefixes GROUP BY p, depth),
        kids AS (SELECT up, depth - 1 AS depth, count(DISTINCT p) AS k FROM prefixes WHERE depth > 0 GROUP BY ALL),
        full_nodes AS (SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN kids ON kids.up = n.p AND kids.depth = n.depth),
        below AS (SELECT list_slice(p, 1, d) AS p, sum(CAST(k = 0 AS BIGINT)) AS n_leaves, sum((n - 1) * size) AS saved
          FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_nodes) GROUP BY ALL)
        SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n AS n_convs, n.k AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
          CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM full_nodes n JOIN below b ON b.p = n.p LEFT JOIN nodes u ON n.depth > 0 AND u.p = list_slice(n.p, 1, n.depth - 1)"""


ORACLE = _oracle()
