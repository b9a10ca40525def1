"""The conversation trie against a plain dictionary of prefixes, at shard sizes from one turn to all."""

import collections
import hashlib
import random
import zlib

import pytest

from meterwatch.llm import trie


def rebuilt(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: tuple(own.get(c - c % 5, [])[: heads[c]] + turns[heads[c] :]) for c, turns in own.items()}


def expected(convs):
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, ids in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (min(ids), len(p), min(members[p[:-1]]) if p else -1, len(ids), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, ids in members.items()
    )


def rows(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in df.collect())


def talks():
    rng = random.Random(11)
    said = ["hello", "Hi é", "", None, "x" * 50, "why?"]
    data = []
    for c in rng.sample(range(2000), 150):
        first = [("user", "the common first turn")] if rng.random() < 0.5 else []
        turns = first + [(rng.choice(["user", "assistant", None]), rng.choice(said)) for _ in range(rng.randint(0, 9))]
        data += [(c, i if rng.random() < 0.95 else None, role, text) for i, (role, text) in enumerate(turns)]
    for c in range(3000, 3700):  # many equal conversations, over several parts of ids
        data += [(c, 0, "user", "copy"), (c, 1, "assistant", "copied")]
    data += [(c, i, "user", f"long {i}") for c in (5000, 5005) for i in range(300)] + [(5005, 300, "user", "end")]
    data += [(7, 0, "user", "twice")] * 2 + [(None, 0, "user", "nobody's"), (11, None, None, None)]
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("shard_turns", [1, 60, 20_000])
def test_as_a_dictionary_of_prefixes(spark, shard_turns):
    data = talks()
    given = spark.createDataFrame([(*r, 1, "k") for r in data], "conv_id long, turn long, role string, text string, id int, key string").repartition(4)
    assert rows(trie.digest(given, shard_turns)) == expected(rebuilt(data))


def test_empty_table_and_one_conversation(spark):
    shape = "conv_id long, turn long, role string, text string"
    assert trie.digest(spark.createDataFrame([], shape)).collect() == []
    lone = spark.createDataFrame([(3, 0, "user", "a")], shape)  # crc32 takes its only turn away, and no head replaces it
    assert rows(trie.digest(lone)) == expected(rebuilt([(3, 0, "user", "a")]))


def test_medians_balance_the_tree():
    assert sorted(trie.medians_first(1000)) == list(range(1000))
    tree = trie.Tree()
    for i in trie.medians_first(1000):
        tree.insert([i], [1], i)
    waiting, deepest = [tree.down[0]], 0
    while waiting:
        waiting = [n for at in waiting for n in (tree.low[at], tree.high[at]) if n >= 0]
        deepest += 1
    assert deepest <= 11
