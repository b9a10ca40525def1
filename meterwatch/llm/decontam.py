"""Benchmark decontamination: a hash set of test n-grams, scanned by windows of words, verified word by word.

The hashes of the benchmark's windows become one bucketed array, which a scalar subquery hands to every task. Its size
is checked: a benchmark of more than `block` windows is scanned in as many passes as it has blocks. Hits alone leave
the scan; they are joined with the benchmark on the words themselves, so that equal hashes of different words don't count.

Defined cases: null and empty texts have no words and no hits; equal rows each get their result; a benchmark without
words hits nothing; repeated items count once; extra columns of any name pass through `remove`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import let, lower_ascii, row_key, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text as it is written, with capitals.
WRITTEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
BLOCK = 200_000
BUCKETS = 1 << 14


def words(text: str) -> str:
    return f"regexp_extract_all({lower_ascii(f'''coalesce({text}, '')''')}, r'{WORD}', 0)"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: length, hash, joined words, and the ids of the items that hold it."""
    items = benchmark.selectExpr("cast(item_id AS string) AS item_id", f"{words('text')} AS ws").where("size(ws) > 0")
    spread = items.selectExpr(
        "item_id", "ws", f"least(size(ws), {window}) AS n", f"explode(sequence(1, size(ws) - least(size(ws), {window}) + 1)) AS at"
    )
    return (
        spread.selectExpr("item_id", "n", "slice(ws, at, n) AS ws")
        .selectExpr("item_id", "n", "xxhash64(ws) AS h", "array_join(ws, ' ') AS window")
        .groupBy("n", "h", "window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )


def _hash_set(windows: DataFrame) -> DataFrame:
    """One row: the window lengths, and the hashes in BUCKETS buckets by upper bits, as blocks take the lower ones."""
    spark = windows.sparkSession
    held = windows.groupBy(F.expr(f"pmod(shiftright(h, 32), {BUCKETS})").alias("b")).agg(F.collect_set("h").alias("hs"))
    every = spark.range(BUCKETS).join(held, F.col("id") == F.col("b"), "left")
    buckets = every.agg(F.expr("transform(sort_array(collect_list(struct(id, hs))), x -> coalesce(x.hs, array()))").alias("buckets"))
    return spark.sql(
        "SELECT struct(buckets, (SELECT sort_array(collect_set(n)) FROM {windows}) AS lens) AS held FROM {buckets}",
        buckets=buckets, windows=windows,
    )


def _scan(docs: DataFrame, held: DataFrame, block: int) -> DataFrame:
    """n_words and the candidate windows (place, length, words) of every document, in one pass."""
    known = f"array_contains(element_at(g.buckets, cast(pmod(shiftright(h, 32), {BUCKETS}) AS int) + 1), h)"
    places = (
        "if(size(ws) < n, cast(array() AS array<int>), filter(sequence(1, size(ws) - n + 1), "
        f"at -> exists(array(xxhash64(slice(ws, at, n))), h -> {known})))"
    )
    hits = f"flatten(transform(g.lens, n -> transform({places}, at -> struct(at, n, array_join(slice(ws, at, n), ' ') AS window))))"
    body = let("held", "g", let(words("text"), "ws", f"struct(size(ws) AS n_words, {hits} AS hits)"))
    return docs.sparkSession.sql(
        f"SELECT doc_id, key, {block} AS block, {body} AS s FROM (SELECT *, (SELECT held FROM {{held}}) AS held FROM {{docs}})",
        docs=docs, held=held,
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per row of `docs`: doc_id, key, n_words, places of hit words (at, last; from 1, inclusive; sorted), items."""
    windows = stored(benchmark_windows(benchmark, window), "benchmark-windows")
    blocks = max(1, -(-windows.count() // block))
    keyed = docs.select("doc_id", row_key().alias("key"), "text")
    parts = [_scan(keyed, _hash_set(windows.where(f"pmod(h, {blocks}) = {i}")), i) for i in range(blocks)]
    scanned = stored(reduce(DataFrame.unionAll, parts), "benchmark-scan")
    verified = (
        scanned.where("size(s.hits) > 0").selectExpr("doc_id", "key", "inline(s.hits)")
        .join(windows.select("window", "n", "items"), ["window", "n"])
        .groupBy("doc_id", "key")
        .agg(
            F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("n") - 1).alias("last")))).alias("places"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .withColumnsRenamed({"doc_id": "hit_id", "key": "hit_key"})
    )
    every = scanned.where("block = 0").selectExpr("doc_id", "key", "s.n_words")
    return every.join(verified, F.expr("key = hit_key AND doc_id <=> hit_id"), "left").drop("hit_id", "hit_key")


#: Words under any of the sorted places.
COVERED = (
    "aggregate(places, struct(0 AS upto, 0L AS n), (a, x) -> struct(greatest(a.upto, x.last) AS upto, "
    "a.n + greatest(x.last - greatest(a.upto, x.at - 1), 0) AS n), a -> a.n)"
)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The counts and digests of the registered query."""
    return contamination(docs, benchmark).selectExpr(
        "doc_id", "cast(n_words AS bigint) AS n_words", f"coalesce({COVERED}, 0L) AS n_hit",
        "cast(coalesce(size(items), 0) AS bigint) AS n_items",
        "sha2(coalesce(array_join(items, ','), ''), 256) AS items_sha256", "places IS NOT NULL AS contaminated",
    )


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Drop every document that holds a window of the benchmark; the rest stays as it is."""
    hit = contamination(docs, benchmark, window).where("places IS NOT NULL").selectExpr("doc_id AS _llm_hit_id", "key AS _llm_hit_key")
    keyed = docs.withColumn("_llm_key", row_key())
    return keyed.join(hit, F.expr("_llm_key = _llm_hit_key AND doc_id <=> _llm_hit_id"), "left_anti").drop("_llm_key")


def cut_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Keep the documents but take every hit word, with what lies between hit words, out of the text."""
    hit = contamination(docs, benchmark, window).where("places IS NOT NULL").selectExpr(
        "doc_id AS _llm_hit_id", "key AS _llm_hit_key", "places AS _llm_places"
    )
    keyed = docs.withColumn("_llm_key", row_key()).join(
        hit.dropDuplicates(["_llm_hit_id", "_llm_hit_key"]), F.expr("_llm_key = _llm_hit_key AND doc_id <=> _llm_hit_id"), "left"
    )
    # gaps and words alternate: gap 1, word 1, gap 2, ...; a gap goes with the word after it
    pieces = f"zip_with(split(text, r'{WRITTEN}', -1), regexp_extract_all(text, r'{WRITTEN}', 0), (g, w) -> struct(g, coalesce(w, '') AS w))"
    # places that overlap or touch are one stretch
    stretches = (
        "aggregate(_llm_places, cast(array() AS array<struct<at:int,last:int>>), (a, x) -> if(size(a) > 0 AND x.at <= element_at(a, -1).last + 1, "
        "concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).at AS at, greatest(element_at(a, -1).last, x.last) AS last))), "
        "concat(a, array(struct(x.at AS at, x.last AS last)))))"
    )
    joined = lambda words: f"array_join(transform({words}, x -> concat(x.g, x.w)), '')"
    upto = "if(k = 0, 0, ss[k - 1].last)"
    before = f"concat({joined(f'slice(ps, {upto} + 1, s.at - {upto} - 1)')}, ps[s.at - 1].g)"
    rest = joined("slice(ps, ss[size(ss) - 1].last + 1, size(ps))")
    whole = let(pieces, "ps", let(stretches, "ss", f"concat(array_join(transform(ss, (s, k) -> {before}), ''), {rest})"))
    return keyed.withColumn("text", F.expr(f"if(_llm_places IS NULL, text, {whole})")).drop("_llm_key", "_llm_hit_id", "_llm_hit_key", "_llm_places")
