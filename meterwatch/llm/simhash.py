"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in at most `max_bits` bits are found on distinct fingerprints. A fingerprint is cut into
max_bits // 2 + 1 segments, of which two near fingerprints have one that differs by at most one bit. Every segment is
indexed once for each of its bits with that bit cleared (a wildcard); an equality join on these variants proposes pairs,
and a bit count over the whole fingerprint verifies them. A pair is taken at its first common variant alone.

A variant that more than `hot` distinct fingerprints share isn't paired. Its fingerprints go into the balls of radius
one around every value: two of them are linked if and only if a common value is within one bit of both, and a ball has at
most 65 members whatever the data, all linked to each other, so that links to its least member suffice. Components come
from alternating large-star and small-star steps over stored edges.

Defined cases: null, empty and blank texts have the fingerprint zero and are linked like any other; copies share a
fingerprint; a component of rows without ids has no id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwatch.llm.common import lean, row_key, stored

SHINGLE, MAX_BITS, HOT = 3, 2, 64
SEED = 42
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit j is set if more than half of the shingles' hashes have it; as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        stop = min(at + (1 << 16), n)
        spans = zip(starts[at:stop].tolist(), ends[at + k - 1 : stop + k - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The columns `keep` and fp (signed 64-bit) of every document."""

    def of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in rows:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.int64())], names=names)

    names = [*[f"k{i}" for i in range(len(keep))], "fp"]
    shape = T.StructType([*[T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, keep, strict=False)], T.StructField("fp", T.LongType())])
    picked = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, keep, strict=False)], F.col(f"`{text}`").alias("text"))
    return picked.mapInArrow(of, shape).toDF(*keep, "fp")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def variants(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, tag (segment and wildcard), rest (the segment with the wildcard's bit cleared)."""
    made = []
    for first, width in _segments(max_bits):
        part = f"(shiftrightunsigned(fp, {first}) & {(1 << width) - 1 if width < 64 else -1}L)"
        made.append(f"transform(sequence(0, {width - 1}), j -> struct({first} + j AS tag, {part} & ~shiftleft(1L, j) AS rest))")
    return fps.selectExpr("fp", f"inline(concat({', '.join(made)}))")


def _first_common(max_bits: int) -> str:
    """SQL over `x`, the exclusive or of a pair: the tag of its first common variant."""
    cases = []
    for first, width in _segments(max_bits):
        part = f"(shiftrightunsigned(x, {first}) & {(1 << width) - 1 if width < 64 else -1}L)"
        cases.append(f"WHEN bit_count({part}) = 0 THEN {first} WHEN bit_count({part}) = 1 THEN {first} + coalesce(bit_count(try_subtract({part}, 1L)), 63)")
    return f"CASE {' '.join(cases)} END"


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """Edges (u, v) between distinct fingerprints, u < v: enough of them for the components of all links."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    # each fingerprint becomes 64 variants: spread right before, as a scan packs small files together
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = variants(fps.repartition(parts, "fp"), max_bits)
    shared = index.groupBy("tag", "rest").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(index.join(shared, ["tag", "rest"]), "simhash-variants")
    cold = members.where(f"n <= {hot}").drop("n")
    pairs = (
        cold.withColumnRenamed("fp", "u").join(cold.withColumnRenamed("fp", "v"), ["tag", "rest"]).where("u < v")
        .withColumn("x", F.expr("u ^ v")).where(f"bit_count(x) <= {max_bits} AND tag = {_first_common(max_bits)}").select("u", "v")
    )
    if max_bits < 2:
        return pairs  # one segment: a variant has two members at most
    crowded = members.where(f"n > {hot}").select("fp").distinct()
    balls = crowded.selectExpr("fp", "explode(concat(array(fp), transform(sequence(0, 63), j -> fp ^ shiftleft(1L, j)))) AS centre")
    stars = balls.groupBy("centre").agg(F.collect_set("fp").alias("near")).where("size(near) > 1")
    spokes = stars.selectExpr("array_min(near) AS u", "explode(near) AS v").where("u < v").distinct()
    return pairs.unionAll(spokes)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of each component that has edges."""
    edges = stored(edges.select("u", "v").distinct(), "component-edges")
    print_of = lambda df: df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
    seen = print_of(edges)
    while seen[0]:
        both = edges.unionAll(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.expr("least(u, min(v))").alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("m AS u", "v").where("u < v").distinct()
        # small star: a node's smaller neighbours, and the node itself, move to the least of them
        head = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(head, "v").where("u > m").selectExpr("m AS u", "u AS v").unionAll(head.selectExpr("m AS u", "v")).distinct()
        edges = stored(small, "component-edges")
        now = print_of(edges)
        if now == seen:
            break
        seen = now
    return edges.selectExpr("v AS node", "u AS root")


def classes(marked: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """fp, root: the component of every distinct fingerprint of a stored frame."""
    fps = stored(marked.select("fp").distinct(), "simhash-classes")
    found = components(links(fps, max_bits, hot))
    return fps.join(found, F.expr("fp = node"), "left").selectExpr("fp", "coalesce(root, fp) AS root")


def near_duplicates(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT
) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable) of every document."""
    marked = stored(fingerprints(docs, ("doc_id",), text, shingle), "simhash-fingerprints")
    rooted = stored(classes(marked, max_bits, hot), "simhash-roots")
    ids = marked.groupBy("fp").agg(F.min("doc_id").alias("id")).join(rooted, "fp").groupBy("root").agg(F.min("id").alias("component_id"))
    return marked.join(rooted.join(ids, "root").select("fp", "component_id"), "fp")


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Keep one document of each component: the one with the least id (rows without an id come last, equal ids in the
    order of a hash of their text). Rows that repeat id and text stay once."""
    keyed = docs.withColumn("_llm_key", row_key())
    marked = stored(fingerprints(keyed, ("doc_id", "_llm_key"), "text", shingle), "simhash-fingerprints")
    rooted = classes(marked, max_bits)
    first = F.min(F.expr("struct(doc_id IS NULL AS last, doc_id, _llm_key AS key)")).alias("w")
    best = marked.groupBy("fp").agg(first).join(rooted, "fp").groupBy("root").agg(F.min("w").alias("w"))
    winners = best.selectExpr("w.doc_id AS _llm_win_id", "w.key AS _llm_win_key")
    kept = keyed.join(winners, F.expr("_llm_key = _llm_win_key AND doc_id <=> _llm_win_id"), "left_semi")
    return kept.dropDuplicates(["_llm_key", "doc_id"]).drop("_llm_key")
