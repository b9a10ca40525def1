"""Byte-level BPE encoding and decoding with a public rank file.

A batch of documents is reduced to its distinct words (matches of the split pattern) and the documents' word numbers.
Spark's higher-order functions then fold the ranked merges over each word's byte array: a step merges the leftmost pair
of lowest rank, looked up in a literal rank map. The documents' ids are a take over the words' ids; decoding concatenates
the pieces of the ids. All of it is narrow: nothing shuffles, and a lost task repeats alone. A batch holds about
`BATCH_BYTES` of text, and at least a document. Batches of a partition follow one another, so a batch folds only words that
those before it lack; both workers start afresh when the words held exceed `HELD_BYTES`.

The rank map is held as two arrays: rows of a table with one row for each left piece are laid over each other, so that
`shift[left] + right` is the slot of a pair. A slot holds the left piece of its pair in its upper half and the merged one
in its lower: exclusive or with the left piece at hand leaves a number below 2^32 for the slot's own pair alone.

Defined cases: a null or empty text has no ids and decodes to the empty text; equal rows are encoded each; an empty
table gives an empty table. Words of more than `FOLD_BYTES` bytes (unbroken runs) take the same merges in a heap.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwatch.llm.common import lean, let

BATCH_BYTES = 14 << 20
FOLD_BYTES = 200
#: Words, with their offsets, that are known from former batches of the partition.
HELD_BYTES = 16 << 20
#: Places in a word that goes through the fold; a power of two over FOLD_BYTES.
PLACES = 256
#: The left piece of a slot without a pair, and the rank of a pair without one.
_NOBODY = 1 << 30
#: A token within the fold is one number: rank of its pair with the next token, place in the word (8 bits), id (20 bits).
_ID = (1 << 20) - 1
#: White space as Unicode has it; Java's \s has ASCII alone.
_WHITE = r"\x09-\x0D\x20\x85\xA0  -     　"


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, lines))
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without a gap")
    return [piece for _, piece in ranked]


#: Letters and numbers, as code points, of Unicode 14 to 16, which the tokenizer's library knows and Java 17 does not.
LATER_LETTERS = (
    "870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 1C89-1C8A 2C2F 2C5F 9FFD-9FFF A7C0-A7C1 A7CB-A7CD A7D0-A7D1 A7D3 "
    "A7D5-A7DC A7F2-A7F4 10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC "
    "105C0-105F3 10780-10785 10787-107B0 107B2-107BA 10D4A-10D65 10D6F-10D85 10EC2-10EC4 10F70-10F81 11071-11072 11075 "
    "1123F-11240 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3 11740-11746 11AB0-11ABF 11BC0-11BE0 11F02 11F04-11F10 "
    "11F12-11F33 12F90-12FF0 1342F 13441-13446 13460-143FA 16100-1611D 16A70-16ABE 16D40-16D6C 18CFF 1AFF0-1AFF3 1AFF5-1AFFB "
    "1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D 1E290-1E2AD 1E4D0-1E4EB 1E5D0-1E5ED 1E5F0 "
    "1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE 2A6DE-2A6DF 2B735-2B739 2EBF0-2EE5D 31350-323AF"
)
LATER_NUMBERS = (
    "10D40-10D49 116D0-116E3 11BF0-11BF9 11F50-11F59 16130-16139 16AC0-16AC9 16D70-16D79 1CCF0-1CCF9 1D2C0-1D2D3 1E4F0-1E4F9 "
    "1E5F1-1E5FA"
)


def _later(ranges: str) -> str:
    """A class within a class for Java. The first range keeps common characters away from the long list."""
    points = [r.split("-") for r in ranges.split()]
    listed = "".join(f"\\x{{{r[0]}}}-\\x{{{r[-1]}}}" for r in points)
    return f"[\\x{{{points[0][0]}}}-\\x{{{points[-1][-1]}}}&&[{listed}]]"


def java_pattern(pattern: str) -> str:
    r"""The split pattern for Java: \s, \p{L} and \p{N} inside and outside classes as Unicode 16 has them."""
    pattern = pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"(?!\S)", f"(?![^{_WHITE}])").replace(r"\s+", f"[{_WHITE}]+")
    held = {r"\p{L}": r"\p{L}" + _later(LATER_LETTERS), r"\p{N}": r"\p{N}" + _later(LATER_NUMBERS)}
    # a class as it stands, or a property outside of one, which becomes a class
    return re.sub(
        r"\[[^\]]*\]|\\p\{[LN]\}",
        lambda m: f"[{held[m[0]]}]" if m[0] in held else m[0].replace(r"\p{L}", held[r"\p{L}"]).replace(r"\p{N}", held[r"\p{N}"]), pattern,
    )


def pair_ranks(pieces: list[bytes]) -> dict[int, dict[int, int]]:
    """left id -> right id -> id of the merged piece."""
    of, pairs = {piece: rank for rank, piece in enumerate(pieces)}, defaultdict(dict)
    for rank, piece in enumerate(pieces):
        for cut in range(1, len(piece)):
            left, right = of.get(piece[:cut]), of.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left][right] = rank
    return pairs


def rank_table(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """shift by left id; left id * 2^32 + merged id by slot."""
    n, pairs = len(pieces), pair_ranks(pieces)
    if n > _ID:
        raise ValueError("too many pieces")
    slots = 2 * sum(map(len, pairs.values())) + 4 * n
    shift, owner, merged = np.zeros(n, np.int32), np.full(slots, -1, np.int32), np.zeros(slots, np.int32)
    # as each shift is at least 0, any right id stays inside the table; each row's search starts at a place of its own
    for left, row in sorted(pairs.items(), key=lambda x: (-len(x[1]), x[0])):
        rights, room = np.fromiter(row, np.int64, len(row)), slots - n
        for start in range(0, room, 1024):
            tried = (left * 2_654_435_761 + start + np.arange(1024)) % room
            tried = tried[owner[tried + rights[0]] < 0]
            fits = ~(owner[tried[:, None] + rights] >= 0).any(axis=1)
            if fits.any():
                shift[left] = tried[fits.argmax()]
                break
        else:
            raise ValueError("the rank table is too small")
        owner[shift[left] + rights], merged[shift[left] + rights] = left, np.fromiter(row.values(), np.int64, len(row))
    return shift, np.where(owner < 0, _NOBODY, owner).astype(np.int64) << 32 | merged


def _rank_map(spark: SparkSession, pieces: list[bytes]) -> DataFrame:
    shift, slots = rank_table(pieces)
    columns = {"shift": pa.array([shift], pa.list_(pa.int32())), "slots": pa.array([slots], pa.list_(pa.int64()))}
    return spark.createDataFrame(pa.table(columns)).selectExpr("struct(shift, slots) AS m")


def _rank(left: str, right: str) -> str:
    """SQL: the rank of a pair of ids, in place; _NOBODY's if it has none or there is no right one."""
    return f"shiftleft(least(slots[shift[{left}] + {right}] ^ shiftleft({left}, 32), {_NOBODY}L), 28)"


def _fold(word: str) -> str:
    """SQL: the ids of one word from its byte ids, by merging the leftmost pair of lowest rank again and again.

    The least token is the leftmost one of lowest rank. It takes its pair's rank as id, its right neighbour goes, those behind
    move up a place, and only its own rank and that of its left neighbour are looked up anew.
    """
    start = f"transform({word}, (a, i) -> {_rank('CAST(a AS BIGINT)', f'get({word}, i + 1)')} | shiftleft(CAST(i AS BIGINT), 20) | a)"
    new, before = "shiftright(best, 28)", "get(acc, at - 1)"
    merged = f"{_rank(new, f'(get(acc, at + 2) & {_ID}L)')} | (best & {(PLACES - 1) << 20}L) | {new}"
    neighbour = f"{_rank(f'({before} & {_ID}L)', new)} | ({before} & {(1 << 28) - 1}L)"
    joined = let(
        f"CAST(shiftright(best, 20) & {PLACES - 1} AS INT)", "at",
        "transform(array_remove(acc, get(acc, at + 1)), "
        f"(x, i) -> if(i > at, x - {1 << 20}L, if(i = at, {merged}, if(i = at - 1, {neighbour}, x))))",
    )
    step = let("array_min(acc)", "best", f"if(best < {_NOBODY << 28}L, {joined}, acc)")
    return f"transform(aggregate(sequence(2, size({word})), {start}, (acc, s) -> {step}), x -> CAST(x & {_ID}L AS INT))"


def _heap_merge(word: bytes, of: dict[bytes, int]) -> list[int]:
    """The same merges for a very long word: pairs wait in a heap by rank, then place."""
    parts, after, before = [word[i : i + 1] for i in range(len(word))], [*range(1, len(word)), -1], [*range(-1, len(word) - 1)]
    heap: list[tuple[int, int, bytes, bytes]] = []

    def push(at: int) -> None:
        if at >= 0 and after[at] >= 0 and (rank := of.get(parts[at] + parts[after[at]])) is not None:
            heapq.heappush(heap, (rank, at, parts[at], parts[after[at]]))

    for at in range(len(word)):
        push(at)
    while heap:
        _, at, left, right = heapq.heappop(heap)
        if parts[at] != left or after[at] < 0 or parts[after[at]] != right:
            continue  # one of the two has been merged meanwhile
        gone = after[at]
        parts[at], parts[gone], after[at] = left + right, b"", after[gone]
        if after[at] >= 0:
            before[after[at]] = at
        push(before[at])
        push(at)
    return [of[p] for p in parts if p]


def _one(values: pa.Array) -> pa.ListArray:
    """A column of one row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def encode(
    docs: DataFrame, pieces: list[bytes], pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
    then: tuple[Step, T.StructType] | None = None,
) -> DataFrame:
    """The columns `keep` and ids (array of int) of every document; a column called ids must not be among them.

    `then` is a step over batches of these columns and the schema it returns; it runs in the workers that made them.
    """
    spark, of = docs.sparkSession, {piece: rank for rank, piece in enumerate(pieces)}
    byte_ids = np.array([of[bytes([b])] for b in range(256)], np.int32)
    kept = [f"k{i}" for i in range(len(keep))]
    fields = [docs.schema[c] for c in keep]
    split = docs.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)],
        F.expr(f"regexp_extract_all(coalesce(`{text}`, ''), r\"{java_pattern(pattern)}\", 0)").alias("words"),
    )

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        held = pa.array([], pa.binary())
        for batch in rows:  # a batch of Spark may hold much more than BATCH_BYTES: cut it into even parts
            upto = batch.column("words").offsets.to_numpy()
            words = batch.column("words").values
            places = np.frombuffer(words.buffers()[1], np.int32)[upto + words.offset].astype(np.int64) if len(words) else np.zeros(len(upto), np.int64)
            parts = max(1, -(-int(places[-1] - places[0]) // BATCH_BYTES))
            cuts = np.unique(np.searchsorted(places, places[0] + (places[-1] - places[0]) * np.arange(1, parts) // parts))
            cuts = [0, *[int(c) for c in cuts if 0 < c < batch.num_rows], batch.num_rows]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if stop > start:
                    made, held = packed(batch.slice(start, stop - start), held)
                    yield made

    def packed(whole: pa.RecordBatch, held: pa.Array) -> tuple[pa.RecordBatch, pa.Array]:
        """A batch as one row, with the words that are not held yet, and the words to hold from now on."""
        coded = whole.column("words").flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary())
        known = pc.index_in(words, value_set=held)
        new = known.is_null().to_numpy(zero_copy_only=False)
        numbers = np.where(new, len(held) + np.cumsum(new) - 1, pc.fill_null(known, 0).to_numpy()).astype(np.int32)
        places, words = numbers[coded.indices.to_numpy()], words.filter(pa.array(new))
        lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        listed = words.to_pylist()
        apart = (lengths > FOLD_BYTES) | np.array([w in of for w in listed], bool)  # very long, or a piece as it is: no fold
        long = np.flatnonzero(apart)
        joined = np.frombuffer(b"".join([w for w, a in zip(listed, apart.tolist(), strict=True) if not a]), np.uint8)
        starts = np.concatenate([[0], np.cumsum(np.where(apart, 0, lengths))])
        byte_lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(byte_ids[joined], pa.int32()))
        merged = pa.array([[of[w]] if (w := listed[i]) in of else _heap_merge(w, of) for i in long.tolist()], pa.list_(pa.int32()))
        made = pa.RecordBatch.from_arrays(
            [*[_one(whole.column(k)) for k in kept], _one(pc.list_value_length(whole.column("words"))), _one(pa.array(places, pa.int32())),
             _one(byte_lists), _one(pa.array(long, pa.int32())), _one(merged), _one(pa.array([len(held)], pa.int32()))],
            names=[*kept, "counts", "places", "words", "long", "long_ids", "held"],
        )
        return made, pa.concat_arrays([held, words]) if held.nbytes + words.nbytes <= HELD_BYTES else held[:0]

    ints = T.ArrayType(T.IntegerType())
    lists = [T.StructField(k, T.ArrayType(f.dataType)) for k, f in zip(kept, fields, strict=True)]
    shape = T.StructType([*lists, *[T.StructField(n, ints) for n in ("counts", "places")], T.StructField("words", T.ArrayType(ints)),
                          T.StructField("long", ints), T.StructField("long_ids", T.ArrayType(ints)), T.StructField("held", ints)])
    fold = f"transform(words, w -> if(size(w) < 2, w, {_fold('w')}))"
    for name in ("slots", "shift"):
        fold = let(f"m.{name}", name, fold)
    folded = spark.sql(
        f"SELECT * EXCEPT (words, m), {fold} AS words "
        "FROM (SELECT *, (SELECT m FROM {ranks}) AS m FROM {batches})",
        ranks=_rank_map(spark, pieces), batches=split.mapInArrow(batches, shape),
    )

    def spread(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        held = None
        for batch in rows:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].values for n in batch.schema.names}
                words = row["words"]
                if len(row["long"]):
                    order = np.arange(len(words))
                    order[row["long"].to_numpy()] = len(words) + np.arange(len(row["long"]))
                    words = pa.concat_arrays([words, row["long_ids"].cast(words.type)]).take(pa.array(order))
                before = row["held"][0].as_py()
                if before != (len(held) if before else 0):
                    raise RuntimeError("the batches of a partition came in another order")
                words = held = pa.concat_arrays([held if before else words[:0], words])
                sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
                places, counts = row["places"].to_numpy(), row["counts"].to_numpy()
                upto = np.concatenate([[0], np.cumsum(sizes[places], dtype=np.int64)])
                docs_upto = upto[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
                docs_words = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                for start in range(0, len(counts), 512):
                    stop = min(start + 512, len(counts))
                    ids = words.take(pa.array(places[docs_words[start] : docs_words[stop]])).flatten()
                    listed = pa.ListArray.from_arrays(pa.array(docs_upto[start : stop + 1] - docs_upto[start], pa.int32()), ids)
                    yield pa.RecordBatch.from_arrays([*[row[k].slice(start, stop - start) for k in kept], listed], names=[*keep, "ids"])

    if then:
        return folded.mapInArrow(lambda rows: then[0](spread(rows)), then[1])
    return folded.mapInArrow(spread, T.StructType([*fields, T.StructField("ids", ints)]))



def _decoder(pieces: list[bytes], ids: str, output: str) -> Step:
    def joined(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.array(pieces, pa.large_binary())
        for batch in rows:
            lists = batch.column(ids)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            taken = held.take(lists.flatten())  # its bytes lie one after another, document by document
            ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
            upto = ends[np.concatenate([[0], np.cumsum(lengths)])]
            texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(upto.copy()), taken.buffers()[2]])
            yield pa.RecordBatch.from_arrays([*batch.columns, texts.cast(pa.binary())], names=[*batch.schema.names, output])

    return joined


def decode(tokens: DataFrame, pieces: list[bytes], ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for: their pieces, concatenated. Null ids give the empty text."""
    kept = [c for c in tokens.columns if c.lower() != output.lower()]
    shape = T.StructType([*[tokens.schema[c] for c in kept], T.StructField(output, T.BinaryType())])
    return tokens.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(_decoder(pieces, ids, output), shape)


def digest(docs: DataFrame, pieces: list[bytes], pattern: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """The columns `keep` with number and digest of the ids and digest of the decoded bytes; on demand the ids as well."""
    decoder = _decoder(pieces, "ids", "decoded")

    def digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decoder(rows):
            ids, texts = batch.column("ids"), batch.column("decoded")
            flat, upto = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
            hashed = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(upto[:-1], upto[1:], strict=True)]
            columns = [
                *batch.columns[: len(keep)], pc.list_value_length(ids).cast(pa.int64()), pa.array(hashed, pa.string()),
                pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in texts], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*columns, ids] if with_ids else columns, names=shape.names)

    shape = T.StructType([*[docs.schema[c] for c in keep], T.StructField("n_tokens", T.LongType()),
                          T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        shape = shape.add("ids", T.ArrayType(T.IntegerType()))
    return encode(docs, pieces, pattern, keep, then=(digests, shape))
