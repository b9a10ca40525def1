"""Language identification by partial matching over bytes.

Each language has a context tree of orders 2, 1 and 0 with frozen counts: n(context, byte). The code of a byte under the
longest known context is n / (n + d), with d the number of different bytes seen there; an unseen byte costs the escape
d / (n + d) and goes to the next shorter context, at last to 1/256. A text's language is the one of shortest code.

Counting reduces a bounded sample of labelled documents to (language, context, byte) counts in Spark. As the counts are
frozen, the exact code length of every context and byte is one number in a table. Bytes that no language has seen cost
the same everywhere and share a row. Texts are scored whole, in numpy, batch by batch.

Defined cases: a null text, or one without any letter, is `und` with score 0; rows without a language don't teach; with
no labelled row every text is `und`; equal code lengths go to the language first in order; equal rows score equally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import id_rest

#: Whole documents that each language is learned from, at most about (those with the smallest hashes of text and id).
SAMPLE = 4_000
UNKNOWN = "und"
_CHUNK = 1 << 20


def _codes(text: str, classes: np.ndarray, start: int) -> np.ndarray:
    """Byte classes after two start marks."""
    return np.concatenate([[start, start], classes[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]])


def learn_counts(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """lang, key (two context symbols and a byte; 256 marks the start), n."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.expr("xxhash64(doc_id, text) & 1048575").alias("h"))
    share = known.groupBy("lang").agg(F.expr(f"least(1048576, ceil(1048576D * {sample} / count(*)))").alias("below"))
    picked = known.join(F.broadcast(share), "lang").where("h < below").select("lang", "text")

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.arange(256, dtype=np.int64)
        for batch in rows:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                texts = [t.as_py() for t, same in zip(batch.column(1), langs == lang, strict=True) if same]
                keys = [((c := _codes(t, classes, 256))[:-2] << 18) | (c[1:-1] << 9) | c[2:] for t in texts]
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n)], names=["lang", "key", "n"])

    return picked.mapInArrow(count, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def code_table(counts: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages; class of each byte; bits by (context, class) and language. At most 257 * 257 * 257 rows."""
    langs = sorted(set(counts.column("lang").to_pylist()))
    keys, n = counts.column("key").to_numpy(), counts.column("n").to_numpy().astype(np.float64)
    of = np.array([langs.index(x) for x in counts.column("lang").to_pylist()], np.int64)
    seen = np.unique(keys & 511)
    classes = np.full(257, len(seen), np.int64)  # the class after the seen ones: new bytes
    classes[seen] = np.arange(len(seen))
    start, size = len(seen) + 1, len(seen) + 2
    classes[256] = start
    a, b, c = classes[keys >> 18], classes[(keys >> 9) & 511], classes[keys & 511]
    table = np.empty((size, size, size, len(langs)), np.float32)
    for i in range(len(langs)):
        mine = of == i
        tree = np.zeros((size, size, size))
        np.add.at(tree, (a[mine], b[mine], c[mine]), n[mine])
        p = np.full(size, 1 / 256)
        for counted in (tree.sum(axis=(0, 1)), tree.sum(axis=0), tree):
            whole, kinds = counted.sum(axis=-1, keepdims=True), (counted > 0).sum(axis=-1, keepdims=True)
            here = np.where(counted > 0, counted, kinds * p) / np.maximum(whole + kinds, 1)
            p = np.where(whole > 0, here, np.broadcast_to(p, counted.shape))
        table[..., i] = -np.log2(p)
    return langs, classes, table.reshape(size**3, len(langs))


def predict(docs: DataFrame, training: DataFrame, keep: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE) -> DataFrame:
    """The columns `keep`, lang_pred, score (posterior of the language under equal priors) and bits_per_byte."""
    spark = docs.sparkSession
    langs, classes, table = code_table(learn_counts(training, sample).toArrow())
    held = spark.sparkContext.broadcast((classes, table))  # bounded: 257 ** 3 numbers a language
    marked = docs.select(*[F.col(f"`{c}`") for c in keep], F.expr("if(text RLIKE r'\\p{L}', text, NULL)").alias("_llm_text"))

    def lengths(text: str, classes: np.ndarray, table: np.ndarray) -> np.ndarray:
        size = round(len(table) ** (1 / 3))
        codes, total = _codes(text, classes, size - 1), np.zeros(table.shape[1])
        for at in range(0, len(codes) - 2, _CHUNK):
            c = codes[at : at + _CHUNK + 2]
            total += table[(c[:-2] * size + c[1:-1]) * size + c[2:]].sum(axis=0, dtype=np.float64)
        return total

    def judge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, table = held.value
        for batch in rows:
            names, scores, rates = [], [], []
            for text in batch.column(batch.num_columns - 1):
                if not text.is_valid or not langs:
                    names.append(UNKNOWN), scores.append(0.0), rates.append(None)
                    continue
                bits = lengths(text.as_py(), classes, table)
                best = int(bits.argmin())
                names.append(langs[best]), scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
                rates.append(float(bits[best] / len(text.as_buffer())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                names=[*keep, "lang_pred", "score", "bits_per_byte"],
            )

    shape = marked.drop("_llm_text").schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    return marked.mapInArrow(judge, shape)


def digest(docs: DataFrame) -> DataFrame:
    marked = docs.withColumn("held_out", id_rest(4) == 2)
    return predict(marked, marked.where("NOT held_out"), ("doc_id", "held_out"))
