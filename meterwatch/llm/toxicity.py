"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled documents teaches three things in turn: a lexicon (words and beginnings of words far more
frequent in toxic documents than in others), trees over the features, and on rows kept apart from the trees an isotonic calibration. The
features are densities of lexicon words as written and as unmasked (look-alike digits and signs read as letters, dots and
the like left out), their nearness to the second person, capitals, punctuation and masked words. Every whole text is
scored; ids, languages, sources and labels are never features.

Defined cases: null and empty texts have zero features and a score like any other; labels of missing documents and of
missing ids are left out, of several labels for an id the greatest counts; without both labels every score is 0; with too
few labelled texts to keep some apart, trees and calibration learn from the same ones; an empty table gives an empty table.
Bounds that are parameters: TOXIC and OTHERS labelled documents, ENTRIES lexicon entries, of which each must be in LEAST_SHARE
of the toxic ones and counts REPEATS times a document at most; words of over 64 bytes are no entries.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwatch.llm.common import WORD, id_rest, lean, stored

#: Labelled documents to learn from, at most: toxic ones and others.
TOXIC, OTHERS = 6_000, 12_000
#: Lexicon entries at most; the least share and number of toxic documents and the least frequency ratio of each.
ENTRIES, LEAST_SHARE, LEAST_DOCS, LEAST_RATIO = 80, 0.02, 6, 8.0
REPEATS = 8
#: Lengths in bytes of the beginnings that stand for a family of words.
STEMS = (5, 6, 7, 8)
NEAR = 4
THRESHOLD = 0.3
#: Pronouns of the second person.
SECOND_PERSON = frozenset(
    w.encode() for w in "you your yours yourself u ur du dich dir dein deine deiner euch euer ihr sie tu te toi ton ta tes vous votre vos tú "
    "usted ustedes ti vosotros su tus".split()
)
_UPPER, _LETTER = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ALIKE = dict(zip(b"013457@$!|", b"oieastasil", strict=True))
_DROPPED = b"*.,;:_-~'\"`^#%&()[]{}<>?/\\+="
_OPEN = bytes(_ALIKE.get(b, b + 32 if 65 <= b <= 90 else b) for b in range(256))
NAMES = (
    "lexicon", "lexicon_count", "unmasked", "near_second_person", "second_person", "capitals", "shouted", "exclaims", "asks",
    "signs", "digits", "word_length", "log_words",
)


@dataclass(frozen=True)
class Lexicon:
    """Whole words, which end in a space, and stems."""

    entries: frozenset[bytes] = frozenset()

    @cached_property
    def heads(self) -> frozenset[bytes]:
        return frozenset(e.rstrip()[: STEMS[0]] for e in self.entries)

    def hits(self, words: list[bytes]) -> list[int]:
        heads, entries, first = self.heads, self.entries, STEMS[0]
        return [
            i for i, w in enumerate(words)
            if w[:first] in heads and (w + b" " in entries or any(w[:k] in entries for k in STEMS if len(w) >= k))
        ]


def units(word: bytes) -> list[bytes]:
    return [word + b" ", *[word[:k] for k in STEMS if len(word) >= k]]


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of NAMES for a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    plain, shown = raw.translate(_PLAIN).split(), raw.split()
    n, size = max(len(shown), 1), max(len(raw), 1)
    hits = lexicon.hits(plain)
    yous = [i for i, w in enumerate(plain) if w in SECOND_PERSON]
    at = np.searchsorted(yous, hits) if hits and yous else np.zeros(0, int)
    near = sum(min(abs(h - yous[j]) for j in (k - 1, k) if 0 <= j < len(yous)) <= NEAR for h, k in zip(hits, at, strict=False))
    opened = raw.translate(_OPEN, _DROPPED).split()
    unmasked = max(len(lexicon.hits(opened)) - len(hits), 0)
    letters = len(raw) - len(raw.translate(None, _LETTER))
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    return [
        len(hits) / n, math.log1p(len(hits)), math.log1p(unmasked), near / n, len(yous) / n, count(_UPPER) / max(letters, 1),
        sum(w.isupper() and len(w) > 2 for w in shown) / n, count(b"!") / size, count(b"?") / size, count(b"#*$%&|<>@_~^") / size,
        count(b"0123456789") / size, letters / n, math.log1p(len(shown)),
    ]


def sample(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, others: int = OTHERS) -> DataFrame:
    """label, text, part (0 to 9, from the text's hash) of at most `toxic` and `others` labelled documents."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")  # the bound counts documents that there are
    known = known.withColumn("h", F.xxhash64("doc_id"))
    one = lambda test, bound: known.where(test).orderBy("h", "doc_id").limit(bound)
    picked = one("label = 1", toxic).unionAll(one("label = 0", others)).withColumnRenamed("doc_id", "label_id")
    joined = docs.select("doc_id", "text").join(F.broadcast(picked), F.expr("doc_id = label_id"))
    rows = joined.selectExpr("cast(label AS int) AS label", "text", "cast(pmod(xxhash64(text), 10) AS int) AS part")
    return stored(rows.dropDuplicates(["label", "text"]), "toxicity-sample")  # copies would pass for evidence


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """At most ENTRIES words and stems, by the weight of evidence that toxic documents use them more."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()
                found = Counter(u for w in words if len(w) <= 64 for u in units(w))
                found = {u: min(n, REPEATS) for u, n in found.items()}  # a word on end isn't evidence again and again
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(found), pa.int32()), pa.array([*found], pa.binary()), pa.array([*found.values()], pa.int64()),
                     pa.array([len(words)] * len(found), pa.int64())], names=["label", "unit", "n", "words"])

    sizes = {r["label"]: r for r in rows.groupBy("label").agg(
        F.count("*").alias("docs"), F.sum(F.expr(f"size(regexp_extract_all(coalesce(text, ''), r'{WORD}', 0)) + 1")).alias("words")).collect()}
    if len(sizes) < 2:
        return Lexicon()
    counted = rows.select("label", "text").mapInArrow(split, "label int, unit binary, n bigint, words bigint").groupBy("unit").agg(
        F.sum(F.expr("if(label = 1, n, 0)")).alias("bad"), F.sum(F.expr("if(label = 0, n, 0)")).alias("good"),
        F.count_if(F.expr("label = 1")).alias("docs"))
    ratio = f"((bad + 0.5D) / {sizes[1]['words']}D) / ((good + 0.5D) / {sizes[0]['words']}D)"
    sure = f"docs >= {max(LEAST_DOCS, LEAST_SHARE * sizes[1]['docs'])}D AND {ratio} >= {LEAST_RATIO}D"
    best = counted.where(sure).orderBy(F.expr(f"bad * ln({ratio})").desc(), "unit").limit(ENTRIES)
    return Lexicon(frozenset(bytes(r["unit"]) for r in best.collect()))


def with_features(docs: DataFrame, lexicon: Lexicon, kept: list[str], text: str = "text") -> DataFrame:
    """The columns `kept` and f, the array of features."""
    every = [*kept, *[c for c in (text,) if c not in kept]]
    at = every.index(text)

    def compute(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in rows:
            made = [features(t.as_py(), lexicon) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(made, pa.list_(pa.float64()))], names=[*kept, "_llm_f"])

    shape = T.StructType([*[docs.schema[c] for c in kept], T.StructField("_llm_f", T.ArrayType(T.DoubleType()))])
    return docs.select(*[F.col(f"`{c}`") for c in every]).mapInArrow(compute, shape)


def score(
    docs: DataFrame, training: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """The columns `keep`, score and predicted (as `names` calls them) of every document."""
    rows = sample(training, labels)
    lexicon = learn_lexicon(rows)
    vectors = with_features(rows, lexicon, ["label", "part"]).coalesce(4).select(
        F.col("label").cast("double"), "part", array_to_vector("_llm_f").alias("_llm_features"))
    made = with_features(docs, lexicon, list(keep))
    verdict = f"cast(`{names[0]}` >= {THRESHOLD}D AS int) AS `{names[1]}`"
    if not lexicon.entries and rows.select("label").distinct().count() < 2:
        return made.drop("_llm_f").selectExpr(*[f"`{c}`" for c in keep], f"0D AS `{names[0]}`").selectExpr("*", verdict)
    vectors = stored(vectors, "toxicity-vectors").coalesce(4)
    trees = GBTClassifier(
        featuresCol="_llm_features", labelCol="label", predictionCol="_llm_p", maxIter=24, maxDepth=4, stepSize=0.2, seed=7, minInstancesPerNode=5,
    ).setRawPredictionCol("_llm_r").setProbabilityCol("_llm_q")
    taught = vectors.where("part < 7")
    if taught.groupBy("label").count().count() < 2:
        taught = vectors  # too few rows to keep some apart
    model = trees.fit(taught)
    margin = F.element_at(vector_to_array("_llm_r"), 2)
    apart = model.transform(vectors.where("part >= 7")).select("label", margin.alias("_llm_margin"))
    if apart.groupBy("label").count().count() < 2:
        apart = model.transform(vectors).select("label", margin.alias("_llm_margin"))
    steps = IsotonicRegression(featuresCol="_llm_margin", labelCol="label").fit(apart)
    scored = model.transform(made.withColumn("_llm_features", array_to_vector("_llm_f"))).withColumn("_llm_margin", margin)
    kept = [f"`{c}`" for c in keep]
    # the calibrated share, and for order within a step a thousandth of the plain probability
    return steps.setPredictionCol("_llm_share").transform(scored).selectExpr(
        *kept, f"least(greatest(0.999D * _llm_share + 0.001D / (1D + exp(-2D * _llm_margin)), 0D), 1D) AS `{names[0]}`"
    ).selectExpr("*", verdict)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    marked = docs.withColumn("held_out", id_rest(4) == 2)
    return score(marked, marked.where("NOT held_out"), labels, ("doc_id", "held_out"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Keep the documents that are not predicted toxic, with their columns."""
    kept = tuple(docs.columns)
    found = score(docs, docs.where(id_rest(4) != 2), labels, kept, ("_llm_score", "_llm_predicted"))
    return found.where("_llm_predicted = 0").select(*[F.col(f"`{c}`") for c in kept])
