"""Language-model scoring by a hidden Markov model.

Unigram counts come from all training documents. The `FREQUENT` most frequent tokens or fewer form a bounded dictionary;
each has an emission class (the first ones a class of their own), all other tokens share classes by their endings. A
state emits a class, and the class a token by its smoothed unigram share in it, so the model's probabilities sum to one
over the known tokens and one unknown token a class, while its tables stay bounded whatever the vocabulary.

Baum-Welch starts from rounds on a bounded sample of documents of any length, picked by a hash of id and text. Rounds over every
training document follow, their expected counts summed by partition in numpy and across partitions by Spark, until a round
raises the summed log-likelihood by less than the share `SETTLED`. Of a long text the states of `SEGMENT` steps are held at a
time and computed again from marks for the way back. The scaled forward recursion gives the exact likelihood of every
whole text. Counts of tokens outside the dictionary join by token.

Defined cases: null and empty texts are a lone end; a missing id counts as the empty id; equal rows score equally, and other
columns do not matter; an empty table gives an empty table; without training documents the unigram part has one unknown type
and the model adds nothing.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwatch.llm.common import WORD, id_rest, lean, lower_ascii, row_key, stored

SMOOTH = 0.1
FREQUENT, LONGEST = 100_000, 64
OWN, SHARED, ENDINGS = 4096, 2048, 512
CLASSES = OWN + SHARED + ENDINGS
STATES, START_DOCS = 8, 1_200
#: A round that raises the log-likelihood of all training documents by less than this share is the last.
SETTLED = 1e-4
#: Steps of a block of sequences whose states are held together.
SEGMENT = 50_000
_BLOCK = 300_000
#: Tokens that are coded together.
_CODED = 1_000_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words, then the end, which is the empty token."""
    return [*(text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(), b""]


def token_counts(docs: DataFrame) -> DataFrame:
    """token, c: over all rows of `docs`; the end is the empty token."""
    words = f"concat(regexp_extract_all({lower_ascii('coalesce(text, char(32))')}, r'{WORD}', 0), array(''))"
    return docs.selectExpr(f"explode({words}) AS token").groupBy("token").agg(F.count("*").alias("c"))


@dataclass
class Unigrams:
    """Sizes, and the dictionary: tokens by falling count, their counts; `share` is each class's unigram mass."""

    n: int
    v: int
    known: list[bytes]
    counts: np.ndarray
    share: np.ndarray

    @property
    def whole(self) -> float:
        return self.n + SMOOTH * (self.v + 1)

    def classes(self) -> np.ndarray:
        hashed = np.array([zlib.crc32(w) for w in self.known], np.int64) % SHARED + OWN
        return np.where(np.arange(len(self.known)) < OWN, np.arange(len(self.known)), hashed)


def unigrams(counts: DataFrame, frequent: int = FREQUENT) -> Unigrams:
    """The dictionary holds the tokens from the least quarter power of two on that leaves no more than `frequent`."""
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    bins = counts.where(f"octet_length(token) <= {LONGEST}").groupBy(F.expr("cast(floor(4 * log2(c)) AS int)").alias("b")).count().collect()
    left, least = frequent, None
    for row in sorted(bins, reverse=True):
        left -= row["count"]
        if left < 0:
            break
        least = row["b"]
    frequent_test = f"octet_length(token) <= {LONGEST} AND floor(4 * log2(c)) >= {least}" if least is not None else "false"
    top = sorted((-r["c"], r["token"].encode()) for r in counts.where(frequent_test).collect())
    ending = f"cast(crc32(substr(cast(token AS binary), -3, 3)) % {ENDINGS} AS int)"
    rest = counts.where(f"NOT ({frequent_test})").groupBy(F.expr(ending).alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    found = Unigrams(int(size["n"]), int(size["v"]), [w for _, w in top], np.array([-c for c, _ in top], np.float64), np.zeros(CLASSES))
    np.add.at(found.share, found.classes(), found.counts + SMOOTH)
    found.share[OWN + SHARED :] += SMOOTH  # the unknown token of the class
    for r in rest:
        found.share[OWN + SHARED + r["k"]] += r["c"] + SMOOTH * r["v"]
    found.share /= found.whole
    return found


def coded(docs: DataFrame, uni: Unigrams) -> DataFrame:
    """One row a document: row, the kept columns, n_tokens, what the dictionary knows of it, the rest, and its classes."""
    held = docs.sparkSession.sparkContext.broadcast((uni.known, uni.counts, uni.classes()))  # at most FREQUENT short tokens

    def code(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        known, counts, classes = held.value
        place, logs = {w: i for i, w in enumerate(known)}, np.log10(counts + SMOOTH)

        def made(kept: list[pa.Array], seen: _Numbers, lists: list[np.ndarray]) -> pa.RecordBatch:
            names = list(seen)
            ids = np.array([place.get(w, -1) for w in names], np.int64)
            known_class = classes[ids] if len(classes) else np.zeros(len(ids), np.int64)
            endings = [OWN + SHARED + zlib.crc32(w[-3:]) % ENDINGS for w in names]
            of_class = np.where(ids >= 0, known_class, endings).astype(np.int16)
            of_log = np.where(ids >= 0, logs[ids] if len(logs) else 0.0, 0.0)
            flat, lengths = np.concatenate(lists), np.array([len(x) for x in lists], np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            inside = ids[flat] >= 0  # no document is without its end
            n_in = np.add.reduceat(inside, starts[:-1], dtype=np.int64)
            log_in = np.add.reduceat(of_log[flat], starts[:-1])
            rest = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths - n_in)]).astype(np.int32)),
                pa.array(names, pa.binary()).take(pa.array(flat[~inside])).cast(pa.string()),
            )
            coded = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(of_class[flat]))
            return pa.RecordBatch.from_arrays([*kept, pa.array(lengths), pa.array(n_in), pa.array(log_in), rest, coded], names=shape.names)

        for batch in rows:
            lists, seen, size, first = [], _Numbers(), 0, 0
            for i, text in enumerate(batch.column(4)):
                words = tokens(text.as_py())
                lists.append(np.fromiter(map(seen.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= _CODED or i == batch.num_rows - 1:
                    yield made([c.slice(first, i + 1 - first) for c in batch.columns[:4]], seen, lists)
                    lists, seen, size, first = [], _Numbers(), 0, i + 1

    marked = docs.select(F.monotonically_increasing_id().alias("row"), row_key().alias("mark"), "doc_id", "held_out", "text")
    more = T.StructType.fromDDL("n_tokens bigint, n_in bigint, log_in double, rest array<string>, classes array<smallint>")
    shape = T.StructType([*marked.drop("text").schema.fields, *more.fields])
    return stored(marked.mapInArrow(code, shape), "lm-coded")  # stored, so that row numbers stay


class _Numbers(dict):
    """Tokens to numbers in order of appearance."""

    def __missing__(self, token: bytes) -> int:
        number = self[token] = len(self)
        return number


@dataclass
class Model:
    """Start, transition and emission probabilities; emissions by class, then state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    history: tuple[float, ...] = ()  # log10 likelihood of all training documents before each round over them


def _blocks(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Sequences of like length together: the joined classes, and rows, starts and lengths by falling length."""
    flat, upto = column.values.to_numpy(), column.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(upto)
    order = np.argsort(-lengths, kind="stable")
    block = np.cumsum(lengths[order]) // _BLOCK
    for part in np.split(order, np.flatnonzero(np.diff(block)) + 1):
        if len(part):
            yield flat, part, upto[part], lengths[part]


class _Steps:
    """The steps from `first` to `last` of sequences of falling length, one after another: codes, rows and borders of the steps."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: int, last: int):
        sizes = np.searchsorted(-lengths, -np.arange(first, last), side="left")  # lengths greater than t
        self.first, self.upto = first, np.concatenate([[0], np.cumsum(sizes)])
        self.row = np.arange(self.upto[-1]) - np.repeat(self.upto[:-1], sizes)
        self.codes = flat[starts[self.row] + np.repeat(np.arange(first, last), sizes)]

    def forward(self, model: Model, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled states, scales and emissions of all steps; `before` holds the states of the step before them."""
        emitted, ones = model.emit[self.codes], np.ones(len(model.start), model.emit.dtype)
        states, scales = np.empty_like(emitted), np.empty(len(emitted), emitted.dtype)
        for a, b in itertools.pairwise(self.upto.tolist()):
            state = states[a:b]
            if before is None:
                state[:] = model.start
            else:
                np.matmul(before[: b - a], model.move, out=state)
            state *= emitted[a:b]
            scale = np.matmul(state, ones, out=scales[a:b])  # faster than a sum over a short axis
            state /= scale[:, None]
            before = state
        return states, scales, emitted

    def logs(self, scales: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.row, np.log10(scales, dtype=np.float64), n)

    def last(self, states: np.ndarray) -> np.ndarray:
        return states[self.upto[-2] :]


def _forward(model: Model, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """Log10 likelihoods by the scaled recursion; on demand the steps with their states, scales and emissions."""
    logs, before, kept = np.zeros(len(starts)), None, []
    for first in range(0, int(lengths[0]), SEGMENT):
        steps = _Steps(flat, starts, lengths, first, min(first + SEGMENT, int(lengths[0])))
        states, scales, emitted = steps.forward(model, before)
        logs += steps.logs(scales, len(starts))
        before = steps.last(states).copy()
        if keep:
            kept.append((steps, states, scales, emitted))
    return logs, kept


def expected_counts(model: Model, column: pa.ListArray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch sums over sequences: starts, moves, emissions by class and state, and the log10 likelihood."""
    k, total = len(model.start), 0.0
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((len(model.emit), k))
    back_move = np.ascontiguousarray(model.move.T)
    for flat, _, starts, lengths in _blocks(column):
        longest, before, marks, held = int(lengths[0]), None, [], None
        for first in range(0, longest, segment):  # the last segment stays for the way back
            steps = _Steps(flat, starts, lengths, first, min(first + segment, longest))
            held = (steps, *steps.forward(model, before))
            total += float(steps.logs(held[2], len(starts)).sum())
            marks.append((first, before))
            before = steps.last(held[1]).copy()
        carried = np.ones((0, k), model.emit.dtype)  # what the next segment hands back to the last step
        for first, before in reversed(marks):
            if held is None:
                steps = _Steps(flat, starts, lengths, first, first + segment)
                held = (steps, *steps.forward(model, before))
            steps, states, scales, emitted = held
            held, upto = None, steps.upto.tolist()
            ahead = emitted / scales[:, None]
            back = np.ones_like(states)  # sequences end with ones
            back[upto[-2] : upto[-2] + len(carried)] = carried
            for i in range(len(upto) - 2, 0, -1):
                a, b = upto[i], upto[i + 1]
                ahead[a:b] *= back[a:b]
                np.matmul(ahead[a:b], back_move, out=back[upto[i - 1] : upto[i - 1] + b - a])
            n = upto[1]
            ahead[:n] *= back[:n]
            carried = ahead[:n] @ back_move
            share = states * back
            move += states[np.repeat(steps.upto[:-2], np.diff(steps.upto[1:])) + steps.row[n:]].T @ ahead[n:]
            if before is None:
                start += share[:n].sum(axis=0, dtype=np.float64)
            else:
                move += before[:n].T @ ahead[:n]
            for i in range(k):  # summed in double precision
                emit[:, i] += np.bincount(steps.codes, share[:, i], len(emit))
    return start, move * model.move, emit, total


def _updated(start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray, weight: float = 500.0) -> Model:
    """Probabilities from counts. Emissions lean on the unigram shares with `weight` counts."""
    emit = emit + weight * share[:, None]
    return Model((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _unsettled(history: list[float], settled: float) -> bool:
    return len(history) < 2 or history[-1] - history[-2] > settled * abs(history[-1])


def _first_model(sample: pa.ListArray, share: np.ndarray, states: int, settled: float, seed: int = 11) -> Model:
    """Sticky states from random documents, then Baum-Welch on the sample until it settles."""
    rng = np.random.default_rng(seed)
    base = share / share.sum()
    emit = np.zeros((len(share), states))
    for i, doc in enumerate(sample):
        np.add.at(emit[:, i % states], doc.values.to_numpy(), rng.uniform(0.5, 1.5))
    model = _updated(np.ones(states), np.eye(states) * 50 * states + 1, emit, base)
    history: list[float] = []
    while len(sample) and _unsettled(history, settled):
        *sums, total = expected_counts(model, sample)
        model = _updated(*sums, base)
        history.append(total)
    return model


def train(rows: DataFrame, uni: Unigrams, states: int = STATES, settled: float = SETTLED) -> Model:
    """Baum-Welch over the coded training documents, round after round until the likelihood settles."""
    spark = rows.sparkSession
    # by content, so that neither files nor cores decide; rows alike in the mark differ in nothing that is learnt from
    sample = rows.select("mark", "classes").orderBy(F.xxhash64("mark"), "mark", "classes").limit(START_DOCS).toArrow()
    column = sample.column("classes").combine_chunks()
    model = _first_model(column if isinstance(column, pa.ListArray) else pa.array([], pa.list_(pa.int16())), uni.share, states, settled)
    names = [f"s{i}" for i in range(states)]
    history: list[float] = []
    while _unsettled(history, settled):
        held = spark.sparkContext.broadcast((model.start, model.move, model.emit))

        def count(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            lean()
            model, sums = Model(*[a.astype(np.float32) for a in held.value]), [0.0, 0.0, 0.0, 0.0]
            for batch in batches:
                sums = [a + b for a, b in zip(sums, expected_counts(model, batch.column(0)), strict=True)]
            if isinstance(sums[0], np.ndarray):
                table = np.concatenate([sums[0][None], sums[1], sums[2], np.eye(1, states) * sums[3]])
                some = np.flatnonzero(table.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(table[some, i]) for i in range(states)]], names=["slot", *names])

        shape = "slot bigint, " + ", ".join(f"{n} double" for n in names)
        summed = rows.select("classes").mapInArrow(count, shape).groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        table = np.zeros((2 + states + CLASSES, states))
        table[summed.column("slot").to_numpy()] = np.stack([summed.column(n).to_numpy() for n in names], axis=1)
        model = _updated(table[0], table[1 : 1 + states], table[1 + states : -1], uni.share / uni.share.sum())
        history.append(float(table[-1, 0]))
        held.unpersist()
    model.history = tuple(history)
    return model


def score(docs: DataFrame, held_out: str = "held_out") -> DataFrame:
    """Score `docs` (doc_id, text and a boolean column that keeps a row out of all learning)."""
    docs = docs.select("doc_id", "text", F.col(held_out).alias("held_out"))
    counts = stored(token_counts(docs.where("NOT held_out")), "lm-counts")
    uni = unigrams(counts)
    rows = coded(docs, uni)
    model = train(rows.where("NOT held_out"), uni)
    held = docs.sparkSession.sparkContext.broadcast((model.start, model.move, model.emit, np.log10(np.maximum(uni.share, 1e-300))))

    def likelihoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        *model, share = held.value
        model = Model(*model)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            gain = np.zeros(batch.num_rows)
            for flat, part, starts, lengths in _blocks(column):
                logs, _ = _forward(model, flat, starts, lengths)
                upto = np.concatenate([[0], np.cumsum(share[flat])])
                gain[part] = logs - (upto[starts + lengths] - upto[starts])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(gain)], names=[*batch.schema.names[:-1], "gain"])

    names = ("row", "doc_id", "held_out", "n_tokens", "n_in", "log_in")
    picked = rows.select(*names, "classes")
    gained = picked.mapInArrow(likelihoods, picked.drop("classes").schema.add("gain", "double"))
    # what the dictionary doesn't hold
    outside = (
        rows.selectExpr("row AS out_row", "explode(rest) AS token").join(counts, "token", "left").groupBy("out_row")
        .agg(F.sum(F.expr(f"log10(coalesce(c, 0) + {SMOOTH}D)")).alias("log_out"), F.count("c").alias("n_out"))
    )
    base = f"log_in + coalesce(log_out, 0D) - n_tokens * {float(np.log10(uni.whole))!r}D"
    return gained.join(outside, F.expr("row = out_row"), "left").selectExpr(
        "doc_id", "held_out", "n_tokens", "n_in + coalesce(n_out, 0) AS n_known", f"{uni.n}L AS train_tokens",
        f"{base} AS base_score", f"gain + {base} AS score",
    )


def digest(docs: DataFrame) -> DataFrame:
    return score(docs.withColumn("held_out", id_rest(10) == 0))
