"""Secret scan: base patterns, and a character convolutional network over every candidate and its surroundings.

Base findings are the matches of three patterns. A candidate is any unbroken run of key characters, of at least `LEAST`
if a digit is among them and of at least `LEAST_PLAIN` else; the network reads the whole run with `CONTEXT` characters on
either side. It is trained in numpy on all different candidates of all documents, whatever their length and number,
labelled by whether a base finding covers them. So that it learns what keys look like and not the patterns once more, every
key-like finding is shown a second time without its keyword, and key-like runs that no pattern finds are not labelled at all;
key-like are runs that change between capitals, small letters and digits `CHANGES` times.

Two thirds of the candidates, by hash, train in shards: in each of `ROUNDS` rounds every shard takes one pass from the same
weights, and the next round starts from the shards' mean. A shard is a stream of small batches in hash order; there are up to
`SHARDS` of them, and their number depends on that of the candidates alone. The other third, all of it, calibrates the output
(Platt scaling) and sets the threshold: the highest, in hundredths of a logit, that still finds `RECALL` of the labelled findings,
whatever precision that leaves (`Net.precision`). Only counts of logits per hundredth reach the driver. Candidates from the
threshold on that no base finding touches add spans of kind `net`.

Defined cases: null and empty texts have no spans; without labelled findings of both kinds, or with fewer than
30 candidates in all, there is no network and the base findings stand alone; equal rows give equal results; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwatch.llm.common import stored

LEAST, LEAST_PLAIN, CONTEXT, WIDTH, FILTERS = 12, 16, 24, 5, 24
#: Passes over the training candidates; candidates a shard, until there are SHARDS of them.
ROUNDS, SHARD_ROWS, SHARDS = 12, 8_192, 128
#: Candidates and characters of one training step; places whose activations are held at once.
BATCH, BATCH_PLACES, SEGMENT = 64, 1 << 16, 1 << 16
#: Logits are counted in steps of 1 / STEPS up to FAR on either side.
STEPS, FAR = 100, 60
CHANGES = 5
RECALL = 0.98
KINDS = ("assign", "access", "hex", "net")
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_KEYWORD = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?$""", re.IGNORECASE | re.ASCII)
_CHANGE = re.compile(r"(?=[a-z][A-Z0-9]|[A-Z][a-z0-9]|[0-9][A-Za-z])")
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}")
_DIGIT = re.compile(r"[0-9]")
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-:\"' \n"
_CLASS = {c: i + 1 for i, c in enumerate(_ALPHABET)}
_OUTSIDE, _CLASSES = 1 + len(_ALPHABET), 2 * (2 + len(_ALPHABET))  # each character inside and around the candidate

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by start, then kind as listed; leftmost non-overlapping within a kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _RUN.finditer(text) if m.end() - m.start() >= LEAST_PLAIN or _DIGIT.search(m.group())]


def _covered(span: tuple[int, int], base: list[Span]) -> bool:
    return any(a < span[1] and span[0] < b for _, a, b in base)


def key_like(value: str) -> bool:
    return len(_CHANGE.findall(value)) >= CHANGES


def examples(text: str) -> Iterator[tuple[int, str, str, str]]:
    """Labelled candidates of a text: label, before, value, after."""
    base = base_spans(text)
    for a, b in candidates(text):
        before, value, after = text[max(a - CONTEXT, 0) : a], text[a:b], text[b : b + CONTEXT]
        found, keyed = _covered((a, b), base), key_like(value)
        if found or not keyed:
            yield int(found), before, value, after
        if found and keyed:
            yield 1, _KEYWORD.sub("", before), value.removeprefix("AKIA"), after


def window(text: str, span: tuple[int, int]) -> np.ndarray:
    """Classes of the candidate and its surroundings, with WIDTH - 1 blanks on either side."""
    a, b = max(span[0] - CONTEXT, 0), min(span[1] + CONTEXT, len(text))
    codes = np.array([_CLASS.get(c, _OUTSIDE) for c in text[a:b]], np.int64)
    codes[: span[0] - a] += _CLASSES // 2
    codes[span[1] - a :] += _CLASSES // 2
    return np.pad(codes, WIDTH - 1)


@dataclass
class Net:
    """One convolution over one-hot characters, the greatest activation of each filter, one logistic output."""

    filters: np.ndarray  # offset, class, filter
    bias: np.ndarray
    out: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0
    precision: float = 1.0  # of the threshold, on the part of the sample that set it

    def pooled(self, windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Pooled activations, and of each the place of its maximum in its window."""
        sizes = np.array([len(w) for w in windows])
        if sizes.sum() > SEGMENT and len(windows) > 1:
            half = len(windows) // 2
            parts = [self.pooled(windows[:half]), self.pooled(windows[half:])]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        if sizes[0] > SEGMENT + WIDTH:  # one long window: the maximum of its segments' maxima
            best, where = np.full((1, FILTERS), -np.inf), np.zeros((1, FILTERS), np.int64)
            for at in range(0, sizes[0] - WIDTH + 1, SEGMENT):
                some, place = self.pooled([windows[0][at : at + SEGMENT + WIDTH - 1]])
                where, best = np.where(some > best, at + place, where), np.maximum(some, best)
            return best, where
        joined = np.concatenate(windows)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        n = len(joined) - WIDTH + 1
        act = sum(self.filters[o][joined[o : o + n]] for o in range(WIDTH)) + self.bias
        ends = starts + sizes - WIDTH + 1  # no place reaches into the next window, so that a window's result is its own
        best = np.maximum.reduceat(act, np.stack([starts, ends], axis=1).ravel()[:-1], axis=0)[::2]
        return best, np.stack([act[a:b].argmax(axis=0) for a, b in zip(starts, ends, strict=True)])

    def logit(self, windows: list[np.ndarray]) -> np.ndarray:
        best, _ = self.pooled(windows)
        return (np.maximum(best, 0) * self.out).sum(axis=1) + self.offset  # each row by itself, whatever it is scored with

    def probability(self, windows: list[np.ndarray]) -> np.ndarray:
        """Calibrated; in blocks of bounded size."""
        if not windows:
            return np.zeros(0)
        block = max(1, 200_000 // max(len(w) for w in windows))
        parts = [self.logit(windows[i : i + block]) for i in range(0, len(windows), block)]
        return 1 / (1 + np.exp(-np.clip(self.slope * np.concatenate(parts) + self.shift, -60, 60)))


def fresh(seed: int = 7) -> Net:
    rng = np.random.default_rng(seed)
    return Net(rng.normal(0, 0.1, (WIDTH, _CLASSES, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, FILTERS), 0.0)


class Adam:
    """Steps of Adam on the weighted log loss of a network."""

    def __init__(self, net: Net, rate: float = 0.01):
        self.net, self.rate, self.step = net, rate, 0
        self.state = {k: [0.0, 0.0] for k in ("filters", "bias", "out", "offset")}

    def learn(self, some: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> None:
        net = self.net
        best, where = net.pooled(some)
        hidden = np.maximum(best, 0)
        error = weight * (1 / (1 + np.exp(-np.clip((hidden * net.out).sum(axis=1) + net.offset, -60, 60))) - labels) / len(some)
        joined, back = np.concatenate(some), error[:, None] * net.out * (best > 0)
        where = where + np.cumsum([0, *[len(w) for w in some[:-1]]])[:, None]
        grads = {"out": (hidden * error[:, None]).sum(axis=0), "offset": error.sum(), "bias": back.sum(axis=0), "filters": np.zeros_like(net.filters)}
        for o in range(WIDTH):
            np.add.at(grads["filters"][o], (joined[np.minimum(where + o, len(joined) - 1)], np.arange(FILTERS)), back)
        self.step += 1
        for k, g in grads.items():
            m, v = self.state[k] = [0.9 * self.state[k][0] + 0.1 * g, 0.999 * self.state[k][1] + 0.001 * np.square(g)]
            setattr(net, k, getattr(net, k) - self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8))


def platt(net: Net, scores: np.ndarray, truth: np.ndarray, n: np.ndarray) -> None:
    """Set slope and shift from scores with their labels, each counted `n` times."""
    share = n / n.sum()
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(net.slope * scores + net.shift, -60, 60)))
        net.slope -= 0.05 * float(((p - truth) * scores * share).sum())
        net.shift -= 0.05 * float(((p - truth) * share).sum())


def class_weights(negative: int, positive: int) -> tuple[float, float]:
    """Weights that let both labels count alike."""
    mean = positive / max(negative + positive, 1)
    return 0.5 / max(1 - mean, 1e-9), 0.5 / max(mean, 1e-9)


def fit(windows: list[np.ndarray], labels: np.ndarray, seed: int = 7, epochs: int = ROUNDS, batch: int = BATCH, rate: float = 0.01) -> Net:
    """Train by Adam on two thirds of windows at hand, calibrate and set the threshold on the rest."""
    net, rng = fresh(seed), np.random.default_rng(seed)
    order = rng.permutation(len(windows))
    test, train = order[: len(order) // 3], order[len(order) // 3 :]
    low, high = class_weights(int((labels[train] == 0).sum()), int((labels[train] > 0).sum()))
    adam, weight = Adam(net, rate), np.where(labels > 0, high, low)
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), batch):
            rows = train[at : at + batch]
            adam.learn([windows[i] for i in rows], labels[rows], weight[rows])
    truth = labels[test]
    platt(net, net.logit([windows[i] for i in test]), truth, np.ones(len(test)))
    given = net.probability([windows[i] for i in test])
    positive = np.sort(given[truth > 0])
    if len(positive):
        net.threshold = float(positive[int((1 - RECALL) * len(positive))])
        net.precision = float(truth[given >= net.threshold].mean())
    return net


def labelled_candidates(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """All different candidates with their label, before, value and after; with `sample` at most so many of each label, by hash."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = [e for text in batch.column(0).to_pylist() for e in examples(text)]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.string()) for c in columns[1:]]], names=["label", "before", "value", "after"]
            )

    found = docs.where(f"text RLIKE '[A-Za-z0-9+/_=-]{{{LEAST}}}'").select("text").mapInArrow(
        cut, "label int, before string, value string, after string"
    )
    found = found.dropDuplicates(["label", "before", "value", "after"])  # copies would count as often as they occur
    found = stored(found.withColumn("h", F.xxhash64("before", "value", "after")), "secret-examples")  # the texts are read once
    if sample is None:
        return found
    one = lambda label: found.where(f"label = {label}").orderBy("h", "value").limit(sample)
    return one(1).unionAll(one(0))


def _windows(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint8) for x in column.to_pylist()]


def coded(found: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` and codes, the windows of classes of the candidates."""

    def code(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = zip(*[batch.column(c).to_pylist() for c in ("before", "value", "after")], strict=True)
            codes = [window(b + v + a, (len(b), len(b) + len(v))).astype(np.uint8).tobytes() for b, v, a in texts]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(codes, pa.binary())], names=[*keep, "codes"]
            )

    return found.mapInArrow(code, T.StructType([*[found.schema[c] for c in keep], T.StructField("codes", T.BinaryType())]))


def sharded(found: DataFrame, shards: int) -> DataFrame:
    """The candidates' windows, a file a shard, in hash order."""
    rows = coded(found.withColumn("shard", F.expr(f"CAST(pmod(h DIV 3, {shards}) AS INT)")), "shard", "h", "label")
    return stored(rows.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "h", "label", "codes"), "secret-windows")


def _steps(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """A shard's windows and labels, as many at once as one training step takes."""
    some, labels, places = [], [], 0
    for batch in batches:
        for w, label in zip(_windows(batch.column("codes")), batch.column("label").to_pylist(), strict=True):
            some.append(w)
            labels.append(label)
            places += len(w)
            if len(some) == BATCH or places >= BATCH_PLACES:
                yield some, np.array(labels, float)
                some, labels, places = [], [], 0
    if some:
        yield some, np.array(labels, float)


def _one_round(rows: DataFrame, net: Net, weights: tuple[float, float], passes: int) -> Net:
    """The mean of the networks that the shards make of `net`, by their candidates."""
    shape = net.filters.shape
    given = np.concatenate([net.filters.ravel(), net.bias, net.out, [net.offset]])

    def opened(flat: np.ndarray) -> Net:
        a, b, c = (int(x) for x in np.cumsum([np.prod(shape), FILTERS, FILTERS]))
        return Net(flat[:a].reshape(shape), flat[a:b], flat[b:c], float(flat[c]))

    def shard_of(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in rows:
            shard = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            yield from ((int(shard[a]), batch.slice(a, b - a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)

    def learn(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in groupby(shard_of(rows), lambda x: x[0]):
            adam, n = Adam(opened(given.copy())), 0
            stream = (part for _, part in parts)
            held = list(stream) if passes > 1 else stream  # several passes are taken over a single small shard alone
            for _ in range(passes):
                n = 0
                for some, labels in _steps(held):
                    adam.learn(some, labels, np.where(labels > 0, weights[1], weights[0]))
                    n += len(some)
            made = adam.net
            flat = np.concatenate([made.filters.ravel(), made.bias, made.out, [made.offset]])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], names=["shard", "n", "net"])

    made = sorted((r.shard, bytes(r.net), r.n) for r in rows.mapInArrow(learn, "shard int, n bigint, net binary").collect())
    total = sum(n for _, _, n in made)
    return opened(sum(np.frombuffer(flat, float) * (n / total) for _, flat, n in made))


def _settle(found: DataFrame, net: Net) -> None:
    """Calibrate the network and set its threshold on all rows, by their counts per logit."""

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            z = np.concatenate([net.logit(some) for some, _ in _steps([batch])]) if batch.num_rows else np.zeros(0)
            binned = np.rint(np.clip(z, -FAR, FAR) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(binned)], names=["label", "z"])

    counts = coded(found, "label").mapInArrow(score, "label int, z int").groupBy("label", "z").count().collect()
    if not any(r["label"] for r in counts):
        return
    z, truth, n = (np.array(x, float) for x in zip(*sorted((r["z"] / STEPS, r["label"], r["count"]) for r in counts), strict=True))
    platt(net, z, truth, n)
    order = np.argsort(net.slope * z, kind="stable")
    z, truth, n = z[order], truth[order], n[order]
    missed = np.cumsum(n * truth)  # findings up to and with each step
    at = z[np.searchsorted(missed, int((1 - RECALL) * missed[-1]), side="right")]
    least = net.slope * at - abs(net.slope) / (2 * STEPS)  # the lower end of the step
    kept = net.slope * z >= least
    net.threshold = float(1 / (1 + np.exp(-np.clip(least + net.shift, -60, 60))))
    net.precision = float((n * truth)[kept].sum() / n[kept].sum())


def train(docs: DataFrame) -> Net | None:
    found = labelled_candidates(docs)
    counts = {(r["apart"], r["label"]): r["count"] for r in found.groupBy(F.expr("pmod(h, 3) = 0").alias("apart"), "label").count().collect()}
    if len({label for _, label in counts}) < 2 or sum(counts.values()) < 30:
        return None
    low, high = (counts.get((False, label), 0) for label in (0, 1))
    shards = max(1, min(SHARDS, -(-(low + high) // SHARD_ROWS)))
    rows, net = sharded(found.where("pmod(h, 3) <> 0"), shards), fresh()
    passes = ROUNDS if shards == 1 else 1
    for _ in range(ROUNDS // passes):
        net = _one_round(rows, net, class_weights(low, high), passes)
    _settle(found.where("pmod(h, 3) = 0"), net)
    return net


def scan(docs: DataFrame, net: Net | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep` and secrets: array of (kind, start, stop, score) by start, then kind as listed."""
    names = [*keep, "secrets"]
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                     T.StructField("stop", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))

    def find(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            column, made = batch.column(len(keep)), []
            for item in column:
                t = item.as_py() or ""
                base = base_spans(t)
                free = [s for s in candidates(t) if not _covered(s, base)] if net else []
                scores = net.probability([window(t, s) for s in free]) if free else []
                found = [(k, a, b, 1.0) for k, a, b in base] + [
                    ("net", *s, float(p)) for s, p in zip(free, scores, strict=True) if p >= net.threshold
                ]
                made.append([dict(zip(("kind", "start", "stop", "score"), x, strict=True)) for x in sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(made, arrow)], names=names)

    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_llm_text"))
    return picked.mapInArrow(find, T.StructType([*[docs.schema[c] for c in keep], T.StructField("secrets", span)]))


def digest(docs: DataFrame) -> DataFrame:
    found = scan(docs, train(docs))
    count = lambda kind: f"cast(size(filter(secrets, x -> x.kind = '{kind}')) AS bigint) AS n_{kind}"
    joined = "concat_ws(',', transform({}, x -> concat_ws(':', x.kind, x.start, x.stop)))"
    return found.selectExpr(
        "doc_id", *[count(k) for k in KINDS[:-1]],
        f"sha2({joined.format('''filter(secrets, x -> x.kind <> 'net')''')}, 256) AS base_sha256", f"{joined.format('secrets')} AS spans", count("net"),
    )
