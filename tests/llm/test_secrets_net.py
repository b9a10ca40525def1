"""The secret network: an independent base scan, a plain convolution with a numeric gradient, and secrets without a keyword."""

import random
import re
import string

import numpy as np
import pytest

from meterwatch.llm import secrets


def base(text):
    found = [("assign", m.span()) for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) > 11]
    found += [("access", m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) > 17]
    found += [("hex", m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) > 15]
    return sorted(((k, *s) for k, s in found), key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def test_base_spans_of_random_texts():
    rng = random.Random(2)
    parts = ["password", "API_KEY", "token", "secret", "=", ":", " ", '"', "'", "AKIA", "abc123def456", "0123456789abcdef", "ABCDEFGHIJKLMN", "é", "\n", "AKIAAKIA", "x", "."]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert secrets.base_spans(text) == base(text)


def small_net(rng):
    return secrets.Net(rng.normal(0, 0.3, (secrets.WIDTH, secrets._CLASSES, secrets.FILTERS)), rng.normal(0, 0.1, secrets.FILTERS), rng.normal(0, 0.5, secrets.FILTERS), 0.2)


def test_the_convolution_as_loops():
    rng = np.random.default_rng(3)
    net = small_net(rng)
    windows = [secrets.window("say key=" + "aB3" * n + " end", (8, 8 + 3 * n)) for n in (4, 5, 9)]
    for w, got in zip(windows, net.logit(windows), strict=True):
        act = [[sum(net.filters[o, w[i + o], f] for o in range(secrets.WIDTH)) + net.bias[f] for i in range(len(w) - secrets.WIDTH + 1)] for f in range(secrets.FILTERS)]
        assert got == pytest.approx(sum(max(max(row), 0) * net.out[f] for f, row in enumerate(act)) + net.offset)


def test_training_lowers_the_loss_as_its_gradient_says():
    """One small step of training moves every output weight against the numeric gradient of the weighted log loss."""
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("aB3xY9zQ1")) for _ in range(20)) if i % 2 else "ordinarywordshere" + "x" * (i % 5) for i in range(60)]
    windows, labels = [secrets.window(t, (0, len(t))) for t in texts], np.array([i % 2 for i in range(60)], float)
    net = secrets.fit(windows, labels, epochs=8)
    given = net.probability(windows)
    assert given[labels > 0].min() > given[labels == 0].max()

    def loss(offset):
        old, net.offset = net.offset, offset
        z = net.logit(windows)
        net.offset = old
        return float(np.mean(np.logaddexp(0, z) - labels * z))

    numeric = (loss(net.offset + 1e-5) - loss(net.offset - 1e-5)) / 2e-5
    z = net.logit(windows)
    assert numeric == pytest.approx(float(np.mean(1 / (1 + np.exp(-z)) - labels)), abs=1e-6)


def test_secrets_without_a_keyword_are_added(spark):
    rng = random.Random(8)
    key = lambda n=28: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(3, 18)))
    prose = lambda: " ".join(word() for _ in range(40))
    docs = [(i, f"{prose()} password = {key()} {prose()}") for i in range(300)]
    docs += [(i, f"{prose()} call 00{rng.randint(10**12, 10**13)} see /usr/share/{word()}/{word()} {prose()}") for i in range(300, 900)]
    planted = {i: key() for i in range(900, 1000)}
    docs += [(i, f"{prose()} {value} {prose()}") for i, value in planted.items()]
    texts = dict(docs)
    got = secrets.digest(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_net"]
    spans = {r.doc_id: r.spans for r in got.collect()}
    hits = sum(f"net:{texts[i].index(v)}:{texts[i].index(v) + len(v)}" in spans[i] for i, v in planted.items())
    assert hits >= 90
    assert sum("net" in spans[i] for i in range(300, 900)) <= 30


def test_all_candidates_train_the_network(spark):
    rows = [(i, f"token = {i:08d}Ab{i:08d} and internationalisierung{i:08d} here") for i in range(7000)]
    rows.append((-1, "say " + "longword" * 100 + " once"))
    found = secrets.labelled_candidates(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("label").agg({"value": "count", "h": "max"})
    assert {r["label"]: r["count(value)"] for r in found.collect()} == {1: 7000, 0: 7001}


def test_shards_learn_together(spark, monkeypatch):
    rng = random.Random(4)
    key = lambda: "".join(rng.choices("ABCDEFGHJKMNPQRSTUVWXYZ23456789", k=20))
    docs = spark.createDataFrame([(i, f"{key()[:9]} token = {key()} and {key()[:5].lower()}internationalisierungen here") for i in range(400)], "doc_id long, text string")
    monkeypatch.setattr(secrets, "SHARD_ROWS", 100)
    net, again = secrets.train(docs), secrets.train(docs.repartition(7))
    assert net.threshold == again.threshold and (net.filters == again.filters).all()
    texts = [f"{key()[:9]} token = {key()} and {key()[:5].lower()}internationalisierungen here" for _ in range(50)]
    keys = net.probability([secrets.window(t, (18, 38)) for t in texts])
    words = net.probability([secrets.window(t, (43, 71)) for t in texts])
    assert (keys >= net.threshold).mean() > 0.9 and (words < net.threshold).all()


def test_pooling_in_segments(monkeypatch):
    rng = np.random.default_rng(6)
    net = small_net(rng)
    windows = [secrets.window("x" + "aB3-z" * n + "y", (1, 1 + 5 * n)) for n in (3, 90, 7, 41)]
    best, where = net.pooled(windows)
    monkeypatch.setattr(secrets, "SEGMENT", 50)
    cut_best, cut_where = net.pooled(windows)
    assert np.allclose(best, cut_best) and (where == cut_where).all()
