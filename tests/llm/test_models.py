"""Models against plain Python: partial matching, quality scores, toxicity features and calibration."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from meterwatch.llm import langid, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def code_length(text, trees):
    """Bits of a text under trees: order 2, 1, 0, then 1/256; an unseen byte escapes with kinds / (n + kinds)."""
    symbols = [-1, -1, *text.encode()]
    bits = 0.0
    for i in range(2, len(symbols)):
        p = 1.0
        for order in (2, 1, 0):
            seen = trees[order].get(tuple(symbols[i - order : i]))
            if not seen:
                continue
            n, kinds = sum(seen.values()), len(seen)
            if symbols[i] in seen:
                p *= seen[symbols[i]] / (n + kinds)
                break
            p *= kinds / (n + kinds)
        else:
            p /= 256
        bits -= math.log2(p)
    return bits


def test_partial_matching_as_plain_python(spark):
    rng = random.Random(9)
    pools = {"en": "the cat and dog of house 12 with", "de": "der hund und die katze im haus für", "fr": "le chat et la maison où été 7"}
    text = lambda lang: " ".join(rng.choice(pools[lang].split()) for _ in range(rng.randint(1, 12)))
    taught = [(i, text(lang), lang) for i, lang in enumerate(rng.choices(sorted(pools), k=60))]
    asked = [(i, rng.choice([text(rng.choice(sorted(pools))), "zzz ñ qqq", "été hund cat", "x"])) for i in range(80)]
    trees = {lang: ({}, {}, {}) for lang in pools}
    for _, t, lang in taught:
        symbols = [-1, -1, *t.encode()]
        for i in range(2, len(symbols)):
            for order in (2, 1, 0):
                trees[lang][order].setdefault(tuple(symbols[i - order : i]), collections.Counter())[symbols[i]] += 1
    got = langid.predict(spark.createDataFrame(asked, "doc_id long, text string"), spark.createDataFrame(taught, "doc_id long, text string, lang string"))
    for r in got.collect():
        t = dict(asked)[r.doc_id]
        bits = {lang: code_length(t, trees[lang]) for lang in sorted(pools)}
        best = min(bits.values())
        assert bits[r.lang_pred] == pytest.approx(best, rel=1e-5, abs=1e-3)
        assert r.score == pytest.approx(1 / sum(2 ** (best - b) for b in bits.values()), rel=1e-2)
        assert r.bits_per_byte == pytest.approx(best / len(t.encode()), rel=1e-4)


def test_quality_scores_as_plain_python(spark):
    rng = random.Random(10)
    docs = [(i, " ".join(f"{'g' if i % 2 else 'b'}{rng.randint(0, 30)}" for _ in range(rng.choice([0, 1, 2, 55, 80])))) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 120, 3)] + [(None, 1), (500, 1)], "doc_id long, quality int")
    words = {i: WORD.findall(t) for i, t in docs}
    grams = sorted({(w,) for ws in words.values() for w in ws} | {p for ws in words.values() for p in zip(ws, ws[1:])})
    table = spark.createDataFrame([(g[0], g[1] if len(g) > 1 else None) for g in grams], "a string, b string")
    bucket = {(r.a,) if r.b is None else (r.a, r.b): r.h for r in table.selectExpr(
        "a", "b", f"pmod(if(b IS NULL, hash(a), hash(a, b)), {quality.BUCKETS}) AS h").collect()}
    of = {i: [bucket[g] for g in [(w,) for w in ws] + list(zip(ws, ws[1:]))] for i, ws in words.items()}
    raw, target = collections.Counter(), collections.Counter()
    for i, hs in of.items():
        raw.update(hs)
        if i % 3 == 0 and i % 2:
            target.update(hs)
    sums = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    ratio = lambda h: math.log((target[h] + 1) / sums[1]) - math.log((raw[h] + 1) / sums[0])
    got = {r.doc_id: r for r in quality.judge(frame, labels).collect()}
    scored = {i: sum(map(ratio, hs)) / len(hs) for i, hs in of.items() if hs}
    for i, r in got.items():
        assert r.score == (pytest.approx(scored[i]) if i in scored else None)
    quantile = lambda xs, q: (lambda s, at: s[int(at)] + (at % 1) * (s[min(int(at) + 1, len(s) - 1)] - s[int(at)]))(sorted(xs), q * (len(xs) - 1))
    rated = [(i % 2, scored[i]) for i in range(0, 120, 3) if i in scored and not got[i].base_failed]
    good = quantile([s for q, s in rated if q], 1 - quality.KEEP)
    least = min(good, (good + quantile([s for q, s in rated if not q], quality.KEEP)) / 2)
    assert all(r.kept == (not r.base_failed and r.score >= least) for r in got.values())


def plain_features(text, entries):
    letters = lambda s: re.findall(r"[a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in s))
    in_lexicon = lambda w: any(w.encode() + b" " == e or (not e.endswith(b" ") and w.encode()[: len(e)] == e) for e in entries)
    plain, shown, raw = letters(text), WORD.findall(text), text.encode()
    hits = [i for i, w in enumerate(plain) if in_lexicon(w)]
    yous = [i for i, w in enumerate(plain) if w.encode() in toxicity.SECOND_PERSON]
    near = sum(any(abs(h - y) <= toxicity.NEAR for y in yous) for h in hits)
    alike = dict(zip("013457@$!|", "oieastasil", strict=True))
    opened = "".join(alike.get(c, c.lower() if c.isascii() else c) for c in text if c not in "*.,;:_-~'\"`^#%&()[]{}<>?/\\+=")
    unmasked = max(sum(map(in_lexicon, WORD.findall(opened))) - len(hits), 0)
    n, size = max(len(shown), 1), max(len(raw), 1)
    ascii_letters = sum(c.isascii() and c.isalpha() for c in text)
    count = lambda chars: sum(c in chars for c in text)
    return [
        len(hits) / n, math.log1p(len(hits)), math.log1p(unmasked), near / n, len(yous) / n, sum("A" <= c <= "Z" for c in text) / max(ascii_letters, 1),
        sum(w.encode().isupper() and len(w.encode()) > 2 for w in shown) / n, count("!") / size, count("?") / size, count("#*$%&|<>@_~^") / size,
        count("0123456789") / size, ascii_letters / n, math.log1p(len(shown)),
    ]


def test_toxicity_features_as_plain_python():
    rng = random.Random(12)
    entries = frozenset({b"idiot ", b"stupi", b"moron "})
    parts = ["you", "idiot", "Stupid", "st*pid", "1d1ot", "id.iot", "IDIOT!", "moronic", "moron", "hello", "DU", "über", "what?", "a", "42", "@#$", "stupidity", "  ", "\n"]
    for _ in range(500):
        text = "".join(rng.choice(parts) + rng.choice([" ", "  ", ""]) for _ in range(rng.randint(0, 25)))
        got = toxicity.features(text, toxicity.Lexicon(entries))
        assert got == pytest.approx(plain_features(text, entries)), repr(text)


def test_scores_follow_calibrated_margins(spark):
    rng = random.Random(13)
    word = lambda: rng.choice(["cat", "dog", "house", "tree", "nice", "day"])
    docs = [(i, " ".join(word() for _ in range(20)) + (" you idiot scum" if i % 4 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = toxicity.score(frame, frame, labels).withColumn("bad", F.expr("doc_id % 4 = 0")).collect()
    assert all(r.predicted == int(r.score >= toxicity.THRESHOLD) and 0 <= r.score <= 1 for r in got)
    assert min(r.score for r in got if r.bad) > 0.9 and max(r.score for r in got if not r.bad) < 0.1
