"""Each operator against brute force on small rows, the defined cases, and empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from meterwatch.llm import bpe, decontam, langid, lm, pii, quality, secrets, simhash, toxicity, warc

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def rows(df):
    return [r.asDict() for r in df.collect()]


def texts(docs):
    return collections.Counter((r.doc_id, r.text) for r in docs.collect())


@pytest.fixture(scope="module")
def pieces():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_pii_base_and_added(docs):
    found = {r["doc_id"]: r for r in rows(pii.digest(docs))}
    text = next(r.text for r in docs.collect() if r.doc_id == 1)
    one = found[1]
    assert (one["n_email"], one["n_ip"], one["n_card"], one["n_phone"]) == (1, 1, 1, 1)
    spots = [("email", "bob.42@mail8.example.com"), ("ip", "10.0.0.255"), ("card", "4539 1488 0343 6467"), ("phone", "+49 30 1234-5678")]
    base = ",".join(f"{k}:{text.index(v)}:{text.index(v) + len(v)}" for k, v in spots)
    assert one["base_sha256"] == sha(base) and one["spans"] == base
    assert [s.split(":")[0] for s in found[7]["spans"].split(",")] == ["iban", "ssn"]
    assert found[2]["spans"] == found[3]["spans"] == ""


def test_pii_matches_after_a_match(spark):
    text = "a@b.cx%y@d.ef 1.2.3.4.5.6.7.8 " + "1." * 3000 + " +1 (2) 3"
    base = {k: p for k, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"))}
    got = rows(pii.find_pii(spark.createDataFrame([(text,)], "text string")))[0]["pii"]
    for kind, pattern in base.items():
        assert [(s["start"], s["stop"]) for s in got if s["kind"] == kind] == [m.span() for m in re.finditer(pattern, text)]


def test_redact(spark):
    out = rows(pii.redact(spark.createDataFrame([("to a@b.cd now", 1), (None, 2)], "text string, pii int")))
    assert [r["text"] for r in out] == ["to <EMAIL> now", None] and [r["pii"] for r in out] == [1, 2]


def test_bpe_as_the_library(docs, pieces):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})
    got = collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(bpe.digest(docs, pieces, public_tokenizers.PATTERN)))
    want = collections.Counter()
    for (i, t), n in texts(docs).items():
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(t or "")] += n
    assert got == want
    tokens = bpe.decode(bpe.encode(docs, pieces, public_tokenizers.PATTERN), pieces)
    assert sorted(bytes(r["decoded"]).decode() for r in rows(tokens)) == sorted((r.text or "") for r in docs.collect())


def test_bpe_heap_is_the_same(pieces):
    of = {p: i for i, p in enumerate(pieces)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=of, special_tokens={})
    for word in ("a" * 700, "abcab" * 90, "zß" * 200, "the" * 150):
        assert bpe._heap_merge(word.encode(), of) == library.encode_ordinary(word)


def test_bpe_folds_a_word_once_a_partition(spark, pieces, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_BYTES", 1)
    monkeypatch.setattr(bpe, "_fold", lambda word: f"transform({word}, x -> CAST(1e9 * rand() AS INT))")  # other ids with every fold
    twice = spark.createDataFrame([(i, f" zqxjk zq{i}xjk") for i in range(6)], "doc_id long, text string").coalesce(1)
    ids = [tuple(r["ids"][:6]) for r in rows(bpe.encode(twice, pieces, public_tokenizers.PATTERN))]
    assert len(ids) == 6 and len(set(ids)) == 1


@pytest.mark.parametrize("held", [0, 90, bpe.HELD_BYTES])
def test_bpe_batches_of_a_partition(spark, pieces, monkeypatch, held):
    monkeypatch.setattr(bpe, "BATCH_BYTES", 40)
    monkeypatch.setattr(bpe, "HELD_BYTES", held)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})
    texts = [" zqxjk the wörd", None, "", " zqxjk", "x" * 300 + " zqxjk", " the yyqzz\n\n", "x" * 300, "", " yyqzz zqxjk wörd", "💩💩 the", " zqxjk 💩💩"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["ids"] for r in rows(bpe.encode(docs, pieces, public_tokenizers.PATTERN))}
    assert got == {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}


@pytest.mark.parametrize("block", [3, 1000])
def test_decontamination(spark, docs, block):
    bench = spark.createDataFrame(
        [("a", "TWO three four five six seven eight nine ten eleven"), ("b", "x1 wörd"), ("c", ""), ("d", None), ("d", "x1 wörd")], "item_id string, text string"
    )
    found = rows(decontam.contamination(docs, bench, block=block))
    assert len(found) == docs.count()
    by = {r["doc_id"]: r for r in found}
    assert by[None]["items"] == ["a"] and [tuple(p) for p in by[None]["places"]] == [(2, 11)]
    assert by[6]["items"] == ["b", "d"] and by[2]["places"] is None and by[2]["n_words"] == 0
    digest = {r["doc_id"]: r for r in rows(decontam.digest(docs, bench))}
    assert digest[None]["n_hit"] == 10 and digest[6]["n_hit"] == 2 * 2999 and digest[6]["items_sha256"] == sha("b,d")
    kept = decontam.remove(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    cut = {r["doc_id"]: r["text"] for r in rows(decontam.cut_spans(docs, bench))}
    assert cut[None].strip() == "one" and cut[2] is None


def test_language_model(spark):
    rng = random.Random(3)
    pools = [["the", "of", "and", "cat", "dog"], ["der", "und", "die", "katze", "hund"]]
    data = [(i, " ".join(rng.choice(pools[i % 2]) for _ in range(30))) for i in range(300)] + [(300, None), (301, "neu " * 3), (None, "The")]
    got = {r["doc_id"]: r for r in rows(lm.digest(spark.createDataFrame(data, "doc_id long, text string")))}
    words = {i: SPLIT.findall((t or "").translate(LOW)) + [""] for i, t in data}
    out = {i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i in words}
    counts = collections.Counter(w for i, ws in words.items() if not out[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in words.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] <= 0
    apart = [r for i, r in got.items() if r["held_out"] and i is not None]
    assert sum(r["score"] for r in apart) > sum(r["base_score"] for r in apart)


def test_language_model_rounds_settle_on_long_documents(spark):
    rng = random.Random(4)
    pools = [[f"{p}{i}" for i in range(40)] for p in ("a", "b", "c")]
    data = [(i, " ".join(rng.choice(pools[i % 3]) for _ in range(2200))) for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("held_out", lm.F.lit(False))
    uni = lm.unigrams(lm.token_counts(docs))
    model = lm.train(lm.coded(docs, uni), uni)
    gains = np.diff(model.history)
    assert len(gains) and gains[-1] <= lm.SETTLED * abs(model.history[-1]) and all(g > lm.SETTLED * abs(model.history[-1]) for g in gains[:-1])
    # every document is longer than 2,000 words and draws from one pool of 40; base is log10(120) a word
    assert model.history[-1] / (60 * 2201) > -math.log10(60)


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(0)
    model = lm.Model(rng.dirichlet([1, 1]), rng.dirichlet([1, 1], 2), rng.dirichlet([1, 1, 1], 2).T)
    flat = np.array([0, 2, 1, 2], np.int16)
    logs, _ = lm._forward(model, flat, np.array([0]), np.array([4]), keep=False)
    total = sum(
        model.start[s[0]] * math.prod(model.move[a, b] for a, b in zip(s, s[1:])) * math.prod(model.emit[o, k] for o, k in zip(flat, s, strict=True))
        for s in np.ndindex(2, 2, 2, 2)
    )
    assert logs[0] == pytest.approx(math.log10(total))


def test_toxicity(spark, docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    data = [(i, " ".join(rng.choices(words, k=40) + (["scumbag", "you", "Idiots"] * 2 if i % 4 == 0 else []))) for i in range(400)]
    d, labels = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in rows(toxicity.digest(d, labels))}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and r["predicted"] == int(i % 4 == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    assert {r["score"] for r in rows(toxicity.digest(docs, labels.limit(0)))} == {0.0}
    assert toxicity.drop_toxic(d, labels).columns == d.columns


def test_secrets(spark, docs):
    got = {r["doc_id"]: r for r in rows(secrets.digest(docs))}
    text = next(r.text for r in docs.collect() if r.doc_id == 8)
    spans = [f"assign:{text.index('password')}:{text.index('123456') + 6}", f"hex:{text.index('abcdef')}:{text.index('123456') + 6}",
             f"access:{text.index('AKIA')}:{text.index('AKIA') + 20}", f"hex:{len(text) - 17}:{len(text)}"]
    assert got[8]["spans"] == ",".join(spans) and got[8]["base_sha256"] == sha(",".join(spans)) and got[2]["spans"] == ""
    rng = random.Random(5)
    key = lambda: "".join(rng.choices("ABCDEFGHJKMNPQRSTUVWXYZ23456789", k=20))
    data = [(i, f"token = {key()} and internationalisierungen{i % 7} here") for i in range(120)]
    net = secrets.train(spark.createDataFrame(data, "doc_id long, text string"))
    assert net is not None and net.threshold >= 0.5
    probe = net.probability([secrets.window(f"token = {key()} and", (8, 28)), secrets.window("internationalisierungen3 here", (0, 24))])
    assert probe[0] > probe[1]


def test_secrets_sample_holds_no_copies(spark):
    data = [(i, f"token = {i % 7}abcdefabcdefgh and {i % 7}internationalisierung") for i in range(70)]
    found = rows(secrets.labelled_candidates(spark.createDataFrame(data, "doc_id long, text string"), sample=5))
    assert collections.Counter(r["label"] for r in found) == {1: 5, 0: 5}
    assert len({(r["label"], r["before"], r["value"], r["after"]) for r in found}) == 10


def test_secrets_threshold_keeps_the_recall():
    labels = np.array([float(i % 10 == 0) for i in range(300)])  # nothing tells them apart, so all score near one tenth
    windows = [secrets.window("x abcdefghijklmnop1 y", (2, 19))] * 300
    net = secrets.fit(windows, labels)
    assert net.threshold < 0.5 and (net.probability(windows)[labels > 0] >= net.threshold).mean() >= secrets.RECALL
    assert 0 < net.precision < 0.5


def test_revisits(spark):
    shape = "record_id long, url string, ts long, full boolean, etag string, modified long, digest string, headers map<string,string>"
    data = [
        (1, "http://www.A.com:80/p/", 10, True, '"x"', 5, "d1", {"date": "1", "server": "s"}), (2, "https://a.com/p#f", 90_000, False, 'W/"x"', None, None, {"date": "2", "set-cookie": "c"}),
        (3, "https://a.com/p?utm_source=q", 90_001, False, '"y"', None, None, None), (4, "https://a.com/P", 5, False, None, None, None, {}),
        (5, None, 7, False, None, None, None, {}), (6, "https://a.com/p", 10, False, None, 5, None, {}), (7, "https://a.com/p", 95_000, True, None, 9, "d2", {}),
        (8, "https://a.com/p", 95_001, False, None, None, None, {}),
    ]
    got = {r["record_id"]: r for r in rows(warc.resolve(spark.createDataFrame(data, shape), chunk=1000))}
    assert {i: (r["outcome"], r["response_id"]) for i, r in got.items()} == {
        2: ("resolved", 1), 3: ("mismatch", 1), 4: ("orphan", None), 5: ("orphan", None), 6: ("orphan", None), 8: ("unchecked", 7)}
    assert got[2]["digest"] == "d1" and got[2]["headers"] == "date=2;server=s" and got[3]["digest"] is None


def brute_fp(text):
    ws = SPLIT.findall((text or "").translate(LOW))
    k = min(3, len(ws))
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + k]), 42) for i in range(len(ws) - k + 1)] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs):
    got = rows(simhash.digest(docs))
    assert len(got) == docs.count()
    want = {(i, f"{brute_fp(t):016x}") for i, t in texts(docs)}
    assert {(r["doc_id"], r["fingerprint"]) for r in got} == want
    assert {r["component_id"] for r in got if r["doc_id"] in (2, 3, 4)} == {2}
    assert simhash.one_of_each(docs).count() == len({f for _, f in want})


@pytest.mark.parametrize("max_bits,hot", [(1, 64), (2, 2), (2, 64)])
def test_links_are_all_found(spark, max_bits, hot):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(30)] + [0]
    fps = sorted({b ^ sum(1 << j for j in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(20)} | set(base))
    parent = {f: f for f in fps}

    def find(a):
        return a if parent[a] == a else find(parent[a])

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= max_bits:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    roots = {r["fp"]: r["root"] for r in rows(simhash.classes(df, max_bits, hot))}
    groups = lambda of: sorted(sorted(g) for g in of.values())
    want, got = collections.defaultdict(list), collections.defaultdict(list)
    for f in fps:
        want[find(f)].append(signed(f))
        got[roots[signed(f)]].append(signed(f))
    assert groups(got) == groups(want)


def test_quality(spark, docs):
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1)], "doc_id long, quality int")
    got = rows(quality.judge(docs, labels))
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    for i, t in texts(docs):
        ws = SPLIT.findall(t or "")
        seen = collections.Counter(tuple(ws[j : j + 3]) for j in range(len(ws) - 2))
        covered = {j + k for j in range(len(ws) - 2) if seen[tuple(ws[j : j + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if SPLIT.search(x)]
        r = by[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(ws) < 50 or 100 * len(covered) > 50 * len(ws)) and not (r["base_failed"] and r["kept"])


def test_language(spark):
    data = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in range(60)] + [(60, None, "en"), (61, "12 !", "en"), (62, "", None)]
    got = {r["doc_id"]: r for r in rows(langid.digest(spark.createDataFrame(data, "doc_id long, text string, lang string")))}
    assert all(r["lang_pred"] == ("en" if i % 2 else "de") and 0.5 < r["score"] <= 1 for i, r in got.items() if i < 60)
    assert {got[i]["lang_pred"] for i in (60, 61, 62)} == {"und"} and got[1]["held_out"] == (zlib.crc32(b"1") % 4 == 2)


def test_code_lengths_are_a_code(spark):
    counts = langid.learn_counts(spark.createDataFrame([("en", "abracadabra", 1)], "lang string, text string, doc_id long")).toArrow()
    langs, classes, table = langid.code_table(counts)
    size = round(len(table) ** (1 / 3))
    assert langs == ["en"] and np.exp2(-table.reshape(size, size, size)[:, :, : size - 1]).sum(axis=-1).max() <= 1 + 1e-6


def test_empty_tables(spark, docs, pieces):
    none, labels = docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int, quality int")
    bench = spark.createDataFrame([], "item_id string, text string")
    made = [pii.digest(none), bpe.digest(none, pieces, public_tokenizers.PATTERN), decontam.digest(none, bench), lm.digest(none), toxicity.digest(none, labels),
            secrets.digest(none), simhash.digest(none), quality.judge(none, labels), langid.digest(none)]
    assert [df.count() for df in made] == [0] * len(made)
    assert decontam.digest(docs, bench).where("contaminated").count() == 0
