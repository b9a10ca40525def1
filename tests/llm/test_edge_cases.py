"""Canonical URLs and missing values of captures, clashing names, small label samples, stretches cut out, quality's threshold."""

import collections
import re

import pytest

from meterwatch.llm import common, decontam, quality, simhash, toxicity, warc

CAPTURE = "record_id long, url string, ts long, full boolean, etag string, modified long, digest string, headers map<string,string>"


@pytest.mark.parametrize(("url", "want"), [
    ("http://a.com:8080/x", "a.com:8080/x"), ("localhost:8081", "localhost:8081"), ("a.com:4431/x", "a.com:4431/x"),
    ("http://A.com:80/x/", "a.com/x"), ("https://a.com:443", "a.com"), ("http://a.com:443/x", "a.com:443/x"), ("https://a.com:80/x", "a.com:80/x"),
    ("HTTPS://WWW.a.com:443/X?utm_source=1&b=2&ref=z#top", "a.com/X?b=2"), ("a.com:80?q=1", "a.com?q=1"), ("http://[::1]:80/a", "[::1]/a"),
    ("www.a.com", "a.com"), ("http://a.com/www.b:80/c", "a.com/www.b:80/c"), (None, None),
])
def test_canonical_urls(spark, url, want):
    assert spark.createDataFrame([(url,)], "url string").selectExpr(f"{warc.canonical('url')} AS u").first().u == want


def test_headers_and_missing_values_of_captures(spark):
    rows = [
        (1, "http://a.com", 10, True, '"t"', None, "d1", {"Content-Type": "text/html", "DATE": "old", "Server": "s"}),
        (2, "http://a.com", 50, None, 'W/"t"', None, None, {"Date": "new", "date": "newer", "Cache-Control": "max-age=1", "Set-Cookie": "x"}),
        (3, "http://b.com", None, True, '"t"', None, "d3", None), (4, "http://b.com", 50, False, '"t"', None, None, None),
        (5, None, 1, True, '"t"', None, "d5", None), (6, None, 2, False, '"t"', None, None, None), (7, "http://a.com", None, False, '"t"', None, None, None),
    ]
    frame = spark.createDataFrame(rows + rows[1:2], CAPTURE).selectExpr("*", "'x' AS chunk", "1 AS r", "2 AS inside")
    got = collections.Counter((r.record_id, r.response_id, r.outcome, r.digest, r.headers) for r in warc.resolve(frame).collect())
    merged = "cache-control=max-age=1;content-type=text/html;date=newer;server=s"
    assert got == {(2, 1, "resolved", "d1", merged): 2, (4, None, "orphan", None, None): 1, (6, None, "orphan", None, None): 1, (7, None, "orphan", None, None): 1}
    assert warc.resolve(spark.createDataFrame([], CAPTURE)).collect() == []


def test_the_latest_of_responses_at_one_time(spark):
    rows = [(1, "a.com", 5, True, "x", None, d, None) for d in ("d1", "d2")] + [(9, "a.com", t, False, "x", None, None, None) for t in (6, 99_999)]
    assert {r.digest for r in warc.resolve(spark.createDataFrame(rows, CAPTURE)).collect()} == {"d2"}


CLASHES = (
    "key", "hit_id", "hit_key", "places", "items", "block", "held", "win_id", "win_key", "lr", "score", "predicted", "label", "label_id", "fp", "root",
    "trusted_id", "c", "h", "n", "ws", "t", "f", "k0", "node",
)


@pytest.fixture(scope="module")
def clashing(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my"
    rows = [(i, f"{words} {i} you idiot stupid" if i % 3 == 0 else f"plain text number {i} about cats and dogs", i) for i in range(60)]
    rows += [(60, "start one two three four five six seven eight nine ten end", 1), (61, None, 1), (None, "", 1), (5, rows[5][1], 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    return frame.selectExpr("doc_id", "text", *[f"extra AS {name}" for name in CLASHES])


def test_names_of_other_columns_do_not_matter(spark, clashing):
    bench = spark.createDataFrame([("b", "one two three four five six seven eight nine ten")], "item_id string, text string").selectExpr("*", "1 AS n", "2 AS h")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 != 0)) for i in range(60)], "doc_id long, toxic int, quality int").selectExpr("*", "1 AS label")
    kept = decontam.remove(clashing, bench)
    assert kept.columns == clashing.columns and kept.count() == clashing.count() - 1
    cut = decontam.cut_spans(clashing, bench)
    assert cut.columns == clashing.columns and {r.doc_id: r.text for r in cut.collect()}[60] == "start  end"
    once = simhash.one_of_each(clashing)
    assert once.columns == clashing.columns and once.count() < clashing.count()
    mild = toxicity.drop_toxic(clashing, labels)
    assert mild.columns == clashing.columns and 0 < mild.count() < clashing.count()
    assert len(quality.judge(clashing, labels).collect()) == clashing.count()
    assert len(toxicity.digest(clashing, labels).collect()) == clashing.count()


def test_two_labelled_documents_are_enough(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["you idiot"] * 3 + ["good day"] * 3)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (3, 0), (99, 1), (None, 0)], "doc_id long, toxic int")
    got = toxicity.score(docs, docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in toxicity.score(docs, docs, labels.where("toxic = 1")).collect())


def test_stretches_are_cut_as_word_by_word(spark):
    text = "A one two three, four; five six! seven B. one two three four five six seven one two three four five six seven C"
    bench = spark.createDataFrame([("b", "one two three four"), ("c", "three four five six seven")], "item_id string, text string")
    docs = spark.createDataFrame([(1, text), (2, "nothing here"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in decontam.cut_spans(docs, bench).collect()}
    pieces = re.findall(r"([^A-Za-z0-9]*)([A-Za-z0-9]+)", text)
    out, inside = "", False
    for gap, word in pieces:
        hit = word not in "ABC"
        out += (gap if not (hit and inside) else "") + ("" if hit else word)
        inside = hit
    assert got == {1: out, 2: "nothing here", 3: None}


def test_quality_threshold_follows_the_trusted_documents(spark):
    good = [(i, " ".join(f"good{(i * 7 + j) % 50}" for j in range(60))) for i in range(200)]
    bad = [(i, " ".join(f"bad{(i * 7 + j) % 50}" for j in range(60))) for i in range(200, 400)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 200, 2)] + [(i, 0) for i in range(200, 400, 2)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.judge(docs, labels).collect() if r.kept}
    assert len(kept & set(range(200))) >= 198 and not kept & set(range(200, 400))
    measured = quality.judge(docs, labels).drop("kept")
    least = lambda keep, marks: quality.threshold(measured, marks, keep).first().least
    score = {r.doc_id: r.score for r in measured.collect()}
    trusted, rejected = sorted(score[i] for i in range(0, 200, 2)), sorted(score[i] for i in range(200, 400, 2))
    assert least(1, labels) == pytest.approx((trusted[0] + rejected[-1]) / 2)
    # where the two overlap, the trusted ones decide
    mixed = labels.unionAll(spark.createDataFrame([(i, 0) for i in range(1, 200, 2)], "doc_id long, quality int"))
    assert least(0.75, labels) < least(0.75, mixed) <= trusted[24] + 0.75 * (trusted[25] - trusted[24])
    assert all(r.kept != r.base_failed for r in quality.judge(docs, labels.where("quality = 0")).collect())


def test_a_session_without_a_shared_folder_gets_its_own(spark):
    folder = common.shared_folder(spark)
    assert folder and common.shared_folder(spark) == folder


def test_words_of_later_letters_split_as_in_the_library(spark):
    import random

    import public_tokenizers
    import tiktoken

    from meterwatch.llm import bpe

    pieces = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})
    rng = random.Random(6)
    later = [chr(c) for r in (bpe.LATER_LETTERS + " " + bpe.LATER_NUMBERS).split() for c in {int(x, 16) for x in r.split("-")}]
    others = ["믋", "a", " ", "1", "!", "é", "　", " ", "\n", "́", "\U0001f600", "٣", "中"]
    texts = ["".join(rng.choice(later if rng.random() < 0.4 else others) for _ in range(12)) for _ in range(4000)]
    texts += ["".join(chr(c) for c in range(at, at + 512) if not 0xD800 <= c < 0xE000) for at in range(0, 0x32400, 512)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in bpe.encode(docs, pieces, public_tokenizers.PATTERN).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != library.encode_ordinary(t)] == []
