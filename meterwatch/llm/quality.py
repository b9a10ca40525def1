"""Quality rules: counting rules, then a hashed n-gram log-likelihood ratio of trusted target against raw corpus.

Words and word pairs are hashed into `BUCKETS` buckets. The raw multinomial counts every document; the target multinomial
counts `TRUSTED` trusted ones at most (`labels.quality` = 1). A document's score is the mean over its n-grams of log(target / raw). It is kept
from a threshold on that comes from the labelled documents which pass the base rules: the middle between the score that `KEEP`
of the trusted ones reach and the one that `KEEP` of the rejected ones do not pass, and never more than the former. The rule is
the same for every document, no draw. Both multinomials are smoothed by one count a bucket and reach the scan as one array through a scalar subquery.

Built-in functions alone. Defined cases: a null, empty or blank text has no words, fails the base rules and scores null;
without trusted documents all ratios are zero, and the base rules decide; labels without an id or of missing documents are left
out; equal rows give equal results; an empty table gives an empty table; names of other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import WORD, let, stored

BUCKETS = 1 << 14
#: Trusted documents that define the target, at most.
TRUSTED = 500_000
#: Share of the trusted documents that must stay.
KEEP = 0.995
WORDS = f"regexp_extract_all(coalesce(text, ''), r'{WORD}', 0)"
_FIRST, _PAIR = f"pmod(hash(ws[i]), {BUCKETS})", f"pmod(hash(ws[i], ws[i + 1]), {BUCKETS})"


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> DataFrame:
    """The ids of documents labelled as good, at most `bound` in the order of their hashes."""
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").selectExpr("doc_id AS trusted_id").distinct()
    return ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(bound)


def gram_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, raw (all documents), target (trusted ones): at most BUCKETS rows.

    The ids are broadcast, as a join by id would move all texts; their bound keeps them at a few MB.
    """
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted_ids(labels)), F.expr("doc_id = trusted_id"), "left")
    grams = let(
        WORDS, "ws",
        f"if(size(ws) = 0, cast(array() AS array<int>), concat(transform(sequence(0, size(ws) - 1), i -> {_FIRST}), "
        f"if(size(ws) < 2, cast(array() AS array<int>), transform(sequence(0, size(ws) - 2), i -> {_PAIR}))))",
    )
    return (
        marked.selectExpr("trusted_id IS NOT NULL AS t", f"explode({grams}) AS bucket")
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("t").alias("target"))
    )


def ratios(counts: DataFrame) -> DataFrame:
    """One row: the log ratio of every bucket, by bucket."""
    spark = counts.sparkSession
    return spark.sql(
        f"""
        WITH every AS (SELECT id, coalesce(raw, 0) + 1 AS raw, coalesce(target, 0) + 1 AS target
                       FROM range({BUCKETS}) LEFT JOIN {{counts}} ON id = bucket),
             whole AS (SELECT sum(raw) AS raw, sum(target) AS target FROM every)
        SELECT transform(sort_array(collect_list(struct(id, r))), x -> x.r) AS lr FROM (
          SELECT id, if((SELECT target FROM whole) = {BUCKETS}, 0D, ln(target / (SELECT target FROM whole)) - ln(raw / (SELECT raw FROM whole))) AS r
          FROM every)
        """,
        counts=counts,
    )


_REPEATS = let(
    # one sort brings equal windows together: by hash, then place
    "sort_array(transform(sequence(1, size(ws) - 2), i -> struct(xxhash64(slice(ws, i, 3)) AS h, i AS i)))", "s",
    let(
        "filter(s, (x, k) -> (k > 0 AND x.h = s[k - 1].h AND slice(ws, x.i, 3) = slice(ws, s[k - 1].i, 3)) "
        "OR (k + 1 < size(s) AND x.h = s[k + 1].h AND slice(ws, x.i, 3) = slice(ws, s[k + 1].i, 3)))",
        "twice",
        "if(size(twice) = 0, 0L, aggregate(sort_array(transform(twice, x -> x.i)), "
        "struct(0 AS upto, 0L AS n), (a, x) -> struct(x + 2 AS upto, a.n + x + 2 - greatest(a.upto, x - 1) AS n), a -> a.n))",
    ),
)


def measures(docs: DataFrame, lr: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, the base counts, base_failed and score of every document."""
    lines = let(
        f"filter(split(t, '\\n', -1), l -> l RLIKE r'{WORD}')", "ls", "cast(size(ls) - size(array_distinct(ls)) AS bigint)"
    )
    score = (
        f"if(size(ws) = 0, cast(NULL AS double), aggregate(sequence(0, size(ws) - 1), 0D, (a, i) -> a + lr[{_FIRST}] + "
        f"if(i + 1 < size(ws), lr[{_PAIR}], 0D)) / (2 * size(ws) - 1))"
    )
    counted = let(
        "_llm_lr", "lr",
        let(
            "coalesce(text, '')", "t",
            let(
                WORDS.replace("coalesce(text, '')", "t"), "ws",
                "struct(cast(size(ws) AS bigint) AS n_words, "
                "cast(aggregate(ws, 0L, (a, w) -> a + char_length(w)) AS bigint) AS word_chars, "
                "cast(char_length(regexp_replace(t, '[^#*$%&|<>]+', '')) AS bigint) AS n_symbols, "
                f"{lines} AS n_dup_lines, if(size(ws) < 4, 0L, {_REPEATS}) AS n_repeat_words, {score} AS score)",
            ),
        ),
    )
    kept = ", ".join(f"`{c}`" for c in keep)
    return docs.sparkSession.sql(
        f"SELECT {kept}, c.*, c.n_words < 50 OR 100 * c.n_repeat_words > 50 * c.n_words AS base_failed FROM ("
        f"SELECT {kept}, {counted} AS c FROM (SELECT {kept}, `text`, (SELECT lr FROM {{lr}}) AS _llm_lr FROM {{docs}}))",
        docs=docs, lr=lr,
    )


def threshold(measured: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """One row: the least score that is kept; null without trusted documents."""
    rated = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("rated_id")).agg(F.max("quality").alias("quality"))
    known = measured.where("NOT base_failed").join(rated, F.expr("doc_id = rated_id")).groupBy().agg(
        F.expr(f"percentile(score, {1 - keep:g}D) FILTER (WHERE quality = 1)").alias("good"),
        F.expr(f"percentile(score, {keep:g}D) FILTER (WHERE quality = 0)").alias("bad"),
    )
    return known.selectExpr("least(good, (good + coalesce(bad, good)) / 2) AS least")


def judge(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """doc_id, the counts, the score and the verdict `kept` of every document."""
    counts = stored(gram_counts(docs, labels), "gram-counts")  # the ratios read them more than once
    lr = stored(ratios(counts), "gram-ratios")
    measured = stored(measures(docs.select("doc_id", "text"), lr), "quality-measures")
    return docs.sparkSession.sql(
        "SELECT *, NOT base_failed AND score >= coalesce((SELECT least FROM {least}), score) AS kept FROM {measured}",
        measured=measured, least=threshold(measured, labels, keep),
    )
