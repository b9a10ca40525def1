"""The pipeline's stages on planted rows, each against brute force on its own input."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken

from meterwatch.llm.queries import pieces

PASSAGE = "one two three four five six seven eight nine ten"


def planted():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    data = [" ".join(rng.choices(words, k=40) + (["scumbag", "you", "Idiots"] * 2 if i % 4 == 0 else [])) for i in range(200)]
    toxic = [i for i in range(200) if i % 4 == 0]
    data[11], data[13], data[17] = data[9], f"{data[13]} {PASSAGE}", f"{data[17]} a@b.cd"
    return [(i, t, "en", "web", len(t)) for i, t in enumerate(data)], toxic


def test_stages_against_brute_force(spark, tmp_path, monkeypatch):
    data, toxic = planted()
    made = {
        "documents": spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": spark.createDataFrame([(i, int(i in toxic)) for i in range(200)], "doc_id long, toxic int"),
        "benchmark": spark.createDataFrame([("b", PASSAGE)], "item_id string, text string"),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    whole = {r[0]: r for r in data}
    clean = {i: r for i, r in whole.items() if i not in toxic}
    single = {i: r for i, r in clean.items() if i != 11}
    safe = {i: r for i, r in single.items() if i != 13}
    masked = {i: (i, t := r[1].replace("a@b.cd", "<EMAIL>"), *r[2:4], len(t)) for i, r in safe.items()}
    want = dict(zip([name for name, _ in corpus_pipeline.STAGES], (clean, single, safe, masked), strict=False))
    seen = []

    def watched(name, stage):
        def run(spark, docs, sf_dir):
            out = stage(spark, docs, sf_dir)
            if name in want:
                assert out.columns == docs.columns == made["documents"].columns
                got = [tuple(r) for r in out.collect()]
                assert sorted(got) == sorted(want[name].values()), name
            seen.append(name)
            return out
        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(n, s)) for n, s in corpus_pipeline.STAGES])
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert seen == ["toxicity", "simhash_near_dedup", "decontamination", "pii", "byte_bpe"] and got.keys() == masked.keys()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces())}, special_tokens={})
    for i, r in masked.items():
        ids = library.encode_ordinary(r[1])
        assert list(got[i].ids) == ids and got[i].lang == "en" and got[i].source == "web"
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(r[1].encode()).hexdigest()
