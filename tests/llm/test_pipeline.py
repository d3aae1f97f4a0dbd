import os
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import quality, simhash, substrings
from tests.llm.frames import DOCS, awkward, planted, sentence
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_simhash import groups_of


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_repeats(rows):
    first, out = {}, []
    for r in rows:
        words, key = split(r["text"]), (r["doc_id"] is None, r["doc_id"] or 0, r["text"])
        for p in range(len(words) - 19):
            w = tuple(words[p:p + 20])
            first[w] = min(first.get(w, (*key, p)), (*key, p))
    for r in rows:
        words, key = split(r["text"]), (r["doc_id"] is None, r["doc_id"] or 0, r["text"])
        gone = {q for p in range(len(words) - 19) if first[tuple(words[p:p + 20])] < (*key, p) for q in range(p, p + 20)}
        kept = " ".join(w for p, w in enumerate(words) if p not in gone) if gone else r["text"]
        if split(kept):
            out.append({**r, "text": kept})
    return out


def test_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "THRESHOLD", 0.0)  # scores have tests of their own
    rng = random.Random(4)
    rows = [tuple(r)[:5] for r in awkward(spark).collect() if r["doc_id"] != 7]  # texts of one id have an order of their own
    rows += [(None, sentence(rng, 33 + i), "en", "b", 0) for i in range(12)]  # sizes decide between rows without an id
    rows += [(20 + i // 2, sentence(rng, 50 + i), "en", "a", 0) for i in range(12)] + [(None, rows[8][1], "en", "a", 0)] * 2
    folder = str(tmp_path)
    spark.createDataFrame(rows, DOCS).write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(20, 1, 0), (21, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")

    docs = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]
    best = {}
    for r, group in zip(docs, groups_of(docs)):
        best[group] = min(best.get(group, r), r, key=lambda x: (x["doc_id"] is None, x["doc_id"] or 0))
    docs = without_repeats(list(best.values()))
    taken = {(i, n): t for i, n, *_, t in mixed(docs)}
    assert len(taken) == len(docs) and sum(r["doc_id"] is None for r in docs) > 10
    want, tokenizer = Counter(), Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    for r in docs:
        words = split(r["text"])
        whole, part = divmod(taken[r["doc_id"], len(words)], len(words))
        for text in [r["text"]] * whole + [" ".join(words[:part])] * (part > 0):
            ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
            for piece, start in enumerate(range(0, len(ids), 2048)):
                want[r["doc_id"], piece, start, tuple(ids[start:start + 2048])] += 1
    got = Counter((r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist()))
                  for r in corpus_pipeline.run(spark, folder).collect())
    assert got == want


def test_stages_pass_few_texts_at_a_time(spark, tmp_path, monkeypatch):
    """Scoring, fingerprints, segments, their words and the cut itself get whole texts in small batches."""
    spark.range(9).selectExpr("id as doc_id", "int(id % 2) as quality").write.parquet(f"{tmp_path}/labels.parquet")
    seen, name, docs = Counter(), "spark.sql.execution.arrow.maxRecordsPerBatch", planted(spark)
    before = spark.conf.get(name)
    for module in (corpus_pipeline, simhash, substrings):
        monkeypatch.setattr(module, "step", lambda rows, own=module.step: (
            seen.update([(spark.conf.get(name), *rows.columns)]), own(rows))[1])
    corpus_pipeline.quality_classifier(spark, docs, str(tmp_path))
    simhash.keep_first(docs)
    substrings.without_repeats(docs)
    few = {columns[1:]: n for columns, n in seen.items() if columns[0] == "1024"}
    assert few == {("doc_id", "text", "lang", "source", "n_chars"): 2, ("doc_id", "fingerprint"): 1,
                   ("doc", "uid", "hash", "digest", "place"): 1,
                   ("doc", "uid", "place", "hash", "digest", "crowded", "words"): 1}
    assert spark.conf.get(name) == before


def test_copies_of_texts_go_with_their_last_reader(spark, monkeypatch):
    gone, docs = [], planted(spark)
    monkeypatch.setattr(simhash, "removed", lambda df, own=simhash.removed: (gone.append(
        (df.columns, [f.removeprefix("file://") for f in df.inputFiles()])), own(df)))
    assert simhash.keep_first(docs).count() > 0
    (columns, files), = gone
    assert "text" in columns and files and not any(os.path.exists(f) for f in files)
