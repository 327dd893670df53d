"""The corpus pipeline as a whole, against what its stages promise."""

import random
import re
from collections import Counter


import corpus_pipeline
from fundcast.session import scratch_path, share_code

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def folder(spark, docs, labels, items):
    path = scratch_path(spark, "pipeline-input")
    spark.createDataFrame(docs, DOCS).repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def corpus():
    rnd = random.Random(12)
    vocabulary = [a + b + c for a in "ba ke li mo nu".split() for b in "ra se ti vo za".split() for c in "n s t".split()]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    docs, labels = [], []
    for i in range(160):
        toxic = i % 5 == 0
        t = text(rnd.randint(40, 80)) + (" you are a worthless idiot, you moron" * 3 if toxic else "")
        docs.append([i, t, "en", "abc"[i % 3], 1])
        labels.append((i, 1, int(toxic)))
    item = text(25)
    docs += [[200 + i, text(30) + " " + item + " " + text(10), "en", "a", 1] for i in range(3)]
    near = text(90)
    docs += [[300 + i, near if i else near + " more", "en", "b", 1] for i in range(6)]
    docs += [[400, None, "en", "a", 1], [401, "", "en", "b", 1], [None, text(50), "en", "a", 1]]
    return [tuple(d) for d in docs], labels, [(1, item), (2, text(20))]


def test_stages_keep_what_they_promise(spark):
    docs, labels, items = corpus()
    path = folder(share_code(spark), docs, labels, items)
    frame = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, path)
        target = scratch_path(spark, "stage")
        frame.write.parquet(target)
        frame = spark.read.parquet(target)
        kept[name] = frame.collect()
        if name != "token files":
            assert frame.columns == list(corpus_pipeline.COLUMNS)
    ids = {name: {r.doc_id for r in rows} for name, rows in kept.items()}
    given = {d[0] for d in docs}
    toxic = {i for i, _, t in labels if t}
    assert ids["toxicity"] == given - toxic
    # of the near copies the first one stays
    assert ids["n-gram Jaccard join"] == ids["toxicity"] - {301, 302, 303, 304, 305}
    assert ids["benchmark decontamination"] == ids["n-gram Jaccard join"] - {200, 201, 202}
    mixed = Counter(r.doc_id for r in kept["mixing to target weights"])
    assert set(mixed) <= ids["benchmark decontamination"] and max(mixed.values()) <= 2
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in kept["benchmark decontamination"]}
    assert abs(sum(size[i] * n for i, n in mixed.items()) - 1.5 * sum(size.values())) <= 3 * max(size.values())
    assert Counter(r.doc_id for r in kept["token files"]) == mixed
    rows = sorted(kept["token files"], key=lambda r: r.start)
    assert rows[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


def test_an_empty_corpus_gives_no_rows(spark):
    _, labels, items = corpus()
    path = scratch_path(spark, "pipeline-empty")
    spark.createDataFrame([], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    out = corpus_pipeline.run(share_code(spark), path)
    assert out.count() == 0 and set(out.columns) >= {"doc_id", "start", "n_tokens", "ids_crc32"}
