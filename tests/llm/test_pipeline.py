"""The pipeline against plain versions of its stages, and every stage on awkward tables."""

import zlib

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from fringeframe.llm import jaccard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_equals_plain_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select(COLUMNS).collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    comp = brute.components([(r[0], r[1]) for r in rows], 80, 5)
    rows = [r for r in rows if comp[r[0]][1] == r[0]]
    hit = brute.leaks([(r[0], r[1]) for r in rows], items)
    rows = [r for r in rows if not hit[r[0]][1]]
    kept = spark.createDataFrame(rows, docs.select(COLUMNS).schema)
    mixed = corpus_pipeline.mix_sources(spark, kept, sf).select("doc_id", "text").collect()
    assert {r[0] for r in mixed} <= {r[0] for r in rows} and len(mixed) > 0
    t, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for d, text in sorted((r[0], r[1]) for r in mixed):
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == want


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_awkward_tables(spark, sf, name, stage):
    t = "some words that are said again and again in this little text"
    data = [(None, t, None, None, None), (1, None, "en", "a", 1), (2, "", "en", "a", 0), (3, t, None, "b", 2), (3, t, None, "b", 2), (4, "x " * 40_000, "de", None, 3), (5, "12 !", "en", "a", 4)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    out = stage(spark, df, sf)
    n = out.count()
    if name == "token_store":
        assert n == len(data)
    else:
        assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()
    if name == "jaccard_join":
        assert n == 5  # of the three rows of one text one stays, that with an id; the other four rows are alone
    assert stage(spark, df.limit(0), sf).count() == 0
    wide = df.withColumn("score", F.lit(1)).withColumn("shard", F.lit(2))
    if name != "token_store":
        assert stage(spark, wide, sf).columns == wide.columns
    assert n <= 3 * len(data)


def test_near_copies_of_five_words_at_80(spark, sf):
    """A copy with a fifth of text appended goes: 5-word similarity 0.8 to 0.85. One with a third stays."""
    words = [f"w{i}" for i in range(126)]
    texts = [words[:104], words, [f"v{i}" for i in range(104)], [f"v{i}" for i in range(134)]]
    df = spark.createDataFrame([(i, " ".join(t), "en", "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")

    def plain(k, percent):
        sets = [{tuple(t[i : i + k]) for i in range(len(t) - k + 1)} for t in texts]
        return [d for d, s in enumerate(sets) if not any(100 * len(s & t) >= percent * len(s | t) for t in sets[:d])]

    got = sorted(r["doc_id"] for r in corpus_pipeline.fold_near_copies(spark, df, sf).collect())
    assert got == plain(5, 80) == [0, 2, 3] and plain(4, 85) == [0, 1, 2, 3]


def test_one_row_of_each_component(spark):
    """Unrelated texts under one id or under none are kept; near copies without an id fold; any partitioning gives the same rows."""
    a, b, c = (" ".join(f"{p}{i}" for i in range(60)) for p in "abc")
    rows = [(7, a, "en", "s", 1), (7, b, "en", "s", 1), (9, a + " more", "en", "s", 1), (None, c, None, None, 1), (None, c + " more", None, None, 2), (None, c, "de", None, 1),
            (None, b + " x", "en", "s", 1), (8, "", "en", "s", 0), (8, "  ", "en", "s", 0), (None, None, "en", "s", 0), (7, a, "fr", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("mark", F.lit("m"))
    seen = [sorted(map(str, jaccard.keep_one(df.repartition(n), 80, 5).collect())) for n in (1, 4)]
    assert seen[0] == seen[1] and len(seen[0]) == 6
    kept = {(r["doc_id"], r["text"]) for r in jaccard.keep_one(df, 80, 5).collect()}
    assert kept - {(None, c), (None, c + " more")} == {(7, a), (7, b), (8, ""), (8, "  "), (None, None)} and len(kept) == 6


def test_common_counts():
    """Counts of common values in slices, against plain sets and multisets."""
    rng = np.random.default_rng(1)
    width = jaccard.WIDTH
    try:
        for jaccard.WIDTH in (3, width):
            lists = [rng.integers(0, 60, rng.integers(0, 40)) for _ in range(9)]
            got = jaccard._common(lists, 4, 4)
            want = [[sum((x == v).sum() * (y == v).sum() for v in set(x) | set(y)) for y in lists[4:]] for x in lists[:4]]
            assert (got == want).all()
    finally:
        jaccard.WIDTH = width
