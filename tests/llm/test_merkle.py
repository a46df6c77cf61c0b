"""The Merkle manifest against a plain tree."""

import hashlib
import zlib
from collections import Counter

from fringeframe.llm import merkle
from pyspark.sql import functions as F

S = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {c: c + 32 for c in range(65, 91)}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests):
    """(root, steps of every leaf)"""
    steps, members = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        up, held = [], []
        for a in range(0, len(digests), 8):
            run = digests[a : a + 8]
            for j in range(len(run)):
                for m in members[a + j]:
                    steps[m].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(h(*run))
            held.append(sum(members[a : a + 8], []))
        digests, members = up, held
    return digests[0], steps


def plain(rows):
    groups = {}
    for d, text, lang, source, n in rows:
        leaf = lambda t: h(*map(framed, (d, source, lang, n, t)))
        tampered = d is not None and text is not None and zlib.crc32(str(d).encode()) % 3 == 0
        groups.setdefault(lang, []).append((d, leaf(text), leaf(text.translate(LOWER)) if tampered else leaf(text)))
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subs = [tree([x[1] for x in groups[g]]) for g in langs]
    root, above = tree([s[0] for s in subs]) if subs else (None, [])
    out = Counter()
    for g, (sub, inner), outer in zip(langs, subs, above):
        for (d, leaf, found), own in zip(groups[g], inner):
            acc = found
            for a, b in own + outer:
                acc = h(a, acc, b)
            out[(d, leaf, sub, root, h(*[a + b for a, b in own + outer]), acc, acc == root)] += 1
    return out


def check(df):
    got = Counter(tuple(r) for r in merkle.manifest(df).collect())
    assert got == plain([tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    return got


def test_given_table(spark, sf):
    got = check(spark.read.parquet(f"{sf}/documents.parquet"))
    assert {k[6] for k in got} == {True, False}


def test_many_languages_and_sizes(spark):
    """Trees of every height, 70 languages under a two-level root, null ids and languages, repeated rows."""
    rows = [(None, None, None, None, None), (None, "A", None, "s", 1), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (3, "ABC", "en", None, 3), (9, "x", "lone", "s", 1), (4, "É" * 3, "ä", "s", 6)]
    rows += [(i, f"T{i}", f"l{i % 70}", "s", i) for i in range(10, 400)] + [(i, f"T{i}", "big", "s", i) for i in range(1000, 1600)]
    rows += [(i, "x" * 100_000 + "Y", "eight", "s", 1) for i in range(8)]
    df = spark.createDataFrame(rows, S).repartition(6)
    check(df)
    for c in ("at", "hash", "above", "node", "found", "slot0", "height", "_part", "root"):
        df = df.withColumn(c, F.lit(1))
    check(df)


def test_small_tables(spark):
    rows = [(3, "ABC", "en", None, 3), (None, "A", None, "s", 1), (2, "", "en", "a", 0), (2, "", "en", "a", 0)]
    for part in ([], rows[:1], rows[:2], rows[2:], rows):
        assert sum(check(spark.createDataFrame(part, S)).values()) == len(part)


def test_one_child_runs(spark):
    """A last run of a single node is hashed on its own at every level: 9, 65 and 513 leaves."""
    for n in (8, 9, 64, 65, 513):
        check(spark.createDataFrame([(i, "Abc", "en", "s", 1) for i in range(n)], S))


def test_other_fanout(spark):
    df = spark.createDataFrame([(i, "abc", "en", "s", 1) for i in range(30)], S)
    rows = merkle.manifest(df, fanout=2).collect()
    assert all(r["verified"] for r in rows) and len({r["proof_sha256"] for r in rows}) == 30
