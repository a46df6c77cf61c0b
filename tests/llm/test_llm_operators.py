"""Each operator against a plain version, and its defined results on awkward tables."""

import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from fringeframe.llm import balanced_shards, chat, decontaminate, jaccard, langid, mixing, phrase_dedup, suffix_dedup, tiff, token_store
from fringeframe.llm.queries import QUERIES
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                     StructField("source", StringType()), StructField("n_chars", LongType())])
R = random.Random(5)
VOCAB = ["".join(R.choice("abcdefghij") for _ in range(R.randint(2, 7))) for _ in range(400)]
PASSAGE = " ".join(R.choice(VOCAB) for _ in range(70))
LEAK = " ".join(R.choice(VOCAB) for _ in range(14))
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def prose(n, r=R):
    return " ".join(r.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty, blank and long texts, copies, near copies, shared passages, a leak, control strings, non-ASCII."""
    base = prose(200)
    edit = base.split()
    edit[50] = "EDITED"
    texts = [None, "", "   \n\t ", "One", "one", "1234 !!", prose(30), base, base, " ".join(edit), base.upper(), prose(40) + " " + PASSAGE + " " + prose(40),
             PASSAGE + "\n" + prose(60), prose(9) + "  " + LEAK.replace(" ", ",  ") + " " + prose(5), "x" * 900, "ab " * 700, prose(20_000),
             "naïve Straße   日本語 <|endoftext|> a  b   c \n\n d ", prose(25) + " " + PASSAGE, PASSAGE, "é" * 450, prose(120), "tail  ", "\x1c x"]
    out = [(i, t, ("en", "de")[i % 2] if i != 3 else None, ("a", "b", None, "c")[i % 4], 0) for i, t in enumerate(texts)]
    return out + [(100 + i, prose(60), "en", "a", 1) for i in range(20)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and repeated rows, with further columns of clashing names."""
    t = prose(80)
    data = [(None, t, "en", None), (None, None, None, "s"), (7, t, "en", "s"), (7, t, "en", "s"), (8, "short one", "en", "s"), (None, "   ", "en", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    names = ["size", "shard", "slot", "copy", "order", "_key", "_u", "score", "lang_pred", "rid", "spans", "n_hit", "items", "target", "source_size", "sid", "start", "prefix"]
    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ---- 1 mixing

def test_targets_stop_at_three_rounds():
    t = mixing.targets([10, 1000, 5], [1, 1, 3])
    assert t[0] == 30 and t[2] == 15 and abs(sum(t) - 1015) < 1e-6
    assert mixing.targets([0, 0], [1, 2]) == [0, 0] and mixing.targets([], []) == []


def test_split_tree_is_exact():
    quotas = np.array([17, 0, 400, 3])
    leaves = mixing.split_tree(quotas, 7, np.random.default_rng(0))
    total = np.zeros(4, int)
    for who, n in leaves:
        total[who] += n
    assert (total == quotas).all()
    each = [int(n.sum()) for _, n in leaves]
    assert max(each) - min(each) <= 1


def test_mix(docs, rows):
    got = by_id(mixing.mix_report(docs))
    assert set(got) == {r[0] for r in rows}
    sizes, taken, target = {}, {}, {}
    for d, t, _, s, _ in rows:
        r = got[d]
        assert r["size"] == len(brute.words(t)) and r["taken"] <= 3 * r["size"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
    order = sorted((s for s in sizes if s), key=str) + [None]
    want = mixing.targets([sizes[s] for s in order], [1, 2, 3, 1])
    for s, w in zip(order, want):
        assert abs(target[s] - w) < 1e-6
    assert got == by_id(mixing.mix_report(docs.repartition(2)))  # reruns agree
    mixed = mixing.mix(docs, shards=4).collect()
    assert sum(len(brute.words(r["text"])) for r in mixed) == sum(taken.values())
    assert {r["shard"] for r in mixed} <= set(range(4))
    assert len({(r["doc_id"], r["copy"]) for r in mixed}) == len(mixed)


def test_mix_comes_near_the_targets(spark):
    data = [(i, prose(R.randint(5, 60)), "en", f"s{i % 7}" if i % 3 else "hot", 0) for i in range(900)]
    got = mixing.mix_report(spark.createDataFrame(data, SCHEMA))
    per = got.join(spark.createDataFrame(data, SCHEMA).select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"))
    for r in per.collect():
        assert abs(r["t"] - r["w"]) <= 0.01 * r["w"] + 3


def test_mix_odd(odd, none):
    out = mixing.mix(odd)
    assert {"shard", "copy", "order"} <= {c.lower() for c in odd.columns} and len(set(out.columns)) == len(odd.columns) + 3
    out.collect()
    assert mixing.restate(odd).columns == odd.columns
    assert mixing.mix(none).count() == 0 and mixing.mix_report(none).count() == 0


# ---- 2 decontamination

@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, LEAK), (2, "tiny item"), (10, prose(30)), (3, None), (4, "?!"), (None, PASSAGE), (5, LEAK), (5, LEAK)]
    return spark.createDataFrame(items, "item_id long, text string"), items


def test_leaks(docs, rows, benchmark):
    df, items = benchmark
    want = brute.leaks([(r[0], r[1]) for r in rows], items)
    got = by_id(decontaminate.leak_report(docs, df))
    many = by_id(decontaminate.find_leaks(docs, df, part=500))
    one = by_id(decontaminate.find_leaks(docs, df))
    for d, (n, hit, who) in want.items():
        r = got[d]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, len(hit), len(who), bool(hit))
        assert r["items_sha256"] == brute.sha(",".join(who))
        assert sorted(one[d]["words"]) == sorted(hit) and one[d] == many[d]
    assert any(h for _, h, _ in want.values())
    spans = one[13]["spans"]
    text = rows[13][1].encode()
    assert len(spans) == 1 and decontaminate.normal_words(text[spans[0]["start"] : spans[0]["end"]].decode()) == [w.encode() for w in LEAK.split()]


def test_leaks_odd(odd, none, benchmark, spark):
    df, _ = benchmark
    clean = decontaminate.keep_clean(odd, df)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert decontaminate.leak_report(none, df).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leak_report(odd, empty).where("contaminated").count() == 0


# ---- 3 and 10 substring dedup

def test_phrases(docs, rows):
    want = brute.phrase_kept([(r[0], r[1]) for r in rows])
    got = by_id(phrase_dedup.repeat_report(docs))
    for d, (n, kept) in want.items():
        assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept_sha256"]) == (n, n - len(kept), brute.sha(" ".join(kept))), d


def test_bytes(docs, rows):
    for keep in ("none", "first"):
        want = brute.bytes_kept([(r[0], r[1]) for r in rows], keep=keep)
        got = by_id(suffix_dedup.remove_copies(docs, keep=keep))
        for d, (n, kept, _) in want.items():
            assert (bytes(got[d]["kept"]), got[d]["n_removed"]) == (kept, n - len(kept)), (keep, d)
    want = brute.bytes_kept([(r[0], r[1]) for r in rows])
    for d, r in by_id(suffix_dedup.copy_report(docs)).items():
        assert (r["n_bytes"], r["n_spans"], r["kept_sha256"]) == (want[d][0], want[d][2], brute.sha(want[d][1])), d


def test_crowded_anchors(spark, monkeypatch):
    """A passage in very many contexts is spread by window and gives the same result."""
    from fringeframe.llm import repeats

    monkeypatch.setattr(repeats, "GROUP", 3)
    data = [(i, prose(R.randint(0, 30)) + " " + " ".join(PASSAGE.split()[R.randint(0, 20) : 70]) + " " + prose(12), None, None, 0) for i in range(40)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = by_id(phrase_dedup.repeat_report(df))
    for d, (n, kept) in brute.phrase_kept([(r[0], r[1]) for r in data]).items():
        assert (got[d]["n_removed"], got[d]["kept_sha256"]) == (n - len(kept), brute.sha(" ".join(kept)))
    got = by_id(suffix_dedup.copy_report(df))
    for d, (n, kept, spans) in brute.bytes_kept([(r[0], r[1]) for r in data]).items():
        assert (got[d]["n_removed"], got[d]["n_spans"], got[d]["kept_sha256"]) == (n - len(kept), spans, brute.sha(kept))


def test_dedup_odd(odd, none):
    assert phrase_dedup.repeat_report(odd).count() == 6 and suffix_dedup.copy_report(odd).count() == 6
    # repeated rows are one document when the first stays: the null id, last in order, loses its copy
    left = {r["doc_id"]: r["n_removed"] for r in phrase_dedup.repeat_report(odd).where("n_words = 80").collect()}
    assert left == {7: 0, None: 80}
    assert {r["n_removed"] for r in suffix_dedup.copy_report(odd).where("doc_id = 7").collect()} == {suffix_dedup.copy_report(odd).where("doc_id = 7").first()["n_bytes"]}
    assert phrase_dedup.repeat_report(none).count() == 0 and suffix_dedup.copy_report(none).count() == 0


def test_previous_factors():
    text = b"abracadabra-abracadabra"
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = lambda a, b: next((k for k in range(len(text)) if a + k >= len(text) or b + k >= len(text) or text[a + k] != text[b + k]), 0)
    common = np.array([0] + [lcp(a, b) for a, b in zip(order, order[1:])])
    got = np.zeros(len(text), int)
    got[order] = suffix_dedup.previous_factors(np.array(order), common)
    for i in range(len(text)):
        assert got[i] == max([0] + [lcp(j, i) for j in range(i)])


# ---- 4 tokens

def test_tokens(docs, rows):
    got = by_id(token_store.token_report(docs, TOKENIZER, 50_257))
    t, start = Tokenizer.from_file(TOKENIZER), 0
    for d, text, *_ in sorted(rows):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes())), d
        start += len(ids)


def test_grammar_round_trip():
    g = np.random.default_rng(1)
    for vocab, n in ((3, 5000), (2000, 5000), (70_000, 3000), (2, 1), (5, 0)):
        ids = g.integers(0, vocab, n).astype(np.uint32)
        cuts = np.sort(g.integers(0, n + 1, 6))
        sizes = np.diff(np.concatenate([[0], cuts, [n]]))
        b = token_store.Block(token_store.pack([None, *range(len(sizes) - 1)], ids, sizes, max(vocab, 50_257)))
        assert (b.all() == ids).all() and b.doc_ids[0] is None
        ends = np.cumsum(sizes)
        for k, (e, s) in enumerate(zip(ends, sizes)):
            doc = ids[e - s : e]
            assert (b.document(k) == doc).all()
            lo, hi = sorted(g.integers(0, s + 1, 2).tolist())
            assert (b.document(k, lo, hi) == doc[lo:hi]).all()
    run = np.zeros(10_000, np.uint32)  # one symbol only
    assert len(token_store.compress(run, np.array([10_000]), 50_257)[0]) < 200


def test_tokens_odd(odd, none):
    got = token_store.token_report(odd, TOKENIZER, 50_257).orderBy("start").collect()
    assert len(got) == 6 and [r["doc_id"] for r in got] == [None, None, None, 7, 7, 8] and got[0]["n_tokens"] == 1
    assert token_store.token_report(none, TOKENIZER, 50_257).count() == 0


# ---- 5 sharding

def test_shards(docs, rows, spark):
    copies = spark.createDataFrame([(1000 + i, "the hot text", None, None, 0) for i in range(60)], SCHEMA)
    got = balanced_shards.shard_report(docs.unionByName(copies)).collect()
    n = len(rows) + 60
    per = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(8)}
    assert len(got) == n and max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert all(v == list(range(len(v))) for v in per.values())
    text = {r[0]: r[1] for r in rows}
    for r in got:
        t = text.get(r["doc_id"], "the hot text")
        assert r["size"] == len((t or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((t or "").encode()) and r["law"] == "rows"
    hot = [r["shard"] for r in got if r["doc_id"] >= 1000]
    assert len(set(hot)) <= -(-60 // (n // 8)) + 1  # few shards, not all
    assert len({r["shard"] for r in got if r["doc_id"] in (7, 8)}) == 1


def test_shards_odd(odd, none):
    got = balanced_shards.shard_report(odd).collect()
    assert len(got) == 6 and sorted((r["shard"], r["slot"]) for r in got) == sorted({(r["shard"], r["slot"]) for r in got})
    assert balanced_shards.shard_report(none).count() == 0


# ---- 6 language

def test_language(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op6_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    held = got.where("held_out AND lang IS NOT NULL")
    assert held.where("lang = lang_pred").count() / held.count() > 0.97
    assert got.where("score < 0 OR score > 1").count() == 0
    report = langid.language_report(odd).collect()
    assert len(report) == 6 and sum(r["lang_pred"] == "und" for r in report) == 2
    assert langid.language_report(none).count() == 0
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns and kept.count() == 4


def test_bundles_do_not_depend_on_neighbours():
    texts = ["Hello world", "", None, "ß und é", "12 34", "x" * 3000, "日本"]
    together = langid.bundles([t or "" for t in texts])
    for t, v in zip(texts, together):
        assert (langid.bundles([t or ""])[0] == v).all()
    assert not together[1].any() and not together[4].any() and together[6].any()


# ---- 7 chat

def test_chat(spark):
    turns = [(1, 0, "system", "be <|im_end|> \\ kind"), (1, 1, "user", "a\nb"), (1, 2, "assistant", "yes\\n <|x"), (1, 3, "assistant", None), (1, 4, "user", ""),
             (2, 0, "user", "no reply"), (3, None, None, "odd"), (3, 5, "assi\nstant", "x"), (None, 1, "assistant", "lost"), (4, 1, "user", "same"), (4, 1, "user", "same"),
             (5, 0, "assistant", "z" * 200_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1)).withColumn("begin", F.lit(1))
    got = {r["conv_id"]: r for r in chat.chat_report(chat.with_trap(df)).collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    convs = {}
    for c, t, r, x in sorted(turns + [(-1, 0, "user", said), (-1, 1, "assistant", said)], key=lambda v: (v[0] is not None, v[0] or 0, -1 if v[1] is None else v[1], v[2] or "", v[3] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    # two assistant turns without order between them do not occur above
    assert set(got) == set(convs)
    for c, v in convs.items():
        loss = "".join(x for r, x in v if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(v), brute.sha("".join(f"{r}\n{x}\n" for r, x in v)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), brute.sha(loss))
    formatted = chat.format_turns(chat.with_trap(df))
    for r in chat.render(formatted).where("conv_id = 1").collect():
        reply = chat.unescape(r["text"][r["loss_begin"] : r["loss_end"]])
        assert reply in ("yes\\n <|x", "") and r["text"].count(chat.START) == r["example"] + 1
    assert chat.examples(formatted).where("conv_id = 1").count() == 2
    assert chat.chat_report(df.limit(0)).count() == 0


# ---- 8 Jaccard join

def near(base, edits, r):
    w = base.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = r.choice(VOCAB) + "q"
    return " ".join(w)


def test_jaccard(docs, rows, monkeypatch):
    want = brute.components([(r[0], r[1]) for r in rows])
    for d, r in by_id(jaccard.component_report(docs)).items():
        assert (r["n_shingles"], r["component_id"]) == want[d], d


def test_jaccard_dense_group(spark, monkeypatch):
    """Many near copies at every distance around the threshold, and short sets."""
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    r = random.Random(3)
    base, other = prose(120, r), prose(60, r)
    data = [(i, near(base, r.randint(0, 9), r), None, None, 0) for i in range(90)] + [(200 + i, near(other, r.randint(0, 3), r), None, None, 0) for i in range(40)]
    data += [(300 + i, prose(r.randint(1, 12), random.Random(i % 5)), None, None, 0) for i in range(30)] + [(400 + i, other + " " + prose(i, r), None, None, 0) for i in range(20)]
    want = brute.components([(d[0], d[1]) for d in data])
    got = by_id(jaccard.component_report(spark.createDataFrame(data, SCHEMA).repartition(4)))
    assert {d: (v["n_shingles"], v["component_id"]) for d, v in got.items()} == want


def test_jaccard_odd(odd, none):
    got = jaccard.component_report(odd).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in got) == [(-1, -1), (-1, -1), (-1, 7), (7, 7), (7, 7), (8, 8)]
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns and sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, -1, 7, 8]
    assert jaccard.component_report(none).count() == 0 and jaccard.keep_one(none).count() == 0


def test_jaccard_members_stay_folded(spark, monkeypatch):
    """One-edit copies of a text: no product of a group's members with its partners is compared, and parts change nothing."""
    monkeypatch.setattr(jaccard, "LISTED", 0)  # as where more lists are long than are put last
    monkeypatch.setattr(jaccard, "PART", 16)
    r = random.Random(9)
    base = prose(150, r).split()
    data = []
    for i in range(240):
        w = list(base)
        w[r.randrange(150)] = f"edit{i}"
        data.append((i, " ".join(w), None, None, 0))
    data += [(300 + i, " ".join(base[:110]) + " " + prose(40, r), None, None, 0) for i in range(12)]  # far from the copies, sharing much of their prefixes
    want = brute.components([(d[0], d[1]) for d in data])
    compared, verified = [], jaccard.verified

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(jaccard, "verified", counted)
    got = by_id(jaccard.component_report(spark.createDataFrame(data, SCHEMA).repartition(4)))
    assert {d: (v["n_shingles"], v["component_id"]) for d, v in got.items()} == want
    assert sum(compared) <= 12 * 240 + 4 * len(data), compared  # each far text with all copies, and a few of each row


def test_jaccard_long_list_in_blocks(spark, monkeypatch):
    """A list of many units is dealt out by pairs of blocks; copies of one root do not meet each other again."""
    monkeypatch.setattr(jaccard, "PACK", 50)
    data = [(1, g, 100 + g % 7, b"copy" if g < 900 else bytes([g % 251, g // 251])) for g in range(1000)]
    got = jaccard._block_pairs(spark.createDataFrame(data, "token long, gid long, n long, root binary"), 85).collect()
    runs = {}
    for r in got:
        runs.setdefault((r["ci"], r["bi"], r["cj"], r["bj"]), []).append(r)
    assert max(map(len, runs.values())) <= 4 * 50
    met = set()
    for (ci, bi, cj, bj), rows in runs.items():
        sides = [[(r["gid"], r["root"]) for r in rows if r["side"] == k] for k in (0, 1)]
        for g, x in sides[0]:
            for h, y in sides[1] or sides[0]:
                if x != y:
                    met.add((min(g, h), max(g, h)))
                else:
                    assert x != b"copy"
    assert len(met) == 900 * 100 + 100 * 99 // 2


# ---- 9 TIFF

def test_tiff_codecs():
    g = np.random.default_rng(0)
    for comp in (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS):
        for tile in (None, (16, 32)):
            for order in "<>":
                for predictor in (False, True):
                    pages = [g.integers(0, 4, (37, 50), np.uint8), g.integers(0, 256, (90, 70, 3), np.uint8), np.zeros((200, 130), np.uint8), np.full((1, 1), 7, np.uint8)]
                    back = tiff.read(tiff.write(pages, comp, predictor, tile, order, strip=1000))
                    assert len(back) == 4 and all(p.error is None and (p.samples.reshape(a.shape) == a).all() for a, p in zip(pages, back))
    assert tiff.packbits_decode(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA]), 24) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")


def test_tiff_damage(spark):
    good = tiff.write([np.arange(256, dtype=np.uint8).reshape(16, 16)] * 2)
    files = [(1, good), (2, None), (3, b""), (4, b"not an image"), (5, good[:-20]), (6, good[:9]), (7, good[:40] + b"\xff" * 8 + good[48:])]
    got = tiff.read_pages(spark.createDataFrame(files, "doc_id long, media binary").withColumn("page", F.lit(9)), "doc_id", "media").collect()
    assert sum(r["file_id"] == 1 and r["error"] is None for r in got) == 2 and not any(r["file_id"] in (2, 3) for r in got)
    assert all(r["error"] for r in got if r["file_id"] in (4, 6))


def test_media(docs, rows, odd, none):
    got = by_id(tiff.media_report(docs))
    for d, t, *_ in rows:
        raw = (t or "").encode()
        p = raw + b" " * (-len(raw) % 192)
        p = p or b" " * 192
        r = got[d]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(p), brute.sha(p), zlib.crc32(p[-16:]))
    assert got[7]["feature"] == got[8]["feature"] and got[7]["media_sha256"] == got[8]["media_sha256"]
    assert tiff.media_report(odd).count() == 6 and tiff.media_report(none).count() == 0


def test_spread_join(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWD", 3)
    rows = jaccard.cut_lineage(spark.createDataFrame([(i if i % 3 else 1, i % 7 if i % 2 else 2) for i in range(40)], "a long, b long"))
    left = spark.createDataFrame([(a, a * 10 + j) for a in range(40) for j in range(a % 3)] + [(99, 0)], "a long, u long")
    right = spark.createDataFrame([(b, f"r{b}") for b in range(5)], "b long, v string")
    got = jaccard._spread_join(rows, (left, ["a"]), (right, ["b"])).select("a", "b", "u", "v").collect()
    assert sorted(got) == sorted(rows.join(left, "a").join(right, "b").select("a", "b", "u", "v").collect()) and len(got) > 40
    assert not jaccard._spread_join(rows.where("a < 0"), (left, ["a"]), (right, ["b"])).count()


def test_chat_examples_carry_their_context(spark, monkeypatch):
    """The digests come from written examples: with another context they must not come out, and long conversations are read alike."""
    said = [(c, t, "assistant" if t % 3 == 2 else "user", f"turn {t} <|im_end|>\n" * (1 + t % 4)) for c in (1, 2) for t in range(20)] + [(3, 0, "user", "alone")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    want = sorted(tuple(r) for r in chat.read_back(chat.format_turns(df)).collect())
    examples = [r for r in chat.expand(chat.format_turns(df)).collect() if r["loss_begin"] is not None]
    assert len(examples) == 12 and all(r["begin"] == 0 and r["text"].count(chat.START) == r["seq"] + 1 for r in examples)
    for written, held in ((1 << 20, 1 << 20), (500, 1 << 20), (0, 60)):
        monkeypatch.setattr(chat, "WRITTEN", written)
        monkeypatch.setattr(chat, "HELD", held)
        assert sorted(tuple(r) for r in chat.chat_report(df).collect()) == want
    monkeypatch.undo()
    whole = chat.expand
    monkeypatch.setattr(chat, "expand", lambda d: whole(d).withColumn("text", F.when(F.col("seq") == 5, F.expr("overlay(text placing 'x' from 20 for 1)")).otherwise(F.col("text"))))
    with pytest.raises(Exception, match="example"):
        chat.chat_report(df).collect()


def test_grammar_sorts_only_pairs_that_can_pay(monkeypatch):
    """Pairs that are too rare for a rule are left out before the sort; the rules stay the same."""
    rng = np.random.default_rng(5)
    ids = np.concatenate([rng.integers(0, 50_000, 20_000), np.tile([7, 8, 9, 10], 200)]).astype(np.uint32)
    sorted_, unique = [], np.unique
    monkeypatch.setattr(token_store.np, "unique", lambda x, **more: sorted_.append(len(x)) or unique(x, **more))
    seq, symbols, rules = token_store.compress(ids, np.array([len(ids)]), 50_257)
    assert np.array_equal(token_store.expand(seq, rules, 50_257), ids) and len(seq) < len(ids)
    assert max(sorted_) < 2_000


def test_frequent_tokens_are_counted_without_copies_of_all(spark, monkeypatch):
    from fringeframe.llm import jaccard

    sizes, unique = [], np.unique
    monkeypatch.setattr(jaccard, "FREQUENT", 5)
    monkeypatch.setattr(jaccard, "shingle_sets", lambda body, offsets, k: [np.array([7, 9, 100 + i], np.uint64) for i in range(len(offsets) - 1)])
    monkeypatch.setattr(jaccard.np, "unique", lambda x, **more: sizes.append(len(x)) or unique(x, **more))

    class Rows:  # the task's function, run here
        def mapInArrow(self, count, schema):
            batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(["a"] * 1000)], ["doc_id", "text"])
            self.out = pa.Table.from_batches(list(count(iter([batch])))).to_pylist()
            return spark.createDataFrame([(r["token"], r["n"]) for r in self.out], "token long, n long")

    for counted in (1 << 22, 1000):
        monkeypatch.setattr(jaccard, "COUNTED", counted)
        rows = Rows()
        assert jaccard.frequent_tokens(rows, 4).tolist() == [7, 9]
        assert {t: sum(r["n"] for r in rows.out if r["token"] == t) for t in (7, 9)} == {7: 1000, 9: 1000}
    assert max(sizes) < 2001  # before: all 3,000 tokens at once


def test_tables_of_a_comparison_go_when_it_is_done(spark):
    from fringeframe import session
    from fringeframe.llm import components

    before = len(session._written)
    links = session.cut_lineage(spark.createDataFrame([(1, 2), (2, 3), (3, 4), (8, 9)], "x long, y long"))
    found = components.components(links, "x", "y")
    assert {(r.node, r.root) for r in found.collect()} == {(2, 1), (3, 1), (4, 1), (9, 8)}
    assert len(session._written) - before == 2 and links.count() == 4  # the links and the last round; before, every round


def test_encoder_keeps_a_word_once_and_little_for_each_piece():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_store.Encoder(path)
    words = ["".join(chr(97 + (i * 7919 // 26**k + k) % 26) for k in range(6)) for i in range(500)]
    texts = [" ".join(w + sign for w in words for sign in ("", ",", ".", "!?")), " x".join(words)]
    ids, sizes = encoder.encode(texts)
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(whole, []) and sizes.tolist() == [len(x) for x in whole]
    assert set(encoder.parts) == {",", ".", "!?"}  # signs; words are pieces already
    # a worker's cache stays below 200 MB: before, 1.5 million pieces of some 300 bytes
    assert token_store.CACHED * 210 < 200e6


def test_set_tasks_free_the_encoder_of_earlier_jobs():
    """A worker process that is used again held the pieces of the token store while it compared sets."""
    encoder = token_store._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.encode(["some words"])
    assert token_store._encoder.cache_info().currsize == 1
    assert list(jaccard._sets([], 0)) == []
    assert token_store._encoder.cache_info().currsize == 0


def test_set_sketches_take_a_byte_a_word():
    """A first comparison sent 2 bytes of each hash; gaps of the first bits take one, and count no fewer common words."""
    rng = np.random.default_rng(4)
    for n in (0, 1, 6, 300, 5000, 100_000):
        s = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        sent = jaccard._packed(s)
        values, bits = jaccard._unpacked(sent)
        assert np.array_equal(values.astype(np.uint64), s >> np.uint64(64 - bits)) and len(sent) <= 1.05 * n + 1
    base = np.unique(rng.integers(0, 1 << 64, 1030, np.uint64))
    sets = {b"%d" % cut: base[cut : len(base) - cut] for cut in (0, 10, 40, 75, 76, 120, 300)}
    first, whole = {u: jaccard._unpacked(jaccard._packed(s)) for u, s in sets.items()}, {u: (s, 64) for u, s in sets.items()}
    hubs, leaves = [u for u in sets for _ in sets], list(sets) * len(sets)
    likely, similar = (set(jaccard._similar(hubs, leaves, held, 85)) for held in (first, whole))
    want = {i for i, (u, v) in enumerate(zip(hubs, leaves)) if 100 * min(len(sets[u]), len(sets[v])) >= 85 * max(len(sets[u]), len(sets[v]))}
    assert similar == want and likely >= similar and len(likely) < len(hubs)


def test_lists_keep_all_that_can_meet():
    """Rows that no pair with the list's token as its first shared one can have go; every such pair stays."""
    rng = np.random.default_rng(6)
    left = 0
    for percent in (80, 85):
        for _ in range(100):
            m = int(rng.integers(2, 40))
            _, run = np.unique(rng.integers(0, 4, m), return_inverse=True)
            n = rng.integers(5, 80, m)
            pos = (rng.random(m) * n * (100 - percent) / 100).astype(np.int64)
            order = np.lexsort((pos, n, run))
            run, n, pos = run[order], n[order], pos[order]
            keep = jaccard._meetable(run, n, pos, percent)
            left += int((~keep).sum())
            for i in range(m):
                for j in range(i + 1, m):
                    assert run[i] != run[j] or not jaccard._may(n[i], n[j], pos[i], pos[j], percent) or keep[i] and keep[j]
    assert left > 200


def test_prefix_counts_of_many_rows():
    rng = np.random.default_rng(8)
    nx, ny = rng.integers(1, 60, 300), rng.integers(1, 60, 300)
    x, y = (rng.integers(0, 120, n.sum()).astype(np.int16) for n in (nx, ny))
    rows = zip(np.split(x, np.cumsum(nx)[:-1]), np.split(y, np.cumsum(ny)[:-1]))
    assert jaccard._in_both(x, nx, y, ny).tolist() == [max(np.isin(a, b).sum(), np.isin(b, a).sum()) for a, b in rows]


def test_jaccard_places_and_lists(spark, monkeypatch):
    """Crowded places, heavy hubs, short and long lists of several components give the same components."""
    r = random.Random(12)
    base = [prose(80, r) for _ in range(3)]
    data = [(i, near(base[i % 3], r.randint(0, 12), r), None, None, 0) for i in range(120)] + [(200 + i, prose(30, r), None, None, 0) for i in range(10)]
    want = brute.components([(d[0], d[1]) for d in data])
    for few, listed, bucket, heavy in ((4096, 64, 1 << 22, 100_000), (0, 4, 4000, 6)):
        for name, value in (("FEW", few), ("LIST", listed), ("BUCKET", bucket), ("HEAVY", heavy), ("SHORT", 3)):
            monkeypatch.setattr(jaccard, name, value)
        got = by_id(jaccard.component_report(spark.createDataFrame(data, SCHEMA).repartition(3)))
        assert {d: (v["n_shingles"], v["component_id"]) for d, v in got.items()} == want


def test_kept_rows_are_exchanged_once(spark):
    """The texts went through two exchanges, one for the join with the kept ids and one for the grouping."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(1, "a b c d e f g", None, None, 0), (1, "a b c d e f g", None, None, 0), (None, "x y", None, None, 0), (3, " ", None, None, 0)], SCHEMA)
        kept = jaccard.keep_one(df, 80, 5)
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        full = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and full.count("Exchange hashpartitioning") == 2, full  # the texts and the ids to keep
        assert sorted(((x["doc_id"] or -1), x["text"]) for x in kept.collect()) == [(-1, "x y"), (1, "a b c d e f g"), (3, " ")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_set_tasks_hash_little_text_at_once(monkeypatch):
    """Arrays of 8 bytes a byte of text: before, for 1 MB at once, and tables of powers for 2 MB."""
    seen, hashed = [], jaccard.hash_words
    monkeypatch.setattr(jaccard, "hash_words", lambda body, *more, **named: seen.append(len(body)) or hashed(body, *more, **named))
    batch = pa.RecordBatch.from_arrays([pa.array(["one two three four five six " * 40] * 1500)], ["text"])
    assert sum(len(found) for _, found in jaccard._sets([batch], 0)) == 1500
    assert max(seen) <= 1 << 18 and sum(seen) == 1500 * 28 * 40
