"""SentencePiece, SimHash, license scan and toxicity against brute force and fixtures."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from patronage.llm import components, license_scan, piece_bpe, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, " ", "  a  b ", "\n", "a\nb\n\n", "▁x ▁▁", "\x00é🙂ﬁ", "<s> </s> <0x41>", "x" * 3000, "日本 " * 900]


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.model_path())


@pytest.fixture(scope="module")
def texts(spark):
    return [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]


# ------------------------------------------------------------- SentencePiece
def test_pieces_equal_the_library(library):
    bpe = piece_bpe.PieceBpe(piece_bpe.model_path())
    rng = random.Random(5)
    some = sorted(bpe.ids)[::7]
    cases = [t for t in ODD if t is not None] + [" " * n + "ab" + " " * k for n in range(36) for k in (0, 2, 17)]
    cases += ["".join(rng.choice("aabcdethnos  \n\té▁ñ🙂,1<") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    cases += ["".join(rng.choice(some) for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    for t in cases:
        ids = library.encode(t)
        assert bpe.encode(t) == ids, t
        assert bpe.decode(ids) == library.decode(ids), t


def test_decoding_stray_ids_equals_the_library(library):
    bpe = piece_bpe.PieceBpe(piece_bpe.model_path())
    for ids in ([233, 154], [258, 68, 300], [0], [1, 300], [300, 2, 233, 5000], [243, 162, 156], []):
        assert bpe.decode(ids) == library.decode(ids)


def test_encode_query_over_whole_texts(spark, library, texts):
    every = [*texts, *ODD, texts[0]]
    docs = frame(spark, every).withColumn("ids_sha256", F.lit("clash")).withColumn("n_tokens", F.lit(-1))
    got = {r["doc_id"]: r for r in piece_bpe.encode_digests(docs).collect()}
    assert len(got) == len(every)
    for i, t in enumerate(every):
        ids = library.encode(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    r = piece_bpe.encode_texts(frame(spark, ["a b"])).first()
    assert list(r["ids"]) == library.encode("a b") and r["decoded"] == "a b"
    assert piece_bpe.encode_digests(frame(spark, [])).count() == 0


def test_small_caches_change_nothing(library, texts, monkeypatch):
    monkeypatch.setattr(piece_bpe, "UNITS", 50)
    monkeypatch.setattr(piece_bpe, "PAIRS", 20)
    bpe = piece_bpe.PieceBpe(piece_bpe.model_path())
    for t in texts[:20]:
        assert bpe.digests(t)[1] == hashlib.sha256(",".join(map(str, library.encode(t))).encode()).hexdigest()


# ------------------------------------------------------------------- SimHash
def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows, radius=3):
    ids = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    fps = np.array([f for _, f in ids], np.uint64)
    for i in range(len(ids)):
        for j in np.nonzero(np.bitwise_count(fps[i] ^ fps[i + 1:]) <= radius)[0] + i + 1:
            a, b = sorted((find(i), find(int(j))))
            up[b] = a
    return [(ids[i][0], ids[i][1], ids[find(i)][0]) for i in range(len(ids))]


@pytest.mark.parametrize("tile", [4096, 64, 4])
def test_classes_equal_brute_force(spark, texts, tile):
    every = [*texts[:350], *ODD, texts[3], texts[3].upper(), "One two", "one TWO", "Ä b c"]
    want = slow_components([(i, slow_fingerprint(t)) for i, t in enumerate(every)])
    docs = frame(spark, every).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(0))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs, tile=tile).collect()}
    assert got == {d: (f"{f:016x}", c) for d, f, c in want}


def test_dense_groups_give_a_forest():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) for b in range(20)]))
    links = simhash.forest(near, near, 3, True)
    assert len(links) == len(near) - 40  # one tree for each of the 40 groups
    assert simhash.forest(near[:0], near, 3, False) == []


def test_segments_lose_no_pair(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = [base]
    for _ in range(3):
        flips.append(flips[-1] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    fps = sorted({int(x) for f in flips for x in f})
    want = {frozenset(x) for x in _groups([(a, b) for i, a in enumerate(fps) for b in fps[i + 1:]
                                           if (a ^ b).bit_count() <= 3])}
    rows = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    for tile in (1024, 16, 1):
        got = [(int(np.int64(r["a"]).view(np.uint64)), int(np.int64(r["b"]).view(np.uint64)))
               for r in simhash.links(rows, 3, tile).collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in got)
        assert {frozenset(x) for x in _groups(got)} == want


def _groups(pairs):
    at = {}
    for a, b in pairs:
        x = at.setdefault(a, {a}) | at.setdefault(b, {b})
        for y in x:
            at[y] = x
    return at.values()


def test_nulls_repeats_and_empty_tables_of_near_duplicates(spark):
    docs = spark.createDataFrame(
        [(5, "a b c d e", "en", "s", 1), (5, "a b c d e", "en", "s", 1), (None, "a b c d e", "en", "s", 1),
         (7, None, None, None, None), (8, "", "en", "s", 0), (None, "only null ids here now", "en", "s", 1)], DOCS)
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (7, 7), (8, 7), (None, None)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [5, 7, None]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_one_row_of_each_component_stays_whatever_its_id(spark):
    a, b, c, d, e = ("alpha beta gamma delta", "one two three four", "red green blue black", "north east south west", "x y z")
    rows = [(5, a, "en", "s", 1), (None, a, "en", "s", 1), (None, b, "en", "s", 1), (None, b, "en", "t", 1),
            (None, c, "en", "s", 1), (6, d, "en", "s", 1), (6, a, "en", "s", 1), (6, d, None, "s", 1), (6, d, "s", None, 1),
            (7, e, "en", "s", 1), (7, e, "en", "s", 1), (9, e, "en", "s", 1)]
    first = None
    for turn in (rows, rows[::-1]):
        kept = [tuple(r) for r in simhash.keep_one(spark.createDataFrame(turn, DOCS).repartition(3)).collect()]
        assert sorted(((r[0], r[1]) for r in kept), key=str) == sorted([(5, a), (None, b), (None, c), (6, d), (7, e)], key=str)
        assert all(r in rows for r in kept)
        first = first or sorted(kept, key=str)
        assert sorted(kept, key=str) == first


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(3, 3), (None, 4)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(60)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -------------------------------------------------------------- license scan
def test_planted_notices_are_found_with_spans(spark, texts):
    name, notice = "GPL-3.0", license_scan.TEMPLATES["GPL-3.0"]
    words = notice.split()
    changed = " ".join([*words[:4], "really", *words[4:-2], words[-1]])
    plain = [t for t in texts if "icense" not in t][:30]
    cases = [plain[0] + " " + notice + " " + plain[1], plain[2] + "\n" + changed + "\n" + notice.upper(), *plain, *ODD]
    rows = license_scan.scan_licenses(frame(spark, cases).withColumn("license", F.lit("clash"))).collect()
    found = sorted((r["doc_id"], r["license"], r["first_word"], r["last_word"], r["n_matched"]) for r in rows)
    n0, n2 = (len(license_scan.words(plain[k])) for k in (0, 2))
    size = len(license_scan.words(notice))
    assert found == [(0, name, n0, n0 + size - 1, size), (1, name, n2, n2 + size - 1, size - 1),
                     (1, name, n2 + size, n2 + 2 * size - 1, size)]
    assert license_scan.scan_licenses(frame(spark, [])).count() == 0


def test_every_exact_line_of_the_table_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {n: t for n, t in license_scan.TEMPLATES.items() if "\n" not in t}
    want = {(r["doc_id"], n) for r in docs.select("doc_id", "text").collect() for n, t in lines.items() if t in r["text"]}
    got = {(r["doc_id"], r["license"]) for r in license_scan.scan_licenses(docs).where("cover_permille = 1000").collect()}
    assert want and want <= got


def test_each_place_counts_once_with_its_shortest_span():
    index = license_scan.Index(license_scan.TEMPLATES)
    for name in ("MIT", "CC-BY-NC-4.0", "Apache-2.0"):
        said = license_scan.TEMPLATES[name]
        size = len(license_scan.words(said))
        for n in (2, 3, 5):
            assert index.scan(" ".join([said] * n)) == [(name, k * size, (k + 1) * size - 1, size, 1000) for k in range(n)]
    assert index.scan("a licensed b Licensed under the Apache License, Version 2.0 c 0 d") == [("Apache-2.0", 3, 10, 8, 1000)]
    assert index.scan("released x Released under the MIT License y license") == [("MIT", 2, 6, 5, 1000)]


def test_near_relatives_are_told_apart():
    index = license_scan.Index(license_scan.TEMPLATES)
    for name, said in license_scan.TEMPLATES.items():
        words = said.split()
        for text in (said, " ".join([*words[:4], "indeed", *words[4:]]) if len(words) > 9 else said.upper()):
            assert [x[0] for x in index.scan(f"so it is {text} and so on")] == [name]
    both = license_scan.TEMPLATES["GPL-2.0"] + " " + license_scan.TEMPLATES["MIT"]
    assert sorted(x[0] for x in index.scan(both)) == ["GPL-2.0", "MIT"]


# ------------------------------------------------------------------ toxicity
def test_machine_learns_what_only_a_pair_means():
    rng = random.Random(2)
    rows = []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(([1] * a + [2] * b + [10 + rng.randrange(50)], int(a and b)))
    m = toxicity.fit(rows, 0.25)
    assert len(m.buckets) >= 2
    at = m.place

    def raw(*terms):
        k = [at[t] for t in terms if t in at]
        v = m.factor[k]
        return m.bias + m.weight[k].sum() + 0.5 * ((v.sum(axis=0) ** 2) - (v ** 2).sum(axis=0)).sum()
    assert raw(1, 2) > 0 > max(raw(1), raw(2))
    joint = m.factor[at[1]] @ m.factor[at[2]]
    assert joint > 0.1


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.toxicity(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").where("held_out").select("predicted", "toxic", "score", "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.95
    assert hit / sum(r["toxic"] for r in rows) > 0.75
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.learn(docs, labels), toxicity.learn(docs, turned)
    assert a.dump() == b.dump()


def test_toxicity_without_labels_or_texts(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (None, "x y", "en", "s", 0), (1, "", "en", "s", 0)], DOCS)
    rows = toxicity.toxicity(docs.withColumn("score", F.lit(9)), labels).collect()
    assert len(rows) == 3 and all(r["predicted"] == 0 for r in rows)
    assert toxicity.drop_toxic(docs, labels).count() == 3
    some = spark.createDataFrame([(1, 0, 1), (2, 1, None), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs.limit(0), some).count() == 0
