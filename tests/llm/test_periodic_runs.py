"""Run detection against a search of all periods."""

import hashlib
import random
import zlib

import pytest

from patronage.llm import periodic_runs as R

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def slow_runs(w, least):
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.append((i - q, j - i + q, q))
            i = max(j, i + 1)
    # q must be the smallest period of the stretch.
    return sorted((s, n, q) for s, n, q in found
                  if not any(all(w[k] == w[k - p] for k in range(s + p, s + n)) for p in range(1, q)))


def words_of(seed):
    rng = random.Random(seed)
    k, n = rng.choice([0, 1, 2, 4]), rng.randint(0, 70)
    w = [rng.randint(0, k) for _ in range(n)]
    if n > 5 and rng.random() < 0.7:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        w = w[:a] + [w[a + i % p] for i in range(n - a)] + [rng.randint(0, k) for _ in range(rng.randint(0, 9))]
    return w


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    for seed in range(600):
        w = words_of(seed)
        want = slow_runs(w, least)
        assert R.squares_to_runs(w, least) == want
        assert R.word_runs([b"%d" % x for x in w], least) == want


def test_windows_lose_no_run_of_a_long_text():
    rng = random.Random(5)
    for _ in range(30):
        w = [rng.randint(0, 400) for _ in range(1500)]
        for _ in range(4):
            a, p = rng.randrange(1300), rng.randint(1, 60)
            n = rng.randint(2 * p, 3 * p + 12)
            w[a:a + n] = [w[a + i % p] for i in range(n)]
        w[100:400] = w[900:1200]  # a far repeat is no run
        assert R.word_runs([b"%d" % x for x in w]) == slow_runs(w, 12)


def test_access_gives_the_path_by_colour():
    rng = random.Random(2)
    parents = [-1] + [rng.randrange(i) for i in range(1, 80)]
    tree, colour = R.Segments(parents), [-1] * 80
    for i in range(400):
        x = rng.randrange(80)
        want, at = [], x
        while at >= 0:
            if not want or want[-1][1] != colour[at] or colour[at] < 0:
                want.append((at, colour[at]))
            colour[at], at = i, parents[at]
        # Nodes that no access has coloured stand alone.
        assert [m for m in tree.access(x, i)] == want


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 12), (5, "a b c"), (6, "x y " * 40 + "z"), (6, "x y " * 40 + "z"),
            (None, "p " * 11), (7, "q\x0b" * 5000), (8, " ".join(f"w{i % 700}" for i in range(3000)))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS) \
        .selectExpr("*", "1 runs", "'x' words", "2 n_words", "'c' collapsed")
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                  for r in R.periodic_runs(docs).collect()), key=str)
    want = sorted([(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 12, [(0, 12, 1)], "a"), (5, 3, [], "a b c"),
                   *[(6, 81, [(0, 80, 2)], "x y z")] * 2, (None, 11, [], " ".join("p" * 11)),
                   (7, 5000, [(0, 5000, 1)], "q"),
                   (8, 3000, [(0, 3000, 700)], " ".join(f"w{i}" for i in range(700)))], key=str)
    assert got == want
    assert R.run_digests(docs.limit(0)).collect() == []
    one = {r["doc_id"]: r for r in R.run_digests(docs).collect()}
    assert tuple(one[8])[1:6] == (1, 0, 3000, 700, 4285)
    assert one[8]["runs_sha256"] == hashlib.sha256(b"0,3000,700\n").hexdigest()
    assert one[1]["start"] is None and one[1]["runs_sha256"] == hashlib.sha256(b"").hexdigest() == one[1]["collapsed_sha256"]


def test_longest_run_ties(spark):
    text = " ".join(["a", "b"] * 6 + ["x"] + ["c"] * 12)
    r = R.run_digests(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r["n_runs"], r["start"], r["length"], r["period"]) == (2, 0, 12, 2)


def test_planting(spark):
    ids = [i for i in range(300) if zlib.crc32(b"%d" % i) % 10 == 0]
    text = " ".join(f"w{i}" for i in range(97))
    docs = spark.createDataFrame([(i, text) for i in range(300)] + [(None, text), (ids[0] + 1000000, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in R.with_planted_runs(docs).collect()}
    w = text.split()
    for i, t in got.items():
        h = zlib.crc32(str(i).encode())
        if i is None or h % 10 or t is None:
            assert t == (text if i is None or i < 300 else None)
        else:
            a = h // 10 % 97
            p = 1 + (97 - a) // (3 + h // 10 % 8)
            assert t.split(" ") == [w[j] if j < a else w[a + (j - a) % p] for j in range(97)]
