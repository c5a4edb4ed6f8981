"""Quality rules, chat windows, mixing, fixity, pages, neighbours and the pipeline."""

import hashlib
import html
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import ann_mih, chat_windows, html_template, mixing, quality_rules, warc_fixity

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"


# ------------------------------------------------------------- quality rules
def slow_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    tri = Counter(zip(words, words[1:], words[2:], strict=False))
    cover = {i + k for i in range(len(words) - 2) if tri[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


def test_counts_equal_brute_force(spark):
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a b c d a b c d a b", "x x x x x", "\x0bq\x0c é 日本 🙂",
             "l\nl\n l\n\n\n", "#*$ %&| <>", "a b c " * 4000, "p q p q p q r"]
    texts += [r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").limit(150).collect()]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: tuple(r[c] for c in quality_rules.COUNTS)
           for r in quality_rules.counts(docs.withColumn("n_words", F.lit("clash"))).collect()}
    assert got == {i: slow_counts(t) for i, t in enumerate(texts)}


def test_sketch_quantiles_are_close_and_mergeable(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(0, 1, 4000)
    rows = spark.createDataFrame([("en", "a" if i % 3 else "b", 1000, float(v)) for i, v in enumerate(x)],
                                 "lang string, source string, n_words long, v double")
    counted = rows.selectExpr("lang", "source", "n_words", "cast(round(v * 1000) as long) word_chars", "0L n_symbols",
                              "0L n_dup_lines", "1L n_lines", "0L n_repeat_words", "false base_failed")
    f = quality_rules.fences(quality_rules.sketches(counted), ["lang"]).first()
    q1, q3 = np.quantile(x, [0.25, 0.75])
    assert f["high_word_length"] == pytest.approx(q3 + max(1, 3 * (q3 - q1)), rel=0.06)
    assert f["n"] == 4000 and f["high_symbols"] == pytest.approx(0.1)
    parts = quality_rules.sketches(counted.where("source = 'a'")).union(quality_rules.sketches(counted.where("source = 'b'")))
    assert quality_rules.fences(parts, ["lang"]).first() == f


def test_outliers_go_and_ordinary_texts_stay(spark):
    words = [f"w{i}" for i in range(400)]
    plain = [(i, " ".join(words[i % 7:i % 7 + 120]), "en", "s", 0) for i in range(300)]
    junk = [(1000, " ".join(w + "***" for w in words[:120]), "en", "s", 0),
            (1001, "\n".join(["same line of some words here", *words[:60]] + ["short"] * 200), "en", "s", 0),
            (1002, " ".join(w * 6 for w in words[:120]), "en", "s", 0), (1003, "too short", "en", "s", 0)]
    docs = spark.createDataFrame(plain + junk, DOCS)
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.quality(docs).collect()}
    assert all(got[i] == (False, True) for i, *_ in plain)
    assert not any(got[i][1] for i, *_ in junk)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 300


def test_quality_of_nulls_and_empty_tables(spark):
    good = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(None, None, None, None, None), (1, good, None, None, 0), (1, good, None, None, 0),
                                  (2, good, "en", None, 0)], DOCS).withColumn("kept", F.lit("clash"))
    got = quality_rules.quality(docs).select("doc_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, False), (1, True), (1, True), (2, True)], key=str)
    assert quality_rules.quality(docs.limit(0)).count() == 0
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and [r["kept"] for r in kept.collect()] == ["clash"] * 3
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


# -------------------------------------------------------------- chat windows
def slow_chat(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r or "", x or "") for _, _, r, x in sorted((r for r in rows if r[0] == conv),
                                                            key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
        said = "".join(f"{r}\n{x}\n" for r, x in turns)
        learnt = "".join(x for r, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt),
                     hashlib.sha256(learnt.encode()).hexdigest())
    return out


def odd_turns():
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
            (1, 0, "system", "be <|brief|>"), (2, 5, "assistant", ""), (2, 5, "assistant", ""), (3, None, None, None),
            (None, 0, "user", "no id"), (None, 1, "assistant", "none <|end|>\n<|turn:user|>\nx"),
            (4, 0, "we<|ird|>&amp;", "&lt;| & &amp; |&gt; <|turn:assistant|>\n<|end|>\n")]
    rows += [(9, 0, "system", "s " * 90)]
    rows += [(9, i, "user" if i % 2 else "assistant", f"é{i} " * (i * 37 % 260)) for i in range(1, 700)]
    rows += [(10, i, "assistant", "🙂" * 4000 if i == 3 else "tiny") for i in range(8)]
    return rows


def test_windows_read_back_to_the_conversations(spark):
    rows = odd_turns()
    df = spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit("clash"))
    made = chat_windows.windows(df)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in chat_windows.read_back(made).collect()}
    assert got == slow_chat(rows)


def test_windows_keep_the_budget_and_the_system_turn(spark):
    made = chat_windows.windows(spark.createDataFrame(odd_turns(), TURNS)).where("conv_id = 9").orderBy("start").collect()
    assert len(made) > 10
    for i, w in enumerate(made):
        longest = max(-(-len(html.unescape(b).encode()) // 4) for b in re.findall(r"\|>\n(.*?)<\|end\|>\n", w["formatted"], re.S))
        assert w["n_tokens"] <= chat_windows.BUDGET or longest > 100
        assert w["formatted"].startswith("<|turn:system|>\n")
        assert i == 0 or w["n_repeated"] >= 1
        for s in w["loss"]:  # a span begins after its assistant mark and ends at its close
            assert w["formatted"][:s["start"]].endswith("<|turn:assistant|>\n")
            assert w["formatted"][s["start"] + s["length"]:].startswith("<|end|>\n")
    assert any(w["n_repeated"] > 1 for w in made)
    assert all(w["n_tokens"] <= chat_windows.BUDGET for w in made)


def test_no_turns_no_windows(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat_windows.windows(empty).count() == 0
    assert chat_windows.read_back(chat_windows.windows(empty)).count() == 0


# -------------------------------------------------------------------- mixing
def corpus(spark):
    rows, i = [], 0
    for s, n in (("big", 900), ("mid", 120), ("small", 12), (None, 60)):
        for k in range(n):
            rows.append((i, " ".join(["w"] * (1 + (k * 7) % 23)), "en", s, 0))
            i += 1
    rows += [(i, "", "en", "big", 0), (i + 1, None, "en", "none", 0)]
    return spark.createDataFrame(rows, DOCS)


def test_weights_meet_entropy_and_repetition(spark):
    docs = corpus(spark).withColumn("epoch", F.lit("clash"))
    p = {r["source"]: r for r in mixing.plan(mixing.narrow(docs), 0.95, 4.0, 0.9).collect()}
    assert sum(r["weight"] for r in p.values()) == pytest.approx(1)
    assert all(r["budget"] <= 4 * r["tokens"] for r in p.values())
    drawn = mixing.mixture(docs, 0.95, 4.0, 0.9).collect()
    for s, r in p.items():
        got = [d for d in drawn if d["source"] == s]
        used = sum(d["n_tokens"] for d in got)
        assert 0 <= used - r["budget"] < 23  # less than one text over
        counts = Counter(d["doc_id"] for d in got)
        assert max(counts.values()) - min(counts.values()) <= 1  # whole passes, and a part of one more
        assert {d["epoch"] for d in got} == set(range(max(counts.values())))
    # without the limit the entropy target is met exactly
    alpha = mixing.exponent(mixing.narrow(docs).where("t > 0").groupBy("source").agg(F.sum("t").alias("t")), 0.95, 1e9, 0.9)
    t = np.array([r["tokens"] for r in p.values()], float)
    w = (t / t.sum()) ** alpha
    w /= w.sum()
    assert -(w * np.log(w)).sum() == pytest.approx(0.95 * math.log(4), abs=1e-4)


def test_cut_is_exact_at_any_range_size(spark, monkeypatch):
    docs = corpus(spark)
    want = sorted(map(tuple, mixing.mixture(docs, 0.9, 4.0, 0.5).collect()), key=str)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    assert sorted(map(tuple, mixing.mixture(docs, 0.9, 4.0, 0.5).collect()), key=str) == want


def test_mixed_rows_and_empty_tables(spark):
    docs = corpus(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == mixing.mixture(docs).count()
    assert mixing.mixture(docs.limit(0)).count() == 0
    one = mixing.mixture(docs.where("source = 'small'"), budget=1.0)
    assert one.count() == 12  # one source: the natural mix
    assert mixing.mixture(docs.where("text is null or text = ''")).count() == 0


def test_a_long_first_text_and_shared_ids_are_not_left_out(spark):
    rows = [(1, "w " * 5000, "en", "one", 0), (2, "v " * 300, "en", "two", 0), (3, "u " * 310, "en", "two", 0)]
    rows += [(None, f"n{i} " * 50, "en", "none", 0) for i in range(40)] + [(7, f"m{i} " * 50, "en", "same", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    for budget in (0.3, 1.0):
        got = [r.asDict() for r in mixing.mixture(docs, 0.98, 4.0, budget).collect()]
        plan = {r["source"]: r for r in mixing.plan(mixing.narrow(docs), 0.98, 4.0, budget).collect()}
        for s, r in plan.items():
            own = [x["n_tokens"] for x in got if x["source"] == s]
            longest = max(x["n_tokens"] for x in got if x["source"] == s)
            assert r["budget"] <= sum(own) < r["budget"] + longest
        places = Counter((x["source"], x["epoch"], x["place"]) for x in got)
        assert max(places.values()) == 1  # texts of one id, or of none, have places of their own
    part = [x for x in got if x["source"] == "none"]
    assert len({x["place"] for x in part}) == len(part)


def test_one_source_is_kept_whole(spark):
    docs = spark.createDataFrame([(i, f"w{i} x y", "en", "s", 0) for i in range(200)], DOCS)
    assert sorted(r["doc_id"] for r in mixing.mixture(docs).collect()) == list(range(200))


# -------------------------------------------------------- names of user columns
CLASH = ["__digest", "__n", "__source", "__passes", "__cut", "__epoch", "__place", "row", "mark", "digest", "key", "epoch", "place",
         "src", "passes", "cut", "n", "root", "least", "fp", "copies", "kept", "__row", "__words", "score", "label", "toxic"]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_stages_keep_user_columns_of_any_name(spark, kind):
    import corpus_pipeline
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(300)
    wide = docs.withColumns({c: (F.col("doc_id") * 3 + i).cast(kind) for i, c in enumerate(CLASH)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want = {r["doc_id"] for r in stage(spark, docs, DATA).select("doc_id").collect()}
        out = stage(spark, wide, DATA)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert {r["doc_id"] for r in rows} == want, name
        for r in rows:
            assert [str(r[c]) for c in CLASH] == [str(r["doc_id"] * 3 + i) for i in range(len(CLASH))], name
    encoded = {r["doc_id"]: tuple(r) for r in corpus_pipeline.encoded(spark, docs, DATA).collect()}
    assert {r["doc_id"]: tuple(r) for r in corpus_pipeline.encoded(spark, wide, DATA).collect()} == encoded


# -------------------------------------------------------------------- fixity
def records(rows):
    return [(f, o, f"u{f}-{o}", 10, s) for f, o, s in rows]


def test_audit_finds_exactly_what_differs(spark):
    schema = "file long, offset long, uri string, length long, sha256 string"
    a = [(f, o * 700, f"{f}:{o}") for f in (-1, 0, 1, 70, 5000) for o in range(300)]
    b = [(f, o, s) for f, o, s in a if (f, o) != (70, 700 * 5)]  # one is missing
    b = [(f, o, s + "!" if (f, o) in ((0, 0), (5000, 700 * 299)) else s) for f, o, s in b]  # two are changed
    b += [(1, 701, "new"), (9, 0, "file")]  # two are extra
    got = warc_fixity.audit(spark.createDataFrame(records(a), schema), spark.createDataFrame(records(b), schema)).collect()
    assert sorted((r["file"], r["offset"], r["status"]) for r in got) == [
        (0, 0, "changed"), (1, 701, "extra"), (9, 0, "extra"), (70, 3500, "missing"), (5000, 209300, "changed")]
    x = spark.createDataFrame(records(a), schema)
    assert warc_fixity.audit(x, x).count() == 0
    assert warc_fixity.audit(x.limit(0), x.limit(0)).count() == 0
    assert warc_fixity.audit(x, x.limit(0)).where("status = 'missing'").count() == len(a)


def test_only_differing_branches_are_read(spark):
    schema = "file long, offset long, uri string, length long, sha256 string"
    a = spark.createDataFrame(records([(0, o * 900, str(o)) for o in range(2000)]), schema)
    b = a.withColumn("sha256", F.when(F.col("offset") == 900 * 777, "bad").otherwise(F.col("sha256")))
    levels = warc_fixity.tree(a.withColumn("side", F.lit(0)).union(b.withColumn("side", F.lit(1))))
    assert len(levels) == warc_fixity.RANGES + 1 + warc_fixity.GROUPS
    for k, level in enumerate(levels):  # one node differs on each level
        assert warc_fixity.differing(level, ["file", "at"] if k < warc_fixity.RANGES else ["file"]).count() == 1
    assert levels[0].count() > 200 and levels[-1].count() == 2


def test_archive_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "é"), (1, None, None), (2, "u", "")],
                                  "page_id long, url string, html string")
    r = warc_fixity.laid_out(warc_fixity.hashed(warc_fixity.archive(pages))).collect()
    assert len(r) == 4 and {x["offset"] for x in r if x["file"] == -1} == {0}
    a, b = warc_fixity.damaged_copy(warc_fixity.archive(pages))
    assert warc_fixity.audit(a, b).count() == 0


# --------------------------------------------------------------------- pages
def article(source):
    inner = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S).group(1)
    parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", p.replace("<br>", " "))).split())
             for p in re.split("</?(?:p|h1)>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = html_template.extract(pages.withColumn("text", F.lit("clash")).withColumn("host", F.lit(1)))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert {r["page_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def layout(i):
    """Pages without an article element: only the template tells text from frame."""
    return (f"<html><head><title>t{i}</title><script>if (a<b) {{}}</script></head><body><header><h1>Site</h1></header>"
            f"<div class='top-menu'><a href=x>Home</a></div><div id=w><div>Always the same words</div>"
            f"<section><h2>Story {i}</h2><p>First &amp; para {i} of a <b>bold</b> text<br>goes on.<p>Second "
            + f"word{i} " * 30 + f"</p><ul><li>one{i}<li>two{i}</ul></section></div>"
            f"<form>Mail <input></form><div class='cookie-notice'>We use cookies {i}</div>"
            f"<section class=comments><article class=comment><p>Nice {i}</p></article></section>"
            f"<aside>Side {i}</aside><footer>(c) {i}</footer></body></html>")


def test_template_tells_text_from_frame(spark):
    rows = [(i, f"http://a.example/{i}", layout(i)) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in html_template.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        assert got[i] == "\n\n".join([f"Story {i}", f"First & para {i} of a bold text goes on.",
                                      "Second " + " ".join([f"word{i}"] * 30), f"one{i}", f"two{i}"])


def texts_of(spark, rows):
    """Blocks by page id; the pages are of one host."""
    rows = [(i, f"http://one.example/{i}", s) for i, s in rows]
    out = html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r["page_id"]: r["text"].split("\n\n") for r in out.collect()}


def test_template_text_inside_an_article_goes(spark):
    def page(i):
        told = "" if i == 3 else "<p>Read more in our app</p>"
        twice = "<p>Said by half</p>" if i % 2 else ""
        return f"<body><article><p>Please note the terms</p><h1>T{i}</h1>{twice}<p>a{i} b{i}</p>{told}</article></body>"
    want = {i: [f"T{i}", *["Said by half"] * (i % 2), f"a{i} b{i}"] for i in range(20)}
    assert texts_of(spark, [(i, page(i)) for i in range(20)]) == want
    # copies count as one page: here three pages, which make no template
    few = texts_of(spark, [(i, page(i % 3)) for i in range(30)])
    assert all(x[0] == "Please note the terms" and x[-1] == "Read more in our app" for x in few.values())


def test_slots_beside_the_longest_one_stay(spark):
    def text(i):
        return " ".join(f"w{i}x{k}" for k in range(60))
    nested = [(i, f"<body><div>All the same</div><div id=content><h1>T{i}</h1><p>in{i}</p><section><p>{text(i)}</p></section>"
                  f"</div><div class=side><article><p>Tip {i}</p></article></div></body>") for i in range(10)]
    assert texts_of(spark, nested) == {i: [f"T{i}", f"in{i}", text(i), f"Tip {i}"] for i in range(10)}
    beside = [(i, f"<body><b>Site</b><div class=lead>in{i}</div><div class=body>{text(i)}</div></body>") for i in range(10)]
    assert texts_of(spark, beside) == {i: [f"in{i}", text(i)] for i in range(10)}
    # a frame's words do not make it the slot, and a name does not take the slot away
    framed = [(i, f"<body><div>{text(0)}</div><article><p>Short {i}</p></article></body>") for i in range(10)]
    assert texts_of(spark, framed) == {i: [f"Short {i}"] for i in range(10)}
    named = [(i, f"<body><div>Site</div><div id=banner-page><h1>T{i}</h1><p>{text(i)}</p><div class=share>s{i}</div></div></body>")
             for i in range(10)]
    assert texts_of(spark, named) == {i: [f"T{i}", text(i)] for i in range(10)}


def test_names_leave_out_frames_and_not_pages_or_passages():
    def kept(source):
        return [x.text for x in html_template.Page(source).blocks]
    assert kept('<html class="menu"><body class="blog has-sidebar"><p>a</p></body></html>') == ["a"]
    assert kept('<body><div class="wrap no-sidebar"><main class="search" id="search"><p>a</p></main></div></body>') == ["a"]
    assert kept('<body><div id="sidebar-page"><main><p>a</p></main><p>b</p></div></body>') == ["a"]
    assert kept('<article class="post widget"><section id="discussion"><h2 id="search">h</h2><p id="notice">p</p></section>'
                '<div class="share">x</div><div id="comments">y</div><section class="related">z</section></article>') == ["h", "p"]
    assert kept('<article><p title="a hidden cost">a</p><p hidden>b</p><p class="x" hidden="">c</p>'
                "<p data-is=hidden aria-hidden='false'>d</p></article>") == ["a", "d"]
    assert kept("<article><p>so <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> holds</p>"
                "<object data=f.svg><p>a drawing</p></object></article>") == ["so x+1 holds", "a drawing"]


def test_classes_are_nested_or_ignored():
    page = html_template.Page("<body><div><i>a</i><p>x</p><p>y</p></div><section><p>z</p></section></body>")
    tags = [t for t, _ in page.tags]
    root, para = [tags[0], tags[1], tags[4]], tags[2]
    assert html_template.covered(page, root, []) == {page.tags[k][1] for k in (0, 1, 4)}
    assert html_template.covered(page, root, [[para]]) >= {page.tags[2][1], page.tags[3][1]}  # both in one gap
    other = html_template.Page("<body><div><p>x</p></div><section></section><div><p>y</p></div></body>")
    t = [x for x, _ in other.tags]
    assert html_template.covered(other, [t[0], t[3]], [[t[2]]]) == {other.tags[0][1], other.tags[3][1]}  # in two gaps


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://h/x", "<article><p>ok<p>&lt;b&gt; &#233;&nbsp;x"),
            (3, "http://h/x", "no tags < at all & more"), (3, "http://h/x", "no tags < at all & more"),
            (4, "http://h/", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 10),
            (5, "x", "<!-- open <article>lost"), (6, "x", "<article><p title=\"a>b\">in</p><a b='>broken"),
            (7, "x", "<article><p>" + "long " * 60000 + "</p></article>")]
    got = [(r["page_id"], r["text"]) for r in html_template.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    want = [(1, ""), (2, ""), (None, "ok\n\n<b> é x"), (3, "no tags < at all & more"), (3, "no tags < at all & more"),
            (4, "deep"), (5, ""), (6, "in\n\nbroken"), (7, " ".join(["long"] * 60000))]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert html_template.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---------------------------------------------------------------- neighbours
def brute(rows, k):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            s = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)[:k]
            out[q] = [(i, -x) for x, i in s]
    return out


def test_recall_and_exact_scores(spark):
    e = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r["vec_id"], np.array(r["embedding"], np.float64)) for r in e.collect()]
    want = brute(rows, 20)
    for block, queries in ((16384, 1024), (100, 7)):
        got = {}
        for r in ann_mih.neighbours(e, lambda i: i % 20 == 0, block=block, queries=queries).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
        vec = dict(rows)
        assert all(s == pytest.approx(float(np.dot(vec[q], vec[i])), abs=1e-12) for q, x in got.items() for i, s in x)
        hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hit / (20 * len(want)) >= 0.9


def test_pigeonhole_probing_misses_nothing():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 32), dtype=np.uint8)
    codes[:50] = codes[50:51] ^ np.packbits(rng.random((50, 256)) < 0.1, axis=1)
    index = ann_mih.Block(codes)
    off = np.bitwise_count(codes ^ codes[50]).sum(axis=1)
    for radius in (0, 10, 25, 40, 100):
        assert set(index.within(codes[50], radius, 1)) == set(np.nonzero(off <= radius)[0])
    assert len(index.within(codes[50], 0, 30)) >= 30  # widened


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]),
            (40, None), (9, [])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in ann_mih.neighbours(df, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 2, 0.5)]
    assert ann_mih.neighbours(df.limit(0), lambda i: i % 20 == 0).count() == 0
    assert ann_mih.neighbours(df.where("vec_id = 0"), lambda i: i % 20 == 0).count() == 0


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_follow_one_another(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    step = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        step = stage(spark, step, DATA)
        if i < 4:
            assert step.columns == docs.columns
    want = sorted(map(tuple, step.collect()))
    assert want == sorted(map(tuple, corpus_pipeline.run(spark, DATA).collect()))
    assert {r[0] for r in want} <= {r["doc_id"] for r in docs.collect()}


def test_pipeline_over_an_empty_table(spark):
    import corpus_pipeline
    step = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, DATA)
    assert step.count() == 0
