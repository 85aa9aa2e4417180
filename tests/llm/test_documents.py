import collections
import html
import random
import re

import pytest
from pyspark.sql import functions as F

from support import docs, shipped  # noqa: F401
from tallystock.llm import html_text, jaccard_join, quality_rules, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- repeated passages

def removed_words(texts, width):
    where = collections.Counter()
    words = [WORD.findall(t or "") for t in texts]
    for w in words:
        where.update(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return [({k for i in range(len(w) - width + 1) if where[tuple(w[i:i + width])] > 1 for k in range(i, i + width)}, w) for w in words]


def test_repeated_windows_go(docs):
    r = random.Random(1)
    passage = "p1 p2 p3 p4 p5 p6 p7"
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 60))) for _ in range(40)]
    texts += [f"u{k} {passage}\n v{k}" for k in range(30)] + ["x " * 50, "é\tß  é ß", None, "", " \n", passage, passage]
    df = docs(list(enumerate(texts))).withColumn("kept", F.lit("clash"))
    want = removed_words(texts, 5)
    for row in substring_dedup.substring_dedup(df, width=5).collect():
        gone, words = want[row.doc_id]
        assert (row.n_words, row.n_removed, row.extra) == (len(words), len(gone), "x")
        assert {k for i in row.removed for k in range(i.first, i.end)} == gone
        assert row.kept == " ".join(w for k, w in enumerate(words) if k not in gone)
    for row in substring_dedup.substring_dedup(df, width=5, layout=True).collect():
        gone, words = want[row.doc_id]
        assert WORD.findall(row.kept) == [w for k, w in enumerate(words) if k not in gone]
        assert gone or row.kept == (texts[row.doc_id] or "")


def test_repeated_passages_without_rows(docs):
    assert substring_dedup.substring_dedup(docs([])).collect() == []


# ---- near copies

def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def groups(texts):
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(texts):
        least[find(k)] = min(least.get(find(k), d), d)
    return [(d, len(sets[k]), least[find(k)]) for k, (d, _) in enumerate(texts)]


def near_copies(r, n):
    base = [f"w{k}" for k in range(60)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(60)] = f"e{r.randrange(20)}"
        out.append((1000 + k, " ".join(w)))
    return out


@pytest.mark.parametrize("short_list,block", [(32, 1024), (3, 16)])
def test_groups_of_near_copies(docs, monkeypatch, short_list, block):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short_list)
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", block)
    r = random.Random(short_list)
    texts = near_copies(r, 90) + [(k, " ".join(r.choice("abcd") for _ in range(r.randint(0, 12)))) for k in range(60)]
    texts += [(200, None), (201, ""), (202, "One two"), (203, "one TWO"), (204, "é b c d e f")]
    members, links = jaccard_join.jaccard_join(docs(texts), hub_rounds=1)
    assert sorted((x.id, x.n_shingles, x.component_id) for x in members.collect()) == sorted(groups(texts))
    assert links.count() >= 1


def test_one_of_each_group_stays(docs):
    long = " ".join(f"w{k}" for k in range(30))
    texts = [(5, long), (3, long + " x"), (9, long.upper()), (1, "other text here"), (4, None), (6, ""), (1, "other text here"), (None, "zz")]
    kept = jaccard_join.keep_one(docs(texts))
    assert kept.columns == ["doc_id", "text", "extra"]
    assert sorted(((x.doc_id or 0), x.text or "") for x in kept.collect()) == [
        (0, "zz"), (1, "other text here"), (3, long + " x"), (4, ""), (6, "")]
    assert jaccard_join.keep_one(docs([])).collect() == []


# ---- quality rules

def counts(text):
    w = WORD.findall(text or "")
    three = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(covered)


def test_rule_counts(docs):
    r = random.Random(7)
    parts = ["a", "b", "é", " ", "\n", "\n\n", "#", "<", "\t", "word", "😀"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(200)] + [None, "", "a b c a b c", "\n\n"]
    model = quality_rules.QualityModel(quality_rules.np.zeros(1 << 16), float("-inf"), 4)
    for row in quality_rules.judge(docs(list(enumerate(texts))).withColumn("score", F.lit("clash")), model).collect():
        n = counts(texts[row.doc_id])
        assert tuple(row[c] for c in quality_rules.COUNTS) == n
        assert row.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and row.kept == (not row.base_failed)


def test_held_out_documents_are_told_apart(docs, spark):
    r = random.Random(8)
    good = lambda: " ".join("".join(r.choice(["th", "er", "an", "ou"]) for _ in range(r.randint(1, 4))) for _ in range(80))
    bad = lambda: good().upper().replace(" ", "!! ")
    texts = [(k, good() if k % 2 else bad()) for k in range(120)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(None, 1, 0), (3, 1, 0), (61, None, 1)],
                                   "doc_id long, quality int, toxic int")
    model = quality_rules.fit_quality(docs(texts), labels)
    rows = quality_rules.judge(docs(texts + [(None, good())]), model).collect()
    assert all(x.kept == (x.doc_id is None or x.doc_id % 2 == 1) for x in rows if not x.base_failed)
    none = quality_rules.fit_quality(docs(texts), labels.limit(0))
    assert none.threshold == float("-inf") and not none.weights.any()
    assert quality_rules.judge(docs([]), quality_rules.fit_quality(docs([]), labels)).collect() == []


def test_label_limit_leaves_the_trusted_counts_whole(docs, spark):
    r = random.Random(9)
    texts = [(k, " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60))) for k in range(40)]
    labels = spark.createDataFrame([(k, k % 4 > 0, 0) for k in range(40)], "doc_id long, quality boolean, toxic int").withColumn(
        "quality", F.col("quality").cast("int"))
    few, every = (quality_rules.fit_quality(docs(texts), labels, label_rows=n).weights for n in (4, 1000))
    assert every.any() and (few == every).all()


def test_threshold_comes_from_all_labels(docs, spark):
    r = random.Random(10)
    late = [x.id for x in spark.range(51_000).orderBy(F.xxhash64("id").desc()).limit(60).collect()]
    good = lambda: " ".join("".join(r.choice(["th", "er", "an", "ou"]) for _ in range(r.randint(1, 4))) for _ in range(80))
    texts = [(k, good() if k % 2 else good().upper()) for k in late]
    labels = spark.range(51_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    model = quality_rules.fit_quality(docs(texts), labels)
    assert model.threshold > float("-inf")
    assert all(x.kept == (x.doc_id % 2 == 1) for x in quality_rules.judge(docs(texts), model).collect() if not x.base_failed)


def test_threshold_is_the_best_cut(spark):
    np, r = quality_rules.np, random.Random(11)
    for n in (0, 1, 2, 30, 3000):
        rows = [(round(r.gauss(0.3 * g, 1), 2), g) for g in (r.random() < 0.4 for _ in range(n))]
        good, bad = (np.array([s for s, g in rows if g == side]) for side in (True, False))
        want = float("-inf")
        if len(good) and len(bad):
            scores = np.unique([s for s, _ in rows])
            cuts = np.concatenate([[-np.inf], (scores[1:] + scores[:-1]) / 2])
            gain = [(1 - (good < c).sum() / len(good)) + (bad < c).sum() / len(bad) for c in cuts]
            want = float(cuts[np.argmax(np.round(gain, 9))])
        assert quality_rules._best_threshold(spark.createDataFrame(rows, "score double, good boolean").repartition(5)) == want


# ---- main text of pages

SHELL = ("<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
         "<nav><ul><li><a href='/'>Home</a></li><li>About</li></ul></nav>{0}<footer>&copy; us</footer></body></html>")


def test_pages_give_their_article(spark):
    pages = [
        (1, "http://a.example/x", SHELL.format("<article><h1>T &amp;amp; x</h1><p>one<br>two<p>three <b>bold</b></article>"), "T &amp; x\n\none two\n\nthree bold"),
        (2, "http://a.example/y", SHELL.format("<div class='ad'>buy</div><article><p>a&nbsp; b</p><ul><li>q</li></ul></article><div id=comments><p>me too</p></div>"), "a b\n\nq"),
        (3, "http://b.example/", SHELL.format("<aside>side</aside><div><p>plain</p>x &lt; y</div><form>mail <input></form><p class='cookie-notice'>ok</p>"), "plain\n\nx < y"),
        (4, "http://b.example/", "<div role='navigation'>m</div><main><section><p>in</section></main><p>out</p>", "in"),
        (5, None, "just text < and more", "just text < and more"),
        (6, "http://c.example", None, ""), (7, "no address", "", ""), (None, "http://a.example", "<article>é<!-- x --></article>", "é"),
    ]
    df = spark.createDataFrame([(p, u, h, "clash") for p, u, h, _ in pages * 2], "page_id long, url string, html string, text string")
    got = html_text.extract_text(df).collect()
    assert sorted((x.page_id or 0, x.text) for x in got) == sorted((p or 0, t) for p, _, _, t in pages * 2)
    assert html_text.extract_text(df.limit(0)).collect() == []


def test_wrappers_have_optional_and_repeated_groups(spark, monkeypatch):
    monkeypatch.setattr(html_text, "FOLD", 2)
    bodies = ["<h1>t</h1>" + "<p>x</p>" * k + "<ul><li>q</li></ul>" * (k % 2) for k in range(1, 7)]
    df = spark.createDataFrame([("http://h/", f"<article>{b}</article>") for b in bodies], "url string, html string")
    (row,) = html_text.infer_wrappers(df).collect()
    wrapper = html_text.json.loads(row.wrapper)
    text = html_text.json.dumps(wrapper)
    assert row.host == "h" and '"+"' in text and '"?"' in text
    assert html_text.article_paths(wrapper) == {"article*/h1", "article*/p", "article*/ul/li"}


def test_article_of_every_page_of_the_test_table(spark):
    df = html_text.op8(spark, "/root/testdata/sf0.001")
    raw = {x.page_id: x.html for x in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for row in df.collect():
        page = raw[row.page_id]
        body = page[page.index("<article>") + 9:page.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b.replace("<b>", ""))).split()) for b in re.split("</?(?:p|h1)>", body))
        assert row.text == "\n\n".join(b for b in blocks if b) and row.n_chars == len(row.text)


def test_texts_that_a_host_repeats_are_template_whatever_their_block_is_called(spark):
    page = ("<div class='x7'>Start</div><div class='x7'>All topics</div><div class='post'><p>text {0} a</p><p>text {0} b</p></div>"
            "<section>topic {1}</section><div>Write to us</div>")
    pages = [(k, f"http://h/{k}", page.format(k, k % 2)) for k in range(12)]
    pages += [(20, "http://h/20", "<div>Write to us</div>"), (21, "http://i/", "<div class='text no-sidebar'><p>all there is</p></div>")]
    got = {x.page_id: x.text for x in html_text.extract_text(
        spark.createDataFrame(pages * 2, "page_id long, url string, html string")).collect()}
    assert got == {k: f"text {k} a\n\ntext {k} b" for k in range(12)} | {20: "Write to us", 21: "all there is"}


def test_article_keeps_what_its_host_repeats(spark):
    """Headings, closing lines and headlines of an article are its own, also where all pages of a host have them."""
    menu = "<div class='x7'>Start here</div><div class='x8'>All rights reserved by us</div>"
    dish = [f"<body>{menu}<article><header><h1>Dish {k}</h1></header><h2>Ingredients</h2><p>{k} eggs</p><h2>Method</h2><p>Beat {k} times.</p>"
            f"<p>Serve at once.</p><footer>Share it</footer></article></body>" for k in range(12)]
    near = [f"<body>{menu}<main><p>One.</p><p>Two.</p><p>Three.</p><p>tail {k}</p></main></body>" for k in range(4)]
    rows = [(k, "http://dishes.example/x", x) for k, x in enumerate(dish)] + [(100 + k, "http://near.example/y", x) for k, x in enumerate(near)]
    got = {x.page_id: x.text.split("\n\n") for x in html_text.extract_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(12):
        assert got[k] == [f"Dish {k}", "Ingredients", f"{k} eggs", "Method", f"Beat {k} times.", "Serve at once."]
    for k in range(4):
        assert got[100 + k] == ["One.", "Two.", "Three.", f"tail {k}"]
