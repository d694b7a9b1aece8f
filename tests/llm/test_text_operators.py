"""Language, winnowing, mixing, token counts, main text and resampling on small tables, against brute force and in edge cases."""

import random
import re

import numpy as np
import pytest

from siteatlas.llm import density, language, mixing, pieces, resampling, winnowing
from tests.conftest import SF

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "wort " * 40_000 + "x" * 100_000

# ---- language ----------------------------------------------------------------------------------------


def test_held_out_language_is_found(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").filter("held_out").collect()
    assert len(found) > 200
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edge_cases(spark):
    rows = [
        (0, "the cat and the dog", "en", "t"), (1, "le chat et le chien", "fr", "t"), (2, None, "en", "t"), (3, "", None, "t"), (4, "12 34 %%", "fr", "t"),
        (5, "a", None, "t"), (6, "漢字", None, "t"), (7, LONG, None, "t"), (None, "le chien", "fr", "t"), (8, "the cat", None, "t"), (8, "the cat", None, "t"), (9, "zzzzzzz", None, "t"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = language.identify(docs).collect()
    assert len(found) == len(rows)
    of = {r.doc_id: r for r in found}
    assert [of[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and of[2].score == 0
    assert of[8].lang_pred == "en" and of[8].score > 0.5
    assert of[9].score == 0 and of[6].lang_pred in ("en", "fr")
    assert sorted(found[0].asDict()) == ["doc_id", "held_out", "lang_pred", "score"]


def test_language_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(docs).collect()] == [("und", 0.0)]
    assert language.identify(docs.limit(0)).count() == 0


def test_many_languages_share_one_table(spark):
    names = [f"l{i:02d}" for i in range(70)]
    rows = [(i, " ".join(chr(0x4E00 + i * 20 + j) * 3 for j in range(20)), names[i]) for i in range(70)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = language.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert sum(r.lang_pred == names[r.doc_id] for r in found) >= 69


# ---- winnowing -----------------------------------------------------------------------------------------


def contaminated(docs, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    out = []
    for i, text in docs:
        found, hit, of = split(text), set(), set()
        for item, t in items:
            w = split(t)
            m = min(len(w), window)
            windows = {tuple(w[a : a + m]) for a in range(len(w) - m + 1)} if m else set()
            for a in range(len(found) - m + 1):
                if tuple(found[a : a + m]) in windows:
                    hit.update(range(a, a + m))
                    of.add(str(item))
        spans = [a for a in sorted(hit) if a - 1 not in hit]
        out.append((i, len(found), len(hit), len(spans), sorted(of)))
    return sorted(out, key=str)


def winnowed(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    rows = winnowing.find(d, b).collect()
    return sorted(((r.doc_id, r.n_words, sum(s.high - s.low for s in r.spans), len(r.spans), list(r["items"])) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(12)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.randint(0, 25))) for i in range(25)]
    docs = []
    for i in range(60):
        parts = [rng.choice(items)[1] if rng.random() < 0.3 else say(rng.randint(0, 30)) for _ in range(rng.randint(1, 5))]
        docs.append((i, ", ".join(p[rng.randint(0, 9) :] for p in parts)))
    assert winnowed(spark, docs, items) == contaminated(docs, items)


def test_window_edge_cases(spark):
    ten = "a b c d e f g h i j"
    items = [(1, ten), (2, None), (3, ""), (4, "Solo"), (5, "-!-"), (10, ten.upper()), (None, ten), (6, "x y"), (7, "é è"), (7, "q r s")]
    docs = [
        (1, None), (2, ""), (3, "solo"), (4, ten), (4, "other"), (None, "zz " + ten), (5, "a-b,c.d;e f g h i j k"), (6, LONG + " x y"), (7, "É è é è"), (8, "a b c d e f g h i"), (9, "q r s x  y"),
    ]
    assert winnowed(spark, docs, items) == contaminated(docs, [x for x in items if x[0] is not None])
    assert winnowed(spark, docs, []) == contaminated(docs, [])
    assert winnowed(spark, [], items) == []


def test_items_without_an_id_count(spark):
    duck = pytest.importorskip("duckdb").connect()
    ten = [" ".join(f"{c}{i}" for i in range(10)) for c in "abc"]
    items = [(1, ten[0]), (None, ten[1]), (None, "x y"), (None, ten[2]), (2, ten[2])]
    docs = [(1, f"so {ten[0]} and {ten[1]}"), (2, f"only {ten[1]} here"), (3, "the x  Y"), (4, f"{ten[2]} x y"), (5, "none of it"), (6, ten[1] + " x y")]
    want = [(i, n, hit, spans, [x for x in of if x != "None"]) for i, n, hit, spans, of in contaminated(docs, items)]
    assert winnowed(spark, docs, items) == want and [r[2] for r in want] == [20, 10, 2, 12, 0, 12]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = sorted(tuple(r) for r in winnowing.report(winnowing.find(d, b)).collect())
    documents, benchmark = d.toArrow(), b.toArrow()  # noqa: F841 (read by the SQL)
    assert found == sorted(duck.execute(winnowing.ORACLE).fetchall())


# ---- mixing --------------------------------------------------------------------------------------------


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Fill by weight, fix what is full, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), list(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] >= most * sizes[s]]
        if not full:
            return out | {s: level * weight[s] for s in free}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
            free.remove(s)
    return out


def test_mix(spark):
    rng = random.Random(9)
    names = ["b", "a", "é", None, "Z", "tiny", "none"]
    rows = []
    for i in range(4000):
        s = rng.choices(names, [40, 20, 20, 10, 8, 2, 0])[0]
        rows.append((i, "w " * rng.randint(0, 30), s))
    rows += [(5000, None, "none"), (5001, "", "none"), (5002, "big " * 5000, "a"), (7, "twice ", "b"), (7, "twice ", "b"), (None, "no id", "b")]
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, source string, size int, target double")
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for i, text, s in rows:
        sizes[s] = sizes.get(s, 0) + len((text or "").split())
        largest[s] = max(largest.get(s, 0), len((text or "").split()))
    expected = targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
        assert r.taken == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - expected[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r["size"], r.taken)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str) and key
    whole = mixing.mix(docs, prefix="mix_")
    assert whole.columns[:5] == docs.columns and whole.count() == len(rows)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_is_the_same_without_broadcast(spark, monkeypatch):
    rows = [(i, "w " * (i % 7), ["a", "b", None][i % 3]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sent = mixing.mix(docs).collect()
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    assert sorted(sent, key=lambda r: r.doc_id) == sorted(mixing.mix(docs).collect(), key=lambda r: r.doc_id)


# ---- token counts --------------------------------------------------------------------------------------


def greedy(vocabulary, word):
    n = at = 0
    while at < len(word):
        to = next((j for j in range(len(word), at, -1) if word[at:j] in vocabulary), None)
        if to is None:
            return 1
        n, at = n + 1, to
    return n


@pytest.mark.parametrize("seed", range(3))
def test_token_counts_equal_greedy(spark, seed):
    rng = random.Random(seed)
    say = lambda n: bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, n)))
    vocabulary = {say(6) for _ in range(60)} | {b" ", b"a", b"b", b"c"} | {b" " + say(3) for _ in range(20)}
    rows = [(i, " ".join(say(14).decode() for _ in range(rng.randint(0, 30)))) for i in range(40)] + [(100, None), (101, ""), (102, "é d"), (103, "ab" * 40_000), (None, "a")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_tokens int")
    found = sorted((tuple(r) for r in pieces.count_tokens(docs, sorted(vocabulary)).collect()), key=str)
    long = {103: (1, len("ab" * 40_000))}
    expected = []
    for i, t in rows:
        split = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        if i in long:
            continue
        expected.append((i, len(split), sum(greedy(vocabulary, b" " + w.encode()) for w in split)))
    assert [r for r in found if r[0] not in long] == sorted(expected, key=str)
    assert pieces.count_tokens(docs.limit(0), [b"a"]).count() == 0


def test_public_vocabulary_counts(spark):
    vocabulary = pieces.read_vocabulary(pieces.VOCABULARY)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known, most = set(vocabulary), max(map(len, vocabulary))
    texts = {r.doc_id: r.text for r in docs.collect()}

    def count(word):
        n = at = 0
        while at < len(word):
            to = min(len(word), at + most)
            while word[at:to] not in known:
                to -= 1
            n, at = n + 1, to
        return n

    for r in pieces.count_tokens(docs, vocabulary).collect():
        assert r.n_tokens == sum(count(b" " + w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""))


# ---- main text -----------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice">We use cookies. We really do, and many of them, all over the place.</div>
<{0}><h1>Head &amp; line</h1><p>First  paragraph with <b>bold</b> and <a href="x">a link</a>.<p>Second &lt;one&gt;<br>goes on.
<div class="ad">Buy this now</div><script>var x = "</p>";</script><form><input name=q>Search</form><ul><li>one<li>two</ul></{0}>
<aside>Beside</aside><div id="comments"><p>Reader says something long enough to matter for sums, really long.</p></div><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_main_text(tag):
    expected = "Head & line\nFirst paragraph with bold and a link.\nSecond <one> goes on.\none\ntwo"
    assert density.extract(PAGE.format(tag)) == expected


@pytest.mark.parametrize(
    "html,text",
    [
        (None, ""), ("", ""), ("plain   text", "plain text"), ("<p>a<p>b", "a\nb"), ("<p>cut &amp te", "cut & te"), ("<p>a</p><p", "a"), ("a < b", "a < b"),
        ("<nav>only menu</nav>", ""), ("<!-- <p>no</p> --><p>yes", "yes"), ("<![CDATA[x]]><p>y</p>", "y"), ("<p>a<!-- open", "a"), ("<script>a<b</script>ok", "ok"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<p>a</b></i>b</p>", "ab"), ("<p title='a>b'>c</p>", "c"), ("<p title=\"x>y</p><p>z", "y\nz"),
    ],
)
def test_broken_pages(html, text):
    assert density.extract(html) == text


WRAPPED = """<body><header>Top</header>{0}<div class="sidebar"><p>Beside it all stands this.</p></div>
<div id="comments"><ol><li class="comment"><article class="comment-body"><p>Reader says a lot about it.</p></article></ol></div><footer>End</footer>{1}</body>"""
STORY = "<{0}><h1>Head</h1><p>First paragraph of the story, rather long.</p><form><input name=q>Search</form><p>Second one goes on for a while, too.</p></{0}>"


@pytest.mark.parametrize("tag", ["article", "main", "div"])
@pytest.mark.parametrize(
    "start,end",
    [
        ('<div class="content-sidebar-wrap">', "</div>"), ('<div class="has-sidebar">', "</div>"), ('<section id="no-ads">', "</section>"), ('<div class="comments-open">', "</div>"),
        ('<form method="post" action="page.aspx">', "</form>"), ('<form role="form"><div class="has-sidebar no-ads">', "</div></form>"), ('<form class="search">', ""),
    ],
)
@pytest.mark.parametrize("whole", [True, False])
def test_wrappers_with_odd_names_stay(tag, start, end, whole):
    story = STORY.format(tag)
    page = start + WRAPPED.format(story, "") + end if whole else WRAPPED.format(start + story + (end or "</form>"), "")
    assert density.extract(page) == "Head\nFirst paragraph of the story, rather long.\nSecond one goes on for a while, too."


def test_what_is_left_out_beside_wrappers():
    long = "<p>" + "Many other words stand here, more than in the article. " * 9 + "</p>"
    # a short article in a wrapper, and long elements outside it that hold no more than half of the text each
    page = f'<body><div class="related">{long}</div><div class="has-sidebar"><article><p>A short one.</p></article></div><div class="promo">{long}</div></body>'
    assert density.extract(page) == "A short one."
    # beside an article or main, but not within it, a longer element goes
    assert density.extract(f'<body><div class="ad">{long}</div><main><h1>The title</h1></main></body>') == "The title"
    assert density.extract(f'<body><main><h1>The title</h1><div class="has-sidebar">{long}</div></main><div class="ad">{long * 2}</div></body>').count("Many") == 9
    # nothing would remain: density alone decides
    assert density.extract(f'<body><div class="has-sidebar">{long}</div><div class="no-ads">{long}</div></body>').count("Many") == 18
    # links do not make an element the larger part
    assert density.extract('<body><p>The text of it.</p><div class="related">' + '<a href="/x">Another page of ours</a>' * 9 + "</div></body>") == "The text of it."


def test_pages_table(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "v", deep), (3, "w", "<p>" + "word " * 100_000)]
    pages = spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, text int")
    found = density.pages_text(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 0), (1, 1), (1, 1), (2, 4), (3, 499_999)]
    assert density.pages_text(pages.limit(0)).count() == 0


def test_articles_of_the_table(spark):
    from html import unescape

    wrong = 0
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = r.html[r.html.index("<article>") + 9 :].split("</article>")[0].split("<footer>")[0]
        body = re.sub(r"<[^>]*$", "", body).replace("<br>", " ")
        blocks = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1)>", "\0", body)).split("\0")
        blocks = [re.sub(r"\s+", " ", unescape(b)).strip() for b in blocks]
        wrong += "\n".join(b for b in blocks if b) != density.extract(r.html)
    assert wrong == 0


# ---- resampling ----------------------------------------------------------------------------------------


def test_resampling(spark):
    rng = random.Random(3)
    good, bad = [f"g{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(rng.randint(1, 20)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "g1 g2"), (1, rows[1][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, selected string")
    target = spark.createDataFrame([(i,) for i in [*range(1, 200, 2), None, 1]], "doc_id long")
    found = resampling.resample(docs, target).collect()
    assert len(found) == len(rows)
    chosen = [r for r in found if r.selected]
    assert len(chosen) == sum(r.sample_key >= min(c.sample_key for c in chosen) for r in found) and 0 <= len(chosen) - 202 <= 1
    assert sum(r.doc_id is not None and r.doc_id % 2 == 1 for r in chosen) > 150
    of = {r.doc_id: r for r in found}
    assert of[1000].log_weight == of[1001].log_weight == 0 and of[1000].n_grams == 0

    # the models by hand
    grams = lambda t: [tuple(w[a : a + k]) for w in [(t or "").split()] for k in (1, 2) for a in range(len(w) - k + 1)]
    texts = dict(rows)
    p, q = {}, {}
    for i, t in rows:
        for g in grams(t):
            q[g] = q.get(g, 0) + 1
            if i is not None and i % 2 and i < 200:
                p[g] = p.get(g, 0) + 1
    score = lambda t: sum(
        np.log((p.get(g, 0) + 1) / (sum(p.values()) + resampling.BUCKETS)) - np.log((q[g] + 1) / (sum(q.values()) + resampling.BUCKETS)) for g in grams(t)
    )
    close = [abs(of[i].log_weight - score(texts[i])) < 0.5 + 0.05 * abs(score(texts[i])) for i in range(2, 400)]
    assert np.mean(close) > 0.9  # buckets that two grams share aside
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert resampling.resample(docs, target.limit(0)).count() == len(rows)


def test_kth_largest(spark):
    rng = random.Random(8)
    values = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(500)] + [0, -1, -(1 << 63), (1 << 63) - 1] + [5] * 20
    keys = spark.createDataFrame([(v,) for v in values], "key long")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 250, 262, 270, len(values)):
        assert resampling.kth_largest(keys, k) == ordered[k - 1]
    assert resampling.kth_largest(keys, len(values) + 1) is None
