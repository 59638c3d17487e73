import random
import re
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from logloom.llm import dart_minhash, hilbert_ann, html_paths, line_runs, queries, toxicity_cnn

from ..oracle import same
from .brute import kept_lines, near_classes
from .conftest import SF

PAGE = """<html><head><title>t</title><style>p{}</style><script>if (a<b) "<p>no</p>"</script></head><body>
<header>Site</header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies.</div>
<article><h1>Tea &amp; coffee</h1><p>First  paragraph,
with a <b>bold</b> word, and more of it.<p>Second one, left open; it has enough text to count.</p><ul><li>short</ul>
<aside>Read also</aside></article><div id="comments"><p>Nice, thanks, really a very long comment, with marks.</p></div><form>Mail</form><footer>(c)</footer></body></html>"""


def test_article_text(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (1, "u", PAGE, "x"), (4, "u", "plain &lt; text", "x"), (5, "u", "<p " * 20_000, "x")], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_paths.extract_main_text(pages).orderBy("page_id").collect()]
    want = "Tea & coffee\nFirst paragraph, with a bold word, and more of it.\nSecond one, left open; it has enough text to count.\nshort"
    assert got[:2] == [(1, want, len(want))] * 2 and got[2:5] == [(2, "", 0), (3, "", 0), (4, "plain < text", 12)] and got[5][0] == 5
    assert html_paths.extract_main_text(pages.limit(0)).count() == 0


LONG_TEXTS = [f"Paragraph {k} of the story has commas, full stops, and enough words to count as text of an article." for k in range(4)]


def test_paths_above_the_threshold_stay_wherever_they_are():
    body = "".join(f"<p>{t}</p>" for t in LONG_TEXTS[:3])
    links = "<ul>" + "".join(f"<li><a href=/{k}>Another story number {k}</a></li>" for k in range(5)) + "</ul>"
    headline = "A headline that is long enough to be above the threshold, beside the body"
    # no article or main: a headline beside the container, the last paragraph in a container of its own, links between
    page = f"<body><div class=top><h1>{headline}</h1></div>{links}<div class=text>{body}{links}<p>Short.</p></div><div class=more><p>{LONG_TEXTS[3]}</p></div>{links}<div>(c) us</div></body>"
    assert html_paths.main_text(page).split("\n") == [headline, *LONG_TEXTS[:3], "Short.", LONG_TEXTS[3]]
    # content outside the article, and an unhinted list of links inside
    page = f"<body><article>{body}{links}<p>Short.</p></article><div><p>{LONG_TEXTS[3]}</p></div></body>"
    assert html_paths.main_text(page).split("\n") == [*LONG_TEXTS[:3], "Short.", LONG_TEXTS[3]]
    # one long paragraph alone: the short ones beside it stay
    assert html_paths.main_text(f"<body><div><h1>Tea</h1><p>{' '.join(LONG_TEXTS * 9)}</p></div>{links}</body>").split("\n") == ["Tea", " ".join(LONG_TEXTS * 9)]


def test_embedded_elements_take_no_text_of_the_article():
    a, b, c = LONG_TEXTS[:3]
    for tag in ("<svg class=x />", "<svg/>", "<math/>", "<svg>", "<select>", "<object>", "<audio src=x>", "<video src=x>", "<noscript>", "<canvas>", "<svg><title>t</title><text>no</text></svg>", "<video><p>no</p></video>", "<select><option>no</select>"):
        page = f"<body><article><p>{a}</p><div>{tag}</div><p>{b}</p></article><div><p>{c}</p></div></body>"
        assert html_paths.main_text(page).split("\n") == [a, b, c], tag
    page = f"<article><p>{a}</p><p>Given <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> and <svg><g><text>no</text></g></svg>so on.</p><object>{b}</object><noscript>{c}</noscript></article>"
    assert html_paths.main_text(page).split("\n") == [a, "Given x=2 and so on.", b, c]
    page = f"<article><p>{a}</p><div><svg><path></div><p>{b}</p><svg><g/></svg></article><p>{c}</p>"  # closed by its parent
    assert html_paths.main_text(page).split("\n") == [a, b, c]


def test_toxicity_learns_and_never_from_held_out_rows(spark):
    clean, words = "the boat went over the quiet lake and came home", "idiot scum"
    rows = [(i, f"{clean} {i % 7} " * (1 + i % 3) + (words if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(*r[:2], "en", 0.1) for r in rows] + [(None, None, None, None), (9000, "", "", 0.0), (9001, "sea " * 50_000 + words, "en", 0.0), (9002, "!!", "", 0.0)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(9000, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity_cnn.toxicity(docs, labels).collect()}
    assert len(got) == 604 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got if i is not None)
    assert np.mean([got[i].predicted == y for i, _, y in rows if got[i].held_out]) > 0.98 and got[9001].predicted == 1
    flipped = labels.withColumn("toxic", F.when(toxicity_cnn.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in toxicity_cnn.toxicity(docs, flipped).collect()} == {i: r.score for i, r in got.items()}
    assert toxicity_cnn.toxicity(docs.limit(0), labels).count() == 0 and {r.score for r in toxicity_cnn.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    # rows that repeat a labelled document train once, and a long one is not left out
    again = docs.unionByName(docs.where("doc_id IN (0, 1, 2)")).unionByName(docs.where("doc_id = 3"))
    assert {r.doc_id: r.score for r in toxicity_cnn.toxicity(again, labels.unionByName(labels.limit(5))).collect()} == {i: r.score for i, r in got.items()}
    assert {r.score for r in toxicity_cnn.toxicity(docs, labels, max_chars=10).collect()} == {0.0}
    stay = toxicity_cnn.without_toxic(docs, labels)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == {i for i, r in got.items() if not r.predicted}


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op2_toxicity_cnn(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("toxic IS NOT NULL")
    rows = [(r.toxic, r.predicted) for r in scored.collect()]
    assert np.mean([p for y, p in rows if y]) > 0.75 and np.mean([p for y, p in rows if not y]) < 0.01


def test_lines_equal_their_sql(spark):
    same(queries.op8_line_runs, queries.ORACLE_SQL["op8_line_runs"], spark, SF)


def test_lines_of_edge_cases(own, none, texts):
    want = kept_lines(texts)
    for batches, fanout in ((1, 3), (4, 2), (5, 3)):  # runs are compacted on the way
        rows = line_runs.dedup_lines(own, batches=batches, fanout=fanout).collect()
        assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in rows} == want
    stay = line_runs.without_repeated_lines(own)
    assert stay.columns == own.columns and {r.doc_id: r.text or "" for r in stay.collect()} == {i: x[2] for i, x in want.items()}
    assert line_runs.dedup_lines(none).count() == 0


def test_lines_of_different_texts_with_one_id(spark):
    docs = spark.createDataFrame([(1, "a" * 10), (5, "a" * 10), (5, "a line of its own"), (None, "b" * 10), (7, "b" * 10), (7, None)], "doc_id long, text string")
    want = [(None, "b" * 10), (1, "a" * 10), (5, ""), (5, "a line of its own"), (7, ""), (7, "")]
    assert sorted(((r.doc_id, r.kept) for r in line_runs.dedup_lines(docs).collect()), key=lambda r: (r[0] or 0, r[1])) == want
    rows = line_runs.without_repeated_lines(docs).collect()
    assert sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: (r[0] or 0, r[1])) == want


def test_near_classes_of_edge_cases(own, none, texts):
    twice = own.unionByName(own.where("doc_id = 1"))
    rows = dart_minhash.classes(twice.unionByName(own.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long")))).collect()
    assert len(rows) == len(texts) + 2
    assert {r.doc_id: r.class_id for r in rows} == near_classes(texts) | {None: None}
    assert dart_minhash.classes(none).count() == 0
    assert {r.doc_id for r in dart_minhash.one_of_each(own).collect()} == set(near_classes(texts).values())


def test_near_classes_of_all_documents(spark, all_texts):
    assert {r.doc_id: r.class_id for r in queries.op9_dart_minhash(spark, SF).collect()} == near_classes(all_texts)


def test_large_buckets(spark, monkeypatch):
    """Groups beyond one cell, with bounds lowered so that all ways are taken."""
    monkeypatch.setattr(dart_minhash, "CELL_ROWS", 8)
    monkeypatch.setattr(dart_minhash, "CELL_SHINGLES", 900)
    base = [f"w{k}" for k in range(120)]
    texts = {i: " ".join(base[:k] + [f"x{i}"] + base[k + 1 :]) for i, k in enumerate([j % 100 + 10 for j in range(60)])}
    texts |= {100 + i: " ".join(base[:90] + [f"y{i % 3}{j}" for j in range(40)]) for i in range(9)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in dart_minhash.classes(docs).collect()} == near_classes(texts)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(1, 2**63, 300).astype(np.uint64) for _ in range(2))
    mix = np.unique(np.concatenate([a[:240], b[:60]]))
    plain = dart_minhash.signatures([np.unique(a), mix], k=1024)
    assert abs((plain[0] == plain[1]).mean() - 240 / 360) < 0.06
    w = [np.full(300, 3.0), np.full(300, 1.0)]
    assert np.allclose(dart_minhash.saturated(np.array([1, 3, 10**6])), [1, 1.5, 2])
    weighted = dart_minhash.signatures([np.unique(a)] * 2, w, k=1024)
    assert abs((weighted[0] == weighted[1]).mean() - 1 / 3) < 0.06


def test_signatures_weigh_repeated_shingles():
    """The share of equal coordinates is the weighted similarity, not the plain one, of texts with repeated lines."""
    shingle, line = dart_minhash.Shingles(), " ".join(f"r{k}" for k in range(40)) + " "
    texts = [line * 30 + " ".join(f"a{k}" for k in range(60)), line + " ".join(f"a{k}" for k in range(60))]
    sets = [shingle(t) for t in texts]
    weight = [dict(zip(s.tolist(), (2 * c / (c + 1)).tolist(), strict=True)) for s, c in sets]
    every = weight[0].keys() | weight[1].keys()
    want = sum(min(w.get(x, 0) for w in weight) for x in every) / sum(max(w.get(x, 0) for w in weight) for x in every)
    plain = len(weight[0].keys() & weight[1].keys()) / len(every)
    sig = dart_minhash.signatures([s for s, _ in sets], [dart_minhash.saturated(c) for _, c in sets], k=1024)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.05 and plain - want > 0.15


def test_cells_give_one_row_a_member_and_lose_no_link(spark):
    """A family of 400 near copies and outsiders: links and families are no more than members, classes equal brute force."""
    rng, base = np.random.default_rng(3), [f"w{k}" for k in range(60)]
    texts = {}
    for i in range(400):
        words = list(base)
        for at in rng.choice(60, int(rng.integers(1, 4)), replace=False):
            words[at] = f"x{i}_{at}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in dart_minhash.classes(docs).collect()} == near_classes(texts)


def _exact(ids, v, queries_, k):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    out = {}
    for q in queries_:
        score = u @ u[ids.index(q)]
        order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-score[j], ids[j]))
        out[q] = [ids[j] for j in order[:k]]
    return out


def test_ends_of_tags_with_quotes():
    """Against a pattern that starts anew at each tag; and many tags whose quotes don't close take time in line with their number."""
    plain = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
    random.seed(3)
    for _ in range(3000):
        source = "".join(random.choices("<a>\"' ", [3, 3, 2, 2, 2, 1], k=random.randrange(1, 60)))
        scan = html_paths._Scanner(source)
        for at in range(len(source)):
            if source.find(">", at) >= 0:
                found = plain.match(source, at)
                assert scan._end(at) == (found.end() if found else source.index(">", at) + 1), (source, at)
    began = time.perf_counter()
    scan, n = html_paths._Scanner("<p>x</p>" + "<a b='\">" * 100_000 + "<a b=\"'>" * 100_001), 0
    while scan.at < len(scan.source):
        scan.step()
        n += 1
    assert n > 1 and time.perf_counter() - began < 20


def test_neighbours_recall(spark):
    for sf in (SF, "/root/testdata/sf0.1"):
        rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
        ids, v = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float)
        want = _exact(ids, v, [i for i in ids if i % 50 == 0], 5)
        got = queries.op10_hilbert_ann(spark, sf).collect()
        assert sum(r.vec_id in want[r.query_id] for r in got) >= 0.9 * sum(map(len, want.values()))
        assert len(got) == sum(map(len, want.values()))


def test_exact_neighbours_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(hilbert_ann, "CHUNK_ROWS", 300)
    monkeypatch.setattr(hilbert_ann, "CHUNK_QUERIES", 7)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, v = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float)
    got = hilbert_ann.nearest(df.unionByName(df.where("vec_id % 10 = 0")), F.col("vec_id") % 50 == 0, exact=True).orderBy("query_id", "rank").collect()
    want = _exact(ids, v, [i for i in ids if i % 50 == 0], 5)
    assert [(r.query_id, r.vec_id) for r in got] == [(q, i) for q in sorted(want) for i in want[q]]


def test_neighbours_of_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [0.0, 5.0]), (3, [-1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (50, [1e-300, 1e-300]), (100, [nan, 0.0]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, label int, score double")
    got = [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in hilbert_ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    h = round(0.5**0.5, 9)
    assert got == [(0, 1, 50, h), (0, 2, 1, 0.0), (0, 3, 2, 0.0), (0, 4, 3, -1.0), (50, 1, 0, h), (50, 2, 1, h), (50, 3, 2, h), (50, 4, 3, -h)]
    assert hilbert_ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_hilbert_steps_are_to_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert_ann.hilbert(cells, 3)
    walk = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_words_and_further_articles_only_weigh():
    a, b, c = LONG_TEXTS[:3]
    page = f"<body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{a}</p><p class='share-price'>{b}</p><div class='related-work'>{c}</div><div class='share-buttons'>Share this</div></article>"
    page += "<article class=card><p>Short teaser.</p></article><div class='comments'><p>Nice, thanks, really a very long comment, with marks.</p></div><footer>(c) us, all rights reserved.</footer></body>"
    assert html_paths.main_text(page).split("\n") == ["Title", a, b, c]
    assert html_paths.main_text("<body><nav>Home, sweet home.</nav><footer>(c) us, all rights reserved, in all countries.</footer></body>") == ""
    assert html_paths.main_text(f"<body><form id=aspnet><div><p>{a}</p><p>{b}</p></div></form></body>").split("\n") == [a, b]


def test_ratios_decide_on_whole_tables(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]
    texts = [html_paths.main_text(h) for h in pages]
    assert all(t == "\n".join(" ".join(line.split()) for line in t.split("\n")) and "\n\n" not in t for t in texts)
    monkeypatch.setattr(html_paths, "THRESHOLD", -1e9)
    monkeypatch.setattr(html_paths, "FLOOR", -1e9)
    assert sum(html_paths.main_text(h) != t for h, t in zip(pages, texts, strict=True)) > 0.9 * len(pages)


def test_broken_pages_take_linear_time():
    for unit in ("<p ", "<a href='", "<![CDATA[", "<div>", '<p class="', "<div><p>text. ", "<table><tr><td>x ", "<!--", "&", "<a x='>\""):
        began = time.perf_counter()
        html_paths.main_text(unit * (1_000_000 // len(unit)))
        assert time.perf_counter() - began < 5, unit


def test_documents_of_very_many_lines(spark):
    """Work grows with the lines: documents of 100,000 equal lines, of which every second one is new in the last."""
    n = 100_000
    old, mixed = [f"line number {k}" for k in range(n)], [f"line number {k}" if k % 2 else f"other line {k}" for k in range(n)]
    docs = spark.createDataFrame([(1, "\n".join(old)), (2, "\n".join(old) + "\nshort"), (3, "\n".join(mixed))], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_runs.dedup_lines(docs).collect()}
    assert got == {1: (n, 0, "\n".join(old)), 2: (n + 1, n, "short"), 3: (n, n // 2, "\n".join(mixed[::2]))}
    assert time.time() - began < 60


def test_one_long_text_leaves_room_for_others(spark):
    """A labelled text that does not fit into the training sample does not end it."""
    words = ["calm", "river", "stone", "light"]
    rows = [(k, " ".join([words[k % 4]] * 30 + ["vile"] * (k % 2) * 9)) for k in range(1, 200)] + [(0, "calm river " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity_cnn.toxicity(docs, labels, max_chars=60_000).collect()}
    assert len(set(scores.values())) > 2 and len(scores) == 200


def test_short_articles_keep_their_text():
    """No block of these stands out by its length: what the article holds stays, menus and footers still go."""
    assert html_paths.main_text("<article><p>w</p><p>No</p></article>") == "w\nNo"
    page = "<body><nav><a href=x>Home</a></nav><main><h1>Tea</h1><p>a</p><p>b c</p><ul><li>d</li></ul></main><footer>(c) x</footer></body>"
    assert html_paths.main_text(page) == "Tea\na\nb c\nd"


def test_training_holds_no_text_in_the_driver(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("the driver trains")

    monkeypatch.setattr(toxicity_cnn, "_embed", refused)  # in this process only; tasks import the module anew
    docs = spark.createDataFrame([(i, "bad words here" if i % 2 else "fine words there") for i in range(60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    model = toxicity_cnn.fit_on_labels(docs, labels)
    assert model.fitted and model.table.shape == (model.buckets, model.part)


def test_buckets_of_the_same_members_share_a_leader(spark):
    members = spark.range(40).selectExpr("id AS node", "id AS class", "explode(sequence(1, 30)) AS key")
    shape = dart_minhash._shape(members, "key", 0).collect()
    assert len(shape) == 30 and len({r.leader for r in shape}) == 1
    assert len({r.leader for r in dart_minhash._shape(members, "key", 1).collect()}) > 1
