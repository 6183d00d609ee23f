"""Main text of pages, and nearest neighbours."""

import html
import re

import compare
import numpy as np
from swathe.llm import neighbours, wrappers

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header class="site">Site</header>
<nav><ul><li><a href="/">Home {0}</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="c9x"><h1>Title {0}</h1><p>First <b>bo</b>ld&nbsp;{1} &amp; &#233;<br>line<p>Second {1}</p><div class="ad-box">Buy {0}</div>
<ul><li>one<li>two {1}</ul><script>var s = "<p>no</p>";</script><!-- <p>gone</p> --><form><input>Send</form>
<section id="comments"><p>Nice {0}</p></section></div><aside>Side {1}</aside><footer>&copy; {0}</footer></body></html>"""


NONE = {"path": [], "constant": []}


def test_constant_parts_inside_the_content_go():
    made = ("<body><nav>Home</nav><div class=story><h1>Head {0}</h1><p>{1}</p><p>Follow us on every channel</p>"
            "<div class=end><p>Printed by the same press</p></div><p>Last word {0}</p></div></body>")
    pages = [made.format(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(8)]
    wrapper = wrappers.induce(pages)
    got = wrappers.extract(pages[3], wrapper)
    assert got == "Head 3 " + " ".join(f"w3x{k}" for k in range(60)) + " Last word 3"
    assert "Follow us" in wrappers.extract(pages[3], NONE)
    assert "Follow us" in wrappers.extract(pages[3].replace("every channel", "no channel"), wrapper)
    # Copies of one page that differ in a word have no template to learn.
    copies = [made.format(1, " ".join(f"w{k}" for k in range(60)) + f" {i}") for i in range(8)]
    assert wrappers.induce(copies)["constant"] == []


def test_names_mark_only_as_whole_tokens():
    text = " ".join(f"word{k}" for k in range(40))
    for page in (
        f'<body class="post no-sidebar"><p>{text}</p></body>', f'<article class="entry has-comments"><h1>t</h1><p>{text}</p></article>',
        f'<main class="side-by-side"><p>{text}</p></main>', f'<body><form action=x><h1>t</h1><p>{text}</p></form></body>',
        f"<body><div><p>{text}</p><button>Send</div></body>", f'<body id="comments" role="search"><p>{text}</p></body>',
    ):
        for wrapper in (NONE, wrappers.induce([page.replace("word1 ", f"word{i}0 ") for i in range(8)])):
            assert text in wrappers.extract(page, wrapper), page
    for name in ("ad-box", "cookie-notice", "comments", "site-footer", "related-posts", "sidebar"):
        assert wrappers.extract(f"<body><p>{text}</p><div class='{name}'>gone</div></body>", NONE) == text
    assert wrappers.extract(f"<body><nav>{text}</nav><p>short</p></body>", NONE) == "short"


def test_layouts_have_wrappers_of_their_own(spark):
    a = "<body><div class=shop><h2>Item {0}</h2><p>price {0}</p><p>Ships within a day</p><p>{1}</p></div></body>"
    b = "<body><main><h1>News {0}</h1><p>{1}</p><p>Ships within a day</p></main></body>"
    rows = []
    for i in range(12):
        text = " ".join(f"t{i}x{k}" for k in range(50))
        rows += [(i, "http://h.example/a", a.format(i, text)), (100 + i, "http://h.example/b", b.format(i, text + f" n{i}"))] * 2
    rows += [(300, "http://h.example/c", None)] * 20
    out = {r["page_id"]: r["text"] for r in wrappers.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert out[3].startswith("Item 3 price 3 t3x0") and out[103].startswith("News 3 t3x0")
    assert "Ships" not in out[3] and "Ships" not in out[103] and out[300] == ""
    assert wrappers.layout(rows[0][2]) != wrappers.layout(rows[1][2])


def test_all_pages_of_a_layout_decide(spark):
    """What few of many pages show counts: a second slot, and a block that reads otherwise there."""
    made = "<body><div class=story><p>{0}</p>{1}</div><div class=more><p>{2}</p></div></body>"
    rows = []
    for i in range(240):
        text = " ".join(f"t{i}x{k}" for k in range(50))
        rows.append((i, "http://h.example/a", made.format(text, "<p>Printed in Bonn</p>", "")))
        last = ("<p>Printed in Rome</p>", f"{i} more") if i == 7 else ("<p>Printed in Bonn</p>", "")
        rows.append((1000 + i, "http://g.example/a", made.format(text, *last)))
    df = spark.createDataFrame(rows * 2, "page_id bigint, url string, html string").repartition(5)
    out = {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()}
    assert len(out) == 480 and out[7].endswith("t7x49") and out[100].endswith("t100x49")
    assert out[1007].endswith("t7x49 Printed in Rome 7 more")
    assert out[1100].endswith("t100x49 Printed in Bonn")


def test_parts_of_a_layout_give_the_wrapper_of_all():
    made = "<body><div class=story><h1>Head {0}</h1><p>{1}</p><p>Follow us</p>{2}</div><p>{3}</p></body>"
    pages = [made.format(i, " ".join(f"w{i}x{k}" for k in range(60)), "<i>x</i>" * (i % 3), "y" * (i == 11)) for i in range(12)]
    model, state = wrappers.drafted(pages[:6])
    states = []
    for part in (pages[:5], pages[5:9], pages[9:]):
        draft = wrappers.Draft(model, state)
        for page in part:
            draft.weigh(draft.align(wrappers.parse(page)))
        states.append(draft.state())
    assert wrappers.completed(model, states)["path"] == wrappers.induce(pages)["path"]
    assert wrappers.completed(model, states[:2]) == wrappers.induce(pages[:9])
    assert [c[1] for c in wrappers.completed(model, states[:2])["constant"]] == ["Follow us"]


def test_wrapper_finds_the_varying_part():
    pages = [PAGE.format(i, "text " * (i + 3)) for i in range(4)]
    path = wrappers.induce(pages)
    assert [level["labels"][level["at"]] for level in path["path"]] == ["html", "body", "div c x"]
    want = "Title 2 First bold text text text text text & é line Second text text text text text one two text text text text text"
    assert wrappers.extract(pages[2], path) == want
    assert wrappers.extract(pages[2], NONE) == want  # by marks alone
    assert wrappers.extract("<div>other <p>layout</div>", path) == "other layout"


def test_headline_and_lead_beside_the_body_stay():
    for tag in ("div", "section", "ul"):
        made = "<body><div><b>Top of site</b></div><article><h1>Head {0}</h1><p>Lead {0}</p><" + tag + "><p>{1}</p></" + tag + "></article></body>"
        pages = [made.format(i, f"body{i} " * (4000 if i == 2 else 60)) for i in range(4)]
        path = wrappers.induce(pages)
        assert [level["labels"][level["at"]] for level in path["path"]] == ["body", "article"]
        assert wrappers.extract(pages[1], path) == " ".join(["Head 1 Lead 1"] + ["body1"] * 60)


def test_odd_pages():
    assert wrappers.induce([]) == NONE and wrappers.induce([""]) == NONE
    assert wrappers.extract("", NONE) == "" and wrappers.extract("<script>x", NONE) == ""
    assert wrappers.extract("a < b & c &lt;p&gt;", NONE) == "a < b & c <p>"
    assert wrappers.extract("<p>a</b></div>b<p>c", NONE) == "ab c"
    assert wrappers.extract("<div>" * 3000 + "deep" + "</div>" * 3000, wrappers.induce(["<div>" * 3000 + "x"])) == "deep"
    assert wrappers.extract("<p title='a>b'>x<p hidden>y<p style='display: none'>z", NONE) == "x"


def test_matching_keeps_order_and_labels():
    a, b = wrappers.parse("<ul><li>1<li>2<li class=x>3</ul>"), wrappers.parse("<ul><li>1<li class=x>3<li>4</ul>")
    pairs = wrappers.matching(a, b)
    assert len(pairs) == 4 and all(x.label == y.label for x, y in pairs)


def test_long_lists_are_aligned_by_runs():
    pages = [f"<body><nav><a>{i}</a></nav><div>" + "".join(f"<p>{i} {k}</p>" for k in range(2000 + i)) + "<hr><ul><li>x</ul></div></body>" for i in range(3)]
    path = wrappers.induce(pages)
    assert [level["labels"][level["at"]] for level in path["path"]] == ["body", "div"]
    assert wrappers.extract(pages[1], path).startswith("1 0 1 1 1 2 ") and wrappers.extract(pages[1], path).endswith("1 2000 x")


def test_pages_rows(spark):
    rows = [(i, "http://A.example:80/x", PAGE.format(i, f"word{i} " * 5), "t") for i in range(12)]
    rows += [(0, "http://a.example/x", PAGE.format(0, "word0 " * 5), "t"), (50, None, None, "t"), (51, "", "", "t"), (52, None, "<p>lone</p>", "t"), (None, "x", "<p>no id", "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, TEXT string")
    out = wrappers.main_text(df).collect()
    assert len(out) == len(rows) and list(out[0].asDict()) == ["page_id", "url", "text"]
    texts = {r["page_id"]: r["text"] for r in out}
    assert texts[3].startswith("Title 3 First bold word3") and "Nice" not in texts[3] and "Side" not in texts[3]
    assert (texts[50], texts[51], texts[52], texts[None]) == ("", "", "lone", "no id")
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_pages_query(spark, sf):
    out = {r["page_id"]: r for r in compare.load_entry().queries()["op4_wrappers"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(out) == len(pages)
    for p in pages:
        article = re.sub(r"</?(p|br|h1)\b[^>]*>", " ", re.search("<article>(.*)</article>", p["html"], re.S)[1])
        want = " ".join(html.unescape(re.sub("<[^>]*>", "", article)).split())
        assert (out[p["page_id"]]["text"], out[p["page_id"]]["n_chars"]) == (want, len(want))


def brute(ids, vectors, k=5):
    lengths = np.sqrt((vectors * vectors).sum(1))
    best = {}
    for q in np.flatnonzero(np.array(ids) % 50 == 0):
        score = (vectors * vectors[q]).sum(1) / (lengths * lengths[q])
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        best[ids[q]] = [(ids[i], score[i]) for i in order]
    return best


def test_neighbours_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    best = brute([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], np.float64))
    got = {}
    for r in compare.load_entry().queries()["op5_neighbours"](spark, sf).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == best.keys()
    hits = 0
    for q, want in best.items():
        found = sorted(got[q])
        assert [x[0] for x in found] == [1, 2, 3, 4, 5] and [-x[2] for x in found] == sorted(-x[2] for x in found)
        hits += len({v for v, _ in want} & {v for _, v, _ in found})
    assert hits >= 0.9 * 5 * len(best)


def test_neighbours_edges(spark, monkeypatch):
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(120, 4)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(200 + i, vectors[0]) for i in range(60)] + [(0, vectors[0])]  # a group of copies, and a repeated row
    bad = [(300, None), (350, [0.0] * 4), (400, [1.0, None, 1.0, 1.0]), (450, [1.0, float("nan"), 0.0, 0.0]), (500, [1.0, 2.0]), (None, vectors[3]), (550, [float("inf")] * 4), (600, [])]
    schema = "vec_id bigint, embedding array<float>, score double, Rank int"
    df = spark.createDataFrame([(*r, 0.0, 0) for r in rows + bad], schema)
    want = brute([r[0] for r in rows[:-1]], np.array([r[1] for r in rows[:-1]], np.float64))
    for block in (4096, 16):
        monkeypatch.setattr(neighbours, "BLOCK", block)
        got = {}
        for r in neighbours.nearest(df, "vec_id % 50 = 0").orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert got.keys() == want.keys()
        assert [v for v, _ in got[0]] == [200, 201, 202, 203, 204] and [v for v, _ in got[200]] == [0, 201, 202, 203, 204]
        hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
        assert hits >= 0.9 * sum(map(len, want.values()))
    few = spark.createDataFrame([(0, [1.0, 0.0], 0.0, 0), (1, [0.0, 1.0], 0.0, 0), (2, [-1.0, 0.0], 0.0, 0)], schema)
    assert [(r["vec_id"], r["score"]) for r in neighbours.nearest(few, "vec_id % 50 = 0").orderBy("rank").collect()] == [(1, 0.0), (2, -1.0)]
    assert neighbours.nearest(few.where("vec_id = 0"), "vec_id % 50 = 0").count() == 0
    assert neighbours.nearest(df.limit(0), "vec_id % 50 = 0").count() == 0
