from html.parser import HTMLParser

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import html_blstm as H
from tallyfold.llm.page_plans import labelled_pages


@pytest.fixture(scope="module")
def weights():
    return H.train()


def texts(page):
    return [b.text for b in H.read_blocks(page)]


def test_blocks():
    page = "<html><head><title>t</title><style>p{}</style></head><body><nav><a href='/x>y'>One</a></nav><p><b>Two &amp;  three<br>four<p>five<script>var a='</p>';</script> six<!-- no --><table><tr><td>a<td>b</table><select><option>no</select>&lt;b&gt;<div></div>1 < 2 <"
    assert texts(page) == ["One", "Two & three four", "five six", "a", "b", "no", "<b>", "1 < 2 <"]
    assert H.read_blocks(page)[0].linked == 3 and H.read_blocks(page)[0].path[-1] == "<nav>"
    assert texts("") == [] and texts("no tags") == ["no tags"] and texts("<p") == ["<p"] and texts("</div></p>x</article>y") == ["x", "y"]
    assert texts("<article><p>a</article>b") == ["a", "b"] and texts("<script>never closed <p>x") == []
    assert texts("<svg><p>x</p></svg><p>y") == ["x", "y"]


def test_what_is_read_and_what_is_not():
    assert texts("<p>We have <math><mi>x</mi><annotation>\\x</annotation></math> here</p>") == ["We have x here"]
    assert texts("<html><head><title>t</title><p>Body text") == ["Body text"]  # valid: neither end of head nor body
    assert texts("<head><meta charset=x>words<p>more") == ["words", "more"]
    for name in ("video", "audio", "canvas", "object", "button"):
        got = H.read_blocks(f"<p>a <{name} x=y>fallback</{name}> b</p><p>c")
        assert [b.text for b in got] == ["fallback", "a b", "c"] and got[0].path[-1] == f"<{name}>"
        assert texts(f"<div><p>a<{name}>never closed<p>b</div>c") == ["never closed", "a", "b", "c"]
    assert texts("<p>a<select><option>1<option>2<p>b") == ["1 2", "a", "b"]
    assert texts("<template><p>no</template><p>yes<iframe><p>no</iframe><textarea>no</textarea>") == ["yes"]
    assert texts("<figure><img><figcaption>cap</figcaption></figure>") == ["cap"]


class Plain(HTMLParser):
    """Another parser: the blocks of an <article> of headings, paragraphs and line breaks."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks, self.words = False, [], ""

    def cut(self, inside):
        text, self.words = " ".join(self.words.split()), ""
        if text and self.inside:
            self.blocks.append(text)
        self.inside = inside

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article"):
            self.cut(self.inside or tag == "article")
        elif tag == "br":
            self.words += " "

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.cut(self.inside and tag != "article")

    def handle_data(self, data):
        self.words += data


def articles(page):
    parser = Plain()
    parser.feed(page)
    parser.close()
    return "\n\n".join(parser.blocks)


def test_gradient():
    rng = np.random.default_rng(0)
    pages = [(rng.normal(size=(n, H.DIM)).astype(np.float32), rng.integers(0, 2, n).astype(np.float32)) for n in (3, 5)]
    x, mask = H._pad([p for p, _ in pages])
    w, u = (rng.normal(size=s).astype(np.float32) * 0.1 for s in ((H.DIM, 4 * H.HIDDEN), (H.HIDDEN, 4 * H.HIDDEN)))
    g = rng.normal(size=(5, 2, H.HIDDEN)).astype(np.float32) * mask[..., None]
    _, saved = H._lstm(x, mask, w, u, True)
    dw, du = H._lstm_back(g, x, u, saved)
    for a, d in ((w, dw), (u, du)):
        for i, j in rng.integers(0, a.shape, (6, 2)):
            old, e = a[i, j], 1e-2
            a[i, j] = old + e
            hi = (H._lstm(x, mask, w, u)[0] * g).sum()
            a[i, j] = old - e
            lo = (H._lstm(x, mask, w, u)[0] * g).sum()
            a[i, j] = old
            assert abs((hi - lo) / (2 * e) - d[i, j]) < 0.02 * max(1, abs(d[i, j]))


def scores(weights, keep, n=300):
    same = pages = hit = got_ = wanted = 0
    for blocks, labels in labelled_pages(n, 4711):
        if blocks and keep(blocks):
            got, want = H.predict(weights, [H.vectors(blocks)])[0] >= H.THRESHOLD, np.array(labels, bool)
            pages, same = pages + 1, same + bool((got == want).all())
            hit, got_, wanted = hit + int((got & want).sum()), got_ + int(got.sum()), wanted + int(want.sum())
    return same / pages, hit / got_, hit / wanted


def test_held_out_pages(weights):
    """Pages all right, precision and recall of blocks, on fresh pages; many of these name no part of the page."""
    whole, precision, recall = scores(weights, lambda blocks: True)
    assert whole > 0.84 and precision > 0.98 and recall > 0.99
    whole, precision, recall = scores(weights, lambda blocks: not any("<article>" in b.path for b in blocks))
    assert whole > 0.8 and precision > 0.98 and recall > 0.985


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_pages_of_the_tables(weights, size):
    """Against what stands in <article>, which every page of these tables has, read by another parser."""
    pages = pq.read_table(f"/root/testdata/sf{size}/pages.parquet").column("html").to_pylist()
    got = H.extract_texts(weights, pages)
    assert sum(g == articles(p) for g, p in zip(got, pages, strict=True)) / len(pages) >= 0.99


def test_hand_written_pages(weights):
    """Pages without an article tag, or with what used to get lost."""
    nav, foot = "<div><a href=/>Home</a> <a href=/n>News</a></div>", "<div>&copy; 2020 Harbour News. All rights reserved.</div>"
    told = ["The old harbour", "The harbour was built long ago by the people of the town. It is still in use.", "Every morning the boats come in with their catch, and the market opens."]
    body = f"<h1>{told[0]}</h1><p>{told[1]}</p><p>{told[2]}</p>"
    caption = "A view of the old harbour in the evening."
    pages = {
        f"<body>{nav}<div>{body}</div>{foot}": told,
        f"<body>{nav}<div class=wrap><div class=inner>{body}</div></div>{foot}": told,
        f"<body><div>Town News</div>{nav}<div>{body}<div><h3>Related</h3><ul><li><a href=/x>Another harbour</a></ul></div></div>{foot}": told,
        f"<body><nav>{nav}</nav><main>{body}</main><footer>{foot}</footer>": told,
        f"<body><nav>{nav}</nav><article>{body}<figure><img><figcaption>{caption}</figcaption></figure></article><footer>{foot}</footer>": [*told, caption],
        f"<body><nav>{nav}</nav><article>{body}<video src=x>Your browser does not support video<p>{told[1]}</p></article><footer>{foot}</footer>": [*told, told[1]],
        f"<body><nav>{nav}</nav><article>{body}<p>We have <math><mi>x</mi></math> here and go on with it.</p></article>": [*told, "We have x here and go on with it."],
        f"<html><head><title>t</title>{nav}<div>{body}</div>{foot}": told,
        f"<body><article>{body}</article><section class=comments>{'<div>' * 20}<p>Some words of a sentence that goes on for a while, and then it ends.</p>{'</div>' * 20}</section>": told,
    }
    for page, want in pages.items():
        assert H.extract_texts(weights, [page]) == ["\n\n".join(want)], page


def test_rows(spark, weights):
    rows = [(1, None, "u"), (1, None, "u"), (None, "", "v"), (3, "<body><article><h1>Title here</h1><p>Some words of the article, and some more words.</p></article><footer>&copy; All rights reserved</footer>", "w"), (4, "<article>" + "<p>many words in a row here. " * 3000, "x")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string").withColumns({c: F.lit(c) for c in ("row", "path", "blocks", "n_chars")})
    got = H.extract_main_text(df, weights=weights).collect()
    by = {r.row.page_id: r for r in got}
    assert len(got) == 5 and by[1].text == "" and by[None].text == "" and by[3].row.text == "w"
    assert by[3].text == "Title here\n\nSome words of the article, and some more words."
    assert len(by[4].text) > 70_000
    assert H.extract_main_text(spark.createDataFrame([], "page_id long, html string"), weights=weights).count() == 0


def vector(page):
    return H.vectors(H.read_blocks(page))[0]


def test_whole_paths_and_blocks_count():
    deep = "<div>" * 40
    assert (vector(f"<article>{deep}x") != vector(f"<nav>{deep}x")).any()
    assert (vector(f'<div class="{"plain " * 20}comments">x') != vector(f'<div class="{"plain " * 20}">x')).any()
    many = ["word"] * 200
    assert (vector(" ".join(many)) != vector(" ".join([*many[:99], "other", *many[100:]]))).any()
    assert vector("a" * 300 + "1" * 100)[H.PATH_DIM + H.WORD_DIM + 4] == 0.25
    assert len(H.read_blocks("<div>a" * 20_000)) == len(H.vectors(H.read_blocks("<div>a" * 20_000)))


def test_deep_and_long_pages(weights):
    line, good = "Some words of a sentence that goes on for a while, and then it ends. ", []
    for depth in (0, 20, 30):
        wrap = lambda x, d=depth: "<div>" * d + x + "</div>" * d
        article = ["The title", *[(line * n).strip() for n in (1, 3, 40, 2)]]
        page = f"<body><nav>{wrap('<ul><li><a href=/>Home</a><li><a href=/n>News</a></ul>')}</nav><article>{wrap('<h1>' + article[0] + '</h1>' + ''.join(f'<p>{p}</p>' for p in article[1:]))}</article><section class=comments>{wrap(f'<p>{line}</p><p>{line * 20}</p>')}</section><footer>{wrap('&copy; 2020 Us')}</footer>"
        got = H.extract_texts(weights, [page])[0].split("\n\n")
        good.append(got == article)
    assert good == [True] * 3
