import numpy as np

from pricepanel.llm import htmltext as H


def page(i, wrap="article"):
    words = f"word{i} goes on and on, as words will do; line {i}."
    return (f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<nav><ul><li><a href='/'>Home {i}</a></li><li><a href='/x'>Other</a></li></ul></nav><div class='ad'>Buy {i}!</div>"
            f"<{wrap}><h1>Title &amp; {i}</h1><p>{words}<br>more&nbsp;here<p>Second   {words}</{wrap.split()[0]}>"
            f"<footer>(c) {i}</footer></body></html>")


def want(i):
    words = f"word{i} goes on and on, as words will do; line {i}."
    return f"Title & {i}\n{words} more here\nSecond {words}"


def test_blocks_of_odd_markup():
    got = H.leaf_blocks("a<b>c</b> d<!-- x <p>no</p> --><p>e &lt;f&gt;<script>no</script>g<p>h</div><li>i<li>j<a href='x>y'>k</a> 3 < 4<br>l")
    assert [b[0] for b in got] == ["ac d", "e <f>g", "h", "i", "jk 3 < 4 l"]
    assert H.leaf_blocks(None) == H.leaf_blocks("") == [] and H.leaf_blocks("<p>open")[0][0] == "open"
    assert H.leaf_blocks("<script>never closed <p>x")[:1] == []


def test_lockstep_equals_one_page_at_a_time():
    w, pages = H.new_weights(1), [H.leaf_blocks(page(i)) * (i + 1) for i in range(5)] + [[]]
    data = H.Page(pages)
    whole = H.forward(w, data.inputs(w), data.sizes)
    alone = [H.forward(w, (d := H.Page([p])).inputs(w), d.sizes) for p in pages if p]
    assert np.allclose(whole, np.concatenate(alone), atol=1e-5)


def test_gradients(monkeypatch):
    monkeypatch.setattr(H.np, "float32", np.float64)
    r = np.random.default_rng(0)
    data, w = H.Page([H.leaf_blocks(page(i)) * (i + 1) for i in range(3)]), H.new_weights(1)
    x = data.inputs(w)
    d = r.standard_normal(len(x))
    _, cache = H.forward(w, x, data.sizes, keep=True)
    g, _ = H.backward(w, x, data.sizes, cache, d)
    for name in ("hf", "hb", "xf", "xb", "bf", "bb", "out", "bias"):
        at = tuple(r.integers(0, n) for n in w[name].shape)
        old, values = w[name][at], []
        for e in (1e-5, -1e-5):
            w[name][at] = old + e
            values.append((H.forward(w, x, data.sizes) * d).sum())
        w[name][at] = old
        assert abs((values[0] - values[1]) / 2e-5 - g[name][at]) < 1e-5, name


def test_extracts_known_and_varied_layouts(spark):
    rows = [(i, f"u{i}", page(i), 1) for i in range(60)]
    odd = [(100, None, None, 1), (101, "u", "", 1), (102, "u", "<nav><a>x</a></nav>", 1), (None, "u", page(7), 1), (5, "u", page(5), 1)]
    pages = spark.createDataFrame(rows + odd, "page_id long, url string, html string, n_chars int")
    w = H.fit(pages, max_pages=50)
    got = H.extract_text(pages, w)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in got.collect()}
    assert all(out[i, f"u{i}"] == (want(i), len(want(i))) for i in range(60))
    assert out[100, None] == out[101, "u"] == ("", 0) and out[102, "u"][0] == "" and out[None, "u"][0] == want(7)
    assert H.main_texts(w, [page(3, "main"), page(4, "div class='post'")]) == [want(3), want(4)]
    assert H.extract_text(pages.filter("false"), w).count() == 0
    assert H.main_texts(H.train(["<p>a</p>"]), ["<p>b</p>"]) == ["b"]


def test_query_against_the_pages_own_articles(spark, sf_small):
    from pricepanel.llm.queries import op8_html_text
    got = {r["page_id"]: r["text"] for r in op8_html_text(spark, sf_small).collect()}
    pages = spark.read.parquet(f"{sf_small}/pages.parquet").collect()
    same = [got[p["page_id"]] == "\n".join(b[0] for b in H.leaf_blocks(p["html"]) if "article" in b[1]) for p in pages]
    assert np.mean(same) > 0.98


def test_elements_that_are_not_raw_keep_the_rest_of_the_page():
    texts = lambda html: [b[0] for b in H.leaf_blocks(html)]
    for tag in ("<svg-icon name=x></svg-icon>", "<style-guide>", "<object-card></object-card>", "<svg viewBox='0 0 1 1'/>", "<math/>",
                "<object data=x>", "<canvas id=c>", "<svg>", "<noscript>", "<object data=x>", "<TITLE-BAR>"):
        assert texts(f"<nav>menu{tag}</nav><article><p>one<p>two</article>") == ["menu", "one", "two"], tag
    assert texts("<object data=x><p>kept<object data=y>no</object><p>too") == ["kept", "too"]
    assert texts("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be") == ["let x=2 be"]
    assert texts("<p>an <svg class=i><title>no</title><path d=''/></svg>icon<svg/> inline") == ["an icon inline"]
    for tag in ("script", "style", "textarea", "title", "iframe", "template", "svg", "object", "canvas", "noscript"):
        assert texts(f"<p>a</p><{tag} x=y>no <b>no</b></{tag} ><p>b") == ["a", "b"], tag
    for tag in ("script", "style", "textarea", "title", "iframe", "template"):
        assert texts(f"<p>a</p><{tag}>never closed <p>b") == ["a"], tag
