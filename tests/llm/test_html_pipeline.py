import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_bpe_packing_simhash import slow_components, slow_fingerprint
from tidewatt.llm import html, language, quality
from tidewatt.llm.queries import TOKENIZER


def text_of(markup):
    return html.Page(markup).text()


@pytest.mark.parametrize(
    "markup, text",
    [
        ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b <b>c<br>d</p>e", "a b c d e"), ("<ul><li>a<li>b</ul>c", "a b c"),
        ("<head><title>t</title><body>x", "x"), ("<script>var t='</p>';</script>a<style>p{}</style>", "a"), ("<nav>m</nav><main>a<aside>s</aside>b</main><footer>f</footer>", "a b"),
        ("<div class='cookie-notice'>c</div><div>a</div>", "a"), ("<body class='with-sidebar'><article>a<div id='comments'>r<article>r</article></div></article>", "a"),
        ("<div class='has-sidebar'><article>a</article><div class='sidebar'>s</div></div>", "a"), ("a<span class='ad'>x</span>b&nbsp;&#233;\n\t c", "ab é c"), ("<article>a<form>f<input>g</form>b", "a b"), ("</p></div>x</b>", "x"), ("<p>a <i>b</i>c", "a bc"),
    ],
)
def test_blocks(markup, text):
    assert text_of(markup) == text


LONG = "iVBORw0KGgo+/AbC" * 640


@pytest.mark.parametrize(
    "markup, text",
    [
        (f'<p>a</p><img src="data:image/png;base64,{LONG}"><p>b</p><img src="x"><p>c</p>', "a b c"), (f"<p>a</p><img src='{LONG}' alt='x'><p>b</p><p title='t'>c</p>", "a b c"),
        (f"<p>a</p><div data-x='{'{"k": "<b>v</b>"}' * 320}'>b</div><p class='t'>c</p>", "a b c"), (f'<p>a</p><div data-x="{"k > v, " * 720}"><p>b</p></div><p class="t">c</p>', "a b c"),
        (f"<p>a</p><p title='it's'>b</p>{'<p>c</p>' * 999}<p title='t'>d</p>", "a b " + "c " * 999 + "d"), ('<p>a</p><p title="5" tall">b</p><p title="t">c</p>', "a b c"),
        ("<p>a</p><p title=\"x>b</p>" + "<p>c</p>" * 999, "a b" + " c" * 999), ('<p>a</p><p title="x>b</p>' + "<p>c</p>" * 999 + '<p>d "', "a b" + " c" * 999 + ' d "'),
        ("<p>a</p><div data-x='<p class=\"ad\">' title='class=\"ad\"' data-role=\"search\">b</div>", "a b"), ("a <p class=b c <i", "a"), ("<p>a</p><p title", "a"), ("a<p x = \"y>\" / z= >b</p / >c", "a b c"),
    ],
)
def test_attributes_of_any_length(markup, text):
    assert text_of(markup) == text


@pytest.mark.parametrize("part", ["<a b=\">\" ", "<a b='\"' ", "<a b=\"", "<a b='x>", "<", "<!", "</", "<a ", "<a = "])
def test_unfinished_tags_take_linear_time(part):
    import time

    start = time.process_time()
    text_of(part * 200_000 + '"')
    assert time.process_time() - start < 10


@pytest.mark.parametrize(
    "markup, text",
    [
        ("<article><h2 id='related-work'>a</h2><section id='legal-history'>b</section><h2 id='search-and-replace'>c</h2><h3 id='comments'>d</h3></article>", "a b c d"),
        ("<div class='widget-content'>a</div><div class='content with-sidebar'>b <span class='share-price'>c</span></div>", "a b c"), ("<body class='comments-open'><article class='no-comments'>a</article>", "a"),
        ("<div class='x sidebar'>s</div><div id='site-search'>a</div><div id='search'>s</div><div role='navigation x'>s</div><p class='Cookie_Notice'>s</p>b", "a b"), ("<article class='comment'>r</article><article>a</article>", "a"),
        ("<div class='legal'>Legal history</div><section class='social'><p>b</p></section><div class='related'>c</div>", "Legal history b c"),
    ],
)
def test_only_whole_names_decide(markup, text):
    assert text_of(markup) == text


PAGES = "page_id long, url string, html string"


def extracted(spark, rows, names=html.NO_ARTICLE_WORDS):
    return {r["page_id"]: r for r in html.extract(spark.createDataFrame(rows, PAGES), names).collect()}


def article(i, n=None):
    return "".join(f"<p>own{i} text{i * 7 + k} the and of para{i}x{k}</p>" for k in range(n or 1 + i % 6))


def test_hints_lower_importance(spark):
    """Of two branches whose words each stand on some pages, the one that is hinted at goes."""
    rows = [(i, f"http://h.com/{i}", f"<article>{article(i)}<div class='post-related'>qa{i // 8} b{i // 8}</div><div class='post-x'>c{i // 8} d{i // 8}</div></article>") for i in range(48)]
    got = extracted(spark, rows)
    assert all(f"c{i // 8} d{i // 8}" in got[i]["text"] and f"qa{i // 8}" not in got[i]["text"] and f"para{i}x0" in got[i]["text"] for i in range(48))


def test_the_tree_judges_names(spark):
    """A named branch with most of its host's text stays; a small one goes, and so does what has no name but recurs or is small and apart."""
    rows = [(i, f"http://h.com/{i}", f"<body><div class='login'>word{i} sign{i}</div><div class='x'>fresh{i}</div><div class='notice'>{article(i, 12 + i % 6)}<div class='z'>always here</div></div>") for i in range(40)]
    rows += [(100 + i, f"http://few.com/{i}", f"<div class='notice'>n{i}</div><div class='x'>fresh{i}</div>") for i in range(3)]
    got = extracted(spark, rows)
    for i in range(40):
        assert got[i]["text"] == " ".join(f"own{i} text{i * 7 + k} the and of para{i}x{k}" for k in range(12 + i % 6))
    assert all(got[100 + i]["text"] == f"fresh{i}" for i in range(3))


def slow_tree(rows):
    """importance() in plain Python, from (host, markup) of distinct pages."""
    import math
    from collections import Counter, defaultdict

    words, seen, shapes, whole, sizes, linked = defaultdict(Counter), Counter(), defaultdict(Counter), defaultdict(Counter), Counter(), Counter()
    for host, markup in rows:
        page = html.Page(markup, host, kept=None)
        here, texts = defaultdict(set), defaultdict(str)
        for (path, text), links in zip(page.blocks, page.linked):
            here[path] |= set(text.split())
            sizes[path] += len(text.split())
            linked[path] += links
            for k in range(16, len(path) + 1, 8):
                texts[path[:k]] += text
        for path, link in page.links:
            if path in here:
                here[path].add("link " + link)
        for path, own in here.items():
            seen[path] += 1
            words[path].update(own)
        for path, text in texts.items():
            whole[path][text] += 1
        for path, names in page.children.items():
            shapes[path][" ".join(names)] += 1
    entropy = lambda c, m: math.log(c) / math.log(m) if m > 1 else 0.0
    tree = {}
    for path in {p[:k] for p in words for k in range(8, len(p) + 1, 8)}:
        leaves = [p for p in words if p.startswith(path)]
        known = [1 - entropy(c, seen[p]) for p in leaves for c in words[p].values()]
        pages, n, said = max(seen[p] for p in leaves), sum(shapes[path].values()), sum(whole[path].values())
        size = sum(sizes[p] for p in leaves)
        tree[path] = {
            "pages": pages, "content": sum(known) / len(known), "information": sum(c * (1 - entropy(c, seen[p])) for p in leaves for c in words[p].values()), "size": size / pages,
            "linked": sum(linked[p] for p in leaves) / max(1, size), "variety": math.exp(-sum(c / n * math.log(c / n) for c in shapes[path].values())) if n else 0,
            "whole": sum(c / said * (1 - entropy(c, said)) for c in whole[path].values()) if said else 1.0,
        }
    containers, headed, pool = set(), set(), defaultdict(lambda: [0, 0, 0])
    for path, v in tree.items():
        v["mass"] = v["information"] / max(tree[path[:8]]["information"], 1e-9)
        own = pool[path[8:]]
        own[0] += v["pages"]
        own[1] += v["pages"] * v["mass"]
        own[2] += v["pages"] * v["size"]
    for site in {p[:8] for p in tree}:
        varied = [p for p, v in tree.items() if p[:8] == site and v["mass"] >= html.MOST and v["variety"] >= html.VARIED]
        containers |= {min(varied, key=len)} if varied else set()
    for path, v in tree.items():
        if path[-8:-7] == html.ARTICLE:
            containers.add(path)
        if path[-8:-7] == html.FIRST and v["content"] >= 0.5 and len(path) > 16:
            containers.add(path[:-8])
            headed.add(path[:-8])
    out = {}
    for path, v in tree.items():
        kind, (n, mass, size) = path[-8:-7], pool[path[8:]]
        drawn = lambda own, all_: (v["pages"] * own + html.DRAWN * all_ / n) / (v["pages"] + html.DRAWN)  # noqa: E731, B023
        room = min(1, max(drawn(v["mass"], mass) / html.SHARE, drawn(v["size"], size) / html.LONG)) ** (1 - 1 / n)
        text = kind in (html.HEADING, html.FIRST, html.PART)
        if any(path.startswith(c) for c in containers):
            own = v["content"] if v["linked"] >= html.LIST else 1 if text else max(v["content"], v["whole"])
        else:
            own = v["content"] * (1 if kind in (html.HEADING, html.FIRST) else room)
        if any(c.startswith(path) for c in containers):
            own = max(own, 1)
        stays = v["mass"] > html.MOST and (drawn(v["mass"], mass) > html.MOST or v["size"] >= html.LONG) or path in headed and v["size"] >= html.LONG
        share = html.HINTED if kind == html.HINT else html.NAMED_AS if kind == html.NAMED and not stays else 1
        out[path] = tuple(v[k] for k in ("pages", "content", "whole", "mass", "size", "linked", "variety")) + (own * share,)
    return out


def test_importance_equals_brute_force(spark, sf):
    made = [("h.com", f"<body><div class='a-ad'>x{i % 5} y{i % 3}</div><article>{article(i)}<h2>head {i}</h2><div class='ad'><a href='/{i % 4}'>same</a> or</div></article><p>root {i}") for i in range(30)]
    made += [(f"h{i % 4}.com", f"<body><div class='search'><h1>own {i}</h1><p>{article(i, 3)}</p></div><div><ul><li><a href='/'>one</a></ul></div>") for i in range(6)]
    table = [("h.com", r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").orderBy("page_id").limit(40).collect()]
    for pages in (made, list(dict.fromkeys(table))):
        rows = [(i, f"http://{h}/", m) for i, (h, m) in enumerate(pages + pages[:1] * 9)]
        got = {bytes(r["path"]): tuple(r)[2:] for r in html.importance(html.style_features(spark.createDataFrame(rows, PAGES))).collect()}
        want = slow_tree(pages)
        assert got.keys() == want.keys()
        assert all(got[p] == pytest.approx(want[p], abs=1e-5) for p in want)


def many(i, n):
    return " ".join(f"w{i}x{k} the and" for k in range(n // 3))


def test_what_recurs_in_articles_stays(spark):
    rows = [(i, f"http://a.com/{i}", f"<body><nav>m</nav><div class='wrap'><h1>title {i}</h1><h2>Introduction</h2><p>{many(i, 60)}</p>{'<p>' + many(i + 1000, 30) + '</p>' if i % 2 else ''}<h2>Summary</h2><p>{many(i + 500, 30 + 3 * (i % 7))}</p><table><tr><th>Price</th><td>{i * 17}</td></tr></table><div class='z'>Always the same</div><ul><li><a href='/x'>one</a></li><li><a href='/y'>two</a></li></ul></div><div class='foot'>All the same here</div></body>") for i in range(40)]
    got = extracted(spark, rows)
    for i in range(40):
        assert all(w in got[i]["text"] for w in (f"title {i}", "Introduction", "Summary", "Price", f"w{i}x0"))
        assert not any(w in got[i]["text"] for w in ("All the same", "Always the same", "one two"))


@pytest.mark.parametrize("long", [100, 400])
@pytest.mark.parametrize("tag", ["article", "div", "p"])
def test_short_articles_beside_long_columns_stay(spark, long, tag):
    head = lambda i: "" if tag == "p" else f"<h1>head{i} of it</h1>"
    rows = [(i, f"http://b.com/{i}", f"<body><{tag}>{head(i)}<p>{many(i, 24)}</p></{tag}><div class='col'><p>{many(i + 1000, long)}</p>{('<p>' + many(i + 3000, 30) + '</p>') * (i % 4)}</div></body>") for i in range(20)]
    got = extracted(spark, rows)
    assert all(f"w{i}x0" in got[i]["text"] and (f"head{i}" in got[i]["text"] or not head(i)) for i in range(20))


@pytest.mark.parametrize("pages", [1, 2, 3, 7, 8])
def test_hosts_of_few_pages_are_judged_alike(spark, pages):
    rows = [(i, f"http://c.com/{i}", f"<body><div class='x'>Read this every time</div><div class='notice'><p>{many(i, 90)}</p>{('<p>' + many(i + 500, 20) + '</p>') * (i % 5)}</div><div class='y'>ending of all</div></body>") for i in range(pages)]
    rows += [(100, "http://d.com/", f"<body><section class='search'><h1>Search algorithms</h1><p>{many(1, 90)}</p></section></body>"), (101, "http://e.com/", f"<div id='menu'><h1>Menu of the week</h1><p>{many(2, 90)}</p></div>"), (102, "http://f.com/", f"<div class='banner'><p>{many(3, 90)}</p></div><div class='menu'>a b c</div>")]
    got = extracted(spark, rows)
    assert all(f"w{i}x0" in got[i]["text"] and (pages == 1 or "Read this" not in got[i]["text"] and "ending" not in got[i]["text"]) for i in range(pages))
    assert got[100]["text"].startswith("Search algorithms w1x0") and got[101]["text"].startswith("Menu of the week w2x0") and got[102]["text"] == many(3, 90)


def test_lists_in_one_stream_with_pages(spark, sf, monkeypatch):
    """With very many judged nodes lists go before their hosts' pages, a large host's to several tasks."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn("url", F.when(F.col("page_id") % 3 > 0, "http://one.com/").otherwise(F.col("url")))
    pages = pages.unionByName(spark.createDataFrame([(9001, None, None), (9002, "x", "")], PAGES))
    order = lambda df: sorted(map(tuple, df.collect()))
    want = order(html.extract(pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), "html")))
    monkeypatch.setattr(html, "NODES", -1)
    monkeypatch.setattr(html, "HOT", 6)
    assert order(html.extract(pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), "html"))) == want
    assert html.extract(pages.limit(0)).collect() == []


def test_templates_go_and_articles_stay(spark):
    rows = []
    for i in range(40):
        rows.append((i, f"http://h.com/{i}", f"<body><div class='x'>Read this every time</div><article><h1>own {i}</h1>{article(i)}</article><div class='y'>ending</div>"))
    rows += [(100 + i, f"http://h.com/c{i}", rows[0][2]) for i in range(30)]  # copies of one page
    rows += [(200, "http://few.com/", "<div>Read this every time</div>"), (201, None, None), (None, "http://h.com/", ""), (202, "no scheme", "<p>" + "long " * 30_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html.extract(pages).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["text"] == f"own {i} " + " ".join(f"own{i} text{i * 7 + k} the and of para{i}x{k}" for k in range(1 + i % 6)) for i in range(40))
    assert got[105]["text"] == got[0]["text"]
    assert got[200]["text"] == "Read this every time" and got[201]["text"] == "" == got[None]["text"]
    assert got[202]["n_chars"] == 30_000 * 5 - 1
    assert html.extract(pages.limit(0)).count() == 0


def test_deep_and_large_pages():
    import time

    start = time.process_time()
    deep = html.Page("<div>a" * 50_000 + "</div>" * 50_000)
    assert len(deep.blocks) == 50_000 and max(len(p) for p, _ in deep.blocks) == 8 * html.LEVELS
    assert text_of("<article>" + "<section><p>a <i>b</i></section>" * 50_000 + "</article>") == " ".join(["a b"] * 50_000)
    assert time.process_time() - start < 20


def articles(rows):
    import html as references
    import re

    for r in rows:
        own = r["html"].split("<article>")[1].split("</article>")[0]
        yield r["text"], " ".join(references.unescape(re.sub("<[^>]*>", " ", own)).split())


def test_articles_of_the_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert all(a == b for a, b in articles(html.extract(pages).join(pages.select("page_id", "html"), "page_id").collect()))


def test_the_tree_finds_the_articles_without_names(spark):
    """On the table, whose hosts have one to some dozens of pages, no class word is needed."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = list(articles(html.extract(pages, frozenset()).join(pages.select("page_id", "html"), "page_id").collect()))
    assert sum(a == b for a, b in found) >= 0.95 * len(found)


def test_pipeline_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    content = language.learn_dictionaries(language.training_rows(docs))
    compressors = language.Compressors(content)
    kept = {i: t for i, t in kept.items() if not compressors.judge(t)[2]}
    left = docs.where(F.col("doc_id").isin(list(kept)))
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(~quality.held_out())
    ranking = quality.learn(left, labels)
    scores = ranking.scores(np.array([quality.features(t) for t in kept.values()]))
    kept = {i: t for (i, t), s in zip(kept.items(), scores) if s >= 0.3}
    ids = list(kept)
    least = slow_components(ids, [slow_fingerprint(kept[i]) for i in ids])
    kept = {i: kept[i] for i, c in zip(ids, least) if i == c}
    assert len(kept) > 0.6 * docs.count()
    library = Tokenizer.from_file(TOKENIZER)
    want = set()
    for i, t in kept.items():
        raw = np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want |= {(i, k, at, len(raw[at : at + 2048]), zlib.crc32(raw[at : at + 2048].tobytes())) for k, at in enumerate(range(0, len(raw), 2048))}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {tuple(r[:5]) for r in rows} == want and len(rows) == len(want)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 1


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = [(1, None, "en", "a"), (2, "", None, None), (None, "The words of a text that nobody labelled.", None, None), (3, "The words of a text that nobody labelled.", "en", "s"), (3, "The words of a text that nobody labelled.", "en", "s"), (4, "12 %%", "en", "s")]
    kind = "doc_id long, text string, lang string, source string, score double, rejected string, fp long"
    docs = spark.createDataFrame([(*r, 1.0, "x", 5) for r in rows], kind)
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            if name != "best_fit_packing":
                assert out.columns == docs.columns
            out.write.parquet(path := f"{tmp_path}/{name}-{table.count()}-{table is docs}")
            table = spark.read.parquet(path)


def test_stages_on_a_very_long_text(spark, sf, tmp_path):
    """A text of millions of characters goes through every stage whole, beside ordinary ones."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("text is not null").limit(40)
    long = " ".join(r["text"] for r in docs.collect()) * 20
    every = docs.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(10**9).cast("long"), "text": F.lit(long)}))
    at = str(tmp_path)
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{at}/labels.parquet")
    every.write.parquet(f"{at}/documents.parquet")
    rows = corpus_pipeline.run(spark, at).where(F.col("doc_id") == 10**9).orderBy("start").collect()
    if rows:  # its quality may be low
        assert rows[0]["start"] == 0 and all(a["start"] + a["length"] == b["start"] for a, b in zip(rows, rows[1:])) and all(r["length"] == 2048 for r in rows[:-1])
    got = language.identify(language.learn_dictionaries(language.training_rows(docs)), "text")
    assert every.where(F.col("doc_id") == 10**9).select(got.alias("j")).first()["j"]["lang_pred"] != "und"
