"""Main text of web pages."""

import numpy as np

from signalflow.llm import html_extract


def text(page):
    found = html_extract.blocks(page)
    return html_extract.main_text(found)


def test_marked_text():
    page = (
        "<body><header>Site</header><nav><ul><li>Menu</ul></nav><div class='cookie-notice'>We use</div><main><article>"
        "<header><h1>Title</h1><span>by me</span></header>Caf&eacute; &amp; bar &#x4e2d; &am<br>next  line<ul><li>a<li>b</ul><p class=ad>buy<p>last"
        "<script>var t='</p>';</script><style>p{}</style><!-- no --><form>mail</form><aside>more</aside><article>a reader</article>"
        "<div id=comments><p>nice</div></article><p>beside</main><footer>foot"
    )
    assert text(page) == ["Title", "Café & bar 中 &am next line", "a", "b", "last"]


def test_broken_markup():
    assert html_extract.blocks(None) == html_extract.blocks("") == html_extract.blocks("<script>x") == []
    assert html_extract.blocks("a < b") == [(0, "a < b")]
    assert html_extract.blocks("x</div></p>y<!-- z") == [(0, "x"), (0, "y")]
    assert text("<article><p><b>one<br><p>two</article>") == ["one", "two"]
    deep = "<div>" * 20000 + "in" + "</div>" * 20000
    assert html_extract.blocks(deep) == [(0, "in")]


def test_host_repeats_are_cut_from_unmarked_pages(spark, monkeypatch):
    menu = "home news sport weather travel culture contact imprint privacy terms"
    pages = [(i, f"https://Host.example/{i}", f"<div>{menu}</div><div>story {i} tells of thing number {i}</div>") for i in range(5)]
    pages += [(9, "https://other.example/", f"<p>{menu}</p>"), (10, None, None), (11, "", ""), (None, "x", "<article>kept</article>")]
    pages += [(12, "https://host.example/a", f"<article>{menu}</article>")] * 2
    got = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == len(pages)
    by_id = {r.page_id: r for r in got}
    assert all(by_id[i].text == f"story {i} tells of thing number {i}" and by_id[i].n_repeated == 10 for i in range(5))
    assert by_id[9].text == menu and by_id[12].text == menu and by_id[None].text == "kept"
    assert (by_id[10].text, by_id[10].n_chars, by_id[11].text) == ("", 0, "")


def test_no_pages(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_suffixes_are_ranked_by_their_first_words():
    words = np.random.default_rng(5).integers(0, 2, 300)
    ranks = html_extract.suffix_ranks(words)
    heads = [tuple(words[i : i + html_extract.RUN].tolist()) for i in range(len(words))]
    order = sorted(set(heads))
    assert ranks.tolist() == [order.index(h) for h in heads]


def test_blocks_that_most_articles_of_a_host_share_are_cut(spark):
    share = "tell your friends about this story by mail or post"
    some = "our reporters wrote this part for a few of the stories"

    def page(i, more=""):
        return f"<nav>menu</nav><article><h1>Story {i}</h1><p>{share}</p><p>What happened on day {i} at the place of number {i} {share} {i}</p>{more}</article>"

    pages = [(i, f"https://big.example/{i}", page(i, f"<p>{some}</p>" if i < 150 else "")) for i in range(700)]
    pages += [(1000 + i, f"https://big.example/copy{i}", page(5, f"<p>{some}</p>")) for i in range(3)]
    pages += [(2000 + i, f"https://small.example/{i}", page(i)) for i in range(9)]
    pages += [(3000 + i, f"https://same.example/{i}", f"<article><p>{share}</p><p>{some}</p></article>") for i in range(20)]
    pages += [(4000 + i, f"https://main.example/{i}", f"<main><p>{share}</p><p>page {i}</p></main>") for i in range(12)]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == len(pages)

    def text(i, first="", more=""):
        return f"Story {i}{first}\nWhat happened on day {i} at the place of number {i} {share} {i}{more}"

    assert all(got[i].text == text(i, more=f"\n{some}" if i < 150 else "") and got[i].n_repeated == 10 for i in range(700))
    assert all(got[1000 + i].text == got[5].text for i in range(3))
    assert all(got[2000 + i].text == text(i, first=f"\n{share}") for i in range(9))  # too few articles to tell
    assert all(got[3000 + i].text == f"{share}\n{some}" for i in range(20))  # copies of one article
    assert all(got[4000 + i].text == f"page {i}" for i in range(12))


def test_many_copies_of_a_row_are_no_one_group(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "SECTION_PAGES", 20)
    menu = "home news sport weather travel culture contact imprint privacy terms"
    pages = [(7, "https://h.example/7", f"<p>{menu}</p><p>seven</p>")] * 300
    pages += [(100 + i, f"https://h.example/{i}", f"<p>{menu}</p><p>page {i}</p>") for i in range(100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    keyed = html_extract._keyed(df)
    groups = html_extract.dealt(html_extract._sections(keyed)(keyed)).groupBy("host", "section").count().collect()
    assert sum(g["count"] for g in groups) == 400 and max(g["count"] for g in groups) <= 40
    got = html_extract.extract(df).collect()
    assert sorted((r.page_id, r.text, r.n_repeated) for r in got) == sorted([(7, "seven", 10)] * 300 + [(100 + i, f"page {i}", 10) for i in range(100)])


def test_where_a_host_is_cut_changes_no_text(spark, monkeypatch):
    """Sections of few articles: what counts is the share of the host's different articles."""
    monkeypatch.setattr(html_extract, "SECTION_PAGES", 6)
    rng = np.random.default_rng(8)
    shared = [" ".join(f"b{i}w{j}" for j in range(8 + i % 3)) for i in range(30)]
    # up to four of a hundred articles more or less than half, and the rest far from it
    have = [rng.permutation(101)[: 50 + rng.integers(-4, 5) if i < 20 else 10 * (i - 20)] for i in range(30)]
    articles = [[f"only here {a}", *[shared[i] for i in range(30) if a in have[i]]] for a in range(101)]
    pages = [(a, f"https://big.example/{a}", blocks) for a, blocks in enumerate(articles)]
    # copies of an article count once, and those of a row are judged by the host too
    pages += [(1000 + i, f"https://big.example/copy{i}", articles[3]) for i in range(60)] + [pages[4]] * 40
    df = spark.createDataFrame([(i, u, "<article><p>" + "<p>".join(b) + "</article>") for i, u, b in pages], "page_id long, url string, html string")
    gone = {shared[i] for i in range(30) if 2 * len(have[i]) > 101}
    assert 5 < len(gone) < 25 and any(len(h) == 50 for h in have) and any(len(h) == 51 for h in have)
    got = sorted((r.page_id, r.text, r.n_repeated) for r in html_extract.extract(df).collect())
    want = [(i, "\n".join(t for t in b if t not in gone), sum(len(t.split()) for t in b if t in gone)) for i, _, b in pages]
    assert got == sorted(want)


def test_named_runs_are_those_of_more_than_a_quarter():
    rng = np.random.default_rng(9)
    for n in (1, 3, 9):
        articles = [[" ".join(rng.choice(["a", "b"], rng.integers(0, 20))) for _ in range(4)] for _ in range(n)]
        held = [{tuple(w[i : i + 8]) for t in a for w in [t.split()] for i in range(len(w) - 7)} for a in articles]
        counts = {r: sum(r in h for h in held) for r in set().union(*held)}
        digest = lambda run: int(html_extract.run_hashes(html_extract._word_hashes(run))[0])
        runs, number = html_extract.named_runs(articles)
        assert dict(zip(runs.tolist(), number.tolist())) == {digest(r): c for r, c in counts.items() if 4 * c > n}
        some = np.array([digest(r) for r in list(counts)[::2]], np.int64)
        runs, number = html_extract.counted_runs(articles, some)
        assert dict(zip(runs.tolist(), number.tolist())) == {digest(r): counts[r] for r in list(counts)[::2]}
