"""WARC archives, HTML extraction and close vectors against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import time
from collections import Counter

import numpy as np
import pytest

from orderlens.llm import cover_tree, html_text, warc
from orderlens.llm.components import connected
from orderlens.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, digest int"


def test_archives_give_back_what_was_written(spark, monkeypatch):
    rng = random.Random(1)
    long_ = ["<p>" + "".join(rng.choices("abc é", k=rng.randint(100, 3000))) + "</p>" for _ in range(40)]
    html = [None, "", "x", "x", *long_, long_[0], long_[0], long_[1], "é" * 50, "é" * 50]
    rows = [(i, f"http://a.example/{i}?q=ü \n", h, 3) for i, h in enumerate(html, 5)]
    rows += [(None, None, long_[2], 3), (9, "http://a.example/9", html[4], 3), (200, "u", long_[39] * 400, 3)]
    rng.shuffle(rows)
    got = warc.archive(spark.createDataFrame(rows, PAGES))
    first: dict[str, int] = {}
    for page_id, _, h, _ in rows:
        if page_id is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, page_id), page_id)
    expected = Counter()
    for page_id, _, h, _ in rows:
        payload = (h or "").encode()
        refers = first.get(h) if first.get(h) != page_id else None
        kind = "response" if refers is None else "revisit"
        expected[page_id, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers] += 1
    assert Counter(tuple(r)[:5] for r in got.collect()) == expected
    assert warc.archive(spark.createDataFrame([], PAGES)).count() == 0


def test_only_listed_archives_are_read(spark, tmp_path):
    """Another attempt's archives, cut at other rows, and one that was never finished stand beside."""
    rows = [(i, f"http://x.example/{i}", f"<p>{i}</p>" * 40) for i in range(60)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"{tmp_path}/archives"
    listed = warc.write(frame.repartition(3), folder).collect()
    assert sum(r.records for r in listed) == 60
    record = warc.record(7, "http://x.example/7", b"<p>7</p>" * 40, "0" * 64, None)
    for name in ("000000-00000-99.warc.zst", "000009-00000-98.warc.zst"):
        (tmp_path / "archives" / name).write_bytes(warc.pack([record]))
    (tmp_path / "archives" / "000001-00001-97.warc.zst").write_bytes(b"cut off")
    assert sorted(r.page_id for r in warc.read(spark, folder).collect()) == list(range(60))


def test_a_repeated_task_writes_under_another_name(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    folder = f"{tmp_path}/archives"
    names = [warc.write(frame, folder).first().archive]
    spark.read.parquet(f"{folder}-written").write.parquet(f"{tmp_path}/kept")
    assert warc.read(spark, folder).count() == 1
    frame.write.parquet(f"{tmp_path}/again")
    names.append(warc.write(frame, f"{tmp_path}/other").first().archive)
    assert len(set(names)) == 2


def test_an_archive_begins_with_its_dictionary_and_each_record_is_a_frame():
    import zstandard

    records = [warc.record(i, f"http://x.example/{i}", b"<p>hello world</p>" * (i % 9 + 1), "0" * 64, None) for i in range(300)]
    data = warc.pack(records)
    size = int.from_bytes(data[4:8], "little")
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D
    assert list(warc.unpack(data)) == records
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    assert dictionary.dict_id() != 0
    # Any zstd reader skips the leading frame; with the dictionary it reads the first record alone.
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    assert reader.decompress(data[8 + size :]) == records[0]
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) - 8 - size < alone
    assert list(warc.unpack(warc.pack(records[:1]))) == records[:1]


ARTICLE = "<h1>A &amp; B</h1><p>First <b>bold</b> para&shy;graph with plenty of words in it,\n  &eacute;t&eacute;.<p>Of.<ul><li>one<li>two</ul>"
TEXT = "A & B First bold para­graph with plenty of words in it, été. Of. one two"
AROUND = {
    "article": ("<body><nav><a href=x>Home</a></nav><div class='ad'>Buy now, it is cheap</div><article>", "</article><footer>&copy; me</footer>"),
    "named": ("<body><div id=header>Site</div><div class=menu><a>x</a></div><div class=post>", "</div><div class=comments><p>I like it, says a reader</div>"),
    "broken": ("<p><main>", ""),
    "aside": ("<body><aside><p>Related reading of some length here</p></aside><section>", "</section><form>Name <input> <p>text</form>"),
    "notice": ("<body><div class='cookie-notice'>We use cookies</div><div><div>", "</div></div><script>if (a < b) { x('</div>') }</script>"),
}


@pytest.mark.parametrize("name", AROUND)
def test_the_article_is_found_whole(name):
    before, after = AROUND[name]
    head = "<!doctype html><html><head><title>T</title><style>p{}</style><!-- <p>no</p> --></head>"
    assert html_text.extract(head + before + ARTICLE + after) == TEXT


WRAPPED = {
    "compound": ("<body><div class='layout has-sidebar no-comments'><div class='post'>", "</div></div>"),
    "builder": ("<body><div class=elementor-widget><div class='elementor-widget-container'>", "</div></div>"),
    "widget": ("<body><div class='widget Blog' id=Blog1><div class=post>", "</div></div><div class='widget'>Popular posts of the week</div>"),
    "main": ("<body><div id=page class=modal><div class=banner>Buy</div><main>", "</main><div class=comments>I like it</div></div>"),
    "article": ("<body><div class='content widget'><article class='post has-sidebar'>", "</article></div><div class='related'><article class=card>Other</article></div>"),
    "left": ("<body><div class='site-header'>Site name</div><div id='left_sidebar'>Latest news of all</div><div class=post>", "</div>"),
    "readers": (
        "<body><div class=post>",
        "</div><div id=comments>" + "<article class='comment-body'>I like it</article>" * 2 + "</div><div class=related>Next</div>",
    ),
}


@pytest.mark.parametrize("name", WRAPPED)
def test_a_name_alone_does_not_remove_the_article(name):
    before, after = WRAPPED[name]
    assert html_text.extract(f"<html>{before}{ARTICLE}{after}") == TEXT
    with_header = f"<div class='entry-header'>{ARTICLE[: ARTICLE.index('<p>')]}</div>{ARTICLE[ARTICLE.index('<p>') :]}"
    assert html_text.extract(f"<html>{before}{with_header}{after}") == TEXT


@pytest.mark.parametrize("name", "comment-list user-comments ad-slot google-ad-box newsletter-box related_posts social-share-bar".split())
def test_adverts_and_comments_go_whatever_their_compound_name(name):
    inside = ARTICLE[: ARTICLE.index("<ul>")], ARTICLE[ARTICLE.index("<ul>") :]
    for part in (f"<div class='x {name}'><p>Not of the article</p></div>", f"<section id={name}>Not of the article</section>"):
        assert html_text.extract(f"<body><article>{inside[0]}{part}{inside[1]}</article>") == TEXT


@pytest.mark.parametrize("name", "entry-header has-comments no-ads commentary adapter roads post-widget".split())
def test_names_that_are_no_part_keep_their_text(name):
    inside = ARTICLE[: ARTICLE.index("<ul>")], ARTICLE[ARTICLE.index("<ul>") :]
    assert html_text.extract(f"<body><article>{inside[0]}<div class={name}>{inside[1]}</div></article>") == TEXT


@pytest.mark.parametrize(
    "html",
    ["<b>" * 50_000 + "</i>" * 50_000, "<div>x" * 20_000 + "</p></b>" * 20_000, "<b><div>" * 20_000 + "</b>" * 20_000, "<p>x" * 50_000],
    ids=["unmatched", "implied", "scoped", "siblings"],
)
def test_deep_pages_with_unmatched_tags_take_time_in_proportion(html):
    def seconds(page):
        started = time.perf_counter()
        html_text.extract(page)
        return time.perf_counter() - started

    assert seconds(html) < 5


def plain_main_text(html):
    """The method told plainly: every sum over a node's whole subtree, anew for every node."""
    root = html_text.parse(html)

    def below(node):
        yield node
        for child in node.children:
            if isinstance(child, html_text.Node) and not child.aside:
                yield from below(child)

    def chars(node, only_links=False):
        total = 0
        for n in below(node):
            linked = any(up.tag == "a" for up in html_text._up(n))
            if linked or not only_links:
                total += sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
        return total

    def density(node):
        c, lc = chars(node), chars(node, True)
        if not c:
            return 0.0
        t, lt = len(list(below(node))), sum(n.tag == "a" for n in below(node))
        base = math.log(c / max(c - lc, 1) * lc + chars(root, True) / max(chars(root), 1) * c + math.e)
        adjust = math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / max(math.log(base), 1e-9) if base > 1 else 0.0
        return c / t * (adjust if lc else max(adjust, 1.0))

    sums = {n: sum(density(c) for c in n.children if isinstance(c, html_text.Node) and not c.aside) for n in below(root)}
    places = [n for n in below(root) if n.tag in html_text.CONTAINERS and chars(n)]
    if not places:
        return " ".join(html_text.blocks(root)) if chars(root) else ""
    best = max(places, key=lambda n: sums[n])
    threshold = min(density(n) for n in html_text._up(best))
    while best.tag not in ("article", "main", "body") and best.parent is not None:
        beside = [c for c in best.parent.children if isinstance(c, html_text.Node) and c is not best and not c.aside]
        if best.parent.tag not in ("article", "main") and not any(chars(c) and density(c) >= threshold for c in beside):
            break
        best = best.parent
    return " ".join(html_text.blocks(best))


def test_main_text_equals_the_plain_densities(spark):
    """On generated pages, and on every page of the sample through the query."""
    rng = random.Random(23)
    tags = "p p div div a b ul li section article h2 span table tr td nav br".split()
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 60)):
            tag = rng.choice(tags)
            parts.append(rng.choice([f"<{tag}>", f"</{tag}>", f"<{tag}>{'word ' * rng.randint(1, 30)}", "text here "]))
        html = "<body>" + "".join(parts)
        assert html_text.extract(html) == plain_main_text(html), html
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    got = QUERIES["op4_html_extraction"](spark, "/root/testdata/sf0.001").collect()
    assert {r.page_id: r.text for r in got} == {i: plain_main_text(html) if html else "" for i, html in pages.items()}


def test_pages_without_text_and_odd_markup(spark):
    odd = ["<", "<p", "</p></div>", "<!--", "<script>x", "a<b", "<div " * 3000, "<div>" * 5000 + "deep", "&am &#x41; &#0;"]
    rows = [(i, "u", h, 3) for i, h in enumerate([None, "", *odd])] + [(None, None, "<p>x", 3)] * 2
    got = html_text.extract_pages(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    texts = {r.page_id: r.text for r in got}
    assert (texts[0], texts[1], texts[5], texts[9], texts[None]) == ("", "", "", "deep", "x")
    assert texts[10].startswith("&am A")
    assert html_text.extract_pages(spark.createDataFrame([], PAGES)).count() == 0


def close(rows):
    """Numbers of links and components by comparing all pairs."""
    unit = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = np.array(v, float) / np.linalg.norm(v)
    ids = [r[0] for r in rows]
    root, n = list(range(len(rows))), Counter()
    pairs = [(i, j) for i in unit for j in unit if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])]
    pairs = [(i, j) for i, j in pairs if unit[i] @ unit[j] >= 0.93]
    for i, j in pairs:
        n[i] += 1
        n[j] += 1
    while True:
        before = list(root)
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
        if root == before:
            break
    smallest = {r: min(ids[i] for i in range(len(rows)) if root[i] == r) for r in set(root)}
    return Counter((ids[i], n[i], smallest[root[i]], ids[i] == smallest[root[i]]) for i in range(len(rows)))


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        centres = rng.normal(size=(5, 8))
        rows += [((centres[i % 5] + rng.normal(scale=0.25, size=8)).tolist(), label) for i in range(60)]
        rows += [((centres[0] + rng.normal(scale=0.01, size=8)).tolist(), label) for _ in range(90)]
    rows += [(rows[0][0], 0)] * 3 + [([0.0] * 8, 0), ([float("nan")] + [1.0] * 7, 0), ([float("inf")] * 8, 1)]
    rows += [([None] + [1.0] * 7, 0), (None, 0), ([], 0), ([1.0, 0.0], 0), ([2.0, 0.1], 0)]
    return [(int(i), [None if x is None else float(np.float32(x)) for x in v] if v is not None else None, label)
            for i, (v, label) in zip(rng.permutation(len(rows)) + 100, rows)]


@pytest.mark.parametrize(("part", "pivots", "leaf"), [(2048, 1024, 32), (40, 1024, 4), (25, 2, 2)])
def test_close_vectors_equal_brute_force(spark, monkeypatch, part, pivots, leaf):
    """In one part, in many cells, and in few cells of many parts."""
    for name, value in (("PART", part), ("PIVOTS", pivots), ("LEAF", leaf)):
        monkeypatch.setattr(cover_tree, name, value)
    rows = vectors(part)
    frame = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, cell int")
    got = cover_tree.near_duplicates(frame).collect()
    assert Counter(map(tuple, got)) == close(rows)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert cover_tree.near_duplicates(empty).count() == 0


def test_a_traversal_counts_dense_nodes_without_their_pairs():
    """Three thousand near copies: as many links as pairs, a forest of as many edges as vectors."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=8) + rng.normal(scale=0.005, size=(3000, 8))
    v /= np.linalg.norm(v, axis=1)[:, None]
    tree = cover_tree.build(v)
    links = cover_tree.traverse(tree, tree, v, v, 0, np.ones(3000, np.int64), 0.93)
    assert (links.counts == 2999).all()
    assert {links.root(i) for i in range(3000)} == {0}


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(1000, 1040)]
    star = [(5, i) for i in range(2000, 2100)]
    ring = [(3000 + i, 3000 + (i + 7) % 20) for i in range(20)]
    edges = [*path, *star, *ring, (7, 7)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()))
    expected = {i: 1000 for i in range(1000, 1041)} | {i: 5 for i in (5, *range(2000, 2100))}
    expected |= {3000 + i: 3000 for i in range(20)}
    assert got == expected


def _noise(n, seed):
    """Unrelated vectors, and two groups of near copies, of which the first is wider than the threshold."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 64))
    v[:300] = v[0] + rng.normal(scale=0.2, size=(300, 64))
    v[300:400] = v[300] + rng.normal(scale=0.02, size=(100, 64))
    return v / np.linalg.norm(v, axis=1)[:, None]


def test_unrelated_vectors_are_sent_to_few_tasks(spark):
    """They prune nothing, so each goes to a task for every part of its label: parts must be large."""
    rows = [(i, v.tolist(), 0) for i, v in enumerate(_noise(5000, 1))]
    units = cover_tree._units(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    units = units.localCheckpoint()
    assert cover_tree._meetings(units, cover_tree._celled(units)).count() == 5000


@pytest.mark.parametrize("block", [2048, 70])
def test_trees_of_unrelated_vectors_give_all_links(monkeypatch, block):
    """Within a part and between two, in few blocks and in many."""
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    a, b = _noise(900, 2), _noise(700, 3)
    b[:20] = a[:20]
    both, weights = np.concatenate([a, b]), np.arange(1, 1601)
    close_ = both @ both.T >= 0.93
    np.fill_diagonal(close_, False)
    trees = cover_tree.build(a), cover_tree.build(b)
    assert max(len(t.children) for t in trees) > 400
    within = cover_tree.traverse(trees[0], trees[0], a, a, 0, weights[:900], 0.93)
    assert (within.counts == close_[:900, :900] @ weights[:900]).all()
    between = cover_tree.traverse(*trees, a, b, 900, weights, 0.93)
    close_[:900, :900] = close_[900:, 900:] = False
    assert (between.counts == close_ @ weights).all()
    root = np.arange(1600)
    while (less := np.minimum(root, np.where(close_, root, 1600).min(axis=1))).tolist() != root.tolist():
        root = less
    assert between.roots(np.arange(1600)).tolist() == root.tolist()
