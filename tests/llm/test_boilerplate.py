from __future__ import annotations

import random
import time

import numpy as np
import pytest

from ledgerlint.llm import boilerplate

CASES = [
    (None, []), ("", []), ("plain", [("open", "plain")]), ("x < y &amp; <b>z</b>", [("open", "x < y & z")]),
    ("<p>a<p>b</p>c", [("open", "a"), ("open", "b"), ("open", "c")]),
    ("<ul><li>a<li>b</ul>", [("open", "a"), ("open", "b")]),
    ("<p>one\n two<br>three&nbsp;four", [("open", "one two three four")]),
    ("<!-- c <p>no</p>", []), ("<p>cut <a hre", [("open", "cut")]), ("<p>a</p><script>if(a<b){'</p>'}", [("open", "a")]),
    ("<article><h1>T</h1><p>x</p></article><footer>f</footer>", [("main", "T"), ("main", "x"), ("furniture", "f")]),
    ("<article><p>a<div class='ad'>b</div><p>c</article>d", [("main", "a"), ("furniture", "b"), ("main", "c"), ("open", "d")]),
    ("<main><section id='comments'><p>r</section>m</main>", [("furniture", "r"), ("main", "m")]),
    ("<div role=navigation>n</div><a title='>'>k</a>", [("furniture", "n"), ("open", "k")]),
    ("<article><form><p>f</p></form><style>p{}</style><p>&#x41;&copy;&lt;p&gt;</article>", [("furniture", "f"), ("main", "A©<p>")]),
]


@pytest.mark.parametrize("page,want", CASES)
def test_blocks(page, want):
    assert boilerplate.blocks(page) == want


def test_very_long_and_broken_pages_end():
    boilerplate.blocks("<" * 20000)
    boilerplate.blocks("<p>" * 20000)
    assert boilerplate.blocks("<article><p>" + "word " * 200000)[0][0] == "main"


MENU = "home news sport weather travel culture money video audio"


def pages(spark):
    bodies = [f"unique words of page {i} " + " ".join(f"t{i}x{k}" for k in range(12)) for i in range(6)]
    rows = [(i, f"https://one.example/{i}", f"<div>{MENU}</div><div>{b}</div>", "u") for i, b in enumerate(bodies)]
    rows += [(10, "https://two.example/a", f"<div>{MENU}</div><div>{bodies[0]}</div>", "u")]
    rows += [(11, "https://three.example/a", f"<div>{bodies[1]}</div>", "u"), (12, "https://three.example/b", f"<div>{bodies[1]}</div>", "u")]
    rows += [(13, "https://one.example/x", f"<nav>{MENU}</nav><article><p>{MENU}</p><p>own</p></article>", "u")]
    rows += [(14, None, None, "u"), (14, None, None, "u"), (15, "no url", "<p>alone", "u")]
    return bodies, spark.createDataFrame(rows, "page_id long, url string, html string, unsure string").repartition(3)


def test_repeated_runs_go_and_unique_runs_stay(spark):
    bodies, frame = pages(spark)
    out = boilerplate.main_text(frame)
    assert out.columns == ["page_id", "url", "unsure", "text"]
    got = {r["page_id"]: r["text"] for r in out.collect()}
    for i in range(6):
        assert got[i] == bodies[i]  # the menu repeats on the host
    assert got[10] == f"{MENU}\n\n{bodies[0]}"  # other hosts do not count
    assert got[11] == got[12] == bodies[1]  # copies do not erase each other
    assert got[13] == f"{MENU}\n\nown"  # an article is kept as it is
    assert got[14] == "" and got[15] == "alone"
    assert out.count() == frame.count()


def test_runs_equal_brute_force():
    texts = ["a b c d e f g h i j", "k l m", "n o p q r s t u v w x"]
    words = " ".join(texts).split()
    windows = boilerplate._windows(texts)
    assert len(windows) == len(words) - boilerplate.RUN + 1
    assert boilerplate.unique_runs(texts, {int(windows[0])}) == ["i j", "k l m", "n o p q r s t u v w x"]
    assert boilerplate.unique_runs(texts, {int(w) for w in windows}) == []
    assert boilerplate.unique_runs(texts, set()) == texts


def brute(found, least, share):
    """Texts of pages by a sorted suffix array of each host: (url host, blocks) of every page in ``found``."""
    out = []
    for host in sorted({h for h, _ in found}):
        streams, owners = [], []
        for n, (h, page) in enumerate(found):
            if h == host:
                main, unsure, furniture = ([t for k, t in page if k == x] for x in ("main", "open", "furniture"))
                own = boilerplate._windows([] if main else unsure)
                streams.append((n, boilerplate._family(own, main + unsure), main, [] if main else unsure, furniture))
        for n, family, _, unsure, furniture in streams:
            for texts, is_open in ((unsure, True), (furniture, False)):
                tokens = " ".join(texts).lower().split()
                owners += [(tokens[i:], family, n if is_open else -1, i) for i in range(len(tokens))]
        owners.sort(key=lambda x: x[0])
        need = max(least, share * len({f for _, f, _, _, _ in streams}))
        covered = {n: set() for n, *_ in streams}
        for at, (suffix, _, n, i) in enumerate(owners):
            if n < 0:
                continue
            families, common = {owners[at][1]: len(suffix)}, []
            for step in (-1, 1):  # neighbours agree ever less on the way up and down
                shared, k = len(suffix), at + step
                while 0 <= k < len(owners) and shared >= boilerplate.RUN:
                    other = owners[k][0]
                    m = 0
                    while m < min(shared, len(other)) and other[m] == suffix[m]:
                        m += 1
                    shared = m
                    families[owners[k][1]] = max(families.get(owners[k][1], 0), shared)
                    k += step
            common = sorted(families.values(), reverse=True)
            longest = max((c for j, c in enumerate(common) if j + 1 >= need), default=0)
            if longest >= boilerplate.RUN:
                covered[n].update(range(i, i + longest))
        for n, _, main, unsure, _ in streams:
            texts, at = list(main), 0
            for block in unsure:
                words, kept, run = block.split(), [], []
                for j, word in enumerate([*words, None]):
                    if word is not None and at + j in covered[n]:
                        run.append(word)
                        continue
                    if len(run) < min(boilerplate.RUN, len(words)):
                        kept += run
                    run = []
                    kept += [word] if word is not None else []
                at += len(words)
                texts += [" ".join(kept)] if kept else []
            out.append((n, "\n\n".join(texts)))
    return dict(out)


@pytest.mark.parametrize("seed,least,share", [(1, 3, 0.1), (2, 2, 0.0), (3, 3, 0.5)])
def test_query_equals_sorted_suffixes(spark, monkeypatch, seed, least, share):
    monkeypatch.setattr(boilerplate, "LEAST", least)
    monkeypatch.setattr(boilerplate, "SHARE", share)
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(rng.randint(3, 30))) for _ in range(9)]
    rows = []
    for i in range(60):
        parts = [f"<p>{rng.choice(shared)}" for _ in range(3)] + [f"<nav>{rng.choice(shared)}</nav>"]
        parts += [f"<div class='widget'>{rng.choice(shared)} w{i}</div>"]
        parts += ["<div>" + " ".join(f"own{rng.randrange(4000)}" for _ in range(rng.randint(1, 40))) + "</div>"]
        rng.shuffle(parts)
        page = "".join(parts) if i % 9 else f"<article><p>{shared[0]}</article>" + "".join(parts)
        rows.append((i, f"http://h{i % 2}.example/{i}", page))
    found = [(i % 2, boilerplate.blocks(page)) for i, _, page in rows]
    want = brute(found, least, share)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in boilerplate.extract(frame).collect()}
    assert got == want
    assert any(got[i] != "\n\n".join(t for k, t in found[i][1] if k == "open") for i in range(60) if i % 9)


def test_articles_that_share_a_passage_keep_it(spark):
    passage = " ".join(f"p{k}" for k in range(26))
    rows = [(i, f"http://h.example/{i}", f"<div>{passage}</div><div>{w}</div>") for i, w in enumerate(("one", "two"))]
    rows += [(2 + i, f"http://h.example/x{i}", f"<div>{' '.join(f'q{i}x{k}' for k in range(20))}</div>") for i in range(9)]
    # Near copies by the dozen, one word apart, count as few pages of the host.
    copy = [f"c{k}" for k in range(400)]
    rows += [(20 + i, "http://n.example/1", f"<p>{' '.join([*copy, f'end{i}'])}") for i in range(12)]
    got = {r["page_id"]: r["text"] for r in
           boilerplate.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == f"{passage}\n\none" and got[1] == f"{passage}\n\ntwo"
    assert all(got[20 + i] == " ".join([*copy, f"end{i}"]) for i in range(12))


def test_columns_of_any_name(spark):
    names = ["host", "__host", "page", "doc", "p", "family", "open", "windows", "w", "unsure", "repeated"]
    rows = [(f"http://h.example/{i}", f"<div>{MENU}</div><p>own {i}", "old", *names) for i in range(4)]
    frame = spark.createDataFrame(rows, ["url", "html", "text", *names])
    out = boilerplate.main_text(frame)
    assert out.columns == ["url", *names, "text"]
    assert sorted(map(tuple, out.collect())) == [(f"http://h.example/{i}", *names, f"own {i}") for i in range(4)]


def test_empty_table(spark):
    _, frame = pages(spark)
    assert boilerplate.extract(frame.where("page_id < 0")).collect() == []


@pytest.mark.parametrize("around", [
    "<div class='page has-sidebar'>", "<div class='no-sidebar'>", "<div class='elementor-widget-container'>",
    "<div id='header-fixed'>", "<form action='/a'>", "<header>", "<div role='form'>",
])
def test_an_article_ends_furniture_around_it(around):
    assert ("main", "x") in boilerplate.blocks(f"{around}<article><p>x</article>")
    assert ("main", "x") in boilerplate.blocks(f"{around}<main><p>x</main>")


@pytest.mark.parametrize("around", ["<aside>", "<nav>", "<footer>", "<div class='comments'>", "<div hidden>"])
def test_articles_of_lists_and_menus_are_not_the_page(around):
    page = f"{around}<article><p>x</article></{around[1:4]}>"
    assert "main" not in {kind for kind, _ in boilerplate.blocks(page)}


def test_names_alone_are_left_to_the_host(spark):
    menu = "home news sport weather travel culture money video audio"
    rows = [(i, f"https://one.example/{i}", f"<div class='widget'>{menu}</div><div class='has-sidebar'>own {i}</div>")
            for i in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in boilerplate.extract(frame).collect()} == {i: f"own {i}" for i in range(4)}


@pytest.mark.parametrize("head, tail", [("<div>", "</p>"), ("<b>", "</div>"), ("<p><i>", "<li>"), ("< ", "<a "), ("<table><b>", "</b>")])
def test_hostile_pages_take_linear_time(head, tail):
    page = head * (500_000 // len(head)) + tail * (500_000 // len(tail))
    start = time.perf_counter()
    boilerplate.blocks(page)
    assert time.perf_counter() - start < 5


def test_suffixes_are_sorted_and_repeats_are_intervals(spark):
    words = [f"w{k}" for k in range(20)]
    rows = [(f"h{i % 2}", i, words[i % 4 : i % 4 + 12], words[: 3 * (i % 5)]) for i in range(40)]
    rows += [("closed", 99, [], words)]  # nothing to judge on this host
    codes = {w: int(boilerplate._tokens([w])[0].astype(np.int64)) for w in words}
    frame = spark.createDataFrame(
        [(h, f, [codes[w] for w in a], [codes[w] for w in b]) for h, f, a, b in rows],
        "host string, family long, stream array<long>, furniture array<long>",
    )
    parts = boilerplate.suffix_array(frame).rdd.glom().collect()
    got = [(r["host"], tuple(r["head"]), r["family"], r["open"]) for part in parts for r in part]
    want = {}
    for h, f, a, b in rows[:-1]:
        for tokens, is_open in ((a, True), (b, False)):
            for i in range(len(tokens) - boilerplate.RUN + 1):
                key = (h, tuple(codes[w] for w in tokens[i : i + boilerplate.RUN]), f)
                want[key] = want.get(key, False) or is_open
    assert got == [(*k, want[k]) for k in sorted(want)]
    hosts, heads = np.array([g[0] for g in got], dtype=object), np.array([g[1] for g in got])
    lcp = boilerplate.common_prefixes(hosts, heads)
    for k in range(1, len(got)):
        same = [x == y for x, y in zip(got[k][1], got[k - 1][1])] if got[k][0] == got[k - 1][0] else [False]
        assert lcp[k] == (same.index(False) if False in same else boilerplate.RUN)
    plan = boilerplate.repeated_runs(frame)._jdf.queryExecution().toString().lower()
    assert "rangepartitioning" in plan
