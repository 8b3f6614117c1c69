"""HTML extraction, decontamination, near-duplicates and the pipeline."""

import collections
import html as entities
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlake.llm import html_extract, near_dedup
from eventlake.llm.decontaminate import contaminated, decontaminate

from .helpers import SCHEMA, awkward, frame, rows, words

SF = "/root/testdata/sf0.01"


# --- HTML -------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a\n\nb"), ("a<br>b", "a b"),
        ("<html><head><title>t<body><div>x  y</div><div class='ad'>q</div><ul><li>1<li>2</ul>", "x y\n\n1\n\n2"),
        ("<div>a <b>bold</b> c<span class=ad>AD</span> d</div><!-- x", "a bold c d"),
        ("<header>site</header><article><header><h1>T</h1></header><p>x</p><div class=comments><p>c</p></div></article><p>z", "T\n\nx"),
        ("<p class=\"a>b\">ok<p>c", "ok\n\nc"), ("<script>if(a<b){'</p>'}</script>t", "t"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"), ("<div>" * 3000 + "deep", "deep"), ("<<<", "<<<"),
        ("<nav><ul><li>m</ul></nav><aside>s</aside><form>f<input></form><p>main</p><footer>x</footer>", "main"),
        ("<div id='cookie-notice'>accept</div><p>m</p>", "m"), ("<p>&lt;b&gt; &nbsp;&eacute;", "<b> é"),
        ("<p " + "a'b\"" * 500, ""),
    ],
)
def test_extract(page, text):
    assert html_extract.extract(page) == text


@pytest.mark.parametrize(
    "inner, text",
    [
        ("<svg-icon a=b></svg-icon><p>two</p>", "one\n\ntwo"), ("<svg class='i'/><p>two</p>", "one\n\ntwo"),
        ("<object-x></object-x><template-y></template-y><p>two</p>", "one\n\ntwo"), ("<select><option>a<p>two</p>", "one\n\ntwo"),
        ("<object data=x><p>two</p>", "one\n\ntwo"), ("<template><p>two</p>", "one\n\ntwo"), ("<svg><path d='1'/><p>two</p>", "one\n\ntwo"),
        ("<p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</p><p>two</p>", "one\n\na x=2 b\n\ntwo"),
        ("<p>a<object data=x>b</object> c</p>", "one\n\nab c"), ("<p>a<svg><title>t</title><g><text>s</text></g></svg>b</p>", "one\n\nab"),
        ("<p>a <select><option>x<option>y</select> b</p>", "one\n\na b"), ("<iframe>x</iframe><noscript>n</noscript ><p>two", "one\n\ntwo"),
        ("<script>'<p>x</p>'</script\n><style>p{}</style><p>two<textarea>z", "one\n\ntwo"),
    ],
)
def test_extract_raw_and_foreign(inner, text):
    assert html_extract.extract(f"<article><p>one</p>{inner}</article>") == text


def test_pages_like_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = html_extract.html_extract(pages).collect()
    assert len(got) == len(source)
    for r in got:
        body = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        parts = (" ".join(entities.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in re.split(r"</?(?:p|h1)>", body))
        assert r.text == "\n\n".join(p for p in parts if p)


def test_wrapper_without_semantic_tags(spark):
    """Constant nodes go, the varying slot stays, also where no tag or class tells them apart."""
    page = lambda i: f"<body><div>Site name</div><div><p>Read our rules first.</p><div class=c><p>{words(i, 30)}</p>{'<p>' + words(900 + i, 9) + '</p>' if i % 2 else ''}</div></div><div>All rights kept</div></body>"
    data = [(i, "http://one.example/x", page(i), None) for i in range(40)]
    data += [(100 + i, "http://copies.example/", page(7), None) for i in range(9)]
    data += [(200, None, None, None), (201, "x", "", None), (202, "http://one.example/x", page(3), None), (202, "http://one.example/x", page(3), None)]
    df = spark.createDataFrame(data, "page_id long, url string, html string, host string").repartition(4)
    got = collections.defaultdict(list)
    for r in html_extract.html_extract(df).collect():
        got[r.page_id].append(r.text)
    for i in range(40):
        assert got[i][0] == "\n\n".join([words(i, 30), *([words(900 + i, 9)] if i % 2 else [])])
    assert words(7, 30) in got[100][0]  # copies of one page are not all template
    assert got[200] == [""] and got[201] == [""] and len(got[202]) == 2
    assert html_extract.html_extract(df.limit(0)).collect() == []


def test_slots_are_told_apart_without_tags_and_classes(spark):
    """Menus, adverts and footers that vary by page are slots beside the article's, whatever their labels."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    bare = pages.withColumn("html", F.regexp_replace(F.regexp_replace("html", "<(/?)(nav|article|footer)\\b", "<$1div"), ' class="[^"]*"', ""))
    host = {r.page_id: r.h for r in pages.select("page_id", html_extract.host_of("url").alias("h")).collect()}
    size = collections.Counter(host.values())
    tagged = {r.page_id: r.text for r in html_extract.html_extract(pages).collect()}
    got = {r.page_id: r.text for r in html_extract.html_extract(bare.repartition(7)).collect()}
    large = [i for i in got if size[host[i]] >= html_extract.LEAST_PAGES]
    assert len(large) > 100 and sum(got[i] == tagged[i] for i in large) >= 0.95 * len(large)
    assert all(set(tagged[i].split("\n\n")) <= set(got[i].split("\n\n")) for i in got)  # no block of an article is lost


def test_pages_of_another_layout_keep_their_article(spark):
    menu = lambda i: "<div>" + "".join(f"<p>{words(i * 9 + k, 2)}</p>" for k in range(5)) + "</div>"
    most = lambda i: f"<body>{menu(i)}<div><h1>{words(i, 4)}</h1><p>{words(1000 + i, 80)}</p><p>{words(2000 + i, 60)}</p></div></body>"
    few = lambda i: f"<body><table><tr><td>{words(3000 + i, 90)}<td><ul><li>{words(4000 + i, 70)}</ul></table></body>"
    data = [(i, "http://mixed.example/", most(i) if i < 30 else few(i)) for i in range(34)]
    got = {r.page_id: r.text for r in html_extract.html_extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "\n\n".join([words(i, 4), words(1000 + i, 80), words(2000 + i, 60)]) for i in range(30))
    assert all(got[i] == "\n\n".join([words(3000 + i, 90), words(4000 + i, 70)]) for i in range(30, 34))


def test_wrapper_chooses_among_articles(spark):
    """Also where tags exist: a teaser that is an article of its own lies in another slot than the story."""
    page = lambda i: f"<body><div><article><p>{words(i, 5)}</p></article></div><div><article><h1>{words(i, 3)}</h1><p>{words(500 + i, 60)}</p></article></div></body>"
    df = spark.createDataFrame([(i, "http://two.example/", page(i)) for i in range(20)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.html_extract(df).collect()}
    assert all(got[i] == words(i, 3) + "\n\n" + words(500 + i, 60) for i in range(20))


def test_induction_equals_one_process(spark):
    """Wrappers of many tasks equal those counted page by page in one process."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select(html_extract.host_of("url").alias("host"), "html")
    pages = pages.withColumn("html", F.regexp_replace("html", "<(/?)(nav|article|footer)\\b", "<$1div"))
    pages = pages.withColumn("html", F.replace("html", F.lit("<body>"), F.lit("<body><div><p>Mind the rules</p></div>")))
    got = {r.host: r for r in html_extract.induce(pages.repartition(9)).collect()}
    unpack = html_extract.zstandard.ZstdDecompressor().decompress
    refs = {r.host: html_extract.json.loads(unpack(bytes(r.packed))) for r in html_extract.references(pages).collect()}
    by_host = collections.defaultdict(list)
    for r in pages.collect():
        by_host[r.host].append(r.html)
    for host, all_pages in by_host.items():
        if len(all_pages) < html_extract.LEAST_PAGES:
            assert host not in got
            continue
        counts, trees = collections.Counter(), [html_extract.parse(x) for x in refs[host]]
        mass, held = [collections.Counter() for _ in trees], [collections.Counter() for _ in trees]
        for page in all_pages:
            root = html_extract.parse(page)
            texts = list(html_extract.blocks(root))
            partner = [{id(b): a for a, b in html_extract.match(t, root)[1]} for t in trees]
            shows, keys = [[] for _ in texts], set()
            for tree, other, of in zip(trees, refs[host], partner, strict=True):
                own = collections.defaultdict(set)
                for text, node in html_extract.blocks(tree):
                    own[id(node)].add(text)
                same = [text in own[id(of.get(id(node)))] for text, node in texts]
                part = sum(len(t) for (t, n), x in zip(texts, same) if x and not n.furniture)
                if other == page or part <= 0.9 * sum(len(t) for t, n in texts if not n.furniture):
                    for k, x in enumerate(same):
                        shows[k] += [other != page] * x
                    keys |= {html_extract.node_key(of[id(n)].path, t) for (t, n), x in zip(texts, same) if x}
            counts.update(keys)
            for k, of in enumerate(partner):
                back = set()
                for (text, node), x in zip(texts, shows):
                    if not any(x) and not node.furniture and not node.head:
                        at = node
                        while id(at) not in of:
                            at = at.up
                        a = of[id(at)]
                        if at is node and (a.tag in html_extract.HEADINGS or html_extract._is_slot(a)):
                            back.add(id(a.up if a.tag in html_extract.HEADINGS else a))
                        while a is not None:
                            mass[k][id(a)] += len(text)
                            a = a.up
                held[k].update(back)
        best = []
        for k, tree in enumerate(trees):
            at = tree
            while 2 * held[k][id(at)] <= len(all_pages):
                down = [c for c in at.kids if html_extract._is_slot(c) and mass[k][id(c)] >= 0.8 * mass[k][id(at)]]
                if not down or not mass[k][id(at)]:
                    break
                at = down[0]
            best.append((mass[k][id(at)], -k, html_extract._numbered(tree).index(at)))
        assert got[host].slot == max(best)[2] and unpack(bytes(got[host].packed)).decode() == refs[host][-max(best)[1]]
        template = {x for x, n in counts.items() if n >= 0.8 * len(all_pages)}
        assert template and set(got[host].template or ()) == template


def test_repeated_cell_counts_once_per_page(spark):
    """A minority of pages that repeat one text on one path does not make it a template."""
    page = lambda i: f"<body><article>{'<p>* * *</p>' * 10 if i < 10 else ''}<p>{words(i, 20)}</p></article></body>"
    df = spark.createDataFrame([(i, "http://cells.example/", page(i)) for i in range(100)], "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in html_extract.html_extract(df).collect()}
    assert all(got[i] == "\n\n".join(["* * *"] * 10 * (i < 10) + [words(i, 20)]) for i in range(100))


def test_notice_of_most_pages_whatever_the_splits(spark):
    """A text on 85 % of a host's pages is template in any order and any number of splits."""
    page = lambda i: f"<body><div>{'<p>Mind our rules</p>' if i % 20 > 2 else ''}<p>{words(i, 20)}</p></div></body>"
    data = [(i, "http://most.example/", page(i)) for i in range(100)]
    for parts in (1, 40):
        for rows_ in (data, data[::-1]):
            df = spark.createDataFrame(rows_, "page_id long, url string, html string").coalesce(1).repartition(parts)
            got = {r.page_id: r.text for r in html_extract.html_extract(df).collect()}
            assert all(got[i] == words(i, 20) for i in range(100))


def test_captures_of_one_page_keep_their_article(spark):
    """Nine captures of one story, alike but for the date, and one other page: no article is taken for template."""
    story = "".join(f"<p>Paragraph {i} of the story, {words(i, 30)}.</p>" for i in range(6))
    page = lambda body: f"<body><div class=x><p>Home and more</p></div><div class=y>{body}</div></body>"
    rows = [(k, "http://h.example/a", page(f"<p>Crawled {k}</p>{story}")) for k in range(9)]
    rows.append((9, "http://h.example/b", page(f"<p>Other</p><p>{words(77, 60)}</p>")))
    got = {r.page_id: r.text for r in html_extract.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(9):
        assert got[k].count("Paragraph") == 6 and f"Crawled {k}" in got[k]
    assert words(77, 60) in got[9]


@pytest.mark.parametrize("depth", [160, 3000])
def test_deep_pages_keep_their_structure(spark, depth):
    inner = "<article><p>text</p><nav><p>menu</p></nav><p>more</p></article>"
    page = "<div>" * depth + inner + "</div>" * depth
    assert html_extract.extract(page) == "text\n\nmore"
    rows = [(k, "http://deep.example/", page.replace("more", f"more {k}").replace("text", f"text {k}")) for k in range(6)]
    got = html_extract.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {k: f"text {k}\n\nmore {k}" for k in range(6)}


def test_long_sibling_lists():
    """20,000 siblings of other shapes on both sides: linear, anchored at shapes that are unique."""
    page = lambda k: "<body>" + "".join(
        f"<div class=c{i}><b>{i}</b></div>" if i % 100 == 0 else "<p>" + "<i>x</i>" * ((i * k) % 7) + "</p>" for i in range(20000)) + "</body>"
    a, b = html_extract.parse(page(3)), html_extract.parse(page(5))
    n, pairs = html_extract.match(a, b)
    assert n == len(pairs) > 20000
    anchored = [(u, v) for u, v in pairs if u.label.startswith("div.c")]
    assert len(anchored) == 200 and all(u.label == v.label for u, v in anchored)


def brute_match(a, b):
    if a.label != b.label:
        return 0
    m = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
    for i, u in enumerate(a.kids):
        for j, v in enumerate(b.kids):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + brute_match(u, v))
    return m[-1][-1] + 1


def test_tree_matching():
    rng = random.Random(5)

    def tree(depth):
        inner = "".join(tree(depth - 1) for _ in range(rng.randint(0, 3))) if depth else "t"
        tag = rng.choice(["div", "section", "ul"])
        return f"<{tag}>{inner}</{tag}>"

    for _ in range(200):
        a, b = html_extract.parse(tree(3)), html_extract.parse(tree(3))
        n, pairs = html_extract.match(a, b)
        assert n == len(pairs) and all(x.label == y.label for x, y in pairs)
        assert len({id(x) for x, _ in pairs}) == n == len({id(y) for _, y in pairs})
        assert n == brute_match(a, b)


# --- Decontamination ---------------------------------------------------------

BENCH = [
    (0, "Alice Jones bought 12 apples for 5kg of flour and walked 30 miles home before the other children had finished eating."),
    (1, "how many of the seven sleeping dogs would wake if a very loud bell rang twice at noon"),
    (2, "tiny item words"), (3, None), (4, ""), (1, "how many of the seven sleeping dogs would wake if a very loud bell rang twice at noon"),
]


def found(spark, texts, ids=None):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    out = contaminated(frame(spark, rows(texts, ids=ids)), bench).collect()
    return {(r.doc if not r.null_id else None, r["item"]) for r in out}


def test_reparameterised_and_consistent(spark):
    swap = BENCH[0][1].replace("Alice", "Robert").replace("12", "99").replace("5kg", "8lb").replace("30 miles", "7 km")
    again = "The King saw 5 men and the King gave 5 of them bread because these old men had walked for many long days " * 2
    texts = [
        words(1, 50) + " " + swap + " " + words(2, 50),  # other names, numbers and units
        words(3, 30) + "\n" + BENCH[1][1].upper().replace(" ", "***  ") + "\n" + words(4, 30),  # other case and punctuation
        " ".join(BENCH[1][1].split()[:9]) + " " + words(5, 40),  # too short a passage
        "nothing " + "tiny item words" + " here", None, "", again, words(9, 5000) + " " + BENCH[1][1] + " " + words(8, 5000),
    ]
    assert found(spark, texts) == {(0, 0), (1, 1), (3, 2), (7, 1)}


def test_copies_in_other_case_and_with_longer_names(spark):
    items = [
        "Then Maria told Peter that Lena would meet Oskar near Berlin before Anna saw Bruno leave for Madrid with Clara",
        "Tom walked past the old mill with Eva and then sold 5 kg of apples to the tall man for 3 coins",
    ]
    texts = [f(i) for i in items for f in (str.lower, str.upper, lambda x: words(5, 20).lower() + " " + x.lower())]
    texts += [items[1].replace("Eva", "Mary Ann Lee"), items[1].replace("Tom", "Mary Ann").replace("5 kg", "5kg"), words(6, 60)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc, r["item"]) for r in contaminated(frame(spark, rows(texts)), bench).collect()}
    assert got == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1)}


def test_inconsistent_slots_do_not_match(spark):
    item = "If Anna gives Anna 3 and Anna takes 3 then Anna has 3 more than Anna had before 3 new ones came"
    good = item.replace("Anna", "Otto").replace("3", "8")
    names, numbers = iter(["Otto", "Emma", "Karl", "Ida", "Paul"]), iter("81742")
    bad = " ".join(next(names) if w == "Anna" else next(numbers) if w == "3" else w for w in item.split())
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = contaminated(frame(spark, rows([good, bad])), bench).collect()
    assert [(r.doc, r["item"]) for r in got] == [(0, 7)]


def test_decontaminate_awkward(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    data = awkward() + rows([BENCH[1][1], BENCH[1][1], None], ids=[500, 500, 501])
    df = frame(spark, data)
    out = decontaminate(df, bench)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(data) - 2 and not any(r.doc_id == 500 for r in got)
    assert decontaminate(frame(spark, []), bench).collect() == []
    assert decontaminate(df, bench.limit(0)).count() == len(data)


def test_benchmark_passages_of_the_tables(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: r.text for r in bench.collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if r.text and t in r.text}
    got = {(r.doc, r["item"]) for r in contaminated(docs, bench).collect()}
    assert exact and exact <= got and len(got - exact) <= 2


# --- Near-duplicates ----------------------------------------------------------


def plain(text):
    clean = (re.sub(r"[^0-9a-z\x80-\U0010ffff]", "", x.lower()) for x in re.split(r"[\x20\x09-\x0d]+", text or ""))
    return [w for w in clean if w]


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        new = [0]
        for j, b in enumerate(y):
            new.append(row[j] + 1 if a == b else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def brute_classes(data, similarity=0.8):
    seqs = []
    for r in data:
        w = plain(r[1])
        k = min(5, len(w))
        seqs.append([tuple(w[p : p + k]) for p in range(len(w) - k + 1)] if w else [])
    up = list(range(len(data)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if seqs[i] and seqs[j] and root(i) != root(j):
                need = similarity * (len(seqs[i]) + len(seqs[j])) / (1 + similarity) - 1e-9
                common = sum((collections.Counter(seqs[i]) & collections.Counter(seqs[j])).values())
                if common >= need and lcs(seqs[i], seqs[j]) >= need:
                    up[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(data)):
        groups[root(i)].append(i)
    order = lambda x: (x is None, x)
    return sorted(((data[i][0], min((data[k][0] for k in g), key=order), len(g)) for g in groups.values() for i in g), key=str)


def got_classes(df):
    return sorted(((None if r.null_id else r.doc, r.class_id, r.members) for r in near_dedup.classes(df).collect()), key=str)


def edited(text, seed, n):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_classes_like_brute_force(spark):
    base, chain = words(31, 150), [words(32, 200)]
    for i in range(6):  # each near the one before, the ends far apart
        chain.append(edited(chain[-1], i, 3))
    texts = [edited(base, i, i % 7) for i in range(40)] + chain + [words(40 + i, 60) + " " + words(33, 60) for i in range(30)]
    texts += [base.upper() + " !!", " ".join(base.split()[:10] + base.split()), "five short words stay alone", "five short words stay alone", "five short words stay"]
    data = awkward() + rows(texts, ids=list(range(1000, 1000 + len(texts))))
    assert got_classes(frame(spark, data, 5)) == brute_classes(data)


def test_group_without_a_hub(spark):
    """Texts of one ring, each near its neighbours only: links between non-hubs are found too."""
    w = words(71, 400).split()
    data = rows([" ".join((w + w)[i * 12 : i * 12 + 200]) for i in range(30)])
    assert got_classes(frame(spark, data, 4)) == brute_classes(data)


def test_large_groups_in_blocks(spark, monkeypatch):
    base = words(81, 120)
    data = rows([edited(base, i, 2 + i % 9) for i in range(60)] + [words(82, 30) + " " + words(900 + i, 40) for i in range(20)])
    monkeypatch.setattr(near_dedup, "GROUP_WORDS", 1500)
    assert got_classes(frame(spark, data, 4)) == brute_classes(data)


def test_alignment():
    rng = random.Random(6)
    for _ in range(300):
        x = [rng.randrange(6) for _ in range(rng.randint(1, 40))]
        y = list(x)
        for _ in range(rng.randint(0, 8)):
            if y and rng.random() < 0.5:
                y.pop(rng.randrange(len(y)))
            else:
                y.insert(rng.randint(0, len(y)), rng.randrange(6))
        if not y:
            continue
        true = lcs(x, y)
        need = int(np.ceil(0.8 * (len(x) + len(y)) / 1.8 - 1e-9))
        assert (near_dedup.aligned(np.array(x), np.array(y), need) >= need) == (true >= need)
        assert near_dedup.similar(np.array(x), np.array(y), 0.8) == (true >= need)


def test_near_dedup_awkward(spark):
    data = awkward()
    df = frame(spark, data)
    out = near_dedup.near_dedup(df)
    assert out.columns == df.columns
    got = out.collect()
    texts = [plain(r.text) for r in got if plain(r.text)]
    assert len({tuple(t) for t in texts}) == len(texts) == len({tuple(plain(r[1])) for r in data if plain(r[1])})
    assert sum(r.text is None or not plain(r.text) for r in got) == sum(not plain(r[1]) for r in data)
    assert near_dedup.near_dedup(frame(spark, [])).collect() == []


# --- Pipeline ------------------------------------------------------------------


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix_sources", "shards"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.cut(stage(spark, kept, SF), f"test-{name}")
        assert out.columns[: len(docs.columns)] == docs.columns
        if name != "shards":
            assert out.dtypes == docs.dtypes
        seen.append({r.doc_id for r in out.select("doc_id").collect()})
        kept = out
    assert all(b <= a for a, b in zip(seen, seen[1:], strict=False))
    assert len(seen[0]) >= 0.99 * docs.count()
    bad = {r.doc for r in contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert not bad & seen[2] and len(seen[2]) >= len(seen[1] - bad)


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns[-2:] == ["slot", "shard"] and out.count() > 0


def test_stages_on_awkward_and_empty(spark, tmp_path):
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for data in (awkward(), []):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame(spark, data), str(tmp_path))
            assert set(SCHEMA.names) - {"slot"} <= set(out.columns)
            assert out.count() <= 3 * len(data)
