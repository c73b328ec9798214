"""Wrapper induction: tree matching against all matchings, and templates found by it alone."""

import random

from tallywatch.llm import pages
from tallywatch.llm.alignment import MATCH, Tree, bounded, matching, packed, unpacked

COLUMNS = "page_id long, url string, html string"


def random_tree(chance, size):
    labels, texts, children = ["r"], [""], [[]]
    above = sorted(chance.randrange(k) for k in range(1, size))
    for k, parent in enumerate(above, 1):
        labels.append(chance.choice("ab"))
        texts.append(chance.choice(["", "x", "y"]))
        children.append([])
        children[min(parent, k - 1)].append(k)
    # Parents in order, so numbers go level by level.
    return bounded(Tree(labels, texts, children), size, 2 * size)


def best(one, two, a=0, b=0):
    """Weight of the best matching, by trying all pairs of child lists."""
    if one.labels[a] != two.labels[b]:
        return 0

    def along(xs, ys):
        if not xs or not ys:
            return 0
        met = best(one, two, xs[0], ys[0])
        return max(along(xs[1:], ys), along(xs, ys[1:]), met + along(xs[1:], ys[1:]) if met else 0)

    return MATCH + (one.texts[a] == two.texts[b]) + along(one.children[a], two.children[b])


def test_matching_is_the_best_of_all():
    chance = random.Random(7)
    for _ in range(300):
        one, two = (random_tree(chance, chance.randint(1, 9)) for _ in range(2))
        found = matching(one, two)
        assert sum(MATCH + (one.texts[a] == two.texts[b]) for a, b in found) == best(one, two)
        # Each node once, labels alike, parents matched with each other, order kept.
        assert len({a for a, _ in found}) == len({b for _, b in found}) == len(found)
        above = [{c: k for k, own in enumerate(t.children) for c in own} for t in (one, two)]
        assert all(one.labels[a] == two.labels[b] and (above[0][a], above[1][b]) in found for a, b in found[1:])
        assert all((a < c) == (b < d) for a, b in found for c, d in found if a != c and above[0].get(a, -1) == above[0].get(c, -2))


def test_matching_of_deep_and_wide_trees():
    deep = Tree(["d"] * 3000, ["t"] * 3000, [*([k + 1] for k in range(2999)), []])
    assert len(matching(deep, deep)) == 3000 and matching(deep, Tree(["e"], [""], [[]])) == []
    wide = Tree(["b"] + ["p"] * 20_000, [str(k) for k in range(20_001)], [list(range(1, 20_001)), *([] for _ in range(20_000))])
    small = bounded(wide, 2000, 32)
    assert small.texts == [*map(str, range(17)), *map(str, range(19_985, 20_001))]
    assert all(small.texts[a] == wide.texts[b] for a, b in matching(small, wide)) and unpacked(packed(small)) == small


def texts(spark, rows):
    return {r["page_id"]: (r["text"], r["n_constant"]) for r in pages.main_text(spark.createDataFrame(rows, COLUMNS)).collect()}


def test_template_without_telling_tags(spark):
    rows = []
    for i in range(40):
        own = "".join(f"<div>Line {i}.{k}</div>" for k in range(i % 4 + 1))
        # Constant blocks around a varying number of the same label; one with its own label on every second page only.
        half = "<p>Ask us</p>" if i % 2 else ""
        rows.append((i, "http://a.example/", f"<body><div>Start</div><div>Shop</div>{own}{half}<div>Imprint</div></body>"))
    # One page goes its own way, so its block stays; copies of one page are no template.
    rows.append((90, "http://a.example/", "<body><div>Start</div><div>Shop</div><div>Only here</div><div>New imprint</div></body>"))
    rows += [(200 + k, "http://copies.example/", "<body><div>Same</div><div>Text</div></body>") for k in range(30)]
    found = texts(spark, rows)
    for i in range(40):
        assert found[i] == ("\n\n".join(f"Line {i}.{k}" for k in range(i % 4 + 1)), 3 + i % 2)
    assert found[90] == ("Only here\n\nNew imprint", 2)
    assert {found[200 + k] for k in range(30)} == {("Same\n\nText", 0)}


def test_constant_blocks_of_an_article_stay(spark):
    body = "<body><div>Site</div><article><h2>Summary</h2><p>Own {i}</p><h2>Sources</h2></article></body>"
    found = texts(spark, [(i, "http://a.example/", body.format(i=i)) for i in range(12)])
    assert all(found[i] == (f"Summary\n\nOwn {i}\n\nSources", 1) for i in range(12))


def test_edges(spark):
    assert texts(spark, [(1, None, None), (None, "nonsense", "")]) == {1: ("", 0), None: ("", 0)}
    empty = spark.createDataFrame([], COLUMNS + ", host string, trees string, template string")
    assert pages.main_text(empty).count() == 0
    clash = spark.createDataFrame([(k, "http://a.example/", f"<p>own {k}</p>", "h", "t", "m") for k in range(6)], COLUMNS + ", host string, trees string, template string")
    long = spark.createDataFrame([(99, "http://a.example/", "<p>word" * 100_000, "h", "t", "m")], clash.schema)
    got = {r["page_id"]: r["text"] for r in pages.main_text(clash.unionByName(long)).collect()}
    assert got[3] == "own 3" and got[99].count("word") == 100_000


def test_constant_blocks_that_no_reference_holds(spark):
    def form(i):
        return f"<body><div>Start</div><div>Own {i}</div></body>"

    # Pages of a second form with higher digests than three of the first, so that it gives no reference.
    plain = sorted(range(60), key=lambda i: pages.page_digest(form(i)))
    third = pages.page_digest(form(plain[2]))
    other = [(i, html) for i in range(100, 160) if pages.page_digest(html := f"<body><section><p>Own {i}</p><h4>Write to us</h4></section></body>") > third][:12]
    rows = [(i, "http://a.example/", form(i)) for i in plain] + [(i, "http://a.example/", html) for i, html in other]
    # More neighbours of one label than a reference keeps, the constant one in the middle.
    wide = [(1000 + i, "http://b.example/", "".join(f"<p>{i} at {k}</p>" if k != 30 else "<p>Call us now</p>" for k in range(61))) for i in range(12)]
    found = texts(spark, rows + wide)
    assert all(found[i] == (f"Own {i}", 1) for i in range(60))
    assert len(other) == 12 and all(found[i] == (f"Own {i}", 1) for i, _ in other)
    assert all(found[1000 + i] == ("\n\n".join(f"{i} at {k}" for k in range(61) if k != 30), 1) for i in range(12))
