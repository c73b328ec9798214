"""Each operator against a brute-force version on small inputs with nulls, empty texts, ties and repeated rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import difference, oracle_connection

import corpus_pipeline
from tallywatch.llm import decontaminate, licenses, mixing, pages, ppm, quality, simhash, substrings, topk, toxicity
from tallywatch.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(80))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    frame = QUERIES[name](spark, SMALL).toPandas()
    assert difference(frame, oracle_connection(SMALL).sql(ORACLE[name]).df()) is None


EDGE = [(1, None, "a"), (2, "", "a"), (3, LONG, None), (3, LONG, None), (None, "one two", "b"), (4, "short text here", "b"), (5, "x " * 30_000, "a")]


def test_mixing_edges(docs):
    rows = mixing.mix(docs(EDGE)).collect()
    assert len(rows) == len(EDGE)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    sums = defaultdict(int)
    for r in rows:
        sums[r["source"]] += r["taken"]
    assert all(abs(sums[r["source"]] - r["target"]) <= 1 for r in rows)
    assert mixing.mix(docs(EDGE[:1]).limit(0)).count() == 0


def test_decontaminate_edges(spark, docs):
    benchmark = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20, 35))), (2, "short text"), (3, None), (None, "two")], "item_id long, text string")
    found = {(r["doc_id"], r["n_hit"], r["n_items"]) for r in decontaminate.contamination(docs(EDGE), benchmark).collect()}
    assert found == {(1, 0, 0), (2, 0, 0), (3, 15, 1), (None, 1, 1), (4, 2, 1), (5, 0, 0)}
    kept = decontaminate.without_contaminated(docs(EDGE), benchmark)
    assert kept.columns == docs(EDGE).columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5]
    assert decontaminate.contamination(docs(EDGE), benchmark.limit(0)).filter("contaminated").count() == 0
    near = decontaminate.proximity(docs(EDGE), benchmark, 12)
    assert near.count() > 0


def brute_components(prints, ids):
    reach = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= simhash.DISTANCE:
                old, new = max(reach[i], reach[j]), min(reach[i], reach[j])
                reach = [new if r == old else r for r in reach]
    return [min((ids[k] for k in range(len(ids)) if reach[k] == r and ids[k] is not None), default=None) for r in reach]


def test_simhash_components(docs, monkeypatch):
    edited = [(10 + i, LONG + f" {'z' if i % 2 else 'y'}{i}", "a") for i in range(12)]
    rows = EDGE + edited
    want = Counter(zip([r[0] for r in rows], brute_components([simhash.fingerprint(r[1]) for r in rows], [r[0] for r in rows])))
    for crowd in (256, 1):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        got = Counter((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs(rows)).collect())
        assert got == want
    kept = simhash.one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns
    assert kept.count() == len(set(brute_components([simhash.fingerprint(r[1]) for r in rows], [r[0] for r in rows])))
    assert simhash.near_duplicates(docs(rows).limit(0)).count() == 0


@pytest.mark.parametrize("parts", simhash.PARTITIONS)
def test_simhash_partitions_lose_no_link(spark, monkeypatch, parts):
    monkeypatch.setattr(simhash, "PARTITIONS", (parts,))
    random = np.random.default_rng(7)
    base = random.integers(-(2**63), 2**63 - 1, 40)
    values = set(base.tolist())
    for b in base.tolist():
        for _ in range(4):
            for bit in random.choice(63, random.integers(1, 5), replace=False):
                b ^= 1 << int(bit)
            values.add(b)
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r["fp"]: r["root"] for r in simhash.components(simhash.links(frame)).collect()}
    want = brute_components([v & (2**64 - 1) for v in values], values)
    assert [roots.get(v, v) for v in values] == want


def test_substrings_keep_the_first_and_remove_the_rest(docs):
    rows = [(7, f"own line\n{LONG}\nend", "a"), (2, f"{LONG.upper()}\n{LONG}", "a"), *EDGE]
    out = Counter((r["doc_id"], r["text"], r["n_removed"]) for r in substrings.repeats(docs(rows)).collect())
    assert out[(7, "own line\nend", len(LONG) + 1)] == 1
    assert out[(2, f"{LONG.upper()}\n", len(LONG))] == 1
    assert out[(3, "", len(LONG))] == 2 and out[(1, None, 0)] == 1 and out[(2, "", 0)] == 1
    left = substrings.cleaned(docs(rows))
    assert left.columns == docs(rows).columns and left.count() == len(rows)
    # Of two equal rows one keeps its line.
    twice = Counter(r["text"] for r in substrings.repeats(docs([(3, LONG, "a"), (3, LONG, "b")])).collect())
    assert twice == {LONG: 1, "": 1}


def test_substrings_across_and_inside_lines(docs):
    lines = "\n".join(f"The line number {i} of a poem, repeated by many." for i in range(12))
    inside = " ".join(f"Sentence {i} of the passage is here." for i in range(12))
    bare = " ".join(f"u{i}" for i in range(300))
    rows = [
        (1, f"Head one.\n{lines}\nTail one.", "a"), (2, f"Another head.\n{lines}\nAnother tail.", "a"),
        (3, f"Before it. {inside} After it.", "a"), (4, f"Something else. {inside} The rest.\nA last line.", "a"),
        (5, bare, "a"), (6, f"q1 q2 q3 {bare} q4", "a"), (7, "Short line.\n" * 3, "a"), (8, "Ten words are in this line of the song, yes.\n" * 20, "a"),
    ]
    out = {r["doc_id"]: r for r in substrings.repeats(docs(rows)).collect()}
    assert all(out[i]["text"] == rows[i - 1][1] for i in (1, 3, 5, 7))
    assert out[2]["text"] == "Another head.\nAnother tail."
    assert out[4]["text"] == "Something else. The rest.\nA last line."
    assert len(out[6]["text"].split()) < 100
    # A periodic text keeps one passage whole.
    assert out[8]["text"] == "Ten words are in this line of the song, yes.\n" * 5
    for r in out.values():
        ends = [0, *(x for s in r["spans"] for x in (s["begin"], s["end"]))]
        assert ends == sorted(ends) and r["n_removed"] == sum(s["end"] - s["begin"] for s in r["spans"])


def test_topk_ties_copies_and_bad_vectors(spark):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [0.0, -0.1]), (None, [2.0, 2.0])]
    found = [tuple(r) for r in topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect()]
    one = [(1, None, 256 * 512 + 128 * 512), (2, 0, 256 * 256 + 128 * 128), (3, 1, 256 * 256 + 128 * 128), (4, 6, -26 * 128)]
    assert Counter(found) == Counter({(0, *x): 2 for x in one})


def test_ppm_against_plain_counts(docs, monkeypatch):
    monkeypatch.setattr(ppm, "WORD_BLOCK", 7)
    monkeypatch.setattr(ppm, "BLOCK_CHARS", 200)
    rows = [(i, t, "a") for i, t in enumerate(["the cat sat", "the Cat\nran on", None, "", "aa ab " * 5, "unseen wörds", LONG])]
    got = {r["doc_id"]: r for r in ppm.scores(docs(rows)).collect()}
    counts = Counter()
    for i, text, _ in rows:
        if not got[i]["held_out"]:
            counts.update(w for w in ppm.symbols_of(text) if not w.startswith(ppm.LINE))
    total, lines = sum(counts.values()), Counter(k for i, t, _ in rows if not got[i]["held_out"] for k in ppm.symbols_of(t) if k.startswith(ppm.LINE))
    share = (sum(n for n in lines.values() if n > 1) + 0.5) / (sum(n for n in lines.values() if n > 1) + total + 1)
    seen = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    ends = lambda w: ppm.SPACE * ppm.ORDER + (w if w == ppm.END else w + ppm.SPACE)
    for word, n in counts.items():
        for at in range(ppm.ORDER, len(ends(word))):
            for k in range(ppm.ORDER + 1):
                seen[k][ends(word)[at - k : at]][ends(word)[at]] += n

    def length(word):
        out = 0.0
        for at in range(ppm.ORDER, len(ends(word))):
            gone: set[int] = set()
            for k in range(ppm.ORDER, -1, -1):
                table = seen[k].get(ends(word)[at - k : at], Counter())
                left = {s: n for s, n in table.items() if s not in gone}
                if ends(word)[at] in left:
                    out += math.log10(left[ends(word)[at]] / (sum(left.values()) + len(left)))
                    break
                if left:
                    out += math.log10(len(left) / (sum(left.values()) + len(left)))
                gone |= set(table)
            else:
                out -= math.log10(ppm.ALPHABET - len(gone))
        return out

    for i, text, _ in rows:
        words = [w for w in ppm.symbols_of(text) if not w.startswith(ppm.LINE)]
        assert got[i]["n_tokens"] == len(words) and got[i]["train_tokens"] == total
        assert got[i]["n_known"] == sum(w in counts for w in words)
        assert got[i]["score"] == pytest.approx(sum(length(w) + math.log10(1 - share) for w in words))
    assert ppm.scores(docs(rows).limit(0)).count() == 0


def test_pages_without_article_use_the_template(spark):
    def page(i):
        body = f"<div>Welcome to the site</div><div class=x><p>Story {i} of a &lt;kind&gt;<p>and <b>more {i}</div><div>All the best</div>"
        return (i, "http://h.example/p", f"<html><head><title>t</title></head><body><nav>menu</nav>{body}<footer>f</footer></body></html>")

    odd = [(90, None, None), (91, "nonsense", ""), (92, "http://h.example/x", "plain < text"), (93, "http://k.example/", "<article><p>same</article>"), (94, "http://k.example/", "<article><p>same</article>")]
    rows = [page(i) for i in range(8)] + odd
    text = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(text[i] == f"Story {i} of a <kind>\n\nand more {i}" for i in range(8))
    assert text[90] == text[91] == "" and text[92] == "plain < text" and text[93] == text[94] == "same"


def test_pages_names_do_not_cost_content(spark):
    share = "<div class='share'>Share this</div>"
    bodies = [
        "<article class='post category-social'><p>Own {i}</p></article>",
        "<div class='site no-sidebar'><article><p>Own {i}</p></article></div>",
        "<article><section id='related-work'><h2 id='search-algorithms'>Own {i}</h2></section></article>",
        "<article><h2><span class='headline' id='Social_impact'>Own {i}</span></h2></article>",
        "<article><pre><span class='comment'>Own {i}</span></pre></article>",
        "<form class='search'><article><p>Own {i}</p></article></form>",
        "<article><p>Own {i}</p>" + share + "</article>",
        "<main><div class='sidebar'>Elsewhere {i}</div><article><p>Own {i}</p></article></main>",
        "<div class='sidebar'><article>Teaser {i}</article></div><article><p>Own {i}</p></article>",
        "<article><p>Own <math><mi>{i}</mi><annotation encoding='tex'>x</annotation></math></p></article>",
        "<div class='search'>Find</div><div class='site no-sidebar'>Own {i}</div>",
        "<pre><span class='comment'>Own {i}</span></pre>",
    ]
    rows = [(k * 10 + i, f"http://h{k}.example/{i}", f"<body><nav>menu</nav>{b.format(i=i)}</body>") for k, b in enumerate(bodies) for i in range(6)]
    text = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k: v for k, v in text.items() if v != f"Own {k % 10}"} == {}


def test_pages_deep_nesting_and_own_names(spark):
    rows = [(0, "http://d.example/", "<div>" * 5000 + "deep"), (1, "http://d.example/", "<div><p>" * 2500 + "other")]
    for i in range(10):
        # Own ids and an optional element before the constant slot.
        extra = f"<div>Extra {i}</div><p>more {i}</p>" if i % 2 else ""
        rows.append((10 + i, "http://o.example/", f"<body>{extra}<div>Welcome</div><h2 id='own-{'abcdefghij'[i]}'>Head {i}</h2></body>"))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r["page_id"]: r["text"] for r in pages.main_text(frame).collect()}
    assert text[0] == "deep" and text[1] == "other"
    assert all(text[10 + i] == (f"Extra {i}\n\nmore {i}\n\n" if i % 2 else "") + f"Head {i}" for i in range(10))
    # Per host only constant slots are gathered, however many own slots its pages have.
    host = frame.withColumn("host", pages.F.lit("o"))
    assert max(len(t["constant"]) for r in pages.templates(host.filter("page_id >= 10")).collect() for t in r["template"]) <= 2


def test_licences(docs):
    rows = [*EDGE, (20, "intro\nLicensed under the Apache License, Version 2.0.", "a"), (21, "Released under the MIT License.\nAll rights reserved.", "a"), (22, "All the rights of the people", "a")]
    found = {r["doc_id"]: r["families"] for r in licenses.scan(docs(rows)).collect()}
    assert found[20] == "apache-2.0" and found[21] == "all-rights-reserved,mit"
    assert all(v == licenses.UNKNOWN for k, v in found.items() if k not in (20, 21))


def test_licences_reworded_and_wrapped(docs):
    want = {
        "Licensed under the GNU General Public License, version 3": "gpl-3.0",
        "Released under the GNU General Public License version 3": "gpl-3.0",
        "MIT License": "mit",
        "The MIT License (MIT)": "mit",
        "Intro.\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the Software), to deal\nin the Software": "mit",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:": "bsd",
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.": "gpl-3.0",
        "Distributed under the GNU Affero General Public License v3.0": "agpl-3.0",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted": "isc",
        "This program is made available under the terms of the Eclipse Public License 2.0": "epl-2.0",
        "Dedicated to the public under CC0 1.0 Universal": "cc0-1.0",
        "The permission of the rights holder and a license to drive are needed": licenses.UNKNOWN,
    }
    found = {r["doc_id"]: r for r in licenses.scan(docs([(i, t, "a") for i, t in enumerate(want)])).collect()}
    assert {t: found[i]["families"] for i, t in enumerate(want)} == want
    assert all(found[i]["n_notices"] == (f != licenses.UNKNOWN) for i, f in enumerate(want.values()))


def test_quality_and_toxicity_on_held_out_labels(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.resampled(documents, labels).join(labels, "doc_id").filter("crc32(cast(doc_id as string)) % 2 = 1").toPandas()
    assert (kept["kept"] == (kept["quality"] == 1)).mean() > 0.97
    scored = toxicity.scores(documents, labels).join(labels, "doc_id").filter("held_out").toPandas()
    ranks, toxic = scored["score"].rank(), scored["toxic"] == 1
    area = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.88


def test_quality_and_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    assert quality.resampled(docs(EDGE), labels).filter("kept").count() == len(EDGE)
    assert quality.accepted(docs(EDGE), labels).columns == docs(EDGE).columns
    rows = toxicity.scores(docs(EDGE), labels).collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in rows)


def test_kth_largest(spark):
    values = [float(v) for v in (3, 1, 2, 2, 2, 9, -5)]
    frame = spark.createDataFrame([(v,) for v in values], "value double")
    for k in range(1, 8):
        assert quality.kth_largest(frame, k) == sorted(values)[-k]


def test_pipeline_drops_copies_by_jaccard(spark, docs):
    """Edited texts of five-word Jaccard 0.8 or more that lie more than three bits apart."""
    random = np.random.default_rng(3)
    rows, far = list(EDGE), 0
    for k in range(40):
        words = [f"t{x}" for x in random.integers(0, 5000, 300)]
        edited = list(words)
        for at in random.choice(300, 4, replace=False):
            edited[at] = f"e{at}"
        one, two = " ".join(words), " ".join(edited)
        x, y = (set(simhash.shingles(t).tolist()) for t in (one, two))
        assert len(x & y) / len(x | y) >= 0.8
        far += (simhash.fingerprint(one) ^ simhash.fingerprint(two)).bit_count() > simhash.DISTANCE
        rows += [(100 + 2 * k, one, "a"), (101 + 2 * k, two, "a")]
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs(rows), SMALL).collect()}
    assert far > 10
    assert {i for i in kept if i and i >= 100} == {100 + 2 * k for k in range(40)}


def test_pipeline_stages(spark):
    out = corpus_pipeline.run(spark, SMALL).toPandas()
    assert len(corpus_pipeline.STAGES) == 5
    assert 0 < len(out) < 200 and (out["taken"] > 0).all() and (out["taken"] <= 2 * out["size"]).all()
