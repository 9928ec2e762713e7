"""Near copies of texts and vectors, components, and page extraction against brute force."""

import random
import re
import uuid

import numpy as np
import pytest
from llm_helpers import random_words

from placeweave.llm import covertree, graph, jaccard, layouts, pages, store as store_module
from placeweave.operators.sizing import BroadcastLimit


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_of_paths_stars_and_trees(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1200)] + [(2500, i) for i in range(2000, 2300)]
    edges += [(r.randrange(3000, 3400), r.randrange(3000, 3400)) for _ in range(300)] + [(5, 5), (7, 6), (6, 7)]
    tree = Union(3400)
    for a, b in edges:
        tree.join(a, b)
    got = graph.components(spark.createDataFrame(edges, "a long, b long").repartition(8))
    rows = {r["id"]: r["component"] for r in got.collect()}
    assert rows == {v: tree.find(v) for e in edges if e[0] != e[1] for v in e} and got.count() == len(rows)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# texts


def brute_sets(texts):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        out.append({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    return out


def brute_components(ids, texts, percent=90):
    sets, tree = brute_sets(texts), Union(len(ids))
    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and ids[i] is not None and ids[j] is not None and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                tree.join(i, j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[tree.find(k)] = min(i, least.get(tree.find(k), i))
    return sorted(((i, len(s), least.get(tree.find(k))) for k, (i, s) in enumerate(zip(ids, sets, strict=True))), key=repr)


def edited(r, words, share):
    return [w if r.random() > share else "".join(r.choice("xyz") for _ in range(4)) for w in words]


@pytest.mark.parametrize("limit", [BroadcastLimit(), BroadcastLimit(-1, -1)], ids=["broadcast", "shuffled"])
def test_jaccard_components_equal_brute_force(spark, limit):
    r = random.Random(7)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c", "A\nb  c", "a b c", "É é", "word " * 40_000]
    for _ in range(8):
        base = random_words(r, r.choice([4, 30, 120, 400]))
        shared = random_words(r, 40)
        for _ in range(12):
            words = edited(r, base, r.choice([0, 0.002, 0.01, 0.03]))
            if r.random() < 0.3:
                words[0:0] = shared
            texts.append(" ".join(words))
    # A shared passage in many texts that are otherwise unlike, and sets that differ outside their prefixes only.
    common = random_words(r, 60)
    texts += [" ".join(random_words(r, 55) + common) for _ in range(40)]
    ids = list(range(100, 100 + len(texts)))
    ids[-1], ids[-2] = None, ids[-3]
    df = spark.createDataFrame(list(zip(ids, texts, ["k"] * len(ids), strict=True)), "doc_id long, text string, v string").repartition(5)
    got = jaccard.near_components(df, limit=limit)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute_components(ids, texts)


def test_jaccard_links_of_members_that_are_not_their_groups_head(spark):
    # Nine shingles have a prefix of one; here it is the same in texts that are otherwise unlike, each with a near copy.
    r = random.Random(11)
    start, texts = ["start", "of", "all"], []
    for _ in range(6):
        rest = random_words(r, 8)
        texts += [" ".join(start + rest), " ".join([*start, *rest, *random_words(r, 1)])]
        texts += [" ".join([*start[1:], *rest, *random_words(r, 20)]) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    settings = jaccard.Settings()
    every = jaccard.prefixes(df, jaccard.shingle_counts(df, settings), settings, "doc_id", "text").filter("n = 9")
    assert every.count() == 6 and every.select("prefix").distinct().count() == 1
    want = brute_components(list(range(len(texts))), texts)
    assert sum(i != c for i, _, c in want) == 6
    assert sorted((tuple(x) for x in jaccard.near_components(df).collect()), key=repr) == want


def test_jaccard_of_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d")] * 3 + [(2, "a b c d")] * 2, "doc_id long, text string")
    assert sorted(tuple(x) for x in jaccard.near_components(df).collect()) == [(1, 2, 1)] * 3 + [(2, 2, 1)] * 2
    assert jaccard.near_components(df.limit(0)).count() == 0


def test_jaccard_passage_in_many_texts_pairs_few_of_them(spark, monkeypatch):
    # Sixty texts share nine tenths of their words and are still unlike; eight more are near copies of the first.
    r = random.Random(23)
    passage = random_words(r, 654)
    texts = [" ".join(random_words(r, 46) + passage) for _ in range(60)]
    texts += [" ".join(edited(r, texts[0].split(), 0.003)) for _ in range(8)]
    ids = list(range(len(texts)))
    seen, cross = [], jaccard._cross_pairs
    monkeypatch.setattr(jaccard, "_cross_pairs", lambda *given: seen.append(cross(*given)) or seen[-1])
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)
    got = jaccard.near_components(df)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute_components(ids, texts)
    assert seen[0].count() < 60


def test_jaccard_keeps_one_shingle_of_equal_lists(spark):
    lists = {1: [7, 8], 2: [7, 8], -3: [8, 7], 4: [7, 8, 9], 5: [8, 9], 6: [7, 9]}
    rows = [(shingle, g, 10, i) for i, (shingle, groups) in enumerate(lists.items()) for g in groups]
    got = jaccard._distinct_lists(spark.createDataFrame(rows, "shingle long, g long, n long, i int").repartition(3))
    assert sorted(tuple(x) for x in got.collect()) == sorted(x for x in rows if x[0] not in (1, 2))
    assert jaccard._distinct_lists(got.limit(0)).count() == 0


def test_jaccard_signatures_of_any_lengths_bound_how_many_shingles_differ(spark):
    r = random.Random(29)
    words = random_words(r, 900)
    texts = [" ".join(words[:k]) for k in (3, 40, 120, 140, 250, 270, 500, 900)]
    sizes = [len(x) for x in brute_sets(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    settings = jaccard.Settings()
    made = jaccard.prefixes(df, jaccard.shingle_counts(df, settings), settings, "doc_id", "text")
    a, b = (made.select(*(made[c].alias(f"{c}_{x}") for c in ("id", "n", "sig"))) for x in "ab")
    rows = a.crossJoin(b).select("id_a", "id_b", jaccard._differ("sig_a", "sig_b").alias("bits")).collect()
    longs = {x["id"]: len(x["sig"]) for x in made.collect()}
    assert [longs[i] for i in range(len(texts))] == [4, 4, 4, 8, 8, 16, 16, 32]
    for i, j, bits in rows:
        apart, widest = abs(sizes[i] - sizes[j]), max(longs[i], longs[j]) // min(longs[i], longs[j])
        assert bits <= apart and bits == 0 if i == j or widest > 2 else 0 < bits <= apart


def test_jaccard_removes_what_it_wrote_on_the_way(spark, tmp_path, monkeypatch):
    r = random.Random(31)
    base = random_words(r, 200)
    texts = [" ".join(edited(r, base, 0.01)) for _ in range(12)] + [" ".join(random_words(r, 150)) for _ in range(12)]
    monkeypatch.setattr(store_module, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(store_module.CLEANUP, None)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard.near_components(df)
    left = {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}
    assert left.isdisjoint({"prefixes", "whole", "listed", "held", "shared", "entries", "sets", "reps", "open", "rows", "marked", "purity"})
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute_components(list(range(len(texts))), texts)
    assert spark.conf.get(store_module.CLEANUP, None) == before


def test_word_hashes_across_blocks(monkeypatch):
    r = random.Random(2)
    text = " ".join(random_words(r, 3000)) + " " + "q" * 5000 + "\t" + " ".join(random_words(r, 300))
    whole = next(jaccard.shingle_sets([text], 3))
    assert len(whole) == len(brute_sets([text])[0])
    monkeypatch.setattr(jaccard, "BLOCK", 1000)
    words = list(jaccard.word_hashes([text, "x y"]))
    assert len(words[0]) == len(text.split()) and len(set(words[0].tolist())) == len(set(text.split()))


# vectors


def brute_vectors(rows, cosine):
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    tree, links = Union(len(rows)), [0] * len(rows)
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v, label) else None for _, v, label, _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]):
                if units[i] @ units[j] >= cosine:
                    tree.join(i, j)
                    links[i] += 1
                    links[j] += 1
    least = {}
    for k, row in enumerate(rows):
        least[tree.find(k)] = min(row[0], least.get(tree.find(k), row[0]))
    return sorted((row[0], links[k], least[tree.find(k)], row[0] == least[tree.find(k)]) for k, row in enumerate(rows))


@pytest.mark.parametrize("settings", [covertree.Settings(), covertree.Settings(chunk=40, sample=64, small=4), covertree.Settings(cosine=0.7, chunk=25, small=2)])
def test_vector_links_equal_brute_force(spark, settings):
    r = np.random.default_rng(3)
    rows = []
    for label in (1, 1, 1, 2, 3):
        for centre in r.standard_normal((6, 8)):
            for spread in (0.0, 0.05, 0.08, 0.3):
                for v in centre + spread * r.standard_normal((5, 8)):
                    rows.append((len(rows), [float(np.float32(x)) for x in v * r.choice([1.0, 4.0])], label, "k"))
    v = rows[0][1]
    odd = [(None, 1), ([], 1), ([0.0] * 8, 1), ([None, *v[1:]], 1), ([float("nan"), *v[1:]], 1), ([float("inf"), *v[1:]], 1), (v, None), (v[:4], 1), ([-x for x in v], 1)]
    rows += [(len(rows) + k, x, label, "k") for k, (x, label) in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, point string").repartition(4)
    got = covertree.near_copies(df, settings)
    assert sorted(tuple(x) for x in got.collect()) == brute_vectors(rows, settings.cosine)


def test_vectors_of_empty_tables_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1)] * 3, "vec_id long, embedding array<float>, label int")
    assert [tuple(x) for x in covertree.near_copies(df).collect()] == [(1, 2, 1, True)] * 3
    assert covertree.near_copies(df.limit(0)).count() == 0


def test_vectors_without_ids_name_no_component(spark):
    big = 2**53 + 1
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    near = [1.0, 0.05, 0.0]
    rows = [(None, a), (7, near), (9, [1.0, 0.0, 0.05]), (None, b), (None, [0.05, 1.0, 0.0]), (big, c), (big + 1, [0.05, 0.0, 1.0]), (None, None)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = [tuple(x) for x in covertree.near_copies(df).collect()]
    want = [(None, 2, 7, False), (7, 2, 7, True), (9, 2, 7, False), (None, 1, None, True), (None, 1, None, True)]
    want += [(big, 1, big, True), (big + 1, 1, big, False), (None, 0, None, True)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_links_of_a_block_join_whatever_they_connect():
    # Row 1 and column 1 link, but neither is the other's first: without that link there would be two components.
    hit = np.array([[0, 1], [1, 1]], bool)
    row, column = covertree.joined(hit)
    assert (row.tolist(), column.tolist()) == ([0, 0], [0, 0])
    r = np.random.default_rng(6)
    for n, m, share in [(40, 50, 0.02), (60, 60, 0.03), (30, 90, 0.01), (80, 20, 0.2)] * 5:
        hit = r.random((n, m)) < share
        tree = Union(n + m)
        for i, j in zip(*np.nonzero(hit), strict=True):
            tree.join(i, n + j)
        row, column = covertree.joined(hit)
        assert row.tolist() == [tree.find(i) for i in range(n)]
        assert [c for c in column if c < n] == [tree.find(n + j) for j in range(m) if hit[:, j].any()]
    path = np.zeros((600, 600), bool)
    order = r.permutation(600)
    path[order, order] = path[order[1:], order[:-1]] = True
    assert not covertree.joined(path)[0].any()


@pytest.mark.parametrize("same", [False, True])
def test_links_of_chunks_join_whatever_they_connect(same):
    step, n, r = np.arccos(0.985), 12, np.random.default_rng(7)
    for _ in range(50):
        turns = r.permutation(n) * step
        points = np.stack([np.cos(turns), np.sin(turns)], axis=1)
        sides = [np.arange(n)] * 2 if same else [np.flatnonzero(np.round(turns / step) % 2 == k) for k in (0, 1)]
        flat = [np.zeros((len(s), 1), np.int64) for s in sides]
        ones = [np.ones(len(s), np.int64) for s in sides]
        x, y = (points[s] for s in sides)
        _, _, edges = covertree.near_pairs(x, flat[0], y, flat[1], *ones, *sides, same, covertree.Settings())
        tree = Union(n)
        for a, b in edges:
            tree.join(a, b)
        assert {tree.find(i) for i in range(n)} == {0}


def test_chains_of_vectors_between_two_nodes_are_one_component(spark):
    # Points along an arc, each linked with its neighbours only, dealt in turn over two sides.
    step = np.arccos(0.985)
    for n in (8, 24):
        turns = [(k * 7) % n for k in range(n)]
        vectors = [[float(np.cos(t * step)), float(np.sin(t * step))] for t in turns]
        rows = [(k, v, 1, "k") for k, v in enumerate(vectors)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, point string")
        got = covertree.near_copies(df, covertree.Settings(chunk=4, small=2))
        assert sorted(tuple(x) for x in got.collect()) == brute_vectors(rows, 0.98)


def test_vectors_at_the_threshold_link(spark):
    # (49, 9, 3, 3) is 50 long: its cosine with the first axis is the threshold to the last digit.
    rows = [(1, [1.0, 0.0, 0.0, 0.0], 1), (2, [49.0, 9.0, 3.0, 3.0], 1), (3, [0.0, 0.0, 1.0, 0.0], 1), (4, [3.0, 9.0, 49.0, 3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(x) for x in covertree.near_copies(df).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False)]


def test_cover_tree_levels_are_nested_and_halve():
    r = np.random.default_rng(5)
    points = r.standard_normal((300, 6))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    paths = covertree.levels(points, covertree.Settings())
    radius = covertree.apart(points, points[0]).max()
    for k in range(paths.shape[1]):
        assert all(np.linalg.norm(points[i] - points[paths[i, k]]) <= radius / 2**k + 1e-9 for i in range(300))
        for centre in set(paths[:, k]):
            assert (paths[centre, k:] == centre).all()


# pages


@pytest.fixture(scope="module")
def forest(spark):
    return pages.fit(spark)


def test_pages_of_unseen_layouts(forest):
    right = wrong = missed = 0
    for seed in range(9_000_000, 9_000_150):
        html, wanted = layouts.page(seed)
        want, got = {" ".join(x.split()) for x in wanted}, set(pages.main_text(html, forest).split("\n")) - {""}
        right, wrong, missed = right + len(want & got), wrong + len(got - want), missed + len(want - got)
    assert right / (right + wrong) > 0.98 and right / (right + missed) > 0.98


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li>
<li><a href="/x">News</a></li></ul></nav><div class="cookie-notice"><p>We use cookies to serve you, please agree.</p></div>
<article><h1>A title &amp; more</h1><p>First   paragraph of the
text, with <b>bold</b> words and a <a href="#">link</a>.</p><div class="ad">Buy now, great offers today.</div>
<p>Second paragraph, caf&eacute; &#8212; and&nbsp;so on, long enough to count as prose.<p>Third one, unclosed, has words too.</article>
<section id="comments"><div class="comment"><p>Nice article, I liked it very much indeed.</p></div></section>
<form><p>Enter your mail</p><input></form><footer>&copy; Someone</footer></body></html>"""


def test_a_page_by_hand(spark, forest):
    df = spark.createDataFrame([(1, "u", PAGE, "k"), (2, "u", None, "k"), (3, "u", "", "k"), (4, "u", "<p", "k"), (5, None, PAGE[:700], "k")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in pages.extract_pages(df, forest).collect()}
    assert got[1].split("\n") == [
        "A title & more",
        "First paragraph of the text, with bold words and a link.",
        "Second paragraph, café — and so on, long enough to count as prose.",
        "Third one, unclosed, has words too.",
    ]
    assert got[2] == got[3] == got[4] == "" and got[5].startswith("A title & more\nFirst paragraph")
    assert pages.extract_pages(df.limit(0), forest).count() == 0


def test_share_of_sibling_tags_is_true_at_every_size():
    for n in (10, 100):
        nodes = [pages.Node("body", -1, 0)] + [pages.Node("p" if i else "heading", 0, 1) for i in range(n)]
        nodes[0].kids.extend(range(1, n + 1))
        same = pages.features(nodes)[1:, pages.NAMES.index("same")]
        assert np.allclose(same, [1 / n] + [(n - 1) / n] * (n - 1))


def test_decoding_is_the_best_consistent_labelling():
    import itertools
    import math

    r = random.Random(4)
    for _ in range(60):
        nodes = [pages.Node("body", -1, 0)]
        for i in range(1, r.randint(2, 9)):
            parents = [k for k, n in enumerate(nodes) if n.tag != "text"]
            parent = r.choice(parents)
            nodes.append(pages.Node(r.choice(["div", "text"]), parent, 1, (), "x"))
            nodes[parent].kids.append(i)
        p = [r.random() for _ in nodes]

        def value(keep, p=p):
            return sum(math.log(q if k else 1 - q) for k, q in zip(keep, p, strict=True))

        def sound(keep, nodes=nodes):
            down = all(not keep[i] or n.parent < 0 or keep[n.parent] for i, n in enumerate(nodes))
            return down and all(not keep[i] or n.tag == "text" or any(keep[k] for k in n.kids) for i, n in enumerate(nodes))

        best = max((k for k in itertools.product([False, True], repeat=len(nodes)) if sound(k)), key=value)
        got = pages.decode(nodes, np.array(p))
        assert sound(got) and abs(value(got) - value(best)) < 1e-9
