"""Spelling variants, prefix-hash fingerprints and zone-map clusters against brute force on small fixtures."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_helpers import random_words

from placeweave.llm import prefixhash, queries, variants, zonemaps
from placeweave.llm.prefixhash import Prefixes, fingerprint, likeness
from placeweave.llm.store import store
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


# spelling variants


def brute_vocabulary(docs, least=6, often=5):
    counts = collections.Counter()
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    i = 0
    while i < len(u) and u[i] == v[i]:
        i += 1
    return u[i + 1 :] == v[i + 1 :] if len(u) == len(v) else u[i:] == v[i + 1 :]


def brute_variants(counts, ratio=5):
    form, out = {}, {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], counts.get(form[w]), root)
    return out


def got_variants(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def vocabulary_table(spark, counts):
    return spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(5)


@pytest.mark.parametrize("most", [20_000, 3], ids=["whole", "split"])
def test_variants_equal_brute_force(spark, most):
    r = random.Random(3)
    counts = {}
    for _ in range(60):
        word = "".join(r.choice("abé") for _ in range(r.randint(6, 9)))
        counts[word] = 5 ** r.randint(1, 5)
        for _ in range(12):
            at, kind = r.randrange(len(word) + 1), r.randrange(3)
            other = word[:at] + ("" if kind == 0 else r.choice("abz")) + word[at + (kind < 2) :]
            if len(other) >= 6:
                counts.setdefault(other, r.randint(5, 40))
                word = r.choice([word, other])
    # A crowd that shares all but its end, one that shares all but its start, and very long words.
    counts |= {"sharedstart" + "".join(x): 5 for x in zip("aabbccdd", "abababab")}
    counts |= {"".join(x) + "sharedend": 7 for x in zip("aabbccdd", "abababab")}
    counts |= {"a" * 3000: 5, "a" * 3001: 50, "a" * 1500 + "b" + "a" * 1500: 9}
    settings = variants.Settings(most=most)
    assert got_variants(variants.variants(vocabulary_table(spark, counts), settings)) == brute_variants(counts)


def test_variants_of_a_dense_partition_are_split_without_loss(spark):
    counts = {f"same{a}{b}{c}end": 5 + (a == b == c == "a") * 100 for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"}
    got = got_variants(variants.variants(vocabulary_table(spark, counts), variants.Settings(most=20)))
    assert got == brute_variants(counts)


def test_composition_gives_each_pair_once():
    r = random.Random(9)
    for _ in range(50):
        words = sorted({"".join(r.choice("ab") for _ in range(r.randint(0, 5))) for _ in range(r.randint(0, 25))})
        pairs = [tuple(sorted(p)) for p in variants.composed(*variants.minimised(words))]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {(u, v) for u in words for v in words if u < v and one_edit(u, v)}


def test_minimised_acceptor_is_smallest():
    arcs, final = variants.minimised(["tap", "taps", "top", "tops"])
    seen, todo = {0}, [0]
    while todo:
        for to in arcs[todo.pop()].values():
            if to not in seen:
                seen.add(to)
                todo.append(to)
    assert len(seen) == 5 and sum(final[s] for s in seen) == 2


def test_words_of_texts_follow_the_stated_rule(spark):
    r = random.Random(4)
    pool = random_words(r, 30, "abcdeÉéÀ×÷ßÿ") + ["KelvinK", "İstanbul", "don't", "ABCdefGHI", "x" * 400, "straße", "ĀĀ"]
    docs = [(i, " ".join(r.choice(pool) * r.randint(1, 3) for _ in range(300))) for i in range(40)]
    docs += [(None, docs[0][1]), (1, docs[1][1]), (7, None), (8, ""), (9, "word7 " * 20_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    want = brute_vocabulary(docs)
    got = {r["word"]: r["n"] for r in variants.vocabulary(variants.words_of(df)).collect()}
    assert got == want and len(want) > 50
    assert got_variants(variants.spelling_variants(df)) == brute_variants(want)
    assert variants.spelling_variants(df.limit(0)).count() == 0


def test_op13_on_a_whole_table_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got_variants(queries.op13_spelling_variants(spark, SF)) == brute_variants(brute_vocabulary(docs))


# words that a hash modulo a power of two takes for one


def alike(n):
    """Two different words of ``n`` letters with equal polynomial hashes modulo 2 ** 64 from 1,024 letters on."""
    x, y = "a", "b"
    while len(x) < n:
        x, y = x + y, y + x
    return x, y


@pytest.mark.parametrize("n", [32, 64, 128, 512, 1024, 2048, 4096])
def test_words_of_equal_weak_hashes_are_told_apart(n):
    from placeweave.llm import bpe, jaccard

    x, y = alike(n)
    assert len(set(np.concatenate(list(jaccard.word_hashes([x, y, f"{x} {y}"]))).tolist())) == 2
    coder = queries.codec()
    for text in (f" {x} {y}", f" {y} {x}", x + y):
        assert coder.decode(coder.encode(text)) == text.encode()
    data = np.frombuffer(f"{x}{y}".encode(), np.uint8)
    assert len(set(bpe.word_names(data, np.array([0, n]), np.array([n, 2 * n])).tolist())) == 2


def test_bpe_compares_the_bytes_of_words_with_equal_names(monkeypatch):
    from placeweave.llm import bpe

    coder = queries.codec()
    monkeypatch.setattr(bpe, "word_names", lambda data, starts, stops: np.zeros(len(starts), np.uint64))
    for word in ("one", "two", "one"):
        assert coder.decode(coder.encode(word)) == word.encode()


def test_jaccard_and_line_dedup_tell_such_texts_apart(spark):
    from placeweave.llm import jaccard, repeats

    x, y = alike(1024)
    texts = [" ".join([w, "b", "c"] * 30 + [f"w{i}" for i in range(60)]) for w in (x, y)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component"] for r in jaccard.near_components(df, jaccard.Settings(percent=80)).collect()}
    words = [t.split() for t in texts]
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in words]
    assert 100 * len(sets[0] & sets[1]) < 80 * len(sets[0] | sets[1]) or got[1] == 0
    lone = spark.createDataFrame([(0, " ".join([x] * 60)), (1, " ".join([y] * 60))], "doc_id long, text string")
    assert {r["n_removed"] for r in repeats.remove_repeats(lone).collect()} == {0}


# what many spans, tags and rows cost


def test_many_parted_passages_secrets_and_stray_tags_stay_linear(spark):
    import time

    from placeweave.llm import ledger, pages, repeats

    page = "<div>" + "<b><i>x</b>" * 4000 + "</em>" * 4000 + "</p>" * 4000 + "</div>"
    started = time.perf_counter()
    assert pages.parse(page)
    assert time.perf_counter() - started < 3
    part = "k = 'api_key: " + "A" * 10 + "' "
    df = spark.createDataFrame([(part * 3_000,)], "text string")
    found = store(ledger.scan(df, ledger.Ledger(spark)), "found")
    started = time.perf_counter()
    (row,) = found.select(ledger.redact(F.col("text"), F.col("found")).alias("t"), F.size("found").alias("n")).collect()
    assert row["n"] == 3_000 and "A" * 8 not in row["t"] and row["t"].count("[ASSIGN]") == 3_000
    assert time.perf_counter() - started < 10
    unit = " ".join(f"w{i}" for i in range(60))
    lines = [(1, unit), (2, "\n".join(f"{unit}\nown{i}" for i in range(1000)))]
    got = repeats.remove_repeats(spark.createDataFrame(lines, "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[1]["n_removed"] == 1000 and got[1]["text"] == "\n".join(f"own{i}" for i in range(1000))


def test_redaction_of_overlapping_spans_over_groups(spark, monkeypatch):
    from placeweave.llm import ledger

    r = random.Random(3)
    for size in (1, 2, 3, 128):
        monkeypatch.setattr(ledger, "SPANS_AT_ONCE", size)
        rows = []
        for _ in range(20):
            text = "".join(r.choice("abcé🙂 ") for _ in range(60))
            spans = sorted((a, min(60, a + r.randint(1, 25)), r.choice(["hex", "jwt"])) for a in (r.randrange(60) for _ in range(r.randint(0, 7))))
            want, at = "", 0
            for a, b, kind in spans:
                if a >= at:
                    want += text[at:a] + f"[{kind.upper()}]"
                at = max(at, b)
            rows.append((text, [{"kind": k, "start": a, "end": b} for a, b, k in spans], want + text[at:]))
        df = spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:long,end:long>>, want string")
        assert df.filter(ledger.redact(F.col("text"), F.col("spans")) != F.col("want")).count() == 0


def test_chat_roles_of_any_characters_read_back(spark):
    from placeweave.llm import chat

    roles = ["a\0b", "\\", "\\n", "\n", "\\\n", "a\\\\nb\0\n", "<|im_end|>", "<\\|", ""]
    df = spark.createDataFrame([(1, i, role, f"t{i}") for i, role in enumerate(roles)], "conv_id long, turn long, role string, text string")
    (row,) = chat.format_conversations(df).select(chat.read_turns(F.col("formatted")).alias("t")).collect()
    assert [t["role"] for t in row["t"]] == roles


def test_quality_sample_takes_one_text_of_a_labelled_id(spark):
    from placeweave.llm import quality

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)] * 3, "doc_id long, quality int")
    settings = quality.Settings(per_class=10)
    rows = quality.labelled_sample(docs, labels, settings).collect()
    kept = [i for i in (1, 2) if zlib.crc32(str(i).encode()) % 5]
    assert len(rows) == len(kept)


def test_pipeline_drops_near_copies_by_row(spark):
    import corpus_pipeline as p
    from placeweave.llm.store import store

    r = random.Random(4)
    a, b, c = (" ".join(random_words(r, 80)) for _ in range(3))
    rows = [(1, a), (2, a), (2, b), (None, c), (None, c), (5, b + " x"), (None, None), (6, ""), (1, a)]
    docs = store(spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, row_number string").repartition(3), "docs")
    kept = [(x["doc_id"], x["text"]) for x in p.near_duplicate_stage(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted([(1, a), (2, b), (None, c), (None, None), (6, "")], key=repr)
    assert p.near_duplicate_stage(spark, docs.limit(0), "").count() == 0


# fingerprints


def test_span_hashes_and_extensions_equal_string_comparison():
    r = random.Random(1)
    for _ in range(40):
        a = "".join(r.choice("ab\0🙂") for _ in range(r.randint(0, 60)))
        b = a[r.randint(0, 5) :] + r.choice(["", "a", "bb"]) + a[: r.randint(0, 9)]
        x, y = Prefixes(a), Prefixes(b)
        for _ in range(30):
            i, j, n = r.randint(0, 62), r.randint(0, 62), r.randint(0, 20)
            inside = i + n <= len(a) and j + n <= len(b)
            assert x.equal(i, y, j, n) == (inside and a[i : i + n] == b[j : j + n])
            want = 0
            while i + want < len(a) and j + want < len(b) and a[i + want] == b[j + want]:
                want += 1
            assert x.extension(i, y, j) == want


def test_span_hash_is_the_polynomial():
    text = "prefix hash ünder 三 primes"
    for k, (p, base) in enumerate(zip(prefixhash.PRIMES, prefixhash.BASES)):
        assert int(Prefixes(text).span(3, 11, k)) == sum((ord(c) + 1) * pow(base, t, p) for t, c in enumerate(text[3:11])) % p


def test_texts_that_defeat_a_hash_modulo_a_power_of_two_differ():
    x, y = "a", "b"
    for _ in range(12):
        x, y = x + y, y + x
        assert fingerprint(Prefixes(x)).split(":")[1] != fingerprint(Prefixes(y)).split(":")[1]


def test_likeness_follows_what_texts_share():
    r = random.Random(2)
    for n in (1, 3, 8, 40, 300, 5000):
        words = " ".join(random_words(r, n))
        same = fingerprint(Prefixes(words))
        assert likeness(same, fingerprint(Prefixes(words))) == 1.0
        other = " ".join(random_words(r, n, "qrstuvwxyz"))
        assert likeness(same, fingerprint(Prefixes(other))) <= 0.15
        changed = prefixhash.edited(words, other)
        if len(words) >= 8:
            assert 0.6 <= likeness(same, fingerprint(Prefixes(changed))) < 1.0
    middle = words[:9000] + "#" + words[9001:]
    assert likeness(same, fingerprint(Prefixes(middle))) > 0.9
    assert likeness(fingerprint(Prefixes("")), fingerprint(Prefixes(""))) == 1.0
    assert likeness(fingerprint(Prefixes("")), same) == 0.0


def test_op11_contract_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(prefixhash, "RANGE_BYTES", 2000)
    r = random.Random(8)
    docs = [(i * 3, " ".join(random_words(r, r.choice([0, 1, 5, 60, 200])))) for i in range(150)]
    docs += [(500, "word " * 40_000), (501, None), (502, "🙂é" * 50), (30, docs[10][1]), (30, docs[10][1]), (30, "other"), (None, "last")]
    docs += [(61, "all the same text") for _ in range(200)] + [(91, f"same id {i}") for i in range(200)]
    df = spark.createDataFrame([(i, t, "x", 2) for i, t in docs], "doc_id long, text string, fingerprint string, range int")
    df = store(df.repartition(7), "texts")  # the operator's input must read the same twice
    bounds = []
    monkeypatch.setattr(prefixhash, "_bounds", lambda light, made=prefixhash._bounds: bounds.extend(made(light)) or bounds)
    got = prefixhash.with_next(df).collect()
    assert len(got) == len(docs) and len(bounds) > 20
    by_row = collections.defaultdict(list)
    for g in got:
        by_row[g["doc_id"]].append(g)
    # Within one id any order will do as long as it is one order: the chain of a text and its edited text must hold.
    order = sorted({i for i, _ in docs if i is not None}) + [None]
    texts = collections.defaultdict(list)
    for i, t in docs:
        texts[i].append(t or "")
    prints = {fingerprint(Prefixes(t or "")) for _, t in docs}
    assert {g["fingerprint"] for g in got} == prints
    for at, key in enumerate(order):
        mine, following = texts[key], texts[order[(at + 1) % len(order)]]
        assert sorted(len(t) for t in mine) == sorted(g["n_chars"] for g in by_row[key])
        if len(mine) == 1 and len(following) == 1:
            (g,) = by_row[key]
            cut = len(mine[0]) // 4
            want = mine[0][: len(mine[0]) - cut] + following[0][:cut]
            assert g["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest()
            assert g["edited_fingerprint"] == fingerprint(Prefixes(want))
            assert g["near_edited"] == likeness(g["fingerprint"], g["edited_fingerprint"])
            assert g["near_next"] == likeness(g["fingerprint"], fingerprint(Prefixes(following[0])))
    # Of the texts that are all the same, all but one have an equal next text.
    assert sum(g["near_next"] == 1.0 for g in by_row[61]) == 199
    # Rows of one id follow each other: every row but one has another row of its id as its next.
    hashes = {t: fingerprint(Prefixes(t)) for t in texts[91]}
    edits = {hashlib.sha256(prefixhash.edited(a, b).encode()).hexdigest() for a in texts[91] for b in texts[91] if a != b}
    assert len(hashes) == 200 and sum(g["edited_sha256"] in edits for g in by_row[91]) >= 199


def test_op11_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(5, "only one")], "doc_id long, text string")
    (row,) = prefixhash.with_next(one).collect()
    assert (row["near_next"], row["common_next"], row["n_chars"]) == (1.0, 8, 8)
    assert prefixhash.with_next(one.limit(0)).count() == 0


def test_op11_on_a_whole_table_equals_plain_python(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = {}
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        changed = prefixhash.edited(t, after)
        want[i] = (len(t), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(Prefixes(t)), fingerprint(Prefixes(changed)))
    got = queries.op11_prefix_fingerprints(spark, SF).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in got} == want


def test_span_queries_as_columns(spark):
    df = spark.createDataFrame([("abcde", "xxabcdz", 0, 2, 4), ("abc", None, 0, 0, 0), ("abc", "abc", None, 0, 1), ("ab", "ab", 1, 1, 2)], "a string, b string, i long, j long, n long")
    got = prefixhash.equal_spans(prefixhash.common_extensions(df, "a", "b", "i", "j"), "a", "b", "i", "j", "n")
    assert [(r["extension"], r["equal"]) for r in got.collect()] == [(4, True), (0, True), (None, None), (1, False)]


# clusters


def test_hilbert_curve_visits_every_cell_in_steps_of_one():
    for axes, bits in ((2, 4), (3, 3), (1, 5), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        keys = zonemaps.hilbert(grid, bits)
        assert len(set(keys)) == len(grid)
        walk = grid[np.array(sorted(range(len(grid)), key=keys.__getitem__))]
        assert (abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_never_lose_the_nearest_centroid():
    r = np.random.default_rng(5)
    for scale in (3, 1000, zonemaps.LARGEST):
        centroids = r.integers(-scale, scale, (8, 6))
        centroids[7] = centroids[2]
        rows = r.integers(-scale, scale, (6, 1, 6)) // 2 + r.integers(-max(1, scale // 20), max(1, scale // 20) + 1, (6, 40, 6))
        maybe = zonemaps.candidates(rows.min(axis=1), rows.max(axis=1), centroids)
        for some, block in zip(maybe, rows):
            chosen = np.flatnonzero(some)
            best, apart = zonemaps.nearest(block, centroids[chosen])
            every = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in centroids] for x in block]
            assert [chosen[b] for b in best] == [row.index(min(row)) for row in every]
            assert apart.tolist() == [min(row) for row in every]


def brute_clusters(rows, settings):
    kept = []
    for i, v in rows:
        if v is None or len(v) != settings.width or any(x is None or not np.isfinite(x) for x in v):
            continue
        top = zonemaps.LARGEST
        kept.append((i, [int(np.floor(min(max(settings.scale * float(x), -top), top))) for x in v]))
    first = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in first[: settings.clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(settings.rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = [sum(d for _, d, c in found if c == k) for k in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums), names[c]) for i, d, c in found), key=repr)


@pytest.mark.parametrize("scale", [1.0, 40_000.0], ids=["doubles", "longs"])
def test_clusters_equal_brute_force(spark, scale):
    r = np.random.default_rng(6)
    settings = zonemaps.Settings(width=5, clusters=8, rounds=4, block=16, axes=3, bits=3, sample=100)
    middles = r.normal(size=(6, 5))
    vectors = [(i, (scale * (middles[i % 6] + 0.1 * r.normal(size=5))).tolist()) for i in range(400)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(150)] + [(7, vectors[1][1]), (7, vectors[2][1]), (None, vectors[3][1]), (None, vectors[4][1])]
    vectors += [(1, None), (2, [1.0] * 4), (3, [1.0, None, 1.0, 1.0, 1.0]), (4, [float("nan")] * 5), (5, [float("-inf")] + [0.0] * 4), (6, [])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], "vec_id long, embedding array<double>, cluster string, id string").repartition(4)
    got = zonemaps.clustered(df, settings)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute_clusters(vectors, settings)


def test_clusters_of_few_vectors_of_none_and_of_huge_ones(spark):
    settings = zonemaps.Settings(width=2, rounds=2)
    rows = [(1, [0.5, 1e300]), (2, [-1e300, 0.0]), (3, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, zonemaps.clustered(df, settings).collect()), key=repr) == brute_clusters(rows, settings)
    assert zonemaps.clustered(df.limit(0), settings).count() == 0


def test_clustered_vectors_leave_few_candidates(spark):
    r = np.random.default_rng(7)
    middles = r.normal(size=(8, 16)) * 10
    rows = [(i, (middles[i % 8] + r.normal(size=16) * 0.1).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    settings = zonemaps.Settings(width=16, block=64)
    done = zonemaps.cluster(zonemaps.integers(df, settings), settings)
    assert done.pairs_kept < 0.5 and done.vectors_read < 0.7
