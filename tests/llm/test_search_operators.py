"""Dedup, join, packing and media operators against brute force, and on odd rows."""

import itertools
import pathlib
import random
import urllib.parse

import duckdb
import numpy as np
import pytest

from babelmill.llm import candidates, grams, jaccard, jpeg, lines, packing, superkmers, tiles
from babelmill.llm.components import components
from babelmill.llm.text import mix

from .rows import SCHEMA, frame, words

ODD = [(901, None), (902, ""), (903, " \n \t"), (None, "one line\nof a row without id"), (None, "one line\nof a row without id"), (None, None), (904, "a"), (905, "b c")]


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def edited(text, rate, seed):
    rng = random.Random(seed)
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < rate else w for w in text.split(" "))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(70)] + [(i, i + 1) for i in range(200, 240)] + [(7, 7), (None, 3), (200, 201)]
    known = [(a, b) for a, b in edges if a is not None and a != b]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == roots({x for e in known for x in e}, known)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts():
    texts = dict(enumerate(words(60 + 40 * (i % 5), i) for i in range(24)))
    for i in range(24, 48):
        texts[i] = edited(texts[i % 12], (0.0, 0.01, 0.03, 0.05, 0.3)[i % 5], i)
    hot = words(90, 99)
    for i in range(100, 130):
        texts[i] = edited(hot, 0.04, i)
    return texts


def test_jaccard_groups_against_brute_force(spark):
    texts = near_texts()
    docs = frame(spark, [*ODD, *texts.items(), (30, texts[30])])
    rows = jaccard.duplicate_groups(docs).collect()
    sets = {i: jaccard.word_ngrams(t) for i, t in texts.items()}
    index = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(texts, 2)}
    root = roots(texts, [p for p, j in index.items() if j >= jaccard.LEAST])
    want = {(i, r) for i, r in root.items() if list(root.values()).count(r) > 1}
    got = {(r["doc_id"], r["group_id"]) for r in rows}
    assert len(got & want) >= 0.97 * len(want) and not got - want
    partners = {i: [(-j, b if a == i else a) for (a, b), j in index.items() if i in (a, b) and j >= jaccard.LEAST] for i in texts}
    for r in rows:  # within a group no link is lost, and the partner is the closest of all
        assert r["links"] == len(partners[r["doc_id"]])
        assert (pytest.approx(-r["jaccard"]), r["partner_id"]) == min(partners[r["doc_id"]])
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    gone = {i for i, r in got if i != r}
    assert sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == sorted(i or 0 for i, _ in [*ODD, *texts.items(), (30, 0)] if i not in gone)


def test_no_pair_at_the_threshold_is_left_out(spark):
    texts = {}
    for i in range(600):
        both = 60 + i % 300
        own = int((both - 2) * 0.45 / 1.1)  # n-grams that each holds alone: the index is 0.55 and hardly more
        base = words(both, 7000 + i, 10**6)
        texts[2 * i] = f"{base} {words(own, 8000 + i, 10**6)}"
        texts[2 * i + 1] = f"{base} {words(own, 9000 + i, 10**6)}"
    sets = {i: jaccard.word_ngrams(t) for i, t in texts.items()}
    want = {i for i in texts if len(sets[i] & sets[i ^ 1]) / len(sets[i] | sets[i ^ 1]) >= jaccard.LEAST}
    rows = jaccard.duplicate_groups(frame(spark, texts.items())).collect()
    assert len(want) > 1000 and {r["doc_id"] for r in rows} == want, (len(want), len(rows))
    assert all(r["links"] == 1 and r["partner_id"] == r["doc_id"] ^ 1 for r in rows)


def test_jaccard_on_odd_rows(spark):
    assert jaccard.duplicate_groups(frame(spark, ODD)).count() == 0
    same = [(8, "x"), (9, "x"), (8, "x"), (10, "x y"), (11, "x  y")]
    got = {(r["doc_id"], r["group_id"]) for r in jaccard.duplicate_groups(frame(spark, [*ODD, *same])).collect()}
    assert got == {(8, 8), (9, 8), (10, 10), (11, 10)}
    assert jaccard.duplicate_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_count_copies(spark):
    base = words(120, 7)
    texts = {i: base for i in range(5)} | {i: edited(base, 0.03, i) for i in range(5, 9)} | {9: edited(base, 0.03, 5), 10: words(120, 8)}
    found = {r["doc_id"]: r for r in jaccard.duplicate_groups(frame(spark, texts.items())).collect()}
    sets = {i: jaccard.word_ngrams(t) for i, t in texts.items()}
    for i in texts:
        linked = [j for j in texts if j != i and len(sets[i] & sets[j]) >= jaccard.LEAST * len(sets[i] | sets[j])]
        assert found[i]["links"] == len(linked) if linked else i not in found
    assert found[0]["partner_id"] == 1 and found[3]["partner_id"] == 0 and found[3]["jaccard"] == 1


def test_groups_of_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(tiles, "CHUNK_BYTES", 4000)
    base = words(100, 17)
    texts = {i: edited(base, 0.02 + 0.02 * (i % 4), i) for i in range(60)}
    sets = {i: jaccard.word_ngrams(t) for i, t in texts.items()}
    rows = jaccard.duplicate_groups(frame(spark, texts.items())).collect()
    assert len(rows) > 50
    for r in rows:
        i = r["doc_id"]
        near = [(-len(sets[i] & sets[j]) / len(sets[i] | sets[j]), j) for j in texts if j != i]
        assert r["links"] == sum(-x >= jaccard.LEAST for x, _ in near) and r["partner_id"] == min(near)[1]


@pytest.mark.parametrize("least", [0.55, 0.7, 0.9])
def test_prefixes_miss_no_pair(spark, least):
    rng = random.Random(int(least * 100))
    made = {}
    for i in range(150):
        old = rng.choice(list(made.values())) if made and rng.random() < 0.7 else words(rng.randrange(5, 60), i, 40)
        made[i] = edited(old, rng.choice((0.0, 0.05, 0.2)), i)
    sets = {i: jaccard.word_ngrams(t) for i, t in made.items()}
    want = {(a, b) for a, b in itertools.combinations(made, 2) if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}
    how = candidates.Sets(jaccard.word_ngrams, lambda x: (lambda t, g: (t, mix(g, 13)))(*grams.gram_sets(x)))
    items = spark.createDataFrame(list(made.items()), "id long, text string")
    members = spark.createDataFrame([(i, i) for i in made], "member long, root long")
    got = {(r["a"], r["b"]) for r in candidates.by_prefix(members, items, 4, how, least).collect()}
    assert len(want) > 20 and want <= got and len(got) < 4 * len(want)


def written(spark, work):
    """Bytes that a query writes to shuffles and checkpoints, where no table is small enough to be broadcast by itself."""
    folder = pathlib.Path(urllib.parse.urlparse(spark.sparkContext._jsc.sc().getCheckpointDir().get()).path)
    store = spark.sparkContext._jsc.sc().statusStore()

    def now():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        held = store.executorList(False)
        return sum(held.apply(i).totalShuffleWrite() for i in range(held.size())) + sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        before = now()
        return work(), now() - before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def long_words(n, seed):
    rng = random.Random(seed)
    return " ".join(f"{rng.getrandbits(400):x}" for _ in range(n))


def unlike_texts():
    """Texts of which two and two share keys (60 % of their words) but are unlike, and two that are alike."""
    texts = {}
    for i in range(0, 300, 2):
        both = long_words(90, i)
        texts |= {i: both + " " + long_words(60, 1000 + i), i + 1: both + " " + long_words(60, 2000 + i)}
    return texts | {300: texts[0] + " x", 301: "y " + texts[7]}


def test_texts_that_only_share_keys_are_not_written(spark):
    texts = unlike_texts()
    docs = frame(spark, texts.items())
    kept, cost = written(spark, lambda: {r["doc_id"] for r in jaccard.keep_one(docs).select("doc_id").collect()})
    assert kept == set(range(300))
    assert cost < 0.6 * sum(map(len, texts.values())), cost


def test_only_texts_of_groups_are_compared(spark):
    texts = unlike_texts()
    docs = frame(spark, texts.items())
    rows, cost = written(spark, lambda: jaccard.duplicate_groups(docs).collect())
    assert {(r["doc_id"], r["group_id"], r["links"], r["partner_id"]) for r in rows} == {(0, 0, 1, 300), (300, 0, 1, 0), (7, 7, 1, 301), (301, 7, 1, 7)}
    assert cost < 0.6 * sum(map(len, texts.values())), cost


def test_clusters_are_sketched_once_a_text(spark, monkeypatch):
    asked = []
    plain = jaccard.matched

    def counted(found, items, partitions, sets, least, prune):
        def counting(pairs):
            asked.append(pairs.count())
            return prune(pairs)

        return plain(found, items, partitions, sets, least, counting)

    monkeypatch.setattr(jaccard, "matched", counted)
    texts = {}
    for i in range(84):
        own = words(200, i // 14, 5000)
        texts[i] = edited(own, 0.02, i)
    kept = {r["doc_id"] for r in jaccard.keep_one(frame(spark, texts.items())).select("doc_id").collect()}
    assert kept == {0, 14, 28, 42, 56, 70}
    assert sum(asked) < 2 * len(texts), asked


def test_texts_of_groups_travel_few_times(spark):
    texts = {}
    for i in range(0, 120, 2):
        both = long_words(90, i)
        texts |= {i: both, i + 1: both + " x"}
    rows, cost = written(spark, lambda: jaccard.duplicate_groups(frame(spark, texts.items())).collect())
    assert {(r["doc_id"], r["group_id"], r["links"], r["partner_id"]) for r in rows} == {(i, i & ~1, 1, i ^ 1) for i in texts}
    assert cost < 4.2 * sum(map(len, texts.values())), cost


@pytest.mark.parametrize("small", [2, 16])
def test_listed_pairs_miss_none(monkeypatch, small):
    monkeypatch.setattr(candidates, "SMALL", small)
    rng = np.random.default_rng(small)
    for least in (0.55, 0.9):
        key = np.sort(rng.integers(0, 60, 900).astype(np.uint32))
        member = np.concatenate([np.sort(rng.choice(400, n, replace=False)) for n in np.unique(key, return_counts=True)[1]]).astype(np.int64)
        size = (10 * rng.integers(1, 9, 400))[member] * np.where(key % 3 == 0, 1, 3)
        reach = np.where(key % 5 == 0, size, (size * rng.uniform(least, 1, 900)).astype(np.int64))
        gid, a, b = candidates.listed(key, member, size, reach, least)
        whole = {g: set(a[gid == g].tolist()) | set(b[gid == g].tolist()) for g in set(gid[gid != 0].tolist())}
        got = set(zip(a[gid == 0].tolist(), b[gid == 0].tolist()))
        want = set()
        for i, j in itertools.combinations(range(900), 2):
            if key[i] == key[j] and min(size[i], size[j]) >= least * max(size[i], size[j]) - 1e-6:
                if min(reach[i], reach[j]) >= least / (1 + least) * (size[i] + size[j]) - 1e-6:
                    want.add((member[i], member[j]))
        assert len(want) > 100 and got <= want and (whole or small > 2)
        assert all(pair in got or any(x.issuperset(pair) for x in whole.values()) for pair in want)


@pytest.mark.parametrize("least", [0.55, 0.7, 0.9])
def test_near_sets_share_what_is_asked(least):
    rng = np.random.default_rng(int(least * 100))
    more = 0
    for _ in range(4000):
        x = rng.integers(1, 400)
        y = rng.integers(max(1, int(least * x)), int(x / least) + 1)
        low = max(0, int(np.ceil(least / (1 + least) * (x + y) - 1e-6)))
        both = rng.integers(low, min(x, y) + 1) if low <= min(x, y) and rng.random() < 0.5 else low
        if both > min(x, y):
            continue
        order = np.arange(x + y - both)  # the common elements come last more often than not
        common = order[-both:] if rng.random() < 0.5 else rng.choice(order, both, replace=False)
        lone = rng.permutation(np.setdiff1d(order, common))
        a, b = np.sort(np.append(common, lone[: x - both])), np.sort(np.append(common, lone[x - both :]))
        reach, asked = candidates.demand(np.int64(x), np.int64(y), least)
        in_a, in_b = a[: max(0, x - reach + 1)], b[: max(0, y - reach + 1)]
        assert len(in_a) <= candidates.held_back(np.int64(x), least) and len(in_b) <= candidates.held_back(np.int64(y), least)
        assert len(np.intersect1d(in_a, in_b)) >= asked
        more += asked > 1
    assert more > 300


def test_pairs_that_share_an_element_by_chance_are_not_listed(spark):
    """60 texts of which any two share one rare 3-gram, and a near copy of each fourth."""
    own = {i: [words(3, 1000 * min(i, j) + max(i, j), 10**9) for j in range(60) if j != i] for i in range(60)}
    texts = {i: " ".join(random.Random(i).sample(parts, len(parts))) for i, parts in own.items()}
    texts |= {100 + i: edited(texts[i], 0.02, i) for i in range(0, 60, 4)}
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    elements = lambda x: (lambda t, g: (t, mix(g, 13)))(*grams.gram_sets(x))
    got = {(r["a"], r["b"]) for r in candidates.prefix_pairs(docs, 4, elements, 0.55).collect()}
    assert got == {(i, 100 + i) for i in range(0, 60, 4)}
    members = spark.createDataFrame([(i, i) for i in texts], "member long, root long")
    how = candidates.Sets(jaccard.word_ngrams, elements)
    assert {(r["a"], r["b"]) for r in candidates.by_prefix(members, docs, 4, how, 0.55).collect()} == got


def test_templated_lines_cost_no_square(spark, monkeypatch):
    seen = []
    plain = candidates.rest

    def counted(*args):
        seen.append(plain(*args).count())
        return plain(*args)

    monkeypatch.setattr(candidates, "rest", counted)
    rng = random.Random(4)
    for n in (800, 1600, 3200):
        made = ["The record was updated by the user " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=24)) for _ in range(n)]
        made[n // 2] = made[3][:-1] + "X"
        got = {(r["doc_id"], r["line_no"]) for r in lines.duplicate_lines(frame(spark, [(1, "\n".join(made))])).collect()}
        assert (1, n // 2) in got
    assert all(b <= 2.2 * max(a, 50) for a, b in zip(seen, seen[1:]))


def test_sketch_distance_bounds_the_difference():
    rng = np.random.default_rng(2)
    import pyarrow as pa

    for n in (10, 300, 2000):
        a = np.unique(rng.integers(0, 1 << 44, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 44, n // 3).astype(np.uint64)]))
        x, y = (pa.array([jaccard.dense_sketch(s, 0.55).tobytes()]) for s in (a, b))
        assert jaccard.hamming(x, y)[0] <= len(np.setxor1d(a, b))


def test_long_texts_join(spark):
    long = words(30_000, 3, 10**6)
    rows = [(1, long), (2, edited(long, 0.02, 1)), (3, words(30_000, 4, 10**6))]
    got = {(r["doc_id"], r["group_id"]) for r in jaccard.duplicate_groups(frame(spark, rows)).collect()}
    assert got == {(1, 1), (2, 1)}


def line_texts():
    pool = [words(4 + i % 30, 500 + i) for i in range(30)]
    rng = random.Random(5)
    out = {}
    for i in range(40):
        chosen = [edited(rng.choice(pool), 0.04, i * 50 + j) if rng.random() < 0.5 else words(12, i * 99 + j) for j in range(6)]
        out[i] = "\n".join([*chosen, "", "The same line in every one of the documents.", "}"])
    return out


def test_lines_against_brute_force(spark):
    texts = line_texts()
    docs = frame(spark, [*ODD, *texts.items(), (7, texts[7])])
    got = {(r["doc_id"], r["line_no"]) for r in lines.duplicate_lines(docs).collect()}
    known = [(i, n, line) for i, t in sorted(texts.items()) for n, line in enumerate(t.split("\n")) if line.strip()]
    known += [(904, 0, "a"), (905, 0, "b c")]
    sets = [lines.line_shingles(x) for _, _, x in known]
    edges = [(a, b) for a, b in itertools.combinations(range(len(known)), 2) if len(sets[a] & sets[b]) >= lines.LEAST * len(sets[a] | sets[b])]
    root = roots(range(len(known)), edges)
    best = {}
    for k, r in root.items():
        best[r] = min(best.get(r, known[k]), known[k])
    want = {known[k][:2] for k, r in root.items() if known[k] != best[r]}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)


def test_packed_shingles_are_the_set():
    rng = random.Random(9)
    made = ["".join(rng.choices("abé漢" if i % 3 else "ab", k=rng.randrange(40))) for i in range(200)]
    for x, y in zip(made, made[1:] + made[:1]):
        a, b = lines.packed_shingles(x), lines.packed_shingles(y)
        assert lines.packed_size(a) == len(lines.line_shingles(x))
        assert lines.packed_overlap(a, b) == len(lines.line_shingles(x) & lines.line_shingles(y))


def test_lines_of_other_blanks_and_spellings(spark):
    rows = [(1, "the same line of many words in two texts"), (2, "the same line of many words in two texts\n\u00a0"), (3, "\n \n")]
    docs = spark.createDataFrame([(i, t, len(t), 1, 2) for i, t in rows], "Doc_ID long, Text string, N_Chars int, _owner int, _GONE int")
    out = lines.drop_duplicate_lines(docs)
    assert out.columns == docs.columns
    assert sorted((r[0], r[1], r[2]) for r in out.collect()) == [(1, rows[0][1], 40), (2, "\u00a0", 1), (3, "\n \n", 3)]


def test_lines_are_dropped(spark):
    rows = [(1, "first line here\n\nsecond line here"), (2, "first line here\nonly in the second"), (3, "second line here\n \nfirst line here"), (3, "second line here\n \nfirst line here"), (None, "first line here"), (6, None), (7, ""), (8, " \n"), (9, "x" * 300_000)]
    out = lines.drop_duplicate_lines(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["n_chars"]) for r in out.collect())
    assert got == sorted([(1, rows[0][1], len(rows[0][1])), (2, "only in the second", 18), (0, "first line here", 15), (6, "", None), (7, "", 0), (8, " \n", 2), (9, "x" * 300_000, 300_000)])
    assert lines.drop_duplicate_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeats_equal_sql_and_brute_force(spark):
    shared = words(120, 6)
    rows = [(i, words(80, i) + "\n" + (shared if i % 2 else words(130, i + 70)) + "  " + words(60, i + 30)) for i in range(10)]
    rows += [*ODD, (20, "a " * 400), (21, words(50, 1)), (22, words(50, 1)), (22, words(50, 1)), (23, words(49, 1))]
    docs = frame(spark, rows)
    got = sorted(tuple(r) for r in superkmers.repeated_spans(docs).collect())
    con = duckdb.connect()
    documents = docs.select("doc_id", "text").toPandas()
    con.register("documents", documents)
    assert got == sorted(con.sql(superkmers.ORACLE).fetchall())
    for most in (0, 1, 3):  # all or some minimisers are hot
        assert got == sorted(tuple(r) for r in superkmers.repeated_spans(docs, most=most).collect())
    windows = {}
    for i, t in sorted(set(rows), key=str):
        if i is not None and t:
            parts = t.split()
            for j in range(len(parts) - 49):
                windows.setdefault(tuple(parts[j : j + 50]), []).append((i, j))
    covered = {(i, w) for places in windows.values() if len(places) > 1 for i, j in places for w in range(j, j + 50)}
    assert {(i, w) for i, a, b, _, _ in got for w in range(a, b)} == covered
    assert {c for i, _, _, c, _ in got if i == 20} == {351}
    assert superkmers.repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lone_strings_repeat_their_own_windows(spark):
    lines = ["a " * 51, "b " * 60, "c " * 92, "d " * 50, "ee " * 55, "f g " * 27, "h i j k l m n " * 9]
    docs = frame(spark, list(enumerate(lines)))
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    want = sorted(con.sql(superkmers.ORACLE).fetchall())
    assert (1, 0, 50, 11, True) in want and {r[0] for r in want} == {0, 1, 2, 4, 5, 6}
    assert sorted(tuple(r) for r in superkmers.repeated_spans(docs).collect()) == want


def test_windows_whose_hashes_collide(monkeypatch):
    monkeypatch.setattr(superkmers, "span_hash", lambda sums, a, b: np.zeros(len(a), np.uint64))
    strings = [b"a b c", b"a b d", b"a b c"]
    found = superkmers.count_windows(strings, np.zeros(3, np.int64), np.array([1, 2, 3]), np.zeros(3, np.int64), 3)
    assert sorted(zip(*(x.tolist() for x in found))) == [(1, 0, 0, 2, 1), (3, 0, 0, 2, 0)]


def test_packing_fills_windows_along_paths(spark):
    texts = near_texts()
    rows = [*texts.items(), *ODD, (12, texts[12]), (200, words(5000, 8))]
    out = [tuple(r) for r in packing.pack_documents(frame(spark, rows), window=64).collect()]
    sizes = {}
    for window, place, doc, a, b in out:
        sizes.setdefault(window, []).append((place, place + b - a))
    last = max(sizes)
    assert sorted(sizes) == list(range(last + 1))
    for window, spans in sizes.items():
        spans.sort()
        assert all(x[1] == y[0] for x, y in itertools.pairwise(spans)) and spans[0][0] == 0
        assert spans[-1][1] == 64 or window == last
    words_of = {}
    for i, t in rows:
        if i is not None and t is not None:
            words_of[i] = words_of.get(i, 0) + len(t.split())
    got = {}
    for _, _, doc, a, b in out:
        got[doc] = got.get(doc, 0) + b - a
    assert got == {i: n for i, n in words_of.items() if n}
    order = list(dict.fromkeys(doc for _, _, doc, _, _ in sorted(out)))
    at = [order.index(i) for i in range(100, 130)]
    assert max(at) - min(at) == 29
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nearest_neighbours_have_recall(spark):
    texts = near_texts()
    docs = frame(spark, list(texts.items())).selectExpr("doc_id as id", "text")
    sets = {i: jaccard.word_ngrams(t) for i, t in texts.items()}
    index = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    best = {a: max(index(a, b) for b in texts if b != a) for a in texts}
    found = {}
    for r in packing.neighbours(docs).collect():
        found[r["a"]] = max(found.get(r["a"], 0), index(r["a"], r["b"]))
    related = [a for a in texts if best[a] >= 0.5]
    assert sum(found.get(a, 0) >= best[a] - 0.1 for a in related) / len(related) >= 0.9


@pytest.mark.parametrize("count", [30, 2500])
def test_nearest_neighbours_of_large_groups(spark, count):
    hot = words(200, 77)
    texts = {i: edited(hot, 0.04, i) for i in range(count)}
    docs = frame(spark, [*texts.items(), (3, texts[3])]).selectExpr("doc_id as id", "text")
    sets = {i: jaccard.word_ngrams(t) for i, t in texts.items()}
    found = {}
    for r in packing.neighbours(docs).collect():
        found.setdefault(r["a"], {})[r["b"]] = r["similarity"]
    hits = total = 0
    for a in range(0, count, max(1, count // 60)):
        index = {b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in texts if b != a}
        last = sorted(index.values())[-packing.NEAREST]
        assert all(abs(index[b] - x) < 1e-9 for b, x in found[a].items()) and len(found[a]) <= packing.NEAREST
        hits += sum(index[b] >= last for b in found[a])
        total += packing.NEAREST
    assert hits / total >= 0.9


def test_packing_groups_hold_all_pairs_of_a_bucket(spark):
    shared = words(40, 1)  # of all documents, so that unlike ones meet in buckets
    texts = {i: f"{shared} {words(150, 1000 + i)}" for i in range(150)}
    for i in range(150, 450):
        texts[i] = edited(texts[i - 150 if i < 300 else i - 300], 0.17 + 0.01 * (i % 3), i)
    sets = {i: jaccard.word_ngrams(t) for i, t in texts.items()}
    alike = [(a, b) for a, b in itertools.combinations(texts, 2) if len(sets[a] & sets[b]) >= packing.LEAST * len(sets[a] | sets[b])]
    docs = frame(spark, [*texts.items(), *ODD]).selectExpr("doc_id as id", "text")
    root = {r["node"]: r["root"] for r in packing.grouped_documents(docs).collect()}
    held = sum(root.get(a, -1) == root.get(b, -2) for a, b in alike)
    assert len(alike) > 250 and held >= 0.97 * len(alike), (held, len(alike))  # with three neighbours a bucket 267 of 282


def test_spanning_pairs_connect_all_that_agree():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, (12, packing.SIGNATURE), dtype=np.uint8)
    rows = base[rng.integers(0, 12, 300)]
    rows = np.where(rng.random(rows.shape) < 0.5, rng.integers(0, 256, rows.shape, dtype=np.uint8), rows)
    agree = [(a, b) for a, b in itertools.combinations(range(300), 2) if (rows[a] == rows[b]).mean() >= packing.LINK]
    i, j = packing.spanning(rows)
    assert len(agree) > 1000 and len(i) < 300 and {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())} <= set(agree)
    assert roots(range(300), list(zip(i.tolist(), j.tolist()))) == roots(range(300), agree)


def plain_packing(rows, edges, window):
    """The walk and the fill by their definition: one list of all documents, cut into windows."""
    near = {}
    for a, b, s in edges:
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = s
    root = roots(near, [(a, b) for a, b, _ in edges])
    place, seen = {}, set()
    for least in sorted(set(root.values())):
        left = sorted((x for x in near if root[x] == least), key=lambda x: (len(near[x]), x))
        at, step = None, 0
        while len([x for x in left if x in seen]) < len(left):
            if at is None:
                at = next(x for x in left if x not in seen)
            seen.add(at)
            place[at], step = (least, step), step + 1
            free = sorted((-s, b) for b, s in near[at].items() if b not in seen)
            at = free[0][1] if free else None
    order = sorted(((*place.get(i, (i, 0)), i, len(t.split())) for i, t in rows if i is not None and t is not None and t.split()))
    out, total = [], 0
    for _, _, i, n in order:
        begin = 0
        while begin < n:
            take = min(n - begin, window - total % window)
            out.append((total // window, total % window, i, begin, begin + take))
            begin, total = begin + take, total + take
    return out


def test_packing_against_a_plain_walk(spark):
    rows = [*near_texts().items(), *ODD, (12, near_texts()[12]), (200, words(500, 8))]
    docs = frame(spark, rows)
    edges = [tuple(r) for r in packing.neighbours(docs.selectExpr("doc_id as id", "text")).collect()]
    assert len(edges) > 50
    got = sorted(tuple(r) for r in packing.pack_documents(docs, window=64).collect())
    assert got == sorted(plain_packing(rows, edges, 64))


def test_large_groups_are_walked_whole(spark):
    rows = [(i, edited(words(80, 5), 0.05, i)) for i in range(60)]
    packed = [tuple(r) for r in packing.pack_documents(frame(spark, rows), piece=8).collect()]
    size = {}
    for _, _, i, a, b in packed:
        size[i] = size.get(i, 0) + b - a
    assert size == {i: len(t.split()) for i, t in rows}
    assert sorted(packed) == sorted(tuple(r) for r in packing.pack_documents(frame(spark, rows)).collect())
    near = [*near_texts().items()]
    small, large = ({tuple(r) for r in packing.paths(frame(spark, near).selectExpr("doc_id as id", "text"), most).collect()} for most in (1000, 1))
    assert small == large and len(small) > 30


def test_parts_are_components():
    edges = [(5, 9, 0.5), (2, 3, 0.9), (9, 4, 0.4), (3, 2, 0.9)]
    assert packing.parts(edges) == {4: [edges[0], edges[2]], 2: [edges[1], edges[3]]}


def test_walks_start_at_low_degrees():
    assert packing.walk([(1, 2, 0.5), (2, 3, 0.9), (2, 4, 0.4), (3, 4, 0.3)]) == [1, 2, 3, 4]
    assert packing.walk([(5, 9, 0.5), (5, 6, 0.5), (5, 7, 0.8)]) == [6, 5, 7, 9]


def picture(height, width, seed=1):
    y, x = np.mgrid[:height, :width]
    base = np.stack([128 + 90 * np.sin(x / 9 + y / 13), 128 + 80 * np.cos(x / 17), 128 + 70 * np.sin(y / 7)], 2)
    return np.clip(base + np.random.default_rng(seed).normal(0, 10, base.shape), 0, 255).astype(np.uint8)


def virtual_machine_decode(spark, data):
    """The JVM's own decoder, as an independent one."""
    jvm = spark._jvm
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(data))
    width, height = image.getWidth(), image.getHeight()
    values = np.array(list(image.getRGB(0, 0, width, height, None, 0, width)), np.int64).reshape(height, width)
    return np.stack([values >> 16 & 255, values >> 8 & 255, values & 255], 2)


def virtual_machine_encode(spark, rgb, progressive):
    jvm = spark._jvm
    height, width, _ = rgb.shape
    image = jvm.java.awt.image.BufferedImage(width, height, 1)
    for y in range(height):
        for x in range(width):
            image.setRGB(x, y, int(rgb[y, x, 0]) << 16 | int(rgb[y, x, 1]) << 8 | int(rgb[y, x, 2]))
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName("jpeg").next()
    options = writer.getDefaultWriteParam()
    if progressive:
        options.setProgressiveMode(1)
    out = jvm.java.io.ByteArrayOutputStream()
    stream = jvm.javax.imageio.ImageIO.createImageOutputStream(out)
    writer.setOutput(stream)
    writer.write(None, jvm.javax.imageio.IIOImage(image, None, None), options)
    stream.close()
    return bytes(out.toByteArray())


def luma(rgb):
    return np.asarray(rgb, float) @ [0.299, 0.587, 0.114]


@pytest.mark.parametrize(("height", "width"), [(1, 1), (8, 8), (17, 33), (24, 19)])
def test_pictures_equal_the_virtual_machines(spark, height, width):
    rgb = picture(height, width)
    for data in (jpeg.encode(rgb), virtual_machine_encode(spark, rgb, True), virtual_machine_encode(spark, rgb, False)):
        mine, other = jpeg.decode(data).astype(int), virtual_machine_decode(spark, data).astype(int)
        assert mine.shape == (height, width, 3)
        assert np.abs(mine - other).max() <= 3 and (mine.size < 50 or np.abs(mine - other).mean() < 0.5)  # all three channels; rounding differs
        assert np.abs(luma(mine) - luma(rgb)).mean() < 8


def test_damaged_pictures_raise_nothing_else():
    rng = random.Random(5)
    good = [jpeg.encode(picture(24, 19)), jpeg.encode(picture(40, 50))]
    for i in range(2000):
        data = bytearray(good[i % 2])
        for _ in range(rng.randrange(1, 5)):
            at, kind = rng.randrange(len(data)), rng.randrange(4)
            if kind < 2:
                data[at] = rng.randrange(256)
            elif kind == 2:
                del data[at]
            elif rng.random() < 0.2:
                del data[at + 1 :]
        try:
            assert jpeg.decode(bytes(data)).dtype == np.uint8
        except jpeg.Damaged:
            pass


def test_a_header_alone_allocates_nothing():
    data = jpeg.encode(picture(24, 19))
    at = data.index(b"\xff\xc2") + 5
    huge = data[:at] + b"\xff\xff\xff\xff" + data[at + 4 :]
    with pytest.raises(jpeg.Damaged, match="pixels"):
        jpeg.decode(huge)
    with pytest.raises(jpeg.Damaged, match="blocks"):
        jpeg.decode(data[:at] + b"\x10\0\x10\0" + data[at + 4 :])


def test_a_large_picture_of_many_batches(spark):
    rgb = picture(130, 210)
    data = jpeg.encode(rgb)
    assert np.abs(jpeg.decode(data).astype(int) - virtual_machine_decode(spark, data)).max() <= 3
    rgb = picture(600, 900)  # more blocks than are transformed at once
    assert np.abs(luma(jpeg.decode(jpeg.encode(rgb))) - luma(rgb)).mean() < 8


def test_grey_pictures_are_exact(spark):
    grey = np.repeat(picture(20, 28)[:, :, :1], 3, axis=2)
    data = jpeg.encode(grey)
    assert np.abs(jpeg.decode(data).astype(int) - virtual_machine_decode(spark, data)).max() <= 1


def test_media_on_odd_rows(spark):
    good = jpeg.encode(picture(9, 9))
    media = [good, None, b"", b"\xff\xd8", good[: len(good) // 2], good[:-2], b"no picture", good.replace(b"\xff\xc2", b"\xff\xc3"), bytes(200), good, good[:300] + bytes(50) + good[350:]]
    df = spark.createDataFrame([(i if i != 9 else None, m, i, "x") for i, m in enumerate(media)], "pid long, media binary, height int, error string")
    rows = {r["pid"]: r for r in jpeg.decode_column(df, "pid").collect()}
    assert len(rows) == len(media) and rows[0]["tensor"] == rows[None]["tensor"] and len(rows[0]["tensor"]) == 9 * 9 * 3 and rows[0]["error"] is None
    assert rows[1]["tensor"] is None and rows[1]["error"] is None
    assert all(rows[i]["tensor"] is None and rows[i]["error"] for i in range(2, 9))
    assert jpeg.decode_column(df.limit(0), "pid").count() == 0


def test_media_column_round_trip(spark):
    df = spark.createDataFrame([(1, [0.1] * 64), (2, None), (3, []), (4, [None, float("nan"), 0.2])], "vec_id long, embedding array<float>")
    rows = {r["vec_id"]: r for r in jpeg.decode_column(jpeg.media_column(df, "vec_id", "embedding"), "vec_id").collect()}
    assert rows[2]["tensor"] is None and rows[2]["error"] is None
    for i, vector in ((1, [0.1] * 64), (3, []), (4, [float("nan"), 0.2])):
        want = jpeg.draw(vector, i)
        got = np.frombuffer(rows[i]["tensor"], np.uint8).reshape(rows[i]["height"], rows[i]["width"], 3)
        assert np.abs(luma(got) - luma(want)).mean() < 8
