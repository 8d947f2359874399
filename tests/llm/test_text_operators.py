"""Tokens, classifier, fingerprints, licences and identifiers against brute force, and on odd rows."""

import os
import random
import re

import numpy as np
import pytest

from babelmill.llm import bpe, licenses, ordinal, private, syncmers, text

from .rows import SCHEMA, frame, words

ODD = [(1, None), (2, ""), (3, "a b"), (None, "call 1.2.3.4 now"), (4, words(40_000, 1)), (5, "tie tie tie"), (5, "tie tie tie"), (None, None), (6, "\n\n é漢\U0001f642\x00")]


def test_text_primitives():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    for w in (1, 2, 7, 499, 500, 501):
        assert text.sliding_min(values, w).tolist() == [min(values[i : i + w].tolist()) for i in range(len(values) - w + 1)]
    c, offsets = text.codes(["ab ab", "", "b  ab\n"])
    starts, ends, which = text.words(c, offsets)
    assert [(int(a), int(b), int(t)) for a, b, t in zip(starts, ends, which)] == [(0, 2, 0), (3, 5, 0), (5, 6, 2), (8, 10, 2)]
    h = text.span_hash(text.prefix(c), starts, ends)
    assert h[0] == h[1] == h[3] != h[2]
    assert list(text.chunks(["aaa", "b", "cc"], 4)) == [(0, 2), (2, 3)]


needs_vocabulary = pytest.mark.skipif(not os.path.exists(bpe.default_vocabulary()), reason="no rank file")


@needs_vocabulary
def test_ids_equal_the_reference_encoder():
    import tiktoken

    coder = bpe.Codec(bpe.read_ranks(bpe.default_vocabulary()))
    other = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks={t: i for i, t in enumerate(coder.tokens)}, special_tokens={})
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab'st'rell vemd  \n\t1²９_é漢'’　\xa0́", k=rng.randrange(14))) for _ in range(4000)]
    ids, offsets = coder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [other.encode_ordinary(t) for t in texts]


@needs_vocabulary
def test_bpe_on_odd_rows(spark):
    out = bpe.encode_documents(frame(spark, ODD))
    rows = {(r["doc_id"], r["n_tokens"], r["exact"]) for r in out.collect()}
    assert out.count() == len(ODD) and (1, None, None) in rows and (2, 0, True) in rows and all(e in (True, None) for _, _, e in rows)
    texts = sorted((r["doc_id"] or 0, r["text"] or "") for r in bpe.decode_documents(out).collect())
    assert texts == sorted((i or 0, t or "") for i, t in ODD)
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ordinal_held_out(spark):
    rng = random.Random(3)

    def make(grade):
        body = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 80))]
        if grade == 0:
            body = [w + "%%%" for w in body]
        if grade == 1:
            body[rng.randrange(len(body))] = rng.choice(["vile", "nasty"])
        return " ".join(body)

    grades = [rng.randrange(3) for _ in range(900)]
    docs = frame(spark, [(i, make(g)) for i, g in enumerate(grades)])
    labels = spark.createDataFrame([(i, int(g > 0), int(g == 1)) for i, g in enumerate(grades[:600])] + [(None, 1, 0), (700, None, 0)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in ordinal.select_documents(docs, labels).collect()}
    held = range(600, 900)
    assert sum((i in out) == (grades[i] == 2) for i in held) / 300 > 0.95
    assert all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in out.values())
    kept = ordinal.keep_selected(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(out)


def test_ordinal_thresholds_are_ordered():
    rows = [np.array([g, 5]) for g in (0, 1, 2, 3) for _ in range(30)]
    model = ordinal.fit(rows, [g for g in (0, 1, 2, 3) for _ in range(30)], bits=6)
    assert (np.diff(model.thresholds) > 0).all()
    assert (np.diff(ordinal.sigmoid(0 - model.thresholds)) < 0).all()


def test_ordinal_fit_is_the_maximum():
    """Against Newton's method with derivatives by differences, on a likelihood that is written out from its definition."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, (400, 3)).astype(float)
    y = np.clip(np.round(x @ [2.0, -1.5, 0.5] + rng.normal(0, 1.5, 400) + 0.7), 0, 2).astype(int)
    decay, share = 1e-2, 1 / 3 / np.bincount(y)[y]

    def loss(p):
        cuts = np.array([-np.inf, p[3], p[3] + np.exp(p[4]), np.inf])
        upper = 1 / (1 + np.exp(-(x @ p[:3] - cuts[y])))
        lower = 1 / (1 + np.exp(-(x @ p[:3] - cuts[y + 1])))
        return -(share * np.log(upper - lower)).sum() + decay / 2 * (p[:3] ** 2).sum()

    def gradient(p, h=1e-5):
        return np.array([(loss(p + e) - loss(p - e)) / (2 * h) for e in np.eye(5) * h])

    with np.errstate(all="ignore"):
        p = np.zeros(5)
        for _ in range(30):
            curve = np.array([(gradient(p + e) - gradient(p - e)) / 2e-4 for e in np.eye(5) * 1e-4])
            p -= np.linalg.solve(curve + 1e-9 * np.eye(5), gradient(p))
        assert np.abs(gradient(p)).max() < 1e-7
    model = ordinal.fit([np.flatnonzero(r) for r in x], y.tolist(), bits=2, decay=decay, epochs=3000, rate=0.02)
    assert model.weights[:3] == pytest.approx(p[:3], abs=0.02)
    assert model.thresholds == pytest.approx([p[3], p[3] + np.exp(p[4])], abs=0.02)


def test_ordinal_ties_and_spellings(spark):
    rows = [(i, ("good words here " if i % 2 else "bad junk there ") * 3) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    tails = {r["tail_probability"] for r in ordinal.select_documents(docs, labels, least=0.0).collect()}
    assert len(tails) == 2
    assert ordinal.select_documents(docs, labels, least=max(tails)).count() == 100
    odd = docs.selectExpr("doc_id as Doc_Id", "text as Text", "1 as _Expected", "2 as _TAIL", "3 as grade")
    kept = ordinal.keep_selected(odd, labels)
    assert kept.columns == odd.columns and kept.count() == 100


def test_ordinal_on_odd_rows(spark):
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    rows = ordinal.select_documents(frame(spark, ODD), labels).collect()
    assert len(rows) == len([t for _, t in ODD if t is not None]) and all(r["tail_probability"] is None for r in rows)
    both = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (5, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["id"]: r["grade"] for r in ordinal.grades(both).collect()} == {3: 2, 4: 0, 5: 1}
    assert ordinal.keep_selected(frame(spark, ODD), both).columns == frame(spark, ODD).columns
    assert ordinal.select_documents(spark.createDataFrame([], SCHEMA), both).count() == 0


def test_syncmers_against_their_definition():
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdef gh", k=400)), "x" * 300, "short", "", "".join(rng.choices("ab", k=150))]
    k, s = 30, 8
    found, place, _ = syncmers.anchors(texts, k, s)
    c, offsets = text.codes(texts)
    sums = text.prefix(c)
    h = lambda i: int(text.span_hash(sums, np.array([i]), np.array([i + s]))[0])
    for t, one in enumerate(texts):
        seen, want = set(), []
        for i in range(len(one) - k + 1):
            inner = [h(int(offsets[t]) + i + j) for j in range(k - s + 1)]
            if min(inner) in (inner[0], inner[-1]) and one[i : i + k] not in seen:
                seen.add(one[i : i + k])
                want.append(i)
        assert place[found == t].tolist() == want


def test_syncmers_are_free_of_context(spark):
    shared = words(200, 5)
    docs = frame(spark, [*ODD, (10, shared), (11, "PRE FIX " + shared + " tail")])
    rows = {r["doc_id"]: r for r in syncmers.fingerprints(docs).where("doc_id >= 10").collect()}
    inside = set(rows[10]["hashes"])
    assert inside and inside <= set(rows[11]["hashes"])
    odd = syncmers.fingerprints(frame(spark, ODD)).collect()
    assert len(odd) == len(ODD) and [r["positions"] for r in odd if r["doc_id"] == 1] == [None] and [r["positions"] for r in odd if r["doc_id"] == 2] == [[]]
    match = syncmers.match_positions(docs).collect()
    assert [(r["doc_id"], r["source_id"], r["shift"], r["anchors"]) for r in match] == [(11, 10, 8, len(inside))]
    assert syncmers.match_positions(spark.createDataFrame([], SCHEMA)).count() == 0


def test_syncmers_keep_recurring_passages(spark):
    shared, gap = words(200, 5), words(60, 6)
    twice = f"{shared} {gap} {shared}"
    docs = frame(spark, [(10, shared), (11, twice), (11, twice), (12, twice)])
    rows = {r["doc_id"]: r for r in syncmers.fingerprints(docs).collect()}
    second = len(shared) + len(gap) + 2
    one = list(zip(rows[10]["positions"], rows[10]["hashes"]))
    both = set(zip(rows[11]["positions"], rows[11]["hashes"]))
    assert one and {(p + move, h) for p, h in one for move in (0, second)} <= both
    match = {tuple(r) for r in syncmers.match_positions(docs).collect()}
    low, high = min(rows[10]["positions"]), max(rows[10]["positions"]) + syncmers.K
    ends = [(i, 10, move, len(one), low + move, high + move) for i in (11, 12) for move in (0, second)]
    assert {r for r in match if r[1] == 10} == set(ends)
    inner = {r[2]: r[3] for r in match if r[:2] == (12, 11)}
    assert set(inner) == {0} and inner[0] == len(rows[11]["positions"]) - 2 * len(one)
    back = {tuple(r) for r in syncmers.match_positions(frame(spark, [(10, twice), (11, shared)])).collect()}
    assert {(r[2], r[3]) for r in back} == {(0, len(one)), (-second, len(one))}


def template_tree(template):
    """Nested lists of words, optional parts and expressions, by a split at the marks."""
    stack = [[]]
    for part in re.split(r"(<<.*?>>)", template, flags=re.S):
        if part == "<<beginOptional>>":
            stack.append([])
        elif part == "<<endOptional>>":
            inner = stack.pop()
            stack[-1].append(("opt", inner))
        elif part.startswith("<<var"):
            stack[-1].append(("var", re.search('match="(.*?)"', part, re.S).group(1)))
        else:
            stack[-1] += [("word", w) for w, _, _ in licenses.tokens(part)]
    return stack[0]


def brute_licenses(body, templates):
    """A backtracking search over the templates as trees: every end from every token, tried in full."""
    found = licenses.tokens(body)
    repeat = lambda p: re.fullmatch(r"\.(\+|\*|\{[0-9,]+\})", p)

    def stands(p, i, j):
        if re.fullmatch(r"[\w|-]+", p):
            return j == i + 1 and found[i][0] in [licenses.token(w) for w in p.split("|")]
        held = "" if i == j else body[found[i][1] : found[j - 1][2]]
        if not repeat(p):
            held = " ".join(held.split())
        return re.fullmatch(p, held, re.S | re.I if repeat(p) else re.I) is not None

    def may_end(nodes):
        return all(kind == "opt" or kind == "var" and stands(x, 0, 0) for kind, x in nodes)

    def ends(nodes, i):
        if not nodes:
            return {i}
        (kind, x), rest = nodes[0], nodes[1:]
        if kind == "word":
            return ends(rest, i + 1) if i < len(found) and found[i][0] == x else set()
        if kind == "opt":
            return ends(x + rest, i) | ends(rest, i)
        out = set()
        for j in range(i, len(found) + 1):
            if stands(x, i, j):
                out |= ends(rest, j)
                if repeat(x) and may_end(rest):
                    break
        return out

    best = {}
    for name, template in templates.items():
        nodes, i = template_tree(template), 0
        while i < len(found):
            end = max(ends(nodes, i), default=-1)
            if end > i:
                best[i] = min(best.get(i, (0, "")), (-end, name))
                i = end
            else:
                i += 1
    return [(name, found[i][1], found[-end - 1][2]) for i, (end, name) in sorted(best.items())]


def test_license_templates():
    compile_ = licenses.compile_template
    one = compile_("t", 'Licensed under <<beginOptional>>the <<beginOptional>>very<<endOptional>> good<<endOptional>> Foo <<var;name="n";match=".{0,4}">> License')
    accepts = lambda s, by=one: bool(licenses.match_text(s, [by]))
    assert accepts("licensed under Foo License") and accepts("LICENSED!! UNDER!! the very good foo X, Y licence.") and accepts("Licensed under the good Foo a license")
    assert not accepts("Licensed under very good Foo License") and not accepts("Licensed under Foo a b c License") and not accepts("Licensed under Bar License")
    assert accepts("licensed under foo abcd license") and not accepts("licensed under foo abcde license") and not accepts("licensed under foo extraordinarily longwords license")
    far = compile_("t", 'from <<var;name="n";match=".+">> to here')
    for n in (1, 40, 41, 3000):
        assert [b for _, _, b in licenses.match_text("from " + "x " * n + "to here, and on", [far])] == [12 + 2 * n]
    several = compile_("t", 'by <<var;name="n";match="the (authors|copyright holders)">> only')
    assert accepts("by THE\n copyright   holders only", several) and accepts("by the authors only", several) and not accepts("by the holders only", several)
    tail = compile_("t", 'get it at <<var;name="n";match="\\S+">>')
    assert licenses.match_text("get it at https://a.org/B/2.0/. Then much follows", [tail]) == [("t", 0, 29)]
    for bad in ("<<beginOptional>>a<<endOptional>>", "a <<endOptional>>", "a <<beginOptional>> b", '<<var;name="n";match=".+">> a', 'a <<var;name="n";match="(">> b'):
        with pytest.raises(ValueError):
            compile_("bad", bad)


def test_license_automata_against_backtracking():
    rng = random.Random(12)
    patterns = [".+", ".*", ".{1,4}", ".{0,3}", "b|d", "(a b|c)+", "[a-c]( [a-c])?", "a, b"]

    def made(depth):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            kind = rng.randrange(6)
            parts.append(f"<<beginOptional>>{made(depth - 1)}<<endOptional>>" if kind == 0 and depth else f'<<var;name=x;match="{rng.choice(patterns)}">>' if kind == 1 else rng.choice("abcd"))
        return " ".join(parts)

    hits = 0
    for _ in range(400):
        templates = {name: rng.choice("abcd") + " " + made(2) for name in "xy"}
        body = "".join(rng.choice("abcd") + rng.choice([" ", " ", ", ", "\n"]) for _ in range(rng.randrange(0, 14)))
        got = licenses.match_text(body, [licenses.compile_template(n, t) for n, t in templates.items()])
        assert got == brute_licenses(body, templates), (templates, body)
        hits += len(got)
    assert hits > 200


def filled(template, words=("x",)):
    """A text that fits a template: with its optional parts, and each region's first word or some of its own."""
    body = re.sub(r"<<(begin|end)Optional>>", "", template)
    given = lambda m: m.group(1).split("|")[0] if re.fullmatch(r"\w[\w|/.-]*", m.group(1)) else "2020" if "[0-9]" in m.group(1) else "https://a.org/L" if "S" in m.group(1) else " ".join(words)
    return re.sub(r'<<var;.*?match="(.*?)">>', given, body, flags=re.S)


def test_license_scan_against_backtracking(spark):
    bodies = ["x Released under the MIT License. y", "This work is licensed under the GNU General Public License, version 3.", "All rights reserved. all RIGHTS reserved", "Copyright 2020 Some One. All rights reserved", "Released under the License of MIT", words(3000, 6) + " Licensed under CC BY-NC 4.0."]
    bodies += [f"before. {filled(t, ('Some', 'One'))} And after." for t in licenses.TEMPLATES.values()]
    docs = frame(spark, [*ODD, *[(100 + i, b) for i, b in enumerate(bodies)]])
    got = sorted((r["doc_id"], r["start"], r["license_id"], r["end"]) for r in licenses.scan_licenses(docs).collect())
    want = sorted((100 + i, a, n, b) for i, body in enumerate(bodies) for n, a, b in brute_licenses(body, licenses.TEMPLATES))
    assert got == want and {g[0] for g in got} >= {100, 101, 102, 103, 105}
    assert {g[2] for g in got} == set(licenses.TEMPLATES)
    for i, name in enumerate(licenses.TEMPLATES):
        whole = [g for g in got if g[0] == 106 + i and g[1] == 8]
        assert whole and (whole[0][2] == name or whole[0][3] >= len(bodies[6 + i]) - 20), name
    tied = {"b": "a c", "a": "a <<beginOptional>>c<<endOptional>>"}
    assert [tuple(r) for r in licenses.scan_licenses(frame(spark, [(1, "a c")]), templates=tied).collect()] == [(1, "a", 0, 3)]
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_identifiers_are_discovered(spark):
    rng = random.Random(7)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    rows, secret = [], {}
    for i in range(160):
        value = [f"u{digits(2)}@m{i % 5}.example.com", f"+1 ({digits(3)}) 555-{digits(4)}", ".".join(str(rng.randrange(256)) for _ in range(4)), digits(16), f'token = "{"".join(rng.choices("0123456789abcdef", k=40))}"'][i % 5]
        secret[i] = value
        rows.append((i, f"{words(30, i)} {value} {words(20, i + 500)}"))
    clean = [(1000 + i, f"plain text of version 3.{i} and chapter {i} in {1900 + i}") for i in range(60)]
    docs = frame(spark, [*rows, *clean, (9001, None), (9002, "")])
    found = {r["doc_id"] for r in private.find_identifiers(docs).collect()}
    assert found == set(secret)
    clear = private.redact(docs)
    assert clear.columns == docs.columns and clear.count() == docs.count()
    texts = {r["doc_id"]: r for r in clear.collect()}
    for i, value in secret.items():
        assert value.split('"')[-2 if '"' in value else -1] not in texts[i]["text"] and private.MARK in texts[i]["text"]
        assert texts[i]["n_chars"] == len(texts[i]["text"])
    assert all(texts[i]["text"] == t for i, t in clean)


def test_identifiers_have_whole_contexts():
    long = "x" * 100
    found = {text[a:b]: p for text in [f"{long} {long}y 1234567 {long}z"] for a, b, _, _, p in private.scan(text)}
    assert found["1234567"][2:] == [f"<{long} {long}y|9{{7}}", f"<{long}y|9{{7}}", f">{long}z|9{{7}}"]
    values = ["aGVsbG8/d29ybGQ+MTIzNDU2Nzg5MA==", "abc-def_ghi-1234-jkl-mnop", "0123456789abcdef0123"]
    for value in values:
        for text in (f'my api key = "{value}".', f"token={value} and more", f"{'y ' * 90}secret :   {value}\n"):
            assert [(text[a:b], known) for a, b, _, known, _ in private.scan(text) if known > 0] == [(value, 1)]
        assert not any(known > 0 for *_, known, _ in private.scan(f"token\n{value}"))
    assert private.beside("a b\nc d e", 7, -1, 4) == "c d" and private.beside("ab cd\ne", 2, 1, 1) == " cd"


def test_redaction_of_other_spellings_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "mail a@b.example.com and c@d.example.com", 40), (None, None, None)], "_Spans long, Text string, N_CHARS long")
    out = private.redact(docs)
    assert out.columns == docs.columns and out.where("Text is not null").first()[1] == f"mail {private.MARK} and {private.MARK}"
    assert out.where("Text is not null").first()[2] == len(f"mail {private.MARK} and {private.MARK}")
    assert private.redact(spark.createDataFrame([], SCHEMA)).count() == 0


def test_identifiers_on_odd_rows(spark):
    docs = frame(spark, [*ODD, (9, "ip 10.0.0.1 10.0.0.1 and 4111111111111111 4111111111111111."), (9, "ip 10.0.0.1 10.0.0.1 and 4111111111111111 4111111111111111.")])
    rows = private.find_identifiers(docs).collect()
    assert sum(r["doc_id"] == 9 for r in rows) == 8 and sum(r["doc_id"] is None for r in rows) == 1
    assert private.find_identifiers(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pattern_scores_against_brute_force(spark):
    rows = [(i, f"id {'4111 1111 1111 1111' if i == 0 else ''} value{i}x99999 then {10_000_000 + i}") for i in range(12)]
    found = private.occurrences(frame(spark, rows), "doc_id", "text")
    got = {r["instance"]: r["score"] for r in private.score(found).collect()}
    seeds, edges = {}, {}
    for r in found.collect():
        seeds[r["instance"]] = max(seeds.get(r["instance"], r["seed"]), r["seed"])
        for p in r["patterns"]:
            edges.setdefault(p, set()).add(r["instance"])
    score = {i: float(s == 1) for i, s in seeds.items()}
    for _ in range(private.TURNS):
        conf = {}
        for p, members in edges.items():
            good = sum(score[i] for i in members)
            against = sum(1.0 if seeds[i] == -1 else private.UNKNOWN * (1 - score[i]) if seeds[i] == 0 else 0 for i in members)
            c = good / (good + against + private.PRIOR)
            if c >= private.LEAST and sum(score[i] >= private.LEAST for i in members) >= private.SUPPORT:
                conf[p] = c
        score = {i: 1.0 if s == 1 else 0.0 if s == -1 else max([c for p, c in conf.items() if i in edges[p]], default=0.0) for i, s in seeds.items()}
    assert got == pytest.approx({i: s for i, s in score.items() if s >= private.LEAST})
