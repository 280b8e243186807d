"""The text operators against brute force on small fixtures: nulls, empty and long texts, ties, repeated rows, empty
tables, extra columns with clashing names."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlelake.llm import decontaminate, exact_dedup, grams, html_text, licenses, ngram_join, packing, queries, repeats, secrets, substring_dedup, suffix_dedup, toxicity
from candlelake.llm.common import load, materialise
from candlelake.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def vocabulary(n=400):
    rng = np.random.default_rng(3)
    return ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def cases():
    """Texts with copies, near copies, shared passages, repeats within a text, and odd ones."""
    rng, words = np.random.default_rng(5), vocabulary()
    text = lambda n: " ".join(rng.choice(words, n))
    base, passage, line = text(120), text(70), text(12)
    out = [base, base, base.replace(" ", "\n"), " ".join(base.split()[:110]), base.upper()]
    out += [f"{text(30)} {passage} {text(25)}" for _ in range(6)] + [f"{line}\n{text(40)}" for _ in range(5)]
    out += ["", None, " \t\n", "a", "a b c d", "a b c d", "A b c d", "é" * 80, "é" * 81 + "x", "a" * 3000, "ab" * 900 + passage, passage, passage + " " + passage, text(2000), "日本語 " * 60]
    edited = base.split()
    for k in range(0, 100, 9):
        edited = [*edited]
        edited[k] = "zz"
        out.append(" ".join(edited))
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, cases):
    rows = [(i, t, "en", "s", len(t or ""), 7, "k") for i, t in cases]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kind int, key string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_exact_dedup(docs, cases, empty):
    plain = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in cases}
    size = {i: len(t or "") for i, t in cases}
    out = by_id(exact_dedup.exact_dedup(docs))
    assert len(out) == len(cases)
    for i, r in out.items():
        same = [j for j in plain if plain[j] == plain[i]]
        keep = min(same, key=lambda j: (-size[j], j))
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (keep, len(same), keep == i, hashlib.sha256(plain[i].encode()).hexdigest())
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_of_nameless_rows(spark):
    rows = [(None, "a b"), (3, "ab"), (None, "c"), (None, "c"), (4, None), (4, ""), (5, "x" * 3000), (6, " " + "x" * 3000), (7, "x" * 1999 + " x" * 1001)]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, sha string, keep_id int")
    before = len(spark.catalog.listTables())
    out = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect()), key=str)
    want = [(None, None, 2, True)] * 2 + [(None, None, 2, True), (3, None, 2, False), (4, 4, 2, True), (4, 4, 2, True), (5, 7, 3, False), (6, 7, 3, False), (7, 7, 3, True)]
    assert out == sorted(want, key=str) and len(spark.catalog.listTables()) == before
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, None, 4, 7], key=str)


def test_digest_index_keeps_what_it_knows(spark, docs):
    index = exact_dedup.DigestIndex(spark)
    index.append(docs.where("doc_id >= 2"))
    before = {r.text_sha256: r.keep_id for r in index.table().collect()}
    index.append(docs)
    after = {r.text_sha256: r.keep_id for r in index.table().collect()}
    assert all(after[k] == v for k, v in before.items()) and index.table().count() == len(after)


def test_digest_index_counts_all_batches(spark):
    schema = "doc_id long, text string"
    batches = [[(1, "a b"), (2, "ab"), (3, "c")], [(4, "a\nb"), (5, "d"), (6, "d")], [(7, "ab"), (8, " c"), (9, "e"), (None, None)], [(10, "")]]
    index, seen, first = exact_dedup.DigestIndex(spark), [], {}
    for batch in batches:
        plain = lambda t: re.sub(r"\s", "", t or "")
        for i, t in sorted(batch, key=lambda x: -len(x[1] or "")):
            first.setdefault(plain(t), i)
        seen += [plain(t) for _, t in batch]
        out = exact_dedup.exact_dedup(spark.createDataFrame(batch, schema), index).collect()
        assert {(r.doc_id, r.keep_id, r.group_size) for r in out} == {(i, first[plain(t)], seen.count(plain(t))) for i, t in batch} and len(out) == len(batch)
    assert index.table().count() == len(set(seen))


def test_repeated_rows_become_one(docs):
    twice = docs.unionByName(docs)
    assert exact_dedup.keep_first(twice).count() == exact_dedup.keep_first(docs).count()
    assert set(exact_dedup.keep_first(docs).columns) == set(docs.columns)


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def classes(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("short_list", [16, 2])
def test_jaccard_components(docs, cases, empty, monkeypatch, short_list):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short_list)
    sets = {i: shingles(t) for i, t in cases}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want, out = classes(sets, links), by_id(ngram_join.jaccard_components(docs))
    assert {i: (r.n_shingles, r.component_id) for i, r in out.items()} == {i: (len(s), want[i]) for i, s in sets.items()}
    if short_list == 16:
        assert ngram_join.jaccard_components(empty).count() == 0
        assert sorted(r.doc_id for r in ngram_join.keep_one(docs).collect()) == sorted(i for i in sets if want[i] == i)


@pytest.mark.parametrize("short_list", [16, 2])
def test_jaccard_components_of_families(spark, monkeypatch, short_list):
    """Texts that stray from a few ancestors by more and more words, so that links, near misses and chains abound; repeated
    doc_ids with several texts, rows without one, colliding words, clashing columns."""
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short_list)
    rng, words, rows = np.random.default_rng(12), vocabulary(), []
    for family in range(6):
        text = list(rng.choice(words, int(rng.integers(40, 160))))
        for _ in range(14):
            own = list(text)
            for at in rng.integers(0, len(own), int(rng.integers(0, 7))):
                own[at] = str(rng.choice(words))
            rows.append((len(rows), " ".join(own[: len(own) - int(rng.integers(0, 12))])))
            text = own if rng.random() < 0.4 else text
    alike = " ".join(rng.choice(words, 40))
    rows += [(300, thue_morse(1024, "a", "b")), (301, thue_morse(1024, "b", "a")), (302, "v w x y " + thue_morse(2048, "a", "b")), (303, "v w x y " + thue_morse(2048, "b", "a"))]
    rows += [(400, alike), (400, rows[0][1]), (401, alike + " z"), (401, "other words here"), (402, alike), (402, alike), (None, alike), (None, None), (403, rows[20][1])]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, n int, node int, gone string").repartition(4)
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a is not None and b is not None and a != b and x & y and 100 * len(x & y) >= 75 * len(x | y)]
    want = classes({i for i, _ in sets if i is not None}, links)
    out = ngram_join.jaccard_components(df).collect()
    assert sorted(map(tuple, out), key=str) == sorted(((i, len(s), want.get(i)) for i, s in sets), key=str)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _ in rows if i is None or want[i] == i), key=str)


def test_blocks_of_a_list():
    rng = np.random.default_rng(3)
    for percent in (75, 90):
        rows = sorted((int(t), int(n), int(p), d) for d, (t, n, p) in enumerate(zip(rng.integers(0, 9, 90), rng.integers(1, 12, 90), rng.integers(0, 4, 90))))
        token, n, pos, doc = (np.array(x) for x in zip(*rows))
        i, j = ngram_join._block_pairs(token, doc, n, pos, percent)
        need = lambda a, b: -(-percent * (a + b) // (100 + percent))
        want = {(a, b) for a in range(90) for b in range(a + 1, 90) if token[a] == token[b] and 100 * n[a] >= percent * n[b] and min(n[a] - pos[a], n[b] - pos[b]) >= need(n[a], n[b])}
        assert sorted(zip(i.tolist(), j.tolist())) == sorted(want)


def test_bitmaps_never_overstate_a_difference():
    rng = np.random.default_rng(9)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 700), dtype=np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, rng.integers(0, len(a) + 1), replace=False), rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64)]))
        x, y = ngram_join.parities(np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b]))
        assert ngram_join.least_difference(x, y) <= len(set(a.tolist()) ^ set(b.tolist()))
        one, two = ngram_join.sketches(np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b])).view(np.uint64)
        assert np.bitwise_count(one ^ two).sum() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(50)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r.node: r.component for r in components(edges).collect()} == {i: 0 for i in range(51)} | {100: 100, 101: 100}

    known = components(edges.where("a % 7 <> 3"))
    grown = {r.node: r.component for r in components(edges.where("a % 7 = 3"), known).collect()}
    assert grown == {r.node: r.component for r in components(edges).collect()}


BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6, 2), ("access", re.compile("AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile("[0-9a-f]+"), 24, 0)]


def test_secret_scan(spark):
    opaque = "Ab3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0eF3hI6kL9n"
    texts = ["", None, "é password = 'abcdefg' x", "secret=token = abcdef", "password: a token=abcdef", "AKIA" + "A" * 16 + " AKIAAKIA0 " + "f" * 24, "0123456789abcdef" * 4000,
             f"AKIA{'B' * 16} and {opaque}", opaque, f"client_id: me42 {' ' * 900} {opaque}", f"https://db.example.com/x {opaque}", "日本 api_key=日本 apikey='zzzzzz'" * 30]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    out = by_id(secrets.secret_scan(df))
    for i, t in enumerate(texts):
        found = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, least, g) in enumerate(BASE) for m in p.finditer(t or "") if len(m[g]) >= least)
        assert out[i].base_sha256 == hashlib.sha256(",".join(x[2] for x in found).encode()).hexdigest()
        assert set(x[2] for x in found) <= set(out[i].spans.split(",")) | {""}
    assert out[7].n_linked == 1 and "opaque" in out[7].spans and out[10].n_linked == 2
    assert out[8].n_linked == out[9].n_linked == 0
    assert secrets.secret_scan(df.limit(0)).count() == 0


def test_secret_links_against_brute_force(spark):
    rng, words = np.random.default_rng(21), vocabulary(60)
    values = ["Ab3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0eF3hI6kL9n", "AKIA" + "Q" * 16, "f0" * 15, "client_id: me42", "https://db.example.com/x", "token=abcdef9", "login = someone"]
    rows = []
    for i in range(60):
        parts = [str(rng.choice(values)) if rng.random() < 0.05 else str(rng.choice(words)) for _ in range(int(rng.integers(0, 400)))]
        rows.append((i, "\n".join(parts)))
    rows += [(70, " ".join(["token=abcdef", "é", values[0], values[4]] * 3000)), (None, f"{values[0]} {values[1]}"), (70, "")]
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id long, text string, row int, kind string")
    every = {k: (re.compile(p, re.A), least, g) for k, (p, least, g) in secrets.BASE.items()} | {k: (re.compile(p, re.A), least, 0) for k, (p, least, _) in secrets.WEAK.items()}
    want = []
    for i, t in rows:
        found = [(m.start(), secrets.KINDS.index(k), m.end(), k) for k, (p, least, g) in every.items() for m in p.finditer(t) if len(m[g]) >= least]
        near = {k: np.array(sorted((s, e) for s, _, e, kind in found if kind == k)).reshape(-1, 2) for k in every}
        linked = lambda s, e, k: any(((near[o][:, 0] <= e + 400) & (near[o][:, 1] >= s - 400)).any() for o in secrets.WEAK[k][2])
        kept = sorted(x for x in found if x[3] in secrets.BASE or linked(x[0], x[2], x[3]))
        want.append((i, ",".join(f"{k}:{s}:{e}" for s, _, e, k in kept), sum(k in secrets.WEAK for *_, k in kept)))
    out = [(r.doc_id, r.spans, r.n_linked) for r in secrets.secret_scan(df).collect()]
    assert sorted(out, key=str) == sorted(want, key=str) and sum(n for *_, n in want) > 50
    assert secrets.secret_scan(df.limit(0)).count() == 0


def test_secret_scan_links_keys_and_values(spark):
    access, value = "AKIA" + "B" * 16, "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    before = [f"AWS_ACCESS_KEY_ID={access}\naws_secret_access_key=", "DefaultEndpointsProtocol=https://a.example.com;é AccountKey=", "https://a.example.com/x?sig="]
    texts = [b + v + after for b in before for v in (value, value + "==", value * 20) for after in ("", "\nx", "&y=1", ";z")]
    out = by_id(secrets.secret_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, t in enumerate(texts):
        start = max(t.find(b) + len(b) for b in before if b in t)
        end = re.compile(r"[A-Za-z0-9+/]+={0,2}").match(t, start).end()
        assert f"opaque:{start}:{end}" in out[i].spans.split(","), t
    assert all(r.n_linked == 0 for r in secrets.secret_scan(spark.createDataFrame([(0, f"key={value}"), (1, f"{access} {value}_"), (2, f"{access} {value}===")], "doc_id long, text string")).collect())


def thue_morse(n, a, b):
    """A string of two letters; polynomials modulo a power of two give it and its complement one value."""
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


@pytest.fixture(scope="module")
def odd_ids(spark, cases):
    """The cases with rows that share a doc_id, with equal and different texts, rows without one, and colliding words."""
    rest, passage = " ".join(f"w{i}" for i in range(49)), " ".join(f"v{i}" for i in range(60))
    more = [(-1, f"{thue_morse(1024, 'a', 'b')} {rest}"), (-2, f"{thue_morse(1024, 'b', 'a')} {rest}"), (-3, f"{thue_morse(2048, 'a', 'b')} {rest}"), (-4, f"{thue_morse(2048, 'b', 'a')} {rest}")]
    more += [(None, cases[0][1]), (None, passage), (None, None), (None, cases[0][1]), (1, "short"), (700, passage), (701, passage + " x"), (701, "y " + passage), (701, "short"), (701, "short"), (702, passage)]
    rows = [*cases, *more]
    return rows, spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, place int, spans string").repartition(3)


def kept_symbols(rows, width, symbols):
    """(doc_id, symbols, whether each is removed) of each row, by brute force."""
    parts = [(i, symbols(t or "")) for i, t in rows]
    first = {}
    for i, own in parts:
        for a in range(len(own) - width + 1) if i is not None else ():
            key = tuple(own[a : a + width])
            first[key] = min(i, first.get(key, i))
    for i, own in parts:
        gone = np.zeros(len(own), bool)
        for a in range(len(own) - width + 1) if i is not None else ():
            if first[tuple(own[a : a + width])] < i:
                gone[a : a + width] = True
        yield i, own, gone


@pytest.mark.parametrize("crowded", [20_000, 1])
def test_suffix_dedup(odd_ids, empty, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    rows, df = odd_ids
    want = []
    for i, own, gone in kept_symbols(rows, 50, str.encode):
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((i, len(own), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(own, gone) if not g)).hexdigest()))
    assert sorted(map(tuple, suffix_dedup.suffix_dedup(df).collect()), key=str) == sorted(want, key=str)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_repeat_groups_have_all_occurrences(spark):
    rng, words = np.random.default_rng(8), vocabulary()
    shared = " ".join(rng.choice(words, 12))
    texts = {i: f"{' '.join(rng.choice(words, 5))} {i} {shared[: 90 - 5 * (i % 3)]} {i} {' '.join(rng.choice(words, 5))}" for i in range(9)}
    found = suffix_dedup.repeat_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert found and all(r.length >= 50 for r in found)
    groups = {}
    for r in found:
        groups.setdefault(r.group, set()).add((texts[r.doc_id].encode()[r.start : r.start + r.length], r.doc_id))
    for own in groups.values():
        strings, docs = {s for s, _ in own}, {d for _, d in own}
        assert len(strings) == 1 and len(own) > 1
    assert any(len(own) == 9 for own in groups.values())


def test_maximal_intervals_list_all_occurrences():
    texts = [b"xxABCDEFyy", b"zABCDEFw", b"qABCDEFyy", b"ABC"]
    shard = repeats.Shard(texts, np.arange(4), np.zeros(4, np.int64))
    order, common = suffix_dedup.suffix_array(shard, 3)
    suffix = [shard.values[p : shard.first[shard.of[p] + 1]].tobytes() for p in order]
    assert suffix == sorted(suffix) and all(suffix[i - 1][:c] == suffix[i][:c] for i, c in enumerate(common) if i)
    before = np.array([shard.values[p - 1] if p > shard.first[shard.of[p]] else -1 for p in order])
    groups = {suffix[a][:n]: b - a + 1 for a, b, n, _ in suffix_dedup.maximal_intervals(common, before, shard.doc[shard.of[order]], 3)}
    assert groups == {b"ABC": 4, b"ABCDEF": 3, b"ABCDEFyy": 2}


@pytest.mark.parametrize("crowded", [20_000, 1])
def test_substring_dedup(odd_ids, empty, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    rows, df = odd_ids
    want = [(i, len(own), int(gone.sum()), hashlib.sha256(" ".join(x for x, g in zip(own, gone) if not g).encode()).hexdigest()) for i, own, gone in kept_symbols(rows, 50, WORD.findall)]
    assert sorted(map(tuple, substring_dedup.substring_dedup(df).collect()), key=str) == sorted(want, key=str)
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_matching_statistics():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(1, 40))).encode() for _ in range(12)]
    shard = repeats.Shard(texts, np.arange(12), np.zeros(12, np.int64), np.int64)
    index = substring_dedup.FMIndex(shard)
    length, low, high = substring_dedup.matching_statistics(index, shard, 6)
    words = [t.split() for t in texts]
    all_ends = [(i, j) for i, w in enumerate(words) for j in range(len(w))]
    for k, (i, j) in enumerate(all_ends):
        count = lambda n: sum(words[a][b - n + 1 : b + 1] == words[i][j - n + 1 : j + 1] for a, b in all_ends if b >= n - 1)
        want = max((n for n in range(1, min(6, j + 1) + 1) if count(n) > 1), default=0)
        assert length[k] == want and (not want or high[k] - low[k] == count(want))


def test_only_ends_of_windows_are_searched_for(monkeypatch):
    rng = np.random.default_rng(9)
    common = " ".join(f"c{i}" for i in rng.integers(0, 30, 70))
    texts = [" ".join([*(f"a{k}.{i}" for i in range(20)), common, *(f"b{k}.{i}" for i in range(k))]).encode() for k in range(12)]
    shard = repeats.Shard(texts, np.arange(12), np.zeros(12, np.int64), np.int64)
    index = substring_dedup.FMIndex(shard)
    symbols = np.arange(int(shard.values.max()) + 2)
    all_before = index.matrix.rank(symbols, np.zeros_like(symbols), np.full_like(symbols, len(index.last)))
    coded = np.where(index.last < index.ends, 0, index.last - index.ends + 1)
    assert (all_before[0] == 0).all() and (all_before[1] == np.bincount(coded, minlength=len(symbols))).all()
    asked = []
    rank = substring_dedup.BitVector.rank
    monkeypatch.setattr(substring_dedup.BitVector, "rank", lambda self, at: asked.append(len(at)) or rank(self, at))
    every = substring_dedup.matching_statistics(index, shard, 50)
    most, asked[:] = sum(asked), []
    ends = substring_dedup.matching_statistics(index, shard, 50, 50)
    within = np.arange(len(shard.values)) - shard.first[shard.of]
    assert all((b == np.where(within >= 49, a, 0)).all() for a, b in zip(every, ends)) and (ends[0] == 50).sum() == 12 * 21
    # At most two ranks for each plane, step and end of a window; none for the words before the first end.
    assert sum(asked) <= 2 * index.matrix.bits * 49 * int((within >= 49).sum()) and sum(asked) < most


def test_cut_splits_at_separators_only():
    text = "a\x1cb \x85c\td\u00a0e\x0b\x0cf\u2003g\r\nh ".encode()
    sha = lambda *words: hashlib.sha256(" ".join(words).encode()).hexdigest()
    words = WORD.findall(text.decode())
    assert len(words) == 5 and substring_dedup._cut(text, np.zeros((0, 2), np.int64)) == (5, 0, sha(*words))
    assert substring_dedup._cut(text, np.array([[0, 1], [2, 4]])) == (5, 3, sha(words[1], words[4]))
    assert substring_dedup._cut(b"", np.zeros((0, 2), np.int64)) == (0, 0, sha())


def test_bit_vector_ranks():
    bits = np.random.default_rng(6).integers(0, 2, 1000).astype(np.uint8)
    for n in (0, 1, 63, 64, 65, 1000):
        assert (substring_dedup.BitVector(bits[:n]).rank(np.arange(n + 1)) == np.concatenate([[0], np.cumsum(bits[:n])])).all()


def test_hashes_tell_structured_strings_apart():
    for n in (16, 64, 1024, 4096):
        x, y = thue_morse(n, "a", "b").encode(), thue_morse(n, "b", "a").encode()
        one, two = grams.Words([x, y]).hash
        assert one != two and len(set(grams.span_hash(np.frombuffer(x + y, np.uint8), np.array([0, n]), np.array([n, 2 * n])).tolist())) == 2
    bounds = grams.exact_sets([b"A b c d e f", b"a b", b"", b"a b c d e f a b c d e"], 5, grams.LOWER)
    assert [len(x) for x in bounds] == [2, 1, 0, 6] and set(bounds[0]) <= set(bounds[3])


def test_html_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a> <a>News</a></nav><div class="cookie-notice">We use cookies on this site, please accept them all.</div>
    <main><article class="post"><header><h1>The   head&amp;line</h1></header><p>First para<b>graph</b> that has quite a lot of text in it, so that it surges.<p>Of.</p><div class="ad">Buy now, buy now, buy now, it is cheap</div>
    <script>var a = "<p>no</p>";</script><p>Last&nbsp;&#x41;&lt;x&gt; one, also long enough to be counted as the text.</p></article></main>
    <section id="comments"><article class="comment"><p>A reader says something that is rather long, longer than a line.</p></article></section>
    <form><p>Your mail <input name=m></p></form><footer>&copy; someone, all of whose rights are reserved, and more words</footer></body></html>"""
    assert html_text.main_text(page) == "The head&line First paragraph that has quite a lot of text in it, so that it surges. Of. Last A<x> one, also long enough to be counted as the text."
    assert html_text.main_text("") == "" and html_text.main_text("<p>only</p>") == "only" and html_text.main_text("<script>x") == ""


def test_html_text_keeps_articles_whole():
    lead, body, end = "The lead. " * 20, "".join(f"<p>{f'Paragraph {i}. ' * 20}</p>" for i in range(25)), "The ending. " * 10
    text = " ".join([lead.strip(), *(f"Paragraph {i}. " * 19 + f"Paragraph {i}." for i in range(25)), end.strip()])
    for tag in ("article", "main"):
        for cut in ("<aside>Buy this now</aside>", "<nav><a href=x>One</a></nav>", "<footer>Written by someone</footer>"):
            assert html_text.main_text(f"<body><{tag}><p>{lead}</p>{cut}{body}{cut}<p>{end}</p></{tag}></body>") == text
    links = "".join(f"<li><a href=x>Source {i}</a></li>" for i in range(5))
    sources = " ".join(f"Source {i}" for i in range(5))
    page = f"<body><nav>{links}</nav><article><h1><a href=x>Title</a></h1><p>{lead}</p><ul>{links}</ul>{body}<article><p>{end}</p></article><ul>{links}</ul></article><p>Outside.</p></body>"
    assert html_text.main_text(page) == " ".join(["Title", lead.strip(), sources, text[len(lead):], sources])
    assert html_text.main_text(f"<body><section><p>{lead}</p></section><section>{body}</section><section><p>{end}</p></section></body>") == text
    assert html_text.main_text(f"<body><main><article>{body}</article><article><p>Another, and shorter text that still surges.</p></article></main></body>") == text[len(lead) : -len(end)]


HTML_TEXT = "Some words of text that go on. "
HTML_LONG, HTML_SHORT = (HTML_TEXT * 15).strip(), HTML_TEXT.strip()
HTML_LINKS = "<ul>" + "".join(f"<li><a href=x>Link {i}</a></li>" for i in range(5)) + "</ul>"
HTML_LINKED = " ".join(f"Link {i}" for i in range(5))
#: Labelled layouts: body of a page, its main text.
LAYOUTS = [
    (f"<article><h1><a href=x>Headline</a></h1><p>{HTML_LONG}</p><p><a href=x>last paragraph</a></p></article>", f"Headline {HTML_LONG} last paragraph"),
    (f"<article><p>{HTML_LONG}</p>{HTML_LINKS}<p>End.</p></article>", f"{HTML_LONG} {HTML_LINKED} End."),
    (f"<article><p class='tags'>{HTML_SHORT}</p><p class='search'>Q.</p><p>{HTML_LONG}</p></article>", f"{HTML_SHORT} Q. {HTML_LONG}"),
    (f"<nav>{HTML_LINKS}</nav><div id=content><h1><a href=x>Headline</a></h1><p>{HTML_LONG}</p><p>End.</p></div>", f"Headline {HTML_LONG} End."),
    (f"<nav>{HTML_LINKS}</nav><div><p>{HTML_LONG}</p>{HTML_LINKS}<p>End.</p></div><footer>{HTML_LONG}</footer>", f"{HTML_LONG} {HTML_LINKED} End."),
    (f"<header><h1>Site</h1>{HTML_LINKS}</header><main><h1>Head</h1><p>{HTML_LONG}</p></main><aside>{HTML_LONG}</aside>", f"Head {HTML_LONG}"),
    (f"<main><article><h2>Head</h2><p>{HTML_LONG}</p></article><section class=comments><p>{HTML_LONG}</p></section></main>", f"Head {HTML_LONG}"),
    (f"<article><p>{HTML_LONG}</p><div class='ad'>{HTML_SHORT}</div><p>{HTML_LONG}</p></article>", f"{HTML_LONG} {HTML_LONG}"),
    (f"<article><p>{HTML_LONG}</p><p class='sponsored advert'>{HTML_SHORT}</p><p>End.</p></article>", f"{HTML_LONG} End."),
    (f"<div class='cookie-consent'>{HTML_LONG}</div><article><p>{HTML_LONG}</p></article>", HTML_LONG),
    (f"<div role=navigation>{HTML_LINKS}</div><div class=post><p>{HTML_LONG}</p></div><div class=sidebar><p>{HTML_LONG}</p></div>", HTML_LONG),
    (f"<article><p>{HTML_LONG}</p><form><p>{HTML_SHORT}</p><button>Go</button></form></article>", HTML_LONG),
    (f"<article><p>{HTML_LONG}</p><table><tr><td>a</td><td>b</td></tr></table></article>", f"{HTML_LONG} a b"),
    (f"<article><h1>A</h1><pre>x  y\n z</pre><p>{HTML_LONG}</p></article>", f"A x y z {HTML_LONG}"),
    (f"<article><p>{HTML_LONG}<p>Two<br>lines<p>&lt;b&gt; &eacute;&#233;</article>", f"{HTML_LONG} Two lines <b> éé"),
    (f"<article><p>{HTML_LONG}</p><!-- <p>no</p> --><script>'<p>no</p>'</script><style>p{{}}</style><noscript>no</noscript></article>", HTML_LONG),
    (f"<article><blockquote>{HTML_SHORT}</blockquote><p>{HTML_LONG}</p><figure><figcaption>Caption</figcaption></figure></article>", f"{HTML_SHORT} {HTML_LONG} Caption"),
    (f"<section><p>{HTML_LONG}</p></section><section><p>{HTML_LONG}</p></section>", f"{HTML_LONG} {HTML_LONG}"),
    (f"<article><header><h1>Head</h1></header><p>{HTML_LONG}</p><footer>{HTML_SHORT}</footer></article>", f"Head {HTML_LONG}"),
    (f"<ARTICLE><P>{HTML_LONG}</P><ASIDE>{HTML_LONG}</ASIDE></ARTICLE><FOOTER>{HTML_SHORT}</FOOTER>", HTML_LONG),
    (f"<article><p>{HTML_LONG}</p><div hidden>{HTML_SHORT}</div><div style='display: none'>no</div></article>", HTML_LONG),
    (f"<p>{HTML_SHORT}</p>", HTML_SHORT),
]


@pytest.mark.parametrize("i", range(len(LAYOUTS)))
def test_html_layouts(i):
    body, want = LAYOUTS[i]
    assert html_text.main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>") == want


def test_html_extraction_against_the_labelled_parts_of_pages(spark):
    """The pages of the driver's tables hold their text in one article, between a menu, an advert and a footer."""
    import html as entities

    pages = load(spark, SF, "pages")
    out = {r.page_id: r for r in html_text.extract(pages).collect()}
    seen = 0
    for r in pages.collect():
        if r.html and (m := re.search(r"<article>(.*)</article>", r.html, re.S)):
            bare = re.sub(r'<div class="ad">.*?</div>|<!--.*?-->|<script.*?</script>|<style.*?</style>', " ", m[1], flags=re.S)
            blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h\d|li|ul|ol|br|div|table|tr|td|pre|blockquote)\b[^>]*>", bare)]
            assert out[r.page_id].text == " ".join(x for x in blocks if x), r.page_id
            seen += 1
    assert seen >= 40


def test_html_extraction(spark):
    long = "<p>" + "word é " * 200_000 + "</p>"
    df = spark.createDataFrame([(1, "u", None, 3), (2, None, "<p>a b</p>", 3), (2, None, "<p>a b</p>", 3), (None, None, "<p>é</p>", 3), (3, "", long, 3)], "page_id long, url string, html string, text int")
    assert sorted(((r.page_id, r.text[:9], r.n_chars) for r in html_text.extract(df).collect()), key=str) == sorted([(1, "", 0), (2, "a b", 3), (2, "a b", 3), (None, "é", 1), (3, "word é wo", 1_399_999)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def test_packing(docs, cases, empty):
    from tokenizers import Tokenizer

    odd = [(500, "<|endoftext|> it's don't ﬁ É $$$. 12,5 x.y. ΑΣ. ..., a b!"), (501, "word, " * 6000)]
    more = docs.unionByName(docs.sparkSession.createDataFrame(odd, "doc_id long, text string"), allowMissingColumns=True)
    own, window = Tokenizer.from_file(queries.TOKENIZER), 256
    out = packing.pack(more, queries.TOKENIZER, window).toPandas()
    for i, t in [*cases, *odd]:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        rows = out[out.doc_id == i].sort_values("start")
        assert rows.length.sum() == len(ids) and (rows.doc_tokens == len(ids)).all() and rows.start.tolist() == [0, *rows.length.cumsum()[:-1]]
        assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(rows.start, rows.length)] == rows.ids_crc32.tolist()
    for _, rows in out.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *rows.length.cumsum()[:-1]] and rows.length.sum() <= window
    assert packing.pack(empty, queries.TOKENIZER).count() == 0
    rows = docs.sparkSession.createDataFrame([(7, "a b", 1), (7, "a b", 1), (None, "c", 2), (2**60 + 1, None, 3)], "doc_id long, text string, part int")
    again = packing.pack(rows, queries.TOKENIZER, window).collect()
    assert sorted((r.doc_id for r in again), key=str) == sorted([7, 7, None, 2**60 + 1], key=str) and len({(r.sequence_id, r.offset) for r in again}) == 4


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    histogram = {int(n): int(c) for n, c in zip(*np.unique(rng.integers(1, 257, 5000), return_counts=True))}
    used = {}
    for lengths, times in packing.plan(histogram, 256):
        assert sum(lengths) <= 256 and times > 0
        for n in lengths:
            used[n] = used.get(n, 0) + times
    assert used == histogram


def test_leaks(spark, docs, empty):
    rng, words = np.random.default_rng(11), vocabulary()
    item = " ".join(rng.choice(words, 20))
    items = spark.createDataFrame([(i, t, 5, "x") for i, t in [(0, item), (1, "alpha beta"), (2, ""), (3, None), (4, " ".join(rng.choice(words, 30))), (0, item), (None, "gamma delta epsilon")]], "item_id long, text string, item int, hash string")
    texts = [(900, f"x {item.upper()}, y"), (901, " ".join(item.split()[:10])), (902, "x Alpha, beta y"), (903, "alpha x beta"), (904, None), (905, " ".join(item.split()[:17] + ["q"] * 4000)), (None, f"{item} gamma delta epsilon"), (906, "x gamma; delta -- epsilon."), (902, "Alpha beta")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, row int, leaked int").unionByName(docs.select("doc_id", "text"), allowMissingColumns=True)
    want = [(900, 0, 16), (902, 1, 1), (902, 1, 1), (905, 0, 13), (None, 0, 16), (None, None, 1), (906, None, 1)]
    assert sorted(((r.doc_id, r.item_id, r.n_shared) for r in decontaminate.leaks(df, items).collect()), key=str) == sorted(want, key=str)
    kept = decontaminate.decontaminate(df, items)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r.doc_id for r in df.collect() if r.doc_id not in (900, 902, 905, 906)), key=str)
    assert decontaminate.leaks(empty, items).count() == 0 and decontaminate.leaks(df, items.limit(0)).count() == 0


def test_leaks_against_brute_force(spark):
    rng, words = np.random.default_rng(31), vocabulary()
    items = [(i, " ".join(rng.choice(words, int(n)))) for i, n in enumerate(rng.integers(1, 60, 40))]
    docs = []
    for i in range(60):
        own = str(items[int(rng.integers(40))][1]).split()
        a = int(rng.integers(0, max(1, len(own) // 4)))
        own = own[a : len(own) - int(rng.integers(0, max(1, len(own) // 4)))]
        docs.append((i, " ".join([*rng.choice(words, 50), *own, *rng.choice(words, 50)])))
    sets = lambda t, k: {tuple(t.split()[j : j + k]) for j in range(len(t.split()) - k + 1)}
    want = set()
    for i, t in items:
        k = min(5, len(t.split()))
        own = sets(t, k)
        want |= {(d, i, len(own & sets(x, k))) for d, x in docs if 4 * len(own & sets(x, k)) >= 3 * len(own)}
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.n_shared) for r in found.collect()} == want and len(want) > 20


def test_license_scan(spark):
    mit = "Copyright (c) 2020 Some One\n\n" + licenses.MIT.replace("copies", "copies").upper().replace('"', "“")
    texts = [(0, mit), (1, "x\nLicensed under the Apache Licence, Version 2.0.\ny"), (2, None), (3, ""), (4, "no license here"), (5, licenses.MIT + " and more"), (0, mit)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, row int, license_id string")
    out = licenses.license_scan(df).collect()
    assert len(out) == len(texts) and licenses.license_scan(df.limit(0)).count() == 0
    assert [r.license_id for r in licenses.license_scan(spark.createDataFrame([(None, mit)], "doc_id long, text string")).collect()] == ["MIT"]
    got = {r.doc_id: (r.license_id, r.notices) for r in out}
    assert got == {0: ("MIT", []), 1: (None, ["Apache-2.0"]), 2: (None, []), 3: (None, []), 4: (None, []), 5: (None, [])}


def test_license_scan_knows_the_notices_of_documents(spark):
    gpl = (licenses.Path(licenses.__file__).parent / "license_texts" / "GPL-3.0.txt").read_text("utf-8")
    one_line = " ".join(licenses.MIT.split())
    texts = [(0, "x\nThis work is licensed under the GNU General Public License, version 3.\ny"), (1, "x\nLicensed under CC BY-NC 4.0.\ny"), (2, "x\n" + one_line + "\ny"),
             (3, gpl), (4, "This project is licensed under a Creative Commons Attribution-ShareAlike 4.0 International Licence"), (5, f"Licensed under CC BY-NC 4.0. {'and more ' * 60}")]
    got = {r.doc_id: (r.license_id, r.notices) for r in licenses.license_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {0: (None, ["GPL-3.0"]), 1: (None, ["CC-BY-NC-4.0"]), 2: (None, ["MIT"]), 3: ("GPL-3.0", []), 4: ("CC-BY-SA-4.0", ["CC-BY-SA-4.0"]), 5: (None, [])}
    odd = spark.createDataFrame([(t,) for t in ["", "\n \n", "Copyright 2020 X\r\nΑΣ\n\u2028a\r b\n-\nc’s", gpl, one_line]], "text string")
    assert all(r[0] == r[1] for r in odd.select(licenses.canonical(F.col("text")), F.array_join(licenses.canonical_lines(F.col("text")), " ")).collect())


def test_toxicity_learns_held_in_labels_only(spark):
    rng, words = np.random.default_rng(7), vocabulary()
    bad = ["scoundrel", "vermin", "dastard"]
    texts = [(i, " ".join([*rng.choice(words, 60), *(rng.choice(bad, 3) if i % 6 == 0 else [])])) for i in range(600)]
    df = spark.createDataFrame([*texts, (1000, None), (1001, "")], "doc_id long, text string").withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.train(df, labels.where(~toxicity.held_out(F.col("doc_id"))))
    out = by_id(toxicity.toxicity(df, model))
    tested = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([out[i].predicted == int(i % 6 == 0) for i in tested]) > 0.97
    assert out[1000].predicted == out[1001].predicted == 0 and all(0 <= r.score <= 1 for r in out.values())
    assert toxicity.train(df, labels.where("toxic = 0")) is None
    assert toxicity.toxicity(df, None).count() == 602 and toxicity.toxicity(df.limit(0), model).count() == 0


def test_toxicity_learns_from_short_and_similar_texts(spark):
    """The longest word of all toxic texts is one slur; columns clash with names used inside; few labels."""
    rng, words = np.random.default_rng(17), vocabulary()
    texts = [(i, " ".join([*rng.choice(words, 30), *(["scoundrelousness"] if i % 5 == 0 else [])])) for i in range(120)]
    df = spark.createDataFrame([(i, t, 1, "a", 2.0, [1], "x") for i, t in [*texts, (None, "scoundrelousness"), (900, None), (900, "scoundrelousness " * 30_000)]],
                               "doc_id long, text string, words int, hits string, strongest double, found array<int>, `my col.x` string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 3) for i in range(120)] + [(None, 1, 3), (3, None, 3)], "doc_id long, toxic int, text int")
    out = toxicity.without_toxic(df, labels)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(i, t) for i, t in texts if i % 5] + [(900, None)], key=str)
    few = toxicity.train(df.where("doc_id < 40"), labels)
    scored = by_id(toxicity.toxicity(df.where("doc_id < 120"), few))
    assert all(scored[i].predicted == int(i % 5 == 0) for i in range(120))


def test_toxicity_learns_from_texts_with_the_same_longest_words(spark):
    """A notice that all texts hold doesn't make them copies; two hundred near copies of one toxic text count as one."""
    rng, words, bad = np.random.default_rng(19), vocabulary(1500), ["vermin", "dastard", "scoundrel", "lowlife"]
    notice = "copyrightedpublication {} allrightsreservedworldwide termsandconditionsapply"
    texts = [(i, notice.format(" ".join([*rng.choice(words, 40), *(rng.choice(bad, 2, replace=False) if i % 2 else [])]))) for i in range(400)]
    labels = [(i, i % 2) for i in range(400)]
    copied = [f"oddity{i}" for i in range(200)]
    near = [(1000 + i, " ".join([*copied[:i], f"edit{i}", *copied[i + 1 :], "vermin"])) for i in range(200)]
    df = spark.createDataFrame([*texts, *near], "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame([*[x for x in labels if x[0] % 3], *[(i, 1) for i, _ in near]], "doc_id long, toxic int"))
    clean = [(2000 + i, " ".join([*rng.choice(words, 40), *rng.choice(copied, 3)])) for i in range(100)]
    out = by_id(toxicity.toxicity(df.unionByName(spark.createDataFrame(clean, "doc_id long, text string")), model))
    assert all(out[i].predicted == i % 2 for i in range(0, 400, 3))
    assert not any(out[i].predicted for i, _ in clean)


def test_toxicity_score_by_hand(spark):
    """Scores are those of the formula on hits that are counted window by window."""
    rng, words = np.random.default_rng(18), vocabulary()
    texts = [(i, " ".join([*rng.choice(words, int(rng.integers(0, 50))), *(["vermin"] * int(rng.integers(0, 4)) if i % 4 == 0 else [])])) for i in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame([(i, int("vermin" in t)) for i, t in texts], "doc_id long, toxic int"))
    out = by_id(toxicity.toxicity(df, model))
    for i, t in texts:
        own = re.findall(r"[^\W\d_]+", t.lower())
        hits = sum(model.gains(w) >= model.threshold for w in own)
        a, b, c = model.weights
        assert (out[i].hits, out[i].words) == (hits, len(own)) and abs(out[i].score - 1 / (1 + np.exp(-(a + b * min(hits, 8) + c * hits / max(1, len(own)))))) < 1e-9


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours, theirs = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    # A column of whole numbers with nulls is one of floats in pandas, or one with its own null.
    one = lambda x: str(list(x)) if isinstance(x, (list, np.ndarray)) else "null" if pd.isna(x) else str(int(x)) if isinstance(x, float) and x.is_integer() else str(x)
    plain = lambda df: sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False))
    assert plain(ours) == plain(theirs)


def test_pipeline_stages_against_brute_force(spark):
    """Each stage on what the one before it kept, as run() does, against what a plain reading of its rule keeps."""
    docs = materialise(load(spark, SF, "documents").unionByName(spark.createDataFrame([(10**6, "", "en", "s", 0), (10**6 + 1, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")))
    columns, stages = sorted(docs.columns), dict(corpus_pipeline.STAGES)
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    labels = load(spark, SF, "labels")

    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    score = lambda t: sum(model.gains(w) >= model.threshold for w in re.findall(r"[^\W\d_]+", t.lower()))
    toxic = {r.doc_id for r in toxicity.toxicity(docs, model).where("predicted = 1").collect()}
    assert model and all(score(text[i]) > 0 for i in toxic)
    docs = materialise(stages["toxicity"](spark, docs, SF))
    assert sorted(docs.columns) == columns and {r.doc_id for r in docs.collect()} == set(text) - toxic
    left = {i: t for i, t in text.items() if i not in toxic}

    docs = materialise(stages["exact_dedup"](spark, docs, SF))
    best = {}
    for i, t in left.items():
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (1, 0)), (-len(t), i)) if key in best else (-len(t), i)
    left = {i: left[i] for _, i in best.values()}
    assert sorted(docs.columns) == columns and {r.doc_id for r in docs.collect()} == set(left)

    docs = materialise(stages["ngram_jaccard_join"](spark, docs, SF))
    sets = {i: shingles(t) for i, t in left.items()}
    where = {}
    for i, own in sets.items():
        for g in own:
            where.setdefault(g, []).append(i)
    pairs = {(a, b) for own in where.values() for a in own for b in own if a < b}
    root = classes(sets, [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])
    left = {i: t for i, t in left.items() if root[i] == i}
    assert sorted(docs.columns) == columns and {r.doc_id for r in docs.collect()} == set(left)

    docs = materialise(stages["decontamination"](spark, docs, SF))
    plain = lambda t: (t or "").encode().translate(grams.LOWER_WORDS).split()
    parts = {i: plain(t) for i, t in left.items()}
    leaked = set()
    for r in load(spark, SF, "benchmark").collect():
        own = plain(r.text)
        k = min(5, len(own))
        wanted = {tuple(own[j : j + k]) for j in range(len(own) - k + 1)} if k else set()
        leaked |= {i for i, w in parts.items() if wanted and 4 * len(wanted & {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}) >= 3 * len(wanted)}
    left = {i: t for i, t in left.items() if i not in leaked}
    assert sorted(docs.columns) == columns and {r.doc_id for r in docs.collect()} == set(left) and leaked

    from tokenizers import Tokenizer

    own, out = Tokenizer.from_file(queries.TOKENIZER), stages["packing"](spark, docs, SF).toPandas()
    size = {i: len(own.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}
    assert out.groupby("doc_id").length.sum().to_dict() == size and out.groupby("sequence_id").length.sum().max() <= 2048


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from candlelake.llm import common

    for master, fails in (("local[4]", False), ("local", False), ("local-cluster[2,1,1024]", True), ("spark://host:7077", True), ("k8s://x", True)):
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master))
        if fails:
            with pytest.raises(ValueError):
                common.scratch_dir(session)
        else:
            assert common.scratch_dir(session)
