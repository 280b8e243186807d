"""Nearest neighbours, periodic runs and spelling variants against brute force on small fixtures: nulls, empty and long texts,
ties, repeated rows, empty tables, extra columns with clashing names."""

import glob
import hashlib
import os
import random
import re
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlelake.llm import collisions, licenses, periodic, queries, spelling
from candlelake.llm.common import load

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, row long, runs int, word string, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "k", 3) for i, t in rows], DOCS).repartition(3)


@pytest.mark.parametrize("name", ["op12_periodic_runs", "op13_spelling_variants"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    plain = lambda d: Counter(tuple(None if pd.isna(x) else x if isinstance(x, str) else int(x) for x in r) for r in d[sorted(d.columns)].itertuples(index=False))
    ours, theirs = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and plain(ours) == plain(theirs)


# --- Nearest neighbours ---------------------------------------------------------------------------------------------


def brute_force(ids, vectors, asked, k):
    out = {}
    for i in asked:
        scores = (vectors * vectors[i]).sum(1)
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def recall_of(found, want):
    rows = {q: d.sort_values("rank") for q, d in found.groupby("query_id")}
    hits = total = 0
    for q, best in want.items():
        got = rows[q]
        assert list(got["rank"]) == list(range(1, len(best) + 1))
        assert [(-s, i) for s, i in zip(got.score, got.vec_id)] == sorted((-s, i) for s, i in zip(got.score, got.vec_id))
        hits += len({i for i, _ in best} & set(got.vec_id))
        total += len(best)
    return hits / total


def vectors_of(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v], "other") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string").repartition(4)


@pytest.mark.parametrize("kind", ["sphere", "norms", "clusters", "ties", "short"])
def test_recall_and_exact_scores(spark, kind, monkeypatch):
    monkeypatch.setattr(collisions, "SHARD_VALUES", 4_000)
    monkeypatch.setattr(collisions, "BLOCK_VALUES", 500)
    monkeypatch.setattr(collisions, "TASK_VALUES", 1_000)
    rng = np.random.default_rng(3)
    dimension = {"short": 3}.get(kind, 24)
    v = rng.normal(size=(900, dimension))
    if kind == "sphere":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    elif kind == "norms":
        v *= rng.lognormal(0, 1.5, size=(900, 1))
    elif kind == "clusters":
        v = rng.normal(size=(12, dimension))[rng.integers(0, 12, 900)] * 4 + v
    elif kind == "ties":
        v[:400] = v[0]
        v[400:600] = -v[0]
    ids = rng.permutation(3000)[:900]
    found = collisions.nearest(vectors_of(spark, ids, v), F.col("vec_id") % 20 == 0, 20).toPandas()
    want = brute_force(ids, v, np.flatnonzero(ids % 20 == 0), 20)
    assert recall_of(found, want) >= 0.95
    at = {int(i): k for k, i in enumerate(ids)}
    assert all(s == (v[at[q]] * v[at[i]]).sum() for q, i, s in zip(found.query_id, found.vec_id, found.score))
    if kind == "ties":  # equal vectors, smallest ids first
        for q, best in want.items():
            if at[q] < 400:
                assert list(found[found.query_id == q].sort_values("rank").vec_id) == [i for i, _ in best]


def test_recall_on_the_given_vectors(spark):
    found = queries.QUERIES["op11_nearest_neighbours"](spark, SF).toPandas()
    rows = load(spark, SF, "embeddings").toPandas()
    ids, v = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float)
    assert recall_of(found, brute_force(ids, v, np.flatnonzero(ids % 20 == 0), 20)) >= 0.95


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [9.0, 9.0]), (8, [1.0, 2.0, 3.0]), (20, [1.0, 1.0]), (20, [1.0, 1.0]), (40, [0.0, 0.0]), (60, [5.0, 5.0, 5.0]), (9, [-3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collisions.nearest(df, F.col("vec_id") % 20 == 0, 3)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    assert got == {(0, 1): (1, 2.0), (0, 2): (20, 1.0), (0, 3): (9, -3.0), (20, 1): (1, 3.0), (20, 2): (0, 1.0), (20, 3): (9, -3.0), (60, 1): (8, 30.0)}
    assert collisions.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert collisions.nearest(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


# --- Periodic runs --------------------------------------------------------------------------------------------------


def runs_of(words):
    """start, period, length of all runs, by comparing all places of all periods."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q) and j > i:
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, q, length) for (s, length), q in best.items())


def described(words):
    runs, gone = runs_of(words), set()
    for s, q, length in runs:
        gone |= set(range(s + q, s + length))
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    head = (None,) * 4 if best is None else (best[0], best[2], best[1], 1000 * best[2] // best[1])
    return (len(runs), *head, sha("".join(f"{s},{length},{q}\n" for s, q, length in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.fixture(scope="module")
def periodic_cases():
    rnd = random.Random(5)
    out = [None, "", " \t\n", "a", "a " * 11, "a " * 12, "a\n" * 13, "a b " * 6, "x " + "a b c d e f " * 2, "a b c d e f a b c d e " + "z", "é ü " * 50, "a b " * 40 + "c " + "a b " * 40, "w " * 3000]
    for n in (30, 100, 400, 1500):
        for k in (1, 2, 3, 30, 1000):
            w = [f"w{rnd.randrange(k)}" for _ in range(n)]
            for _ in range(4):
                a, p = rnd.randrange(n), rnd.randrange(1, n // 2)
                for i in range(a + p, min(n, a + int(p * rnd.choice([2, 2.3, 4, 15])))):
                    w[i] = w[i - p]
            out.append(rnd.choice([" ", "\n", "\t "]).join(w))
    return list(enumerate(out))


@pytest.mark.parametrize("tile", [64, 256, periodic.TILE])
def test_periodic_runs(spark, periodic_cases, tile):
    rows = [*periodic_cases, (None, "a b " * 9), (None, "a b " * 9), (3, "a b c " * 9), (3, None)]
    found = periodic.periodic_runs(table(spark, rows), tile).collect()
    plain = lambda r: (r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
    want = Counter((i, *described(WORD.findall(t or ""))) for i, t in rows)
    assert Counter(map(plain, found)) == want
    assert all([tuple(x) for x in r.runs] == sorted(tuple(x) for x in r.runs) and len(r.runs) == r.n_runs for r in found)
    assert periodic.periodic_runs(table(spark, rows).limit(0), tile).count() == 0


def stretches_of(codes, lowest, highest):
    """period, low, high of the stretches that equal_stretches promises, by comparing all places."""
    out = set()
    for q in range(lowest, highest + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], codes[q:] == codes[:-q], [False]]).astype(int)))
        out |= {(q, a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= max(12 - q, q) or a == 0 and b >= 6}
    return out


@pytest.mark.parametrize("dense", [0, 2, 32, 10**6])
def test_equal_stretches_with_and_without_z_functions(monkeypatch, dense):
    monkeypatch.setattr(periodic, "DENSE", dense)
    monkeypatch.setattr(periodic, "BLOCK", 64)
    rng = np.random.default_rng(8)
    for n in (12, 13, 40, 300, 900):
        for kinds, p in ((1, 1), (2, 3), (3, 9), (1000, 17), (1000, n // 3), (1000, n // 2)):
            codes = rng.integers(0, kinds, n).astype("<i4")
            a = int(rng.integers(0, n // 4))
            codes[a:] = codes[a + np.arange(n - a) % p]
            codes[rng.integers(0, n, n // 200)] = 5000
            for lowest, highest in ((1, n // 2), (8, min(15, n // 2))):
                if lowest > highest:
                    continue
                found = list(zip(*(x.tolist() for x in periodic.equal_stretches(codes, lowest, highest))))
                want = stretches_of(codes, lowest, highest)
                own = {(q, low, high) for q, low, high in found if high - low >= max(12 - q, q) or low == 0 and high >= 6}
                assert len(found) == len(set(found)) and own == want


def test_few_periods_need_no_z_functions(monkeypatch):
    calls, z_function = [], periodic.z_function
    monkeypatch.setattr(periodic, "z_function", lambda s: calls.append(len(s)) or z_function(s))
    codes = np.concatenate([np.arange(100), 200 + np.arange(800) % 40]).astype("<i4")
    period, low, high = periodic.equal_stretches(codes, 1, 450)
    assert sorted(zip(period.tolist(), low.tolist(), high.tolist())) == [(q, 100, 900 - q) for q in range(40, 441, 40)] and not calls
    periodic.equal_stretches(np.zeros(900, "<i4"), 1, 450)
    assert calls  # all periods of long octaves from every boundary


def test_documents_and_tiles_are_taken_together(monkeypatch):
    calls, next_same = [], periodic.next_same
    monkeypatch.setattr(periodic, "next_same", lambda *a: calls.append(len(a[0])) or next_same(*a))
    texts = ["a b c d e f", "a b c d e f", "", "x " * 30, "q a b c d e f r", " a\x1cb\u00a0c\t" * 20]
    batch = pd.DataFrame({"row": range(6), "doc_id": list("012345"), "text": texts})
    out = pd.concat(periodic._explode(iter([batch]), periodic.TILE), ignore_index=True)
    assert len(calls) == 1
    heads, live = out[out["codes"].isna()], out[out["codes"].notna()]
    assert heads["n"].tolist() == [6, 6, 0, 30, 8, 20] and heads["sha256"].tolist() == [hashlib.sha256(" ".join(WORD.findall(t)).encode()).hexdigest() for t in texts]
    assert set(live["row"]) - {2} == {3, 5}  # grams that come again in another document don't count
    tiles = live[["row", "n", "lowest", "highest", "start", "codes"]].astype({c: "int64" for c in ("n", "lowest", "highest", "start")})
    frames = list(periodic._solve(iter([tiles])))
    assert len(frames) == 1 and set(frames[0]["row"]) == {3, 5}


def test_planted_runs_are_found(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(0, 120)))) for i in range(400)] + [(None, "a b c"), (401, None)]
    found = {r.doc_id: r for r in periodic.periodic_runs(periodic.with_planted_runs(table(spark, rows))).collect()}
    planted = 0
    for i, text in rows:
        words = WORD.findall(text or "")
        h = None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        r = found[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == described(words)
    assert planted > 20


# --- Spelling variants ----------------------------------------------------------------------------------------------


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows, every=None):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = None if i is None else zlib.crc32(f"{i}:{run}".encode())
            if every and h is not None and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    out = {}
    for w in n:
        close = [x for x in n if x != w and near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = [form, n[w], len(close), None if form is None else n[form]]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w].append(root)
    return out


@pytest.mark.parametrize("every", [None, 3])
def test_spelling_variants(spark, every):
    rnd = random.Random(7)
    stems = ["".join(rnd.choice("abcdeéÉß") for _ in range(rnd.randrange(6, 12))) for _ in range(15)] + ["banana", "bananas", "aaaaaa", "aaaaaaa", "aaaaaaaa", "abcabc", "xabcabc", "abcxabc", "abcabd", "ibcabc"]
    words = []
    for depth, s in enumerate(stems):
        for times in (700, 120, 22, 5):  # chains of forms
            words += [s] * times
            k = rnd.randrange(len(s) + 1)
            s = rnd.choice([s[:k] + rnd.choice("abcé") + s[k:], s[: max(0, k - 1)] + s[k:], s[: max(0, k - 1)] + "z" + s[k:]])
    rnd.shuffle(words)
    rows = [(i, rnd.choice([" ", "-", "7"]).join(words[100 * i : 100 * i + 100]).upper() if i % 7 == 0 else " ".join(words[100 * i : 100 * i + 100])) for i in range(len(words) // 100 + 1)]
    rows += [(None, "BANANA banana"), (1, "banana"), (1, "banana"), (5, None), (6, ""), (8, "日本語" + "x" * 5), (9, "q" * 20_000)]
    found = {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in spelling.spelling_variants(table(spark, rows), misspell_every=every).collect()}
    want = variants(rows, every)
    assert found == want
    assert sum(x[4] != (x[0] or w) for w, x in want.items()) > 3  # roots further off than forms
    assert spelling.spelling_variants(table(spark, rows).limit(0)).count() == 0


# --- Licences -------------------------------------------------------------------------------------------------------


def wrapped(text, width):
    """The same paragraphs at another line width."""
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in re.split(r"\n[ \t]*\n", text))


def test_licences_are_known_however_their_lines_break(spark):
    texts = {p.stem: p.read_text("utf-8") for p in (licenses.Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    texts |= {"MIT": licenses.MIT, "ISC": licenses.ISC, "Zlib": licenses.ZLIB}
    own = "Copyright (c) 2021 Some One\n\n"
    shapes = {f"width {w}": (lambda t, w=w: wrapped(t, w)) for w in (40, 60, 72, 100, 10_000)} | {
        "crlf": lambda t: t.replace("\n", "\r\n"), "double spaces": lambda t: t.replace(" ", "  "), "tabs": lambda t: t.replace("\n", "\n\t"), "upper": lambda t: t.upper(), "british": lambda t: t.replace("license", "licence")}
    rows, want = [], {}
    for name, text in texts.items():
        for shape, change in shapes.items():
            for head in ("", own):
                if head and name not in ("MIT", "ISC", "Zlib"):
                    continue
                want[len(rows)] = (name, shape, head)
                rows.append((len(rows), head + change(text)))
        want[len(rows)] = (None, "a word more", "")
        rows.append((len(rows), text + " word"))
    found = {r.doc_id: r.license_id for r in licenses.license_scan(table(spark, rows)).collect()}
    assert [(w, found[i]) for i, w in want.items() if found[i] != w[0]] == []


def test_notices_with_other_white_space(spark):
    rows = [(0, "Licensed under the Mozilla Public License, Version\n2.0."), (1, "x\nLicensed under the Mozilla Public License, Version  2.0.\ny"), (2, "x\nLicensed under the Mozilla Public Licence,\tversion 2.0\r\ny"), (3, "x\nLicensed under GPLv2\ny"), (4, "Licensed under the v2 thing")]
    found = {r.doc_id: (r.license_id, r.notices) for r in licenses.license_scan(table(spark, rows)).collect()}
    assert found == {0: ("MPL-2.0", []), 1: (None, ["MPL-2.0"]), 2: (None, ["MPL-2.0"]), 3: (None, ["GPL-2.0"]), 4: (None, [])}


def test_license_query_equals_sql_on_planted_texts(spark, tmp_path):
    texts = [p.read_text("utf-8") for p in (licenses.Path(licenses.__file__).parent / "license_texts").glob("*.txt")]
    rows = [(i, wrapped(t, w)) for i, (t, w) in enumerate((t, w) for t in texts for w in (60, 100))] + [(99, None), (100, "Copyright (c) 2020 A\n" + licenses.MIT), (101, "x v2 licence\nv3 owner")]
    table(spark, rows).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    ours = {(r.doc_id, r.text_digest, r.license_id, tuple(r.notices)) for r in licenses.license_scan(table(spark, rows)).collect()}
    assert ours == {(i, d, k, tuple(n)) for i, d, k, n, _ in con.sql(licenses.oracle()).fetchall()}
