"""The order of shingles in the Jaccard join: what the prefixes hold, and how often a pair comes up."""

from __future__ import annotations

import numpy as np
import pytest

from candlelake.llm import ngram_join


def _phrases(docs: int, each: int) -> list[tuple[int, str]]:
    """Documents of 12 own sentences and 12 that ``each`` documents hold, five words in every one; 5,000 and 5,001 are a near pair."""
    out = []
    for i in range(docs):
        own = [" ".join(f"o{i}x{j}y{w}" for w in range(5)) for j in range(12)]
        shared = [" ".join(f"s{j}x{i // each}y{w}" for w in range(5)) for j in range(12)]
        out.append((i, " ".join(x for pair in zip(own, shared) for x in pair)))
    near = " ".join(f"n{w}" for w in range(100))
    return [*out, (5000, near), (5001, near + " more")]


def test_shingles_of_a_few_documents_stay_out_of_prefixes(spark, monkeypatch):
    seen = []
    plausible = ngram_join._plausible
    monkeypatch.setattr(ngram_join, "_plausible", lambda pairs, *rest: seen.extend((r.a, r.b) for r in pairs.select("a", "b").collect()) or plausible(pairs, *rest))
    docs = spark.createDataFrame(_phrases(24, 6), "doc_id long, text string").coalesce(1)
    out = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert out == {i: i for i in range(24)} | {5000: 5000, 5001: 5000}
    # Each document has enough shingles of its own for its prefix, so only the near pair comes up.
    assert set(seen) == {(5000, 5001)}


def test_more_common_shingles_come_later():
    hashes = np.array([5 << 40, 9 << 40, 1 << 63, 2**64 - 1], np.uint64)
    last, counts = hashes[[0, 2]], np.array([40_000, 3])
    tokens = ngram_join._tokens(hashes, last, ngram_join._levels(counts))
    assert [hashes[i] for i in np.argsort(tokens)] == [hashes[1], hashes[3], hashes[2], hashes[0]]
    assert (ngram_join._tokens(hashes, last[:0], ngram_join._levels(counts[:0])) >> np.uint64(60) == 0).all()
    assert ngram_join._levels(np.array([1, 3, 4, 1023, 1024, 2**40])).tolist() == [1, 1, 2, 9, 10, 15]


def _family(members: int, twice: bool) -> list[tuple[int, str]]:
    """Documents of 200 words, each with 4 of its own put over those of one text: of most pairs, less than 0.75 of the shingles are
    common. The last three have 2 own words and the same text beyond, so they link. One doc_id may have two texts."""
    words, random = [f"w{i}" for i in range(200)], np.random.default_rng(5)
    out = []
    for i in range(members):
        text, own = list(words), 4 if i < members - 3 else 2
        for j in random.choice(40, own, replace=False):
            text[5 * j] = f"m{i}x{j}"
        out.append((i, " ".join(text)))
    return [*out, (0, out[-1][1] + " and more"), (1, "another text")] if twice else out


def _links(docs: list[tuple[int, str]]) -> dict[int, int]:
    sets = [(i, {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}) for i, w in ((i, t.split()) for i, t in docs)]
    root = {i: i for i, _ in docs}
    for _ in sets:
        for a, x in sets:
            for b, y in sets:
                if 100 * len(x & y) >= 75 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("twice", [False, True])
def test_pairs_of_a_family_come_up_for_one_shared_shingle(spark, monkeypatch, twice):
    docs = _family(24, twice)
    lists, made = [], []
    remaining = ngram_join._remaining

    def watched(split, sets, percent):
        out = remaining(split, sets, percent)
        lists.extend(split.collect())
        made.extend(tuple(sorted(r)) for r in out.collect() if r.a != r.b)
        return out

    monkeypatch.setattr(ngram_join, "_remaining", watched)
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "_alike", lambda percent: ngram_join.F.lit(True))
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    out = {(r.doc_id, r.component_id) for r in ngram_join.jaccard_components(df).collect()}
    assert out == set(_links(docs).items())
    # What a join of the lists with themselves makes: a row for each shingle that a pair shares.
    every = [(x.doc_id, y.doc_id) for x in lists for y in lists if x.token == y.token and x.doc_id < y.doc_id and x.component != y.component
             and 100 * min(x.n, y.n) >= 75 * max(x.n, y.n) and min(x.n - x.pos, y.n - y.pos) >= -(-75 * (x.n + y.n) // 175)]
    assert set(made) == set(every) and len(every) > 3 * len(set(every))
    if not twice:
        # Sets of equal size come up on either side.
        assert len(made) <= 2.5 * len(set(made))
