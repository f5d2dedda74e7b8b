"""Runs of repeated words against a direct search, and the grammar's extensions against a scan."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from assaymill.llm import periodic, queries


def brute_runs(words):
    """Every maximal stretch of each period, by scanning; the smallest period of a stretch stays."""
    n, found = len(words), {}
    for p in range(1, n):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((s, length, p) for (s, length), p in found.items())


def brute_collapsed(words, runs):
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def random_words(rng, n, alphabet, repeats):
    words = [str(rng.randrange(alphabet)) for _ in range(n)]
    for _ in range(repeats):
        p, k = rng.randrange(1, 9), rng.randrange(2, 8)
        unit = [str(rng.randrange(alphabet)) for _ in range(p)]
        at = rng.randrange(len(words) + 1)
        words[at:at] = unit * k + unit[: rng.randrange(p)]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_extensions_match_a_scan(seed):
    rng = random.Random(seed)
    words = random_words(rng, rng.choice([1, 2, 40, 300]), rng.choice([1, 2, 3, 40]), rng.randrange(9))
    w = np.array([int(x) for x in words] + [1000])
    levels = periodic.grammar(w)
    assert all(len(b.symbols) <= len(a.symbols) for a, b in zip(levels, levels[1:]))
    mirror = [level.mirrored() for level in levels]
    n = len(w)
    pairs = [(i, j) for i in range(n + 1) for j in range(i + 1, n + 1)]
    pairs = rng.sample(pairs, min(len(pairs), 3000))
    a, b = (np.array(c) for c in zip(*pairs))

    def scan(text, i, j):
        k = 0
        while j + k < n and text[i + k] == text[j + k]:
            k += 1
        return k

    assert periodic.extensions(levels, a, b).tolist() == [scan(w, i, j) for i, j in pairs]
    turned = w[::-1]
    assert periodic.extensions(mirror, a, b).tolist() == [scan(turned, i, j) for i, j in pairs]
    assert periodic.extensions(levels, b, a).tolist() == [scan(w, i, j) for i, j in pairs]


def test_grammar_is_flat():
    words = np.random.default_rng(5).integers(0, 3, 20_000)
    assert len(periodic.grammar(words)) < 60
    assert len(periodic.grammar(np.zeros(20_000, dtype=int))) == 2


def test_runs_match_a_direct_search(spark):
    rng = random.Random(7)
    texts = [random_words(rng, rng.randrange(60), rng.choice([1, 2, 3, 50]), rng.randrange(5)) for _ in range(150)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    found = periodic.find_runs(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    for r in found:
        words = texts[r.doc_id]
        runs = brute_runs(words)
        assert [tuple(x) for x in r.runs] == runs
        assert (r.n_words, r.collapsed) == (len(words), brute_collapsed(words, runs))


def test_batches_and_blocks_of_candidates(spark, monkeypatch):
    rng = random.Random(9)
    import pyarrow as pa

    monkeypatch.setattr(periodic, "CANDIDATES", 5)
    texts = [" ".join(random_words(rng, 30, 2, 2)) for _ in range(20)]
    whole = [c.to_pylist() for c in periodic._runs_of(pa.array(texts))]
    apart = [periodic._runs_of(pa.array([t])) for t in texts]
    for column, parts in zip(whole, zip(*apart)):
        assert column == [p.to_pylist()[0] for p in parts]
    monkeypatch.setattr(periodic, "BATCH_BYTES", 100)
    parts = list(periodic._batches(pa.array([*texts, None, "", "x"])))
    assert len(parts) > 5 and sum(map(len, parts)) == 23


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "a a a a a a"), (5, "a a a a a"), (6, "           "), (6, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS runs", "2 AS _row", "3 AS n_words")
    found = {(r.doc_id, r.text): r for r in periodic.find_runs(df).collect()}
    assert len(found) == 7 and found[5, "a a a a a"].runs == []
    assert [tuple(r) for r in found[None, "a a a a a a"].runs] == [(0, 6, 1)]
    assert found[6, rows[5][1]].collapsed == " " and found[1, None].collapsed == ""
    assert found[2, ""].n_words == found[3, rows[2][1]].n_words == 0
    assert found[6, "x"]._row == 2
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert periodic.report(empty).collect() == []
    assert len(periodic.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()) == 7


def test_one_very_long_text(spark):
    words = ["a", "b"] * 60_000 + [str(i) for i in range(50_000)] + ["c"] * 100_000
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id int, text string")
    (found,) = periodic.find_runs(df).collect()
    assert [tuple(r) for r in found.runs] == [(0, 120_000, 2), (170_000, 100_000, 1)]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query(spark, sf_dir):
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op13_runs(spark, sf_dir).collect()
    assert len(found) == len(source)
    some = 0
    for r in found:
        words = planted(r.doc_id, source[r.doc_id])
        if len(words) > 3000:
            continue
        runs = brute_runs(words)
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        wanted = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == wanted
        assert (r.n_runs, r.runs_sha256) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
        some += bool(runs)
    assert some > 5
