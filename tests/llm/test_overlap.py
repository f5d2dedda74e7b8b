"""Near copies of the pipeline's stage against brute force over exact 5-word shingle sets."""

import itertools
import random
import re

import corpus_pipeline
from assaymill.llm import overlap, simhash
from assaymill.llm.common import table


def brute_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(texts):
    """The smallest place of each text's group."""
    sets, parent = [brute_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a == b or (min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and len(a & b) * 5 >= len(a | b) * 4):
            low, high = sorted((find(i), find(j)))
            parent[high] = low
    return [find(i) for i in range(len(texts))]


def changed(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def kept_ids(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}


def test_stage_finds_near_copies(spark, sf_dir):
    """Pairs around 0.8, exact copies, and a large group whose members differ from each other."""
    rng = random.Random(13)
    fresh = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    texts = [r.text for r in table(spark, sf_dir, "documents").orderBy("doc_id").collect()]
    for _ in range(60):
        base = fresh(rng.randint(30, 300))
        texts += [" ".join(base), changed(rng, base, max(1, len(base) // rng.choice([30, 45, 60, 90])))]
    hot = fresh(200)
    texts += [changed(rng, hot, rng.randint(0, 5)) for _ in range(120)] + [" ".join(hot)] * 3
    texts += [None, "", " \n", "one", "One", "one two three"]
    groups = brute_groups(texts)
    assert kept_ids(spark, texts) == {i for i, g in enumerate(groups) if g == i}


def test_pairs_do_not_grow_with_the_square(spark):
    rng = random.Random(3)
    hot = [f"v{rng.randrange(3000)}" for _ in range(100)]
    texts = [changed(rng, hot, 1) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shared = overlap.shared_keys(overlap._signed(docs, "text").select("_class", "_size", "_keys").distinct())
    pairs = overlap.first_pairs(shared)
    assert pairs.count() < 600 * 20
    roots = simhash.components(overlap._similar(pairs, overlap._sets(overlap._signed(docs, "text"), "text").select("_class", "_set").dropDuplicates(["_class"])))
    assert overlap.left_pairs(shared, roots).count() < 600 * 20
