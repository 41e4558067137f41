"""The pipeline's near-duplicate stage against brute force over all pairs."""

import random

import corpus_pipeline
from isallobar.llm import shingles
from tests.llm.fixtures import TEXTS, WORDS, prose
from tests.llm.test_neighbours import plain_components


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def varied():
    """Texts at all distances from each other, with chains and a crowded group."""
    rnd, out = random.Random(3), [t for t in TEXTS if t != TEXTS[-1]]
    for _ in range(30):
        words = [rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(rnd.randint(30, 200))]
        out.append(" ".join(words))
        for _ in range(4):
            words = list(words)
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = f"new{rnd.random()}"
            out.append(" ".join(words))
    return [*out, *(prose(1, 200) + f" tail{k}" for k in range(100))]


def brute_groups(texts):
    sets = [plain_set(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    return plain_components(pairs, range(len(sets))), pairs


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "en") for k, t in rows], "doc_id long, text string, lang string")


def test_stage_keeps_the_least_of_every_group_of_brute_force(spark):
    texts = varied()
    groups, pairs = brute_groups(texts)
    assert sum((texts[a] or "") != (texts[b] or "") for a, b in pairs) > 200
    kept = corpus_pipeline.near_dedup(spark, frame(spark, enumerate(texts)), "")
    assert kept.columns == ["doc_id", "text", "lang"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(k, texts[k]) for k in sorted(set(groups.values()))]


def test_a_near_copy_that_simhash_misses_goes(spark):
    words = [f"w{k}" for k in range(300)]
    other = [*words[:150], "changed", *words[151:]]
    docs = frame(spark, enumerate([" ".join(words), " ".join(other), "some other text of its own"]))
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [0, 2]
    assert corpus_pipeline.near_dedup(spark, docs.where("false"), "").count() == 0


def test_rows_with_null_or_repeated_ids_keep_their_group(spark):
    unique, copied, null = prose(1, 80), " ".join(f"c{k}" for k in range(80)), " ".join(f"n{k}" for k in range(80))
    # doc_id 5 repeats: once as a copy of 3, once with a text of its own; two groups have only null ids or one beside a number.
    rows = [(3, copied), (5, copied + " end"), (5, unique), (None, null), (None, null + " end"), (None, unique + " end"), (None, "alone"), (8, "x"), (8, "y"), (8, "y")]
    kept = corpus_pipeline.near_dedup(spark, frame(spark, rows), "")
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    nulls = [t for k, t in got if k is None]
    assert sorted(x for x in got if x[0] is not None) == [(3, copied), (5, unique), (8, "x"), (8, "y")]
    assert len(nulls) == 2 and "alone" in nulls and (null in nulls or null + " end" in nulls)
