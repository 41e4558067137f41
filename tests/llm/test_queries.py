"""Registered corpus queries: SQL where there is some, contracts of names and rows, the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isallobar.llm import pii, quality, queries
from isallobar.llm.common import table
from tests.compare import connection, differences

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{k}" for k in range(1, 11)), "pipeline"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert differences(queries.queries()[name](spark, SF), connection(SF), queries.oracle_sql()[name]) == ""


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.persist()
        kept = stage(spark, before, SF)
        assert kept.schema.simpleString() == docs.schema.simpleString()
        assert kept.count() <= before.count()
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, table(spark, SF, "labels")).collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert ids <= {k for k, s in scores.items() if s >= quality.THRESHOLD}
    found = pii.find_personal_data(kept)
    assert found.where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


def test_pipeline_equals_plain_stages(spark, tmp_path):
    """Scores, groups, redaction and token ids of the whole pipeline, each by its plain version."""
    import random
    import zlib
    from collections import defaultdict

    import numpy as np
    from tokenizers import Tokenizer

    from tests.llm.fixtures import prose
    from tests.llm.test_neighbours import plain_scores
    from tests.llm.test_shingles import brute_groups

    rnd = random.Random(12)
    texts = []
    for k in range(160):
        text = " ".join(f"{w}{rnd.randrange(40)}" for w in prose(k, 60 + k % 50).split())
        texts.append(text if k % 3 else " ".join(w + rnd.choice(["", "##", "$$%"]) for w in text.split()))
    texts += [texts[1], texts[2] + " tail", texts[4] + " write to me@mail.example.org or 10.1.2.3", "", texts[5].replace("fox", "ox")]
    labels = [(k, int(k % 3 > 0)) for k in range(160) if k % 2 == 0]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("en")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, q, 0) for k, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    scores = plain_scores(texts, dict(labels), [k for k, _ in labels])
    good = [k for k, s in enumerate(scores) if s >= quality.THRESHOLD]
    assert 60 < len(good) < 150
    groups, _ = brute_groups([texts[k] for k in good])
    kept = sorted({good[first] for first in groups.values()})
    spans = {r.doc_id: r.spans for r in pii.find_personal_data(spark.createDataFrame([(k, texts[k]) for k in kept], "doc_id long, text string")).collect()}
    library = Tokenizer.from_file(queries.vocabulary_path())
    wanted = {}
    for k in kept:
        text, end, out = texts[k], 0, []
        for kind, a, b in sorted((s.split(":") for s in spans[k].split(",") if s), key=lambda s: (int(s[1]), int(s[2]))):
            if int(a) >= end:
                out += [text[end : int(a)], f"[{kind.upper()}]"]
            end = max(end, int(b))
        wanted[k] = np.array([*library.encode("".join(out) + text[end:], add_special_tokens=False).ids, 0], "<u4")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(kept) and sum(r.length for r in rows) == sum(map(len, wanted.values()))
    taken = defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(wanted[r.doc_id][r.start : r.start + r.length].tobytes())
        taken[r.sequence_id].append((r.offset, r.length))
    assert all(o == sum(n for _, n in sorted(p)[:j]) for p in taken.values() for j, (o, _) in enumerate(sorted(p)))
    assert max(sum(n for _, n in p) for p in taken.values()) <= 2048 and len(taken) == -(-sum(map(len, wanted.values())) // 2048)
