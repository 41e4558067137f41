"""SimHash, components, nearest neighbours, WARC, licences and quality against brute force."""

import base64
import hashlib
import random

import duckdb
import numpy as np
import pytest
import xxhash

from isallobar.llm import ann, graph, licences, quality, simhash, warc
from isallobar.llm.common import Scratch
from tests.llm.fixtures import TEXTS, documents, empty, prose


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_fingerprints(spark):
    for text in TEXTS[:-1] + ["one two three", "A B", "\x0ba\x0cb\rc d"]:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text or "")


@pytest.mark.parametrize("hot", [0, 2, 64])
def test_links_connect_as_all_pairs_do(spark, hot):
    rnd = random.Random(hot)
    values = {rnd.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for v in list(values)[:20]:
        for _ in range(6):
            x = v
            for _ in range(rnd.randint(1, 3)):
                x ^= 1 << rnd.randrange(64)
            values.add(x)
    nodes = sorted(values)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    wanted = plain_components([(a, b) for i, a in enumerate(nodes) for b in nodes[:i] if (a ^ b).bit_count() <= 2], nodes)
    edges = simhash.links(spark.createDataFrame([(signed(x),) for x in nodes], "fp long"), Scratch(), hot=hot)
    got_pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in got_pairs)
    assert plain_components(got_pairs, nodes) == wanted
    found = {r.node % (1 << 64): r.component for r in graph.components(edges).collect()}
    groups = {}
    for n in found:
        groups.setdefault(found[n], set()).add(n)
    linked = {}
    for n, c in wanted.items():
        linked.setdefault(c, set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in linked.values() if len(g) > 1)


def test_components_of_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 200), (200, 250), (1, 0)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == plain_components(pairs, {x for p in pairs for x in p if p[0] != p[1]})
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    texts = [*TEXTS, *(prose(k, 60) for k in range(20)), *(prose(k, 60) + " end" for k in range(20))]
    docs = documents(spark, texts)
    rows = docs.select("doc_id", "text").collect()
    fp = [plain_fingerprint(r.text or "") if len(r.text or "") < 50000 else simhash.fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 2]
    parts = plain_components(links, range(len(rows)))
    least = {}
    for i, c in parts.items():
        if rows[i].doc_id is not None:
            least[c] = min(least.get(c, rows[i].doc_id), rows[i].doc_id)
    wanted = sorted((str(rows[i].doc_id), fp[i], least.get(parts[i])) for i in range(len(rows)))
    got = simhash.near_duplicates(docs)
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got.collect()) == wanted
    kept = simhash.drop_near_duplicates(docs)
    first = {}
    for i, c in parts.items():
        first[c] = min(first.get(c, i), i, key=lambda j: (rows[j].doc_id is None, rows[j].doc_id, j))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(((rows[i].doc_id, rows[i].text) for i in first.values()), key=str)
    # Rows are chosen, not ids: a text of its own stays although its id repeats with a copy, and so does a lone null id.
    own, copy = prose(1, 80), " ".join(f"c{k}" for k in range(80))
    some = spark.createDataFrame([(5, copy, 1), (5, own, 2), (3, copy, 3), (None, "alone here", 4), (None, "alone here", 5)], "doc_id long, text string, node int")
    assert sorted(((r.doc_id, r.text) for r in simhash.drop_near_duplicates(some).collect()), key=str) == sorted([(3, copy), (5, own), (None, "alone here")], key=str)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def plain_nearest(rows, k=10):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = []
    for q, v in good:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in good if i != q and len(v) == len(w))[:k]
            out += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    return sorted(out)


def test_nearest_against_brute_force(spark):
    rnd = np.random.default_rng(5)
    for n, d in ((900, 16), (350, 5), (60, 64), (5, 3)):
        vectors = rnd.standard_normal((n, d)).astype(np.float32)
        vectors[n // 2 : n // 2 + n // 3] = vectors[1]  # one vector that a third of all rows share
        rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
        rows += [(n, None), (n + 1, [0.0] * d), (n + 2, [float("nan")] + [1.0] * (d - 1)), (n + 3, [None] + [1.0] * (d - 1)), (None, [1.0] * d), (n + 4, [float("inf")] * d), (n + 5, [1.0]), (100 * n, [1.0] * (d + 1)), (100 * n + 1, [2.0] * (d + 1))]
        got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
        found, wanted = sorted(tuple(r) for r in got.collect()), plain_nearest(rows)
        same = {(a[0], a[2]) for a in found} & {(b[0], b[2]) for b in wanted}
        assert len(found) == len(wanted) and len(same) >= 0.98 * len(wanted)
        assert np.allclose([x[3] for x in found], [x[3] for x in wanted], rtol=0.02)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(none).count() == 0


def test_codes_estimate_and_bound_distances():
    rnd = np.random.default_rng(1)
    vectors, query, centre = rnd.standard_normal((2000, 64)), rnd.standard_normal(64), rnd.standard_normal(64) * 0.1
    turn = ann.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    bits, length, agreement = ann.encode(vectors, centre, turn)
    assert bits.shape == (2000, 8)
    bound = ann.lower_bounds(bits, length, agreement, query, centre, turn)
    exact = ((vectors - query) ** 2).sum(axis=1)
    assert (bound <= exact).mean() > 0.999
    middle = ann.lower_bounds(bits, length, agreement, query, centre, turn, width=0.0)
    assert abs((middle - exact).mean()) < 1.0 and np.corrcoef(middle, exact)[0, 1] > 0.7


def plain_warc(rows):
    groups = {}
    for i, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        known = [i for i in ids if i is not None]
        kept, first = max(known, default=None), True
        for i in ids:
            if kept is None or (i == kept and first):
                first = first and i != kept
                out.append((i, len(payload), digest, "response", None))
            else:
                out.append((i, len(payload), digest, "revisit", kept))
    return sorted(out, key=str)


def test_archives_give_records_back(spark):
    rows = [(k, "u\r\nv" if k % 3 else None, html) for k, html in enumerate(["<p>é</p>", "", None, "x" * 700_000, "<p>é</p>", "a\r\n\r\nWARC/1.1\r\n", "\x00", *(f"<b>{k}</b>" for k in range(50)), *["same"] * 30])]
    rows += [(60, "u", "same"), (86, "u", "same"), (86, "w", "same"), (86, "w", "same"), (4, "z", "<p>é</p>"), (4, "y", "<p>é</p>"), (4, "q", "else"), (None, "u", "same"), (None, None, "lonely"), (None, None, "lonely")]
    pages = spark.createDataFrame([(a, b, c, "z") for a, b, c in rows], "page_id long, url string, html string, sha string").repartition(3)
    bundles = warc.write_bundles(pages)
    got = sorted((tuple(r) for r in warc.read_bundles(bundles).collect()), key=str)
    assert got == plain_warc([(a, c) for a, _, c in rows])
    links, ids, referred = [], [], set()
    for b in bundles.collect():
        data = bytes(b.data)
        assert len(warc.seek_table(data)) == max(e.frame for e in b["index"]) + 1
        for e in b["index"]:
            fields, body = warc.read_record(data, e.frame, e.offset)
            assert fields["WARC-Record-ID"] == e.record_id
            links.append((fields["WARC-Page-ID"], fields["WARC-Target-URI"]))
            ids.append(e.record_id)
            if fields["WARC-Type"] == "revisit":
                referred.add(fields["WARC-Refers-To"])
    assert len(ids) == len(set(ids)) and referred <= set(ids)
    assert sorted(links) == sorted(("" if a is None else str(a), (b or "").replace("\r", "%0D").replace("\n", "%0A")) for a, b, _ in rows)
    with pytest.raises(ValueError):
        warc.seek_table(b"nothing that ends in a table")
    assert warc.read_bundles(warc.write_bundles(pages.where("false"))).count() == 0
    assert {r.record_type for r in warc.read_bundles(warc.write_bundles(pages, least=10**9)).collect()} == {"response"}


def test_licences(spark):
    mit = licences.KNOWN["MIT"]
    texts = [mit, "Copyright (c) 2001 Someone\n\n" + mit.upper(), mit.replace("sublicense", "sublicence").replace("\n", "  "), mit + " more", None, "", "(c) 1999 X\n© Y\nAll rights reserved.\n" + licences.KNOWN["ISC"], "x“y”—z"]
    docs = documents(spark, texts)
    got = {(r.doc_id, r.license_id) for r in licences.scan_licences(docs).collect()}
    assert got == {(0, "MIT"), (1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (6, "ISC"), (7, None), (None, None)} | ({(5, None)})
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    assert sorted(map(str, con.execute(licences.oracle()).fetchall())) == sorted(str(tuple(r)) for r in licences.scan_licences(docs).collect())
    spelt = documents(spark, ["Licence licence LICENCE, sublicence", "Copyright The Foo Authors\n\n" + licences.KNOWN["MIT-0"], "Copyright [yyyy] [name]\n" + licences.KNOWN["BSL-1.0"], "copyright\nholders", *licences.KNOWN.values()])
    rows = {r.doc_id: r for r in licences.scan_licences(spelt).where("doc_id <> 5").collect()}
    assert rows[0].digest == hashlib.sha256(b"license license license sublicense").hexdigest()
    assert rows[1].license_id == "MIT-0" and rows[2].license_id == "BSL-1.0" and rows[3].n_canonical == len("copyright holders")
    assert [rows[k].license_id for k in sorted(rows) if 6 <= k < 4 + len(licences.KNOWN)] == list(licences.KNOWN)[2:]
    con.register("documents", spelt.select("doc_id", "text").toArrow())
    assert sorted(map(str, con.execute(licences.oracle()).fetchall())) == sorted(str(tuple(r)) for r in licences.scan_licences(spelt).collect())
    other = spark.createDataFrame([("own", " X \n y z"), ("zz", "x y z")], "license_id string, text string")
    assert {r.license_id for r in licences.scan_licences(docs, other).where("doc_id = 7").collect()} == {"own"}
    assert licences.scan_licences(empty(spark)).count() == 0


def test_quality_learns_and_calibrates(spark):
    rnd = random.Random(0)
    rows, marks = [], []
    for k in range(1200):
        good = rnd.random() < 0.7
        text = prose(k, 30 + k % 90)
        rows.append((k, text if good else " ".join(w + rnd.choice("#$%&*") * 3 for w in text.split()), "en"))
        if k % 2:
            marks.append((k, int(good), 0))
    docs = spark.createDataFrame([*rows, (None, None, "en"), (5000, "", "en"), (3, "z " * 9, "en")], "doc_id long, text string, stats string")
    labels = spark.createDataFrame([*marks, (1, 7, 0), (7, 0, 0), (7, 1, 0), (None, 1, 0), (9, None, 0), *marks[:5]], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    import zlib

    truth = {k: int("###" not in t and "$$$" not in t and "%%%" not in t and "&&&" not in t and "***" not in t) for k, t, _ in rows}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.score for r in got if r.doc_id != 3}
    assert {r.doc_id for r in kept.collect()} - {3} == {k for k, s in scores.items() if s >= 0.7}
    assert quality.quality_scores(docs, labels.where("false")).select("score").distinct().collect()[0].score == 0.5
    assert quality.quality_scores(docs.where("false"), labels).count() == 0


def plain_scores(texts, labels, marks):
    """Ridge by least squares on stacked rows, and the isotonic fit by its min-max formula."""
    import zlib

    stats = quality.statistics(texts)
    fold = [zlib.crc32(str(k).encode()) % 4 for k in range(len(texts))]
    teach = [k for k in marks if fold[k] in (0, 1)]
    check = [k for k in marks if fold[k] == 3]
    centre, scale = stats[teach].mean(axis=0), stats[teach].std(axis=0)
    draw = np.random.default_rng(quality.SEED)
    turn = draw.standard_normal((stats.shape[1], quality.COSINES)) / quality.KERNEL_WIDTH
    phase = draw.uniform(0, 2 * np.pi, quality.COSINES)

    def lifted(row):
        z = np.clip((row - centre) / np.maximum(scale, 1e-6), -quality.CLIP, quality.CLIP)
        size = np.expm1(row[0])
        z = z * size / (size + quality.SHORT_BYTES)
        return np.array([1.0, *(np.sqrt(2 / quality.COSINES) * np.cos(z @ turn[:, j] + phase[j]) for j in range(quality.COSINES))])

    rows = np.array([lifted(s) for s in stats])
    m = quality.COSINES + 1
    pull = np.sqrt(quality.RIDGE * len(teach) * np.array([0.0] + [1.0] * quality.COSINES) / m + 1e-9)
    weights = np.linalg.lstsq(np.vstack([rows[teach], np.diag(pull)]), np.concatenate([[labels[k] for k in teach], np.zeros(m)]), rcond=None)[0]
    raw = np.clip(rows @ weights, 0, 1) * (quality.GRID - 1)
    cell = np.rint(raw).astype(int)
    used = sorted({cell[k] for k in check})
    good = [sum(labels[k] for k in check if cell[k] == c) for c in used]
    total = [sum(cell[k] == c for k in check) for c in used]
    fitted, pools = [], []
    for k in range(len(used)):
        level = max(min(sum(good[i : j + 1]) / sum(total[i : j + 1]) for j in range(k, len(used))) for i in range(k + 1))
        pools.append(level)
    for k, level in enumerate(pools):
        same = [j for j, other in enumerate(pools) if abs(other - level) < 1e-12]
        fitted.append((sum(good[j] for j in same) + 0.05) / (sum(total[j] for j in same) + 0.1))
    grid = np.interp(np.arange(quality.GRID), used, np.maximum.accumulate(fitted))
    return np.clip(np.interp(raw, np.arange(quality.GRID), grid), 0, 1)


def test_scores_equal_a_single_machine_version(spark):
    rnd = random.Random(3)
    texts = [prose(k, 20 + 3 * (k % 80)) if k % 3 else " ".join(w + rnd.choice(["", "##", "$$"]) for w in prose(k, 20 + k % 60).split()) for k in range(400)]
    labels = {k: int(k % 3 > 0) if rnd.random() < 0.9 else rnd.randint(0, 1) for k in range(400)}
    marks = [k for k in range(400) if k % 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, spark.createDataFrame([(k, labels[k]) for k in marks], "doc_id long, quality int")).collect()}
    wanted = plain_scores(texts, labels, [k for k in marks])
    assert max(abs(got[k] - wanted[k]) for k in got) < 1e-5


def test_isotonic_is_monotone_and_keeps_means():
    good, total = np.array([0.0, 3, 1, 0, 8]), np.array([4.0, 4, 4, 0, 8])
    fitted = quality.isotonic(good, total)
    assert (np.diff(fitted) >= 0).all() and abs(fitted[1] - 0.5) < 0.02 and fitted[0] < 0.1 and fitted[4] > 0.9
