"""SimHash near-duplicates: pigeonhole blocks, verified by Hamming distance.

The 64 bits are cut into four blocks of 16.  Two fingerprints that differ in at
most two bits agree on at least two whole blocks, so each fingerprint is keyed by
its six pairs of blocks and pairs are sought among equal keys only.  Equal
fingerprints are folded first.

A key shared by more than ``HOT`` distinct fingerprints is split by the same rule: the
bits that it leaves free are cut into four smaller blocks, of which a close pair
shares two as well.  Three such steps fix 56 of 64 bits, so no key that is joined
with itself holds more than 256 fingerprints, and no link is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isallobar.llm.bpe import batch_texts
from isallobar.llm.common import Scratch, as_row, settle
from isallobar.llm.graph import components

SHINGLE, SEED, DISTANCE = 3, 42, 2
BLOCKS, LEVELS = 4, 3
#: Distinct fingerprints up to which the members of a key are paired without a further split.
HOT = 64


def shingle_hashes(text: str, words: int) -> list[int]:
    """Hash of every run of so many words, or of all words where there are fewer."""
    found = text.encode().lower().split()
    if len(found) < words:
        return [xxhash.xxh64_intdigest(b" ".join(found), SEED)] if found else []
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    return [hashed(join(x), SEED) for x in zip(*(found[k:] for k in range(words)), strict=False)]


def fingerprint_of(hashes: list[int]) -> int:
    """SimHash of shingle hashes: a bit is set if it is set in over half of them."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """SimHash of one whole text."""
    return fingerprint_of(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id`` and signed 64-bit ``fp`` of every whole text (null: empty)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batch_texts(batches):
            found = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array(found)], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, fp bigint")


def split_masks(fixed: int) -> list[int]:
    """Masks that fix two of four equal blocks of the bits that ``fixed`` leaves free, beside its own."""
    free = [b for b in range(64) if not fixed >> b & 1]
    width = len(free) // BLOCKS
    blocks = [sum(1 << b for b in free[k * width : (k + 1) * width]) for k in range(BLOCKS)]
    return [fixed | sum(chosen) for chosen in itertools.combinations(blocks, BLOCKS - DISTANCE)]


def _keyed(rows: DataFrame, masks: list[list[int]]) -> DataFrame:
    """Rows (``kid``, ``key``, ``fp``) of the masks that follow each row's own ``kid``."""
    signed = lambda m: F.lit(m - (1 << 64) if m >> 63 else m).cast("long")
    table = F.array(*(F.array(*map(signed, own)) for own in masks))
    each = rows.select("fp", "kid", F.posexplode(F.get(table, F.col("kid"))).alias("turn", "mask"))
    return each.select((F.col("kid") * len(masks[0]) + F.col("turn")).alias("kid"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def links(nodes: DataFrame, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """Edges (``a``, ``b``) for all pairs of the distinct fingerprints ``fp`` within two bits.

    A pair that shares several keys comes several times.  What is settled on the way is in ``scratch``.
    """
    found, rows, masks = None, nodes.select("fp", F.lit(0).alias("kid")), [0]
    for level in range(LEVELS):
        split = [split_masks(m) for m in masks]
        masks = [m for own in split for m in own]
        keyed = _keyed(rows, split)
        if level + 1 < LEVELS:
            crowded = keyed.groupBy("kid", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("kid", "key")
            rows = scratch.settle(keyed.join(crowded, ["kid", "key"], "left_semi").select("fp", "kid"), "crowded")
            keyed = keyed.join(crowded, ["kid", "key"], "left_anti")
        left, right = keyed.withColumnRenamed("fp", "a"), keyed.withColumnRenamed("fp", "b")
        close = left.join(right, ["kid", "key"]).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).select("a", "b")
        found = close if found is None else found.unionByName(close)
        if level + 1 < LEVELS and rows.isEmpty():
            break
    return found


def near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """Fingerprint and near-duplicate component of every document.

    Returns ``doc_id``, ``fp`` (signed) and ``component_id``, the smallest doc_id reachable over
    links, the document's own included.  Null and empty texts have fingerprint
    zero and are linked like any other.  Repeated rows each give a row; rows with a
    null doc_id get the component's smallest id, null if it has none.  Other
    columns are ignored, an empty table gives no rows.
    """
    marked = settle(fingerprints(docs, words), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    scratch = Scratch()
    classes = scratch.settle(components(links(nodes.select("fp"), scratch)), "classes")
    owned = nodes.join(classes.withColumnRenamed("node", "fp"), "fp")
    smallest = owned.groupBy("component").agg(F.min("least").alias("component_id"))
    grouped = settle(owned.select("fp", "component").join(smallest, "component").select("fp", "component_id"), "grouped")
    scratch.clear()
    single = nodes.join(grouped.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    named = grouped.unionByName(single)
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(rows: DataFrame) -> DataFrame:
    """One ``row`` of each ``component``; rows have doc_id and ``node`` (shared by equal texts) beside.

    It is a row with the smallest doc_id (null only if the component has no other) and, of
    those, the least ``node``.  Rows are told apart by doc_id and node together, so a
    doc_id that repeats with unrelated texts is kept once for each of their components.
    """
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first"))
    keep = settle(first.select("first.doc_id", "first.node").toDF("doc_id_", "node_"), "kept")
    same = (F.col("node") == F.col("node_")) & F.col("doc_id").eqNullSafe(F.col("doc_id_"))
    return rows.join(keep, same, "left_semi").dropDuplicates(["node"]).select("row.*")


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """Keep one row of each component of linked fingerprints, all columns unchanged (see :func:`keep_first`)."""
    node = F.xxhash64(F.coalesce("text", F.lit(""))).alias("node")
    found = near_duplicates(docs.select(node.alias("doc_id"), "text"), words)
    classes = settle(found.select(F.col("doc_id").alias("node"), F.col("component_id").alias("component")).distinct(), "nodes")
    return keep_first(docs.select("doc_id", node, as_row(docs)).join(classes, "node"))
