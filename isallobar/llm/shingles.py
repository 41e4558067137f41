"""Near-duplicates by word shingles: SimHash blocks and MinHash bands propose pairs, the sets decide.

Two texts are linked if the sets of their five-word shingles have a Jaccard
similarity of at least 0.8.  Close copies are proposed by the pigeonhole blocks of
their SimHash fingerprints.  At 0.8 about ten of 64 bits differ, and blocks that bear
so many are a few bits wide, so the other pairs come from equal bands of MinHash values
(a pair at 0.8 is missed once in 20,000).  All are verified on the whole sets, so no
link is wrong.

Of the texts that share a band, each is compared with a few others first.  Those of a
band that still lie in different components are dealt to cells of bounded size, and the
members of a cell are compared in the task that holds it, which returns only links that
join two components.  So a large group of near copies makes few rows and no proposed
link is lost.  The lowest bits of the MinHash values ride along; pairs that differ in
more of them than one at 0.8 does (but for one in a million) are not proposed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isallobar.llm import simhash
from isallobar.llm.bpe import batch_texts
from isallobar.llm.common import Scratch, as_row, settle
from isallobar.llm.graph import components
from isallobar.llm.simhash import fingerprint_of, shingle_hashes

SHINGLE, BANDS, ROWS, SEED = 5, 25, 5, 42
#: The least similarity of a link, as a fraction of whole numbers.
SIMILAR = (4, 5)
#: Differing lowest bits of the MinHash values at which a pair is still proposed; 12.5 of 125 are expected at 0.8.
APART = 31
#: Members of a band, in random order, that each is compared with before all others.
NEXT = 4
#: Members of a band that one task puts in order.
RUN = 4096
#: Shingles, and as many more for each member, in one side of a cell.
CELL, MEMBER = 250_000, 50
#: Shingles hashed at once.
PART = 4096

_draw = np.random.default_rng(SEED)
_MASKS, _FACTORS = (_draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(low) for low in (0, 1))


def set_of(hashes: list[int]) -> np.ndarray:
    """Sorted distinct shingle hashes; texts without words share one."""
    return np.unique(np.array(hashes or [xxhash.xxh64_intdigest(b"", SEED)], np.uint64))


def shingle_set(text: str, words: int = SHINGLE) -> np.ndarray:
    """The set of a whole text."""
    return set_of(shingle_hashes(text, words))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of the MinHash values of a set, then their lowest bits in two numbers."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(hashes), PART):
        mixed = (hashes[at : at + PART, None] ^ _MASKS) * _FACTORS
        np.minimum(least, mixed.min(axis=0), out=least)
    keys = np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(least.reshape(BANDS, ROWS))], np.uint64)
    # The products' low bits are those of the hashes alone, so the values are mixed once more.
    bits = np.zeros(128, np.uint8)
    bits[: BANDS * ROWS] = ((least ^ least >> np.uint64(31)) * _FACTORS) >> np.uint64(63)
    return np.concatenate([keys, np.packbits(bits).view("<u8")])


def node_of(text: str = "text") -> Column:
    """A number that equal texts share (null is empty)."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("node")


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) for x in found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found).view(np.int64)))


def _signatures(nodes: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batch_texts(batches):
            hashes = [shingle_hashes(t, SHINGLE) for t in texts]
            sets = [set_of(h) for h in hashes]
            marks = np.array([fingerprint_of(h) for h in hashes], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array([len(s) for s in sets], pa.int64()), pa.array(marks), _lists([band_keys(s) for s in sets])], names=["node", "n", "fp", "keys"])

    return nodes.mapInArrow(work, "node bigint, n bigint, fp bigint, keys array<bigint>")


def _sets(nodes: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batch_texts(batches):
            yield pa.RecordBatch.from_arrays([keys, _lists([shingle_set(t) for t in texts])], names=["node", "hashes"])

    return nodes.mapInArrow(work, "node bigint, hashes array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are similar enough."""
    part, whole = SIMILAR
    x, y = sets.toDF("a", "x"), sets.toDF("b", "y")
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(x, "a").join(y, "b").where(both * (whole + part) >= (F.size("x") + F.size("y")) * part).select("a", "b")


def _alike(s: Column, t: Column) -> Column:
    """Whether sizes and lowest bits let two sets be similar enough."""
    part, whole = SIMILAR
    bits = F.bit_count(s["low"].bitwiseXOR(t["low"])) + F.bit_count(s["high"].bitwiseXOR(t["high"]))
    return (F.least(s["n"], t["n"]) * whole >= F.greatest(s["n"], t["n"]) * part) & (bits <= APART)


def _close_pairs(marked: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (``a``, ``b``) that connect the nodes of linked fingerprints."""
    least = scratch.settle(marked.groupBy("fp").agg(F.min("node").alias("a")), "least")
    same = marked.join(least, "fp").where("node <> a").select("a", F.col("node").alias("b"))
    found = simhash.links(least.select("fp"), scratch).distinct()
    one, two = least.toDF("f", "x"), least.toDF("g", "y")
    across = found.join(one, F.col("a") == F.col("f")).join(two, F.col("b") == F.col("g")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return same.unionByName(across)


def compared(key: int, lo: int, hi: int, rows: pa.Table) -> list[tuple[int, int]]:
    """Links between the members of a cell that join their components.

    A pair whose sets share a band before this one is left to that band's cells.
    """
    part, whole = SIMILAR
    size = rows.num_rows
    node, side = (rows[c].to_numpy() for c in ("node", "side"))
    _, root = np.unique(rows["class"].to_numpy(), return_inverse=True)
    keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(size, -1)
    sets = [x.values.to_numpy() for x in rows["hashes"].combine_chunks()]
    n = np.array([len(x) for x in sets])
    band = int(np.flatnonzero((keys[:, :BANDS] == key).all(axis=0))[0])
    sketch = keys[:, BANDS:].astype(np.uint64)
    other = np.flatnonzero(side == hi)
    out = []
    for i in np.flatnonzero(side == lo).tolist():
        late = other[other > i] if lo == hi else other
        late = late[root[late] != root[i]]
        late = late[(np.minimum(n[late], n[i]) * whole >= np.maximum(n[late], n[i]) * part)]
        late = late[np.bitwise_count(sketch[late] ^ sketch[i]).sum(axis=1) <= APART]
        late = late[~(keys[late, :band] == keys[i, :band]).any(axis=1)]
        for j in late.tolist():
            if root[j] == root[i]:
                continue
            place = np.minimum(sets[i].searchsorted(sets[j]), n[i] - 1)
            both = int((sets[i][place] == sets[j]).sum())
            if both * (whole + part) >= (n[i] + n[j]) * part:
                root[root == root[j]] = root[i]
                out.append((int(min(node[i], node[j])), int(max(node[i], node[j]))))
    return out


def _cell_links(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within bands between nodes of different components, by comparing all of them.

    ``placed`` has key, node, s and class.  The members of a band's heaviest component and
    the others are dealt to parts of bounded weight; a cell holds two parts, but never two
    of that one component.
    """
    weight = F.col("s.n") + MEMBER
    own = placed.groupBy("key", "class").agg(F.count("*").alias("m"), F.sum(weight).alias("w"))
    mixed = own.groupBy("key").agg(F.count("*").alias("classes"), F.sum("m").alias("m"), F.max_by("class", F.struct("w", "class")).alias("main"), F.max("w").alias("main_w"), F.sum("w").alias("w"))
    mixed = mixed.where(F.col("classes") > 1).where(F.col("m") > NEXT + 1)
    parts = mixed.select("key", "main", F.ceil(F.col("main_w") / CELL).cast("int").alias("big"), F.ceil((F.col("w") - F.col("main_w")) / CELL).cast("int").alias("small"))
    apart = placed.join(parts, "key")
    inside = F.col("class") == F.col("main")
    at = F.when(inside, F.col("small") + F.pmod(F.xxhash64("node"), "big")).otherwise(F.pmod(F.xxhash64("node"), "small")).cast("int")
    others = F.when(inside, F.sequence(F.lit(0), F.col("small") - 1)).otherwise(F.sequence(F.lit(0), F.col("small") + F.col("big") - 1))
    dealt = apart.select("key", "node", "class", at.alias("side"), F.explode(others).alias("with"))
    cells = dealt.select("key", F.least("side", "with").alias("lo"), F.greatest("side", "with").alias("hi"), "side", "node", "class").join(sets, "node")

    def work(group: tuple, rows: pa.Table) -> pa.Table:
        found = compared(*(x.as_py() for x in group), rows)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return cells.groupBy("key", "lo", "hi").applyInArrow(work, "a bigint, b bigint")


def links(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (``a``, ``b``) between the nodes of rows (``node``, ``text``) that connect what proposed links connect."""
    marked = scratch.settle(_signatures(texts).dropDuplicates(["node"]), "signatures")
    sketch = F.struct("n", F.get("keys", F.lit(BANDS)).alias("low"), F.get("keys", F.lit(BANDS + 1)).alias("high")).alias("s")
    rows = marked.select("node", sketch, F.explode(F.slice("keys", 1, BANDS)).alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    met = scratch.settle(rows.join(shared, "key"), "bands")
    # Every member with the next ones of its band, in an order of the band's own, and with close fingerprints.
    run = F.pmod(F.xxhash64("key", "node"), F.ceil(F.col("m") / RUN))
    order = Window.partitionBy("key", run).orderBy(F.xxhash64("node", "key"), "node")
    after = F.array(*(F.lead(F.struct("node", "s"), k).over(order) for k in range(1, NEXT + 1)))
    some = met.select("node", "s", after.alias("after")).select("node", "s", F.explode(F.array_compact("after")).alias("other"))
    some = some.where(_alike(F.col("s"), F.col("other.s"))).select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b"))
    some = scratch.settle(some.unionByName(_close_pairs(marked, scratch)).distinct(), "proposed")
    wanted = met.select("node").union(some.select("a")).union(some.select("b")).distinct()
    sets = scratch.settle(_sets(texts.join(wanted, "node", "left_semi").dropDuplicates(["node"])).join(marked.select("node", "keys"), "node"), "sets")
    near = scratch.settle(_verified(some, sets.select("node", "hashes")), "near")
    # All members that are still apart.
    placed = scratch.settle(met.join(components(near), "node", "left").select("key", "node", "s", F.coalesce("component", "node").alias("class")), "placed")
    return near.unionByName(scratch.settle(_cell_links(placed, sets), "near"))


def near_groups(texts: DataFrame) -> DataFrame:
    """``node`` and ``component`` of every distinct text of rows (``node``, ``text``), settled."""
    scratch = Scratch()
    nodes = texts.select("node").distinct()
    found = nodes.join(components(links(texts, scratch)), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    found = settle(found, "groups")
    scratch.clear()
    return found


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Keep one row of each group of near-duplicates, all columns unchanged (see :func:`simhash.keep_first`)."""
    groups = near_groups(docs.select(node_of(), "text"))
    return simhash.keep_first(docs.select("doc_id", node_of(), as_row(docs)).join(groups, "node"))
