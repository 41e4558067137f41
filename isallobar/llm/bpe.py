"""Byte-pair encoding and decoding in batched numpy merge rounds.

Pre-tokenisation, word folding, merging and decoding all run over flat arrays:

* code points get a class (letter, number, white space, other) by table look-up
  and word boundaries follow from the class runs;
* equal words are folded, so each distinct word of a slice is merged once;
* the symbols of all distinct words lie in one flat array.  Each round takes,
  for every word, its lowest-rank pair, which is found by binary search over the
  sorted pair keys, and merges all its places, left to right.

Results equal those of the ``tokenizers`` library for byte-level vocabularies
without prefix space.  Code points that this Python's Unicode tables do not know
yet send their text through the library's own splitter.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from isallobar.llm.common import SLICE_CHARS, slices, texts_of

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)
NO_RANK = np.int32(2**31 - 1)
#: Words that a process keeps with their ids; beyond that it starts afresh.
WORDS_KEPT = 300_000

# The characters that the splitter counts as white space.
WHITE_SPACE = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# The endings that are split off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_classes: np.ndarray | None = None
_loaded: dict[str, "MergeTable"] = {}


def class_table() -> np.ndarray:
    """Class of every code point, made once in each process."""
    global _classes
    if _classes is None:
        first = {"L": LETTER, "N": NUMBER}
        names = [unicodedata.category(chr(c)) for c in range(0x110000)]
        found = np.array([first.get(x[0], UNKNOWN if x == "Cn" else OTHER) for x in names], np.uint8)
        found[list(WHITE_SPACE)] = SPACE
        _classes = found
    return _classes


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [chr(moved.get(b, b)) for b in range(256)]


def word_starts(points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Offsets at which words start, for code points of texts laid end to end.

    ``doc_starts`` are the offsets of the non-empty texts; every one starts a word.
    """
    n = len(points)
    kind = class_table()[points]
    opens = np.zeros(n + 1, bool)
    opens[doc_starts] = opens[n] = True
    run = np.ones(n, bool)
    run[1:] = (kind[1:] != kind[:-1]) | opens[1:n]
    white = kind == SPACE
    blank = points == 0x20
    first = opens[:n]
    starts = run.copy()
    # The last white space before a word: a blank joins the word, others stand alone.
    last = np.zeros(n, bool)
    last[:-1] = white[:-1] & ~white[1:] & ~opens[1:n]
    starts |= last
    joined = np.zeros(n, bool)
    joined[1:] = last[:-1] & blank[:-1]
    starts &= ~joined
    # Endings after an apostrophe that opens a run of one character.
    marks = np.flatnonzero((points == 0x27) & run & ~joined)
    marks = marks[marks + 1 < n]
    marks = marks[(kind[marks + 1] == LETTER) & ~first[marks + 1]]
    taken = np.zeros(len(marks), bool)
    for ending in ENDINGS:
        fits = ~taken & (marks + len(ending) < n)
        at = np.minimum(marks, n - 1 - len(ending))
        for k, letter in enumerate(ending, 1):
            fits &= (points[at + k] == ord(letter)) & ~first[at + k]
        hit = marks[fits]
        starts[hit + 1] = False
        after = hit + 1 + len(ending)
        starts[after[after < n]] = True
        taken |= fits
    return np.flatnonzero(starts)


def fold_words(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group equal byte words: a group number for each word, and a first word for each group."""
    place = np.arange(len(data), dtype=np.int64) - np.repeat(begin, size)
    mixing = np.random.default_rng(20).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
    weight = mixing[place & 63] * (2 * (place >> 6) + 1).astype(np.uint64)
    mixed = np.add.reduceat((data.astype(np.uint64) + np.uint64(7)) * weight, begin)
    mixed ^= mixed >> np.uint64(29)
    mixed += size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    group, distinct = pd.factorize(mixed)
    leader = np.empty(len(distinct), np.int64)
    leader[group[::-1]] = np.arange(len(group) - 1, -1, -1)
    lead = leader[group]
    same = bool((size == size[lead]).all())
    if same:
        same = bool((data == data[np.repeat(begin[lead], size) + place]).all())
    if not same:  # two words share a hash value: fold by their bytes
        raw = data.tobytes()
        seen: dict[bytes, int] = {}
        group = np.array([seen.setdefault(raw[b : b + s], len(seen)) for b, s in zip(begin.tolist(), size.tolist(), strict=True)])
        leader = np.empty(len(seen), np.int64)
        leader[group[::-1]] = np.arange(len(group) - 1, -1, -1)
    return group, leader


class MergeTable:
    """A byte-level vocabulary: pair keys in order, their ranks and results, token bytes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.path = path
        self.first = np.array([vocab[c] for c in symbols], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.result = np.array([vocab[a + b] for a, b in merges], np.int64)[order]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        back = {c: b for b, c in enumerate(symbols)}
        size = 1 + max([*vocab.values(), *self.special.values()])
        parts = [b""] * size
        for token, number in vocab.items():
            parts[number] = bytes(back[c] for c in token)
        for token, number in self.special.items():
            parts[number] = token.encode()
        self.token_size = np.array([len(p) for p in parts], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_size)])[:-1]
        self.token_bytes = np.frombuffer(b"".join(parts), np.uint8)
        self._library = None
        self._forget()

    def _forget(self) -> None:
        """Empty the store of words that came more than once in a slice."""
        self._known: dict[bytes, int] = {}
        self._kept_ids = np.empty(0, np.int64)
        self._kept_counts = np.empty(0, np.int64)

    @classmethod
    def load(cls, path: str) -> "MergeTable":
        """The table for ``path``, read once in each process."""
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and its place among the keys."""
        wanted = left << 32 | right
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.ranks[place], NO_RANK), place

    def merge_words(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words whose bytes lie end to end, and the number of ids of each."""
        ids, counts = np.empty(0, np.int64), np.zeros(len(size), np.int64)
        sym = self.first[data]
        word = np.repeat(np.arange(len(size)), size)
        rank = np.full(len(sym), NO_RANK)
        place = np.zeros(len(sym), np.int64)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], place[inner] = self._rank(sym[inner], sym[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, begin)
            length = np.diff(np.append(begin, len(sym)))
            stays = least != NO_RANK
            if not stays.all():
                keep = np.repeat(stays, length)
                done.append((word[~keep], sym[~keep]))
                sym, word, rank, place = sym[keep], word[keep], rank[keep], place[keep]
                least, length = least[stays], length[stays]
                if not len(sym):
                    break
            hit = rank == np.repeat(least, length)
            at = np.flatnonzero(hit)
            # Of places that follow one another directly, every second one is merged.
            fresh = np.concatenate([[True], np.diff(at) != 1])
            run_start = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
            at = at[(at - run_start) % 2 == 0]
            sym[at] = self.result[place[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            sym, word = sym[keep], word[keep]
            rank, place = rank[keep], place[keep]
            left = moved[at]
            rank[left] = NO_RANK
            near = np.zeros(len(sym), bool)
            near[left] = True
            near[left[left > 0] - 1] = True
            near[-1] = False
            changed = np.flatnonzero(near)
            joins = word[changed] == word[changed + 1]
            rank[changed[~joins]] = NO_RANK
            changed = changed[joins]
            rank[changed], place[changed] = self._rank(sym[changed], sym[changed + 1])
        if done:
            owner = np.concatenate([x[0] for x in done])
            order = np.argsort(owner, kind="stable")
            ids = np.concatenate([x[1] for x in done])[order]
            counts = np.bincount(owner, minlength=len(size))
        return ids, counts

    def _merge_distinct(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words; those kept from earlier slices are not merged again."""
        if len(self._known) > WORDS_KEPT:
            self._forget()
        raw = data.tobytes()
        words = [raw[b : b + s] for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
        old = len(self._kept_counts)
        found = np.array([self._known.get(w, -1) for w in words], np.int64)
        new = np.flatnonzero(found < 0)
        fresh = size[new]
        at = np.repeat(begin[new] - (np.cumsum(fresh) - fresh), fresh) + np.arange(fresh.sum())
        ids, counts = self.merge_words(data[at], fresh)
        found[new] = old + np.arange(len(new))
        all_ids = np.concatenate([self._kept_ids, ids])
        all_counts = np.concatenate([self._kept_counts, counts])
        starts = np.cumsum(all_counts) - all_counts
        take = all_counts[found]
        spread = np.repeat(starts[found] - (np.cumsum(take) - take), take) + np.arange(take.sum())
        keep = np.flatnonzero(often[new])
        for k, j in enumerate(keep.tolist()):
            self._known[words[new[j]]] = old + k
        self._kept_ids = np.concatenate([self._kept_ids, ids[np.repeat(often[new], counts)]])
        self._kept_counts = np.concatenate([self._kept_counts, counts[keep]])
        return all_ids[spread], take

    def _encode_slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens, and the number of ids of each."""
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = np.zeros(len(texts), np.int64)
        joined = "".join(texts)
        if not joined:
            return np.empty(0, np.uint32), counts
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(joined.encode("utf-8"), np.uint8)
        ends = np.cumsum(sizes)
        doc_starts = (ends - sizes)[sizes > 0]
        starts = word_starts(points, doc_starts)
        owner = np.flatnonzero(sizes > 0)[np.searchsorted(doc_starts, starts, "right") - 1]
        begin = starts
        if len(points) != len(data):
            width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            begin = (np.cumsum(width) - width)[starts]
        size = np.diff(np.append(begin, len(data)))
        group, leader = fold_words(data, begin, size)
        ids, pieces = self._merge_distinct(data, begin[leader], size[leader], np.bincount(group) > 1)
        offset = np.cumsum(pieces) - pieces
        take = pieces[group]
        total = int(take.sum())
        spread = np.repeat(offset[group] - (np.cumsum(take) - take), take) + np.arange(total)
        counts += np.bincount(owner, weights=take, minlength=len(texts)).astype(np.int64)
        return ids.astype(np.uint32)[spread], counts

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without special tokens."""
        known = class_table()
        out: list[np.ndarray] = []
        for start, end in slices([len(t) for t in texts]):
            part = texts[start:end]
            odd = [not t.isascii() and bool((known[np.frombuffer(t.encode("utf-32-le"), np.uint32)] == UNKNOWN).any()) for t in part]
            ids, counts = self._encode_slice(["" if o else t for t, o in zip(part, odd, strict=True)])
            found = np.split(ids, np.cumsum(counts)[:-1])
            out += [self._by_library(t) if o else f for t, o, f in zip(part, odd, found, strict=True)]
        return out

    def _by_library(self, text: str) -> np.ndarray:
        """Ids of a text with code points newer than this Python: split by the library, merged here."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        back = {c: b for b, c in enumerate(byte_symbols())}
        words = [bytes(back[c] for c in w) for w, _ in self._library.pre_tokenize_str(text)]
        return self.merge_words(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.int64))[0].astype(np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (unsigned 32 bits) of each text; special tokens in a text become their id."""
        if not any(s in t for t in texts for s in self.special):
            return self._plain(texts)
        parts: list[str] = []
        layout: list[list[int]] = []  # of each text: part numbers, or -1 - id
        for text in texts:
            row: list[int] = []
            rest = text
            while rest:
                found = min(((rest.find(s), -len(s), s) for s in self.special if s in rest), default=None)
                head = rest if found is None else rest[: found[0]]
                if head:
                    row.append(len(parts))
                    parts.append(head)
                if found is None:
                    break
                row.append(-1 - self.special[found[2]])
                rest = rest[found[0] + len(found[2]) :]
            layout.append(row)
        ids = self._plain(parts) if parts else []
        none = np.empty(0, np.uint32)
        return [np.concatenate([none, *(ids[k] if k >= 0 else np.array([-1 - k], np.uint32) for k in row)]) for row in layout]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a run of ids."""
        size = self.token_size[ids]
        total = int(size.sum())
        at = np.repeat(self.token_start[ids] - (np.cumsum(size) - size), size) + np.arange(total)
        return self.token_bytes[at].tobytes()


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode whole texts and decode them again.

    Returns ``key``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit, binary) and
    ``decoded`` (string; bytes that are not UTF-8 become U+FFFD, as in the library).

    Null and empty texts give no ids and an empty text.  Repeated rows each give
    a row, other columns are ignored, a null key stays null, an empty table gives
    no rows.  One map over the rows: no shuffle, memory bounded by a batch.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = MergeTable.load(vocabulary)
        for keys, texts in batch_texts(batches):
            ids = table.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    pa.array([table.decode(x).decode("utf-8", "replace") for x in ids], pa.string()),
                ],
                names=[key, "n_tokens", "ids", "decoded"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, n_tokens bigint, ids binary, decoded string")


def batch_texts(batches: Iterator[pa.RecordBatch], budget: int = 2 * SLICE_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts (null: empty) of the two columns of each batch, in bounded parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = texts_of(batch.column(1))
        for start, end in slices([len(t) for t in texts], budget):
            yield batch.column(0).slice(start, end - start), texts[start:end]


def encoding_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digest columns of :func:`encode_documents`, taken where the ids are made."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = MergeTable.load(vocabulary)
        for keys, texts in batch_texts(batches):
            ids = table.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(table.decode(x).decode("utf-8", "replace").encode()).hexdigest() for x in ids]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
