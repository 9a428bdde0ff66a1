"""Substring dedup by recompression.

Rounds of recompression rename a document's words: runs of one symbol and pairs
of a left and a right symbol (a keyed coin decides the side) become symbols of
the next level. Names are keyed fingerprints of what they replace, so they are
global: equal substrings get equal interior symbols in every document, on every
executor. Each symbol carries the stretch of words that its naming looked at.

1. Documents become packs (one row: ids, dictionary, word codes), a table.
2. The high-level symbols of each pack go to the bucket of their name; buckets
   answer which names occur twice or more anywhere.
3. A window that contains the whole stretch of an unshared symbol is unique. All
   other windows are verified: their 128-bit fingerprints meet in buckets, and
   each occurrence but the earliest (document id, then start) is a repeat.
4. Each pack removes the words under repeated windows.

A pack sends each name, and the earliest of each window, once, so a passage in
very many documents costs one entry for each pack.

Defined results: null and empty texts have no words; texts below the window have
no window and stay whole; rows that share a doc_id compare by start only, so
equal rows keep each other's words; a null doc_id comes first; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm.shared import materialize, text_bytes

WINDOW = 20
ROUNDS = 7
#: Rounds that also name runs; every run round widens the stretch a name looks at.
RUN_ROUNDS = (0, 4)
#: A pair of symbols becomes evidence when it first reaches one of these lengths.
TILE_WORDS = (3, 6)
PACK_WORDS = 500_000
BUCKET_WORDS = 1_000_000

_OUTSIDE = 1 << 40
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
PACK = "pack long, ids array<long>, counts array<long>, words binary, codes binary, n_words long"
REQUEST = "bucket long, pack long, body binary, local binary"
ANSWER = "pack long, bucket long, body binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


# --- recompression -----------------------------------------------------------

class Symbols:
    """The symbols of one level: name, words [start, end), stretch [low, high)."""

    def __init__(self, names: np.ndarray, docs: np.ndarray):
        at = np.arange(len(names), dtype=np.int64)
        self.names, self.docs = names, docs
        self.start, self.end, self.low, self.high = at, at + 1, at.copy(), at + 1

    def next_is_same_doc(self) -> np.ndarray:
        return np.append(self.docs[:-1] == self.docs[1:], False) if len(self.docs) else np.zeros(0, bool)

    def _take(self, keep: np.ndarray, names: np.ndarray, ends: np.ndarray) -> None:
        self.names, self.end = names[keep], ends[keep]
        self.docs, self.start = self.docs[keep], self.start[keep]
        self.low, self.high = self.low[keep], self.high[keep]

    def runs(self, salt: int) -> np.ndarray:
        """Name maximal runs of one symbol; returns which symbols are new.

        Whether a run (or a lone symbol) ends here depends on both neighbours."""
        same_doc = self.next_is_same_doc()
        same = same_doc.copy()
        same[:-1] &= self.names[:-1] == self.names[1:]
        first = np.append(True, ~same[:-1])
        heads = np.flatnonzero(first)
        tails = np.append(heads[1:], len(first)) - 1
        length = tails - heads + 1
        before, after = np.maximum(heads - 1, 0), np.minimum(tails + 1, len(first) - 1)
        starts_doc = ~same_doc[before] | (heads == 0)
        low = np.where(starts_doc, -_OUTSIDE, np.minimum(self.low[heads], self.low[before]))
        high = np.where(same_doc[tails], np.maximum(self.high[tails], self.high[after]), _OUTSIDE)
        run = _mix(_mix(self.names[heads] + np.uint64(salt)) + length.astype(np.uint64))
        names = np.where(length > 1, run, self.names[heads])
        self.names, self.docs, self.start, self.end = names, self.docs[heads], self.start[heads], self.end[tails]
        self.low, self.high = low, high
        return length > 1

    def pairs(self, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """Name pairs of a left and a right symbol; returns which symbols are new and
        the length of their longer half.

        A left symbol looks at its right neighbour only, a right one at its left."""
        n = len(self.names)
        right = (_mix(self.names + np.uint64(salt)) >> np.uint64(63)).astype(bool)
        after, before = np.minimum(np.arange(1, n + 1), n - 1), np.maximum(np.arange(-1, n - 1), 0)
        has_after = self.next_is_same_doc()
        has_before = np.append(False, has_after[:-1])
        other = np.where(right, before, after)
        alone = np.where(right, ~has_before, ~has_after)
        low = np.where(alone & right, -_OUTSIDE, np.minimum(self.low, self.low[other]))
        high = np.where(alone & ~right, _OUTSIDE, np.maximum(self.high, self.high[other]))
        low, high = np.where(alone & ~right, self.low, low), np.where(alone & right, self.high, high)
        paired = ~right & has_after & right[after]
        keep = np.append(True, ~paired[:-1])
        name = _mix(_mix(self.names + np.uint64(salt + 1)) * _MULT[0] + self.names[after])
        size = self.end - self.start
        longer = np.maximum(size, size[after])[keep]
        ends = np.where(paired, self.end[after], self.end)
        self.low, self.high = low, high
        self._take(keep, np.where(paired, name, self.names), ends)
        return paired[keep], longer


def evidence(names: np.ndarray, docs: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, low, high) of the symbols that reach a tile length within one window."""
    found = []
    level = Symbols(names, docs)

    def collect(new: np.ndarray, longer: np.ndarray | None) -> None:
        size = level.end - level.start
        reached = np.zeros(len(size), bool)
        for words in TILE_WORDS:
            reached |= (size >= words) if longer is None else (size >= words) & (longer < words)
        keep = new & reached & (level.high - level.low <= window)
        found.append((level.names[keep], level.low[keep], level.high[keep]))

    for r in range(ROUNDS if len(names) else 0):
        if r in RUN_ROUNDS:
            collect(level.runs(1000 + r), None)
        collect(*level.pairs(2 * r))
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, (np.uint64, np.int64, np.int64)[i])
                 for i in range(3))


# --- packs -------------------------------------------------------------------

def packs(docs: DataFrame, text_col: str, id_col: str, pack_words: int) -> DataFrame:
    """Documents as packs of about ``pack_words`` words: ids, word counts, the
    distinct words and a code for each word."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        ids, counts, codes, known, total = [], [], [], _numbering(), 0
        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), text_bytes(batch.column("text")), strict=True):
                words = text.split() if text else []
                ids.append(doc)
                counts.append(len(words))
                codes.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
                total += len(words)
                if total >= pack_words or len(ids) >= pack_words:
                    yield _pack_row((task << 32) + k, ids, counts, codes, known)
                    ids, counts, codes, known, total, k = [], [], [], _numbering(), 0, k + 1
        if ids:
            yield _pack_row((task << 32) + k, ids, counts, codes, known)
    return rows.mapInArrow(run, PACK)


def _numbering() -> defaultdict:
    known: defaultdict = defaultdict()
    known.default_factory = known.__len__
    return known


def _pack_row(pack: int, ids: list, counts: list, codes: list, known: dict) -> pa.RecordBatch:
    words = zstandard.ZstdCompressor(level=1).compress(b" ".join(known))
    return pa.RecordBatch.from_arrays(
        [pa.array([pack]), pa.array([ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
         pa.array([words]), pa.array([_pack(np.concatenate(codes))]), pa.array([sum(counts)])],
        names=["pack", "ids", "counts", "words", "codes", "n_words"])


class Pack:
    """One pack in memory."""

    def __init__(self, row: dict):
        self.pack, self.ids = row["pack"], row["ids"]
        self.counts = np.array(row["counts"], np.int64)
        self.words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b" ")
        self.codes = _unpack(row["codes"], np.uint32)
        self.docs = np.repeat(np.arange(len(self.counts)), self.counts)
        self.first = np.cumsum(self.counts) - self.counts

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit fingerprints of each word."""
        both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.words)), np.uint64).reshape(-1, 2)
        return both[:, 0][self.codes], both[:, 1][self.codes]


def _window_prints(values: np.ndarray, window: int, mult: np.uint64) -> np.ndarray:
    from fairstream.llm.decontam import window_hashes
    return _mix(window_hashes(_mix(values * mult), window))


# --- requests and answers ----------------------------------------------------

def _bucket_slices(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The positions of each bucket's keys, in order."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cut) if len(order) else []:
        yield int(bucket[part[0]]), part


def _request(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("bucket", pa.int64()), ("pack", pa.int64()), ("body", pa.binary()), ("local", pa.binary())])
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.types[i]) for i in range(4)],
                                      schema=schema)


def _answers(pack: list, bucket: list, body: list) -> pa.Table:
    return pa.table({"pack": pa.array(pack, pa.int64()), "bucket": pa.array(bucket, pa.int64()),
                     "body": pa.array(body, pa.binary())})


def name_requests(pack: Pack, buckets: int) -> list[tuple]:
    """Each distinct name once, with a flag if it stands twice in this pack."""
    keys, n = np.unique(evidence(pack.names()[0], pack.docs)[0], return_counts=True)
    return [(b, pack.pack, keys[at].tobytes(), np.packbits(n[at] > 1).tobytes())
            for b, at in _bucket_slices(keys, buckets)]


def answer_names(table: pa.Table) -> pa.Table:
    """For each pack: which of its names occur twice or more anywhere."""
    parts = [np.frombuffer(x, np.uint64) for x in table.column("body").to_pylist()]
    flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)).astype(bool)
             for x, p in zip(table.column("local").to_pylist(), parts, strict=True)]
    _, which, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = n > 1
    shared[which[np.concatenate(flags)]] = True
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return _answers(table.column("pack").to_pylist(), table.column("bucket").to_pylist(),
                    [np.packbits(x).tobytes() for x in np.split(shared[which], cuts)])


def candidates(pack: Pack, names: np.ndarray, answers: list[dict], buckets: int, window: int) -> np.ndarray:
    """Starts of the windows that no unshared symbol proves unique."""
    name, low, high = evidence(names, pack.docs, window)
    keys, which = np.unique(name, return_inverse=True)
    by_bucket = {a["bucket"]: a["body"] for a in answers}
    unshared = np.zeros(len(keys), bool)
    for b, at in _bucket_slices(keys, buckets):
        unshared[at] = ~np.unpackbits(np.frombuffer(by_bucket[b], np.uint8), count=len(at)).astype(bool)
    proof = unshared[which]
    n = len(names)
    steps = np.bincount(np.maximum(high[proof] - window, 0), minlength=n + 1).astype(np.int64)
    steps[:n + 1] -= np.bincount(low[proof] + 1, minlength=n + 1)[:n + 1]
    open_ = np.cumsum(steps)[:n] == 0
    fits = np.arange(n) + window <= (pack.first + pack.counts)[pack.docs]
    return np.flatnonzero(open_ & fits)


def window_requests(pack: Pack, answers: list[dict], buckets: int, window: int) -> list[tuple]:
    """The earliest of each candidate window; later ones of this pack are repeats already."""
    one, two = pack.names()
    at = candidates(pack, one, answers, buckets, window)
    f1, f2 = (_window_prints(x, window, m)[at] if len(at) else np.zeros(0, np.uint64)
              for x, m in zip((one, two), _MULT, strict=True))
    lowest = np.iinfo(np.int64).min
    ids = np.array([lowest if x is None else x for x in pack.ids], np.int64)[pack.docs[at]]
    start = at - pack.first[pack.docs[at]]
    order = np.lexsort((start, ids, f2, f1))
    f1, f2, ids, start, at = f1[order], f2[order], ids[order], start[order], at[order]
    repeat = _later(f1, f2, ids, start)
    send = ~repeat
    local = _pack(np.sort(at[repeat]))
    rows = []
    f1, f2, ids, start, at = f1[send], f2[send], ids[send], start[send], at[send]
    for b, part in _bucket_slices(f1, buckets):
        part = part[np.argsort(at[part], kind="stable")]
        where = np.stack([ids[part], start[part], at[part]])
        body = f1[part].tobytes() + f2[part].tobytes() + _pack(np.diff(where, prepend=0))
        rows.append((b, pack.pack, len(part).to_bytes(8, "little") + body, local if not rows else None))
    return rows if rows or not len(at) + repeat.sum() else [(0, pack.pack, bytes(8), local)]


def _later(f1: np.ndarray, f2: np.ndarray, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """In sorted order: whether an equal window starts strictly earlier."""
    if not len(f1):
        return np.zeros(0, bool)
    new = np.append(True, (f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1]))
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    return (ids != ids[head]) | (start != start[head])


def answer_windows(table: pa.Table) -> pa.Table:
    """For each pack: the starts of its windows that also stand earlier."""
    f1, f2, ids, start, at, sizes = [], [], [], [], [], []
    for body in table.column("body").to_pylist():
        n = int.from_bytes(body[:8], "little")
        sizes.append(n)
        if n:
            f1.append(np.frombuffer(body, np.uint64, n, 8))
            f2.append(np.frombuffer(body, np.uint64, n, 8 + 8 * n))
            where = np.cumsum(_unpack(body[8 + 16 * n:], np.int64).reshape(3, n), axis=1)
            ids.append(where[0])
            start.append(where[1])
            at.append(where[2])
    packs_ = table.column("pack").to_pylist()
    local = [(p, x) for p, x in zip(packs_, table.column("local").to_pylist(), strict=True) if x]
    out = ([p for p, _ in local], [-1] * len(local), [x for _, x in local])
    if f1:
        f1, f2, ids, start, at = map(np.concatenate, (f1, f2, ids, start, at))
        order = np.lexsort((start, ids, f2, f1))
        repeat = np.zeros(len(f1), bool)
        repeat[order] = _later(f1[order], f2[order], ids[order], start[order])
        end = 0
        for p, n in zip(packs_, sizes, strict=True):
            here, end = slice(end, end + n), end + n
            if len(hit := at[here][repeat[here]]):
                out[0].append(p)
                out[1].append(0)
                out[2].append(_pack(hit))
    return _answers(*out)


def _ask(source: DataFrame, make: Callable[[dict], list[tuple]], answer: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Requests of all packs to their buckets, the answers grouped by pack."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _request(make(row))
    asked = source.mapInArrow(run, REQUEST)
    answers = asked.groupBy("bucket").applyInArrow(answer, ANSWER)
    return answers.groupBy("pack").agg(F.collect_list(F.struct("bucket", "body")).alias("answers"))


# --- the operator ------------------------------------------------------------

FOUND = "doc_id long, n_words long, n_removed long, kept_text string"


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW,
                   pack_words: int = PACK_WORDS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """One row per document: word counts and the kept words joined by one space."""
    table = materialize(packs(docs, text_col, id_col, pack_words), "packs")
    words = table.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(1, math.ceil(words / bucket_words))
    shared = _ask(table, lambda row: name_requests(Pack(row), buckets), answer_names)
    asked = table.join(shared, "pack", "left")
    repeats = _ask(asked, lambda row: window_requests(Pack(row), row["answers"] or [], buckets, window),
                   answer_windows)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _kept(Pack(row), row["answers"] or [], window)
    return table.join(repeats, "pack", "left").mapInArrow(finish, FOUND)


def _kept(pack: Pack, answers: list[dict], window: int) -> pa.RecordBatch:
    n = len(pack.codes)
    steps = np.zeros(n + 1, np.int64)
    for a in answers:
        at = _unpack(a["body"], np.int64)
        steps += np.bincount(at, minlength=n + 1)
        steps -= np.bincount(at + window, minlength=n + 1)[:n + 1]
    stays = np.cumsum(steps)[:n] == 0
    removed, kept = [], []
    for first, count in zip(pack.first.tolist(), pack.counts.tolist(), strict=True):
        codes = pack.codes[first:first + count][stays[first:first + count]]
        removed.append(count - len(codes))
        kept.append(b" ".join(map(pack.words.__getitem__, codes.tolist())))
    return pa.RecordBatch.from_arrays(
        [pa.array(pack.ids, pa.int64()), pa.array(pack.counts), pa.array(removed, pa.int64()),
         pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])
