"""Benchmark decontamination: a broadcast set of the benchmark's word n-grams is
scanned against every training document; hits are verified word by word.

The benchmark is cut into blocks of bounded size (by a hash of item id and text,
copies merged, so one item with many texts fills no block). Each block is one broadcast and one map-only pass over the documents; the hits
of the passes add up, so a benchmark of any size is matched whole.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters.
Defined results: null or empty texts have no words and no hits; an item without
words has no window; a null item_id counts as the empty string; rows with one
item_id are one item; repeated documents are judged each on their own; very long
texts are scanned whole; an empty table on either side gives no rows and no hits;
input columns with the name of a result are replaced.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.llm.shared import add_arrow_columns, materialize, text_bytes

NGRAM = 13
#: Bytes of benchmark text in one broadcast block; built, it takes up to ten times that
#: (and 200 bytes for each distinct word).
BLOCK_BYTES = 4 << 20
#: Bytes of documents whose words are held at a time.
CHUNK_BYTES = 1 << 20

#: Every byte to its lower-case word byte, or to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
             for b in range(256))
_MULT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

FIELDS = [
    T.StructField("hit_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def window_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every window of ``length`` values, by doubling."""
    if len(values) < length:
        return np.empty(0, np.uint64)
    done, out, power, step = 0, None, 1, values
    while True:
        if length >> (power.bit_length() - 1) & 1:
            if out is None:
                out, done = step, power
            else:
                mult = np.uint64(pow(_MULT, power, 1 << 64))
                m = len(values) - done - power + 1
                out = out[:m] * mult + step[done:done + m]
                done += power
        if power * 2 > length:
            return out
        m = len(step) - power
        step = step[:m] * np.uint64(pow(_MULT, power, 1 << 64)) + step[power:power + m]
        power *= 2


class Windows:
    """The windows of one benchmark block in packed arrays, ready for scanning.

    ``words`` holds the word numbers of all items one behind the other. For each
    window length: the sorted hashes of the distinct windows, where each of them
    stands in ``words``, and the numbers of its items, all windows in one array."""

    def __init__(self, items: Iterable[tuple[str, bytes]], ngram: int):
        self.ids: dict[bytes, int] = {}
        names: dict[str, int] = {}
        words, owners, sizes = array("i"), [], []
        for item, text in items:
            found = words_of(text)
            words.extend(self.ids.setdefault(w, len(self.ids) + 1) for w in found)
            owners.append(names.setdefault(item, len(names)))
            sizes.append(len(found))
        self.names, self.words = list(names), np.array(words, np.int32)
        starts = np.cumsum([0, *sizes])
        owner = np.array(owners, np.int32)
        length = np.minimum(ngram, np.array(sizes, np.int64))
        lengths = sorted({n for n in length.tolist() if n})
        for seed in itertools.count(7):
            rng = np.random.default_rng(seed)
            self.value = np.concatenate([np.zeros(1, np.uint64),
                                         rng.integers(1, _MASK, len(self.ids), np.uint64, endpoint=True)])
            made = {}
            for n in lengths:
                mine = np.flatnonzero(length == n)
                at = np.concatenate([np.arange(starts[k], starts[k + 1] - n + 1) for k in mine])
                made[n] = self._windows(n, at, np.repeat(owner[mine], np.array(sizes)[mine] - n + 1))
            if all(made.values()):              # else two windows share a hash: draw other values
                break
        self.tables = made

    def _windows(self, length: int, at: np.ndarray, owner: np.ndarray) -> dict | None:
        hashes = window_hashes(self.value[self.words], length)[at]
        order = np.lexsort((owner, hashes))
        hashes, at, owner = hashes[order], at[order], owner[order]
        same = hashes[1:] == hashes[:-1]
        if not self._equal(at[1:][same], self.words, at[:-1][same], length).all():
            return None
        first = np.r_[True, ~same]
        keep = np.r_[True, ~same | (owner[1:] != owner[:-1])]               # an item once for each window
        counts = np.add.reduceat(keep, np.flatnonzero(first))
        bits = max(16, (8 * int(first.sum())).bit_length())
        table = np.zeros(1 << bits, bool)
        table[(hashes[first] >> np.uint64(64 - bits)).astype(np.int64)] = True
        return {"hash": hashes[first], "at": at[first].astype(np.int32), "table": table,
                "cuts": np.r_[0, np.cumsum(counts)].astype(np.int32), "items": owner[keep]}

    def _equal(self, at: np.ndarray, ids: np.ndarray, there: np.ndarray, length: int) -> np.ndarray:
        """Whether the windows of ``ids`` at ``at`` are those of ``words`` at ``there``."""
        out = np.ones(len(at), bool)
        for k in range(length):
            out &= ids[at + k] == self.words[there + k]
        return out

    def find_in(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Per text: its number of words, and what ``find`` gives."""
        docs = [words_of(t) if t else [] for t in texts]
        return [(len(d), *x) for d, x in zip(docs, self.find(docs), strict=True)]

    def find(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """Per document: the spans (word positions) of its hits and their items."""
        found: list[tuple[list, set]] = [([], set()) for _ in docs]
        flat = [w for d in docs for w in d]
        ends = np.cumsum([len(d) for d in docs])
        ids = np.fromiter(map(self.ids.get, flat, itertools.repeat(0)), np.int64, len(flat))
        codes = self.value[ids]
        for length, t in self.tables.items():
            hashes = window_hashes(codes, length)
            shift = np.uint64(65 - len(t["table"]).bit_length())
            at = np.flatnonzero(t["table"][(hashes >> shift).astype(np.int64)])
            k = np.minimum(np.searchsorted(t["hash"], hashes[at]), len(t["hash"]) - 1)
            doc = np.searchsorted(ends, at, "right")
            good = (t["hash"][k] == hashes[at]) & (at + length <= ends[np.minimum(doc, len(ends) - 1)])
            at, k, doc = at[good], k[good], doc[good]
            good = self._equal(at, ids, t["at"][k], length)                 # word by word
            for i, w, d in zip(at[good].tolist(), k[good].tolist(), doc[good].tolist(), strict=True):
                first = i - (int(ends[d]) - len(docs[d]))
                found[d][0].append((first, first + length))
                found[d][1].update(self.names[x] for x in t["items"][t["cuts"][w]:t["cuts"][w + 1]].tolist())
        return found


def chunks(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Neighbouring texts of ``CHUNK_BYTES`` together (or one longer text)."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t or b"")
        if size >= CHUNK_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def merge_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(docs: DataFrame, text_col: str, block, first: bool, min_percent: int) -> DataFrame:
    def make() -> Callable[[pa.RecordBatch], list]:
        windows = block.value

        def work(batch: pa.RecordBatch) -> list:
            found = [x for some in chunks(text_bytes(batch.column(text_col))) for x in windows.find_in(some)]
            if not first:
                old = zip(batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist(), strict=True)
                for (_, spans, items), (s, i) in zip(found, old, strict=True):
                    spans.extend((x["start"], x["end"]) for x in s)
                    items.update(i)
            out: list[list] = [[] for _ in FIELDS]
            for n, spans, items in found:
                spans, ids = merge_spans(spans), sorted(items)
                hit = sum(b - a for a, b in spans)
                row = ([{"start": a, "end": b} for a, b in spans], ids, n, hit, len(ids),
                       hashlib.sha256(",".join(ids).encode()).hexdigest(),
                       hit > 0 and 100 * hit >= min_percent * n)
                for x, v in zip(out, row, strict=True):
                    x.append(v)
            return out
        return work
    return add_arrow_columns(docs, FIELDS, make)


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", ngram: int = NGRAM, min_percent: int = 5,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus ``FIELDS``: merged hit spans (word positions), the items found,
    counts, and whether hit words are at least ``min_percent`` of all words."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(item_text).alias("text")).filter("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    out = docs
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        rows = [(r["item"], r["text"].encode()) for r in part.toLocalIterator()]
        block = docs.sparkSession.sparkContext.broadcast(Windows(rows, ngram))
        out = _scan(out, text_col, block, k == 0, min_percent)
        if k + 1 < blocks:
            out = materialize(out, "decontaminate")
    return out


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return "".join(out) + text[last:]


def remove(scanned: DataFrame, text_col: str = "text", spans_only: bool = False) -> DataFrame:
    """Drop the contaminated documents, or with ``spans_only`` cut their hit spans."""
    names = [f.name for f in FIELDS]
    if not spans_only:
        return scanned.filter(~F.col("contaminated")).drop(*names)

    def make() -> Callable[[pa.RecordBatch], list]:
        def work(batch: pa.RecordBatch) -> list:
            columns = (batch.column(c).to_pylist() for c in (text_col, "hit_spans"))
            return [[cut_spans(t, [(x["start"], x["end"]) for x in s]) if s else t
                     for t, s in zip(*columns, strict=True)]]
        return work
    cut = add_arrow_columns(scanned, [T.StructField(text_col, T.StringType())], make, tuple(names))
    return cut.select(*[c for c in scanned.columns if c not in names])
