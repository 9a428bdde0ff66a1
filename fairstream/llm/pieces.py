"""SentencePiece (BPE with byte fallback) encoding with seeded merge-dropout.

A text is cut where a space follows another character; no piece crosses such a
place, so the chunks merge independently. A chunk's candidate merges are taken
from an agenda in the order of their scores, the leftmost first among equals.
With dropout, each candidate that is taken is skipped if its keyed hash (seed,
document, place of the chunk, chunk, merge, step of the agenda) falls below the
rate, so every occurrence of a word draws on its own. What is remembered is no
draw but an agenda: the merges of a chunk without a skip, and with one skip at a
given step. An occurrence whose draws follow one of them takes its pieces; the
others are merged each on their own. With rate 0 the pieces are the model's own.

Decoding joins the pieces, and bytes for what no piece covers, so it gives every
text back exactly (a literal U+2581 too, which is encoded as bytes).

Defined results: a null text gives null ids, an empty one no ids; a null id is
a key like any other; repeated rows with one id are cut alike; an empty table gives
no rows; input columns with the name of a result are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fairstream.llm.shared import add_arrow_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 13
#: Agendas kept per Python worker; a full memory is emptied.
CACHE_CHUNKS = 500_000

_CHUNK = re.compile(r" +[^ ]*")
_SHORT = 48
_GROUP_CHARS = 4 << 20
_NEVER = (1 << 31) - 1
_MASK = (1 << 32) - 1


class Model:
    """Pieces, ranks (lower merges first) and byte ids of a model file's content."""

    def __init__(self, content: bytes):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_proto=content)
        n = lib.get_piece_size()
        self.texts, self.bytes_at, self.ids, self.ranks = [b""] * n, [0] * 256, {}, {}
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes_at[value], self.texts[i] = i, bytes([value])
            elif not (lib.is_control(i) or lib.is_unknown(i)):
                piece = piece.replace("▁", " ")
                self.ids[piece], self.ranks[piece], self.texts[i] = i, -lib.get_score(i), piece.encode()
        order = {score: k for k, score in enumerate(sorted(set(self.ranks.values())))}
        self.ranks = {piece: order[score] for piece, score in self.ranks.items()}

    def to_ids(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for p in parts:
            if (i := self.ids.get(p)) is None:
                out.extend(self.bytes_at[b] for b in p.encode())
            else:
                out.append(i)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``, without the space that encoding puts first."""
        return b"".join(map(self.texts.__getitem__, ids)).decode()[1:]


def occurrences(key: str, seed: int, n: int) -> np.ndarray:
    """A number for each of the first ``n`` places of the document ``key``."""
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= np.uint64(xxhash.xxh64_intdigest(key.encode(), seed))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


class Dropout:
    """Whether a taken candidate is skipped: a keyed hash of occurrence, chunk, merge and step."""

    def __init__(self, chunk: str, rate: float, seed: int, occurrence: int):
        self.limit = int(rate * (1 << 32))
        self.key = xxhash.xxh32_intdigest(chunk.encode(), seed & _MASK) + occurrence & _MASK if self.limit else 0
        self.step = 0

    def skips(self, rank: int) -> bool:
        """``rank`` names the merge: pieces have ranks of their own (runs of spaces share one)."""
        self.step += 1
        x = (self.key + rank * 0x9E3779B1 + self.step * 0x85EBCA77 & _MASK) * 0xC2B2AE3D & _MASK
        x = (x ^ x >> 15) * 0x27D4EB2F & _MASK
        return (x ^ x >> 13) < self.limit


def skips_many(keys: np.ndarray, ranks: np.ndarray, steps: np.ndarray | int, limit: int) -> np.ndarray:
    """``Dropout.skips`` for arrays."""
    x = keys + ranks.astype(np.uint32) * np.uint32(0x9E3779B1)
    x += np.asarray(steps).astype(np.uint32) * np.uint32(0x85EBCA77)
    x *= np.uint32(0xC2B2AE3D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    return (x ^ (x >> np.uint32(13))) < np.uint64(limit)


def merge_short(chunk: str, model: Model, drop: Dropout) -> list[str]:
    """The agenda as a list of ranks, for chunks of few characters."""
    rank, parts, skips = model.ranks.get, list(chunk), drop.skips if drop.limit else None
    agenda = [rank(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
    while agenda and (best := min(agenda)) != _NEVER:
        i = agenda.index(best)
        if skips and skips(best):
            agenda[i] = _NEVER
            continue
        parts[i] = piece = parts[i] + parts.pop(i + 1)
        del agenda[i]
        if i:
            agenda[i - 1] = rank(parts[i - 1] + piece, _NEVER)
        if i < len(agenda):
            agenda[i] = rank(piece + parts[i + 1], _NEVER)
    return parts


def merge_long(chunk: str, model: Model, drop: Dropout) -> list[str]:
    """The agenda as a heap over linked symbols, for chunks of any length."""
    n, parts = len(chunk), list(chunk)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, str]] = []

    def propose(i: int) -> None:
        if i >= 0 and (j := after[i]) < n:
            piece = parts[i] + parts[j]
            if (r := model.ranks.get(piece)) is not None:
                heapq.heappush(agenda, (r, i, j, piece))

    for i in range(n - 1):
        propose(i)
    while agenda:
        rank, i, j, piece = heapq.heappop(agenda)
        if not parts[i] or after[i] != j or parts[i] + parts[j] != piece or drop.limit and drop.skips(rank):
            continue
        parts[i], parts[j], after[i] = piece, "", after[j]
        if after[i] < n:
            before[after[i]] = i
        propose(before[i])
        propose(i)
    return [p for p in parts if p]


class PairTable:
    """Rank and piece of every pair of pieces whose join is a piece, for arrays of
    pairs: an open-addressing table."""

    def __init__(self, model: Model):
        pairs = {(model.ids[p[:k]] << 32) + model.ids[p[k:]]: (r, model.ids[p]) for p, r in model.ranks.items()
                 for k in range(1, len(p)) if p[:k] in model.ids and p[k:] in model.ids}
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank, self.piece = (np.full(1 << self.bits, _NEVER, np.int32) for _ in range(2))
        keys = np.array(list(pairs), np.int64)
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):                        # each round, the first to ask gets a free slot
            free = left[self.keys[slot[left]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.rank[slot[won]], self.piece[slot[won]] = keys[won], *values[won].T
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair (rank ``_NEVER``: no piece)."""
        shape, keys = a.shape, ((a.astype(np.int64) << 32) + b).ravel()
        slot = self._slot(keys)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            open_ = open_[(self.keys[slot[open_]] != keys[open_]) & (self.keys[slot[open_]] != -1)]
        return self.rank[slot].reshape(shape), self.piece[slot].reshape(shape)


def merge_many(symbols: np.ndarray, table: PairTable, skips: Callable | None = None,
               ) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The agendas of many chunks of one length at once: the ids of each, and the
    merges taken up (their ranks, chunk by chunk, and how many).

    Row by row this is ``merge_short``: every round takes one candidate of each
    chunk, so the round is the step; ``skips(rows, ranks, step)`` says which are
    skipped. An agenda entry is rank and place in one number."""
    n, width = symbols.shape
    out: list[bytes] = [b""] * n
    cells, rows, step = np.ascontiguousarray(symbols.T).astype(np.int32), np.arange(n), 0
    after = np.repeat(np.arange(1, width + 1, dtype=np.int32)[:, None], n, 1)
    before = after - 2
    agenda, piece = (np.full((width, n), _NEVER, np.int32) for _ in range(2))

    def entry(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(rank == _NEVER, _NEVER, rank * 64 + at)

    rank, piece[:-1] = table.find(cells[:-1], cells[1:])
    agenda[:-1] = entry(rank, np.arange(width - 1, dtype=np.int32)[:, None])
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    while len(rows):
        best = agenda.min(axis=0)
        live = best != _NEVER
        at_work = np.flatnonzero(live)
        if 2 * len(at_work) <= len(rows):
            ended = cells[:, ~live].T
            there = ended >= 0
            ids, ends = ended[there].astype("<i4").tobytes(), np.cumsum(there.sum(axis=1) * 4).tolist()
            for r, a, b in zip(rows[~live].tolist(), [0, *ends], ends, strict=False):
                out[r] = ids[a:b]
            cells, after, before, agenda, piece = (x[:, live] for x in (cells, after, before, agenda, piece))
            rows, best, at_work = rows[live], best[live], np.arange(len(at_work))
            if not len(rows):
                break
        at, rank, step = best[at_work] & 63, best[at_work] >> 6, step + 1
        taken.append((rows[at_work], rank))
        agenda[at, at_work] = _NEVER
        if skips:
            go = ~skips(rows[at_work], rank, step)
            at, at_work = at[go], at_work[go]
        right, made = after[at, at_work], piece[at, at_work]
        beyond = after[right, at_work]
        cells[at, at_work], cells[right, at_work] = made, -1
        agenda[right, at_work] = _NEVER
        after[at, at_work] = beyond
        ok = beyond < width
        i, j, c = at[ok], beyond[ok], at_work[ok]
        before[j, c] = i
        rank, piece[i, c] = table.find(made[ok], cells[j, c])
        agenda[i, c] = entry(rank, i)
        i = before[at, at_work]
        ok = i >= 0
        i, c = i[ok], at_work[ok]
        rank, piece[i, c] = table.find(cells[i, c], made[ok])
        agenda[i, c] = entry(rank, i)
    if not taken:
        return out, np.zeros(0, np.int32), np.zeros(n, np.int64)
    whose, ranks = (np.concatenate(x) for x in zip(*taken, strict=True))
    return out, ranks[np.argsort(whose, kind="stable")], np.bincount(whose, minlength=n)


class Agendas:
    """Remembered agendas: the ids and the merges taken up behind ``start`` steps."""

    def __init__(self):
        self.ids: list[bytes] = []
        self.ranks = np.zeros(0, np.int32)
        self.begin, self.count, self.start = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, ids: list[bytes], ranks: np.ndarray, count: np.ndarray, start: np.ndarray) -> None:
        self.begin = np.concatenate([self.begin, len(self.ranks) + np.cumsum(count) - count + start])
        self.count = np.concatenate([self.count, count - start])
        self.start = np.concatenate([self.start, start])
        self.ranks = np.concatenate([self.ranks, ranks])
        self.ids += ids

    def first_skip(self, which: np.ndarray, keys: np.ndarray, limit: int) -> np.ndarray:
        """The first step at which an occurrence with such an agenda skips, or 0."""
        count = self.count[which]
        rows = np.repeat(np.arange(len(which)), count)
        within = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
        steps = self.start[which][rows] + within + 1
        hit = np.flatnonzero(skips_many(keys[rows], self.ranks[self.begin[which][rows] + within], steps, limit))
        out = np.zeros(len(which), np.int64)
        out[rows[hit[::-1]]] = steps[hit[::-1]]         # the first of a row is written last
        return out


class Encoder:
    """Encodes texts; the agendas of short chunks are remembered."""

    def __init__(self, model: Model, rate: float = DROPOUT, seed: int = SEED):
        if not 0 <= rate <= 1:
            raise ValueError("the rate must be from 0 to 1")
        self.model, self.rate, self.seed, self.limit = model, rate, seed, int(rate * (1 << 32))
        self._forget()
        self.table = PairTable(model)
        self.unknown = len(model.texts)         # a character without a piece: this and its code point
        self.char_ids = self.unknown + np.arange(0x110000)
        for piece, i in model.ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i

    def _forget(self) -> None:
        self.room = CACHE_CHUNKS
        self.known: dict[str, int] = {}
        self.chunks: list[str] = []
        self.hashes = np.zeros(0, np.uint32)
        self.plain, self.skipped = Agendas(), Agendas()
        self.known_skips: dict[int, int] = {}

    def _ids(self, parts: list[str]) -> bytes:
        return np.array(self.model.to_ids(parts), "<i4").tobytes()

    def _spell(self, ids: bytes) -> bytes:
        """``ids`` with the bytes of the characters without a piece."""
        out: list[int] = []
        for i in np.frombuffer(ids, "<i4").tolist():
            if i < self.unknown:
                out.append(i)
            else:
                out.extend(self.model.bytes_at[b] for b in chr(i - self.unknown).encode())
        return np.array(out, "<i4").tobytes()

    def _merge(self, chunks: list[str], skips: Callable | None) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """``merge_many`` for short chunks of all lengths."""
        ids: list[bytes] = [b""] * len(chunks)
        ranks, whose = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        for length in np.unique(lengths).tolist():
            group = np.flatnonzero(lengths == length)
            for at in range(0, len(group), 1 << 14):
                rows = group[at:at + (1 << 14)]
                points = np.frombuffer("".join([chunks[i] for i in rows.tolist()]).encode("utf-32-le"), np.uint32)
                symbols = self.char_ids[points].reshape(-1, length)
                pick = (lambda r, k, s, rows=rows: skips(rows[r], k, s)) if skips else None
                found, taken, count = merge_many(symbols, self.table, pick)
                for i, x in zip(rows.tolist(), found, strict=True):
                    ids[i] = x
                for i in rows[(symbols >= self.unknown).any(axis=1)].tolist():
                    ids[i] = self._spell(ids[i])
                ranks.append(taken)
                whose.append(np.repeat(rows, count))
        owner = np.concatenate(whose)
        return ids, np.concatenate(ranks)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(chunks))

    def _learn(self, flat: list[str]) -> None:
        """The agendas without a skip of the chunks that are not known yet."""
        if self.room <= 0:
            self._forget()
        fresh = [c for c in set(flat) - self.known.keys() if len(c) <= _SHORT]
        self.room -= len(fresh)
        ids, ranks, count = self._merge(fresh, None)
        self.known.update(zip(fresh, range(len(self.chunks), len(self.chunks) + len(fresh)), strict=True))
        self.chunks += fresh
        if self.limit:
            seed = self.seed & _MASK
            hashes = np.fromiter((xxhash.xxh32_intdigest(c.encode(), seed) for c in fresh), np.uint32, len(fresh))
            self.hashes = np.concatenate([self.hashes, hashes])
        self.plain.add(ids, ranks, count, np.zeros(len(fresh), np.int64))

    def _learn_skips(self, codes: np.ndarray) -> np.ndarray:
        """The agendas with one skip: chunk and step in one number."""
        fresh = [c for c in np.unique(codes).tolist() if c not in self.known_skips]
        self.room -= len(fresh)
        first = len(self.skipped.ids)
        self.known_skips.update(zip(fresh, range(first, first + len(fresh)), strict=True))
        at = np.array(fresh, np.int64) & 255
        self.skipped.add(*self._merge([self.chunks[c >> 8] for c in fresh], lambda r, k, s: at[r] == s), at)
        return np.fromiter(map(self.known_skips.__getitem__, codes.tolist()), np.int64, len(codes))

    def _encode(self, flat: list[str], places: np.ndarray) -> list[bytes]:
        """The ids of each chunk; ``places`` numbers the occurrences."""
        self._learn(flat)
        which = np.fromiter(map(self.known.get, flat, itertools.repeat(-1)), np.int64, len(flat))
        plain = self.plain.ids
        out = [plain[i] for i in which.tolist()] if plain else [b""] * len(flat)
        for i in np.flatnonzero(which < 0).tolist():
            drop = Dropout(flat[i], self.rate, self.seed, int(places[i]) if self.limit else 0)
            out[i] = self._ids(merge_long(flat[i], self.model, drop))
        if not self.limit:
            return out
        short = np.flatnonzero(which >= 0)
        which, keys = which[short], self.hashes[which[short]] + places[short]
        step = self.plain.first_skip(which, keys, self.limit)
        some = np.flatnonzero(step)
        short, which, keys = short[some], which[some], keys[some]
        once = self._learn_skips(which * 256 + step[some])
        for i, k in zip(short.tolist(), once.tolist(), strict=True):
            out[i] = self.skipped.ids[k]
        more = np.flatnonzero(self.skipped.first_skip(once, keys, self.limit))
        short, keys = short[more].tolist(), keys[more]
        found, _, _ = self._merge([flat[i] for i in short], lambda r, k, s: skips_many(keys[r], k, s, self.limit))
        for i, x in zip(short, found, strict=True):
            out[i] = x
        return out

    def encode(self, text: str, key: str = "") -> np.ndarray:
        """Ids of ``text``; ``key`` names its document."""
        return self.encode_many([text], [key])[0]

    def encode_many(self, texts: list[str], keys: list[str]) -> list[np.ndarray]:
        """The ids of each text of a batch."""
        out, group, chars = [], [], 0
        for k, (text, key) in enumerate(zip(texts, keys, strict=True)):
            group.append((_CHUNK.findall(" " + text) if text else [], key))
            chars += len(text)
            if chars >= _GROUP_CHARS or k + 1 == len(texts):
                places = [occurrences(d, self.seed, len(c)) for c, d in group] if self.limit else []
                found = self._encode(list(itertools.chain(*[c for c, _ in group])),
                                     np.concatenate([np.zeros(0, np.uint32), *places]))
                ends = list(itertools.accumulate(len(c) for c, _ in group))
                out += [np.frombuffer(b"".join(found[a:b]), "<i4") for a, b in zip([0, *ends], ends, strict=False)]
                group, chars = [], 0
        return out


@functools.lru_cache(maxsize=1)
def worker_encoder(content: bytes, rate: float, seed: int) -> Encoder:
    """One encoder per Python worker: its memory of agendas serves every task there."""
    return Encoder(Model(content), rate, seed)


FIELDS = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()),
          T.StructField("ids_sha256", T.StringType()), T.StructField("lossless", T.BooleanType())]


def _content(spark: SparkSession, path: str):
    with open(path, "rb") as f:        # read by the driver; a model file is under a megabyte
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", model_path: str = MODEL,
           rate: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``docs`` plus ``ids``, ``n_pieces``, ``ids_sha256`` (of the ids as 32-bit little
    endian) and ``lossless`` (whether decoding gave the text back; null for null)."""
    content = _content(docs.sparkSession, model_path)

    def make() -> Callable[[pa.RecordBatch], list]:
        encoder = worker_encoder(content.value, rate, seed)
        model = encoder.model

        def work(batch: pa.RecordBatch) -> list:
            texts = batch.column(text_col).to_pylist()
            found = encoder.encode_many([t or "" for t in texts], [str(k) for k in batch.column(id_col).to_pylist()])
            ids, counts, digests, lossless = [], [], [], []
            for text, x in zip(texts, found, strict=True):
                missing = text is None
                ids.append(None if missing else x)
                counts.append(None if missing else len(x))
                digests.append(None if missing else hashlib.sha256(x.tobytes()).hexdigest())
                lossless.append(None if missing else model.decode(x.tolist()) == text)
            return [_lists(ids), counts, digests, lossless]
        return work
    return add_arrow_columns(docs, FIELDS, make)


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if x is None else len(x) for x in ids])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)])
    missing = pa.array([x is None for x in ids], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()), mask=missing)


def decode(encoded: DataFrame, ids_col: str = "ids", model_path: str = MODEL, out_col: str = "decoded") -> DataFrame:
    """``encoded`` plus the text of ``ids`` (null for null)."""
    content = _content(encoded.sparkSession, model_path)

    def make() -> Callable[[pa.RecordBatch], list]:
        model = Model(content.value)
        return lambda batch: [[None if x is None else model.decode(x)
                               for x in batch.column(ids_col).to_pylist()]]
    return add_arrow_columns(encoded, [T.StructField(out_col, T.StringType())], make)
