"""Alignment of two tokenizers over the same bytes.

Both tokenizers cover the bytes of space + text. Where a token of each ends, the
bytes are cut: what lies between two cuts is a group, and the last tokens of its
two sides are linked.

1. A document of at most ``LONG_BYTES`` is encoded and grouped in one task, many
   documents at a time in arrays. A longer one is cut into sections at spaces
   between word characters, where neither tokenizer has a token across, and the
   sections are dealt over the tasks.
2. Fragments. The tokens that end in one range of ``RANGE_BYTES`` bytes make a
   fragment: an open prefix (up to the first cut), closed groups, an open suffix
   (behind the last cut); without a cut all is prefix. Fragments compose: the
   suffix of the left and the prefix of the right close one group. Composition is
   associative, and the empty fragment is its identity.
3. Tree reduction. Spark rounds compose eight neighbours of a document at a time.
   Only prefixes and suffixes travel; closed groups stay where they are, and each
   round writes the groups that it closed.
4. Counts. The links of each document are counted by pair of ids, then by Spark
   over all documents. The table of counts goes back to the documents by
   broadcast, ``PAIR_BLOCK`` pairs at a time, as many passes as the table needs.

A document's groups are given in pieces that are joined by ``;`` in the order of
``seq``, so that no long document is gathered; a short one has one piece.

Defined results: null and empty texts, and texts whose token bytes differ from
space + text, have no tokens, no pieces and zero counts; strings of special tokens
are plain text; rows with one doc_id are documents of their own; other columns are
ignored; an empty table gives no rows. A stretch without any space is one section,
however long.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.llm.shared import materialize

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
LONG_BYTES, SECTION_CHARS, RANGE_BYTES = 1 << 16, 1 << 14, 1 << 13
FAN_IN_BITS = 3
PAIR_BLOCK = 2_000_000
_BATCH_BYTES = 1 << 20
_CUT = re.compile(r"(?<=[\w.,;:!?]) (?=\w)")
#: How the byte model splits a text before its merges (fixed value of that model).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# --- tokenizers --------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones
    for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both models, from the contents of their files, and the bytes of their ids."""

    def __init__(self, byte_model: bytes, piece_model: bytes):
        import sentencepiece
        import tiktoken

        self.byte_model = byte_model
        letters, content = _byte_letters(), json.loads(byte_model)
        special = {t["id"] for t in content["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i
                 for token, i in content["model"]["vocab"].items() if i not in special}
        self.a = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode())
        self.n_b = len(self.b_bytes)
        n_a = max(ranks.values()) + 1
        self.a_size = np.zeros(n_a, np.int64)
        for token, i in ranks.items():
            self.a_size[i] = len(token)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # how an id is written within a group, and as the last of its side
        self.written = [b"%d%s" % (i, end) for i in range(n_a) for end in (b",", b"|")]
        self.written += [b"%d%s" % (i, end) for i in range(self.n_b) for end in (b",", b";")]
        self.first_b = 2 * n_a

    def _encode_bytes(self, text: str) -> np.ndarray:
        try:
            return self.a.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:          # its pattern matcher gives up on a million blanks in a row
            from tokenizers import Tokenizer

            slower = Tokenizer.from_buffer(self.byte_model)
            slower.encode_special_tokens = True
            return np.array(slower.encode(text, add_special_tokens=False).ids, np.int64)

    def encode(self, texts: list[str]) -> tuple[list, list, list[bool]]:
        """Ids of space + text by each model, and whether both cover its bytes."""
        spaced = [" " + t for t in texts]
        a = [self._encode_bytes(t) for t in spaced]
        b = self.b.encode(texts, num_threads=1)
        fits = []
        for text, x, y in zip(spaced, a, b):
            raw = text.encode()
            fits.append(self.a_size[x].sum() == len(raw) and b"".join([self.b_bytes[i] for i in y]) == raw
                        and self.a.decode_bytes(x.tolist()) == raw)
        return a, [np.array(y, np.int64) for y in b], fits


@functools.lru_cache(1)
def _loaded(byte_model: bytes, piece_model: bytes) -> Tokenizers:
    return Tokenizers(byte_model, piece_model)


def load(spark: SparkSession, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL):
    """A function that gives a task its tokenizers; the files (2 MB) are read by the
    driver and broadcast."""
    files = []
    for path in (byte_model, piece_model):
        with open(path, "rb") as f:
            files.append(f.read())
    sent = spark.sparkContext.broadcast(tuple(files))
    return lambda: _loaded(*sent.value)


# --- groups -------------------------------------------------------------------------

@dataclass
class Tokens:
    """Ids of both sides over the same bytes, with the byte at which each ends, and
    whether a token of the other side ends there too."""

    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray

    def __post_init__(self) -> None:
        self.a_cut = np.isin(self.a_end, self.b_end, assume_unique=True, kind="table") if len(self.a) else np.zeros(0, bool)
        self.b_cut = np.isin(self.b_end, self.a_end, assume_unique=True, kind="table") if len(self.b) else np.zeros(0, bool)


def tokens(t: Tokenizers, a: np.ndarray, b: np.ndarray, start: int = 0) -> Tokens:
    return Tokens(a, b, start + np.cumsum(t.a_size[a]), start + np.cumsum(t.b_size[b]))


def written_order(t: Tokenizers, a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray) -> np.ndarray:
    """Indexes into ``t.written``: the groups in order, side a before side b."""
    a_last, b_last = np.flatnonzero(a_cut), np.flatnonzero(b_cut)
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + np.r_[0, b_last + 1][a_group]] = 2 * a + a_cut
    out[np.arange(len(b)) + a_last[b_group] + 1] = t.first_b + 2 * b + b_cut
    return out


def write(t: Tokenizers, order: np.ndarray) -> bytes:
    return b"".join([t.written[k] for k in order.tolist()])[:-1]


def link_pairs(t: Tokenizers, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair of ids."""
    return a * t.n_b + b


_PIECE = T.StructType([
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("groups", T.StringType()), T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("times", T.ArrayType(T.LongType()))])


def _batches(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices with a bounded number of bytes (or one text)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    start = 0
    while start < len(texts):
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + _BATCH_BYTES, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)),
                                    pa.array(values.astype(np.int64)))


def align_texts(t: Tokenizers, texts: list) -> list[pa.Array]:
    """The columns of a piece for each text, all texts in one set of arrays: their
    bytes stand one behind the other, and every text ends in a cut."""
    rows = [k for k, text in enumerate(texts) if text]
    a, b, fits = t.encode([texts[k] for k in rows])
    rows, a, b = ([x for x, fit in zip(some, fits) if fit] for some in (rows, a, b))
    n = len(texts)
    n_a, n_b, n_groups, n_pairs = (np.zeros(n, np.int64) for _ in range(4))
    groups = [b""] * n
    pairs = times = np.zeros(0, np.int64)
    if rows:
        n_a[rows], n_b[rows] = [len(x) for x in a], [len(x) for x in b]
        every = tokens(t, np.concatenate(a), np.concatenate(b))
        order = written_order(t, every.a, every.b, every.a_cut, every.b_cut)
        ends = np.cumsum(n_a + n_b)
        for k in rows:
            groups[k] = write(t, order[ends[k] - n_a[k] - n_b[k]:ends[k]])
        owner = np.repeat(np.arange(n), n_a)[every.a_cut]
        n_groups = np.bincount(owner, minlength=n)
        keys = link_pairs(t, every.a[every.a_cut], every.b[every.b_cut])
        both, times = np.unique(owner << 40 | keys, return_counts=True)
        pairs, n_pairs = both & ((1 << 40) - 1), np.bincount(both >> 40, minlength=n)
    return [pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(groups, pa.binary()).cast(pa.string()),
            _lists(pairs, n_pairs), _lists(times, n_pairs)]


def short_pieces(docs: DataFrame, get) -> DataFrame:
    """``docs`` (uid, doc_id, text) aligned whole: uid, doc_id and the columns of a piece."""
    schema = T.StructType([docs.schema["uid"], docs.schema["doc_id"], *_PIECE.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = get()
        for batch in batches:
            at = 0
            for texts in _batches(batch.column("text")):
                ids = [batch.column(c).slice(at, len(texts)) for c in ("uid", "doc_id")]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(ids + align_texts(t, texts.to_pylist()), names=schema.fieldNames())
    return docs.mapInArrow(run, schema)


# --- fragments ------------------------------------------------------------------------

@dataclass(frozen=True)
class Fragment:
    """Open prefix, closed groups and open suffix; each group and each open part is
    (ids of a, ids of b). ``cut`` is false if no cut lies in the fragment."""

    prefix: tuple = ((), ())
    closed: tuple = ()
    suffix: tuple = ((), ())
    cut: bool = False


def compose(left: Fragment, right: Fragment) -> Fragment:
    def joined(x: tuple, y: tuple) -> tuple:
        return (x[0] + y[0], x[1] + y[1])
    if not left.cut:
        return Fragment(joined(left.prefix, right.prefix), right.closed, right.suffix, right.cut)
    if not right.cut:
        return Fragment(left.prefix, left.closed, joined(left.suffix, right.prefix), True)
    return Fragment(left.prefix, left.closed + (joined(left.suffix, right.prefix),) + right.closed, right.suffix, True)


def range_slices(every: Tokens, range_bytes: int) -> Iterator[tuple[int, slice, slice]]:
    """(range, its tokens of a, of b): a token belongs to the range of its last byte."""
    a_range, b_range = (every.a_end - 1) // range_bytes, (every.b_end - 1) // range_bytes
    for k in np.union1d(a_range, b_range).tolist():
        (a0, a1), (b0, b1) = np.searchsorted(a_range, [k, k + 1]), np.searchsorted(b_range, [k, k + 1])
        yield k, slice(a0, a1), slice(b0, b1)


def fragment_row(t: Tokenizers, every: Tokens, at: slice, bt: slice) -> dict:
    """A fragment as a row: open parts as ids, closed groups written and counted."""
    a, b, a_cut, b_cut = every.a[at], every.b[bt], every.a_cut[at], every.b_cut[bt]
    row = {"n_a": len(a), "n_b": len(b), "n_groups": 0, "groups": "", "pairs": [], "times": [],
           "cut": bool(a_cut.any()), "pre_a": a.tolist(), "pre_b": b.tolist(), "suf_a": [], "suf_b": []}
    if row["cut"]:
        (fa, *_, la), (fb, *_, lb) = (np.flatnonzero(c)[[0, -1]] for c in (a_cut, b_cut))
        row |= {"pre_a": a[:fa + 1].tolist(), "pre_b": b[:fb + 1].tolist(),
                "suf_a": a[la + 1:].tolist(), "suf_b": b[lb + 1:].tolist()}
        inner, outer = slice(fa + 1, la + 1), slice(fb + 1, lb + 1)
        if la > fa:
            order = written_order(t, a[inner], b[outer], a_cut[inner], b_cut[outer])
            keys = link_pairs(t, a[inner][a_cut[inner]], b[outer][b_cut[outer]])
            pairs, times = np.unique(keys, return_counts=True)
            row |= {"n_groups": len(keys), "groups": write(t, order).decode(), "pairs": pairs.tolist(),
                    "times": times.tolist()}
    return row


_FRAGMENT = T.StructType([
    T.StructField("fits", T.BooleanType()), T.StructField("seq", T.LongType()), T.StructField("range", T.LongType()),
    *_PIECE.fields, T.StructField("cut", T.BooleanType()),
    *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("pre_a", "pre_b", "suf_a", "suf_b")]])


def _arrow(fields: list) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type
    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in fields])


def cut_sections(text: str, section_chars: int = SECTION_CHARS) -> Iterator[tuple[int, str]]:
    """(first byte in space + text, section): the sections joined by spaces are the text."""
    start = byte = 0
    while True:
        found = _CUT.search(text, start + section_chars)
        section = text[start:found.start()] if found else text[start:]
        yield byte, section
        if not found:
            return
        start, byte = found.end(), byte + len(section.encode()) + 1


def fragments(docs: DataFrame, get, section_chars: int = SECTION_CHARS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The fragments of long ``docs`` (uid, doc_id, text), one row each, written."""
    ids = [docs.schema["uid"], docs.schema["doc_id"]]
    cut_schema = _arrow([*ids, T.StructField("byte", T.LongType()), T.StructField("section", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                parts = list(cut_sections(batch.column("text")[k].as_py(), section_chars))
                one = [pa.concat_arrays([batch.column(c).slice(k, 1)] * len(parts)) for c in ("uid", "doc_id")]
                yield pa.RecordBatch.from_arrays([*one, pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts])],
                                                 schema=cut_schema)

    sections = docs.mapInArrow(cut, T.StructType([*ids, T.StructField("byte", T.LongType()),
                                                  T.StructField("section", T.StringType())]))
    out = T.StructType([*ids, *_FRAGMENT.fields])
    row_schema = _arrow(_FRAGMENT.fields)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = get()
        for batch in batches:
            texts = batch.column("section").to_pylist()
            for k, (text, byte) in enumerate(zip(texts, batch.column("byte").to_pylist())):
                (a,), (b,), (fits,) = t.encode([text])
                rows = [{"fits": False, "seq": byte, "range": byte // range_bytes}]
                if fits:
                    every = tokens(t, a, b, byte)
                    rows = [{"fits": True, "seq": max(byte, r * range_bytes), "range": r} | fragment_row(t, every, x, y)
                            for r, x, y in range_slices(every, range_bytes)]
                made = pa.RecordBatch.from_pylist(rows, schema=row_schema)
                one = [pa.concat_arrays([batch.column(c).slice(k, 1)] * len(rows)) for c in ("uid", "doc_id")]
                yield pa.RecordBatch.from_arrays([*one, *made.columns], names=out.fieldNames())

    return materialize(sections.repartition("uid", "byte").mapInArrow(encode, out), "fragments")


_HEAD = "uid long, range long, seq long, cut boolean, pre_a array<long>, pre_b array<long>, suf_a array<long>, suf_b array<long>"
_JOINT = "joints array<struct<seq:long,a:array<long>,b:array<long>>>"


def reduce_fragments(found: DataFrame) -> DataFrame:
    """(uid, seq, a, b): the groups that composition closes, each placed before the
    fragment that closed it. One Spark round composes eight neighbours."""
    heads = found.select("uid", "range", "seq", "cut", "pre_a", "pre_b", "suf_a", "suf_b")
    last = heads.agg(F.max("range")).first()[0] or 0

    def fold(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["seq"])
        whole, joints = Fragment(), []
        for r in rows:
            one = Fragment((tuple(r["pre_a"]), tuple(r["pre_b"])), (), (tuple(r["suf_a"]), tuple(r["suf_b"])), r["cut"])
            whole = compose(whole, one)
            joints += [{"seq": r["seq"], "a": list(a), "b": list(b)} for a, b in whole.closed]
            whole = Fragment(whole.prefix, (), whole.suffix, whole.cut)      # closed groups stay here
        head = {"uid": rows[0]["uid"], "range": rows[0]["range"] >> FAN_IN_BITS, "seq": rows[0]["seq"],
                "cut": whole.cut, "pre_a": whole.prefix[0], "pre_b": whole.prefix[1], "suf_a": whole.suffix[0],
                "suf_b": whole.suffix[1], "joints": joints}
        return pa.Table.from_pylist([head], schema=target)

    schema = T.StructType.fromDDL(f"{_HEAD}, {_JOINT}")
    target, closed = _arrow(schema.fields), []
    while True:
        up = F.shiftright("range", FAN_IN_BITS).alias("up")
        done = materialize(heads.groupBy("uid", up).applyInArrow(fold, schema), "composed")
        closed.append(done.select("uid", F.inline("joints")))
        heads, last = done.drop("joints"), last >> FAN_IN_BITS
        if not last:
            break
    first = heads.select("uid", F.lit(-1).cast("long").alias("seq"), F.col("pre_a").alias("a"), F.col("pre_b").alias("b"))
    return functools.reduce(DataFrame.unionByName, closed, first)


def long_pieces(found: DataFrame, n_b: int) -> DataFrame:
    """(uid, seq, n_groups, groups, pairs, times) of the documents whose fragments all fit."""
    fit = found.groupBy("uid").agg(F.min("fits").alias("fits")).filter("fits").select("uid")
    found = found.join(fit, "uid", "left_semi")
    joints = reduce_fragments(found)
    def ids(name: str):
        return F.array_join(F.col(name).cast("array<string>"), ",")
    pair = F.element_at("a", -1) * n_b + F.element_at("b", -1)
    one = F.array(F.lit(1).cast("long"))
    closed = found.filter("n_groups > 0").select("uid", (2 * F.col("seq") + 1).alias("seq"), "n_groups", "groups",
                                                 "pairs", "times")
    return closed.unionByName(joints.select(
        "uid", (2 * F.col("seq")).alias("seq"), F.lit(1).cast("long").alias("n_groups"),
        F.concat(ids("a"), F.lit("|"), ids("b")).alias("groups"), F.array(pair).alias("pairs"), one.alias("times")))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """(uid, groups_sha256): the hash of a document's pieces joined by ``;``, taken
    piece by piece in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        def answer() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"uid": pa.array([now], pa.int64()), "groups_sha256": [sha.hexdigest()]})
        for batch in batches:
            for uid, groups in zip(batch.column("uid").to_pylist(), batch.column("groups").to_pylist()):
                if uid != now:
                    if sha:
                        yield answer()
                    now, sha = uid, hashlib.sha256(groups.encode())
                else:
                    sha.update(b";" + groups.encode())
        if sha:
            yield answer()
    rows = pieces.select("uid", "seq", "groups").repartition("uid").sortWithinPartitions("uid", "seq")
    return rows.mapInArrow(run, "uid long, groups_sha256 string")


# --- counts over all documents -----------------------------------------------------------

def pair_counts(links: DataFrame, n_b: int) -> DataFrame:
    """(pair, count, best): links by pair of ids over all rows (pairs, times), and
    whether no other pair of the same id of b has more."""
    counts = links.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy(F.col("pairs").alias("pair")).agg(
        F.sum("times").alias("count"))
    counts = materialize(counts, "pair-counts")
    most = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("count").alias("most"))
    return (counts.withColumn("b", F.col("pair") % n_b).join(F.broadcast(most), "b")     # at most n_b rows
            .select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


def link_scores(links: DataFrame, counts: DataFrame, pair_block: int = PAIR_BLOCK) -> DataFrame:
    """(uid, n_links, n_best, count_sum): each block of the counts is broadcast to all
    links; what the blocks give is added up."""
    counts = materialize(counts, "pairs")
    blocks = -(-counts.count() // pair_block) or 1
    every = []
    for k in range(blocks):
        block = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k) if blocks > 1 else counts
        found = links.select("uid", F.inline(F.arrays_zip("pairs", "times"))).join(
            F.broadcast(block), F.col("pairs") == F.col("pair"))
        every.append(found.groupBy("uid").agg(
            F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum")))
    return functools.reduce(DataFrame.unionByName, every).groupBy("uid").agg(
        *[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")])


# --- results -------------------------------------------------------------------------------

def split_long(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               long_bytes: int = LONG_BYTES) -> tuple[DataFrame, DataFrame]:
    """Short and long documents as (uid, doc_id, text); uids are even and odd."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.octet_length("text") > long_bytes, F.lit(False))
    short, long = rows.filter(~is_long), rows.filter(is_long)
    uid = 2 * F.monotonically_increasing_id()
    return short.select(uid.alias("uid"), "*"), long.select((uid + 1).alias("uid"), "*")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL,
          piece_model: str = PIECE_MODEL, long_bytes: int = LONG_BYTES, section_chars: int = SECTION_CHARS,
          range_bytes: int = RANGE_BYTES, pair_block: int = PAIR_BLOCK) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    get = load(docs.sparkSession, byte_model, piece_model)
    n_b = get().n_b
    short, long = split_long(docs, id_col, text_col, long_bytes)
    aligned = short_pieces(short, get)
    sha = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    small = materialize(aligned.select("uid", "doc_id", "n_a", "n_b", "n_groups", sha.alias("groups_sha256"),
                                       "pairs", "times"), "aligned")
    found = fragments(long, get, section_chars, range_bytes)
    pieces = materialize(long_pieces(found, n_b), "pieces")
    totals = found.groupBy("uid", "doc_id").agg(
        F.min("fits").alias("fits"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    many = pieces.groupBy("uid").agg(F.sum("n_groups").alias("n_groups"))
    big = totals.join(many, "uid", "left").join(piece_digests(pieces), "uid", "left")
    rows = small.drop("pairs", "times").unionByName(big.select(
        "uid", "doc_id", *[F.when(F.col("fits"), F.col(c)).otherwise(0).alias(c) for c in ("n_a", "n_b")],
        F.coalesce("n_groups", F.lit(0)).alias("n_groups"), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))
    links = small.select("uid", "pairs", "times").unionByName(pieces.select("uid", "pairs", "times"))
    scores = link_scores(links, pair_counts(links, n_b), pair_block)
    return rows.join(scores, "uid", "left").select(
        F.col("doc_id").alias(id_col), "n_a", "n_b", "n_groups",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_best", "count_sum")], "groups_sha256")
