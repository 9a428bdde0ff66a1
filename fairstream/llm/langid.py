"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of slices of labelled
texts. Case, digits and signs say little, so both sides are lower-cased and what
stands between words becomes one space. A text is encoded with every dictionary, piece by piece; the language
whose dictionary gives the fewest bytes wins. A narrow margin is rejected.

The dictionaries come from a bounded sample: at most ``sample_rows`` slices of
``slice_chars`` characters for each language, drawn by a hash of the text over
all distinct labelled texts, so copies take no other text's place. Every text is
then classified whole, map-only.

Defined results: a null text or one without a letter is ``und`` with score 0 and
rejected; equal sizes go to the language that sorts first; without any labelled
text every row is ``und``; with a single language the score is its gain over no
dictionary; input columns with the name of a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.llm.shared import add_arrow_columns, free_name, materialize

SAMPLE_ROWS = 256
SLICE_CHARS = 512
#: Dictionaries of one pass: 128 of up to half a megabyte each.
PASS_LANGUAGES = 128
#: Languages up to which the draw limits are broadcast; more are joined by a shuffle.
BROADCAST_LANGUAGES = 100_000
PIECE_BYTES = 4096
LEVEL = 9
MIN_MARGIN = 0.005
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_RANGE = 1 << 30

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("rejected", T.BooleanType())]


def normal(text: str) -> bytes:
    """Lower-case letters; everything between words is one space."""
    return f" {_OTHER.sub(' ', text.lower())} ".encode()


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """``lang, slices``: the slices of each language's dictionary, in order, from rows
    with a text and a language; a table in the shared folder."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    rows = rows.withColumn("_text", F.xxhash64("text"))
    distinct = rows.groupBy("lang", "_text").agg(F.lit(1)).groupBy("lang").agg(F.count("*").alias("n"))
    # Twice the sample is expected below the limit: copies are counted once and drawn together.
    share = F.expr(f"{2 * sample_rows * _RANGE}L div n")
    limits = materialize(distinct.select("lang", F.least(F.lit(_RANGE).cast("long"), share).alias("limit")),
                         "language-limits")
    side = F.broadcast(limits) if limits.count() <= BROADCAST_LANGUAGES else limits
    drawn = rows.withColumn("h", F.pmod("_text", F.lit(_RANGE))).join(side, "lang").filter("h < limit")
    room = F.greatest(F.char_length("text") - slice_chars, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("h", F.lit(1)), room).cast("int") + 1
    slices = drawn.groupBy("lang", "h", F.substr("text", start, F.lit(slice_chars)).alias("slice")).agg(F.lit(1))
    by_lang = slices.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("h", "slice"))).alias("s"))
    return materialize(by_lang.select("lang", F.slice(F.col("s")["slice"], 1, sample_rows).alias("slices")),
                       "dictionaries")


def contents(dictionaries: DataFrame, first: str | None = None, last: str | None = None) -> dict[str, bytes]:
    """The raw contents of the dictionaries from ``first`` to ``last``."""
    some = dictionaries if first is None else dictionaries.filter(F.col("lang").between(first, last))
    return {r["lang"]: b"".join(map(normal, r["slices"])) for r in some.collect()}


class Classifier:
    """The compressors of all languages, one task's worth."""

    def __init__(self, dictionaries: dict[str, bytes], only: bool | None = None):
        self.only = len(dictionaries) == 1 if only is None else only
        self.compress = []
        for lang, content in sorted(dictionaries.items()):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compress.append((lang, self._compressor(d)))
        if self.only:
            self.compress.append((UNKNOWN, self._compressor(None)))

    @staticmethod
    def _compressor(d: zstandard.ZstdCompressionDict | None) -> Callable[[bytes], bytes]:
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                        write_checksum=False, write_dict_id=False).compress

    def sizes(self, text: str | None) -> list[tuple[int, str]]:
        """The two smallest sizes of the text with their languages, smallest first;
        none for a text without a letter."""
        if not text or not self.compress or not _LETTER.search(text):
            return []
        data = normal(text)
        pieces = [data[i:i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        return sorted((sum(len(f(p)) for p in pieces), lang) for lang, f in self.compress)[:2]

    def predict(self, text: str | None) -> tuple[str, float]:
        return verdict(self.sizes(text), self.only)


def verdict(sizes: list[tuple[int, str]], only: bool = False) -> tuple[str, float]:
    """The language and its margin: the share that the runner-up needs beyond it. The
    only language there is runs against no dictionary."""
    if not sizes:
        return UNKNOWN, 0.0
    if only:
        by = {name: size for size, name in sizes}
        lang = next(name for name in by if name != UNKNOWN)
        return lang, max(0.0, 1 - by[lang] / by[UNKNOWN])
    return sizes[0][1], 1 - sizes[0][0] / sizes[1][0]


_SIZES = T.StructField("sizes", T.ArrayType(T.StructType([
    T.StructField("size", T.LongType()), T.StructField("lang", T.StringType())])))


def classify(docs: DataFrame, dictionaries: DataFrame, text_col: str = "text",
             min_margin: float = MIN_MARGIN, pass_languages: int = PASS_LANGUAGES) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` and ``rejected`` (margin too narrow)."""
    langs = sorted(r["lang"] for r in dictionaries.select("lang").collect())        # names only
    blocks = [langs[i:i + pass_languages] for i in range(0, len(langs), pass_languages)] or [[]]
    names = docs.columns
    carried = free_name("sizes", names)
    found = docs
    for k, block in enumerate(blocks):
        some = contents(dictionaries, block[0], block[-1]) if block else {}
        shared = docs.sparkSession.sparkContext.broadcast(some)
        last = k == len(blocks) - 1
        found = add_arrow_columns(
            found, FIELDS if last else [T.StructField(carried, _SIZES.dataType)],
            _one_pass(shared, text_col, carried if k else None, last, len(langs) == 1, min_margin),
            drop=(carried,) if last and k else ())
    return found


def _one_pass(shared: Broadcast, text_col: str, carried: str | None, last: bool, only: bool,
              min_margin: float) -> Callable[[], Callable[[pa.RecordBatch], list]]:
    def make() -> Callable[[pa.RecordBatch], list]:
        classifier = Classifier(shared.value, only)

        def work(batch: pa.RecordBatch) -> list:
            best = [classifier.sizes(t) for t in batch.column(text_col).to_pylist()]
            if carried:
                before = batch.column(carried).to_pylist()
                best = [sorted(x + [(s["size"], s["lang"]) for s in y])[:2] for x, y in zip(best, before, strict=True)]
            if not last:
                return [[[{"size": n, "lang": lang} for n, lang in x] for x in best]]
            out = [verdict(x, only) for x in best]
            return [[x for x, _ in out], [s for _, s in out], [x == UNKNOWN or s < min_margin for x, s in out]]
        return work
    return make
