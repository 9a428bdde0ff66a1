"""Quality rules: a threshold table compiled into one Spark projection.

Only DataFrame functions: text -> word, line and window arrays -> counts ->
ratios -> verdict, all map-only. Defined results: a null or empty text has no
words, so it fails the base rule and is rejected; repeated rows are judged
each on their own; very long texts are measured whole; an empty table gives no
rows; input columns with the name of a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairstream.llm.shared import SPACE_CHARS, SPACE_CLASS, Renamed, column, drop_clashing

# Common function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "on", "it", "as", "by", "are", "this",
    "be", "or", "at", "from", "was",
    "le", "la", "les", "des", "et", "que", "qui", "un", "une", "en", "du", "pour", "par", "dans", "est",
    "de", "sur", "au", "avec",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "im", "ein", "eine", "sich", "nicht",
    "auf", "dem",
    "el", "los", "las", "y", "por", "con", "para", "se", "del", "su", "una", "como",
)
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * part / whole <= high`` (no bound: None); a whole of 0 passes."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def broken(self) -> Column:
        """Integer arithmetic, so every engine gives the same verdict."""
        part, whole = F.col(self.part) * 1000, F.col(self.whole)
        out = F.lit(False)
        if self.low is not None:
            out = out | (part < whole * self.low)
        if self.high is not None:
            out = out | (part > whole * self.high)
        return out


#: The threshold table: lengths, symbols, stop words, lines.
RULES = (
    Rule("mean_word_chars", "word_chars", "n_words", low=2000, high=15000),
    Rule("symbols_per_word", "n_symbols", "n_words", high=250),
    Rule("exclamations_per_word", "n_exclamations", "n_words", high=500),
    Rule("stop_words", "n_stop_words", "n_words", low=20),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=500),
)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_stop_words", "n_exclamations", "n_lines"]


def _repeat_words(n: Column) -> Column:
    """Words inside windows that occur twice or more, from the window positions
    of such windows in ascending order: each adds its distance to the next one,
    at most a whole window."""
    p = F.col("_at")
    steps = F.zip_with(
        p, F.concat(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.array(F.array_max(p) + WINDOW)),
        lambda a, b: F.least(b - a, F.lit(WINDOW)))
    total = F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)
    return F.when(F.size(p) > 0, total).otherwise(0)


def measure(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` plus the columns of ``MEASURES`` (long)."""
    inside = Renamed(df)
    return inside.back(_measured(inside.df, inside.of(text_col)), MEASURES)


def _measured(df: DataFrame, text_col: str) -> DataFrame:
    t = F.coalesce(F.col(text_col), F.lit(""))
    body = F.btrim(t, F.lit(SPACE_CHARS))
    none = F.array().cast("array<string>")
    with_words = df.select(
        "*",
        F.when(body == "", none).otherwise(F.split(body, SPACE_CLASS + "+")).alias("_words"),
        F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "").alias("_lines"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(t, F.lit("!")).cast("long").alias("n_exclamations"),
    )
    w = F.col("_words")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.xxhash64(*[w.getItem(i + k) for k in range(WINDOW)]))
    with_windows = with_words.select(
        "*",
        F.when(F.size(w) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("_grams"),
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    ).drop("_words", "_lines")
    g = F.col("_grams")
    ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    with_order = with_windows.select(       # most texts repeat no window: they skip the sort
        "*", F.when(F.size(F.array_distinct(g)) < F.size(g), ordered).alias("_sorted")).drop("_grams")
    s = F.col("_sorted")
    twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    at = with_order.select(
        "*", F.coalesce(F.sort_array(F.transform(twice, lambda x: x["i"])),
                        F.array().cast("array<int>")).alias("_at")).drop("_sorted")
    # Always true, but not deterministic: a filter on the verdict stays above this projection.
    # Pushed below it, the filter would compute every array anew for each use of a measure.
    here = F.monotonically_increasing_id() >= 0
    return at.withColumn("n_repeat_words", F.when(here, _repeat_words(F.col("_at")).cast("long"))).drop("_at")


def judge(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` plus the measures, ``base_failed``, ``rejected_by`` (the names of
    the broken rules) and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules],
                                     F.lit(None).cast("string")))
    clean = drop_clashing(df, ["base_failed", "rejected_by", "kept"])
    return measure(clean, text_col).select(
        "*", base.alias("base_failed"), broken.alias("rejected_by"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that pass every rule, with the columns of ``df`` only."""
    packed = df.select(F.struct(*map(column, df.columns)).alias("_row"), column(text_col).alias("_text"))
    return judge(packed, "_text").filter("kept").select("_row.*")
