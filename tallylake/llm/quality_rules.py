"""Heuristic quality rules: a table of thresholds compiled into one projection of built-in functions."""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from tallylake.llm.arrow_columns import spare_prefix, without

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5
# Frequent function words of the languages that the stop-word rule knows (English, French, Spanish, German).
STOP_WORDS = ("the of and to in is a that for it as was with be by on not he this are or his from at which but have an "
              "de la le les et des en un une du que el los las y der die und das ist von zu den mit").split()


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= measure <= high; documents of fewer words than least_words are not judged by it."""

    measure: str
    low: float | None = None
    high: float | None = None
    least_words: int = 0


#: Production thresholds.
RULES = (
    Rule("n_words", low=10),
    Rule("repeat_word_pct", high=20),
    Rule("mean_word_length", low=2, high=20),
    Rule("symbol_pct", high=10),
    Rule("dup_line_pct", high=90),
    Rule("long_word_pct", high=30),
    # Running text has function words; titles and short lists needn't. Texts in other languages fail as well.
    Rule("stop_word_pct", low=1, least_words=20),
)


def _split(text):
    """Words of a text: runs of anything but the six ASCII spaces."""
    return F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def _repeat_windows(words, n):
    """Windows of REPEAT_WINDOW words, by content, then place: equal ones are neighbours."""
    size = REPEAT_WINDOW
    windows = F.transform(
        F.sequence(F.lit(0), F.col(n) - size),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + j) for j in range(size)]).alias("h"), i.alias("i")),
    )
    return F.when(F.col(n) >= size, F.sort_array(windows))


def _repeated_places(windows):
    """Places of the windows that a neighbour equals, in order."""
    twin = lambda x, k: F.coalesce(F.get(F.col(windows), k)["h"] == x["h"], F.lit(False))
    kept = F.filter(windows, lambda x, k: twin(x, k - 1) | twin(x, k + 1))
    return F.sort_array(F.transform(kept, lambda x: x["i"]))


def _covered(places):
    """Words in the windows at some places: each covers its words up to the next window's."""
    size = REPEAT_WINDOW
    ends = F.transform(
        places, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(F.col(places), k + 1) - p, F.lit(size)))
    )
    return F.coalesce(F.aggregate(ends, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))


def measures(docs, text="text"):
    """docs with the counts and ratios that rules may name; null and empty texts have 0 of everything.

    Counts: n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines, n_repeat_words, n_stop_words,
    n_long_words. Ratios: mean_word_length, symbol_pct (of word characters), dup_line_pct, repeat_word_pct,
    stop_word_pct, long_word_pct.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words",
             "n_long_words", "mean_word_length", "symbol_pct", "dup_line_pct", "repeat_word_pct", "stop_word_pct",
             "long_word_pct"]
    kept = without(docs, names)
    prefix = spare_prefix(docs)
    own = [prefix + name for name in ("text", "words", "lines", "n", "windows", "places")]
    given, words, lines, n, windows, places = own
    body = F.coalesce(F.col(given), F.lit(""))
    spaceless = F.translate(body, SPACES, "")
    has_word = lambda line: F.translate(line, SPACES, "") != ""
    pct = lambda part, whole: F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))
    c = F.col
    return (
        docs.select(*kept, F.col(f"`{text}`").alias(given))
        .withColumns({words: _split(body), lines: F.filter(F.split(body, "\n", -1), has_word)})
        .withColumn(n, F.size(words))
        .withColumn(windows, _repeat_windows(words, n))
        .withColumn(places, _repeated_places(windows))
        .withColumns({
            "n_words": c(n).cast("long"),
            "word_chars": F.length(spaceless).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": _covered(places),
            "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
            "n_long_words": F.size(F.filter(words, lambda w: F.length(w) > 40)).cast("long"),
        })
        .withColumns({
            "mean_word_length": F.when(c("n_words") > 0, c("word_chars") / c("n_words")).otherwise(F.lit(0.0)),
            "symbol_pct": pct(c("n_symbols"), c("word_chars")),
            "dup_line_pct": pct(c("n_dup_lines"), c("n_lines")),
            "repeat_word_pct": pct(c("n_repeat_words"), c("n_words")),
            "stop_word_pct": pct(c("n_stop_words"), c("n_words")),
            "long_word_pct": pct(c("n_long_words"), c("n_words")),
        })
        .drop(*own)
    )


def compile_rules(rules):
    """One boolean column: every rule holds."""
    def holds(rule):
        value = F.col(rule.measure)
        bounds = [value >= rule.low] if rule.low is not None else []
        bounds += [value <= rule.high] if rule.high is not None else []
        return reduce(and_, bounds, F.lit(True)) | (F.col("n_words") < rule.least_words)

    return reduce(and_, [holds(r) for r in rules], F.lit(True))


def judge(docs, rules=RULES, text="text"):
    """docs with their measures, base_failed (fewer than 10 words, or over 20 % of them in repeated windows) and kept
    (not base_failed, and all rules hold).

    Evaluated by built-in functions alone, row by row: repeated rows, ties and extra columns change nothing (columns
    that bear a new name are replaced), an empty table gives an empty table. Null and empty texts fail. Very
    long texts are measured whole.
    """
    measured = measures(docs.select(*without(docs, ["base_failed", "kept"])), text)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
