"""Quality rules: repetition counts and divergence from language references.

Base rules fail a text of too few words or with too many words in repeated
five-word windows.  The method's own rule compares two histograms of a text
with those of each reference language by Jensen-Shannon distance (square root
of the divergence to base 2, 0 to 1): its character classes, and the common
words of the configured languages against all other words.  A text is kept
when it is near enough to some language in both; texts below a length guard
are not judged by the histogram they are too short for.

References are the median shares per language over all texts of the table with
enough words: each text counts once, so one huge text cannot shape them,
and junk below half of a language's texts cannot either.  At most one row per
configured language reaches the driver.  Shares are counted in
thousandths, so the medians are exact and the same on any partitioning.  The
histograms are judged only for texts labelled with a configured language or
with none, since other languages have no reference, and texts without a label
whose characters are mostly letters beyond ASCII are of another script.

Every per-text step is a row-local expression: no shuffle, no Python.

Defined cases: null text has no words (fails the base rules); blank lines are
never duplicates; null, unknown and missing languages see above; a very long
text is counted whole in its own row; repeated rows each return a row; extra
columns stay untouched; an empty table stays empty,
and a language without texts has no reference (with none at all, only the base
rules decide).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, small_side, split_words, text_key, text_of

# The most frequent function words of each language, lower case.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los"],
}
SYMBOLS = "[#*$%&|<>]"
# Character classes, counted in this order by removing them one after another; what is left is the last class.
CHAR_CLASSES = {"lower": "[a-z]+", "space": r"[\x20\x09-\x0D]+", "accented": r"[^\x00-\x7F]+", "stop": "[.,;:'\"()?-]+",
                "upper": "[A-Z]+", "digit": "[0-9]+"}


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    window: int = 5
    max_repeat_share: int = 20         # per cent of words in repeated windows
    char_min: int = 400                # length guard: characters a text needs to be judged by its classes alone
    char_distance: float = 0.30        # farther than this from every language: rejected
    word_min: int = 100                # length guard of the word histogram
    word_distance: float = 0.45        # farther than this from every language: rejected
    both_char: float = 0.18            # moderately far in both histograms: rejected
    both_word: float = 0.19
    common_words: dict = field(default_factory=lambda: COMMON_WORDS)


# --- counts ------------------------------------------------------------------------

def _let(value: Column, body) -> Column:
    """``body`` of ``value``, with the value computed once: as a lambda's
    variable the optimizer cannot copy it into every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _window_hashes(hashes: Column, window: int) -> Column:
    """Hash of every run of ``window`` neighbours, by doubling: runs of 1, 2,
    4 ... combine, and a remainder is added from its own runs."""
    def combine(a, b, shift):
        return F.zip_with(a, F.slice(b, shift + 1, F.greatest(F.size(b) - shift, F.lit(0))),
                          lambda x, y: F.xxhash64(x, y))

    def cut(runs, h):
        n = F.size(h) - (window - 1)
        return F.when(n > 0, F.slice(runs, 1, F.greatest(n, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))

    def grow(runs, have, h):
        if have == window:
            return cut(runs, h)
        if 2 * have <= window:
            return _let(combine(runs, runs, have), lambda r: grow(r, 2 * have, h))
        return _let(combine(runs, h, have), lambda r: grow(r, have + 1, h))

    return _let(hashes, lambda h: grow(h, 1, h))


def _covered(windows: Column, window: int) -> Column:
    """Positions covered by windows that occur twice or more: sorting brings
    equal windows together, their starts in order give the covered length."""
    def starts(s):
        return F.array_sort(F.transform(F.filter(
            s, lambda x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"])),
            lambda x: x["i"]))

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("end"))
    return F.aggregate(_let(ordered, starts), zero, lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(window), p + window - acc["end"])).alias("n"), (p + window).alias("end")),
        lambda acc: acc["n"])


def _vocabulary(rules: Rules) -> list[str]:
    return sorted({w for ws in rules.common_words.values() for w in ws})


def _common_counts(words: Column, vocabulary: list[str]) -> Column:
    """How often each word of ``vocabulary`` occurs, in its order, counted by
    removing it from the text's common words."""
    hits = F.concat(F.lit(" "), F.array_join(F.filter(words, lambda w: w.isin(vocabulary)), "  "), F.lit(" "))
    return _let(hits, lambda s: F.array(*[
        ((F.length(s) - F.length(F.replace(s, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)) for w in vocabulary]))


def _char_counts(text: Column) -> Column:
    """Struct of the class counts and the characters left over."""
    start = F.struct(text.alias("rest"), F.array().cast("array<double>").alias("n"))

    def remove(acc, pattern):
        return _let(F.regexp_replace(acc["rest"], pattern, F.lit("")), lambda rest: F.struct(
            rest.alias("rest"),
            F.concat(acc["n"], F.array((F.length(acc["rest"]) - F.length(rest)).cast("double"))).alias("n")))

    return F.aggregate(F.array(*[F.lit(p) for p in CHAR_CLASSES.values()]), start, remove)


def _with_histograms(docs: DataFrame, rules: Rules, text_col: str) -> DataFrame:
    """``docs`` plus the words and the histograms they and the characters give."""
    df = docs.withColumn("__words", split_words(F.col(text_col)))
    df = df.withColumn("__chars", _char_counts(text_of(F.col(text_col))))
    return (df.withColumn("__n", F.size("__words").cast("long"))
            .withColumn("__c", _shares(F.col("__chars.n"), F.length(text_of(F.col(text_col))).cast("double")))
            .withColumn("__w", _shares(_common_counts(F.col("__words"), _vocabulary(rules)),
                                       F.size("__words").cast("double"))))


def _with_counts(docs: DataFrame, rules: Rules, text_col: str) -> DataFrame:
    """The histograms plus one struct column ``__q`` of n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = text_of(F.col(text_col))
    df = _with_histograms(docs, rules, text_col)
    df = df.withColumn("__windows", _window_hashes(F.transform("__words", lambda w: F.xxhash64(w)), rules.window))
    # only texts where a window repeats are sorted
    df = df.withColumn("__repeat", F.when(F.size("__windows") > F.size(F.array_distinct("__windows")),
                                          _covered(F.col("__windows"), rules.window)).otherwise(0).cast("long"))
    lines = F.filter(F.split(text, "\n", -1), lambda s: F.length(F.btrim(s, F.lit(" \t\n\x0b\f\r"))) > 0)
    n, repeat, rest = F.col("__n"), F.col("__repeat"), F.col("__chars.rest")
    space = F.col("__chars.n")[list(CHAR_CLASSES).index("space")].cast("long")
    return df.withColumn("__len", F.length(text)).withColumn("__q", F.struct(
        n.alias("n_words"), (F.length(text) - space).cast("long").alias("word_chars"),
        (F.length(rest) - F.length(F.regexp_replace(rest, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        ((n < rules.min_words) | (100 * repeat > rules.max_repeat_share * n)).alias("base_failed")))


def _shares(counts: Column, total: Column) -> Column:
    """Histogram of counts and the rest, as shares; null for an empty text."""
    rest = total - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.transform(F.concat(counts, F.array(rest)), lambda x: x / total))


# --- references --------------------------------------------------------------------

def references(histograms: DataFrame, rules: Rules = Rules()) -> dict[str, tuple[list[float], list[float]]]:
    """Median (character, word) histogram per configured language over all its
    texts of at least ``min_words`` words, scaled to add up to one.
    ``histograms``: columns __lang, __n, __c, __w."""
    df = (histograms.filter(F.col("__lang").isin(sorted(rules.common_words)) & (F.col("__n") >= rules.min_words))
          .select(F.col("__lang").alias("lang"), F.col("__c").alias("c"), F.col("__w").alias("w")))
    n_c, n_w = len(CHAR_CLASSES) + 1, len(_vocabulary(rules)) + 1

    def middle(col: str, n: int) -> Column:
        return F.array(*[F.percentile(F.round(F.col(col)[i], 3), 0.5) for i in range(n)]).alias(col)

    rows = df.groupBy("lang").agg(middle("c", n_c), middle("w", n_w)).collect()     # one row per language

    def whole(shares) -> list[float]:
        total = sum(x or 0.0 for x in shares)
        return [(x or 0.0) / total for x in shares] if total else []

    refs = {r["lang"]: (whole(r["c"]), whole(r["w"])) for r in rows}
    return {k: v for k, v in refs.items() if v[0] and v[1]}


def _js_distance(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance between two histograms, base 2."""
    def part(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(shares, F.array(*[F.lit(float(x)) for x in reference]), lambda p, q: (
        part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def _judge(df: DataFrame, refs: dict[str, tuple[list[float], list[float]]], rules: Rules) -> DataFrame:
    """Adds ``__v`` to the counts: struct of char_distance, word_distance (null
    when not judged) and kept."""
    nothing = F.lit(None).cast("double")
    if refs:
        least = F.least if len(refs) > 1 else (lambda x: x)
        foreign = F.coalesce(F.col("__c")[list(CHAR_CLASSES).index("accented")] > 0.5, F.lit(False))
        labelled = F.col("__lang").isin(sorted(rules.common_words)) | F.col("__lang").isNull() & ~foreign
        char = F.when(F.col("__c").isNotNull() & labelled, least(*[_js_distance(F.col("__c"), c) for c, _ in refs.values()]))
        word = F.when((F.col("__n") >= rules.word_min) & labelled,
                      least(*[_js_distance(F.col("__w"), w) for _, w in refs.values()]))
    else:
        char = word = nothing
    df = df.withColumn("__d", F.struct(char.alias("c"), word.alias("w")))
    c, w = F.col("__d.c"), F.col("__d.w")
    far = (((F.col("__len") >= rules.char_min) & (c > rules.char_distance))
           | (w > rules.word_distance) | ((c > rules.both_char) & (w > rules.both_word)))
    return df.withColumn("__v", F.struct(c.alias("char_distance"), w.alias("word_distance"),
                                         (~F.col("__q.base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept")))


def quality_report(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> DataFrame:
    """Counts, distances and verdict per row.  The counts of each text are
    stored once and serve both the references and the verdicts."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"),
                      F.col(lang_col).alias("__lang"))
    counts = materialise(_with_counts(src, rules, "__text").select("doc_id", "__lang", "__len", "__n", "__c", "__w",
                                                                  "__q"), "quality-counts")
    out = _judge(counts, references(counts, rules), rules)
    return out.select("doc_id", *[f"__q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                       "n_repeat_words", "base_failed")],
                      "__v.char_distance", "__v.word_distance", "__v.kept")


def keep_good(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang") -> DataFrame:
    """Rows of ``docs`` the rules keep, columns as they came.  The counts are
    stored by (id, text, language) once, and the rejected keys leave ``docs`` by an
    anti join; as a filter, the optimizer would copy the counting expressions."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"),
                      F.col(lang_col).alias("__lang"))
    counts = materialise(_with_counts(src, rules, "__text").select(
        "doc_id", text_key(F.col("__text")).alias("__tk"), "__lang", "__len", "__n", "__c", "__w", "__q"),
        "quality-counts")
    verdicts = materialise(_judge(counts, references(counts, rules), rules)
                           .select("doc_id", "__tk", "__lang", F.col("__v.kept").alias("kept")), "quality-verdicts")
    gone = (verdicts.filter(~F.col("kept")).select(F.col("doc_id").alias("__gid"), F.col("__tk").alias("__gtk"),
                                                   F.col("__lang").alias("__glang")).distinct())
    gone = small_side(materialise(gone, "quality-rejected"))
    return docs.join(gone, docs[id_col].eqNullSafe(gone["__gid"]) & (text_key(docs[text_col]) == gone["__gtk"])
                     & docs[lang_col].eqNullSafe(gone["__glang"]), "left_anti")
