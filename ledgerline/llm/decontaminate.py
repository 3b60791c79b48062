"""Benchmark decontamination over a distributed positional inverted index.

The index stores postings (document, position, term) of the training text.  A
term is a run of up to three words, ``gram``; a phrase of L words is then
L - gram + 1 terms on consecutive positions.  Only terms that some benchmark
item holds are stored: all others cannot take part in an answer.

*Phrases.*  The windows of all items are made distinct, so a passage that many
items share is searched once.  Per window the rarest term (fewest postings)
opens the search; a window with a term that has no posting is left out.  Its
postings, adjusted by the term's offset, are the candidates (document, start).
Only these are expanded: to the terms that cover the window, each looked up in
the postings at its (document, position).  A candidate whose terms all stand
there is an occurrence; windows lead to items at the end.

*Proximity.*  A document that holds at least ``share`` of an item's terms near
one another holds one of its rarest terms, as the others are too few: the
postings of these name the candidates (document, item), and only for them the
postings of the item's other terms are counted within bands of neighbouring
diagonals, so words put in or left out between them do not hide a match.

Words: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are
lower-cased.  Defined cases: null and wordless texts have no words and match
nothing; an item of fewer words than a window is one window of all its words;
a null item_id counts as the item named ''; rows that share an item_id are one
item that occurs when any of them does; rows with equal id and text return
equal results; ids may be null or repeat with other texts; a very long text is
a row of more positions, which spread over tasks; extra columns, whatever
their names, are ignored; empty tables give no matches.

Everything is DataFrame operations.  Frames over the benchmark alone are
broadcast only when their stored bytes are few; else the join shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, materialise, small_side, split_words, text_key, text_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 3


def match_words(text: Column) -> Column:
    return split_words(ascii_lower(text_of(text)), SEPARATORS)


@dataclass
class PositionalIndex:
    """Postings of the training text for the terms of one benchmark."""

    postings: DataFrame      # doc_id, text_key, pos, term
    counts: DataFrame        # term, n_postings
    occurrences: DataFrame   # item_text, ip, term, gram, n_terms: the terms of each different item text
    windows: DataFrame       # wid, gram, length, off, term: the terms of each different window
    placed: DataFrame        # wid, item_text, ws: where the windows stand
    items: DataFrame         # item, item_text


def _run(words: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, at, n), " ")


def _benchmark(benchmark: DataFrame, window: int, gram: int, item_col: str, text_col: str) -> tuple[DataFrame, ...]:
    """occurrences, windows, placed and items of the benchmark, stored."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                            match_words(F.col(text_col)).alias("words"))
    rows = rows.withColumn("n", F.size("words")).filter("n > 0").withColumn("item_text", F.xxhash64("words"))
    items = materialise(rows.select("item", "item_text").distinct(), "decon-items")
    texts = (rows.dropDuplicates(["item_text"]).drop("item").withColumn("gram", F.least(F.lit(gram), F.col("n")))
             .withColumn("n_terms", F.col("n") - F.col("gram") + 1).withColumn("length", F.least(F.lit(window), F.col("n"))))
    occurrences = (texts.withColumn("ip", F.explode(F.sequence(F.lit(0), F.col("n_terms") - 1)))
                   .select("item_text", "ip", _run(F.col("words"), F.col("ip") + 1, F.col("gram")).alias("term"), "gram",
                           "n_terms"))
    cut = (texts.withColumn("ws", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("length"))))
           .withColumn("w", F.slice("words", F.col("ws") + 1, F.col("length"))).withColumn("wid", F.xxhash64("w", "length")))
    cut = materialise(cut.select("wid", "item_text", "ws", "gram", "length", "w"), "decon-windows")
    windows = cut.dropDuplicates(["wid"]).withColumn(
        "off", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("gram"))))
    windows = windows.select("wid", "gram", "length", "off", _run(F.col("w"), F.col("off") + 1, F.col("gram")).alias("term"))
    return (materialise(occurrences, "decon-terms"), materialise(windows, "decon-window-terms"),
            cut.select("wid", "item_text", "ws"), items)


def build_index(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                item_text_col: str = "text") -> PositionalIndex:
    """Store the postings of ``docs`` for the terms of ``benchmark``."""
    occ, windows, placed, items = _benchmark(benchmark, window, gram, item_col, item_text_col)
    grams = [r[0] for r in occ.select("gram").distinct().collect()]          # at most `gram` values
    src = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                      match_words(F.col(text_col)).alias("words"))
    tokens = src.select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "word"))
    stored = None
    for g in sorted(grams):
        terms = materialise(
            occ.filter(F.col("gram") == g).select("term").distinct()
            .withColumn("term_words", F.split("term", " "))
            .select("term", F.xxhash64(*[F.get("term_words", F.lit(i)) for i in range(g)]).alias("h"),
                    *[F.get("term_words", F.lit(i)).alias(f"t{i}") for i in range(g)]), "decon-wanted")
        run = [F.col("word")] + [F.get("words", F.col("pos") + i) for i in range(1, g)]
        at = tokens.select("doc_id", "text_key", "pos", *[c.alias(f"w{i}") for i, c in enumerate(run)])
        # whole terms only; the hash is the join key, the words decide
        at = at.filter(F.col(f"w{g - 1}").isNotNull()).withColumn("wh", F.xxhash64(*[f"w{i}" for i in range(g)]))
        on = F.col("wh") == F.col("h")
        for i in range(g):
            on = on & (F.col(f"w{i}") == F.col(f"t{i}"))
        found = at.join(small_side(terms), on).select("doc_id", "text_key", "pos", "term")
        stored = found if stored is None else stored.unionByName(found)
    if stored is None:        # no benchmark words at all
        stored = (src.select("doc_id", "text_key", F.lit(0).alias("pos"), F.lit("").alias("term"))
                  .filter(F.lit(False)))
    postings = materialise(stored.distinct(), "decon-postings")
    counts = materialise(postings.groupBy("term").agg(F.count("*").alias("n_postings")), "decon-counts")
    return PositionalIndex(postings, counts, occ, windows, placed, items)


def _at(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``wanted`` (doc_id, text_key, pos, term, ...) with a posting."""
    key = ["doc_id", "text_key", "pos", "term"]
    p = postings.select(*[F.col(c).alias(f"p_{c}") for c in key])
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"p_{c}"))
    return wanted.join(p, same, "left_semi")


def window_matches(index: PositionalIndex) -> DataFrame:
    """Occurrences of windows: doc_id, text_key, start (word position), length,
    wid."""
    counted = index.windows.join(index.counts, "term", "left").withColumn("n", F.coalesce("n_postings", F.lit(0)))
    opener = materialise(counted.groupBy("wid", "length").agg(F.min(F.struct("n", "off", "term")).alias("o"))
                         .where("o.n > 0").select("wid", "length", "o.off", "o.term"), "decon-openers")
    candidates = (index.postings.join(small_side(opener), "term")
                  .select("doc_id", "text_key", "wid", "length", (F.col("pos") - F.col("off")).alias("start"))
                  .where("start >= 0"))
    # every gram-th term and the last one hold all words of the window
    covers = (F.col("off") % F.col("gram") == 0) | (F.col("off") == F.col("length") - F.col("gram"))
    cover = index.windows.where(covers)
    cover = materialise(cover.join(opener.select("wid"), "wid", "left_semi")
                        .select("wid", F.col("off").alias("c_off"), F.col("term").alias("c_term")), "decon-cover")
    sizes = cover.groupBy("wid").agg(F.count("*").alias("n_cover"))
    wanted = (candidates.join(small_side(cover), "wid")
              .select("doc_id", "text_key", "wid", "length", "start", (F.col("start") + F.col("c_off")).alias("pos"),
                      F.col("c_term").alias("term")))
    there = _at(index.postings, wanted).groupBy("doc_id", "text_key", "wid", "length", "start").agg(F.count("*").alias("n"))
    return there.join(sizes, "wid").where("n = n_cover").select("doc_id", "text_key", "start", "length", "wid")


def phrase_matches(index: PositionalIndex, found: DataFrame | None = None) -> DataFrame:
    """Exact phrases as maximal runs of an item's windows: doc_id, text_key,
    item_id (string), start, end (word positions, end excluded), item_start
    (word position in the item).  ``found``: the window matches, if known."""
    found = window_matches(index) if found is None else found
    here = found.join(small_side(index.placed), "wid").withColumn("delta", F.col("start") - F.col("ws"))
    diagonal = ["doc_id", "text_key", "item_text", "delta"]
    run = Window.partitionBy(*diagonal).orderBy("ws")          # at most the windows of one item text
    runs = (here.withColumn("run", F.col("ws") - F.row_number().over(run)).groupBy(*diagonal, "run")
            .agg(F.min("start").alias("first"), F.max(F.col("start") + F.col("length")).alias("end"),
                 F.min("ws").alias("item_start")))
    return runs.join(small_side(index.items), "item_text").select(
        "doc_id", "text_key", F.col("item").alias("item_id"), F.col("first").alias("start"), "end", "item_start")


def proximity_matches(index: PositionalIndex, slop: int = 5, share: float = 0.5) -> DataFrame:
    """Documents that hold at least ``share`` of an item's terms within a band
    of ``2 * slop`` diagonals: doc_id, text_key, item_id, start, n_terms,
    n_matched.  Two band grids half a band apart, so terms up to ``slop``
    diagonals from each other always share a band."""
    need = F.greatest(F.lit(1), F.ceil(F.col("n_terms") * share)).cast("int")
    ranked = (index.occurrences.join(index.counts, "term", "left").withColumn("n", F.coalesce("n_postings", F.lit(0)))
              .withColumn("place", F.row_number().over(Window.partitionBy("item_text").orderBy("n", "ip"))))
    # `need` terms cannot all be among the need - 1 most frequent: the others open the search
    opener = materialise(ranked.where((F.col("place") <= F.col("n_terms") - need + 1) & (F.col("n") > 0))
                         .select("term", "item_text").distinct(), "decon-near-openers")
    candidates = (index.postings.join(small_side(opener), "term").select("doc_id", "text_key", "item_text").distinct())
    on = (candidates.join(small_side(index.occurrences), "item_text")
          .select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "item_text", "ip", "n_terms",
                  F.col("term").alias("c_term")))
    same = ((F.col("text_key") == F.col("c_key")) & (F.col("term") == F.col("c_term"))
            & F.col("doc_id").eqNullSafe(F.col("c_id")))
    on = index.postings.join(on, same).withColumn("delta", F.col("pos") - F.col("ip"))
    band = F.array(F.struct(F.lit(0).alias("grid"), F.floor(F.col("delta") / (2 * slop)).alias("band")),
                   F.struct(F.lit(1).alias("grid"), F.floor((F.col("delta") + slop) / (2 * slop)).alias("band")))
    key = ["doc_id", "text_key", "item_text", "n_terms", "b"]
    per_band = (on.withColumn("b", F.explode(band)).groupBy(*key, "ip").agg(F.min("pos").alias("pos"))
                .groupBy(*key).agg(F.count("*").alias("n_matched"), F.min("pos").alias("start"))
                .filter(F.col("n_matched") >= need))
    best = F.max(F.struct("n_matched", "start", "n_terms")).alias("best")
    return (per_band.join(small_side(index.items), "item_text").groupBy("doc_id", "text_key", "item").agg(best)
            .select("doc_id", "text_key", F.col("item").alias("item_id"), "best.start", "best.n_terms",
                    "best.n_matched"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  slop: int = 5, share: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, n_hit (words inside
    phrase occurrences), n_items, items (sorted item ids), n_near_items (items
    with a proximity match but no phrase)."""
    index = build_index(docs, benchmark, window, gram, id_col, text_col, item_col, item_text_col)
    found = materialise(window_matches(index), "decon-matches")
    key = ["doc_id", "text_key"]
    # words of the union of the windows: what each adds behind the furthest end before it
    earlier = Window.partitionBy(*key).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(earlier), F.col("start"))), F.lit(0))
    hit = (found.select(*key, "start", "length").distinct().withColumn("fresh", fresh)
           .groupBy(*key).agg(F.sum("fresh").alias("n_hit")))
    names = index.placed.select("wid", "item_text").join(index.items, "item_text").select("wid", "item").distinct()
    exact = (found.select(*key, "wid").distinct().join(small_side(materialise(names, "decon-names")), "wid")
             .select(*key, F.col("item").alias("item_id"), F.lit(1).alias("exact")))
    near = proximity_matches(index, slop, share).select(*key, "item_id", F.lit(0).alias("exact"))
    by_item = exact.unionByName(near).groupBy(*key, "item_id").agg(F.max("exact").alias("exact"))
    # one document's items: at most the benchmark's
    items = by_item.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when(F.col("exact") == 1, F.col("item_id")))).alias("items"),
        F.sum(1 - F.col("exact")).alias("n_near_items"))
    found = items.join(hit, (items["doc_id"].eqNullSafe(hit["doc_id"])) & (items["text_key"] == hit["text_key"]),
                       "left").select(items["doc_id"].alias("found_id"), items["text_key"].alias("found_key"),
                                      "items", "n_near_items", "n_hit")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                       F.size(match_words(F.col(text_col))).cast("long").alias("n_words"))
    out = rows.join(found, rows["doc_id"].eqNullSafe(found["found_id"]) & (rows["text_key"] == found["found_key"]),
                    "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                      F.coalesce("items", none).alias("items"),
                      F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``docs`` without the rows that hold a phrase of the benchmark, columns
    as they came."""
    id_col, text_col = kw.get("id_col", "doc_id"), kw.get("text_col", "text")
    index = build_index(docs, benchmark, kw.get("window", WINDOW), kw.get("gram", GRAM), id_col, text_col,
                        kw.get("item_col", "item_id"), kw.get("item_text_col", "text"))
    bad = window_matches(index).select(F.col("doc_id").alias("__bad_id"), F.col("text_key").alias("__bad_key"))
    bad = small_side(materialise(bad.distinct(), "decon-bad"))
    on = docs[id_col].eqNullSafe(bad["__bad_id"]) & (text_key(docs[text_col]) == bad["__bad_key"])
    return docs.join(bad, on, "left_anti")
