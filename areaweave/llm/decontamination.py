"""Benchmark decontamination over a distributed positional inverted index.

Words of benchmark items form windows (13 in a row; an item with fewer is one window).  The index
holds, for each term that windows are looked up by, the documents and positions where it stands.
A window is looked up by its rarest terms, rarest first: each list of positions, less the term's
place in the window, is a list of possible starts, and the lists are intersected.  Possible starts
are then compared with the document's words, so matches are exact.  ``proximity`` finds where all
terms of any query stand close together, in any order.  All steps are DataFrame functions.

Null and empty texts have no words and no windows.  Repeated rows of documents are told apart by
a digest of their text only: rows with one id and one text give one row each, with the same
figures; rows with one id and different texts are judged each by their own text.  Repeated item
ids count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaweave.llm.common import ascii_lower, pick, stored

#: Whatever is not a word: the ASCII characters but digits and lower-case letters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: Lists of positions that are intersected before the words themselves are compared.
LISTS = 2
#: Rows and bytes that are sent to all tasks at most; beyond them the join is shuffled.
TERMS_SENT, BYTES_SENT = 200_000, 64_000_000


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def windows_of(items: DataFrame, size: int = WINDOW, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """One row per different window: words (array) and the items that hold it."""
    rows = pick(items, item_id=id_column, text=text_column).select("item_id", tokens(F.col("text")).alias("w"))
    rows = rows.where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    rows = rows.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.lit(size)))).alias("words"))
    return rows.groupBy("words").agg(F.collect_set("item_id").alias("items"))


def _send(spark, df: DataFrame, most: int) -> DataFrame:
    """A hint to send ``df`` to all tasks, if its counted rows and their bytes are few enough."""
    size = df.limit(most + 1).agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()
    return F.broadcast(df) if size["n"] <= most and (size["bytes"] or 0) <= BYTES_SENT else df


def lookups(windows: DataFrame, docs: DataFrame, lists: int = LISTS) -> DataFrame:
    """Windows with their ``lists`` rarest terms: window, words, items, terms (array of term, place)."""
    spark = windows.sparkSession
    terms = stored(windows.select(F.explode("words").alias("term")).distinct(), "terms")
    counted = (docs.select(F.explode("words").alias("term")).join(_send(spark, terms, TERMS_SENT), "term")
               .groupBy("term").agg(F.count("*").alias("n")))
    placed = windows.select("window", F.posexplode("words").alias("place", "term"))
    placed = placed.join(counted, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # Of a term that stands twice in a window one place is enough.
    placed = placed.groupBy("window", "term", "n").agg(F.min("place").alias("place"))
    rank = F.row_number().over(Window.partitionBy("window").orderBy("n", "place"))
    rare = placed.withColumn("rank", rank).where(F.col("rank") <= lists)
    grouped = rare.groupBy("window").agg(F.sort_array(F.collect_list(F.struct("rank", "n", "term", "place"))).alias("terms"))
    # A window with a term that no document holds occurs nowhere.
    return windows.join(grouped, "window").where(F.col("terms")[0]["n"] > 0)


def occurrences(docs: DataFrame, looked: DataFrame) -> DataFrame:
    """Every occurrence of a window: doc, start, length, window.  ``docs``: doc (key), text and words."""
    spark = docs.sparkSession
    wanted = looked.select(F.explode("terms").alias("t")).select(F.col("t.term").alias("term")).distinct()
    index = docs.select("doc", F.posexplode("words").alias("at", "term")).join(
        _send(spark, wanted, TERMS_SENT), "term")
    index = stored(index.select("term", "doc", "at"), "postings")
    found = None
    for k in range(LISTS):
        by = looked.where(F.size("terms") > k).select("window", F.col("terms")[k]["term"].alias("term"),
                                                      F.col("terms")[k]["place"].alias("place"))
        starts = index.join(_send(spark, by, TERMS_SENT), "term").select(
            "window", "doc", (F.col("at") - F.col("place")).alias("start")).where(F.col("start") >= 0)
        if found is None:
            found = starts
            continue
        more = looked.select("window", (F.size("terms") > k).alias("has"))
        left = found.join(_send(spark, more, TERMS_SENT), "window")
        found = left.where(~F.col("has")).drop("has").union(
            left.where("has").drop("has").join(starts, ["window", "doc", "start"], "left_semi"))
    # A document has one possible start at most for each window and position.
    possible = found.distinct().join(_send(
        spark, looked.select("window", F.col("words").alias("expected")), TERMS_SENT), "window")
    possible = possible.groupBy("doc").agg(F.collect_list(F.struct("start", "expected", "window")).alias("possible"))
    checked = docs.select("doc", "text").join(possible, "doc").select("doc", "possible", tokens(F.col("text")).alias("words"))
    same = F.filter("possible", lambda p: (p["start"] + F.size(p["expected"]) <= F.size("words")) & (
        F.slice("words", p["start"] + 1, F.size(p["expected"])) == p["expected"]))
    return checked.select("doc", F.explode(same).alias("p")).select(
        "doc", "p.start", F.size("p.expected").alias("length"), "p.window")


def proximity(docs: DataFrame, queries: DataFrame, within: int, id_column: str = "doc_id", text_column: str = "text",
              query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """Where all terms of a query stand in ``within`` words: item_id, doc_id, digest of the text, start and end.

    One row for each place of a term that all the others follow closely enough; end is the first place
    by which they have.  Places of all terms asked for are looked up, around those of the query's rarest term
    only, and meet in stretches of ``within`` words.  Rows that repeat a query's id ask for all their terms together.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_column, text=text_column)
    worded = rows.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc"), tokens(F.col("text")).alias("words"))
    asked = stored(pick(queries, item_id=query_id, text=query_text).select(
        "item_id", F.explode(tokens(F.col("text"))).alias("term")).distinct(), "asked")
    wanted = _send(spark, asked.select("term").distinct(), TERMS_SENT)
    index = worded.select("doc", F.posexplode("words").alias("at", "term")).join(wanted, "term").distinct()
    index = stored(index.withColumn("stretch", F.floor(F.col("at") / within)), "postings")
    counted = index.groupBy("term").agg(F.count("*").alias("n"))
    rarest = asked.join(counted, "term", "left").groupBy("item_id").agg(
        F.count("*").alias("terms"), F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")).alias("t"))
    # A query with a term that no document holds is met nowhere.
    rarest = rarest.where(F.col("t.n") > 0).select("item_id", "terms", F.col("t.term").alias("term"))
    around = index.join(rarest, "term").select(
        "item_id", "doc", F.explode(F.array(*[F.col("stretch") + i for i in (-1, 0, 1)])).alias("stretch"))
    places = index.join(asked, "term").join(around, ["item_id", "doc", "stretch"], "left_semi")
    places = stored(places.select("item_id", "doc", "stretch", "at", "term"), "places")
    starts = places.select("item_id", "doc", F.col("at").alias("start"), F.explode(
        F.array(F.col("stretch"), F.col("stretch") + 1)).alias("stretch"))
    after = starts.join(places, ["item_id", "doc", "stretch"]).where(F.col("at").between(F.col("start"), F.col("start") + within - 1))
    first = after.groupBy("item_id", "doc", "start", "term").agg(F.min("at").alias("at"))
    met = first.groupBy("item_id", "doc", "start").agg(F.count("*").alias("terms"), F.max("at").alias("end"))
    return met.join(rarest.select("item_id", "terms"), ["item_id", "terms"]).select(
        "item_id", "doc.doc_id", F.col("doc.h").alias("digest"), "start", "end")


def is_contaminated(share: int = 20) -> Column:
    """Some words are hit, and at least one in ``share``."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_column: str = "doc_id",
                  text_column: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted as strings) and the text's digest of every row of ``docs``."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    worded = rows.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc"), "text",
                         tokens(F.col("text")).alias("words"))
    windows = windows_of(items, size, item_id, item_text)
    windows = stored(windows.select(F.xxhash64("words", F.lit(7)).alias("window"), "words", "items"), "windows")
    looked = stored(lookups(windows, worded), "lookups")
    hits = stored(occurrences(worded, looked), "hits")
    by_start = Window.partitionBy("doc").orderBy("start")
    spans = hits.groupBy("doc", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    covered = spans.withColumn("reach", F.greatest(F.coalesce(reach, F.col("start")), F.col("start")))
    n_hit = covered.groupBy("doc").agg(F.sum(F.greatest(F.col("end") - F.col("reach"), F.lit(0))).alias("n_hit"))
    # Many items may share a passage: their ids meet the documents that hold it, not its every occurrence.
    holders = windows.select("window", F.explode(F.col("items").cast("array<string>")).alias("item"))
    named = hits.select("doc", "window").distinct().join(holders, "window").groupBy("doc").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    figures = n_hit.join(named, "doc")
    return worded.select("doc", F.size("words").cast("bigint").alias("n_words")).join(figures, "doc", "left").select(
        "doc.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("doc.h").alias("digest"))


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = contamination(docs, items, size, id_column, text_column).where(is_contaminated())
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("digest").alias("bad_digest")).distinct()
    same = docs[f"`{id_column}`"].eqNullSafe(F.col("bad_id")) & (F.xxhash64(docs[f"`{text_column}`"]) == F.col("bad_digest"))
    return docs.join(bad, same, "left_anti")
