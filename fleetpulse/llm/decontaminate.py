"""Benchmark decontamination by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of a benchmark item. A document that holds a
window holds each of its shingles of ``SHINGLE`` words (a shorter window is one shingle),
so one shingle is a sufficient prefix: the rarest, by counts over all documents. Documents
are joined on these shingles alone; the shingle's place in the window bounds where the
window may start, document length bounds where it may end, and the words themselves
decide. Only DataFrame functions are used.

The documents' words are kept once in the shared folder. The prefix shingles are joined
as a kept table whose size Spark knows: it is sent to all tasks only while it is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffled otherwise. Words are fetched for
rows with candidates only.

Defined cases: a NULL text has no words; an item without words has no window and one of
fewer than ``WINDOW`` words is one window; items that share a window are each reported;
items without an id count as one item that the list of ids leaves out; document ids may
be NULL or repeat, rows are told apart by a number of their own; texts of any length are
whole; an empty benchmark contaminates nothing and an empty ``documents`` gives an empty
result; rows that repeat are each in the result; further columns are ignored or carried
along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.shared import (
    document_key,
    keep,
    keyed_anti_join,
    lower_ascii,
    table,
    whole_text,
)

WINDOW = 10
SHINGLE = 3
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), BREAKS), lambda word: word != "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id`` and each of its distinct windows, its words joined by spaces."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), words_of(whole_text()).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    placed = items.select("item_id", "words", F.explode(starts).alias("start"))
    joined = F.concat_ws(" ", F.slice("words", F.col("start"), F.lit(window)))
    return placed.select("item_id", joined.alias("window")).distinct()


def shingle(words: Column, at: Column, size: int) -> Column:
    """The name of the ``size`` words from place ``at`` (from 0): a hash, checked later."""
    return F.xxhash64(F.lit(size), *(F.get(words, at + i) for i in range(size)))


def shingles(rows: DataFrame, size: int, *columns: str) -> DataFrame:
    """``columns``, the place ``at`` (from 0) and the name ``token`` of each shingle."""
    places = F.sequence(F.lit(0), F.size("words") - size)
    placed = rows.where(F.size("words") >= size).select(
        *columns, "words", F.explode(places).alias("at")
    )
    return placed.select(*columns, "at", shingle(F.col("words"), F.col("at"), size).alias("token"))


def shingles_of(rows: DataFrame, sizes: list[int], *columns: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [shingles(rows, size, *columns).withColumn("size", F.lit(size)) for size in sizes],
    )


def prefixes(rows: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """Each window's rarest shingle in the documents (``token``) and its place (``lead``).

    A window with a shingle that no document has cannot occur and is left out.
    """
    spread = shingles_of(windows, sizes, "window", "n_window", "needs")
    spread = keep(spread.where(F.col("size") == F.col("needs")), "window-shingles")
    vocabulary = keep(spread.select("token").distinct(), "vocabulary")
    found = shingles_of(rows, sizes, "row_no").select("token").join(vocabulary, "token")
    counts = keep(found.groupBy("token").agg(F.count("*").alias("n")), "shingle-counts")
    ranked = spread.join(counts, "token", "left").groupBy("window", "n_window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at")).alias("first")
    )
    return ranked.where("first.n > 0").select(
        "window", "n_window", "first.token", F.col("first.at").alias("lead")
    )


def occurrences(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Where windows occur: ``row_no``, ``start`` (from 0), ``n_window``, ``window``."""
    words = F.split("window", " ")
    split = windows.select(
        "window",
        words.alias("words"),
        F.size(words).alias("n_window"),
        F.least(F.size(words), F.lit(SHINGLE)).alias("needs"),
    )
    split = keep(split, "split-windows")
    # At most SHINGLE different ones; one pass over the documents each, mostly one in all.
    sizes = sorted(row.needs for row in split.select("needs").distinct().collect()) or [SHINGLE]
    first = keep(prefixes(rows, split, sizes), "prefixes")
    start = F.col("at") - F.col("lead")
    sized = rows.select("row_no", "words", F.size("words").alias("n"))
    met = shingles_of(sized, sizes, "row_no", "n").join(first, "token")
    candidates = keep(
        met.where((start >= 0) & (start + F.col("n_window") <= F.col("n"))).select(
            "row_no", start.alias("start"), "n_window", "window"
        ),
        "candidates",
    )
    # Only the words of rows with candidates move.
    chosen = keep(candidates.select("row_no").distinct(), "candidate-rows")
    held = rows.select("row_no", "words").join(chosen, "row_no", "left_semi")
    there = F.slice("words", F.col("start") + 1, F.col("n_window"))
    verified = candidates.join(keep(held, "candidate-words"), "row_no").where(
        F.concat_ws(" ", there) == F.col("window")
    )
    return verified.select("row_no", "start", "n_window", "window")


def word_rows(docs: DataFrame, *columns: Column) -> DataFrame:
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        *columns,
        words_of(whole_text()).alias("words"),
    )
    return keep(rows, "words")


def contamination(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row_no``, ``n_hit``, ``n_items`` and the hit ``items`` for rows that any window
    occurs in."""
    windows = keep(item_windows(benchmark, window), "windows")
    found = keep(occurrences(rows, windows.select("window").distinct()), "occurrences")
    last = (F.col("start") + F.col("n_window") - 1).cast("int")
    covered = found.select("row_no", F.explode(F.sequence("start", last)).alias("at"))
    hits = covered.distinct().groupBy("row_no").agg(F.count("*").alias("n_hit"))
    pairs = found.select("row_no", "window").distinct().join(windows, "window")
    items = pairs.select("row_no", "item_id").distinct().groupBy("row_no")
    listed = items.agg(
        F.count("*").alias("n_items"), F.collect_list("item_id").alias("items")
    )
    return hits.join(listed, "row_no")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that no window occurs in, with all their columns."""
    rows = word_rows(docs, *document_key())
    dirty = rows.join(contamination(rows, benchmark, window), "row_no", "left_semi")
    return keyed_anti_join(docs, dirty.select("key_id", "key_text"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    rows = word_rows(table(spark, folder, "documents"), F.col("doc_id"))
    hits = keep(contamination(rows, table(spark, folder, "benchmark")), "contamination")
    items = F.coalesce("items", F.array().cast("array<string>"))
    marked = rows.select("row_no", "doc_id", F.size("words").cast("long").alias("n_words")).join(
        hits, "row_no", "left"
    )
    return marked.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(items)), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (
      SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w,
        least(len(w), {WINDOW}) AS n
      FROM benchmark),
    s AS (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM i WHERE n > 0),
    v AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS win FROM s),
    l AS (SELECT DISTINCT n FROM v),
    e AS (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, l
      WHERE len(w) >= n),
    h AS (
      SELECT doc_id, k, e.n, item_id FROM e
      JOIN v ON e.n = v.n AND array_to_string(w[k:k + e.n - 1], ' ') = win),
    c AS (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS at FROM h),
    p AS (SELECT doc_id, count(*) AS n_hit FROM c GROUP BY 1),
    t AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
      coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
