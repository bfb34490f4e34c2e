"""Benchmark decontamination: size-partitioned MinHash containment search, in SQL functions alone.

Test items are short and documents long, so the share of an item's shingles that a document holds is sought, not
their Jaccard similarity.  An item's sketch is its K smallest shingle hashes (bottom-K MinHash).  Items fall into
partitions by size, and K grows with a partition's largest size u: K = (1 - t) u + margin.  At
containment t no more than (1 - t) |item| shingles are missing, so a document that holds the item holds at
least K - (1 - t) |item| of its sketch: the search loses nothing, and the hashes are a
fraction of the shingles.  Candidates are verified on the shingles' words.

Items of fewer than five words have no shingle.  On request such an item is sought as one run of all its
words among the documents' runs of that length, by an exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spread import shared, stage

SHINGLE = 5
THRESHOLD = 0.8
#: Sketch hashes beyond those that may be missing; more of them leave fewer false candidates.
MARGIN = 4
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """Lowered words of letters, digits and all beyond ASCII."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def each_shingle(words: str, make, width: int = SHINGLE) -> Column:
    """``make`` of the word columns of each shingle; none if there are too few words."""
    at = lambda i: [F.get(words, i + k) for k in range(width)]
    last = F.size(words) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: make(*at(i)))).otherwise(
        F.array().cast("array<string>" if make is phrase else "array<bigint>")
    )


def phrase(*words: Column) -> Column:
    return F.concat_ws(" ", *words)


def once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once a row.

    A generator stands between it and what uses it; a plain column could be copied
    into each use, here into a lambda that runs for every shingle.
    """
    return frame.select("*", F.explode(F.array(value)).alias(name))


def with_hashes(frame: DataFrame) -> DataFrame:
    return once(once(frame, "words", word_list(F.col("text"))), "hashes", each_shingle("words", F.xxhash64))


def item_sketches(items: DataFrame, threshold: float, margin: int) -> DataFrame:
    """(item_id, hash, need): the sketch of each item and how many of it a document must hold."""
    sized = once(with_hashes(items).withColumnRenamed("hashes", "all_hashes"), "hashes", F.array_sort(F.array_distinct("all_hashes")))
    sized = sized.withColumn("q", F.size("hashes")).where("q > 0")
    largest = F.pow(F.lit(2), F.ceil(F.log2("q")))  # of the item's size partition
    k = F.least(F.floor((1 - threshold) * largest).cast("int") + margin, F.col("q"))
    missing = F.col("q") - F.ceil(F.col("q") * threshold - 1e-9)
    sketch = sized.select("item_id", "q", k.alias("k"), F.slice("hashes", F.lit(1), k).alias("sketch"), missing.alias("missing"))
    return sketch.select("item_id", F.explode("sketch").alias("hash"), F.greatest(F.lit(1), F.col("k") - F.col("missing")).alias("need"))


def short_matches(docs: DataFrame, tests: DataFrame, folder: str) -> DataFrame | None:
    """(doc_id, item_id) where a document holds all words of a short item side by side; None without short items."""
    sized = once(tests, "words", word_list(F.col("text"))).where(F.size("words").between(1, SHINGLE - 1))
    items = stage(sized.select("item_id", F.size("words").alias("width"), F.concat_ws(" ", "words").alias("run")), folder, "short")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # four at most
    if not widths:
        return None
    runs = F.flatten(F.array(*[each_shingle("words", phrase, w) for w in widths]))
    # words hold no blank, so a run's words can be told from its text
    found = once(docs, "words", word_list(F.col("text"))).select("doc_id", F.explode(F.array_distinct(runs)).alias("run"))
    return found.join(items, "run").select("doc_id", "item_id").distinct()


def contaminated(
    documents: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, margin: int = MARGIN, short_items: bool = False
) -> DataFrame:
    """(doc_id, item_id, item_shingles, found_shingles, containment) where a document holds an item.

    ``documents`` has doc_id and text, ``items`` item_id and text; other columns are not read.  Shingles are
    five words and counted once.  With ``short_items`` an item of one to four words is one shingle of all of
    them, met by a document that has them side by side; else such items are found nowhere, as are
    null texts and texts without a word.  Rows that share an id are one document, or item, of which the best
    text counts; rows without one are left out.  Texts are taken whole, however long, and an empty table gives no row.
    """
    docs = documents.where("doc_id IS NOT NULL").select("doc_id", "text")
    tests = items.where("item_id IS NOT NULL").select("item_id", "text").distinct()
    folder = shared(documents)
    sketches = stage(item_sketches(tests, threshold, margin), folder, "sketches")
    hashes = with_hashes(docs).select("doc_id", F.explode("hashes").alias("hash"))
    met = hashes.join(sketches, "hash").groupBy("doc_id", "item_id").agg(
        F.count_distinct("hash").alias("met"), F.min("need").alias("need")
    )
    candidates = stage(met.where("met >= need").select("doc_id", "item_id"), folder, "candidates")
    worded = lambda frame: once(frame, "words", word_list(F.col("text")))
    shingles = lambda frame: once(worded(frame), "shingles", F.array_distinct(each_shingle("words", phrase)))
    item_texts = shingles(tests).where(F.size("shingles") > 0).select("item_id", F.col("shingles").alias("item_words"))
    # items join by id, and a document's words are made once per pair that is a candidate
    pairs = shingles(docs.join(candidates, "doc_id")).select("doc_id", "item_id", "shingles").join(item_texts, "item_id")
    met = once(pairs, "found_shingles", F.size(F.array_intersect("shingles", "item_words")).cast("long"))
    counted = met.select("doc_id", "item_id", F.size("item_words").cast("long").alias("item_shingles"), "found_shingles")
    short = short_matches(docs, tests, folder) if short_items else None
    if short is not None:
        one = F.lit(1).cast("long")
        counted = counted.unionByName(short.select("doc_id", "item_id", one.alias("item_shingles"), one.alias("found_shingles")))
    counted = counted.withColumn("containment", F.col("found_shingles") / F.col("item_shingles"))
    best = counted.where(F.col("found_shingles") >= F.ceil(F.col("item_shingles") * threshold - 1e-9))
    return best.groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("item_shingles", "found_shingles"), F.struct("containment", "found_shingles")).alias("x")
    ).select("doc_id", "item_id", "x.*", (F.col("x.found_shingles") / F.col("x.item_shingles")).alias("containment"))


# The same by brute force; documents and items with rows that share an id do not occur in it.
ORACLE = """
    WITH d AS (
        SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM documents
    ), ds AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM d)
    ), b AS (
        SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM benchmark
    ), bs AS (
        SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM b)
    ), n AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id
    ), short AS (
        SELECT item_id, len(w) AS k, array_to_string(w, ' ') AS s FROM b WHERE len(w) BETWEEN 1 AND 4
    ), runs AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i
              FROM d, (SELECT DISTINCT k FROM short) AS widths)
    )
    SELECT doc_id, item_id, item_shingles, count(*) AS found_shingles,
           count(*) / item_shingles AS containment
    FROM ds JOIN bs USING (s) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, item_shingles
    HAVING count(*) >= ceil(item_shingles * 0.8 - 1e-9)
    UNION ALL
    SELECT DISTINCT doc_id, item_id, 1, 1, 1.0 FROM runs JOIN short USING (s)
"""
