"""Benchmark decontamination with DataFrame functions only: SimHash windows, a Hamming index, exact similarity.

Texts are lower-cased words (letters and digits). A document window has as many
words as the item it is compared with. Windows without any of an item's shingles
(five words) have similarity 0, so windows are taken only where a document has a
shingle of an item, placed so that the shingle is where the item has it.

Each window and item gets a 64-bit SimHash of its shingles, weighted by how
often they occur. The fingerprint is cut into ``BLOCKS`` blocks; of two
fingerprints that differ in at most ``RADIUS`` bits, some block differs in at
most ``RADIUS // BLOCKS``. The index has every item under all values that near
to each of its blocks, so an equality join on (window size, block, value) finds
all fingerprints within the radius. Candidates within it are verified exactly:
weighted Jaccard, the sum of the lesser counts by the sum of the greater ones.

An item below five words has one shingle of all its words. Results on odd rows:
null, empty or wordless texts and items match nothing; rows without or with an
equal id are judged each for itself; of equal similarities the first window is
given; empty tables give an empty result; other columns aren't carried.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm._tables import free_name, key_of, keyed, near, written

SIMILARITY = 0.8
SHINGLE = 5
BITS, BLOCKS, RADIUS = 64, 8, 23
#: Rows up to which item shingles, the index and lists of found documents are broadcast (some 10 to 100 bytes each).
BROADCAST_ROWS = 1_000_000


def _words(text: str) -> F.Column:
    return F.expr(rf"filter(split(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), x -> x <> '')")


def _shingles(words: str, size: str) -> str:
    """Fingerprints of all runs of ``size`` (1 to 5) words of an array of word fingerprints."""
    run = " ".join(f"when {k} then xxhash64({', '.join(f'get({words}, i + {j})' for j in range(k))})"
                   for k in range(1, SHINGLE + 1))
    if size.isdigit():
        run = f"xxhash64({', '.join(f'get({words}, i + {j})' for j in range(int(size)))})"
    else:
        run = f"case {size} {run} end"
    return f"if(size({words}) >= {size}, transform(sequence(0, size({words}) - {size}), i -> {run}), array())"


def _fingerprint(shingles: str) -> F.Column:
    """Bit b is set if more shingles, counted with repetition, have it than not."""
    votes = F.expr(f"""transform(sequence(0, {BITS - 1}), b ->
        aggregate({shingles}, 0, (n, h) -> n + if((shiftright(h, b) & 1) = 1, 1, -1)))""")
    return F.aggregate(F.transform(votes, lambda n, b: F.when(n > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b))
                                   .otherwise(F.lit(0).cast("long"))),
                       F.lit(0).cast("long"), lambda all_, bit: all_.bitwiseOR(bit))


def _tagged(shingles: str) -> F.Column:
    """A set in place of a bag: the k-th occurrence of a shingle differs from the others."""
    return F.expr(f"transform({shingles}, (h, i) -> xxhash64(h, size(filter(slice({shingles}, 1, i), y -> y = h))))")


def _block(j: str) -> str:
    width = BITS // BLOCKS
    return f"shiftrightunsigned(print, {width} * {j}) & {(1 << width) - 1}"


def _items(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item`` (of id and text), ``item_id``, ``n`` words, ``k`` words a shingle, ``shingles``, ``print``, ``bag``."""
    items = bench.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    items = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), _words("text").alias("words"))
    items = items.where("size(words) > 0").select(
        "item", "item_id", F.size("words").alias("n"), F.expr(f"least({SHINGLE}, size(words))").alias("k"),
        F.expr("transform(words, x -> xxhash64(x))").alias("words"))
    items = items.withColumn("shingles", F.expr(_shingles("words", "k"))).drop("words")
    return items.select("*", _fingerprint("shingles").alias("print"), _tagged("shingles").alias("bag"))


def _index(items: DataFrame) -> DataFrame:
    """Each item under every value within ``RADIUS // BLOCKS`` bits of each of its blocks."""
    width = BITS // BLOCKS
    flips = [sum(1 << b for b in bits) for r in range(RADIUS // BLOCKS + 1) for bits in combinations(range(width), r)]
    blocks = items.select("item", "n", "print", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    return blocks.select("item", "n", "block", F.col("print").alias("item_print"),
                         F.explode(F.array([F.lit(x) for x in flips])).alias("flip"), F.expr(_block("block")).alias("own")
                         ).select("item", "n", "block", "item_print", F.expr("own ^ flip").alias("value"))


def _found(docs: DataFrame, bench: DataFrame, item_col: str, item_text: str, threshold: float) -> DataFrame:
    """``key``, ``id``, ``item_id``, ``start_word``, ``n_words``, ``similarity`` of keyed documents: the best of each item."""
    items = written(_items(bench, item_col, item_text), "items")
    sizes = [r["k"] for r in items.select("k").distinct().collect()]  # at most five
    places = items.select("n", "k", F.posexplode("shingles").alias("there", "shingle")).distinct()
    places = near(places, BROADCAST_ROWS)
    words = docs.select("key", "id", _words("text").alias("words")).select(
        "key", "id", F.expr("transform(words, x -> xxhash64(x))").alias("words"))

    def hits(k: int) -> DataFrame:
        runs = words.select("key", F.posexplode(F.expr(_shingles("words", str(k)))).alias("here", "shingle"))
        return runs.join(places.where(F.col("k") == k).drop("k"), "shingle").select(
            "key", F.expr("greatest(0, here - there)").alias("start"), "n")

    if not sizes:
        return docs.select("key", "id").limit(0).select(
            "key", "id", F.lit(None).cast(dict(bench.dtypes)[item_col]).alias("item_id"), F.lit(0).alias("start_word"),
            F.lit(0).alias("n_words"), F.lit(0.0).alias("similarity"))
    starts = reduce(DataFrame.unionAll, map(hits, sorted(sizes))).groupBy("key").agg(
        F.collect_set(F.struct("start", "n")).alias("starts"))
    starts = near(written(starts, "starts"), BROADCAST_ROWS)
    windows = words.join(starts, "key").select("key", "id", "words", F.explode("starts").alias("at")).select(
        "key", "id", "at.n", F.expr("greatest(0, least(at.start, size(words) - at.n))").alias("start"), "words").select(
        "key", "id", "n", "start", F.expr("slice(words, start + 1, n)").alias("words"))
    windows = windows.withColumn("k", F.expr(f"least({SHINGLE}, n)")).withColumn("shingles", F.expr(_shingles("words", "k")))
    windows = windows.where("size(shingles) > 0").select("key", "id", "n", "start", "shingles").distinct()
    windows = written(windows.select("*", _fingerprint("shingles").alias("print"), _tagged("shingles").alias("bag"))
                      .drop("shingles"), "windows")
    blocks = windows.select("key", "n", "start", "print", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    blocks = blocks.withColumn("value", F.expr(_block("block")))
    within = (blocks.join(near(_index(items), BROADCAST_ROWS), ["n", "block", "value"])
              .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
              .select("key", "n", "start", "item").distinct())
    bags = near(items.select("item", "item_id", F.col("bag").alias("item_bag")), BROADCAST_ROWS // BITS)
    judged = within.join(windows.select("key", "id", "n", "start", "bag"), ["key", "n", "start"]).join(bags, "item")
    judged = judged.withColumn("similarity", F.expr(
        "size(array_intersect(bag, item_bag)) / size(array_union(bag, item_bag))")).where(F.col("similarity") >= threshold)
    best = judged.groupBy("key", "item_id").agg(
        F.first("id").alias("id"), F.max(F.struct("similarity", F.expr("-start").alias("before"), "n")).alias("best"))
    return best.select("key", "id", "item_id", F.expr("-best.before").alias("start_word"),
                       F.col("best.n").alias("n_words"), "best.similarity")


def benchmark_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """A row for each document and item that it holds: the ids, ``start_word``, ``n_words``, ``similarity``."""
    found = _found(keyed(docs, id_col, text_col), bench, item_col, item_text, threshold)
    return found.select(F.col("id").alias(id_col), F.col("item_id").alias(item_col), "start_word", "n_words", "similarity")


def without_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    key = key_of(docs, id_col, text_col)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"))
    found_key = free_name(docs, "found key")
    found = _found(own, bench, item_col, item_text, threshold).select(F.col("key").alias(found_key)).distinct()
    return docs.join(near(written(found, "leaks"), BROADCAST_ROWS), key == F.col(f"`{found_key}`"), "left_anti")
