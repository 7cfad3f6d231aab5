"""Benchmark passages in training documents, found in spite of substituted words. DataFrame functions only.

Words are runs of letters and digits (anything but ASCII marks, spaces and controls), lower-cased.
Seeds: a fixed mask is laid over every word position; the words at its ones are hashed, the others may be
anything. The mask is chosen by the length of the item alone: the first of ``MASKS`` for items of ``LONG``
words or more, the second for those of ``LEAST`` or more. Each fits, at some position, every pattern of
places that agree as far as the rule below asks (shown by enumeration in the tests), so no passage is lost
for want of a seed. Shorter items have one seed, of all their words. Training seeds are joined with benchmark seeds by hash. Before that join they are
tested, inside each document's array, against a bit table of the benchmark's seeds (one row beside every
document). Its size follows their number, up to ``TABLE_MOST`` words; a benchmark beyond that lets more
seeds through to the join, and nothing else changes.

A hit fixes an alignment of document and item. Around it, words are compared in place: the document
holds the passage when some ``span`` consecutive words of the item (all, if it has fewer) agree in at
least ``percent`` of 100 places; an item shorter than ``LEAST`` words must agree in all.

Nulls: null texts have no words; documents and items without id are judged like others, and items are kept
apart by their words, so items that share an id (or have none) are all found. Repeated rows give repeated
results only once (results are distinct). Items without words are left out. Other columns are ignored.
Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.signals import quoted
from gustline.llm.names import fresh
from gustline.session import stage

# Fixed values. Complete for windows of 16 to 20 and of 8 to 15 words at PERCENT.
MASKS = ["1101001", "1101"]
LONG = 16
SPAN = 20
PERCENT = 80
LEAST = 8
BROADCAST_SEEDS = 1 << 20  # benchmark seeds (with their items' words) sent to all tasks at most
TABLE_WORDS, TABLE_MOST = 1 << 16, 1 << 22  # 64-bit words of the bit table, at least and at most
SEEDS_PER_WORD = 1  # of the bit table, at most (two bits each), below its largest size

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR, -1)
    return F.filter(words, lambda w: w != "")


def _seeds(hashes: Column, number: int, mask: str) -> Column:
    """Hash of the mask's words at each position; seeds of different numbers do not meet."""
    places = [k for k, c in enumerate(mask) if c == "1"]
    positions = F.sequence(F.lit(0), F.size(hashes) - len(mask))
    seeds = F.transform(positions, lambda i: F.xxhash64(F.lit(number), *(F.get(hashes, i + k) for k in places)))
    return F.when(F.size(hashes) >= len(mask), seeds).otherwise(F.array().cast("array<bigint>"))


def _kinds(items: DataFrame) -> list[tuple[int, str, Column]]:
    """Number and mask of the seeds, and the items that have them."""
    size = F.size("item_words")
    kinds = [(0, MASKS[0], size >= LONG), (1, MASKS[1], (size >= LEAST) & (size < LONG))]
    kinds += [(-n, "1" * n, size == n) for n in range(1, LEAST)]
    held = items.agg(*(F.coalesce(F.bool_or(which), F.lit(False)) for *_, which in kinds)).first()
    return [kind for kind, there in zip(kinds, held, strict=True) if there]


def _bit(seed: Column) -> Column:
    """Two bits of one table word."""
    one = F.lit(1).cast("long")
    low = F.call_function("shiftleft", one, seed.bitwiseAND(63).cast("int"))
    high = F.call_function("shiftleft", one, F.shiftrightunsigned(seed, 6).bitwiseAND(63).cast("int"))
    return low.bitwiseOR(high)


def _place(seed: Column, words: int) -> Column:
    return F.shiftrightunsigned(seed, 16).bitwiseAND(words - 1).cast("int")


def table_words(seeds: int) -> int:
    """Size of the bit table, a power of two."""
    return min(TABLE_MOST, max(TABLE_WORDS, 1 << max(0, seeds // SEEDS_PER_WORD - 1).bit_length()))


def _table(seeds: DataFrame, words: int) -> DataFrame:
    """The bit table as one array."""
    spark = seeds.sparkSession
    used = seeds.groupBy(_place(F.col("seed"), words).alias("place")).agg(F.bit_or(_bit(F.col("seed"))).alias("bits"))
    every = spark.range(words).select(F.col("id").cast("int").alias("place"))
    whole = every.join(used, "place", "left").select(F.struct("place", F.coalesce("bits", F.lit(0)).alias("bits")).alias("x"))
    return stage(whole.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bits"]).alias("bits")), "seed-table")


def overlaps(
    docs: DataFrame, benchmark: DataFrame, *, span: int = SPAN, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_matched, n_compared) of each passage found.

    One row per document, item and alignment: the best window, first in the item among equals.
    ``benchmark`` has item_id and text.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_list(F.col("text")).alias("item_words"))
    items = items.where(F.size("item_words") > 0).distinct()
    # by id and words, so that items are told apart whatever their ids
    items = stage(items.withColumn("item", F.sha2(F.concat_ws(" ", F.coalesce(F.col("item_id").cast("string"), F.lit("-")), "item_words"), 256)), "items")
    kinds = _kinds(items)  # seeds of no item would meet nothing

    hashed = items.withColumn("hashes", F.transform("item_words", lambda w: F.xxhash64(w)))
    item_seeds = hashed.limit(0).select("item", F.lit(0).alias("item_at"), F.lit(0).cast("long").alias("seed"))
    for number, mask, which in kinds:
        item_seeds = item_seeds.unionByName(hashed.where(which).select("item", F.posexplode(_seeds(F.col("hashes"), number, mask)).alias("item_at", "seed")))
    item_seeds = stage(item_seeds, "item-seeds")
    n_seeds = item_seeds.count()
    size = table_words(n_seeds)
    table = _table(item_seeds, size)

    words = docs.select(F.col(id_col).alias("doc_id"), word_list(F.col(text_col)).alias("words"))
    words = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    # one row, the bit table, beside every document
    words = words.withColumn("one", F.lit(1)).join(F.broadcast(table.withColumn("one", F.lit(1))), "one")
    bits = F.col("bits")

    def passed(seeds: Column) -> Column:
        """The seeds with both bits in the table, with their places; the second bit is seldom looked at."""

        def test(seed: Column, i: Column) -> Column:
            word = F.get(bits, _place(seed, size))
            first = F.getbit(word, seed.bitwiseAND(63).cast("int")) == 1
            second = F.getbit(word, F.shiftrightunsigned(seed, 6).bitwiseAND(63).cast("int")) == 1
            return F.when(first & second, F.struct(i.alias("at"), seed.alias("seed")))

        return F.filter(F.transform(seeds, test), lambda x: x.isNotNull())

    none = F.array().cast("array<struct<at:int,seed:bigint>>")
    seeds = [none, *(passed(_seeds(F.col("hashes"), number, mask)) for number, mask, _ in kinds)]
    # explode_outer: a filter on the array of hits would be moved down and the hits worked out twice
    passing = words.select("doc_id", "words", F.concat(*seeds).alias("hits"))
    hits = passing.select("doc_id", "words", F.explode_outer("hits").alias("hit")).where("hit is not null")
    around = F.slice("words", F.greatest(F.col("hit.at") - span, F.lit(0)) + 1, 3 * span)
    hits = hits.select("doc_id", F.col("hit.seed").alias("seed"), F.col("hit.at").alias("doc_at"), around.alias("near"))

    # of the hits of one alignment within a span of each other one is verified; its words reach past the others.
    # Few seeds are sent to all tasks, so that hits are matched and thinned out before anything is shuffled
    few = n_seeds <= BROADCAST_SEEDS
    met = hits.join(F.broadcast(item_seeds) if few else item_seeds, "seed").groupBy(
        "doc_id", "item", (F.col("doc_at") - F.col("item_at")).alias("diagonal"), F.floor(F.col("doc_at") / span)
    ).agg(F.min(F.struct("doc_at", "item_at", "near")).alias("hit")).select("doc_id", "item", "hit.*")
    met = met.join(F.broadcast(items) if few else items, "item")
    first = F.greatest(F.col("doc_at") - span, F.lit(0))  # of near, in the document
    shift = F.col("doc_at") - F.col("item_at") - first  # item position + shift = position in near
    met = met.withColumn("shift", shift).withColumn("first", first)
    same = F.transform("item_words", lambda w, i: F.coalesce((F.when(i + F.col("shift") >= 0, F.get("near", i + F.col("shift"))) == w).cast("int"), F.lit(0)))
    met = met.withColumn("same", same).withColumn("compared", F.least(F.size("item_words"), F.lit(span)))
    window = F.transform(
        F.sequence(F.lit(0), F.size("same") - F.col("compared")),
        lambda i: F.struct(F.aggregate(F.slice("same", i + 1, F.col("compared")), F.lit(0), lambda a, x: a + x).alias("matched"), (-i).alias("behind")),
    )
    asked = F.when(F.size("item_words") < LEAST, 100).otherwise(percent)
    met = met.withColumn("best", F.array_max(window)).where(F.col("best.matched") * 100 >= F.col("compared") * asked)
    start = -F.col("best.behind")
    return met.groupBy("doc_id", "item", "item_id", (F.col("doc_at") - F.col("item_at")).alias("diagonal")).agg(
        F.max(F.struct(F.col("best.matched").alias("matched"), F.col("best.behind").alias("behind"), "compared")).alias("best")
    ).select(
        "doc_id", "item_id", (F.col("diagonal") - F.col("best.behind")).cast("long").alias("doc_start"),
        (-F.col("best.behind")).cast("long").alias("item_start"),
        F.col("best.matched").cast("long").alias("n_matched"), F.col("best.compared").cast("long").alias("n_compared"),
    )


def free_of(docs: DataFrame, benchmark: DataFrame, *, span: int = SPAN, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no passage, with all their columns.

    Documents are judged by a 64-bit hash of their text, so repeated or missing ids neither save nor condemn
    others, and copies of a text share their verdict.
    """
    mark = fresh("text_mark", docs.columns)
    marked = docs.withColumn(mark, F.xxhash64(F.lit(0), "text"))
    found = overlaps(marked, benchmark, span=span, percent=percent, id_col=mark)
    found = stage(found.select(F.col("doc_id").alias(mark)).distinct(), "leaks")
    few = F.broadcast(found) if found.count() <= BROADCAST_SEEDS else found
    return marked.join(few, mark, "left_anti").select(*(F.col(quoted(c)) for c in docs.columns))
