"""Mixing sources to target weights, with DataFrame functions only.

The words of each source are packed into blocks of a fixed number of words. Slots of output shards draw their source,
slots of a source are mapped to its blocks by a pseudorandom permutation, and the blocks are joined by their index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starfold.llm.common import stored

# Weights by position of the source, and the share of all words that the mix has.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_EPOCHS = 2
WORD = r"[^\x20\x09-\x0D]+"

BLOCK_WORDS = 256
SHARD_SLOTS = 4096
ROUNDS = 24
# Rows of a source that are put in order in one piece, so that no task orders a whole source.
PIECE_ROWS = 20_000


def permuted(index: Column, size: Column, *key: Column, rounds: int = ROUNDS, back: bool = False) -> Column:
    """Where a keyed pseudorandom permutation of 0 .. size - 1 puts `index`, or with `back` what it puts there.

    In each round the index and its mirror image at a keyed point are swapped or not, by a hash of the pair. A round
    undoes itself, so the rounds in reverse order undo the permutation.
    """

    def swap(x: Column, i: Column) -> Column:
        mirror = F.pmod(F.xxhash64(F.lit("mirror"), i, *key) - x, size)
        return F.when(F.pmod(F.xxhash64(i, F.greatest(x, mirror), *key), F.lit(2)) == 0, mirror).otherwise(x)

    order = F.sequence(F.lit(rounds), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(rounds))
    return F.aggregate(order, index.cast("long"), swap)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, hash, size, copies): size of every text, rows with the same id, source and text together."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    same = rows.groupBy("doc_id", "source", "hash").agg(F.max("size").alias("size"), F.count("*").alias("copies"))
    return stored(same, "sizes")


def targets(
    sizes: DataFrame, weights=WEIGHTS, share=SHARE, epochs=MOST_EPOCHS, block_words=BLOCK_WORDS, seed: int = 0
) -> DataFrame:
    """One row for each source: place by code point order (null last), source_size, target, blocks, slots, first slot.

    `wanted` is the target in whole words and `slots` as many as hold it; the last one is filled in part. `missing` is
    what the source's last block lacks, and `last_at` where each epoch's permutation puts that block.

    A target is the source's weight times a level that all share, `epochs` times its size at most; the level is such
    that the targets sum up to `share` of all words. In the order of the levels at which sources reach their limit,
    a source is limited if what the ones before leave for it and the rest would lift it above its own limit.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n_rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    rows = by_source.withColumn("place", place).withColumn("weight", weight)
    limit = F.col("source_size") * F.lit(float(epochs))
    order = Window.orderBy(limit / F.col("weight"), "place")
    every = Window.partitionBy(F.lit(0))
    before = lambda c: F.coalesce(F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumn("level", (F.sum("source_size").over(every) * F.lit(share) - before(limit))
                           / (F.sum("weight").over(every) - before(F.col("weight"))))
    rows = rows.withColumn("free", limit > F.col("level") * F.col("weight"))
    level = F.min(F.when(F.col("free"), F.struct(limit / F.col("weight"), "place", "level")))
    rows = rows.withColumn("common", level.over(every)["level"])
    target = F.when(F.col("free"), F.col("common") * F.col("weight")).otherwise(limit)
    rows = rows.withColumn("target", target).withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block_words)))
    width, size = F.lit(block_words), F.col("source_size")
    runs = [
        permuted(F.col("blocks") - 1, F.col("blocks"), F.lit(seed), F.col("place").cast("int"), F.lit(e).cast("long"), back=True)
        for e in range(int(epochs) + 1)
    ]
    rows = rows.withColumns({
        "wanted": F.round("target").cast("long"), "missing": F.col("blocks") * width - size, "last_at": F.array(*runs)})
    epoch = F.floor(F.col("wanted") / size)
    rest = F.col("wanted") - epoch * size
    n = F.ceil(rest / width)
    short = (F.get("last_at", epoch.cast("int")) < n) & (n * width - F.col("missing") < rest)
    slots = epoch * F.col("blocks") + n + short.cast("int")
    rows = rows.withColumn("slots", F.when(size > 0, slots).otherwise(0).cast("long"))
    ends = F.sum("slots").over(Window.orderBy("place"))
    return rows.select(
        "source", F.col("place").cast("int").alias("place"), "source_size", "target", "n_rows", "blocks", "slots",
        "wanted", "missing", "last_at", (ends - F.col("slots")).alias("first_slot"),
    )


def packed(sizes: DataFrame, sources: DataFrame, block_words=BLOCK_WORDS, piece_rows=PIECE_ROWS) -> DataFrame:
    """(place, block, doc_id, hash, offset, start, n_words): the stretches of documents that make up each block.

    The words of a source stand in the order of a hash of their documents, those of copies one after another. The order
    is found in pieces of about `piece_rows` documents each, whose sums tell where each piece begins. `offset` is where
    a document begins in its source, `start` where the stretch begins in it. Documents without words are in no block.
    """
    spread = F.xxhash64(F.lit("order"), "doc_id", "hash")
    rows = sizes.filter("size > 0").join(
        sources.select(F.col("source").alias("name"), "place", "n_rows"), F.col("source").eqNullSafe(F.col("name"))
    ).select(
        "place", "doc_id", "hash", (F.col("size") * F.col("copies")).alias("size"), spread.alias("spread"),
        F.pmod(F.shiftrightunsigned(spread, 8), F.ceil(F.col("n_rows") / F.lit(piece_rows))).alias("piece"),
    )
    sums = rows.groupBy("place", "piece").agg(F.sum("size").alias("piece_size"))
    begin = F.sum("piece_size").over(Window.partitionBy("place").orderBy("piece")) - F.col("piece_size")
    inside = Window.partitionBy("place", "piece").orderBy("spread", "doc_id", "hash").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum("size").over(inside)).join(
        sums.select("place", "piece", begin.alias("begin")), ["place", "piece"])
    rows = rows.withColumn("offset", F.col("begin") + F.col("end") - F.col("size"))
    width = F.lit(block_words)
    first, last = F.floor(F.col("offset") / width), F.floor((F.col("offset") + F.col("size") - 1) / width)
    rows = rows.select("place", "doc_id", "hash", "offset", "size", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.col("block") * width - F.col("offset"), F.lit(0))
    end = F.least((F.col("block") + 1) * width - F.col("offset"), F.col("size"))
    return rows.select(
        "place", "block", "doc_id", "hash", "offset", start.alias("start"), (end - start).alias("n_words"))


def drawn(sources: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(shard, slot, place, epoch, block, filled): what every slot of the mix holds, and at most how many words of it.

    The slots of all shards are numbered, and a permutation deals the sources' slots out to them: the counts of the
    sources in a shard are multinomial draws, given that over all shards each source gets its `slots`. A source's slots
    are numbered by shard; each run through its blocks (an epoch) follows another permutation of them.
    """
    spark = sources.sparkSession
    total = sources.agg(F.sum("slots")).first()[0] or 0
    slots = spark.range(total).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), F.pmod("id", F.lit(shard_slots)).alias("slot"),
        permuted(F.col("id"), F.lit(total), F.lit(seed), F.lit("slots")).alias("dealt"),
    )
    # The source whose range of slots holds a number; ranges are met by the cells of a grid that they cover.
    cell = F.lit(max(1, -(-total // 1024)))
    ranges = sources.filter("slots > 0").select(
        "place", "slots", "blocks", "first_slot", "source_size", "wanted", "missing", "last_at",
        F.explode(F.sequence(F.floor(F.col("first_slot") / cell), F.floor((F.col("first_slot") + F.col("slots") - 1) / cell)))
        .alias("cell"),
    )
    dealt = slots.withColumn("cell", F.floor(F.col("dealt") / cell)).join(ranges, "cell").filter(
        "dealt >= first_slot and dealt < first_slot + slots")
    counts = dealt.groupBy("shard", "place").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("place").orderBy("shard")) - F.col("n")
    counts = counts.withColumn("before", before).select("shard", "place", "before")
    within = F.row_number().over(Window.partitionBy("shard", "place").orderBy("slot")) - 1
    numbered = dealt.withColumn("within", within).join(counts, ["shard", "place"])
    number = F.col("before") + F.col("within")
    epoch = F.floor(number / F.col("blocks"))
    # Where a slot's words begin among those that the source gives: full blocks before it, but for the last block.
    nth = F.pmod(number, "blocks")
    lacks = F.when(F.get("last_at", epoch.cast("int")) < nth, F.col("missing")).otherwise(0)
    begin = epoch * F.col("source_size") + nth * F.lit(block_words) - lacks
    return numbered.select(
        "shard", "slot", "place", epoch.alias("epoch"),
        F.least(F.lit(block_words), F.col("wanted") - begin).alias("filled"),
        permuted(F.pmod(number, "blocks"), F.col("blocks"), F.lit(seed), F.col("place"), epoch).alias("block"),
    )


class Mix:
    """A mix of `docs`: `sizes`, `sources`, `stretches` of documents in blocks, and the `slots` that hold blocks.

    Null texts and texts without a word have size 0 and are taken from nowhere; a null source is one source, the last.
    Rows with the same id, source and text stand one after another and share what is taken of them, the first ones a
    word more if it does not divide. No word stands in more than `epochs` slots. Without any word there are no slots.
    Extra columns of `docs` are ignored. The same rows give the same mix, in whatever order they come.
    """

    def __init__(
        self, docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE,
        epochs=MOST_EPOCHS, block_words=BLOCK_WORDS, shard_slots=SHARD_SLOTS, seed=0,
    ):
        self.docs = docs.select(
            F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
        self.sizes = sized(docs, id_col, text_col, source_col)
        self.sources = stored(targets(self.sizes, weights, share, epochs, block_words, seed), "sources")
        self.stretches = packed(self.sizes, self.sources, block_words)
        self.slots = drawn(self.sources, seed, shard_slots, block_words)
        self.block_words = block_words

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) of every row of the documents."""
        held = self.stretches.join(self.slots.select("place", "block", "filled"), ["place", "block"])
        begin = F.col("offset") + F.col("start") - F.col("block") * F.lit(self.block_words)
        kept = F.greatest(F.lit(0), F.least("n_words", F.col("filled") - begin))
        words = held.groupBy("place", "doc_id", "hash").agg(F.sum(kept).alias("words"))
        words = words.toDF("p", "d", "h", "words")
        rows = self.sizes.join(
            self.sources.select(F.col("source").alias("name"), "place", "source_size", "target"),
            F.col("source").eqNullSafe(F.col("name")),
        ).join(
            words, (F.col("place") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("d"))
            & (F.col("hash") == F.col("h")), "left",
        )
        rows = rows.select(
            "doc_id", "size", "source_size", "target", "copies", F.coalesce("words", F.lit(0)).alias("words"),
            F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
        )
        share = F.expr("words div copies") + F.when(F.col("copy") <= F.col("words") % F.col("copies"), 1).otherwise(0)
        return rows.select("doc_id", "size", "source_size", "target", share.cast("long").alias("taken"))

    def shards(self) -> DataFrame:
        """(shard, slot, source, epoch, block, n_words, text): the mixed blocks, words joined by single blanks.

        Texts meet the list of their stretches, and are cut before they are shuffled to their blocks.
        """
        key = ["doc_id", "hash"]
        names = self.sources.select("place", F.col("source").alias("name"))
        cuts = self.stretches.groupBy("place", "offset", *key).agg(
            F.collect_list(F.struct("block", "start", "n_words")).alias("cuts")
        ).join(names, "place").toDF("place", "offset", "d", "h", "cuts", "name")
        texts = self.docs.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit("")))).filter(
            F.regexp_count(F.col("text"), F.lit(WORD)) > 0)
        rows = texts.join(cuts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h"))
                          & F.col("source").eqNullSafe(F.col("name")))
        # The array of words goes through a generator, so that it is made once for each text and not for each cut.
        rows = rows.select("place", "offset", "cuts", F.explode(F.array(
            F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).alias("words"))

        def stretch(cut: Column) -> Column:
            size = F.size("words")
            copies = F.ceil((cut["start"] + cut["n_words"]) / size).cast("int")
            source = F.when(copies <= 1, F.col("words")).otherwise(F.flatten(F.array_repeat("words", copies)))
            text = F.array_join(F.slice(source, (cut["start"] + 1).cast("int"), cut["n_words"].cast("int")), " ")
            at = (F.col("offset") + cut["start"]).alias("at")
            return F.struct(cut["block"].alias("block"), at, cut["n_words"].alias("n_words"), text.alias("text"))

        parts = rows.select("place", F.explode(F.transform("cuts", stretch)).alias("part")).select("place", "part.*")
        # Of equal rows all but one find the same stretches.
        parts = parts.groupBy("place", "block", "at").agg(F.max("n_words").alias("n_words"), F.max("text").alias("text"))
        blocks = parts.groupBy("place", "block").agg(
            F.sum("n_words").alias("n_words"), F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"))
        text = F.array_join(F.transform("parts", lambda p: p["text"]), " ")
        return (
            self.slots.join(blocks.select("place", "block", F.col("n_words").alias("n"), text.alias("whole")), ["place", "block"])
            .join(names, "place")
            .select(
                "shard", "slot", F.col("name").alias("source"), "epoch", "block", F.least("n", "filled").alias("n_words"),
                F.when(F.col("filled") >= F.col("n"), F.col("whole"))
                .otherwise(F.array_join(F.slice(F.split("whole", " "), F.lit(1), F.col("filled").cast("int")), " ")).alias("text"),
            )
        )
