"""Mixing sources to target weights by fixed-length token blocks.

Tokens are words. Each source's words, in doc_id order, are packed into blocks
of ``block`` words (a block may span documents; the last one is short). The
mix has as many slots as the targets need; each output shard draws its slots'
sources from a multinomial, a repair moves the surplus draws to the sources
that fell short, and slot j of a source takes block ``perm(j mod n)`` of its n
blocks, ``perm`` being a swap-or-not permutation keyed by source and pass.
Blocks are then joined by index. A source's last slot takes the first words of
its block only, as many as its target, rounded to a word, still lacks. No source
gets more than two slots a block, so no document is taken more than twice.

Everything is hashed from constants and the data, so reruns agree. DataFrame
functions only. Null text: size 0, nothing taken. A null source is a source of
its own, last in order. Empty table: no rows. Repeated rows count as they come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, WORD, let, order_key, running_total, store, whole_row

#: Fixed values of the mix.
WEIGHTS = [5, 2, 1]
TOTAL_SHARE = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 64
OUTPUT_SHARDS = 256
#: Resolution of the draw: equal bins of the unit interval, dealt to the
#: sources; the repair makes up for the rounding. Bounds the broadcast table.
DRAW_BINS = 1 << 16
ROUNDS = 12
#: Slots of a range of draws, the unit in which they are dealt to tasks.
SLOTS_A_RANGE = 1 << 14


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(src, source_size) -> plus weight and target (double): ``TOTAL_SHARE`` of all
    words, shared by weight, none above ``MOST_PASSES`` times its size.

    Water-filling in closed form: with the sources in the order of cap/weight,
    the level is that of the first source that it does not fill. One row per
    source; the windows over all sources see those rows alone.
    """
    every = Window.partitionBy(F.lit(0))
    x = sizes.withColumn("_i", F.row_number().over(every.orderBy("src")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          (F.col("_i") % len(WEIGHTS) + 1).cast("int"))
    x = x.withColumns({"weight": weight, "_cap": F.col("source_size") * float(MOST_PASSES)})
    x = x.withColumn("_r", F.col("_cap") / F.col("weight"))
    w = every.orderBy("_r", "_i")
    filled = F.coalesce(F.sum("_cap").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing))
    x = x.withColumn("_level", (F.sum("source_size").over(every) * TOTAL_SHARE - filled) / left)
    x = x.withColumn("_at", F.min(F.when(F.col("_level") <= F.col("_r"),
                                         F.struct("_r", "_i", "_level"))).over(every))
    level = F.col("_at._level")
    return x.withColumn("target", F.when(level.isNull(), F.col("_cap"))
                        .otherwise(F.least(F.col("_cap"), level * F.col("weight")))
                        ).drop("_i", "_cap", "_r", "_level", "_at")


def permuted(j: Column, n: Column, *keys: Column, back: bool = False) -> Column:
    """Swap-or-not: a keyed permutation of 0..n-1 for any n, round by round
    x -> K - x (mod n) or x, decided by a hash of the larger of the two. A round
    undoes itself, so ``back`` goes through them in reverse order."""
    def step(x: Column, r: Column) -> Column:
        k = F.pmod(F.xxhash64(F.lit("key"), r, *keys), n)
        return let(F.pmod(k - x, n), lambda y: F.when(
            F.xxhash64(F.lit("bit"), r, F.greatest(x, y), *keys) % 2 == 0, x).otherwise(y))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(F.reverse(rounds) if back else rounds, j.cast("long"), step)


def with_slots(sources: DataFrame) -> DataFrame:
    """(src, source_size, target, ...) -> plus blocks, slots and last_words, the
    words that the last slot takes: together exactly the rounded target.

    All blocks but the last of a source are full. The target's whole passes take
    every block; in the pass after them, slots go on until its words are
    reached, which is one later if the short block came among them.
    """
    size, full = F.col("source_size"), F.lit(BLOCK_WORDS)
    blocks = F.ceil(size / full).cast("long")
    want = F.least(F.round("target").cast("long"), size * MOST_PASSES)
    x = sources.withColumns({"blocks": blocks, "_want": F.when(size > 0, want).otherwise(0)})
    x = x.withColumns({"_passes": F.floor(F.col("_want") / F.greatest(size, F.lit(1))).cast("long"),
                       "_short": F.col("blocks") * full - size})
    x = x.withColumn("_rest", F.col("_want") - F.col("_passes") * size)
    place = permuted(F.col("blocks") - 1, F.greatest("blocks", F.lit(1)), F.col("src.none"), F.col("src.name"),
                     F.col("_passes").cast("int"), back=True)
    x = x.withColumn("_place", place)
    early = F.ceil(F.col("_rest") / full).cast("long")
    x = x.withColumn("_more", F.when(F.col("_place") < early, F.ceil((F.col("_rest") + F.col("_short")) / full).cast("long")).otherwise(early))
    before = (F.col("_more") - 1) * full - F.when(F.col("_place") < F.col("_more") - 1, F.col("_short")).otherwise(0)
    return x.withColumns({
        "slots": F.col("_passes") * F.col("blocks") + F.col("_more"),
        "last_words": F.when(F.col("_more") > 0, F.col("_rest") - before).otherwise(full)}).drop(
        "_want", "_passes", "_short", "_rest", "_place", "_more")


def _row_key() -> list[Column]:
    """128 bits that name a row by its id, source and text."""
    return [F.xxhash64("doc_id", "source", "text").alias("_k1"),
            F.xxhash64("text", F.lit("2"), "source", "doc_id").alias("_k2")]


def packed(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(docs, sources, pieces): docs with size, src and word offset in the
    source; sources with size, target, blocks and slots; pieces
    (src, block, doc key, words of the document in the block, first of them,
    place in the block)."""
    docs = df.select("doc_id", F.struct(F.col("source").isNull().alias("none"),
                                        F.coalesce("source", F.lit("")).alias("name")).alias("src"),
                     word_count(F.col("text")).alias("size"), *_row_key())
    docs = store(docs.withColumn("_ord", order_key("doc_id", F.col("_k1"), F.col("_k2"))), "mix-docs")
    sources = source_targets(docs.groupBy("src").agg(F.sum("size").alias("source_size")))
    sources = store(with_slots(sources), "mix-sources")
    docs = store(running_total(docs, ["src"], "_ord", ["_k1", "_k2"], "size", "offset"), "mix-offsets")
    last = F.col("offset") + F.col("size")
    pieces = (docs.where("size > 0")
              .select("src", "doc_id", "_k1", "_k2", "offset", last.alias("_end"),
                      F.explode(F.sequence(F.floor(F.col("offset") / BLOCK_WORDS),
                                           F.floor((last - 1) / BLOCK_WORDS))).alias("block")))
    start = F.greatest(F.col("offset"), F.col("block") * BLOCK_WORDS)
    end = F.least(F.col("_end"), (F.col("block") + 1) * BLOCK_WORDS)
    pieces = pieces.select("src", "block", "doc_id", "_k1", "_k2", F.col("offset").alias("doc_offset"),
                           (start - F.col("offset")).alias("first"), (end - start).alias("words"),
                           (start - F.col("block") * BLOCK_WORDS).alias("at"))
    return docs, sources, pieces


def shard_draws(sources: DataFrame) -> DataFrame:
    """(src, shard, start, count): the slots start..start+count-1 of a source
    that an output shard takes. Counts are multinomial per shard; each
    source's total is then made exactly its ``slots``."""
    spark = sources.sparkSession
    total = sources.agg(F.sum("slots")).first()[0] or 0
    every = Window.partitionBy(F.lit(0)).orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    edge = sources.where("slots > 0").select(
        "src", "slots", F.sum("slots").over(every).alias("_to"))
    at = lambda c: F.round(c * F.lit(DRAW_BINS) / F.lit(float(max(total, 1)))).cast("long")
    bins = edge.select("src", at(F.col("_to") - F.col("slots")).alias("_a"), at(F.col("_to")).alias("_b"))
    bins = bins.where("_b > _a").select("src", F.explode(F.sequence(F.col("_a"), F.col("_b") - 1)).alias("bin"))
    drawn = (spark.range(total)
             .select(F.floor(F.col("id") * F.lit(OUTPUT_SHARDS) / F.lit(max(total, 1))).alias("shard"),
                     F.pmod(F.xxhash64(F.lit("draw"), "id"), F.lit(DRAW_BINS)).alias("bin"))
             .join(F.broadcast(bins), "bin")  # at most DRAW_BINS rows
             .groupBy("src", "shard").agg(F.count(F.lit(1)).alias("count")))
    sofar = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = store(drawn.withColumn("start", F.coalesce(F.sum("count").over(sofar), F.lit(0)))
                  .join(sources.select("src", "slots"), "src"), "mix-draws")
    kept = F.greatest(F.lit(0), F.least(F.col("count"), F.col("slots") - F.col("start")))
    drawn = drawn.withColumn("kept", kept)
    # repair: unit i of the surplus goes to unit i of the shortfall
    number = lambda df, *o: df.withColumn("_to", F.sum("n").over(
        Window.partitionBy(F.lit(0)).orderBy(*o).rowsBetween(Window.unboundedPreceding, 0)))
    units = lambda df: df.where("n > 0").withColumn(
        "unit", F.explode(F.sequence(F.col("_to") - F.col("n"), F.col("_to") - 1)))
    surplus = units(number(drawn.groupBy("shard").agg(F.sum(F.col("count") - F.col("kept")).alias("n")), "shard"))
    got = drawn.groupBy("src").agg(F.sum("kept").alias("got"))
    short = (sources.join(got, "src", "left").withColumn("got", F.coalesce("got", F.lit(0)))
             .select("src", "got", (F.col("slots") - F.col("got")).alias("n")))
    short = units(number(short, "src")).withColumn("slot", F.col("got") + F.col("unit") - (F.col("_to") - F.col("n")))
    more = (surplus.select("unit", "shard").hint("merge").join(short.select("unit", "src", "slot"), "unit")
            .select("src", "shard", F.col("slot").alias("start"), F.lit(1).cast("long").alias("count")))
    return (drawn.where("kept > 0").select("src", "shard", "start", F.col("kept").alias("count"))
            .unionByName(more))


def mixed_slots(sources: DataFrame) -> DataFrame:
    """(src, shard, slot, pass, block, most): which block every slot of the mix
    takes, and how many of its words."""
    # the draws are few rows that stand for many slots: deal them out in ranges first
    ranges = shard_draws(sources).select("src", "shard", (F.col("start") + F.col("count")).alias("_to"), F.explode(
        F.sequence("start", F.col("start") + F.col("count") - 1, F.lit(SLOTS_A_RANGE).cast("long"))).alias("start"))
    partitions = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("start") + SLOTS_A_RANGE, "_to") - 1
    slots = (ranges.join(sources.select("src", "blocks", "slots", "last_words"), "src").repartition(partitions, "src", "shard", "start")
             .select("src", "shard", "blocks", "slots", "last_words", F.explode(F.sequence("start", last)).alias("slot")))
    turn = F.floor(F.col("slot") / F.col("blocks"))
    return slots.withColumn("pass", turn.cast("int")).select(
        "src", "shard", "slot", "pass",
        permuted(F.col("slot") % F.col("blocks"), F.col("blocks"),
                 F.col("src.none"), F.col("src.name"), F.col("pass")).alias("block"),
        F.when(F.col("slot") == F.col("slots") - 1, F.col("last_words")).otherwise(BLOCK_WORDS).alias("most"))


def mix(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(docs, sources, taken): ``taken`` has one row per slot and document in
    its block: src, shard, slot, pass, block, doc_id, _k1, _k2, doc_offset, first, words."""
    docs, sources, pieces = packed(df)
    # both sides are made from few rows: by the size of those the planner would broadcast all slots or pieces
    taken = mixed_slots(sources).hint("merge").join(pieces, ["src", "block"]).where(F.col("at") < F.col("most"))
    taken = taken.withColumn("words", F.least("words", F.col("most") - F.col("at")).cast("long")).drop("at", "most")
    return docs, sources, taken


def mix_report(df: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's) and taken."""
    docs, sources, taken = mix(df)
    # a document is its source and place there; empty ones are never taken
    took = taken.groupBy("src", "doc_offset").agg(F.sum("words").alias("taken"))
    return (docs.join(took.withColumnRenamed("doc_offset", "offset").withColumn("_some", F.lit(True)),
                      ["src", "offset"], "left")
            .join(sources.select("src", "source_size", "target"), "src")
            .select("doc_id", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken")))


def mix_documents(df: DataFrame) -> DataFrame:
    """The mix as documents, with the columns of ``df``: per document and pass
    one row with the words that the pass takes, in order; runs of successive
    blocks keep the text between them, a gap becomes one space. A document of
    which nothing is taken has no row. ``n_chars``, if there, is recounted."""
    docs, _, taken = mix(df)
    ranges = (taken.groupBy("_k1", "_k2", "doc_offset", "pass").agg(
        F.array_sort(F.collect_list(F.struct("first", "words"))).alias("_ranges"))  # of one document
        .drop("doc_offset", "pass"))
    rows = df.select(whole_row(df), *_row_key())  # the text goes along once, inside the row
    # repeated rows have their ranges under one key
    if not docs.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("m")).where("m > 1").isEmpty():
        rows = rows.groupBy("_k1", "_k2").agg(F.first("_row").alias("_row"))
    joined = rows.join(ranges, ["_k1", "_k2"])
    # the text as words with the white space that follows each
    cut = F.split(F.regexp_replace(F.col("_row.text"), "^" + SPACES, ""),
                  r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    piece = let(cut, lambda w: F.array_join(F.flatten(F.transform(
        F.col("_ranges"), lambda r: F.slice(w, (r["first"] + 1).cast("int"), r["words"].cast("int")))), ""))
    out = joined.select("_row", F.regexp_replace(piece, SPACES + "$", "").alias("_text"))
    own = {"text": F.col("_text")}
    if "n_chars" in df.columns:
        own["n_chars"] = F.char_length("_text").cast(df.schema["n_chars"].dataType)
    return out.select(*[own.get(c, F.col("_row")[c]).alias(c) for c in df.columns])
