"""Mixing sources to target weights, by DataFrame and SQL functions only.

The words of each source form one stream, cut into blocks of up to ``block`` words, shorter ones in small sources, down to single words.
The mix is a row of slots, one block each, dealt to output shards of ``shard`` slots. For every shard the number of slots of each source is drawn from
a multinomial distribution over the sources' shares: each slot inverts the cumulated shares at a pseudorandom
number. What the draws of all shards give a source beyond its target goes, slot by slot, to sources that came short,
so that totals meet the targets to within a block. A source's slots are numbered through all shards; number *i* is
mapped to block ``permutation(i mod blocks)`` of the source, a Feistel network keyed by source and pass, so that each
block is used once before any is used again. Joining blocks by their index gives the words. Sources of single-word blocks
share what rounding leaves by largest remainder; others miss their target by half a block at most, under one per cent of their size.

A document's place in its source's stream follows from prefix sums in two levels: over small hash buckets of
documents, then within each bucket, so that no source, however large, is ordered in one task. Rows that are equal, or share
an id and a text, are one row with a number of copies until then, and are told apart in chunks of ``CHUNK``. What reaches a
single task is one row for each source (shares, the trade between sources) and one for each bucket.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its own, last in
order; rows that are equal, or share a doc_id, count as documents of their own; no words at all, or an empty
table, give ``taken`` 0 everywhere or no rows; columns beside doc_id, text and source are left alone. The seed fixes the
result, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import stored, table

#: Runs of anything but ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"
BLOCK = 32
SHARD = 1024
BUCKET = 4096
CHUNK = 4096
CAP = 3
SEED = 20_240_601


def count_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def _key(source):
    """Groups sources; null is one of them."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def source_targets(sizes: DataFrame, weights=(1, 2, 3), cap: int = CAP) -> DataFrame:
    """One row for each source: key, source_size, target.

    Targets share all words by weight but stop at ``cap`` times the source's size; the excess is shared again
    among the others, until none is above. Sources in order of size per weight settle from the smallest: the
    first k are at their cap where the level that the rest would get still exceeds the k-th's own.
    """
    cycle = F.array(*map(F.lit, weights))
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    # code points and UTF-8 bytes sort alike, and Spark compares strings by bytes
    rank = F.row_number().over(Window.orderBy(F.col("key").startswith("n"), "key"))
    sources = sources.withColumn("rank", rank)
    sources = sources.withColumn(
        "weight", F.get(cycle, ((F.col("rank") - 1) % len(weights)).cast("int")).cast("double")
    )
    level = cap * F.col("source_size") / F.col("weight")
    order = Window.orderBy("level", "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    sources = sources.withColumn("level", level).select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)).alias("settled"),
        F.sum("weight").over(after).alias("open_weight"),
    )
    share = (F.col("total") - F.col("settled")) / F.col("open_weight")
    sources = sources.withColumn("share", share)
    final = F.max(F.when(F.col("share") <= F.col("level"), F.col("share"))).over(everything)
    target = F.least(cap * F.col("source_size").cast("double"), F.col("final") * F.col("weight"))
    return sources.withColumn("final", final).select(
        "key", "rank", "source_size", "total", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def _uniform(*columns):
    """A number in [0, 1) that depends on the columns alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *columns), 11)).cast("double") / F.lit(float(1 << 53))


def _half(left, right, size, turn: int, *keys):
    """One side of a Feistel round: ``left`` moved, within ``size``, by a hash of the other side."""
    return F.pmod(left + F.pmod(F.xxhash64(F.lit(SEED + turn), right, *keys), size), size)


def permuted(rows: DataFrame, index, size, *keys, out: str) -> DataFrame:
    """Adds ``out``, a bijection of 0 .. size - 1 keyed by ``keys``: a Feistel network over pairs, walking on from places beyond ``size``.

    Numbers are pairs of two digits, to bases that are about the square root of the size. Fewer than one number in four, for
    large sizes one in the square root, lies beyond; it is sent through the network again until it does not. No more of them than
    the first base can follow each other, so 64 times are enough for certain up to a size of 4,096, and beyond it but for less than one in
    64 ** 64.
    """
    columns, one, other = rows.columns, F.col("_one"), F.col("_other")
    root = F.ceil(F.sqrt(size.cast("double"))).cast("long")
    # column by column, so that no expression holds another one twice
    rows = rows.withColumns({"_size": size, "_index": index % size, "_root": root})
    rows = rows.withColumn("_one", F.greatest(F.col("_root") + F.when(F.col("_root") * F.col("_root") < F.col("_size"), 1).otherwise(0), F.lit(1)))
    rows = rows.withColumn("_other", F.greatest(F.ceil(F.col("_size") / one).cast("long"), F.lit(1)))
    rows = rows.withColumns({"_left": F.col("_index") % one, "_right": F.floor(F.col("_index") / one).cast("long")})
    for turn in (11, 13):
        rows = rows.withColumn("_left", _half(F.col("_left"), F.col("_right"), one, turn, *keys))
        rows = rows.withColumn("_right", _half(F.col("_right"), F.col("_left"), other, turn + 1, *keys))
    rows = rows.withColumn("_first", F.col("_right") * one + F.col("_left"))

    def again(at):
        left, right = at % one, F.floor(at / one).cast("long")
        for turn in (11, 13):
            left = _half(left, right, one, turn, *keys)
            right = _half(right, left, other, turn + 1, *keys)
        return right * one + left

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(64)), F.col("_first"), lambda at, _: F.when(at < F.col("_size"), at).otherwise(again(at))
    )
    found = F.when(F.col("_first") < F.col("_size"), F.col("_first")).otherwise(walked)
    return rows.select(*[c for c in columns if c != out], found.alias(out))


#: What rows that are alike share: two hashes of their doc_id, source and the columns that tell rows of one doc_id apart.
ALIKE = ["a", "b"]


def _alike(columns: list[str]) -> list:
    held = [F.col(f"`{c}`") for c in dict.fromkeys(["doc_id", "source", *columns])]
    # a null hashes as nothing, so it is told apart by which columns are null
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in held])
    return [F.xxhash64(nulls, *held).alias("a"), F.xxhash64(F.lit(SEED), nulls, *held).alias("b")]


def sized(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """a, b, doc_id, key, size, copies: one narrow row for all rows alike in doc_id, source and ``columns`` (the text)."""
    rows = docs.select(
        *_alike(columns or ["text"]), "doc_id", _key(F.col("source")).alias("key"), count_words(F.col("text")).alias("size")
    )
    return rows.groupBy(*ALIKE, "doc_id", "key", "size").agg(F.count("*").alias("copies"))


def placed(sizes: DataFrame, documents: int) -> DataFrame:
    """a, b, chunk, copy, doc_id, key, size, offset: a row for each document; offset is the number of words before it in its source's
    stream."""
    buckets = 1 << max(0, (documents // BUCKET).bit_length())
    chunks = sizes.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (copies - 1) div {CHUNK})")))
    chunks = chunks.withColumn("copies", F.least(F.lit(CHUNK).cast("long"), F.col("copies") - F.col("chunk") * CHUNK))
    bucket = F.pmod(F.xxhash64(F.lit(SEED + 3), *ALIKE, "chunk"), F.lit(buckets))
    rows = chunks.withColumn("bucket", bucket).withColumn("words", F.col("size") * F.col("copies"))
    sums = rows.groupBy("key", "bucket").agg(F.sum("words").alias("words"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("key", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("key", "bucket").orderBy("doc_id", *ALIKE, "chunk")
    inside = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("inside", inside).join(starts, ["key", "bucket"])
    rows = rows.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    offset = F.col("start") + F.col("inside") + F.col("copy") * F.col("size")
    return rows.select(*ROW, "doc_id", "key", "size", offset.alias("offset"))


def quotas(targets: DataFrame, block: int) -> DataFrame:
    """Adds width (words of a block), blocks (of one pass) and quota (slots due).

    The quota is the target in blocks of the source's mean length; with blocks of one word it is the target itself, rounded so that
    all such sources together get what they are due.
    """
    size, target = F.col("source_size"), F.col("target")
    width = F.greatest(F.least(F.lit(block), F.expr("source_size div 64")), F.lit(1)).cast("long")
    rows = targets.withColumn("width", width).withColumn("blocks", F.ceil(size / F.col("width")).cast("long"))
    single = F.col("width") == 1
    part = F.when(single, target - F.floor(target))
    ranked = Window.partitionBy("width").orderBy(F.desc("part"), "rank")
    extra = F.when(F.row_number().over(ranked) <= F.round(F.sum("part").over(Window.partitionBy("width"))), 1).otherwise(0)
    rows = rows.withColumn("part", part).withColumn("extra", extra)
    quota = F.when(single, F.floor(target) + F.col("extra")).otherwise(F.round(F.try_divide(target * F.col("blocks"), size)))
    return rows.withColumn("quota", F.coalesce(quota.cast("long"), F.lit(0))).drop("part", "extra")


def _intervals(lines: DataFrame, count: str, first: str) -> DataFrame:
    """Sources laid end to end on a line, each over ``count`` places from ``first``."""
    upto = F.sum(count).over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn(first, upto - F.col(count))


def draw_slots(lines: DataFrame, slots: int, sources: int, shard: int) -> DataFrame:
    """key, shard, number: a multinomial draw for each shard, then slots beyond quotas traded to short sources.

    ``lines`` has a row for each source: key, rank, quota. Numbers of a source run from 0 without a gap.
    """
    spark = lines.sparkSession
    width = -(-slots // (4 * sources + 4096))
    line = _intervals(lines.where("quota > 0"), "quota", "from")
    cells = line.withColumn(
        "cell", F.explode(F.expr(f"sequence(`from` div {width}, (`from` + quota - 1) div {width})"))
    ).select("key", "from", "quota", "cell")
    point = F.floor(_uniform("id") * slots)
    drawn = spark.range(slots).select(F.expr(f"id div {shard}").alias("shard"), point.alias("point"))
    hit = (F.col("point") >= F.col("from")) & (F.col("point") < F.col("from") + F.col("quota"))
    counts = (
        drawn.withColumn("cell", F.expr(f"point div {width}"))
        .join(cells, "cell")
        .where(hit)
        .groupBy("key", "shard")
        .count()
        .withColumn("span", F.expr("shard div 1024"))
    )
    counts = stored(counts, "mix-draws", slots // shard * min(sources, shard))
    earlier = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.groupBy("key", "span").agg(F.sum("count").alias("drawn"))
    spans = spans.select("key", "span", F.coalesce(F.sum("drawn").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("key", "span").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        counts.withColumn("inside", F.coalesce(F.sum("count").over(within), F.lit(0)))
        .join(spans, ["key", "span"])
        .withColumn("first", F.col("start") + F.col("inside"))
        .select("key", "shard", F.explode(F.expr("sequence(first, first + count - 1)")).alias("number"))
    )
    totals = counts.groupBy("key").agg(F.sum("count").alias("drawn"))
    ledger = (
        lines.join(totals, "key", "left")
        .withColumn("drawn", F.coalesce("drawn", F.lit(0)))
        .withColumn("excess", F.greatest(F.col("drawn") - F.col("quota"), F.lit(0)))
        .withColumn("short", F.greatest(F.col("quota") - F.col("drawn"), F.lit(0)))
    )
    ledger = _intervals(_intervals(ledger, "excess", "excess_from"), "short", "short_from")
    offers = ledger.where("short > 0").select(
        F.col("key").alias("to"), F.posexplode(F.expr("sequence(drawn, quota - 1)")).alias("i", "to_number"),
        "short_from",
    ).select("to", "to_number", (F.col("short_from") + F.col("i")).alias("trade"))
    # renumbered at random, so that the slots to trade are spread over all shards
    slots_of = numbered.join(ledger.select("key", "quota", "drawn", "excess_from"), "key")
    slots_of = permuted(slots_of, F.col("number"), F.col("drawn"), "key", F.lit(-1).cast("long"), out="number")
    kept = slots_of.where("number < quota").select("key", "shard", "number")
    traded = slots_of.where("number >= quota").select(
        "shard", (F.col("excess_from") + F.col("number") - F.col("quota")).alias("trade")
    )
    return kept.unionByName(
        traded.join(offers, "trade").select(F.col("to").alias("key"), "shard", F.col("to_number").alias("number"))
    )


def plan(
    docs: DataFrame, block: int = BLOCK, shard: int = SHARD, columns: list[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as three frames: placed documents; sources with targets; slots (key, shard, number, block)."""
    documents = docs.count()
    sizes = stored(sized(docs, columns), "mix-sizes", documents)
    words = sizes.withColumn("size", F.col("size") * F.col("copies"))
    lines = stored(quotas(source_targets(words), block), "mix-sources", 0)
    slots, sources = lines.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count("*")).first()
    drawn = draw_slots(lines.select("key", "rank", "quota"), slots, sources, shard) if slots else None
    if drawn is None:
        drawn = lines.select("key", F.lit(0).cast("long").alias("shard"), F.col("quota").alias("number")).limit(0)
    blocks = drawn.join(lines.select("key", "blocks"), "key")
    blocks = permuted(blocks, F.col("number"), F.col("blocks"), "key", F.expr("number div blocks"), out="block")
    places = stored(placed(sizes, documents), "mix-places", documents)
    return places, lines, blocks.select("key", "shard", "number", "block")


#: What tells documents apart once they are placed.
ROW = [*ALIKE, "chunk", "copy"]


def pieces(docs: DataFrame, lines: DataFrame, slots: DataFrame) -> DataFrame:
    """Each document's parts in blocks: block, skip (words of it before the part), words, times taken."""
    rows = docs.where("size > 0").join(lines.select("key", "width"), "key")
    parts = F.expr("sequence(offset div width, (offset + size - 1) div width)")
    rows = rows.withColumn("block", F.explode(parts))
    begin = F.greatest(F.col("offset"), F.col("block") * F.col("width"))
    end = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * F.col("width"))
    rows = rows.select(*ROW, "key", "block", (begin - F.col("offset")).alias("skip"), (end - begin).alias("words"))
    times = slots.groupBy("key", "block").agg(F.count("*").alias("times"))
    return rows.join(times, ["key", "block"])


def taken_words(docs: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """doc_id, size, source_size, target, taken: a row for each document."""
    rows, lines, slots = plan(docs, block, shard)
    taken = pieces(rows, lines, slots).groupBy(*ROW).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = rows.join(taken, ROW, "left").join(lines.select("key", "source_size", "target"), "key")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each time words of a document are taken.

    The r-th row of a document holds the words that are taken r times or more, in order. A row that holds all of
    them keeps the text as it is; in others, words are joined by blanks. ``n_chars``, where there is one, follows the text.
    """
    rows, lines, slots = plan(docs, block, shard, docs.columns)
    parts = F.array_sort(F.collect_list(F.struct("skip", "words", "times")))
    taken = stored(pieces(rows, lines, slots).groupBy(*ROW).agg(parts.alias("parts")), "mix-taken", rows.count())
    texts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_alike(docs.columns), count_words(F.col("text")).alias("size")
    )
    # rows without a like are joined as they are; rows that are alike are one, and once for each chunk of copies
    many = stored(rows.where("copy > 0").select(*ALIKE).distinct(), "mix-alike", 0)
    joined = texts.join(taken, ALIKE).select("row", "size", "parts")
    if not many.isEmpty():
        joined = texts.join(taken.join(many, ALIKE, "left_anti"), ALIKE).select("row", "size", "parts")
        chunks = rows.join(many, ALIKE).select(*ALIKE, "chunk").distinct()
        one = texts.join(many, ALIKE, "left_semi").groupBy(*ALIKE, "size").agg(F.first("row").alias("row")).join(chunks, ALIKE)
        joined = joined.unionByName(one.join(taken, [*ALIKE, "chunk"]).select("row", "size", "parts"))
    # words are cut once for each document, below the explode, and only where a pass does not hold all of them
    even = F.expr("array_min(transform(parts, p -> p.times)) = array_max(transform(parts, p -> p.times))")
    held = F.expr("aggregate(parts, 0L, (n, p) -> n + p.words)")
    words = F.regexp_extract_all("row.text", F.lit(WORDS), F.lit(0))
    joined = joined.withColumn("all", F.when(~(even & (held == F.col("size"))), words))
    times = joined.withColumn("pass", F.explode(F.expr("sequence(1L, array_max(transform(parts, p -> p.times)))")))
    chosen = times.withColumn("parts", F.expr("filter(parts, p -> p.times >= pass)"))
    cut = chosen.withColumn(
        "cut",
        F.when(
            held < F.col("size"),
            F.expr("array_join(flatten(transform(parts, p -> slice(all, int(p.skip) + 1, int(p.words)))), ' ')"),
        ),
    )
    text = F.coalesce("cut", "row.text")
    new = {"text": text, "n_chars": F.length(text).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))
