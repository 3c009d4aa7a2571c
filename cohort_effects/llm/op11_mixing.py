"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its share by weight of the words to take, no more than
``most`` times its size; what is over goes to the other sources by weight until
none is above.  Every document of a source is due the same expected number of
copies, target / size.  The whole part is certain; the fractions are rounded
dependently, so the words taken stay what they are while single fractions become
0 or 1:

Two documents of sizes s, t and fractions p, q exchange words: either p grows and
q shrinks, by as many words as bring the first of them to 0 or 1, or the other
way round, with the chances that keep both expectations.  One of the two is
settled, the other goes on to the next document.  Sums over a source stay exact
until its last document, which goes to the nearer side.

The exchange runs along a reduction tree: leaves of about ``LEAF`` documents of
one source and size class (powers of two), dealt by hash, leave one document
each; these meet in groups of ``FAN`` until a class has one.  About ``RESERVE``
documents of each class wait for the source's root, where all that is left is
settled from the largest to the smallest size, so large documents are balanced
by smaller ones and the last one has few words.  Only DataFrame functions;
a group of any size is split over leaves, and a leaf is a bounded array.

All draws are hashes of the documents, so reruns agree however the rows are
dealt.  Edge cases: null and wordless texts have size 0 and take nothing; a null
source is a source, ordered last; a source without words has target 0; rows
alike in id, source and text are documents of their own (numbered); null ids are
ids; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.tables import materialise, read
from cohort_effects.operators.ranges import matched, positions

WEIGHTS = (5, 2, 1)
LEAF, FAN, RESERVE = 64, 64, 64
FEW = 1 << 16  # rows of a table of sources, or of their size classes, that is broadcast
RUN = 4096  # equal rows are numbered in runs of this many
WORD, BLANKS = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
ITEM = "struct<size:bigint,h:bigint,doc_id:bigint,text_hash:bigint,mass:double>"


def word_count(text: Column) -> Column:
    """Words of a text, without an array of them; null has none."""
    return F.coalesce(F.octet_length(F.regexp_replace(F.regexp_replace(text, WORD, "x"), BLANKS, "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``source``, ``source_size``
    (one row each).  ``level`` is words a unit of weight; sources at their limit
    leave it to the others, so it rises until no other reaches its limit."""
    ranked = positions(sizes, [], [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("_place", F.lit(len(weights))) + 1).cast("int"))
    ranked = materialise(ranked.select("source", "source_size", weight.alias("weight")))
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    limit, level, held = F.col("source_size") * F.lit(most), 0.0, None
    while True:
        full = limit < F.col("weight") * F.lit(level)
        at = ranked.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)).alias("held"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("free")
        ).first()
        if at.held == held or not at.free:
            break
        held, level = at.held, (total - at.held) / at.free
    return ranked.select("source", "source_size", F.least(limit.cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def _uniform(*cols: Column) -> Column:
    """A number in [0, 1) from the hash of ``cols``."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def _exchange(seed: int):
    """Merges the next document into the held one: ``(held, done)``."""

    def merge(state: Column, x: Column) -> Column:
        held = state["held"]
        up = F.least(held["size"] - held["mass"], x["mass"])  # words the held one can gain
        down = F.least(held["mass"], x["size"] - x["mass"])
        grows = _uniform(F.lit(seed), held["h"], x["h"]) * (up + down) < down
        settles = F.when(grows, held["size"] - held["mass"] <= x["mass"]).otherwise(held["mass"] <= x["size"] - x["mass"])
        mass = F.when(settles, F.when(grows, x["mass"] - up).otherwise(x["mass"] + down)).otherwise(
            F.when(grows, held["mass"] + up).otherwise(held["mass"] - down)
        )
        goes, stays = F.when(settles, held).otherwise(x), F.when(settles, x).otherwise(held)
        extra = (settles == grows).cast("int")  # the held one filled, or the other one did
        return F.struct(
            _item(stays, mass).alias("held"),
            F.array_append(state["done"], F.struct(goes.alias("item"), extra.alias("extra"))).alias("done"),
        )

    return merge


def _item(x: Column, mass: Column) -> Column:
    return F.struct(x["size"].alias("size"), x["h"].alias("h"), x["doc_id"].alias("doc_id"), x["text_hash"].alias("text_hash"), mass.alias("mass"))


def _settled(nodes: DataFrame, by: list[str], seed: int) -> DataFrame:
    """One chain of exchanges a node: ``by``, ``item`` and ``extra`` (0, 1, or
    null for the one document left over)."""
    chain = nodes.groupBy(*by).agg(F.sort_array(F.collect_list("item"), asc=False).alias("_x"))
    start = F.struct(F.col("_x")[0].alias("held"), F.array().cast(f"array<struct<item:{ITEM},extra:int>>").alias("done"))
    got = F.aggregate(F.slice("_x", F.lit(2), F.size("_x")), start, _exchange(seed))
    left = F.struct(F.col("_got.held").alias("item"), F.lit(None).cast("int").alias("extra"))
    return chain.withColumn("_got", got).select(*by, F.inline(F.array_append(F.col("_got.done"), left)))


def _told(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins a checkpointed table of sources: broadcast while it has no more than
    ``FEW`` rows, so that a source with most documents is not one task, else by
    shuffle, where AQE splits it."""
    return matched(rows, F.broadcast(table) if table.count() <= FEW else table, keys, how)


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 11) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``text_hash`` (one row a document) with
    ``source_size``, ``target`` and ``copies``."""
    wanted = materialise(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    run = F.expr(f"sequence(0L, (n - 1) div {RUN})")
    inside = F.expr(f"sequence(run * {RUN}, least(n, (run + 1) * {RUN}) - 1)")
    items = (
        rows.groupBy("source", "doc_id", "size", "text_hash").agg(F.count("*").alias("n"))
        .withColumn("run", F.explode(run)).withColumn("number", F.explode(inside))
        .select(
            "source", "doc_id", "size", "text_hash", F.expr("length(bin(size))").alias("class"),
            F.xxhash64(F.lit(seed), F.lit(0), "doc_id", "size", "text_hash", "number").alias("h"),
        )
    )
    due = wanted.select("source", (F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))).alias("due"))
    due = due.select("source", F.coalesce(F.floor("due"), F.lit(0)).alias("whole"), F.coalesce(F.col("due") - F.floor("due"), F.lit(0.0)).alias("fraction"))
    due = materialise(matched(wanted, due, ["source"]))
    classes = matched(
        rows.where("size > 0").groupBy("source", F.expr("length(bin(size))").alias("class")).agg(F.count("*").alias("n")), due, ["source"]
    ).select("source", "class", "fraction", F.ceil(F.col("n") / LEAF).alias("leaves"), (F.lit(float(RESERVE)) / F.col("n")).alias("waits"))
    classes = materialise(classes)
    deepest = classes.agg(F.max("leaves")).first()[0] or 1
    dealt = _told(items, classes, ["source", "class"], "left")
    open_ = dealt.where("size > 0 and fraction > 0")
    root = _uniform(F.lit(seed), F.lit(1), F.col("h")) < F.col("waits")
    open_ = open_.select(
        "source", "class", F.when(root, F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.lit(seed), F.lit(2), "h"), "leaves")).cast("long").alias("node"),
        _item({c: F.col(c) for c in ("size", "h", "doc_id", "text_hash")}, F.col("size") * F.col("fraction")).alias("item"),
    )
    settled = [dealt.where("size = 0 or fraction = 0").select("source", "doc_id", "size", "text_hash", F.lit(0).alias("extra"))]

    def keep(done: DataFrame) -> None:
        settled.append(done.where("extra is not null").select("source", "item.doc_id", "item.size", "item.text_hash", "extra"))

    # the reserve stands aside; a leaf's survivor climbs until its class has one
    waiting = [open_.where("node = -1").select("source", "item")]
    level, parts = materialise(_settled(open_.where("node >= 0"), ["source", "class", "node"], seed)), deepest
    keep(level)
    while parts > 1:
        nodes = level.where("extra is null").withColumn("node", F.expr(f"node div {FAN}"))
        level, parts = materialise(_settled(nodes, ["source", "class", "node"], seed)), -(-parts // FAN)
        keep(level)
    waiting.append(level.where("extra is null").select("source", "item"))
    last = materialise(_settled(waiting[0].unionByName(waiting[1]), ["source"], seed))
    nearest = F.coalesce("extra", (2 * F.col("item.mass") >= F.col("item.size")).cast("int"))
    keep(last.withColumn("extra", nearest))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return _told(out, due, ["source"]).select(
        "doc_id", "source", "size", "text_hash", "source_size", "target", (F.col("whole") + F.col("extra")).cast("long").alias("copies")
    )


def sized(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"), F.xxhash64(text).alias("text_hash"),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``mix`` of a documents table: sizes in words, one scan of the texts."""
    return mix(materialise(sized(docs)), **options)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken (rows
    alike in id, source and text are taken as one of them)."""
    taken = mix_documents(docs, **options).groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    taken = taken.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "text_hash")], "_copies")
    keys = {"_doc_id": F.col("doc_id").cast("long"), "_source": F.col("source").cast("string"), "_text_hash": F.xxhash64(F.col("text").cast("string"))}
    one = docs.select(F.struct(*docs.columns).alias("_row"), *[v.alias(f"{k}_own") for k, v in keys.items()]).dropDuplicates([f"{k}_own" for k in keys])
    on = [F.col(f"{k}_own").eqNullSafe(F.col(k)) for k in keys]
    return one.join(taken, on[0] & on[1] & on[2]).select("_row.*", F.explode(F.expr("sequence(1L, _copies)")).alias("_time")).drop("_time")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
