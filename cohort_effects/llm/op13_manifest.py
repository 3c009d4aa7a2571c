"""Merkle dataset manifest by nested-struct rollup.

Rows are leaves: the SHA-256 of their fields.  Within a group (a language) the
leaves stand in order; every ``FAN`` consecutive nodes become the hash of their
hex digests until one is left, the group's subroot; the subroots in order give
the root the same way.

A leaf's rank within its group is found over ranges (``operators.ranges``), so
a group that holds most rows is spread.  The rank's digits to base ``FAN`` are
columns; a *block* is ``FAN ** DIGITS`` neighbouring leaves.  After one exchange
by (group, block), the digit columns are grouped away one after the other, each
grouping nesting the structs of the one before, down to one row a block.  The
blocks' digests are leaves of the same operator one storey up (512 times fewer
rows a storey), and the groups' subroots are those of the last.  Each block
learns the path above it in one join (a row a block, no key twice); a transform
over the nested structs then writes every leaf's siblings and an explode emits
them, without a join for the leaves.  Only DataFrame functions.

Edge cases: a null field is ``-``; a null group is a group and comes first; null
ids come first; rows alike in id stand by their digest, so the result does not
depend on the order of equal rows, and each repeated row is a leaf of its own;
an empty table gives no rows; a lone leaf is its subroot, a lone subroot the
root.  Columns beside the fields are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_effects.llm.tables import held_out, materialise, read
from cohort_effects.operators.ranges import positions

FAN = 8
DIGITS = 3  # a block holds FAN ** DIGITS = 512 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(fields: dict[str, Column]) -> Column:
    """SHA-256 of the fields one after the other, each ``-`` if null, else its
    UTF-8 byte count, a colon and its value."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _height(n: Column) -> Column:
    """Storeys above ``n`` leaves: the least h with FAN ** h >= n."""
    out = F.lit(0)
    for k in range(20):
        out = out + (n > F.lit(FAN**k)).cast("int")
    return out


def _rolled(nodes: DataFrame) -> DataFrame:
    """One row a block: ``grp``, ``block``, ``height``, ``digest`` of the node
    that the block has become, and ``kids``, its tree of structs."""
    size = FAN**DIGITS
    digits = [F.pmod(F.expr(f"rank div {FAN**k}"), F.lit(FAN)).cast("int").alias(f"d{k}") for k in range(DIGITS)]
    out = nodes.select("grp", F.expr(f"rank div {size}").alias("block"), *digits, "height", "digest", "body").repartition("grp", "block")
    kept = "body"
    for k in range(DIGITS):
        left = [f"d{j}" for j in range(k + 1, DIGITS)]
        out = (
            out.groupBy("grp", "block", *left)
            .agg(F.max("height").alias("height"), F.array_sort(F.collect_list(F.struct(f"d{k}", "digest", kept))).alias("kids"))
            .withColumn(
                "digest",
                # a group that needs no storey here has one node
                F.when(F.col("height") > k, F.sha2(F.array_join("kids.digest", "").cast("binary"), 256)).otherwise(F.col("kids")[0]["digest"]),
            )
        )
        kept = "kids"
    return out.select("grp", "block", "height", "digest", "kids")


def _side(kids: Column, at: Column) -> Column:
    return F.struct(
        F.array_join(F.slice(kids["digest"], 1, at), "").alias("left"),
        F.array_join(F.slice(kids["digest"], at + 2, FAN), "").alias("right"),
    )


def _unfolded(kids: Column, storey: int, above: list[Column]) -> Column:
    """Array of (digest, body, path) of the leaves below; a path is the (left,
    right) digests beside each node from the leaf up."""

    def one(x: Column, at: Column) -> Column:
        path = [_side(kids, at), *above]
        return _unfolded(x["kids"], storey - 1, path) if storey else F.struct(x["digest"].alias("digest"), x["body"].alias("body"), F.array(*path).alias("path"))

    got = F.transform(kids, one)
    return F.flatten(got) if storey else got


def _climb(nodes: DataFrame, crown: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``digest``, ``body`` (which holds the ``rank``) and the whole ``path`` of
    each node, with its group's ``subroot`` and the ``root``.  ``crown`` adds the
    path above the subroots and the root to one row a group."""
    blocks = materialise(_rolled(nodes))
    tallest = blocks.agg(F.max("height")).first()[0] or 0
    if tallest > DIGITS:
        upper = blocks.select(
            "grp", F.col("block").alias("rank"), F.greatest(F.col("height") - DIGITS, F.lit(0)).alias("height"), "digest",
            F.struct(F.col("block").alias("rank")).alias("body"),
        )
        above = _climb(upper, crown).select(
            F.col("grp").alias("_grp"), F.col("body.rank").alias("_rank"), F.col("path").alias("higher"), "subroot", "root"
        )
        crowned = blocks.join(above, (F.col("grp") == F.col("_grp")) & (F.col("block") == F.col("_rank")))
    else:
        crowned = crown(blocks)
    return crowned.select(
        "grp", "height", "higher", "subroot", "root", F.explode(_unfolded(F.col("kids"), DIGITS - 1, [])).alias("x")
    ).select(
        "grp", "x.digest", "x.body",
        F.concat(F.slice("x.path", F.lit(1), F.least("height", F.lit(DIGITS))), "higher").alias("path"),
        "subroot", "root",
    )


def _alone(blocks: DataFrame) -> DataFrame:
    """One group: its top is the root."""
    none = F.array().cast("array<struct<left:string,right:string>>")
    return blocks.withColumn("higher", none).withColumn("subroot", F.col("digest")).withColumn("root", F.col("digest"))


def _over_groups(blocks: DataFrame) -> DataFrame:
    """The groups' tops are leaves of the tree that ends in the root."""
    tops = positions(blocks.select("grp", "digest"), [], [F.col("grp").asc()], "rank")
    tree = _climb(
        tops.select(F.lit("").alias("grp"), "rank", _height(F.col("rank_of")).alias("height"), "digest", F.struct("rank", F.col("grp").alias("name")).alias("body")),
        _alone,
    )
    paths = tree.select(F.col("body.name").alias("_grp"), F.col("path").alias("higher"), "root")
    return blocks.join(paths, F.col("grp") == F.col("_grp")).withColumn("subroot", F.col("digest"))


def manifest(leaves: DataFrame) -> DataFrame:
    """Proofs for ``grp`` (null is a group), ``id`` (the order within a group),
    ``digest`` and a struct ``extra``: these with ``path`` (array of ``left`` and
    ``right``: the joined hex digests beside each node from the leaf up),
    ``subroot`` and ``root``."""
    rows = leaves.select(
        F.coalesce(F.concat(F.lit("1"), F.col("grp")), F.lit("0")).alias("grp"), "id", "digest", "extra"
    )
    # equal rows can be many: a number, whichever, lets a range end among them
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()))
    order = [F.col("id").asc_nulls_first(), F.col("digest").asc(), F.col("_row").asc()]
    nodes = positions(rows, ["grp"], order, "rank").select(
        "grp", "rank", _height(F.col("rank_of")).alias("height"), "digest", F.struct("rank", "id", "extra").alias("body")
    )
    return _climb(nodes, _over_groups).select(
        F.when(F.col("grp") != "0", F.expr("substring(grp, 2)")).alias("grp"), "body.id", "digest", "body.extra", "path", "subroot", "root"
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]).cast("binary"), 256))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def document_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """Proofs of all documents, checked after the texts of the rows ``tampered``
    were lower-cased: rows whose fold does not end in the root do not verify."""
    fields = {c: F.col(c) for c in FIELDS}
    changed = F.when(tampered, digest_of({**fields, "text": lowered(F.col("text").cast("string"))}))
    leaves = docs.select(
        F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("id"), digest_of(fields).alias("digest"),
        F.struct(changed.alias("found")).alias("extra"),
    )
    beside = F.transform("path", lambda s: F.concat(s["left"], s["right"]))
    return manifest(leaves).select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(F.array_join(beside, "").cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("extra.found", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return document_manifest(docs, held_out(F.col("doc_id"), 3, 0))
