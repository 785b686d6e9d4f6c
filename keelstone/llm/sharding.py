"""Shards of near equal size as the leaves of a k-d tree over document metadata."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

#: Bins of a node per round of a median search, and the part of a node's weight that a bin may hold at the end.
BINS, TOLERANCE = 512, 5e-4
DIMENSIONS = ("k0", "k1", "k2", "k3")


@dataclass
class Node:
    first: int  # the smallest shard below
    leaves: int
    weight: float = 0.0
    cut: tuple[str, int] | None = None  # dimension, and the smallest key that goes right
    kids: list[Node] = field(default_factory=list)


def _assign(node: Node, name) -> Column:
    """The name of the leaf that a unit falls into."""
    if not node.kids:
        return F.lit(name(node))
    dimension, at = node.cut
    return F.when(F.col(dimension) < at, _assign(node.kids[0], name)).otherwise(_assign(node.kids[1], name))


def _frontier(node: Node) -> list[Node]:
    return [node] if not node.kids else _frontier(node.kids[0]) + _frontier(node.kids[1])


def weighted_cuts(units: DataFrame, place: Column, asked: dict[int, tuple[str, int, int, float, float]]) -> dict[int, int]:
    """For each node asked for, {node: (dimension, lowest key, highest key, weight wanted left, weight)}: the key at which its units are to be cut.

    Every round counts the weight in BINS bins of each node's interval in one job over all nodes, and goes on in the bin that
    holds the wanted weight.
    """
    state = {k: [d, lo, hi, want, weight, 0.0] for k, (d, lo, hi, want, weight) in asked.items()}
    out: dict[int, int] = {}
    while state:
        of = {k: (lo, max(1, -(-(hi - lo + 1) // BINS))) for k, (_, lo, hi, *_) in state.items()}
        values = ", ".join(f"({k}, {DIMENSIONS.index(s[0])}, {s[1]}L, {s[2]}L, {of[k][1]}L)" for k, s in state.items())
        sought = F.broadcast(units.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(node, d, low, high, step)"))  # a row a node
        binned = units.select(place.alias("node"), "w", F.array(*DIMENSIONS).alias("keys")).join(sought, "node").withColumn("key", F.get("keys", F.col("d"))).where("key >= low and key <= high")
        counts: dict[int, dict[int, float]] = {k: {} for k in state}
        for r in binned.groupBy("node", F.expr("(key - low) div step").alias("bin")).agg(F.sum("w").alias("w")).collect():  # BINS rows a node at most
            counts[r.node][r.bin] = float(r.w)
        for k in list(state):
            _, lo, hi, want, weight, before = state[k]
            start, width = of[k]
            for b in sorted(counts[k]):
                w = counts[k][b]
                if before + w >= want or b == max(counts[k]):
                    break
                before += w
            if width == 1 or w <= TOLERANCE * weight:
                right = before + w - want <= want - before  # which edge of the bin is nearer
                out[k] = start + (b + right) * width
                del state[k]
            else:
                state[k][1:3] = start + b * width, min(hi, start + (b + 1) * width - 1)
                state[k][5] = before
    return out


def grow(units: DataFrame, shards: int) -> Node:
    """The tree: each node is cut along the dimension in which its units spread most, at the weight that its shards on the left are to get."""
    root = Node(0, shards)
    while True:
        open_ = [n for n in _frontier(root) if n.leaves > 1 and n.cut is None]
        if not open_:
            return root
        place = _assign(root, lambda n: n.first)
        found = {r.node: r for r in units.select(place.alias("node"), "w", *DIMENSIONS).groupBy("node").agg(F.sum("w").alias("w"), *[f(d).alias(f"{n}{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))]).collect()}  # a row a node
        asked = {}
        for n in open_:
            r, left = found.get(n.first), n.leaves // 2
            n.kids = [Node(n.first, left), Node(n.first + left, n.leaves - left)]
            if r is None:
                n.cut = (DIMENSIONS[0], 0)
                continue
            d = max(DIMENSIONS, key=lambda d: r[f"hi{d}"] - r[f"lo{d}"])
            n.weight, n.cut = float(r.w), (d, 0)
            asked[n.first] = (d, r[f"lo{d}"], r[f"hi{d}"], float(r.w) * left / n.leaves, float(r.w))
        for k, at in weighted_cuts(units, place, asked).items():
            node = next(n for n in open_ if n.first == k)
            node.cut = (node.cut[0], at)


def _key(position: Column, tie: Column) -> Column:
    """Order by position (0 to 1), ties by hash: a long of 62 bits."""
    return (F.floor(F.least(F.greatest(position, F.lit(0.0)), F.lit(1.0)) * float(1 << 29)).cast("long") * (1 << 32)) + F.pmod(tie, F.lit(1 << 32))


def shard(docs: DataFrame, shards: int = 40, id_col="doc_id", text_col="text", lang_col="lang", source_col="source", rows_per_bucket: int = 100_000) -> DataFrame:
    """Per row: size (UTF-8 bytes + 16), text_crc32, law `bytes`, shard, slot (gapless from 0 within the shard), grown_shard (null).

    Units of the tree are groups of rows of equal text, placed by smallest id, size, language and source; a group of more than a
    quarter of a shard is dealt over several units by hash of the row, else it would upset the balance. Null texts have no bytes
    and form one group; null ids, languages and sources take the place of 0 or of empty text. Repeated rows get a slot each. With
    fewer rows than shards some shards are empty. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(0), text_col).alias("g1"), F.xxhash64(F.lit(1), text_col).alias("g2"), F.coalesce(F.col(id_col), F.lit(0)).cast("double").alias("x"),
        F.pmod(F.xxhash64(F.coalesce(F.col(lang_col), F.lit(""))), F.lit(1 << 20)).alias("l"), F.pmod(F.xxhash64(F.coalesce(F.col(source_col), F.lit(""))), F.lit(1 << 20)).alias("s"),
    )
    rows = cut_lineage(rows)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1)), F.min("x"), F.max("x"), F.max("size")).first()
    if not total[1]:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    target = total[0] / shards
    groups = cut_lineage(rows.groupBy("g1", "g2").agg(F.sum("size").alias("w"), F.min("size").alias("size"), F.min("x").alias("x"), F.min("l").alias("l"), F.min("s").alias("s"), F.count(F.lit(1)).alias("n")))
    heavy = groups.where((F.col("w") > target / 4) & (F.col("n") > 1))  # 4 * shards of them at most
    parts = F.least(F.ceil(F.col("w") / (target / 16)), F.col("n"))
    split = heavy.withColumn("parts", parts.cast("long"))
    hot = F.broadcast(split.select("g1", "g2", "parts"))
    sub = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.col("parts"))).otherwise(F.lit(0))
    marked = rows.join(hot, ["g1", "g2"], "left").withColumn("sub", sub)
    pieces = marked.where("parts is not null").groupBy("g1", "g2", "sub").agg(F.sum("size").alias("w"), F.min("size").alias("size"), F.min("x").alias("x"), F.min("l").alias("l"), F.min("s").alias("s"))
    whole = groups.join(hot, ["g1", "g2"], "left_anti").select("g1", "g2", F.lit(0).cast("long").alias("sub"), "w", "size", "x", "l", "s")
    low, span, longest = float(total[2]), max(1.0, float(total[3] - total[2])), max(1.0, float(total[4]))
    tie = F.xxhash64("g1", "g2", "sub")
    positions = [(F.col("x") - low) / span, F.log(F.col("size").cast("double")) / F.log(F.lit(longest + 1)), F.col("l") / float(1 << 20), F.col("s") / float(1 << 20)]
    units = cut_lineage(whole.unionByName(pieces).select("g1", "g2", "sub", "w", *[_key(p, tie).alias(d) for p, d in zip(positions, DIMENSIONS, strict=True)]))
    tree = grow(units, shards)
    placed = units.select("g1", "g2", "sub", _assign(tree, lambda n: n.first).cast("int").alias("shard"))
    few = F.broadcast(placed.join(hot, ["g1", "g2"]).select("g1", "g2", "sub", "shard"))  # the pieces of heavy groups: some 20 * shards
    calm = marked.where("parts is null").drop("parts").join(placed, ["g1", "g2", "sub"])
    out = marked.where("parts is not null").drop("parts").join(few, ["g1", "g2", "sub"]).unionByName(calm).select("doc_id", "size", "text_crc32", "g1", "g2", "shard")
    return _slots(out, max(1, -(-total[1] // (shards * rows_per_bucket))))


def _slots(rows: DataFrame, buckets: int) -> DataFrame:
    """Gapless numbers within a shard: rows are numbered within (shard, bucket), and buckets are laid end to end."""
    rows = cut_lineage(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "g1"), F.lit(buckets))))
    sizes = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    numbered = rows.withColumn("k", F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "g1", "g2")) - 1)
    return numbered.join(before, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("k")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
