"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Targets: the words of all sources are shared by the sources' weights; a target stops at ``cap`` times its
source's size and the excess is shared again by weight until none is above (computed at once: all open
sources end at one level per weight). Each source is first taken in whole epochs; the rest of its target is a
weighted sample without replacement: a document's key is an exponential variate divided by its quality weight,
and documents are taken in the order of their keys while the prefix sum of sizes stays within the rest. One
more document fills the gap if that brings the sum nearer.

Prefix sums do not gather a source in one task: keys fall into ``CELLS`` cells per source by a monotone
function, cells are summed, and a window runs inside each cell only. The decision per source is then one
threshold: documents of sources that hold over a 1024th of all rows are judged where they stand, by a broadcast of fewer
than 1024 thresholds, the others by a join on their source (broadcast as well where the table of thresholds is small).

Keys come from md5 of seed and id: reruns agree. Equal ids in a source share a key and are decided together.

A very long text is a size like any other: it is taken
whole or not.

Defined cases: a null text has size 0 and nothing is taken of it; null sources are one source, ordered last;
null ids draw one common key; with an empty table, or no words at all, every target is 0; input columns with
an output's name give way to the output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import saved
from tracewright.llm.skew import attach

WORD = "[^\\x20\\x09-\\x0D]+"
CELLS = 4096
SEED = "mix-1"
OUTPUTS = ("size", "source_size", "target", "epochs", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column) -> Column:
    """A quality weight in [0.1, 1]: falls by a tenth for each percent of symbol characters."""
    n = F.char_length(text)
    share = F.regexp_count(text, F.lit("[#*$%&|<>]")) * 10 / n
    return F.when(n > 0, F.greatest(F.lit(0.1), 1 - share)).otherwise(F.lit(0.1)).cast("double")


def sample_key(ident: Column, quality: Column, seed: str = SEED) -> Column:
    """Exponential variate over ``quality``: the least keys form the weighted sample."""
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary")), 1, 12), 16, 10)
         .cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / quality


def _sums_before(df: DataFrame, order: Sequence[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``df``, written in ranges of ``order`` (a total order), with ``<out>_before``, the sum of a column over all earlier rows,
    and ``<out>_all``, its sum over all rows, for each of ``sums``. A window runs inside a range; only one row a range meets in one task."""
    ranged = saved(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), name)
    per_range = ranged.groupBy("__range").agg(*[F.sum(c).alias(o) for o, c in sums.items()])
    earlier, every = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    offsets = per_range.select("__range", *[F.coalesce(F.sum(o).over(earlier), F.lit(0)).alias(f"__{o}") for o in sums],
                               *[F.sum(o).over(every).alias(f"{o}_all") for o in sums])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__in_{o}") for o, c in sums.items()]).join(offsets, "__range")
    for o in sums:
        out = out.withColumn(f"{o}_before", F.col(f"__in_{o}") + F.col(f"__{o}"))
    return out.drop("__range", *[f"__{o}" for o in sums], *[f"__in_{o}" for o in sums])


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(source, source_size) -> also place, weight, most, target. One row per source, however many there are: places and prefix
    sums run in ranges, and the level at which the open sources end, one number, passes through the driver."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = _sums_before(sizes, [F.col("source").asc_nulls_last()], {"rows": F.lit(1)}, "mix-places")
    s = (s.withColumn("place", F.col("rows_before") + 1).drop("rows_before", "rows_all")
         .withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
         .withColumn("most", F.col("source_size") * float(cap)))
    s = s.withColumn("__ratio", F.col("most") / F.col("weight"))
    sums = {"__size": F.col("source_size"), "__most": F.col("most"), "__weight": F.col("weight")}
    s = _sums_before(s, [F.col("__ratio"), F.col("place")], sums, "mix-levels")
    level = (F.col("__size_all").cast("double") - F.col("__most_before")) / (F.col("__weight_all") - F.col("__weight_before"))
    first_open = s.where(F.col("__ratio") >= level).agg(F.min(F.struct("__ratio", "place", level.alias("level"))).alias("x")).first()["x"]
    target = F.col("most") if first_open is None else F.least(F.col("most"), F.lit(first_open["level"]) * F.col("weight"))
    return s.withColumn("target", target).drop("__ratio", *[f"{o}_{x}" for o in sums for x in ("before", "all")])


def source_cuts(d: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``d`` has key (stands for the source, never null), source, id, size, e (its sample key). Returns per source: its key, its rows
    ``n``, its target, whole epochs, the last key and id that the sample takes, and the id that fills the gap. Rows meet their
    source's figures by (key, cell), as the window inside a cell has them already: no shuffle gathers a source."""
    totals = d.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    s = source_targets(totals, weights, cap)
    size = F.col("source_size")
    s = s.withColumn("epochs", F.when(size == 0, 0).when(F.col("target") >= F.col("most"), F.lit(int(cap)))
                     .otherwise(F.floor(F.col("target") / size)).cast("long"))
    s = s.withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * size, F.lit(0.0)))
    cell = F.least(F.floor((1 - F.exp(-F.col("e"))) * CELLS), F.lit(CELLS - 1)).cast("int")
    u = (d.where(F.col("size") > 0).withColumn("cell", cell)
         .groupBy("key", "cell", "e", "id").agg(F.sum("size").alias("size")))
    cells = u.groupBy("key", "cell").agg(F.sum("size").alias("cell_size"))
    up_to = Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = saved(cells.withColumn("before", F.coalesce(F.sum("cell_size").over(up_to), F.lit(0))).join(s.select("key", "rest"), "key")
                  .select("key", "cell", "before", "rest"), "mix-cells")
    inside = Window.partitionBy("key", "cell").orderBy("e", "id").rowsBetween(Window.unboundedPreceding, 0)
    u = (u.withColumn("within", F.sum("size").over(inside)).join(cells, ["key", "cell"])
         .select("key", "cell", "e", "id", "size", "rest", (F.col("before") + F.col("within")).alias("upto")))
    taken = F.col("upto") <= F.col("rest")
    cut = u.where(taken).groupBy("key").agg(F.max(F.struct("e", "id")).alias("cut"), F.max("upto").alias("sum"))
    s = saved(s.join(cut, "key", "left").withColumn("gap", F.col("rest") - F.coalesce("sum", F.lit(0))), "mix-sources")
    v = u.where(~taken).join(cells.select("key", "cell").join(s.select("key", "gap"), "key"), ["key", "cell"])
    nearer = F.abs(F.col("gap") - F.col("size"))
    fill = v.where(nearer < F.col("gap")).groupBy("key").agg(F.min(F.struct(nearer.alias("off"), "e", "id")).alias("fill"))
    return (s.join(fill, "key", "left")
            .select(F.col("key").alias("__llm_s"), "n", "source_size", "target", "epochs", F.col("cut").alias("__llm_cut"),
                    F.struct(F.col("fill.e").alias("e"), F.col("fill.id").alias("id")).alias("__llm_fill"), F.col("fill").isNotNull().alias("__llm_filled")))


def mix_sources(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights: Sequence[float] = (1, 2, 3), cap: float = 3, seed: str = SEED) -> DataFrame:
    """``df`` with size, source_size, target, epochs and taken (words the mix takes, repeats counted)."""
    text = F.col(f"`{text_col}`").cast("string")
    source, ident = F.col(f"`{source_col}`").cast("string"), F.col(f"`{id_col}`")
    size, e = word_count(text), sample_key(ident, text_quality(F.coalesce(text, F.lit(""))), seed)
    key = F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))
    light = df.select(key.alias("key"), source.alias("source"), ident.alias("id"), size.alias("size"), e.alias("e"))
    cuts = saved(source_cuts(saved(light, "mix-sizes"), weights, cap), "mix-cuts")
    keep = [F.col(f"`{c}`") for c in df.columns if c not in OUTPUTS]
    rows = df.select(*keep, size.alias("size"), e.alias("__llm_e"), ident.alias("__llm_id"), key.alias("__llm_s"))
    rows = attach(rows, cuts, "__llm_s", F.xxhash64("__llm_id", "__llm_e"))
    at = F.struct(F.col("__llm_e").alias("e"), F.col("__llm_id").alias("id"))
    picked = (F.coalesce(at <= F.col("__llm_cut"), F.lit(False))
              | (F.col("__llm_filled") & (F.col("__llm_fill.e") == F.col("__llm_e")) & F.col("__llm_fill.id").eqNullSafe(F.col("__llm_id"))))
    taken = F.col("size") * (F.col("epochs") + F.when(picked & (F.col("size") > 0), 1).otherwise(0))
    return rows.withColumn("taken", taken.cast("long")).drop("__llm_e", "__llm_id", "__llm_s", "__llm_cut", "__llm_fill", "__llm_filled")
