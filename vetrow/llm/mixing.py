"""Mixing sources to target weights by capped water-filling.

Every source gets its share of a budget of words by weight; a source whose share
is over its cap (so many epochs of its own words) is clamped there and the excess
goes to the others by weight, until none is over. A source's target is then met
by whole repetitions of all its documents and one fractional repetition: documents
in seeded order, the last of them in part. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetrow.llm.common import boxed, numbered, save, unboxed

WORD = r"[^\x20\x09-\x0D]+"
RESULTS = ("size", "source_size", "target", "repeats", "part", "taken")
#: Hexadecimal digits of the seeded key that one descent splits by, and the rows of a source that a window may order.
DIGITS, WINDOW_ROWS = 3, 100_000
KEY_DIGITS = 48


def fill_targets(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``: shares of ``budget`` by weight, none above
    ``max_epochs`` times its size. Each round clamps the sources that are over; their excess goes to the others by weight.
    A budget above all caps leaves every source at its cap; a weight of zero gets nothing."""
    cap = F.col("source_size") * F.lit(max_epochs)
    state = save(sources.withColumn("clamped", F.lit(False)), "mix-sources")
    while True:
        free, used = state.agg(
            F.sum(F.when(~F.col("clamped"), F.col("weight")).otherwise(0)), F.sum(F.when(F.col("clamped"), cap).otherwise(0))).first()
        left = budget - (used or 0)
        over = ~F.col("clamped") & (F.col("weight") * F.lit(left) > cap * F.lit(free or 0))
        if not free or state.where(over).limit(1).count() == 0:
            break
        state = save(state.withColumn("clamped", F.col("clamped") | over), "mix-sources")
    share = F.col("weight") * F.lit(left) / F.lit(free) if free else F.lit(0.0)
    return state.withColumn("target", F.when(F.col("clamped"), cap).otherwise(share).cast("double")).drop("clamped")


def _with_weights(sources: DataFrame, weights: Sequence[float] | Mapping[str | None, float]) -> DataFrame:
    if isinstance(weights, Mapping):
        given = sources.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items()], "named string, weight double")
        joined = sources.join(given, sources["source"].eqNullSafe(given["named"]), "left").drop("named")
        return joined.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.element_at(cycle, ((F.col("number") - 1) % len(weights) + 1).cast("int")))


def _borders(rows: DataFrame, plan: DataFrame) -> tuple[DataFrame, int]:
    """``plan`` with the prefix of the keys among which each source's fractional repetition ends (null: none does) and the
    words before it, and the prefix's length. A prefix grows until it holds few rows of any source; rows of an equal id and
    text differ in their last digits, so that there always is such a prefix."""
    plan = plan.withColumns({"prefix": F.when(F.col("rest") > 0, F.lit("")), "before": F.lit(0).cast("long")})
    depth, most = 0, None
    while depth < KEY_DIGITS and (most is None or most > WINDOW_ROWS):
        inside = rows.join(plan.where("prefix is not null").select("number", "prefix"), "number").where(
            F.substring("key", 1, depth) == F.col("prefix"))
        depth += DIGITS
        parts = inside.groupBy("number", F.substring("key", 1, depth).alias("next")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        earlier = Window.partitionBy("number").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 parts at most
        starts = parts.withColumn("ahead", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        found = starts.join(plan.select("number", "before", "rest"), "number").withColumn("start", F.col("before") + F.col("ahead")).where(
            (F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("start") + F.col("words")))
        border = found.select("number", F.col("next").alias("prefix"), F.col("start").alias("before"), "rows")
        plan = save(plan.drop("prefix", "before", "rows").join(border, "number", "left"), "mix-borders")
        most = plan.agg(F.max("rows")).first()[0] or 0
    return plan, depth


def mix_sources(docs: DataFrame, *, weights: Sequence[float] | Mapping[str | None, float] = (1, 2, 3), budget: float | None = None,
                max_epochs: float = 3, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                carry: Sequence[str] | None = None) -> DataFrame:
    """The carried columns of ``docs`` (None: all) with ``size`` (words; null or empty text: 0), ``source_size``, ``target``
    (its source's words in the mix), ``repeats`` (whole repetitions), ``part`` (words of one more repetition, from the
    text's start) and ``taken`` (``repeats * size + part``). ``expand`` gives the mix's texts.

    ``weights`` are cycled over the sources in code point order, the null source last, or named by source (others: 0).
    ``budget`` is a number of words, by default all that there are. A source's taken words are its target rounded to whole
    words; at most one of its documents is taken in part. The order of a source's documents comes from the seed and the
    id, among equal ids from the text; rows that repeat both share what their group takes, which of them gets it is not
    defined. A null source is a source; a null id is ordered as an empty one. An empty table gives an empty result.
    Carried columns that bear a result's name come back with ``_in`` appended."""
    first = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    row = F.monotonically_increasing_id()
    key = F.concat(F.substring(first, 1, 16), F.lpad(F.hex(F.xxhash64(text_col)), 16, "0"), F.lpad(F.hex(row), 16, "0"))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = save(docs.select(boxed(docs, carry), F.col(source_col).cast("string").alias("source"), size.alias("size"),
                            F.lower(key).alias("key")), "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = _with_weights(numbered(totals, [F.col("source").asc_nulls_last()], "mix-numbers", "number"), weights)
    if budget is None:
        budget = rows.agg(F.sum("size")).first()[0] or 0
    targets = fill_targets(sources, budget, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.least(F.floor(F.col("target") - F.col("repeats") * F.col("source_size") + 0.5).cast("long"), F.col("source_size"))
    plan = save(targets.withColumn("repeats", whole).withColumn("rest", rest), "mix-plan")
    named = plan.select(F.col("source").alias("_named"), "number")
    rows = rows.join(named, rows["source"].eqNullSafe(named["_named"])).drop("_named", "source")
    plan, depth = _borders(rows, plan)
    placed = rows.join(plan.drop("source", "weight", "rows"), "number").withColumn("_head", F.substring("key", 1, depth))
    ordered = Window.partitionBy("number").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)  # WINDOW_ROWS at most
    ahead = F.col("before") + F.coalesce(F.sum("size").over(ordered), F.lit(0))
    at_border = F.coalesce(F.col("_head") == F.col("prefix"), F.lit(False))
    border = placed.where(at_border).withColumn("part", F.greatest(F.lit(0).cast("long"), F.least("size", F.col("rest") - ahead)))
    others = placed.where(~at_border).withColumn("part", F.when(F.col("_head") < F.col("prefix"), F.col("size")).otherwise(0).cast("long"))
    mixed = others.unionByName(border).withColumn("taken", F.col("repeats") * F.col("size") + F.col("part"))
    return unboxed(mixed, RESULTS)


def expand(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """One row for each repetition that the mix takes, ``repetition`` from 0; a repetition in part has the first words of
    the text, joined by blanks. Documents that are not taken have no row."""
    copies = F.sequence(F.lit(0).cast("long"), F.col("repeats") - F.when(F.col("part") > 0, 0).otherwise(1))
    taken = mixed.where("repeats > 0 or part > 0").withColumn("repetition", F.explode(copies))
    cut = (F.col("repetition") == F.col("repeats")) & (F.col("part") < F.col("size"))
    words = F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)), F.lit(1), F.col("part").cast("int"))
    return taken.withColumn(text_col, F.when(cut, F.array_join(words, " ")).otherwise(F.col(text_col)))
