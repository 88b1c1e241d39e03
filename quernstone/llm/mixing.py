"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens raised to an exponent and
normalised. The exponent is the largest in [0, 1] whose weights have the target
entropy, unless a source would then be repeated more often than allowed: then the
least that keeps the limit. The target lies a stated part of the way from the
natural entropy to the greatest there is, so that it asks for a change wherever
sources differ in size; a share of the greatest can be stated instead. It is
found by bisection; each pass evaluates 15 points in one aggregation over the
sources, so the list of sources never leaves the executors.

Weights are realised by budgeted block permutations. A source's documents are
permuted by a seeded hash, and the permutation is cut into blocks of bounded
size by the hash's high bits. A source takes whole passes over all its
documents, then whole blocks in order while its budget lasts, then the documents
of the block in which it ends, in order, as far as they fit: the place of the
first one that does not is the source's cut. So the realisation of a source is one
row (passes, cut), and each document's copies follow from its own hash. Only one
block of each source is ordered by place, its tokens summed by place before.
Blocks are summed in two levels, so that no window is as long as a source.
All of it is DataFrame operations.

Defined results: tokens are the runs outside 0x20 and 0x09-0x0D; a null text is
empty and has none; documents without tokens go with the place their hash gives
them; a null source is a source of its own; a source without tokens has weight 0
and no copies; rows that repeat id and text have the same place and as many
copies; an empty table gives an empty result; columns other than those named are
not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.common import discard, only, places, settle

#: Tokens of a block, about.
BLOCK = 1 << 20
#: Passes of bisection, and points in each: 2 ** -24 in the end.
PASSES, POINTS = 6, 16
#: How far the weights go from the natural ones to equal ones, by entropy.
FLATTEN = 0.5
#: Blocks of a range, whose tokens are summed before.
SPAN = 1 << 12
WORD = r"[^\x20\x09-\x0D]+"


def _tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _state(totals: DataFrame, exponents: list[float], total: float, budget: float) -> list[tuple[float, float]]:
    """For each exponent, the entropy of the weights and the most repeated source's passes."""
    share, log = F.col("tokens") / F.lit(total), F.ln(F.col("tokens") / F.lit(total))
    sums = []
    for i, x in enumerate(exponents):
        raised = F.exp(log * x)
        sums += [F.sum(raised).alias(f"z{i}"), F.sum(raised * log).alias(f"l{i}"), F.max(raised / share).alias(f"m{i}")]
    row = totals.agg(*sums).first()
    return [(math.log(row[f"z{i}"]) - x * row[f"l{i}"] / row[f"z{i}"], row[f"m{i}"] / row[f"z{i}"] * budget / total) for i, x in enumerate(exponents)]


def exponent(totals: DataFrame, budget: float, entropy: float | None, repeats: float, flatten: float = FLATTEN) -> float:
    """totals: source, tokens > 0. entropy: the target as a share of the greatest there is, 0 to 1; None: `flatten` of the way there from the natural one."""
    row = totals.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not row.n:
        return 1.0
    total, greatest = float(row.t), math.log(row.n)

    def search(good_low) -> float:
        """The border between the low exponents, for which good_low holds, and the others; a point where it holds."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            points = [low + (high - low) * i / POINTS for i in range(1, POINTS)]
            held = [good_low(*s) for s in _state(totals, points, total, budget)]
            n = held.index(False) if False in held else len(held)
            low, high = ([low, *points][n], [*points, high][n])
        return low

    ends = _state(totals, [0.0, 1.0], total, budget)
    target = entropy * greatest if entropy is not None else ends[1][0] + flatten * (greatest - ends[1][0])
    chosen = 1.0 if ends[1][0] >= target else search(lambda h, _: h >= target)
    if _state(totals, [chosen], total, budget)[0][1] > repeats:
        # passes of the rarest source fall as the exponent rises
        step = (1.0 / POINTS) ** PASSES
        chosen = 1.0 if ends[1][1] > repeats else min(1.0, search(lambda _, m: m > repeats) + step)
    return chosen


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _unsigned(place: Column) -> Column:
    """A number whose signed order is the unsigned order of the hash."""
    return place.bitwiseXOR(F.lit(-(2**63)))


def cuts(rows: DataFrame, entropy: float | None, repeats: float, budget: float | None, block: int, flatten: float = FLATTEN) -> DataFrame:
    """rows: key, tokens, place. A row for each source with tokens: key, weight, passes, cut (null: no document gets one more)."""
    totals = settle(rows.groupBy("key").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "totals")
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    budget = float(total if budget is None else budget)
    chosen = exponent(totals, budget, entropy, repeats, flatten)
    raised = F.exp(F.ln(F.col("tokens") / F.lit(float(total or 1))) * chosen)
    z = totals.agg(F.sum(raised)).first()[0] or 1.0
    plan = totals.select("key", (raised / z).alias("weight"), F.col("tokens").alias("all"))
    plan = plan.withColumn("target", F.round(F.col("weight") * budget).cast("long"))
    plan = plan.withColumn("passes", F.expr("target div all")).withColumn("rest", F.expr("target % all"))
    # a power of two of blocks, by the hash's high bits
    plan = settle(plan.withColumn("bits", F.least(F.lit(40), F.greatest(F.lit(0), F.ceil(F.log2(F.col("all") / block)))).cast("int")), "plan")
    discard(totals)
    # sources may be too many to broadcast; one of them may be hot: an equi-join that Spark splits
    placed = rows.where("tokens > 0").join(plan.where("rest > 0").select("key", "bits", "rest"), "key")
    placed = placed.select("key", "place", "tokens", "rest", F.when(F.col("bits") > 0, F.expr("shiftrightunsigned(place, 64 - bits)")).otherwise(F.lit(0)).alias("block"))
    blocks = settle(placed.groupBy("key", "block").agg(F.sum("tokens").alias("held"), F.first("rest").alias("rest")), "blocks")
    # the block in which a source ends: first among ranges of SPAN blocks, then in that range
    ranges = blocks.groupBy("key", F.floor(F.col("block") / SPAN).alias("span")).agg(F.sum("held").alias("held"), F.first("rest").alias("rest"))
    span = _ending(ranges, ["key"], "span", F.lit(0)).select("key", "span", F.col("before").alias("start"))
    inside = blocks.withColumn("span", F.floor(F.col("block") / SPAN)).join(span, ["key", "span"])
    last = settle(_ending(inside, ["key"], "block", F.col("start")).select("key", "block", "before", "rest"), "last")
    border = placed.drop("rest").join(last, ["key", "block"]).groupBy("key", "place").agg(F.sum("tokens").alias("held"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    order = Window.partitionBy("key").orderBy(_unsigned(F.col("place")))
    through = F.col("before") + F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ends = border.withColumn("through", through).where("through > rest").groupBy("key").agg(F.min(_unsigned(F.col("place"))).alias("cut"))
    made = settle(plan.select("key", "weight", "passes").join(ends, "key", "left"), "cuts")
    discard(blocks, last, plan)
    return made


def _ending(sums: DataFrame, by: list[str], order: str, start: Column) -> DataFrame:
    """The row of each source in which the running sum of `held` from `start` passes `rest`, with the sum before it."""
    before = start + F.sum("held").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("held")
    return sums.withColumn("before", before).where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("held") > F.col("rest")))


def _copies(place: Column) -> Column:
    more = F.when(_unsigned(place) < F.col("cut"), 1).otherwise(0)
    return F.coalesce(F.col("passes") + more, F.lit(0)).cast("int")


def mix(frame: DataFrame, entropy: float | None = None, repeats: float = 2.0, budget: float | None = None, seed: int = 17, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keyed: bool = False, flatten: float = FLATTEN) -> DataFrame:
    """A row for each input row: id, source, tokens, weight of the source, copies; keyed: and text_key, the text's 64-bit hash. budget: tokens in all, by default as many as there are."""
    frame = only(frame, id_col, text_col, source_col)
    text = frame[f"`{text_col}`"].cast("string")
    source = frame[f"`{source_col}`"].cast("string")
    rows = frame.select(frame[f"`{id_col}`"].alias("id"), source.alias("source"), _key(source).alias("key"), _tokens(text).alias("tokens"), F.xxhash64(frame[f"`{id_col}`"], text, F.lit(seed)).alias("place"), *([F.xxhash64(text).alias("text_key")] if keyed else []))
    rows = settle(rows, "places")
    dealt = rows.join(cuts(rows.select("key", "tokens", "place"), entropy, repeats, budget, block, flatten), "key", "left")
    return dealt.select(F.col("id").alias(id_col), "source", "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), _copies(F.col("place")).alias("copies"), *(["text_key"] if keyed else []))


def deal(frame: DataFrame, entropy: float | None = None, repeats: float = 2.0, budget: float | None = None, seed: int = 17, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", flatten: float = FLATTEN) -> DataFrame:
    """The frame's rows with all their columns, each as often as its copies say.

    The documents are joined with one row of each source; texts are only moved
    where these rows are too many for Spark to broadcast.
    """
    names = frame.columns
    found = only(frame, id_col, text_col, source_col)
    rows = found.select(_key(found[f"`{source_col}`"].cast("string")).alias("key"), _tokens(found[f"`{text_col}`"].cast("string")).alias("tokens"), F.xxhash64(found[f"`{id_col}`"], found[f"`{text_col}`"].cast("string"), F.lit(seed)).alias("place"))
    rows = settle(rows, "places")
    made = cuts(rows, entropy, repeats, budget, block, flatten)
    discard(rows)
    at = {name: f"c{places(names, name)}" for name in (id_col, text_col, source_col)}
    plain = frame.toDF(*[f"c{i}" for i in range(len(names))])
    placed = plain.withColumn("key", _key(F.col(at[source_col]).cast("string"))).withColumn("place", F.xxhash64(at[id_col], F.col(at[text_col]).cast("string"), F.lit(seed)))
    dealt = placed.join(made, "key", "left").withColumn("copies", _copies(F.col("place"))).where("copies > 0")
    return dealt.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(*plain.columns).toDF(*names)
