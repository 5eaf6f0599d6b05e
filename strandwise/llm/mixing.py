"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is dealt in blocks of equal token counts. Sources get whole blocks by highest
quotients ``target / (2 s + 1)``, the shards of a source share its blocks the same way,
and a seeded order picks the blocks inside each shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.llm.common import WORD, keyed, once, written

#: Tokens in one block.
BLOCK = 16
#: Tokens (each document counts as one more) in one shard: one task orders a shard's documents.
SHARD = 1 << 20
#: Bars that one pass over the parties tries, and quotients in a gap that need no narrower one.
BARS, TIED = 32, 1 << 14
#: Multiplies block numbers; a prime above any shard's block count, so that no two blocks meet.
STEP = 2_654_435_761


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``(source, source_size, docs, target)``; ``sizes`` has ``source`` (maybe null) and ``size``.

    Sources in code point order, null last, weigh ``weights`` over and over. Together they
    get ``share`` of all tokens, none more than ``cap`` times its own: with sources ordered
    by cap per weight, the first ones fill up and the rest divide what is left by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    # one row per source from here on
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weigh).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per = per.select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(every)
         - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("rest"),
    )
    # the level at which each source would fill, were it the first not to be capped
    level = F.max(F.when(F.col("left") / F.col("rest") * F.col("weight") <= F.col("cap"), F.struct(
        -F.col("cap") / F.col("weight"), F.col("left") / F.col("rest")))).over(every)
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce(level.getField("col2"), F.lit(float("inf"))))
    return per.select("source", "source_size", "docs", target.alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: the ``seats`` of each group by highest quotients ``votes / (2 s + 1)``.

    Every quotient competes. How many reach a bar is a sum over parties, so a pass looks at
    ``BARS`` bars at once and keeps the gap between the two that enclose the right number,
    until few quotients or none of any other value lie in it; only these are put in order.
    Ties go to the smaller party. No votes, no seats.
    """
    key = F.concat(F.lit("="), *[F.coalesce(F.concat(F.lit("_"), F.col(c).cast("string")), F.lit("")) for c in group])
    rows = written(parties.select(key.alias("_g"), F.struct(*parties.columns).alias("_in"), F.col(party).alias("_p"),
                                  F.coalesce(F.col(votes).cast("double"), F.lit(0.0)).alias("_v"), F.col(seats).alias("_s")))
    some = rows.where(F.col("_v") > 0)

    def reached(bar: Column) -> Column:
        return F.floor((F.col("_v") / bar + 1) / 2)

    total = some.groupBy("_g").agg(
        F.sum("_v").alias("v"), F.max("_v").alias("most"), F.count(F.lit(1)).alias("n"), F.first("_s").cast("double").alias("s")).where("s > 0")
    # a party's number of quotients over a bar is votes / bar / 2, give or take a half
    high = F.when(2 * F.col("s") > F.col("n"), F.least(F.col("most"), F.col("v") / (2 * F.col("s") - F.col("n")))).otherwise(F.col("most"))
    gaps = total.select("_g", "s", (F.col("v") / (2 * F.col("s") + F.col("n")) * (1 - 1e-9)).alias("low"), (high * (1 + 1e-9)).alias("high"))
    gaps = written(gaps.withColumn("open", F.lit(True)))
    while gaps.where("open").limit(1).count():
        bars = [F.col("low") * F.pow(F.col("high") / F.col("low"), F.lit(k / BARS)) for k in range(BARS)] + [F.col("high")]
        counts = some.join(gaps.where("open"), "_g").groupBy("_g", "s", "low", "high").agg(F.array(*[F.sum(reached(b)) for b in bars]).alias("c"))
        step = F.least(F.size(F.filter("c", lambda c: c >= F.col("s"))) - 1, F.lit(BARS - 1))
        counts = counts.withColumn("k", F.greatest(step, F.lit(0))).withColumn("bars", F.array(*bars))
        low, up = F.get("bars", F.col("k")), F.get("bars", F.col("k") + 1)
        many = F.get("c", F.col("k")) - F.get("c", F.col("k") + 1) > TIED
        now = counts.select("_g", "s", low.alias("low"), up.alias("high"), (many & (up / low > 1 + 1e-9)).alias("open"))
        gaps = written(now.unionByName(gaps.where("not open")))
    near = some.join(gaps.drop("open"), "_g").withColumn("_sure", reached(F.col("high")).cast("long"))
    near = near.withColumn("_more", F.greatest(reached(F.col("low")).cast("long") - F.col("_sure"), F.lit(0)))
    sure = near.groupBy("_g").agg((F.max("s") - F.sum("_sure")).alias("_open"))
    tries = near.where("_more > 0").withColumn("_k", F.explode(F.sequence(F.col("_sure"), F.col("_sure") + F.col("_more") - 1)))
    place = F.row_number().over(Window.partitionBy("_g").orderBy(F.desc(F.col("_v") / (2 * F.col("_k") + 1)), "_p", "_k"))
    won = tries.join(sure, "_g").withColumn("_place", place).where("_place <= _open")
    won = won.groupBy(F.col("_g").alias("_w"), F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_won"))
    bars = gaps.select(F.col("_g").alias("_h"), F.col("high").alias("_high"))
    found = rows.join(won, (F.col("_g") == F.col("_w")) & F.col("_p").eqNullSafe(F.col("_q")), "left").join(bars, F.col("_g") == F.col("_h"), "left")
    own = F.when((F.col("_v") > 0) & F.col("_high").isNotNull(), reached(F.col("_high"))).otherwise(F.lit(0))
    return found.select("_in.*", (own + F.coalesce("_won", F.lit(0))).cast("long").alias("quota"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2,
    seed: int = 42,
    block: int = BLOCK,
    shard: int = SHARD,
    carry: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of each row of ``docs`` (``doc_id``, ``text``, ``source``).

    Returns ``doc_id, size, source_size, target, taken`` and ``blocks``, the row's block
    range and choice: ``first`` and ``last`` block number, ``offset`` of its first word in
    the shard, ``n`` blocks and ``quota`` of the shard and its ``shift``. ``quota // n``
    times the whole shard is taken, and the first ``quota % n`` blocks of the seeded order
    once more; so ``cap`` is kept where it is a whole number.

    A null or empty text has size 0 and is never taken; null sources are a source of their
    own; repeated rows are rows like any other; further columns are ignored, an empty table
    gives no rows. Results depend on the rows and the seed alone. Columns named in
    ``carry`` come along.
    """
    sizes = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("mark"), *carry)
    sizes = written(sizes)  # texts are counted once
    targets = source_targets(sizes, weights, share, cap)
    total = F.sum("target").over(Window.partitionBy())
    targets = targets.withColumn("_seats", F.round(total / block).cast("long"))
    plan = sainte_lague(targets, [], "source", "target", "_seats").select(
        F.col("source").alias("_source"), "source_size", "target", F.col("quota").alias("source_quota"),
        F.ceil((F.col("source_size") + F.col("docs")) / shard).cast("int").alias("n_shards"),
    )
    placed = sizes.join(written(plan), F.col("source").eqNullSafe(F.col("_source"))).select(
        *sizes.columns, "source_size", "target", "source_quota",
        # with the text's hash, so that rows that share an id, or have none, spread
        F.pmod(F.xxhash64("doc_id", "mark", F.lit(seed)), F.col("n_shards")).alias("shard"),
    )
    loads = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("tokens"), F.first("source_quota").alias("source_quota"))
    quotas = sainte_lague(loads, ["source"], "shard", "tokens", "source_quota").select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), F.ceil(F.col("tokens") / block).alias("n"),
        F.least("quota", F.ceil(F.col("tokens") / block) * int(cap)).alias("quota"))
    line = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", "mark", F.lit(seed + 1)), "doc_id", "mark", "size")
    laid = placed.withColumn("offset", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1)))
    laid = laid.withColumn("offset", F.coalesce("offset", F.lit(0)).cast("long"))
    laid = laid.join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    shift = F.pmod(F.xxhash64("source", "shard", F.lit(seed + 2)), F.lit(1 << 31))
    blocks = F.struct(
        F.floor(F.col("offset") / block).alias("first"),
        F.floor((F.col("offset") + F.col("size") - 1) / block).alias("last"),
        "offset", "n", "quota", shift.alias("shift"),
    )
    laid = laid.withColumn("blocks", F.when(F.col("size") > 0, blocks))
    return laid.select(
        "doc_id", "size", "source_size", "target",
        F.coalesce(_taken(F.col("blocks"), F.col("size"), block), F.lit(0)).cast("long").alias("taken"), "blocks", *carry,
    )


def chosen(b: Column, number: Column) -> Column:
    """Is block ``number`` among the shard's extra ones?"""
    return F.pmod(number * F.lit(STEP) + b["shift"], b["n"]) < F.pmod(b["quota"], b["n"])


def _taken(b: Column, size: Column, block: int) -> Column:
    def words(number: Column) -> Column:
        end = F.least((number + 1) * block, b["offset"] + size)
        return F.when(chosen(b, number), end - F.greatest(number * block, b["offset"])).otherwise(F.lit(0))

    extra = F.aggregate(F.sequence(b["first"], b["last"]), F.lit(0).cast("long"), lambda a, k: a + words(k).cast("long"))
    return F.floor(b["quota"] / b["n"]) * size + extra


def mixed_documents(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken.

    A document taken whole keeps its text; where only some of its blocks are taken, the text
    is the words of these, joined by blanks, and ``n_chars`` their length. What is not taken
    leaves no row.
    """
    rows = keyed(docs).select("_key", "_in.doc_id", "_in.text", "_in.source")
    plan = mix(rows, block=block, carry=["_key"], **options).select("_key", "blocks", "taken", "size")
    plan = written(plan.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_key"))).where("taken > 0"))
    rows = once(docs, plan)
    b = F.col("blocks")
    whole = F.floor(b["quota"] / b["n"]).cast("int")
    extra = F.col("taken") - whole * F.col("size")
    rows = rows.withColumns({"_whole": whole, "_extra": extra})
    times = F.col("_whole") + (F.col("_extra") > 0).cast("int")
    rows = rows.withColumn("_pass", F.explode(F.sequence(F.lit(1), times)))
    words = F.regexp_extract_all("_in.text", F.lit(WORD), 0)
    some = F.filter(words, lambda w, i: chosen(b, F.floor((b["offset"] + i) / block)))
    part = (F.col("_pass") > F.col("_whole")) & (F.col("_extra") < F.col("size"))
    rows = rows.withColumn("_text", F.when(part, F.array_join(some, " ")).otherwise(F.col("_in.text")))
    out = {c: F.col("_in").getField(c) for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(part, F.length("_text").cast(dict(docs.dtypes)["n_chars"])).otherwise(out["n_chars"])
    return rows.select(*[value.alias(name) for name, value in out.items()])
