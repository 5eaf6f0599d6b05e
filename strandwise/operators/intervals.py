"""Interval algebra and range joins on 0-based half-open (chrom, start, stop)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import col
from strandwise.functions.running import BLOCK, running, sweep
from strandwise.functions.stages import cut

BIN = 1024
_LONG = 64  # intervals over 64 bins move to the coarse level
_COARSE = 4096  # coarse bin width in fine bins

# Sort keys of the sex chromosomes.
CONTIG_RANK = {"X": 23, "Y": 24}


def merge_intervals(
    df: DataFrame, gap: int = 0, keys: Sequence[str] = ("chrom",), block: int = BLOCK
) -> DataFrame:
    """Union of overlapping, touching or at most ``gap`` apart intervals."""
    keys = list(keys)
    starts = df.groupBy(*keys, "start").agg(F.max("stop").alias("stop"))
    seen = running(
        starts, keys, "start", block, prior_max={"_reach": F.col("stop")}, keep_block=True
    )
    opens = F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + gap)
    flagged = seen.withColumn("_new", opens.cast("int"))
    islands = running(flagged, keys, "start", block, sums={"_island": F.col("_new")})
    return (
        islands.groupBy(*keys, "_island")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .drop("_island")
    )


def union_with_extension(df: DataFrame, extend: int, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Union in which an interval grows only towards a neighbour it can reach.

    A side is extended when the extension meets another interval and stays as it
    is otherwise, so neighbours at most ``extend`` apart are bridged and the outer
    ends are the original ones.  Independent of input order.
    """
    return merge_intervals(df, gap=extend, keys=keys)


def slop(df: DataFrame, flank: int, chrom_len: DataFrame) -> DataFrame:
    """Grow both sides by ``flank`` inside [0, length]; ``chrom_len`` = (chrom, length)."""
    return (
        df.join(chrom_len, "chrom")
        .withColumn("start", F.greatest(F.lit(0), F.col("start") - flank))
        .withColumn("stop", F.least(F.col("length"), F.col("stop") + flank))
        .drop("length")
    )


def flank_segments(targets: DataFrame, flank: int, chrom_len: DataFrame) -> DataFrame:
    """Flanks beside merged targets; a gap no wider than ``flank`` is one segment."""
    merged = cut(merge_intervals(targets.select("chrom", "start", "stop")))
    near = running(
        merged,
        ["chrom"],
        "start",
        lags={"_prev": F.col("stop")},
        leads={"_next": F.col("start")},
    ).join(chrom_len, "chrom")
    left = F.when(
        F.col("_prev").isNull() | (F.col("start") - F.col("_prev") > flank),
        F.struct(
            F.greatest(F.lit(0), F.col("start") - flank).alias("start"),
            F.col("start").alias("stop"),
        ),
    )
    right = F.struct(
        F.col("stop").alias("start"),
        F.when(F.col("_next") - F.col("stop") <= flank, F.col("_next"))
        .otherwise(F.least(F.col("length"), F.col("stop") + flank))
        .alias("stop"),
    )
    return (
        near.select("chrom", F.explode(F.array_compact(F.array(left, right))).alias("s"))
        .select("chrom", "s.start", "s.stop")
        .where(F.col("start") < F.col("stop"))
    )


def _binned(df: DataFrame, width: int, long_intervals: bool, left: bool) -> DataFrame:
    """One row per cell an interval can meet a partner in, as ``_cell`` (kind, bin).

    Kind 0: both short, fine bins.  Kind 1: short left with long right, kind 2: long
    left with any right, both on coarse bins.  So two short intervals never meet on
    the coarse level, where everything nearby shares a bin.
    """
    last = F.greatest(F.col("start"), F.col("stop") - 1)

    def at(kind: int, w: int) -> Column:
        bins = F.sequence(F.floor(F.col("start") / w), F.floor(last / w))
        return F.transform(bins, lambda b: F.struct(F.lit(kind).alias("kind"), b.alias("bin")))

    fine = at(0, width)
    if not long_intervals:
        return df.withColumn("_cell", F.explode(fine))
    is_long = F.col("stop") - F.col("start") > _LONG * width
    wide = width * _COARSE
    if left:
        cells = F.when(is_long, at(2, wide)).otherwise(F.concat(fine, at(1, wide)))
    else:
        cells = F.when(is_long, F.concat(at(1, wide), at(2, wide))).otherwise(F.concat(fine, at(2, wide)))
    return df.withColumn("_cell", F.explode(cells))


def _prefixed(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    clash = {c for c in b.columns if c in a.columns and c not in on} | {"start", "stop"}
    return b.select(*[F.col(c).alias(f"b_{c}") if c in clash else F.col(c) for c in b.columns])


def overlap_join(
    a: DataFrame,
    b: DataFrame,
    how: str = "inner",
    *,
    on: Sequence[str] = ("chrom",),
    bin_size: int = BIN,
    long_intervals: bool = True,
    hot_rows: int | None = None,
) -> DataFrame:
    """Range join: a.start < b.stop and b.start < a.stop on equal ``on`` columns.

    ``b``'s start/stop and clashing names get a ``b_`` prefix.  Both sides are cut
    into bins and joined on (on, kind, bin); a pair is kept only in the bin that
    holds the later of the two starts.  Long intervals live on a coarse level, so
    that nothing is exploded into thousands of bins.  Without ``long_intervals``
    the coarse copies are skipped (right for reads against exons).  A hot bin is
    split by the adaptive skew join; with ``hot_rows`` it is split up front: bins
    of ``a`` with more rows are counted, their rows salted and ``b``'s rows of
    just those bins repeated once per salt.

    semi and anti never build pairs: semi meets the merged ``b``, where exactly one
    island per row is the last one it touches; anti counts by position.
    """
    on = list(on)
    if how == "semi":
        islands = cut(merge_intervals(b.select(*on, "start", "stop"), keys=on))
        islands = running(islands, on, "start", leads={"_next": F.col("start")})
        hits = overlap_join(
            a, islands, on=on, bin_size=bin_size, long_intervals=long_intervals, hot_rows=hot_rows
        )
        last = F.col("_next").isNull() | (F.col("_next") >= F.col("stop"))
        return hits.where(last).select(*a.columns)
    if how == "anti":
        return count_overlaps(a, b, on=on).where("n_overlaps = 0").drop("n_overlaps")
    if how == "left":
        inner = overlap_join(
            a, b, on=on, bin_size=bin_size, long_intervals=long_intervals, hot_rows=hot_rows
        )
        return inner.unionByName(overlap_join(a, b, "anti", on=on), allowMissingColumns=True)
    if how != "inner":
        raise ValueError(f"unknown join type: {how}")

    right = _prefixed(a, b, on)
    left = _binned(a, bin_size, long_intervals, True)
    other = _binned(
        right.withColumnsRenamed({"b_start": "start", "b_stop": "stop"}), bin_size, long_intervals, False
    ).withColumnsRenamed({"start": "b_start", "stop": "b_stop"})
    cells = [F.col("_cell.kind").alias("_kind"), F.col("_cell.bin").alias("_bin")]
    left = left.select(*a.columns, *cells)
    other = other.select(*right.columns, *cells)
    cell = [*on, "_kind", "_bin"]
    if hot_rows:
        hot = (
            left.groupBy(*cell)
            .count()
            .where(F.col("count") > hot_rows)
            .select(*cell, F.ceil(F.col("count") / hot_rows).cast("int").alias("_salts"))
        )
        salt = F.pmod(F.xxhash64(*a.columns), F.col("_salts")).cast("int")
        left = left.join(hot, cell, "left").withColumn(
            "_salt", F.coalesce(salt, F.lit(0))
        ).drop("_salts")
        other = other.join(hot, cell, "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))
        ).drop("_salts")
        cell = [*cell, "_salt"]
    width = F.when(F.col("_kind") > 0, bin_size * _COARSE).otherwise(bin_size)
    pairs = left.join(other, cell).where(
        (F.col("start") < F.col("b_stop"))
        & (F.col("b_start") < F.col("stop"))
        & (F.col("_bin") == F.floor(F.greatest("start", "b_start") / width))
    )
    return pairs.select(*a.columns, *[c for c in right.columns if c not in on])


def count_overlaps(a: DataFrame, b: DataFrame, on: Sequence[str] = ("chrom",)) -> DataFrame:
    """``a`` plus ``n_overlaps``, the number of ``b`` intervals each row meets."""
    return count_overlaps_of(a, {"n_overlaps": b}, on)


def count_overlaps_of(a: DataFrame, layers: Mapping[str, DataFrame], on: Sequence[str] = ("chrom",)) -> DataFrame:
    """``a`` plus a column for each of ``layers``, the number of its intervals each row meets.

    Counted as (starts before a.stop) - (stops up to a.start), so no pair is built
    however deep the pile-up is.  All layers share one sweep, so ``a`` is joined twice
    however many there are.  A row without a key or an end meets none.
    """
    on, names = list(on), list(layers)
    ends = a.select(*on, F.explode(F.array("start", "stop")).alias("pos"))
    for n in names:
        ends = ends.withColumn(f"_s_{n}", F.lit(0)).withColumn(f"_e_{n}", F.lit(0))
    for name, b in layers.items():
        sides = F.array(
            F.struct(F.col("start").alias("pos"), F.lit(1).alias("s"), F.lit(0).alias("e")),
            F.struct(F.col("stop").alias("pos"), F.lit(0).alias("s"), F.lit(1).alias("e")),
        )
        here = b.where("start < stop").select(*on, F.explode(sides).alias("x"))
        own = {f"_s_{name}": F.col("x.s"), f"_e_{name}": F.col("x.e")}
        ends = ends.unionByName(
            here.select(*on, "x.pos", *[own.get(c, F.lit(0)).alias(c) for n in names for c in (f"_s_{n}", f"_e_{n}")])
        )
    counted = [c for n in names for c in (f"_s_{n}", f"_e_{n}")]
    at = ends.groupBy(*on, "pos").agg(*[F.sum(c).alias(c) for c in counted])
    at = running(at, on, "pos", sums={f"_r{c}": F.col(c) for c in counted})
    begun = at.select(*on, F.col("pos").alias("stop"), *[(F.col(f"_r_s_{n}") - F.col(f"_s_{n}")).alias(f"_b_{n}") for n in names])
    ended = at.select(*on, F.col("pos").alias("start"), *[F.col(f"_r_e_{n}").alias(f"_d_{n}") for n in names])
    # a row for every end of either side: more than Spark's size estimate says, not to be broadcast
    met = a.join(begun.hint("merge"), [*on, "stop"], "left").join(ended.hint("merge"), [*on, "start"], "left")
    return met.select(*a.columns, *[F.coalesce(F.col(f"_b_{n}") - F.col(f"_d_{n}"), F.lit(0)).alias(n) for n in names])


def restrict_regions(sites: DataFrame, regions: DataFrame, merged: bool = False) -> DataFrame:
    """Sites whose 1-based ``pos`` is in (start, stop] of any region.

    ``merged`` regions are known to be disjoint, so a site meets one at most and they
    are not merged again.
    """
    points = sites.withColumn("start", F.col("pos") - 1).withColumn("stop", F.col("pos"))
    if merged:
        return overlap_join(points, regions.select("chrom", "start", "stop")).select(*sites.columns)
    return overlap_join(points, regions, "semi").select(*sites.columns)


def intersect_intervals(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row per overlapping pair, clipped to the common part."""
    return (
        overlap_join(a, b)
        .withColumn("start", F.greatest("start", "b_start"))
        .withColumn("stop", F.least("stop", "b_stop"))
        .drop("b_start", "b_stop")
    )


def subtract_intervals(
    a: DataFrame, b: DataFrame, payload: str | None = None, keys: Sequence[str] = ("chrom",)
) -> DataFrame:
    """Parts of ``a`` outside ``b``; a numeric ``payload`` of a disjoint ``a`` is kept."""
    keys = list(keys)
    weights = {"a": F.col(payload)} if payload else None
    layers = {"a": a.where(F.col(payload) != 0) if payload else a, "b": b}
    runs = sweep(layers, keys, weights=weights).where((F.col("a") != 0) & (F.col("b") == 0))
    if payload is None:
        runs = cut(runs)
    if payload:
        kind = a.schema[payload].dataType
        return runs.select(*keys, "start", "stop", F.col("a").cast(kind).alias(payload))
    return merge_intervals(runs, keys=keys)


def point_in_interval(
    points: DataFrame,
    intervals: DataFrame,
    offset: int = 0,
    *,
    point_key: Sequence[str],
    ordinal: str,
) -> DataFrame:
    """First interval in source order with start <= pos + offset <= stop (closed).

    ``point_key`` identifies a point; ``ordinal`` is the source order of intervals.
    """
    shifted = points.withColumn("start", F.col("pos") + offset).withColumn(
        "stop", F.col("pos") + offset + 1
    )
    closed = intervals.withColumn("stop", F.col("stop") + 1)
    hits = overlap_join(shifted, closed).withColumn("b_stop", F.col("b_stop") - 1)
    extra = [c for c in hits.columns if c not in shifted.columns]
    first = hits.groupBy(*point_key).agg(F.min_by(F.struct(*extra), F.col(ordinal)).alias("_hit"))
    return points.join(first, list(point_key)).select(
        *points.columns, *[F.col(f"_hit.{c}").alias(c) for c in extra]
    )


def reciprocal_overlap(calls: DataFrame, catalog: DataFrame, min_frac: float = 0.5) -> DataFrame:
    """Call x catalogue pairs overlapping by ``min_frac`` of both sizes.

    Every hit of a catalogue entry is its own row with its own values.
    """
    common = F.least("stop", "b_stop") - F.greatest("start", "b_start")
    return (
        overlap_join(calls, catalog)
        .withColumn("overlap_rate_aim", common / (F.col("b_stop") - F.col("b_start")))
        .withColumn("overlap_rate_self", common / (F.col("stop") - F.col("start")))
        .where((F.col("overlap_rate_aim") >= min_frac) & (F.col("overlap_rate_self") >= min_frac))
    )


def best_overlap(
    targets: DataFrame,
    candidates: DataFrame,
    *,
    key: Sequence[str],
    order: Sequence[str],
    ties: str = "first",
    fallback: bool = False,
) -> DataFrame:
    """Candidate covering most of each target (``key`` identifies targets).

    ``ties``: first or last in ``order``, which must tell candidates of one target
    apart.  With ``fallback`` a target without candidate gets its own span.
    """
    # a wide target has many cells and hits, of which Spark's size check knows nothing
    hits = overlap_join(targets.hint("merge"), candidates)
    rate = (F.least("stop", "b_stop") - F.greatest("start", "b_start")) / (
        F.col("stop") - F.col("start")
    )
    extra = [c for c in hits.columns if c not in targets.columns]
    names = [f"b_{c}" if f"b_{c}" in extra else c for c in order]
    hits = hits.withColumn("rate", rate)
    if ties == "first":
        top = hits.groupBy(*key).agg(
            F.min_by(F.struct(*extra, "rate"), F.struct(-F.col("rate"), *names)).alias("_best")
        )
    else:
        top = hits.groupBy(*key).agg(
            F.max_by(F.struct(*extra, "rate"), F.struct(F.col("rate"), *names)).alias("_best")
        )
    out = targets.join(top, list(key), "left").select(
        *targets.columns, *[F.col(f"_best.{c}").alias(c) for c in [*extra, "rate"]]
    )
    if fallback:
        out = out.withColumn("b_start", F.coalesce("b_start", "start")).withColumn(
            "b_stop", F.coalesce("b_stop", "stop")
        )
    return out


def overlap_rate(s1, e1, s2, e2, span_start=None, span_stop=None) -> Column:
    """Common length of two spans over the length of the second (the gene); 0 if disjoint."""
    low = col(span_start) if span_start is not None else col(s2)
    high = col(span_stop) if span_stop is not None else col(e2)
    common = F.least(col(e1), col(e2)) - F.greatest(col(s1), col(s2))
    return F.greatest(common, F.lit(0)) / (high - low)


def sliding_windows(regions: DataFrame, win: int, slide: int, win_min: int) -> DataFrame:
    """Windows of ``win`` every ``slide``; the last one absorbs the ragged tail.

    Regions shorter than ``win_min`` vanish; those up to one window stay whole.
    """
    size = F.col("stop") - F.col("start")
    last = F.when(size <= win, F.lit(0)).otherwise(F.floor((size - win) / slide))
    steps = (
        regions.where(size >= win_min)
        .withColumn("_last", last.cast("long"))
        .withColumn("window", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
    )
    begin = F.col("start") + F.col("window") * slide
    end = F.when(F.col("window") == F.col("_last"), F.col("stop")).otherwise(begin + win)
    return steps.withColumn("win_start", begin).withColumn("win_stop", end).drop("_last")


def tile_mean(df: DataFrame, window: int = 1_000_000, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Mean position and depth per fixed tile."""
    return df.groupBy(*keys, F.floor(F.col("pos") / window).alias("tile")).agg(
        F.avg("pos").alias("pos"), F.avg("dp").alias("dp")
    )


def gaps_between(features: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Introns between consecutively numbered exons (1-based closed coordinates).

    On the minus strand intron i runs from exon i+1's stop to exon i's start.
    """
    keys = list(keys)
    nxt = running(
        features,
        keys,
        number,
        block=1000,
        leads={"_start": F.col("start"), "_stop": F.col("stop"), "_no": F.col(number)},
    ).where(F.col("_no").isNotNull())
    minus = F.col("strand") == "-"
    return nxt.select(
        *keys,
        "chrom",
        "strand",
        F.col(number),
        F.when(minus, F.col("_stop") + 1).otherwise(F.col("stop") + 1).alias("start"),
        F.when(minus, F.col("start") - 1).otherwise(F.col("_start") - 1).alias("stop"),
    )


def callable_regions(genome: DataFrame, gaps: DataFrame, par: DataFrame, gap: int = 1) -> DataFrame:
    """Genome minus the merged union of assembly gaps and pseudo-autosomal parts."""
    spans = ["chrom", "start", "stop"]
    masked = cut(merge_intervals(gaps.select(*spans).unionByName(par.select(*spans)), gap=gap))
    return subtract_intervals(genome.select(*spans), masked)


def nearest_phase_set(
    genes: DataFrame, sites: DataFrame, step: int = 1000, key: Sequence[str] = ("gene",)
) -> DataFrame:
    """Phase sets met first when a gene's span grows by ``step`` on both sides.

    The distance to the closest phased site left, inside or right of the gene gives
    the number of steps; a range join with the grown span then finds the sets.
    """
    key = list(key)
    marks = genes.select("chrom", F.explode(F.array("start", "stop")).alias("pos"), F.lit(0).alias("is_site"))
    seen = (
        sites.select("chrom", "pos", F.lit(1).alias("is_site"))
        .unionByName(marks)
        .groupBy("chrom", "pos")
        .agg(F.max("is_site").alias("is_site"))
        .withColumn("_down", -F.col("pos"))
    )
    here = F.when(F.col("is_site") == 1, F.col("pos"))
    left = running(seen, ["chrom"], "pos", fills={"near": here})
    right = running(seen, ["chrom"], "_down", fills={"near": here})
    at = genes.select("chrom", "start", "stop", *[k for k in key if k not in ("chrom", "start", "stop")])
    at = (
        at.join(left.select("chrom", F.col("pos").alias("stop"), F.col("near").alias("_in")), ["chrom", "stop"])
        .join(left.select("chrom", F.col("pos").alias("start"), F.col("near").alias("_l")), ["chrom", "start"])
        .join(right.select("chrom", F.col("pos").alias("stop"), F.col("near").alias("_r")), ["chrom", "stop"])
    )
    distance = F.when(F.col("_in") >= F.col("start"), 0).otherwise(
        F.least(F.col("start") - F.col("_l"), F.col("_r") - F.col("stop"))
    )
    grown = (
        at.withColumn("steps", F.ceil(distance / step))
        .where(F.col("steps").isNotNull())
        .withColumn("start", F.col("start") - F.col("steps") * step)
        .withColumn("stop", F.col("stop") + F.col("steps") * step + 1)
    )
    spots = sites.select(
        "chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("stop"), "ps"
    )
    return overlap_join(grown, spots).select(*key, "steps", "ps").distinct()


def distance_rank(variants: DataFrame, start: Column, stop: Column) -> DataFrame:
    """Variants by distance of ``pos`` from the middle of a gene, nearest first."""
    away = F.abs(F.col("pos") - (start + stop) / 2)
    return variants.withColumn("distance", away).orderBy("distance", "chrom", "pos")


def contig_order(chrom: str | Column) -> Column:
    """Natural sort key: chr1..chr22, X, Y; null for the mitochondrion and others."""
    name = F.regexp_replace(col(chrom), "^chr", "")
    key = F.when(name.rlike("^[0-9]+$"), name.cast("int"))
    for sex, rank in CONTIG_RANK.items():
        key = F.when(name == sex, F.lit(rank)).otherwise(key)
    return key


def parse_region(text: str | Column) -> Column:
    """``chr:start-stop`` or ``chr-pos-ref-alt`` → (chrom, start, stop, ref, alt)."""
    parts = F.split(col(text), "[:-]")
    name = parts[0]
    chrom = F.when(name.startswith("chr"), name).otherwise(F.concat(F.lit("chr"), name))
    site = F.size(parts) == 4
    return F.struct(
        chrom.alias("chrom"),
        parts[1].cast("long").alias("start"),
        F.when(site, parts[1]).otherwise(parts[2]).cast("long").alias("stop"),
        F.when(site, parts[2]).alias("ref"),
        F.when(site, F.get(parts, F.lit(3))).alias("alt"),
    )


def mate_region_reads(reads: DataFrame, regions: DataFrame, extend: int) -> DataFrame:
    """Reads in the regions or in any place a mate of such a read lies.

    ``reads`` has (chrom, start, stop, mate_chrom, mate_start).
    """
    wanted = cut(union_with_extension(regions.select("chrom", "start", "stop"), extend))
    mates = overlap_join(reads, wanted, "semi").select(
        F.col("mate_chrom").alias("chrom"),
        F.col("mate_start").alias("start"),
        (F.col("mate_start") + 1).alias("stop"),
    ).where("chrom is not null").distinct()
    places = cut(union_with_extension(wanted.unionByName(cut(mates)), extend))
    return overlap_join(reads, places, "semi")


def assign_location(pos, start, stop) -> Column:
    """upstream, internal (ends included) or downstream of a gene."""
    return (
        F.when(col(pos) < col(start), "upstream")
        .when(col(pos) > col(stop), "downstream")
        .otherwise("internal")
    )
