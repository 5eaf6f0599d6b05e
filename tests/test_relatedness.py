"""Identity by state over tiles and blocks against plain counts, up to thousands of samples."""

import random
from itertools import combinations

from strandwise.operators import genotype as gt

TEXT = ["0/0", "0|1", "1/1", "./."]


def cohort(spark, samples, sites, seed, chroms=("chr1",)):
    rng = random.Random(seed)
    d = {(c, p, s): rng.choices(range(4), [4, 3, 2, 1])[0] for c in chroms for p in range(sites) for s in samples}
    rows = [(c, p, "A", "C", s, TEXT[g]) for (c, p, s), g in d.items()]
    return d, spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string, sample string, gt string")


def plain(d, samples, keys):
    out = {}
    for a, b in combinations(samples, 2):
        n = [0, 0, 0]
        for c, p in keys:
            x, y = d.get((c, p, a), 3), d.get((c, p, b), 3)
            if x < 3 and y < 3:
                n[2 - abs(x - y)] += 1
        out[a, b] = tuple(n)
    return out


def counts(df):
    return {(r["IID1"], r["IID2"]): (r["IBS0"], r["IBS1"], r["IBS2"]) for r in df.collect()}


def test_many_tiles(spark):
    samples = [f"N{i}" for i in range(131)]  # three tiles, the last of three samples
    d, calls = cohort(spark, samples, 70, 3)
    want = plain(d, samples, [("chr1", p) for p in range(70)])
    assert counts(gt.pairwise_ibs(calls, samples)) == want
    assert counts(gt.pairwise_ibs(calls, samples, tile=64)) == want
    assert counts(gt.pairwise_ibs(calls.union(calls.limit(500)), samples)) == want  # repeated rows


def test_contigs_blocks_and_sample_without_calls(spark):
    samples = ["b", "a", "none"]
    d, calls = cohort(spark, samples[:2], 5000, 4, ("chr1", "chrX"))
    more = [*samples, *(f"N{i}" for i in range(70))]  # the last tile has no call at all
    assert len(counts(gt.pairwise_ibs(calls, more, tile=64))) == 73 * 72 // 2
    got = gt.pairwise_ibs(calls, samples, per_contig=True)
    for chrom in ("chr1", "chrX"):
        assert counts(got.where(f"chrom = '{chrom}'")) == plain(d, samples, [(chrom, p) for p in range(5000)])


def test_plan_does_not_grow_with_samples(spark):
    few, many = [f"N{i}" for i in range(1100)], [f"N{i}" for i in range(2000)]
    rng = random.Random(6)
    rows = [("chr1", p, "A", "C", s, TEXT[rng.randrange(3)]) for s in many for p in range(3)]
    calls = spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string, sample string, gt string")
    plans = [gt.pairwise_ibs(calls, s) for s in (few, many)]
    sizes = [df._jdf.queryExecution().analyzed().treeString().count("\n") for df in plans]
    assert sizes[0] == sizes[1]
    assert plans[1].where("IBS0 + IBS1 + IBS2 = 3").count() == 2000 * 1999 // 2
