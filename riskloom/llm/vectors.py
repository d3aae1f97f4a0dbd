"""Near-duplicate embeddings by sorted projection passes.

Each pass hashes every vector to the signs of random projections, orders the vectors lexicographically
by the concatenated bits, and compares each with its neighbours in a window of bounded size. Vectors at
a small angle agree in their leading bits with a known probability, so the number of passes follows from
the number of vectors, the window and the recall asked for. Verified pairs of all passes are united.
Inside a component found this way all pairs are counted in blocks, so that the number of links of a
vector does not depend on how many of its neighbours stood near it in some order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import components, step
from riskloom.operators.ordering import row_index

THRESHOLD = 0.9
#: A vector meets at least this many neighbours on either side in each pass.
WINDOW = 256
#: Share of pairs exactly at the threshold that all passes together may miss.
MISS = 0.001
BITS = 48
BLOCK = 512


def usable(vector: Column) -> Column:
    """False for vectors that link with nothing: null, empty, all zero, or with a null or non-finite part."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & good & F.exists(vector, lambda v: v != 0), F.lit(False))


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS,
               spread: dict[float, int] | None = None) -> int:
    """Passes after which a pair at the threshold is missed with a probability of at most ``miss``.

    ``spread`` has the squared lengths that unit vectors keep relative to the mean, and how many have each; without
    it the mean is taken to be zero. A pair stays as far apart when the mean is taken away, so the shorter its vectors
    get, the wider is their angle. The probability is that over all vectors but those of a squared length of at
    most 1 - threshold: they are about as near to each other as a link asks, so none of their pairs is isolated.
    Two vectors at angle t agree in one bit with probability 1 - t / pi; they meet in a window if they
    agree in the bits that single it out. These are taken to be log2(4 n / window): where vectors crowd
    together a window reaches less far than on average.
    """
    far = {r: many for r, many in (spread or {1.0: 1}).items() if r > 1 - threshold + 1e-9}
    if not far:
        return 1
    lengths, share = np.array(list(far)), np.array(list(far.values())) / sum(far.values())
    agree = 1 - np.arccos(np.clip(1 - (1 - threshold) / lengths, -1, 1)) / math.pi
    meet = agree ** max(0.0, math.log2(4 * max(n, 1) / window))
    missed = lambda passes: float(share @ (1 - meet) ** passes)
    low, high = 0, 1
    while missed(high) > miss:
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if missed(middle) > miss else (low, middle)
    return high


def unit(vector: Column) -> Column:
    """Usable vectors at length 1; scaled by the largest part first, so that no square overflows."""

    @F.arrow_udf("array<double>")
    def scaled(vectors: pa.Array) -> pa.Array:
        out = []
        for v in vectors:
            x = v.values.to_numpy(zero_copy_only=False)
            x = x / np.abs(x).max()
            out.append(x / np.linalg.norm(x))
        return pa.array(out, pa.list_(pa.float64()))

    return scaled(vector)


def _same_length(frame: pd.DataFrame) -> list[pd.DataFrame]:
    return [part for _, part in frame.groupby(frame["vector"].map(len), sort=True)]


def centres(reps: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector of each length."""
    at = reps.select("vector", F.size("vector").alias("dims"))
    means = {}
    for r in at.select("dims", F.posexplode("vector").alias("i", "v")).groupBy("dims", "i").agg(F.avg("v").alias("m")).collect():
        means.setdefault(r["dims"], {})[r["i"]] = r["m"]
    return {d: np.array([m[i] for i in range(d)]) for d, m in means.items()}


def passes_needed(reps: DataFrame, threshold: float, window: int, centre: dict[int, np.ndarray]) -> int:
    """``passes_for`` the vectors of the length that needs most, by their measured spread around the mean."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                for part in _same_length(batch):
                    x = np.stack(part["vector"].to_list()) - centre[len(part["vector"].iloc[0])]
                    yield pd.DataFrame({"dims": x.shape[1], "bin": np.floor((x * x).sum(axis=1) * 200).astype(np.int32)})

    bins: dict[int, dict[float, int]] = {}
    for r in reps.select("vector").mapInPandas(run, "dims int, bin int").groupBy("dims", "bin").count().collect():
        bins.setdefault(r["dims"], {})[r["bin"] / 200] = r["count"]
    return max((passes_for(sum(b.values()), threshold, window, spread=b) for b in bins.values()), default=1)


def projection_order(reps: DataFrame, passes: int, seed: int = 0, centre: dict[int, np.ndarray] | None = None) -> DataFrame:
    """(pass, dims, bits, gid) of every vector in every pass; hashes are taken relative to the mean of its length."""
    centre = centres(reps) if centre is None else centre

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                for part in _same_length(batch):
                    dims = len(part["vector"].iloc[0])
                    x = np.stack(part["vector"].to_list()) - centre[dims]
                    for n in range(passes):
                        planes = np.random.default_rng([seed, n, dims]).standard_normal((dims, BITS))
                        bits = (x @ planes > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                        yield pd.DataFrame({"pass": n, "dims": dims, "bits": bits, "gid": part["gid"].to_numpy()})

    return reps.select("gid", "vector").mapInPandas(run, "pass int, dims int, bits long, gid long")


def window_links(reps: DataFrame, threshold: float, passes: int, window: int = WINDOW, seed: int = 0,
                 centre: dict[int, np.ndarray] | None = None) -> DataFrame:
    """(a, b) links between gids that connect every group of vectors found to be linked in some window."""
    placed = row_index(projection_order(reps, passes, seed, centre), ["pass", "dims", "bits", "gid"], "place")
    block = F.floor(F.col("place") / window)
    # Every block is compared with itself and with the one before it.
    dealt = placed.select("gid", F.explode(F.array(block, block + 1)).alias("block")).join(reps, "gid")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part in _same_length(frame.drop_duplicates("gid")):
            x, ids = np.stack(part["vector"].to_list()), part["gid"].to_numpy()
            near = x @ x.T >= threshold
            low, label = None, np.arange(len(ids))
            while low is None or (low != label).any():
                low, label = label, np.where(near, label, len(ids)).min(axis=1)
                label = np.minimum(low, label)
            out.append(pd.DataFrame({"a": ids, "b": ids[label]})[label != np.arange(len(ids))])
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []})

    return dealt.groupBy("block").applyInPandas(run, "a long, b long").distinct()


def link_counts(members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(gid, links): over the other vectors of a component that link directly, the sum of their copies.

    ``members``: gid, component, vector (at length 1), copies. A component of m vectors is dealt into m / block parts and
    each couple of parts is one task's work, so a task holds two parts and pairs are never rows. Small
    components share tasks.
    """
    members = step(members)
    sizes = members.groupBy("component").agg(F.count("*").alias("m"))
    total = members.count()
    parts = F.ceil(F.col("m") / block)
    mine = F.pmod(F.xxhash64("gid"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    pack = F.when(F.col("parts") > 1, F.col("component")).otherwise(
        -1 - F.pmod(F.xxhash64("component"), F.lit(max(1, total // (4 * block)))))
    dealt = members.join(sizes, "component").withColumn("parts", parts).withColumn("mine", mine).select(
        "gid", "component", "vector", "copies", "mine", pack.alias("pack"), other.alias("other"))
    dealt = dealt.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in frame.groupby("component"):
            for part in _same_length(own):
                if len(part) > 1:
                    x, ids, weight = np.stack(part["vector"].to_list()), part["gid"].to_numpy(), part["copies"].to_numpy()
                    near = x @ x.T >= threshold
                    np.fill_diagonal(near, False)
                    if part["i"].iloc[0] != part["j"].iloc[0]:  # only pairs across the two parts
                        near &= part["mine"].to_numpy()[:, None] != part["mine"].to_numpy()[None, :]
                    out.append(pd.DataFrame({"gid": ids, "links": near @ weight}))
        return pd.concat(out) if out else pd.DataFrame({"gid": [], "links": []})

    found = dealt.groupBy("pack", "i", "j").applyInPandas(run, "gid long, links long")
    return found.groupBy("gid").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    window: int = WINDOW, passes: int | None = None, seed: int = 0) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Vectors link at a cosine of at least ``threshold`` in double precision; vectors of different lengths
    never do, nor do those of ``usable`` = False, which are components of their own. Equal vectors are
    compared once and all link with each other: repeated rows count as vectors. Rows with a null vec_id
    link with nothing, belong to no component and are not kept. An empty table gives no rows; other columns
    are not read. ``passes`` follows from the number of vectors and their spread unless it is given.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = usable(F.col("vector")) & F.col("vec_id").isNotNull()
    groups = rows.where(fine).groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    groups = step(groups.withColumns({"gid": F.monotonically_increasing_id(), "unit": unit(F.col("vector"))}))
    reps = groups.select("gid", F.col("unit").alias("vector"))
    centre = centres(reps)
    edges = window_links(reps, threshold, passes or passes_needed(reps, threshold, window, centre), window, seed, centre)
    found = step(components(edges))
    members = groups.join(found, groups.gid == found.node).drop("node")
    links = step(link_counts(members.select("gid", "component", F.col("unit").alias("vector"), "copies"), threshold))
    lowest = members.groupBy("component").agg(F.min("rep").alias("lowest"))
    ids = found.join(lowest, "component").select(F.col("node").alias("gid"), "lowest")
    told = groups.join(ids, "gid", "left").join(links, "gid", "left").select(
        "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("lowest", "rep").alias("component_id"))
    linked = rows.where(fine).join(told, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
