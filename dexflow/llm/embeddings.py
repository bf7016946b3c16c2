"""Embedding near-dedup: all pairs by cosine, in tiles, leading principal dimensions first."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, saved

#: Vectors of a tile, rows of a tile multiplied at once, and dimensions added at a time.
TILE, STRIP, STEP = 4096, 256, 16
#: Vectors that the principal axes and the tile bounds are fitted on (they decide speed, not results).
SAMPLE = 8192
#: Products this near the threshold are recomputed with exactly rounded sums.
DOUBT = 1e-12


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    """Cosine in double precision with exactly rounded sums."""
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def unit(values: np.ndarray) -> np.ndarray:
    """Rows as unit vectors; scaled first so that no square overflows or vanishes."""
    values = values.astype(np.float64)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def strip_links(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, least: float) -> np.ndarray:
    """Which rows of the unit vectors a and b have a product of at least ``least``.

    ra and rb are the same vectors in principal axes. Products are summed from the
    leading axes on; what the other axes can add is at most the product of the norms of
    the rest. A pair is given up as soon as the sum with that bound stays below ``least``,
    and the whole strip once no pair is left. The products that remain are taken of
    the vectors themselves, and those in doubt by exactly rounded sums.
    """
    tail = lambda r, d: np.sqrt((r[:, d:] ** 2).sum(axis=1))
    d = min(STEP, a.shape[1])
    bound = ra[:, :d] @ rb[:, :d].T
    bound += np.multiply.outer(tail(ra, d), tail(rb, d))
    i, j = np.nonzero(bound >= least - 1e-9)
    links = np.zeros(bound.shape, bool)
    if len(i) > bound.size // 8:  # most pairs are left: one product of whole vectors is cheaper
        product = a @ b.T
        links = product >= least
        i, j = np.nonzero(np.abs(product - least) <= DOUBT)
    else:
        total = np.einsum("kd,kd->k", ra[i, :d], rb[j, :d])
        while d < a.shape[1] and len(i):
            e = min(d + STEP, a.shape[1])
            total += np.einsum("kd,kd->k", ra[i, d:e], rb[j, d:e])
            d = e
            use = total + tail(ra, d)[i] * tail(rb, d)[j] >= least - 1e-9
            i, j, total = i[use], j[use], total[use]
        product = np.einsum("kd,kd->k", a[i], b[j])
        links[i, j] = product >= least
        use = np.abs(product - least) <= DOUBT
        i, j = i[use], j[use]
    for x, y in zip(i, j):
        links[x, y] = exact_cosine(a[x], b[y]) >= least
    return links


def forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, column) and (row, row) or so that connect what the links connect: one per vertex at most.

    Vertices 0.. are rows, then columns. Each component is walked breadth first; every vertex
    is tied to the row that the walk began at.
    """
    rows, columns = links.shape
    open_row, open_column = links.any(axis=1), links.any(axis=0)
    root, vertex = [], []
    for r in range(rows):
        if not open_row[r]:
            continue
        open_row[r] = False
        front = np.array([r])
        while len(front):
            new = np.flatnonzero(links[front].any(axis=0) & open_column)
            open_column[new] = False
            vertex.append(new + rows)
            front = np.flatnonzero(open_row)
            front = front[links[np.ix_(front, new)].any(axis=1)] if len(new) else front[:0]
            open_row[front] = False
            vertex.append(front)
            root.append(np.full(len(new) + len(front), r))
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *root]), np.concatenate([empty, *vertex])


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """Vectors that can link: not null, not zero, all components finite."""
    finite = "forall({}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    ok = f"embedding is not null and {finite.format('embedding')} and exists(embedding, x -> x <> 0)"
    return vectors.where(ok)


def tile_bounds(rows: DataFrame, axes_of: np.ndarray, tiles: int) -> tuple[np.ndarray, np.ndarray]:
    """Principal axes (columns, by falling variance), and bounds of ``tiles`` ranges of the first coordinate."""
    values, vectors = np.linalg.eigh(axes_of.T @ axes_of)
    axes = vectors[:, ::-1].copy()
    first = np.sort(axes_of @ axes[:, 0])
    return axes, first[[len(first) * k // tiles for k in range(1, tiles)]] if tiles > 1 else np.empty(0)


def link_classes(classes: DataFrame, size: int, threshold: float) -> DataFrame:
    """Links among classes ``cid, embedding, weight`` of one length: rows ``cid, links`` and ``a, b``.

    Tiles are ranges of the first principal coordinate, so that pairs of tiles that lie
    further apart than a link allows are never made; a range with more than ``TILE``
    vectors is dealt over several tiles. Each pair of tiles is one group. A group gives the number
    of vectors that each of its vectors links to, and pairs that connect what it links, one
    per vertex at most, however many links there are.
    """
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("embedding").toPandas()["embedding"]
    fit = unit(np.stack([np.asarray(x, np.float64) for x in sample]))
    axes, bounds = tile_bounds(classes, fit, -(-n // TILE))
    code = dict(classes.dtypes)["embedding"]
    kind = np.float32 if code == "array<float>" else np.float64
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def place(batches):
        for pdf in batches:
            x = np.stack([np.asarray(v, kind) for v in pdf["embedding"]]) if len(pdf) else np.empty((0, size), kind)
            at = np.searchsorted(bounds, unit(x) @ axes[:, 0], "right") if len(pdf) else []
            yield pd.DataFrame({"cid": pdf["cid"], "weight": pdf["weight"], "part": np.asarray(at, "int32"), "values": [v.tobytes() for v in x]})

    placed = saved(classes.mapInPandas(place, "cid long, weight long, part int, values binary"), "placed")
    parts = {r["part"]: -(-r["n"] // TILE) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    names = [(p, k) for p in sorted(parts) for k in range(parts[p])]
    start = {p: names.index((p, 0)) for p in parts}
    low = np.concatenate([[-np.inf], bounds])
    high = np.concatenate([bounds, [np.inf]])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid")
        tile = int(pdf["tile"].iloc[0])
        mine = names[tile][0]
        others = [t for t, (p, _) in enumerate(names) if low[p] - high[mine] <= reach and low[mine] - high[p] <= reach]
        row = {"tile": tile, "cids": pdf["cid"].to_numpy(np.int64).tobytes(), "weights": pdf["weight"].to_numpy(np.int64).tobytes(),
               "values": b"".join(pdf["values"]), "others": others}
        return pd.DataFrame([row])

    first = F.create_map(*[F.lit(int(v)) for p in parts for v in (p, start[p])])[F.col("part")]
    count = F.create_map(*[F.lit(int(v)) for p in parts for v in (p, parts[p])])[F.col("part")]
    tiled = placed.withColumn("tile", (first + F.pmod(F.xxhash64("cid"), count)).cast("int"))
    tiled = saved(tiled.groupBy("tile").applyInPandas(
        pack, "tile int, cids binary, weights binary, values binary, others array<int>"), "tiles")

    def read(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = unit(np.frombuffer(row["values"], kind).reshape(-1, size))
        return np.frombuffer(row["cids"], np.int64), np.frombuffer(row["weights"], np.int64), x

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tile")
        ca, wa, a = read(pdf.iloc[0])
        same = len(pdf) == 1
        cb, wb, b = (ca, wa, a) if same else read(pdf.iloc[1])
        ra, rb = a @ axes, b @ axes
        links = np.zeros((len(a), len(b)), bool)
        for s in range(0, len(a), STRIP):
            f = s if same else 0  # a tile with itself: the upper half
            links[s:s + STRIP, f:] = strip_links(a[s:s + STRIP], b[f:], ra[s:s + STRIP], rb[f:], threshold)
        if same:
            links = np.triu(links, 1)
        of_a, of_b = links @ wb, links.T @ wa
        root, vertex = forest(links)
        cids = np.concatenate([ca, cb])
        out = [pd.DataFrame({"cid": c, "links": x, "a": None, "b": None})[x > 0] for c, x in ((ca, of_a), (cb, of_b))]
        out.append(pd.DataFrame({"cid": None, "links": None, "a": cids[root], "b": cids[vertex]}))
        return pd.concat([o.astype("Int64") for o in out])

    pairs = tiled.withColumn("other", F.explode("others")).withColumns(
        {"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
    return pairs.groupBy("i", "j").applyInPandas(compare, "cid long, links long, a long, b long")


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    Two vectors link if their cosine in double precision is at least ``threshold``. n_links is the
    number of other vectors linked directly, component_id the smallest vec_id
    reachable by links, kept whether that is the vector itself. Equal vectors are one class of some weight
    first. Classes are compared all with all in tiles (see ``link_classes``);
    vectors of different lengths never link.

    A vector that is null, zero or holds null or non-finite components links with nothing, nor
    does one with a null vec_id (its component_id is null, and it is kept). Rows with
    the same vec_id are vectors of their own and count as others, and share one component
    only if their vectors link. Other columns are ignored; an empty table gives no rows.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = saved(v.withColumn("row", F.monotonically_increasing_id()), "vectors")
    good = usable_vectors(rows.where("vec_id is not null"))
    classes = good.groupBy("embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("size", F.size("embedding")), "vector-classes")
    sizes = [r["size"] for r in classes.groupBy("size").agg(F.count("*").alias("n")).collect()]
    if not sizes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = None
    for size in sorted(sizes):
        some = saved(link_classes(classes.where(F.col("size") == size), size, threshold), "tile-links")
        found = some if found is None else found.unionByName(some)
    counts = found.where("cid is not null").groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.where("a is not null").select("a", "b")).withColumnRenamed("node", "cid")
    named = classes.join(counts, "cid", "left").join(joined, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = saved(named.select("cid", "embedding", "first", "component", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "named")
    least = saved(named.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    named = saved(named.join(least, "component").select("embedding", "n_links", "component_id"), "named-classes")
    linked = good.join(named, "embedding").select("row", "n_links", "component_id")
    alone = rows.join(saved(linked, "linked"), "row", "left")
    own = F.coalesce("component_id", "vec_id")
    return alone.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"),
                        F.col("vec_id").eqNullSafe(own).alias("kept"))
