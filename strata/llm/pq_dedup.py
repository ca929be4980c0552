"""Near-duplicate embeddings by product quantisation.

Vectors of one label are linked when their cosine reaches the threshold. Identical vectors are
first folded into classes. A coarse quantiser (spherical k-means) deals the classes out to
inverted lists, and the residuals are coded subspace by subspace. Every class queries the lists
that may hold a partner; there, distances to the coded vectors come from per-query look-up tables,
the quantisation error stored with each code bounds what they can miss, and what passes is decided
by the exact cosine in double precision.

* Probes: a partner at the threshold angle leaves the query's own list for list ``c`` if a random
  direction carries it over the bisecting plane; lists are probed up to ``PROBE_Z`` standard
  deviations of that, so closer partners are missed still less. Recall is measured in the tests.
* Candidates: ``|q - x| >= |q - code(x)| - error(x)``, so no pair in a probed list is lost.
* Skew: a list is cut into blocks of about ``BLOCK`` entries and its queries likewise, and each
  pair of blocks is one bounded task group. Pairs are never emitted: a block reports a
  link count for each query and a spanning forest of its links, at most a row per member.

The codebooks are fitted on at most ``SAMPLE`` classes (a documented bound); everything is coded,
indexed and queried.

Defined cases: null, empty or zero vectors, vectors with null, NaN or infinite components and
vectors without a label link with nothing and are their own component; vectors of different
length never link; repeated rows are linked vectors of their own; rows without an id take part
but name no component; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, stage

THRESHOLD = 0.93
SAMPLE = 16_384          # and no more than SAMPLE_BYTES of double-precision components
SAMPLE_BYTES = 32 << 20
SUBSPACES = 8
CODES = 256
PROBE_Z = 3.5
BLOCK = 2_048


def unit_rows(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Codebook:
    dimension: int
    centroids: np.ndarray        # lists x D, unit rows
    parts: list[np.ndarray]      # columns of each subspace
    codes: list[np.ndarray]      # per subspace: codes x its columns
    freedom: float               # effective dimension of the data

    def assign(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.centroids.T).argmax(axis=1)

    def probes(self, x: np.ndarray, threshold: float) -> list[np.ndarray]:
        """Lists that may hold a partner of each row, the own list among them."""
        dots = x @ self.centroids.T
        own = dots.argmax(axis=1)
        top = dots[np.arange(len(x)), own]
        apart = np.sqrt(np.maximum(2 - 2 * self.centroids @ self.centroids.T, 0))[own]
        reach = PROBE_Z * np.sqrt(max(1 - threshold ** 2, 0)) / threshold / np.sqrt(max(self.freedom - 1, 1))
        near = top[:, None] - dots <= min(reach, 1.0) * apart + 1e-9
        return [np.flatnonzero(row).astype(np.int32) for row in near]

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals and the length of what they leave out."""
        rest = x - self.centroids[lists]
        out, left = np.zeros((len(x), len(self.parts)), np.uint8), np.zeros(len(x))
        for m, (cols, book) in enumerate(zip(self.parts, self.codes)):
            d = _square_distances(rest[:, cols], book)
            out[:, m] = d.argmin(axis=1)
            left += np.maximum(d[np.arange(len(x)), out[:, m]], 0)
        return out, np.sqrt(left)

    def distances(self, queries: np.ndarray, listed: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances: queries x coded entries of one list, by table look-up."""
        rest = queries - self.centroids[listed]
        total = np.zeros((len(queries), len(codes)), np.float32)
        for m, (cols, book) in enumerate(zip(self.parts, self.codes)):
            total += _square_distances(rest[:, cols], book).astype(np.float32)[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :]


def _k_means(x: np.ndarray, k: int, rounds: int, spherical: bool) -> np.ndarray:
    rng = np.random.default_rng(7)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1) if spherical else _square_distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=k)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
        if spherical:
            norms = np.linalg.norm(centres, axis=1, keepdims=True)
            centres = np.where(norms > 0, centres / np.where(norms > 0, norms, 1), x[:k])
    return centres


def fit(sample: np.ndarray, total: int) -> Codebook:
    """Codebooks from unit vectors; ``total``: vectors the lists will hold."""
    n, d = sample.shape
    lists = int(max(1, min(np.sqrt(total), n / 16)))
    centroids = _k_means(sample, lists, 8, True)
    rest = sample - centroids[(sample @ centroids.T).argmax(axis=1)]
    parts = [c for c in np.array_split(np.arange(d), min(SUBSPACES, d)) if len(c)]
    codes = [_k_means(rest[:, c], min(CODES, n), 6, False) for c in parts]
    spread = np.linalg.eigvalsh(np.cov(sample.T).reshape(d, d)) if n > 1 else np.ones(1)
    freedom = float(spread.sum() ** 2 / max((spread ** 2).sum(), 1e-30))
    return Codebook(d, centroids, parts, codes, freedom)


def _forest(hits: np.ndarray, q_ids: np.ndarray, i_ids: np.ndarray) -> pd.DataFrame:
    """Smallest id of each member's component among the links of one pair of blocks."""
    rows, cols = hits.any(axis=1), hits.any(axis=0)
    hits, a, b = hits[np.ix_(rows, cols)], q_ids[rows].copy(), i_ids[cols].copy()
    huge = np.iinfo(np.int64).max
    ids = np.concatenate([a, b])
    while True:
        to_b = np.minimum(b, np.where(hits, a[:, None], huge).min(axis=0)) if len(a) else b
        to_a = np.minimum(a, np.where(hits, to_b[None, :], huge).min(axis=1)) if len(b) else a
        if (to_a == a).all() and (to_b == b).all():
            break
        a, b = to_a, to_b
    return pd.DataFrame({"id": ids, "root": np.concatenate([a, b])})


def link(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` → one row per vector: ``vec_id, n_links,
    component_id, kept``."""
    e = F.col("embedding")
    infinite = float("inf")
    usable = (e.isNotNull() & F.col("label").isNotNull() & (F.size(e) > 0)
              & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
              & F.exists(e, lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding",
                          F.coalesce(usable, F.lit(False)).alias("usable"))
    valid = rows.where("usable")
    classes = stage(valid.groupBy("label", "embedding")
                    .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("size"))
                    .withColumn("id", F.monotonically_increasing_id()), "pq-classes")

    total = classes.count()
    dims = classes.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    book = None
    if dims:
        picked = (classes.where(F.size("embedding") == dims["d"]).orderBy(F.xxhash64("embedding"), "id")
                  .limit(max(CODES, min(SAMPLE, SAMPLE_BYTES // (8 * dims["d"])))).select("embedding").toPandas())
        book = fit(unit_rows(picked["embedding"]), total)

    def code(batches):
        for pdf in batches:
            n = len(pdf)
            lists = np.full(n, -1, np.int32)
            codes, left, probes = [b""] * n, np.full(n, np.inf), [np.array([-1], np.int32)] * n
            fits = np.flatnonzero([len(v) == book.dimension for v in pdf["embedding"]])
            for at in np.array_split(fits, len(fits) // 4096 + 1) if len(fits) else ():
                x = unit_rows(pdf["embedding"].iloc[at])
                lists[at] = book.assign(x)
                c, left[at] = book.encode(x, lists[at])
                for i, row, p in zip(at, c, book.probes(x, threshold)):
                    codes[i], probes[i] = row.tobytes(), p
            yield pd.DataFrame({"id": pdf["id"], "label": pdf["label"], "d": [len(v) for v in pdf["embedding"]],
                                "size": pdf["size"], "embedding": pdf["embedding"], "list": lists,
                                "code": codes, "left": left, "probes": probes})

    kind = dict(classes.dtypes)
    index = stage(classes.mapInPandas(code, f"id long, label {kind['label']}, d int, size long, "
                                            f"embedding {kind['embedding']}, list int, code binary, left double, "
                                            "probes array<int>"), "pq-index")
    cell = ["label", "d", "list"]
    held = index.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    asked = index.select("label", "d", F.explode("probes").alias("list")).groupBy(*cell).agg(
        F.count(F.lit(1)).alias("m"))
    cut = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    cells = stage(held.join(asked, cell).select(*cell, cut("n").alias("n_blocks"), cut("m").alias("m_blocks")),
                  "pq-cells")
    spread = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    entries = (index.join(cells, cell).withColumn("i_block", spread("n_blocks"))
               .withColumn("q_block", every("m_blocks"))
               .select(*cell, "i_block", "q_block", "id", "size", "embedding", "code", "left"))
    again = index.toDF(*index.columns)  # columns of its own beside those of the entries
    queries = (again.drop("list").withColumn("list", F.explode("probes")).join(cells, cell)
               .withColumn("q_block", spread("m_blocks")).withColumn("i_block", every("n_blocks"))
               .select(*cell, "i_block", "q_block", "id", "embedding"))
    reach = float(np.sqrt(max(2 - 2 * threshold, 0)))

    def search(e: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(e) and len(q):
            x, y = unit_rows(q["embedding"]), unit_rows(e["embedding"])
            listed = int(e["list"].iloc[0])
            if listed >= 0:
                codes = np.frombuffer(b"".join(e["code"]), np.uint8).reshape(len(e), -1)
                near = book.distances(x, listed, codes) <= reach + e["left"].to_numpy()[None, :] + 1e-4
            else:
                near = np.ones((len(q), len(e)), bool)
            a, b = np.nonzero(near)
            hits = np.zeros_like(near)
            for s in range(0, len(a), 1 << 16):  # exact cosines of the candidates
                i, j = a[s:s + (1 << 16)], b[s:s + (1 << 16)]
                hits[i, j] = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
            q_ids, i_ids = q["id"].to_numpy(), e["id"].to_numpy()
            same = hits & (q_ids[:, None] == i_ids[None, :])
            counts = (hits & ~same) @ e["size"].to_numpy()
            some = counts > 0
            found.append(pd.DataFrame({"id": q_ids[some], "links": counts[some], "root": q_ids[some]}))
            found.append(_forest(hits & ~same, q_ids, i_ids).assign(links=0))
        return pd.concat(found)[["id", "links", "root"]] if found else pd.DataFrame(
            {"id": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})

    keys = [*cell, "i_block", "q_block"]
    found = stage(entries.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        search, "id long, links long, root long"), "pq-links")
    parts = connected_components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("others"))
    named = (classes.select("label", "embedding", "id", "first_id", "size")
             .join(links, "id", "left").join(parts, "id", "left")
             .withColumn("component", F.coalesce("component", "id")))
    firsts = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = named.join(firsts, "component").select(
        F.xxhash64("label", "embedding").alias("k_hash"), F.col("label").alias("k_label"),
        F.col("embedding").alias("k_embedding"), "component_id",
        (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    mine = valid.withColumn("hash", F.xxhash64("label", "embedding"))
    joined = mine.join(known, (F.col("hash") == F.col("k_hash")) & (F.col("label") == F.col("k_label"))
                       & (F.col("embedding") == F.col("k_embedding"))).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
