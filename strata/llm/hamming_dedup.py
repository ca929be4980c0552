"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document's set of word shingles is reduced to ``CHUNKS * WIDTH`` MinHash values of 8 bits. The
signature is split into chunks; if two signatures differ in at most ``CHUNKS * (ERRORS + 1) - 1``
values, some chunk has at most ``ERRORS`` differing ones (pigeonhole). The allowed chunk errors
are enumerated as the values that remain when ``ERRORS`` places of a chunk are left out, so every
such pair shares a key, exactly. At Jaccard similarity 0.8 a pair shares no key at all with a
probability of about 1e-6 (16 chunks of 7 values, one error). Links are confirmed on full sets.

Nothing is emitted per pair of a large group: equal sets are folded into one class first; then
every class is confirmed against the one bucket representative it shares most keys with, the
components that gives are compared through their representatives, and what then still lies in
different components of one bucket is dealt to bounded blocks; blocks of like sizes meet in tasks that
compare whole sets and report a forest of links. What is skipped cannot change a component, so
all links count.

Defined cases: a null, empty or blank text has no shingles and links with nothing; repeated rows
are links of their own; a null id takes part but names no component; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import connected_components, map_slices, release_memory, stage, text_or_empty
from strata.llm.words import mix, shingle_sets

CHUNKS, WIDTH, ERRORS = 16, 7, 1
VALUES = CHUNKS * WIDTH
# Chunk, and the places of the chunk that stay, for each key of a signature.
KEYS = [(c, [c * WIDTH + i for i in left]) for c in range(CHUNKS)
        for left in combinations(range(WIDTH), WIDTH - ERRORS)]
STAR_ROUNDS = 2
# Members, and shingles, of a block of the last step.
BLOCK_ROWS, BLOCK_SHINGLES = 128, 1 << 18


def _constants() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return seeds[:VALUES], seeds[VALUES:] | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 8-bit MinHash values per set (zeros for an empty set)."""
    shift, factor = _constants()
    out = np.zeros((len(sets), VALUES), np.uint8)
    filled = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(filled):
        group, held = [], 0
        while at < len(filled) and (not group or held + len(sets[filled[at]]) <= 1 << 16):
            group.append(filled[at])
            held += len(sets[filled[at]])
            at += 1
        x = np.concatenate([sets[i] for i in group])
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in group])[:-1]])
        for k in range(VALUES):
            least = np.minimum.reduceat((x ^ shift[k]) * factor[k], starts)
            out[group, k] = (mix(least) >> np.uint64(56)).astype(np.uint8)
    return out


def signature_keys(signature: np.ndarray) -> np.ndarray:
    """Keys of signatures (rows): the number of the key above the values it is made of."""
    keys = np.empty((len(signature), len(KEYS)), np.int64)
    wide = signature.astype(np.int64)
    for k, (_, places) in enumerate(KEYS):
        value = np.full(len(signature), k, np.int64)
        for p in places:
            value = (value << 8) | wide[:, p]
        keys[:, k] = value
    return keys


def components(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """``docs(doc_id, text)`` → one row per document: ``doc_id, text_hash, n_shingles, component,
    component_id``. Documents whose sets of ``size``-word shingles have a Jaccard similarity of at
    least ``percent`` / 100 are linked; ``component`` numbers the components (null where there
    are no shingles) and ``component_id`` is the smallest id in it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = list(shingle_sets(pdf["text"].tolist(), size))
        with np.errstate(over="ignore"):
            sums = [(mix(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64), mix(s + np.uint64(77)).sum(dtype=np.uint64))
                    for s in sets]
        return pd.DataFrame({
            "doc_id": pdf["doc_id"].astype("Int64"), "text_hash": pdf["text_hash"], "n": [len(s) for s in sets],
            "h1": np.array([a for a, _ in sums], np.uint64).view(np.int64),
            "h2": np.array([b for _, b in sums], np.uint64).view(np.int64),
            "signature": [r.tobytes() for r in signatures(sets)]})

    small = stage(map_slices(rows, summarise, "doc_id long, text_hash long, n long, h1 long, h2 long, "
                                              "signature binary", 128), "hd-signatures")
    # One class per set: its size and two sums over its shingles identify it.
    classes = stage(small.where("n > 0").groupBy("n", "h1", "h2", "signature")
                    .agg(F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash"))
                    .withColumn("id", F.monotonically_increasing_id()), "hd-classes")

    def keyed(batches):
        for pdf in batches:
            sig = np.frombuffer(b"".join(pdf["signature"]), np.uint8).reshape(len(pdf), VALUES)
            yield pd.DataFrame({"id": pdf["id"], "keys": list(signature_keys(sig))})
        release_memory()

    # Sets of n shingles can only link with a different set if n >= percent / (100 - percent).
    able = classes.where(F.col("n") * (100 - percent) >= percent)
    entries = (able.select("id", "signature").mapInPandas(keyed, "id long, keys array<long>")
               .select("id", F.explode("keys").alias("key")))
    buckets = (entries.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi"))
    shared = stage(entries.join(buckets, "key"), "hd-shared")

    members = shared.select("id").distinct()
    wanted = able.join(members, "id").select("id", "text_hash", "n", "signature")
    needed = wanted.select("text_hash").distinct()
    texts = (rows.select("text_hash", "text").join(needed, "text_hash", "left_semi"))

    def to_sets(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"hash": pdf["text_hash"],
                             "shingles": [s.view(np.int64) for s in shingle_sets(pdf["text"].tolist(), size)]})

    one_each = texts.groupBy("text_hash").agg(F.min("text").alias("text"))
    sets = map_slices(one_each, to_sets, "hash long, shingles array<long>", 128)
    sets = stage(wanted.join(sets, wanted.text_hash == F.col("hash")).select(
        "id", "n", "signature", "shingles"), "hd-sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` that are links."""
        # Far beyond the expected distance of a link (six standard deviations); what it leaves out
        # wrongly lies in different components of a bucket and is compared in the last step.
        limit = int(VALUES * (1 - percent / 100) + 6 * np.sqrt(VALUES * 0.25)) if percent else VALUES

        @F.pandas_udf("boolean")
        def close(x: pd.Series, y: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=bool)
            u, v = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1) for s in (x, y))
            return pd.Series((u != v).sum(axis=1) <= limit)

        brief = sets.select("id", "n", "signature")
        left = brief.toDF("a", "n_a", "s_a")
        right = brief.toDF("b", "n_b", "s_b")
        fit = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        likely = pairs.join(left, "a").join(right, "b").where(fit).where(close("s_a", "s_b")).select("a", "b")
        full = sets.select("id", "shingles")
        both = F.size(F.array_intersect("x", "y"))  # whole sets, compared where the rows are
        return stage(likely.join(full.toDF("a", "x"), "a").join(full.toDF("b", "y"), "b")
                     .where(both * 100 >= (F.size("x") + F.size("y") - both) * percent).select("a", "b"), "hd-links")

    # 1. Each class against the bucket representative it shares most keys with.
    star = stage(shared.select("id", F.explode(F.array("lo", "hi")).alias("rep")).where("id != rep")
                 .groupBy("id", "rep").agg(F.count(F.lit(1)).alias("common")), "hd-star")
    best = star.groupBy("id").agg(F.max(F.struct("common", "rep")).alias("m")).select(
        F.col("id").alias("a"), F.col("m.rep").alias("b"))
    links = confirm(best)
    component = _labels(members, links)
    # 2. Components against each other, by the pair of members that shares most keys.
    for _ in range(STAR_ROUNDS):
        found = links.count()
        across = (_with(star, component, "id", "ca")
                  .transform(lambda d: _with(d, component, "rep", "cb")).where("ca != cb")
                  .groupBy(F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb"))
                  .agg(F.max(F.struct("common", "id", "rep")).alias("m"))
                  .select(F.col("m.id").alias("a"), F.col("m.rep").alias("b")))
        links = links.union(confirm(across))
        if links.count() == found:
            break
        component = _labels(members, links)
    # 3. What is left: members of buckets that still hold several components.
    mixed = _with(shared.select("key", "id"), component, "id", "c")
    open_keys = (mixed.groupBy("key").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.min("id").alias("first"))
                 .where("c1 < c2").select("key", "first"))
    left_open = stage(mixed.join(open_keys, "key").select("id", "c", "first").distinct(), "hd-open")
    links = links.union(_block_links(left_open, sets.select("id", "n", "shingles"), percent))
    component = _labels(members, links)

    named = classes.select("n", "h1", "h2", "id", "first_id").join(component, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    firsts = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    final = named.join(firsts, "component").select("n", "h1", "h2", "component", "component_id")
    found = small.where("n > 0").join(final, ["n", "h1", "h2"]).select(
        "doc_id", "text_hash", "n", "component", "component_id")
    alone = small.where("n = 0").select("doc_id", "text_hash", "n", F.lit(None).cast("long").alias("component"),
                                        F.col("doc_id").alias("component_id"))
    return found.union(alone).withColumnRenamed("n", "n_shingles")


def link(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    return components(docs, size, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that connect ``members(id, c, first)``: members that share buckets (``first`` names
    a bucket's first one) but lie in different components ``c``.

    Members connected through buckets are a cluster. Its sets are dealt to classes of sizes, each as
    wide as the similarity allows, so that links lie in a class or between neighbouring ones; and
    classes are cut into blocks of bounded rows and shingles. Every two blocks that can hold a link meet
    in a task, which compares all their sets exactly and reports a forest: at most one link per
    member, never its pairs."""
    # A member's buckets hang together through the smallest of their first members: a link for the
    # member and one for each pair of firsts, instead of one for each of its buckets.
    hung = members.withColumn("b", F.min("first").over(Window.partitionBy("id")))
    cluster = connected_components(hung.select(F.col("id").alias("a"), "b").union(
        hung.select(F.col("first").alias("a"), "b")).distinct()).toDF("_of", "cluster")
    base = float(np.log(100 / percent * 1.0001)) if 0 < percent < 100 else 1e9
    own = members.select("id", "c").distinct()
    sized = own.join(sets.select(F.col("id").alias("_id"), "n"), F.col("id") == F.col("_id")).join(
        cluster, F.col("id") == F.col("_of")).select(
        "id", "c", "cluster", F.floor(F.log(F.col("n").cast("double")) / base).alias("class"), "n")
    sized = stage(sized, "hd-sized")
    counts = sized.groupBy("cluster", "class").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    units = stage(counts.select("cluster", "class", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
                                .alias("block")), "hd-units")
    u, v = units.drop("blocks"), units.select(F.col("cluster").alias("v_cluster"), F.col("class").alias("v_class"),
                                              F.col("block").alias("v_block"))
    pairs = u.join(v, (F.col("cluster") == F.col("v_cluster")) & (
        ((F.col("class") == F.col("v_class")) & (F.col("block") <= F.col("v_block")))
        | (F.col("class") + 1 == F.col("v_class")))).drop("v_cluster")
    both = F.array(F.struct(F.col("class").alias("class"), F.col("block").alias("block"), F.lit(0).alias("side")),
                   F.struct(F.col("v_class").alias("class"), F.col("v_block").alias("block"), F.lit(1).alias("side")))
    alone = (F.col("class") == F.col("v_class")) & (F.col("block") == F.col("v_block"))
    seats = pairs.withColumn("seat", F.explode(F.when(alone, F.slice(both, 1, 1)).otherwise(both))).select(
        "cluster", F.struct("class", "block", "v_class", "v_block").alias("meeting"), "seat.*")
    dealt = sized.join(counts, ["cluster", "class"]).select(
        "id", "c", "cluster", "class", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"))
    seated = dealt.join(seats, ["cluster", "class", "block"]).select("id", "c", "cluster", "meeting", "side")
    full = seated.join(sets.select(F.col("id").alias("_id"), "shingles"), F.col("id") == F.col("_id")).drop("_id")

    def compare(table: pa.Table) -> pa.Table:
        a, b = _forest(table.column("id").to_numpy(), table.column("c").to_numpy(), table.column("side").to_numpy(),
                       table.column("shingles").combine_chunks(), percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stage(full.groupBy("cluster", "meeting").applyInArrow(compare, "a long, b long"), "hd-links")


def _forest(ids: np.ndarray, components: np.ndarray, side: np.ndarray, lists: pa.Array, percent: int
            ) -> tuple[list[int], list[int]]:
    """Links between the rows of side 0 and those of side 1 (among all if there is no side 1) that
    connect different components, without those that others make superfluous."""
    order = np.argsort(side, kind="stable")
    bounds = np.asarray(lists.offsets)
    sizes = np.diff(bounds)[order]
    _, codes = np.unique(np.asarray(lists.values), return_inverse=True)  # shingles as small numbers
    codes = codes.reshape(-1) if len(codes) else np.zeros(0, np.int64)
    each = [codes[bounds[i] - bounds[0]:bounds[i + 1] - bounds[0]] for i in order]
    joined, begin = np.concatenate(each), np.concatenate([[0], np.cumsum(sizes)])
    ids, label = ids[order], np.unique(components[order], return_inverse=True)[1]
    second = int((side == 0).sum()) if (side == 1).any() else 0
    held = np.zeros(int(joined.max(initial=-1)) + 1, bool)
    a, b = [], []
    for x in range(second or len(ids)):
        first = second or x + 1
        others = np.flatnonzero(label[first:] != label[x]) + first
        if not len(others):
            continue
        held[each[x]] = True
        common = np.add.reduceat(held[joined[begin[first]:]], begin[first:-1] - begin[first], dtype=np.int64)[others - first]
        held[each[x]] = False
        for y in others[common * 100 >= (sizes[x] + sizes[others] - common) * percent].tolist():
            if label[x] != label[y]:
                label[label == label[y]] = label[x]
                a.append(int(ids[x]))
                b.append(int(ids[y]))
    return a, b


def keep_one(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: those without shingles, and of each
    component the one with the smallest id (the smallest hash of the text where ids repeat or
    are missing). Of rows that repeat id and text one stays."""
    found = components(docs, size, percent)
    first = (found.where("component IS NOT NULL").groupBy("component")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("m"))
             .select("m.doc_id", "m.text_hash"))
    stay = first.union(found.where("component IS NULL").select("doc_id", "text_hash").distinct()).toDF("_id", "_hash")
    keyed = docs.withColumns({"_hd_id": F.col("doc_id").cast("long"), "_hd_hash": F.xxhash64(text_or_empty())})
    kept = keyed.join(stay, keyed["_hd_id"].eqNullSafe(F.col("_id")) & (keyed["_hd_hash"] == F.col("_hash")), "left_semi")
    one = Window.partitionBy("_hd_id", "_hd_hash").orderBy("_hd_hash")
    return (kept.withColumn("_hd_n", F.row_number().over(one)).where("_hd_n = 1")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def _labels(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, component)`` of every member; one without links is its own component."""
    parts = connected_components(links).toDF("i", "component")
    return stage(members.join(parts, F.col("id") == F.col("i"), "left").select(
        "id", F.coalesce("component", "id").alias("component")), "hd-components")


def _with(df: DataFrame, component: DataFrame, column: str, name: str) -> DataFrame:
    return df.join(component.toDF(f"_{name}", name), F.col(column) == F.col(f"_{name}")).drop(f"_{name}")
