"""Near-duplicate documents by SuperMinHash signatures.

Each distinct shingle draws one random permutation of the registers. Step j
offers the value j + r to the j-th register of that permutation, so ranks of
one shingle never meet in a register and signatures vary less than with
independent hash functions. Once every register of a document is below j + 1
no later step can lower it, and the document stops: a document with many
shingles takes one or two steps.

Documents with equal sets are one class. Signatures are cut into bands; classes
that share a band are candidates, which are confirmed on their full sets and
grouped by union-find (``groups``). No bucket is turned into all its pairs: its
members are compared with one of them, the hub, the one that meets most others. If that
leaves more than one group in the bucket, its members go through an exact join
on their rarest shingles, which near copies with edits of their own do not share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.groups import components
from daymark.llm.storage import stored
from daymark.llm.tasks import map_batches
from daymark.llm.text import NOT_SPACE, STEP, find_words, mix, slices, window_hashes

MEMBERS_PER_SLOT = 256


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Fewer words than ``size`` are one shingle; a text without words has none.
    """
    words = find_words(texts, NOT_SPACE)
    hashes = words.hashes()
    windows = window_hashes(hashes, size)
    sets = []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if high - low >= size:
            sets.append(np.unique(windows[low : high - size + 1]))
        else:
            sets.append(window_hashes(hashes[low:high], high - low) if high > low else windows[:0])
    return sets


def signatures(sets: list[np.ndarray], registers: int) -> np.ndarray:
    """One row of ``registers`` values for each set; rows of empty sets stay at the largest value."""
    values = np.full((len(sets), registers), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat = values.reshape(-1)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    places = np.tile(np.arange(registers, dtype=np.uint8), (len(elements), 1))
    for step in range(registers):
        if len(elements) == 0:
            break
        draw = mix(elements + np.uint64(int(STEP) * (2 * step + 1) % (1 << 64)))
        swap = (step + (draw >> np.uint64(32)) % np.uint64(registers - step)).astype(np.int64)
        rows = np.arange(len(elements))
        place = places[rows, swap]
        places[rows, swap] = places[:, step]
        offer = (np.uint64(step) << np.uint64(56)) | (mix(draw) >> np.uint64(8))
        np.minimum.at(flat, owner * registers + place, offer)
        unsettled = values.max(axis=1) >= np.uint64(step + 1) << np.uint64(56)
        on = unsettled[owner]
        elements, owner, places = elements[on], owner[on], places[on]
    return values


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    bands = values.reshape(len(values), -1, rows)
    keys = np.arange(bands.shape[1], dtype=np.uint64) * STEP + np.zeros((len(values), 1), np.uint64)
    for i in range(rows):
        keys = mix(keys + bands[:, :, i] * STEP)
    return keys.view(np.int64)


def _sketch(size: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1)):
                sets = shingle_sets(batch.column(1)[low:high], size)
                keys = band_keys(signatures(sets, bands * rows), rows)
                counts = np.array([len(s) for s in sets], dtype=np.int64)
                sums = np.array([mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                squares = np.array([(s * mix(s ^ STEP)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        pa.array(counts),
                        pa.array(sums.view(np.int64)),
                        pa.array(squares.view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands),
                            pa.array(keys.reshape(-1)),
                        ),
                    ],
                    names=["doc_id", "n_shingles", "sum1", "sum2", "bands"],
                )

    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(x) + len(y)
    shared = both - len(np.unique(np.concatenate([x, y])))
    return both > 0 and 100 * shared >= percent * (both - shared)


def _confirm(size: int, percent: int) -> Callable:
    """Rows sorted by (a, slot, b), the hub first with b null: links of each hub.

    An id with several texts is linked by any of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_sets = None, []
        for batch in batches:
            for low, high in slices(batch.column(3)):
                part = batch.slice(low, high - low)
                sets = shingle_sets(part.column(3), size)
                links = []
                rows = zip(*(part.column(i).to_pylist() for i in range(3)), sets, strict=True)
                for a, slot, b, own in rows:
                    if b is None:
                        hub_sets = [*hub_sets, own] if hub == (a, slot) else [own]
                        hub = (a, slot)
                    elif hub == (a, slot) and any(_similar(x, own, percent) for x in hub_sets):
                        links.append((a, b))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"]
                )

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The candidate (a, b) whose full shingle sets are similar enough.

    The text of ``a`` travels once for every ``MEMBERS_PER_SLOT`` partners, and
    the partners of a frequent ``a`` spread over as many tasks.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_SLOT).alias("_slots"))
    dealt = pairs.join(counts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("_slots")).alias("slot")
    )
    hubs = dealt.select("a", "slot").distinct().join(texts, F.col("a") == F.col("node"))
    partners = dealt.join(texts, F.col("b") == F.col("node"))
    rows = hubs.select("a", "slot", F.lit(None).cast("long").alias("b"), "text").union(
        partners.select("a", "slot", "b", "text")
    )
    rows = rows.repartition("a", "slot").sortWithinPartitions("a", "slot", F.asc_nulls_first("b"))
    return map_batches(rows, _confirm(size, percent), "a long, b long")


def star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) of each bucket's hub with its other members of a similar size."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    meetings = members.join(sizes, "bucket").groupBy("node").agg(F.sum("_n").alias("_meets"))
    ranked = members.join(meetings, "node").withColumn("_rank", F.struct(-F.col("_meets"), F.col("node")))
    hubs = ranked.groupBy("bucket").agg(F.min_by(F.struct("node", "n_shingles"), "_rank").alias("hub"))
    pairs = members.join(hubs, "bucket").filter("hub.node != node")
    alike = 100 * F.least("n_shingles", "hub.n_shingles") >= percent * F.greatest("n_shingles", "hub.n_shingles")
    return pairs.filter(alike).select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()


def unsettled(members: DataFrame, trees: DataFrame) -> DataFrame:
    """(node, component) of all members of buckets that hold more than one component."""
    of = trees.select(F.col("a").alias("node"), F.col("b").alias("component"))
    known = members.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ends = known.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("_n"))
    # Two members were compared with each other, whatever came of it.
    open_buckets = ends.filter("_low != _high AND _n > 2").select("bucket")
    return known.join(open_buckets, "bucket", "left_semi").select("node", "component").distinct()


def _exploded(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(2)):
                sets = shingle_sets(batch.column(2)[low:high], size)
                counts = np.array([len(s) for s in sets], dtype=np.int64)
                rows = pa.array(np.repeat(np.arange(low, high), counts))
                sums = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(np.repeat(counts, counts)),
                        pa.array(np.repeat(sums, counts).view(np.int64)),
                        pa.array(np.concatenate(sets).view(np.int64)),
                    ],
                    names=["node", "component", "n", "own", "shingle"],
                )

    return run


def rare_pairs(nodes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of different components that an exact set-similarity join cannot rule out.

    The shingles of each node are put in the order of how many nodes have them. Nodes that are
    similar enough share one among their rarest, at a place that leaves room for all the others that they must share.
    """
    rows = nodes.join(texts, "node").select("node", "component", "text")
    rows = stored(
        map_batches(rows, _exploded(size), "node long, component long, n long, own long, shingle long"), "shingles"
    )
    counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("_df"))
    ordered = (
        rows.join(counts, "shingle")
        .groupBy("node", "component", "n", "own")
        .agg(F.sort_array(F.collect_list(F.struct("_df", "shingle"))).alias("_all"))
    )
    probe = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    prefix = stored(
        ordered.select("node", "component", "n", F.posexplode(F.slice("_all", F.lit(1), probe)).alias("place", "_s"))
        .filter("_s._df > 1")
        .select("node", "component", "n", "place", F.col("_s.shingle").alias("shingle")),
        "prefix",
    )
    both = F.col("x.n") + F.col("y.n")
    room = 1 + F.least(F.col("x.n") - F.col("x.place") - 1, F.col("y.n") - F.col("y.place") - 1)
    short = F.col("n") - F.ceil(2 * F.col("n") * percent / (100 + percent))
    return (
        prefix.alias("x")
        .join(prefix.filter(F.col("place") <= short).alias("y"), F.col("x.shingle") == F.col("y.shingle"))
        .filter("x.component != y.component AND (x.n > y.n OR x.n = y.n AND x.node > y.node)")
        .filter((100 * F.col("y.n") >= percent * F.col("x.n")) & (room >= F.ceil(both * percent / (100 + percent))))
        .select(F.col("y.node").alias("a"), F.col("x.node").alias("b"))
        .distinct()
    )


def ids_of_several_texts(sets: DataFrame, content: list[str]) -> DataFrame:
    differ = [F.min(c) != F.max(c) for c in content]
    by_id = sets.groupBy("doc_id").agg((differ[0] | differ[1] | differ[2]).alias("_differ"))
    return by_id.filter("_differ").select("doc_id")


def _links_of_ids(sets: DataFrame, several: DataFrame, classes: DataFrame, content: list[str]) -> DataFrame:
    """(a, b) that join the classes of an id with several texts."""
    held = sets.join(several, "doc_id", "left_semi").select("doc_id", *content)
    return held.join(classes, content).filter("doc_id != node").select(
        F.col("node").alias("a"), F.col("doc_id").alias("b")
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    percent: int = 80,
    bands: int = 28,
    rows: int = 4,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents whose sets of ``words``-word shingles have a Jaccard similarity
    of ``percent`` / 100 or more are linked. ``component_id`` is the smallest
    id reachable over links, ``kept`` marks it. At the threshold itself a link
    misses all bands with a probability of (1 - 0.8 ** rows) ** bands, four in
    ten million by default. Sets are held as 64-bit hashes.

    Null or empty texts have no shingles and stay alone, as do rows without an
    id, whose component is null and which are kept. Rows that share an id are
    one document, linked by any of its texts. Other columns are not read. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    sets = stored(
        map_batches(
            docs,
            _sketch(words, bands, rows),
            "doc_id long, n_shingles long, sum1 long, sum2 long, bands array<long>",
        ),
        "sets",
    )
    content = ["n_shingles", "sum1", "sum2"]
    linkable = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy(*content).agg(F.min("doc_id").alias("node"))
    in_bands = (
        linkable.groupBy(*content)
        .agg(F.min(F.struct("doc_id", "bands")).alias("_first"))
        .select(F.col("_first.doc_id").alias("node"), "n_shingles", F.explode("_first.bands").alias("bucket"))
    )
    shared = in_bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    members = stored(in_bands.join(shared.select("bucket"), "bucket", "left_semi"), "banded")
    wanted = members.select("node").distinct()
    texts = stored(
        docs.join(wanted.hint("shuffle_hash"), F.col("doc_id") == F.col("node")).select("node", "text"),
        "candidates",
    )

    found = confirmed(star_pairs(members, percent), texts, words, percent)
    several = ids_of_several_texts(linkable, content)
    if not several.isEmpty():
        found = found.union(_links_of_ids(linkable, several, classes, content))
    links = stored(found, "links")
    trees = components(links)
    rest = stored(unsettled(members, trees), "unsettled")
    if not rest.isEmpty():
        more = stored(confirmed(rare_pairs(rest, texts, words, percent), texts, words, percent), "links")
        if not more.isEmpty():
            trees = components(links.union(more))
    of_class = classes.join(trees, F.col("node") == F.col("a"), "left").select(
        *content, F.coalesce("b", "node").alias("_component")
    )
    return (
        sets.drop("bands")
        .join(of_class, content, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
