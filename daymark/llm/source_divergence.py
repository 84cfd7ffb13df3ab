"""How the sources of a language differ in their terms, priced over joint tables of count levels.

A group is one source of one language. Its price of a term depends on the
term's count there alone, so the distance of two groups is a sum over the
joint table of their count levels: how many terms have level a in one and
level b in the other. All joint tables of a language are one product: terms
are rows, (group, level) pairs are indicator columns, and the matrix times its
own transpose counts terms per pair of columns. The product is taken in exact
blocks: slabs of terms by tiles of groups. Each block is priced where it is
made, and only sums per pair of groups leave the task.

Defined results: null texts, languages and sources are empty strings. Repeated
rows and rows with a null id count as documents of their own. A group without
terms takes part; a language without kept terms has distance 0 between all its
sources and no term rows. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import let_workers_import, map_batches
from daymark.llm.terms import encoded_words
from daymark.llm.text import LETTER_OR_DIGIT, slices

LEAST_DOCUMENTS = 30
SCALE = 1_000_000_000
PRIOR = 5
SLICE = 8 << 20
TERMS_PER_SLAB = 8192
GROUPS_PER_TILE = 32
MOST_COLUMNS = 2048
FEWEST_TERMS = 16

# Bytes of terms `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`.
LETTER = LETTER_OR_DIGIT.copy()
LETTER[0x30:0x3A] = False

COUNTED = "lang string, source string, term string, n bigint, n_docs bigint"
PARTIAL = "lang string, source string, other string, value bigint, n_terms bigint"


def _count_terms(limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column("text"), limit):
                yield _counts(batch.slice(low, high - low))

    return count


def _counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Occurrences and documents of each term, for each group of these rows."""
    codes, terms, first = encoded_words(batch.column("text"), LETTER, lower=True)
    width = max(len(terms), 1)
    langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    n_sources = max(len(sources.dictionary), 1)
    pair = langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy()
    pairs, group = np.unique(pair, return_inverse=True)
    docs = np.repeat(np.arange(batch.num_rows), np.diff(first))
    in_doc, times = np.unique(docs * width + codes, return_counts=True)
    cell = group[in_doc // width] * width + in_doc % width
    cells, place = np.unique(cell, return_inverse=True)
    n = np.zeros(len(cells), dtype=np.int64)
    np.add.at(n, place, times)
    of = pairs[cells // width]
    return pa.RecordBatch.from_pydict({
        "lang": langs.dictionary.take(pa.array(of // n_sources)),
        "source": sources.dictionary.take(pa.array(of % n_sources)),
        "term": terms.take(pa.array(cells % width)).cast(pa.string()),
        "n": pa.array(n),
        "n_docs": pa.array(np.bincount(place, minlength=len(cells)).astype(np.int64)),
    })


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def kept_terms(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, in_lang): counts of the terms in at least so many documents of their language.

    ``in_lang`` is the count in the language. Terms that a group lacks have no row.
    """
    rows = docs.select(_filled("lang"), _filled("source"), _filled("text"))
    counted = map_batches(rows, _count_terms(SLICE), COUNTED)
    by_group = stored(
        counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "terms"
    )
    by_lang = by_group.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("n_docs").alias("n_docs"))
    kept = by_lang.filter(F.col("n_docs") >= least_documents).select("lang", "term", "in_lang")
    return by_group.drop("n_docs").join(kept, ["lang", "term"])


def _price(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exact for any 64-bit count."""
    above = f"cast({SCALE} as decimal(10, 0)) * cast({count} + {PRIOR} as decimal(20, 0))"
    return F.expr(f"1 + ({above}) div cast({total} + {PRIOR} * n_terms as decimal(20, 0))")


def _levels(prices: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns, column_prices, first): the indicator column of each (term, group) and the columns' prices.

    Group ``g`` has the columns ``first[g]`` to ``first[g + 1]``. Levels of one
    price are one column: they are priced alike.
    """
    columns = np.empty(prices.shape, dtype=np.int64)
    priced, first = [], [0]
    for g in range(prices.shape[1]):
        level, columns[:, g] = np.unique(prices[:, g], return_inverse=True)
        columns[:, g] += first[-1]
        priced.append(level)
        first.append(first[-1] + len(level))
    return columns, np.concatenate(priced), np.array(first)


def priced_product(prices: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sums of absolute price differences of all terms, for each left and each right group.

    ``prices`` has a row for each term and a column for each group; ``left``
    and ``right`` are numbers of groups. Rows are halved until the indicator
    matrix is narrow enough.
    """
    columns, column_prices, first = _levels(prices)
    n_terms, width = len(prices), len(column_prices)
    if width > MOST_COLUMNS and n_terms > FEWEST_TERMS:
        half = n_terms // 2
        return priced_product(prices[:half], left, right) + priced_product(prices[half:], left, right)
    marks = np.zeros((n_terms, width), dtype=np.float32)
    np.put_along_axis(marks, columns, 1, axis=1)
    spans = [np.concatenate([np.arange(first[g], first[g + 1]) for g in side]) for side in (left, right)]
    starts = [np.concatenate([[0], np.cumsum(first[side + 1] - first[side])[:-1]]) for side in (left, right)]
    # Counts of at most a slab's terms are exact in single precision.
    joint = marks[:, spans[0]].T @ marks[:, spans[1]]
    distance = np.abs(column_prices[spans[0]][:, None] - column_prices[spans[1]][None, :])
    value = joint.astype(np.int64) * distance
    return np.add.reduceat(np.add.reduceat(value, starts[0], axis=0), starts[1], axis=1)


def _tile(key: tuple[pa.Scalar, ...], entries: pa.Table) -> pa.Table:
    """Partial distances of the groups of two tiles over the terms of one slab."""
    lang, tile, other_tile = (k.as_py() for k in key[:3])
    sources = entries.column("source").combine_chunks().dictionary_encode()
    group = sources.indices.to_numpy()
    n_groups = len(sources.dictionary)
    tile_of, absent = np.zeros(n_groups, dtype=np.int64), np.zeros(n_groups, dtype=np.int64)
    tile_of[group] = entries.column("own_tile").to_numpy()
    absent[group] = entries.column("absent_price").to_numpy()
    named = entries.column("term").combine_chunks()
    present = named.is_valid().to_numpy(zero_copy_only=False)
    terms = named.drop_null().dictionary_encode()
    n_terms = len(terms.dictionary)
    prices = np.tile(absent, (n_terms, 1))
    prices[terms.indices.to_numpy(), group[present]] = entries.column("price").to_numpy()[present]
    # Terms of a similar frequency together have few levels.
    prices = prices[np.argsort(prices.sum(axis=1), kind="stable")]
    left, right = np.flatnonzero(tile_of == tile), np.flatnonzero(tile_of == other_tile)
    # A tile of the hash can lack groups, and a slab terms.
    some = n_terms and len(left) and len(right)
    value = priced_product(prices, left, right) if some else np.zeros((len(left), len(right)), np.int64)
    a, b = np.meshgrid(left, right, indexing="ij")
    a, b, value = a.ravel(), b.ravel(), value.ravel()
    if tile != other_tile:
        a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
    differ = a != b
    a, b, value = a[differ], b[differ], value[differ]
    names = sources.dictionary
    return pa.Table.from_pydict({
        "lang": pa.array([lang] * len(a), pa.string()),
        "source": names.take(pa.array(a)),
        "other": names.take(pa.array(b)),
        "value": pa.array(value),
        "n_terms": pa.array(np.full(len(a), n_terms, dtype=np.int64)),
    })


def _pair_distances(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) for every two sources of a language."""
    own_tile = F.pmod(F.xxhash64("source"), F.greatest(F.lit(1), F.ceil(F.col("n_groups") / GROUPS_PER_TILE)))
    slabs = F.greatest(F.lit(1), F.ceil(F.col("n_terms") / TERMS_PER_SLAB))
    info = groups.withColumns({"own_tile": own_tile, "n_slabs": slabs})
    info = info.withColumn("n_tiles", F.greatest(F.lit(1), F.ceil(F.col("n_groups") / GROUPS_PER_TILE)))
    placed = entries.join(info.select("lang", "source", "own_tile", "n_tiles", "n_slabs", "absent_price"), ["lang", "source"])
    placed = placed.withColumn("slab", F.pmod(F.xxhash64("term"), F.col("n_slabs")))
    # A group has one row in each slab, also where it lacks all terms.
    present = info.filter("n_terms > 0").withColumn("slab", F.explode(F.expr("sequence(0L, n_slabs - 1)")))
    shared = ["lang", "source", "own_tile", "n_tiles", "absent_price", "slab", "term", "price"]
    nothing = present.withColumns({"term": F.lit(None).cast("string"), "price": F.lit(0).cast("long")})
    rows = placed.select(*shared).unionByName(nothing.select(*shared))
    # Rows of tile t go to the blocks (t, u) for all u from t on, and (u, t) for all before it.
    block = F.expr("transform(sequence(0L, n_tiles - 1), u -> struct(least(own_tile, u) AS tile, greatest(own_tile, u) AS other_tile))")
    dealt = rows.withColumn("block", F.explode(block)).select(*shared, "block.*")
    let_workers_import(entries.sparkSession)
    partial = dealt.groupBy("lang", "tile", "other_tile", "slab").applyInArrow(_tile, PARTIAL)
    summed = partial.groupBy("lang", "source", "other").agg(
        F.sum("value").alias("value"), F.sum("n_terms").alias("n_met")
    )
    # The pairs of a language are the rows asked for.
    left = groups.select("lang", "source", "n_terms", "absent_price")
    right = groups.select("lang", F.col("source").alias("other"), F.col("absent_price").alias("other_absent"))
    pairs = left.join(right, "lang").filter("source != other").join(summed, ["lang", "source", "other"], "left")
    # Terms that a block has not met are absent from both groups.
    unmet = F.col("n_terms") - F.coalesce("n_met", F.lit(0))
    absent = F.coalesce(unmet * F.abs(F.col("absent_price") - F.col("other_absent")), F.lit(0))
    return pairs.select("lang", "source", "other", (F.coalesce("value", F.lit(0)) + absent).alias("value"))


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_terms: int = 50) -> DataFrame:
    """Distances between the sources of each language, and the terms that a source has more than its language.

    ``docs`` has text, lang and source; other columns are ignored. Returns
    lang, source, part, item, value, rank: part "pair" has a row for each other
    source of the language, part "term" the ``most_terms`` terms whose price in
    the group is most above that in the language.
    """
    kept = stored(kept_terms(docs, least_documents), "kept")
    lang_terms = kept.select("lang", "term", "in_lang").distinct()
    langs = lang_terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("in_lang").alias("lang_total"))
    present = docs.select(_filled("lang"), _filled("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = present.groupBy("lang").agg(F.count(F.lit(1)).alias("n_groups"))
    groups = present.join(sizes, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["n_terms", "lang_total", "total"])
    absent = F.when(F.col("n_terms") > 0, _price("0L", "total"))
    groups = stored(groups.withColumn("absent_price", absent), "groups")

    sums = groups.select("lang", "source", "total", "lang_total", "n_terms")
    priced = kept.join(sums, ["lang", "source"]).select(
        "lang", "source", "term", _price("n", "total").alias("price"), _price("in_lang", "lang_total").alias("lang_price")
    )
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pair_distances(priced.drop("lang_price"), groups).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value"
    )
    above = priced.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("price") - F.col("lang_price")).alias("value"),
    ).filter("value > 0")
    ranked_pairs = pairs.withColumn("rank", F.row_number().over(own))
    ranked_terms = above.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= most_terms)
    return ranked_pairs.unionByName(ranked_terms)
