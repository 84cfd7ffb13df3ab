"""Line deduplication by an exact set-similarity join, in DataFrame operations only.

Lines are sets of words; equal sets are one class, which its first line stands for. Words are
ordered by rarity: the largest count of any word in one of ``BUCKETS`` hash buckets, an array of fixed
size. If two sets are similar enough, the rarest words of each, its prefix, meet in at least one word.

* If the first word they share is rare, it is a bucket of candidates, of at most ``OFTEN`` lines.
* If not, all they share are frequent words, and each rare word is one of the few that the sets may
  differ by. The frequent words of a line are dealt by hash to 1, 2, 4, ... parts, up to more parts than words that
  may differ, so that one part at least is the same in both: each part is a bucket.

Length and positional filters and a bound on the words not shared thin the candidates out; the words
of both lines confirm what is left. Buckets of up to ``DIRECT`` lines are compared as they are. In larger ones
all lines are compared with the first, and only those that do not repeat it with others, so that
near copies of one line make few pairs among themselves. The candidate that looks closest is tried first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.storage import stored

BUCKETS = 1 << 20
BLOCK = 1 << 10
FILTER = 1 << 20
DIRECT = 128
OFTEN = 2048
MOST_AT_ONCE = 32
AT = ["doc_id", "line_no"]
ODD = ["odd", "odd_too"]


def _all_words(line: Column) -> Column:
    """The words of a line in order, lower-cased."""
    plain = F.when(line.rlike(r"[\t\x0B\f\r]"), F.regexp_replace(line, r"[\t\x0B\f\r]", " ")).otherwise(line)
    return F.array_remove(F.split(F.lower(plain), " "), "")


def words_of(line: Column) -> Column:
    """The distinct words of a line, lower-cased."""
    return F.array_distinct(_all_words(line))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, line_no (from 0), line."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _array_of(values: DataFrame, size: int, otherwise: Column) -> Column:
    """The largest ``value`` of each ``place`` below ``size``, as one array, put together from blocks."""
    every = values.sparkSession.range(size).select(F.col("id").cast("int").alias("place"), otherwise.alias("value"))
    largest = values.select("place", "value").union(every).groupBy("place").agg(F.max("value").alias("value"))
    blocks = largest.groupBy(F.shiftright("place", int(math.log2(BLOCK))).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", "value"))).alias("a")
    )
    blocks = blocks.select("block", F.col("a.value").alias("a"))
    joined = blocks.agg(F.array_sort(F.collect_list(F.struct("block", "a"))).alias("s"))
    return joined.select(F.flatten("s.a").alias("a"))


def _grade(n: Column) -> Column:
    """Counts by steps of a quarter of their doubling, from 0 for a word that occurs once."""
    return F.floor(4 * F.log2(n)).cast("int")


def rarity(lines: DataFrame) -> DataFrame:
    """One row: the grade of each word bucket, 0 if no word of it occurs twice, and the grade up to which words
    occur at most ``OFTEN`` times."""
    words = lines.select(F.explode(_all_words(F.col("line"))).alias("word"))
    counts = words.groupBy(F.xxhash64("word").alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    grades = counts.select(_bucket(F.col("hash")).alias("place"), _grade(F.col("n")).alias("value"))
    often = math.floor(4 * math.log2(OFTEN)) - 1
    return _array_of(grades, BUCKETS, F.lit(0)).select(F.col("a").alias("ranks"), F.lit(often).alias("often"))


def _prefix_size(n: Column, percent: int) -> Column:
    return (n - F.ceil(n * percent / 100) + 1).cast("int")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _part(key: Column, parts: Column) -> Column:
    return F.shiftright(key, 8).bitwiseAND(parts - 1)


def _parts_of(keys: Column, parts: Column, most: Column, own: Column) -> Column:
    """The buckets of ``keys`` dealt to ``parts`` parts. Empty ones count only if ``most`` words may
    touch all others; below the line's own number of parts fewer than ``parts`` words differ."""

    def named(dealt: Column) -> Column:
        empty = F.size(F.filter(dealt, lambda x: F.size(x) == 0))
        needed = parts - empty <= F.least(most, parts - 1)
        names = F.transform(
            dealt,
            lambda x, i: F.when(
                (F.size(x) > 0) | needed, F.struct(F.xxhash64(parts, i, x).alias("bucket"), own.alias("own"))
            ),
        )
        return F.filter(names, lambda x: x.isNotNull())

    ids = F.sequence(F.lit(0).cast("long"), parts - 1)
    return _let(F.transform(ids, lambda i: F.filter(keys, lambda k: _part(k, parts) == i)), named)


def line_sets(lines: DataFrame, percent: int, ranks: Column, often: Column) -> DataFrame:
    """doc_id, line_no, set, n, odd, odd_too, rare, frequent, most, parts and buckets: a row for each line.

    ``set`` tells sets of words apart. A word's 64-bit hash is turned so that its highest bits are the grade of its bucket. Bit i of
    ``odd`` and ``odd_too``, 128 in all, tells whether an odd number of words has a hash that ends in i. ``rare`` are the rare words
    of the prefix. At most ``most`` of the frequent words can be in one set only, if the first word shared with a similar
    line is frequent; ``parts`` is the power of two above. ``buckets`` are the parts, up to ``MOST_AT_ONCE``
    of them at a time; ``frequent`` holds the words if there are more.
    """
    hashes = F.array_distinct(F.transform(_all_words(F.col("line")), lambda w: F.xxhash64(w)))

    def ranked(h: Column) -> Column:
        grade = F.coalesce(F.get(F.col("ranks"), _bucket(h)), F.lit(0)).cast("long")
        return F.shiftleft(grade, 48).bitwiseOR(F.shiftrightunsigned(h, 16))

    hashed = lines.select(*AT, F.sort_array(hashes).alias("hashes"))
    # The array of grades is used once, and in the very next step, so that the optimizer makes one step of both:
    # else the array would be copied for every row. A lambda may not hold a subquery itself.
    name = F.struct(F.xxhash64("hashes").alias("x"), F.xxhash64(F.lit(1), "hashes").alias("y"))
    named = hashed.select(*AT, name.alias("set"), "hashes", ranks.alias("ranks"), often.alias("often"))
    keyed = named.select(*AT, "set", F.sort_array(F.transform("hashes", ranked)).alias("keys"), "often")
    one = F.lit(1).cast("long")

    def odd(second: int) -> Column:
        def turned(bits: Column, k: Column) -> Column:
            here = F.shiftright(k, 6).bitwiseAND(one).bitwiseXOR(F.lit(1 - second).cast("long"))
            return bits.bitwiseXOR(F.call_function("shiftleft", here, k.bitwiseAND(F.lit(63)).cast("int")))

        return F.aggregate("keys", F.lit(0).cast("long"), turned)

    n = F.size("keys")
    prefix = F.slice("keys", F.lit(1), _prefix_size(n, percent))
    # From here on words are told by the grade in their highest bits.
    above = F.shiftleft(F.col("often").cast("long") + 1, 48)
    n_frequent = F.size(F.filter("keys", lambda k: k >= F.col("above")))
    shortest = math.ceil(percent / (100 - percent))
    bits = [odd(i).alias(c) for i, c in enumerate(ODD)]
    sets = keyed.select(*AT, "set", "keys", n.alias("n"), *bits, prefix.alias("prefix"), above.alias("above"))
    # A prefix that ends in a rare word has rare words only; smaller sets are only similar to equal ones.
    all_rare = (F.col("n") < shortest) | (F.get("prefix", F.size("prefix") - 1) < F.col("above"))
    sets = sets.withColumn("n_frequent", F.when(all_rare, 0).otherwise(n_frequent))
    most = F.floor(F.col("n_frequent") * 100 / percent).cast("long") - F.col("n")
    sets = sets.withColumn("most", F.when(F.col("n_frequent") > 0, most).otherwise(-1))
    power = F.call_function("shiftleft", one, F.length(F.bin("most")))
    parts = F.when(F.col("most") > 0, power).when(F.col("most") == 0, one)
    sets = sets.withColumn("parts", F.coalesce(parts, F.lit(0).cast("long")))
    rare = F.when(F.col("n") >= shortest, F.filter("prefix", lambda k: k < F.col("above")))
    frequent = F.slice("keys", F.col("n") - F.col("n_frequent") + 1, F.col("n_frequent"))
    sets = sets.withColumns({"rare": rare, "_frequent": F.when(F.col("parts") > 0, frequent)})
    levels = F.filter(
        F.array(*[F.lit(1 << i).cast("long") for i in range(int(math.log2(MOST_AT_ONCE)) + 1)]),
        lambda x: x <= F.col("parts"),
    )
    buckets = F.flatten(
        F.transform(levels, lambda x: _parts_of(F.col("_frequent"), x, F.col("most"), x == F.col("parts")))
    )
    return sets.select(
        *AT,
        "set",
        "n",
        *ODD,
        "rare",
        F.when(F.col("parts") > MOST_AT_ONCE, F.col("_frequent")).alias("frequent"),
        "most",
        "parts",
        F.when(F.col("parts") > 0, buckets).alias("buckets"),
    )


def _many_parts(sets: DataFrame) -> DataFrame:
    """The buckets of more than ``MOST_AT_ONCE`` parts, each put together from its words."""
    line = [*AT, "n", *ODD, "most", "parts"]
    long = sets.filter("frequent IS NOT NULL").withColumn(
        "level",
        F.explode(
            F.transform(
                F.sequence(F.lit(int(math.log2(MOST_AT_ONCE)) + 1), F.log2("parts").cast("int")),
                lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i),
            )
        ),
    )
    words = long.select(*line, "level", F.explode("frequent").alias("key"))
    words = words.withColumn("part", _part(F.col("key"), F.col("level")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("level") - 1))
    empty = long.select(*line, "level", F.lit(None).cast("long").alias("key"), every.alias("part"))
    parts = words.unionByName(empty).groupBy(*line, "level", "part").agg(
        F.count("key").alias("size"), F.bit_xor(F.xxhash64("key")).alias("all")
    )
    n_empty = parts.groupBy(*AT, "level").agg(F.count(F.when(F.col("size") == 0, 1)).alias("n_empty"))
    parts = parts.join(n_empty, [*AT, "level"])
    needed = F.col("level") - F.col("n_empty") <= F.least("most", F.col("level") - 1)
    name = F.xxhash64("level", "part", "size", F.coalesce("all", F.lit(0).cast("long")))
    return parts.filter((F.col("size") > 0) | needed).select(
        *AT, "n", *ODD, F.lit(0).alias("place"), name.alias("bucket"), (F.col("level") == F.col("parts")).alias("own")
    )


def rare_rows(sets: DataFrame) -> DataFrame:
    """doc_id, line_no, n, odd, place, bucket and own: a row for each rare word of a line's prefix."""
    words = sets.select(*AT, "n", *ODD, F.posexplode("rare").alias("place", "_key"))
    # Never null, so that both sides of the join share their exchange.
    words = words.withColumn("bucket", F.coalesce("_key", F.lit(0).cast("long"))).drop("_key")
    # Words of the lowest grade occur once and meet no other.
    return words.filter(F.col("bucket") >= 1 << 48).withColumn("own", F.lit(True))


def part_rows(sets: DataFrame) -> DataFrame:
    """The same for the parts of a line's frequent words. Of two similar lines one has ``own`` parts in the bucket they share."""
    few = sets.select(*AT, "n", *ODD, F.lit(0).alias("place"), F.explode("buckets").alias("b"))
    return few.select(*AT, "n", *ODD, "place", "b.bucket", "b.own").unionByName(_many_parts(sets))


def bucket_rows(lines: DataFrame, percent: int, ranks: Column, often: Column) -> DataFrame:
    """The buckets of each line, copies included."""
    sets = line_sets(lines, percent, ranks, often)
    return rare_rows(sets).unionByName(part_rows(sets))


def _may_be_similar(x: str, y: str, percent: int) -> Column:
    """What places in a shared bucket, sizes and parities of two sets do not rule out."""

    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    n, m = col(x, "n"), col(y, "n")
    overlap = F.ceil((n + m) * percent / (100 + percent))
    room = 1 + F.least(n - col(x, "place") - 1, m - col(y, "place") - 1)
    # Each word that one of the sets lacks turns one bit at most.
    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & (room >= overlap)
        & (n + m - 2 * overlap >= _apart(x, y))
    )


def _apart(x: str, y: str) -> Column:
    first, second = (F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in ODD)
    return first + second


def maybe_among(column: Column, values: DataFrame) -> Column:
    """False only where ``column`` is none of the one column of ``values``: an array of ``FILTER`` marks."""

    def place(x: Column) -> Column:
        return F.pmod(F.xxhash64(x), F.lit(FILTER)).cast("int")

    marked = values.select(place(F.col(values.columns[0])).alias("place"), F.lit(True).alias("value"))
    return F.get(_array_of(marked, FILTER, F.lit(False)).scalar(), place(column))


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Lines that repeat an earlier one, among pairs (a, b, sizes) of lines, a before b; sizes is of both sets."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("at")).distinct(), "wanted")
    lines = lines_of(docs).select(F.struct(*AT).alias("at"), "line")
    lines = lines.filter(maybe_among(F.col("at"), wanted)).join(wanted, "at")
    sides = [lines.select(F.col("at").alias(s), F.col("line").alias(f"line_{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    shared = F.size(F.array_intersect(words_of(F.col("line_a")), words_of(F.col("line_b"))))
    # shared / (sizes - shared) >= percent / 100, with each side's words worked out once.
    same = both.filter((100 + percent) * shared >= percent * F.col("sizes"))
    return same.select(F.col("b").alias("at")).distinct()


def _at(side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in AT])


def _as_pair() -> list[Column]:
    return [
        _at("x").alias("a"),
        _at("y").alias("b"),
        _apart("x", "y").alias("apart"),
        (F.col("x.n") + F.col("y.n")).alias("sizes"),
    ]


def _pairs(earlier: DataFrame, later: DataFrame, percent: int) -> DataFrame:
    """(a, b, apart, sizes) of lines in the same bucket, a before b, that may be similar."""
    x, y = earlier.alias("x"), later.alias("y")
    same = F.col("x.bucket") == F.col("y.bucket")
    pairs = x.join(y, same & (_at("x") < _at("y")) & (F.col("x.own") | F.col("y.own")))
    return pairs.filter(_may_be_similar("x", "y", percent)).select(*_as_pair())


def _pairs_with_first(members: DataFrame, percent: int) -> DataFrame:
    """The same of members of buckets and the first member ``h`` of each."""
    both = members.select(F.col("h").alias("x"), F.struct(*AT, "n", *ODD, "place").alias("y"))
    both = both.filter((_at("x") < _at("y")) & _may_be_similar("x", "y", percent))
    return both.select(*_as_pair())


def _closest(pairs: DataFrame) -> DataFrame:
    closest = pairs.groupBy("b").agg(F.min(F.struct("apart", "a", "sizes")).alias("_first"))
    return closest.select("_first.a", "b", "_first.sizes")


def _without(some: DataFrame, at: Column, gone: DataFrame) -> DataFrame:
    return some.join(gone.select(F.col("at").alias("_gone")), at == F.col("_gone"), "left_anti")


def _repeating(pairs: DataFrame, docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Lines b that repeat the closest of the lines a in some candidates (a, b, apart, sizes), and the
    other candidates of lines that do not."""
    pairs = stored(pairs.groupBy("a", "b", "sizes").agg(F.min("apart").alias("apart")), "pairs")
    closest = _closest(pairs)
    found = stored(_confirmed(closest, docs, percent), "repeating")
    others = _without(pairs, F.col("b"), found).join(closest, ["a", "b"], "left_anti")
    return found, others.select("a", "b", "apart", "sizes")


def _repeated(sets: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The lines (at) that are similar to an earlier line; ``sets`` has no set of words twice."""
    words = rare_rows(sets)
    parts = stored(part_rows(sets), "parts")
    first = parts.groupBy("bucket").agg(
        F.min(F.struct(*AT, "n", *ODD, "place")).alias("h"), F.count(F.lit(1)).alias("size"), F.max("own").alias("_own")
    )
    # Without two lines, or one that has its own parts there, a bucket holds no pair.
    first = first.filter((F.col("size") > 1) & F.col("_own")).drop("_own")
    members = stored(parts.join(first, "bucket"), "members")
    small, large = members.filter(F.col("size") <= DIRECT), members.filter(F.col("size") > DIRECT)
    found = _pairs(words, words, percent).unionByName(_pairs(small, small, percent))
    removed, others = _repeating(found.unionByName(_pairs_with_first(large, percent)), docs, percent)
    among = _pairs(large, _without(large, F.struct(*AT), removed), percent)
    more, others = _repeating(others.unionByName(among), docs, percent)
    last = _confirmed(stored(others.select("a", "b", "sizes"), "others"), docs, percent)
    return removed.union(more).union(last).distinct()


def _classes(sets: DataFrame) -> DataFrame:
    """The first line of each set of words."""
    columns = [c for c in sets.columns if c != "set"]
    return sets.groupBy("set").agg(F.min(F.struct(*columns)).alias("first")).select("first.*")


def _copies(sets: DataFrame) -> DataFrame:
    """Lines (at) with the same set of words as an earlier line."""
    first = sets.groupBy("set").agg(F.min(F.struct(*AT)).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1").select(F.col("set").alias("_set"), "first")
    at = F.struct(*AT)
    return sets.join(first, F.col("set") == F.col("_set")).filter(at > F.col("first")).select(at.alias("at"))


def deduplicate_lines(
    docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one; n_lines and n_removed count them.

    A line repeats an earlier one of the corpus, in the order of ids and lines, if the Jaccard
    similarity of their sets of lower-cased words is ``percent`` / 100 or more. Lines without words stay. A null
    text has no lines and stays null, an empty one is one empty line. Rows without an id are
    not touched, rows that share an id count as copies of one document and lose the same line numbers. All other
    columns are kept; n_lines and n_removed replace columns of these names.
    """
    own = docs.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")
    )
    lines = lines_of(own)
    order = stored(rarity(lines), "rarity")
    ranks, often = order.select("ranks").scalar(), order.select("often").scalar()
    # Filtered once it is stored: before, the filter would work the sets out once more.
    sets = stored(line_sets(lines, percent, ranks, often), "sets").filter("n > 0")
    copies = _copies(sets)
    repeated = stored(copies.union(_repeated(_classes(sets), own, percent)), "repeated")
    removed = repeated.groupBy(F.col("at.doc_id").alias("_id")).agg(F.collect_set("at.line_no").alias("_lines"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # Only texts that may lose a line travel.
    touched = F.coalesce(maybe_among(F.col(id_column), repeated.select("at.doc_id").distinct()), F.lit(False))
    marked = docs.select(*kept).withColumn("_touched", touched)
    joined = marked.filter("_touched").join(removed, F.col(id_column) == F.col("_id"), "left")
    joined = joined.drop("_id").unionByName(marked.filter("NOT _touched"), allowMissingColumns=True)
    lines = F.split(text_column, "\n")
    left = F.when(
        F.col("_lines").isNotNull(),
        F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_lines", i)), "\n"),
    ).otherwise(F.col(text_column))
    return joined.select(
        *[left.alias(c) if c == text_column else F.col(c) for c in kept],
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_lines"), F.lit(0)).alias("n_removed"),
    )
