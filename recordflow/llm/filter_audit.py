"""What each of five filters removes in every order, from counts per set of failed filters.

A document's removal depends on the set of filters it fails (its mask) and the order alone. In the
lexicographic list of all orders, those that begin with the same letters are neighbours. A mask is removed at a
step by one of its filters exactly where the letters before it are others, so its removals at that
step are a few intervals of ranks. Counts are added where an interval begins and taken off where it
ends, and prefix sums over the ranks give the totals of every order.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.operators.lookups import lookup, saved, saved_rows

LETTERS = "ABCDE"
SPACE = "[\\x20\\x09-\\x0D]+"
MEASURES = ("removed", "good_lost", "toxic_lost")


def first_rank(prefix: str, letters: str = LETTERS) -> int:
    """The rank of the first permutation of ``letters`` that begins with ``prefix``."""
    rank, left = 0, sorted(letters)
    for c in prefix:
        rank += left.index(c) * factorial(len(left) - 1)
        left.remove(c)
    return rank


def removals(letters: str = LETTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, start, end): ranks of the orders in which a document of the mask goes at the step."""
    out = []
    for mask in range(1, 1 << len(letters)):
        failed = [c for i, c in enumerate(letters) if mask >> i & 1]
        passed = [c for c in letters if c not in failed]
        for before in range(len(passed) + 1):
            for prefix in permutations(passed, before):
                for c in failed:
                    start = first_rank("".join(prefix) + c, letters)
                    out.append((mask, before + 1, start, start + factorial(len(letters) - before - 1)))
    return out


def failures(body: Column) -> list[Column]:
    """Whether a text that is not null fails A (short), B (repetitive), C (capitals), D (symbols)."""
    bare = F.btrim(body, F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(bare, SPACE)  # an empty text splits into one empty word
    count = F.size(words) - (bare == "").cast("int")
    distinct = F.size(F.array_distinct(words)) - (bare == "").cast("int")
    capitals = F.length(F.regexp_replace(body, "[^A-Z]", ""))
    return [
        count < 200,
        100 * distinct < 50 * count,
        F.lit(100).cast("long") * capitals > 2 * F.length(body),
        body.rlike("[#$%&*|]"),
    ]


def bits(failed: list[Column], first: int = 0) -> Column:
    return sum((c.cast("int") * (1 << i) for i, c in enumerate(failed, first)), F.lit(0))


def filter_marks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``part`` (source), ``mask`` of failed filters, ``good`` and ``toxic``."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = saved(
        docs.select(
            "doc_id",
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(body, 256)).alias("digest"),
            bits(failures(body)).alias("mask"),
        ),
        "audit_rows",
    )
    ids = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts, copied = saved_rows(ids.filter("first < last").select("digest", "first"), "audit_firsts")
    marked = lookup(rows, firsts, ["digest"], entries=copied)
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    marked = marked.select("doc_id", "part", (F.col("mask") + bits([copy], 4)).alias("mask"))

    def holds(name: str) -> Column:
        return F.max(F.coalesce((F.col(name) == 1).cast("long"), F.lit(0)))

    known = labels.filter("doc_id is not null").groupBy("doc_id")
    known = known.agg(holds("quality").alias("good"), holds("toxic").alias("toxic")).filter("good + toxic > 0")
    table, entries = saved_rows(known, "audit_labels")
    return lookup(marked, table, ["doc_id"], entries=entries).select(
        "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )


def audit(marks: DataFrame) -> DataFrame:
    """(``part``, ``filter_order``, ``step``, counts) from ``part``, ``mask``, ``good`` and ``toxic``."""
    spark = marks.sparkSession
    counts = saved(
        marks.groupBy("part", "mask").agg(
            F.count(F.lit(1)).alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")
        ),
        "audit_counts",
    )
    places = spark.createDataFrame(removals(), "mask int, step int, start int, end int")  # 840 rows
    here = F.array(
        F.struct(F.col("start").alias("rank"), *[F.col(m) for m in MEASURES]),
        F.struct(F.col("end").alias("rank"), *[(-F.col(m)).alias(m) for m in MEASURES]),
    )
    ends = counts.join(F.broadcast(places), "mask").select("part", "step", F.explode(here).alias("e"))

    def fails(i: int) -> Column:
        return F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("removed")).otherwise(0))

    def fails_only(i: int) -> Column:
        return F.sum(F.when(F.col("mask") == 1 << i, F.col("removed")).otherwise(0))

    totals = counts.groupBy("part").agg(
        F.sum("removed").alias("total"),
        F.array(*[fails(i) for i in range(len(LETTERS))]).alias("fails"),
        F.array(*[fails_only(i) for i in range(len(LETTERS))]).alias("only"),
    )
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])  # in lexicographic order
    ranks = factorial(len(LETTERS))
    letter = F.ascii(F.expr("substring(filter_order, step, 1)")) - ord(LETTERS[0])
    grid = (
        totals.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
        .withColumn("filter_order", F.get(orders, F.col("rank")))
        .select(
            "part", "step", "rank", *[F.lit(0).cast("long").alias(m) for m in MEASURES],
            "total", "filter_order", F.get("fails", letter).alias("fails"), F.get("only", letter).alias("only"),
        )
    )
    empty = [F.lit(None).cast(t).alias(n) for n, t in grid.dtypes[-4:]]
    steps = (
        ends.select("part", "step", "e.*", *empty)
        .filter(F.col("rank") < ranks)
        .union(grid)
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(m).alias(m) for m in MEASURES], *[F.max(n).alias(n) for n in grid.columns[-4:]])
    )
    up_to = Window.unboundedPreceding, Window.currentRow
    by_rank = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(*up_to)
    by_step = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(*up_to)
    sums = steps.select(
        "part", "filter_order", "step", "rank", "total", "fails", "only", *[F.sum(m).over(by_rank).alias(m) for m in MEASURES]
    ).withColumn("gone", F.sum("removed").over(by_step))
    by_filter = Window.partitionBy("part", F.expr("substring(filter_order, step, 1)"))
    return sums.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("gone")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        F.col("only").alias("unique_fails"),
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(by_filter).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per source of ``docs``, order of the five filters and step, with zeros where nothing
    happens: ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost``, ``shapley``.

    ``docs`` has ``doc_id``, ``text`` and ``source``, and ``labels`` has ``doc_id``, ``quality`` and ``toxic``.
    A null text is empty: it fails A, and E where another empty text has a smaller id. A null
    source and an empty one are one part, the empty string. A row without an id counts in its part, is no
    copy, makes none and has no label. Rows that repeat count each time, and rows of the same id and text are not copies
    of each other. Of labels that repeat an id, any 1 counts. An empty table gives no rows. Other columns are not looked at.

    Texts are read once and compared by their SHA-256. A common text or source is summed before it
    is shuffled, and from then on there are at most 32 rows a source.
    """
    return audit(filter_marks(docs, labels))


def oracle() -> str:
    letters = ", ".join(f"('{c}', {i})" for i, c in enumerate(LETTERS))
    return f"""
        WITH firsts AS (
            SELECT coalesce(text, '') AS t, min(doc_id) AS first FROM documents GROUP BY ALL
        ), words AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), known AS (
            SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
        ), marks AS (
            SELECT part, [len(w) < 200,
                    100 * len(list_distinct(w)) < 50 * len(w),
                    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                    regexp_matches(t, '[#$%&*|]'),
                    coalesce(doc_id > first, false)] AS fails,
                   coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
            FROM words LEFT JOIN firsts USING (t) LEFT JOIN known USING (doc_id)
        ), counts AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marks GROUP BY ALL
        ), letters(c, i) AS (VALUES {letters}
        ), orders AS (
            SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS places
            FROM letters a JOIN letters b ON b.i <> a.i JOIN letters c ON c.i NOT IN (a.i, b.i)
            JOIN letters d ON d.i NOT IN (a.i, b.i, c.i) JOIN letters e ON e.i NOT IN (a.i, b.i, c.i, d.i)
        ), steps AS (
            SELECT filter_order, places, unnest(range(1, 6)) AS step FROM orders
        ), seen AS (
            SELECT part, filter_order, step, n, good, toxic, fails[places[step] + 1] AS failing,
                   list_bool_or(list_transform(range(1, step), lambda j: fails[places[j] + 1])) IS TRUE AS before,
                   len(list_filter(fails, lambda x: x)) AS failed
            FROM counts, steps
        ), summed AS (
            SELECT part, filter_order, step::INT AS step,
                   sum(n) FILTER (NOT failing AND NOT before) AS kept,
                   sum(n) FILTER (failing AND NOT before) AS removed,
                   sum(n) FILTER (failing AND before) AS redundant,
                   sum(n) FILTER (failing AND failed = 1) AS unique_fails,
                   sum(good) FILTER (failing AND NOT before) AS good_lost,
                   sum(toxic) FILTER (failing AND NOT before) AS toxic_lost
            FROM seen GROUP BY ALL
        )
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, filter_order[step]), 0)::BIGINT AS shapley
        FROM summed
    """
