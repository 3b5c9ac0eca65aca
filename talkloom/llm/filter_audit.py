"""Interaction of row filters over all orders they can be applied in.

The filters already applied form a state of the subset lattice; an edge adds one filter. What an
edge removes depends on its state alone, so one pass that counts documents by the set of filters they
fail (``part`` by failure mask) holds all there is to know. Forward path counts say how many
orders reach a state, backward counts how many lead on from it; their product over an edge is the
number of orders that walk it, which weights its removals for the Shapley values. The report of
each order reads its steps from the same edges.

Rows are counted before anything is combined: per part there are at most 2^k masks, (k 2^(k-1))
edges and k! orders, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from talkloom.llm.work import Work, internal

MASK, ID, DIGEST = internal("mask", "id", "digest")
COUNTS = ("docs", "good", "toxic")


def lattice(k: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders that walk the edge) for every edge, by forward and backward path counts."""
    full = (1 << k) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(full + 1):  # a subset is a smaller number than any set that holds it
        for f in range(k):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in range(full, -1, -1):
        for f in range(k):
            if state >> f & 1:
                leave[state ^ 1 << f] += leave[state]
    return [(s, f, reach[s] * leave[s | 1 << f]) for s in range(full + 1) for f in range(k) if not s >> f & 1]


def repeats(rows: DataFrame, id_col: str, digest: str, name: str) -> DataFrame:
    """``rows`` with ``name``: whether a row of smaller id has the same digest. Null ids are neither smaller nor repeats.

    The smallest id of a digest is found by map-side minima and joined back on digest and id together,
    so rows of one text that a third of the corpus shares spread over their ids.
    """
    least = rows.where(F.col(id_col).isNotNull()).groupBy(F.col(digest).alias("_digest")).agg(F.min(id_col).alias("_least"))
    same = (F.col(digest) == F.col("_digest")) & (F.col(id_col) == F.col("_least"))
    return rows.join(least, same, "left").withColumn(name, F.col("_least").isNull() & F.col(id_col).isNotNull()).drop("_least", "_digest")


def failure_mask(failures: Sequence[Column]) -> Column:
    """Bit f is set where ``failures[f]`` is true; null counts as passed."""
    bits = [F.when(failed, F.lit(1 << f)).otherwise(F.lit(0)) for f, failed in enumerate(failures)]
    return reduce(lambda a, b: a + b, bits, F.lit(0))


def failure_counts(rows: DataFrame, part: Column, failures: Sequence[Column], good: Column, toxic: Column) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by the set of filters they fail."""
    slim = rows.select(part.alias("part"), failure_mask(failures).alias("mask"), good.alias("good"), toxic.alias("toxic"))
    return slim.groupBy("part", "mask").agg(F.count("*").alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def edge_removals(counts: DataFrame, k: int) -> DataFrame:
    """(part, state, filter, orders, removed, good, toxic) for every edge of the lattice and every part, zeros included."""
    listed = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(n).cast("long").alias("orders")) for s, f, n in lattice(k)])
    edges = counts.withColumn("edge", F.explode(listed)).select("part", "mask", *COUNTS, "edge.*")
    # an edge removes what fails its filter and none of those applied before it
    hit = (F.col("mask").bitwiseAND(F.col("state")) == 0) & (F.col("mask").bitwiseAND(F.expr("shiftleft(1, filter)")) != 0)
    totals = [F.sum(F.when(hit, F.col(c)).otherwise(F.lit(0))).alias(f"cut_{c}") for c in COUNTS]
    return edges.groupBy("part", "state", "filter", "orders").agg(*totals)


def interaction_report(counts: DataFrame, names: str | Sequence[str], work: Work) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``counts`` as of ``failure_counts``; filter f is named ``names[f]`` and an order is their names in sequence.
    An empty ``counts`` gives no rows.
    """
    k = len(names)
    spark = counts.sparkSession
    counts = work.keep(counts, "masks")
    edges = work.keep(edge_removals(counts, k), "edges")
    whole = counts.groupBy("part").agg(F.sum("docs").alias("whole"))
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << f)) != 0, F.col("docs")).otherwise(F.lit(0))) for f in range(k)]
    alone = [F.sum(F.when(F.col("mask") == 1 << f, F.col("docs")).otherwise(F.lit(0))) for f in range(k)]
    per_filter = counts.groupBy("part").agg(F.array(*[F.struct(F.lit(f).alias("filter"), fails[f].alias("fails"), alone[f].alias("alone")) for f in range(k)]).alias("x"))
    per_filter = per_filter.select("part", F.explode("x").alias("x")).select("part", "x.*")
    value = edges.groupBy("part", "filter").agg(F.sum(F.col("cut_docs") * F.col("orders")).alias("shapley"))
    steps = []
    for order in permutations(range(k)):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(names[i] for i in order), step, state, f))
            state |= 1 << f
    walks = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, state int, filter int"))  # k! k rows
    rows = edges.join(walks, ["state", "filter"]).join(whole, "part").join(per_filter, ["part", "filter"]).join(value, ["part", "filter"])
    # what an order removed up to a step is the sum of its edges so far
    so_far = F.sum("cut_docs").over(Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("whole") - so_far).alias("kept"),
        F.col("cut_docs").alias("removed"),
        (F.col("fails") - F.col("cut_docs")).alias("redundant"),
        F.col("alone").alias("unique_fails"),
        F.col("cut_good").alias("good_lost"),
        F.col("cut_toxic").alias("toxic_lost"),
        "shapley",
    )


# --- fixed values: what the five text filters look at ---
SPACES = "\t\n\x0b\f\r"
UPPER = "[^A-Z]+"
MARKS = "[#$%&*|]"
# --- end of fixed values ---


def text_failures(text: Column, least_words: int = 100, distinct_percent: int = 80, upper_percent: int = 10) -> list[Column]:
    """Failure conditions A to D of a text (null counts as empty): few words, few distinct words, many capitals, marks."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")
    many, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(F.regexp_replace(text, UPPER, ""))
    return [many < least_words, 100 * distinct < distinct_percent * many, 100 * capitals > upper_percent * F.char_length(text), text.rlike(MARKS)]


def audit_text_filters(
    docs: DataFrame, labels: DataFrame, work: Work | None = None, id_col: str = "doc_id", text: str = "text", part: str = "lang", names: str = "ABCDE"
) -> DataFrame:
    """The report over filters A to D of ``text_failures`` and E: identical to the text of a smaller id.

    E looks at the whole table, whatever else removes that smaller row. Null texts are empty, a null part is the
    empty string, a null id has no label and never fails E; repeated ids fail E unless they are the smallest.
    ``labels`` (doc_id, quality, toxic) may repeat an id: one row that says so is enough. An empty table
    gives no rows. Texts are read once, and only their digests are shuffled.
    """
    work = work or Work(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    mask = failure_mask(text_failures(F.col(text)))
    digest = F.unhex(F.sha2(whole.cast("binary"), 256))
    slim = docs.select(F.col(id_col).alias(ID), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.alias(MASK), digest.alias(DIGEST))
    slim = work.keep(slim, "texts")
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias(ID)).agg(F.max((F.col("quality") == 1)).alias("good"), F.max((F.col("toxic") == 1)).alias("toxic"))
    rows = repeats(slim, ID, DIGEST, "again").join(told, ID, "left")
    failures = [F.col(MASK).bitwiseAND(F.lit(1 << f)) != 0 for f in range(4)] + [F.col("again")]
    counts = failure_counts(rows, F.col("part"), failures, F.col("good"), F.col("toxic"))
    return interaction_report(counts, names, work)
