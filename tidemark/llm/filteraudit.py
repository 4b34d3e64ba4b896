"""What every order of a set of filters removes, by difference arrays over permutation ranks.

Five filters can be applied in 120 orders. A document is described by the mask of filters it
fails, so the table is read once and only counts by part and mask are left. For one mask, the
orders that remove a document at a given step form intervals in the lexicographic numbering of
the orders: all orders that begin with the same letters follow one another, and that beginning
decides the step. A count is added at the first rank of each interval and taken away after its
last; sums along the 120 ranks then give what every order removes at every step. The intervals
follow from the number of filters alone.

Defined results: a null text is an empty one, a null language the part ''. A key without labels,
or with null labels, is neither good nor toxic; of several label rows of a key one is enough. A row
without a key is never a copy and is a first occurrence for nobody. Rows that share key and text
count each, and are no copies of each other. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from functools import cache
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import prepare, stored

FILTERS = "ABCDE"
MIN_WORDS = 200
SPACE = " \t\n\x0b\f\r"
_MARK = "[#$%&*|]"
#: What an interval of ranks says of a step: the document goes here, or fails here after it went.
REMOVED, REDUNDANT = 0, 1


@cache
def orders() -> list[str]:
    """All orders by their rank."""
    return ["".join(order) for order in permutations(FILTERS)]


@cache
def intervals() -> list[tuple[int, int, int, int, int]]:
    """(mask, step, kind, first rank, rank after the last), neighbours joined.

    An interval holds the orders with one beginning. For a mask, the beginning's last letter decides
    whether the step fails, and the letters before it whether the document is still there.
    """
    found: list[tuple[int, int, int, int, int]] = []
    size = len(FILTERS)
    for mask in range(1, 1 << size):
        fails = [bool(mask >> place & 1) for place in range(size)]
        for step in range(1, size + 1):
            block = 1
            for n in range(2, size - step + 1):
                block *= n
            open_at: dict[int, list[int]] = {}
            for number, beginning in enumerate(permutations(range(size), step)):
                if not fails[beginning[-1]]:
                    continue
                kind = REDUNDANT if any(fails[place] for place in beginning[:-1]) else REMOVED
                first, after = number * block, (number + 1) * block
                if kind in open_at and open_at[kind][1] == first:
                    open_at[kind][1] = after
                else:
                    if kind in open_at:
                        found.append((mask, step, kind, *open_at[kind]))
                    open_at[kind] = [first, after]
            found += [(mask, step, kind, *span) for kind, span in open_at.items()]
    return found


def _masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail exactly these filters."""
    text = F.coalesce("text", F.lit(""))
    inner = F.btrim(text, F.lit(SPACE))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))

    def bit(place: int, failed: Column) -> Column:
        return F.when(failed, 1 << place).otherwise(0)

    read = docs.select(
        F.col("doc_id").alias("key"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.sha2(text, 256).alias("same"),
        F.size(words).alias("words"),
        F.size(F.array_distinct(words)).alias("distinct_words"),
        capitals.alias("capitals"),
        F.char_length(text).alias("chars"),
        text.rlike(_MARK).alias("marked"),
    )
    mask = (
        bit(0, F.col("words") < MIN_WORDS)
        + bit(1, 100 * F.col("distinct_words").cast("long") < 50 * F.col("words"))
        + bit(2, 100 * F.col("capitals").cast("long") > 3 * F.col("chars"))
        + bit(3, F.col("marked"))
    )
    # One short row per text, key and part: rows that share all three are counted before they move.
    rows = stored(read.select("key", "part", "same", mask.alias("mask")).groupBy("key", "part", "same", "mask").agg(F.count("*").alias("n")))
    # The rows with the least key of their text. Joined by key and text, so a text that a third of
    # all rows have is as many different keys.
    first = rows.filter("key IS NOT NULL").groupBy("same").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    marks = labels.groupBy(F.col("doc_id").alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    copy = F.col("key").isNotNull() & F.col("first").isNull()
    joined = rows.join(first, ["key", "same"], "left").join(marks, "key", "left")
    return joined.groupBy("part", (F.col("mask") + bit(4, copy)).alias("mask")).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes at each step of each order, per part (see the module's text).

    The result has 600 rows a part. ``docs`` has doc_id, text, lang; ``labels`` has doc_id, quality, toxic.
    """
    spark = prepare(docs.sparkSession)
    masks = stored(_masks(docs, labels))
    # Fixed tables that the number of filters gives: 1,500 intervals and 120 orders.
    spans = F.broadcast(spark.createDataFrame(intervals(), "mask int, step int, kind int, first int, after int"))
    names = F.broadcast(spark.createDataFrame(list(enumerate(orders())), "rank int, filter_order string"))

    ends = F.explode(F.array(
        F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")),
        F.struct(F.col("after").alias("rank"), F.lit(-1).alias("sign")),
    )).alias("end")
    gone, late = F.col("kind") == REMOVED, F.col("kind") == REDUNDANT
    edges = (
        masks.join(spans, "mask")
        .select("part", "step", "kind", "n", "good", "toxic", ends)
        .groupBy("part", "step", F.col("end.rank").alias("rank"))
        .agg(*[
            F.sum(F.when(when, F.col("end.sign") * F.col(column)).otherwise(0)).alias(name)
            for name, when, column in (("removed", gone, "n"), ("good_lost", gone, "good"),
                                       ("toxic_lost", gone, "toxic"), ("redundant", late, "n"))
        ])
    )
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    ranks = F.explode(F.sequence(F.lit(0), F.lit(len(orders()) - 1))).alias("rank")
    parts = masks.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.when(F.col("mask") == 1 << place, F.col("n")).otherwise(0)).alias(f"only_{letter}")
          for place, letter in enumerate(FILTERS)],
    )
    cells = parts.select("*", steps).select("*", ranks).join(edges, ["part", "step", "rank"], "left")
    counts = ("removed", "redundant", "good_lost", "toxic_lost")
    summed = cells.selectExpr("part", "total", "step", "rank", *[f"only_{letter}" for letter in FILTERS], *[
        f"sum(coalesce({c}, 0)) OVER (PARTITION BY part, step ORDER BY rank) AS {c}" for c in counts
    ])
    named = summed.join(names, "rank").withColumn("letter", F.expr("substr(filter_order, step, 1)"))
    shares = named.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    only = F.coalesce(*[F.when(F.col("letter") == letter, F.col(f"only_{letter}")) for letter in FILTERS])
    left = F.expr("total - sum(removed) OVER (PARTITION BY part, rank ORDER BY step)")
    return (
        named.withColumn("unique_fails", only)
        .withColumn("kept", left)
        .join(shares, ["part", "letter"])
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                "good_lost", "toxic_lost", "shapley")
    )
