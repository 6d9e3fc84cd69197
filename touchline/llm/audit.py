"""Filter interaction audit: every order of the filters, folded over counted cells.

A document fails some set of filters, and only that set decides what each order of them
does. Documents are counted by part and set; a cell of that table walks all orders with
`aggregate` and `transform`, which gives one weighted struct for each order and step,
and a part's cells, at most one for each set of filters, are merged by elementwise sums.
Texts are read once and never move.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import materialise

FILTERS = "ABCDE"
WHITE = r"[\x20\x09-\x0D]+"
#: What an order and step has of each part; `unique_fails` and `shapley` follow the filter alone.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def own_failures(text: Column) -> Column:
    """The letters of the filters, but E, that a text fails: A under 50 words; B under 65
    distinct words in 100; C over 5 capitals in 100 characters; D marks of markup."""
    words = F.array_remove(F.split(text, WHITE, -1), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = {
        "A": n < 50,
        "B": distinct * 100 < n * 65,
        "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 5,
        "D": text.rlike(r"[#$%&*|]"),
    }
    return F.concat(*[F.when(fail, letter).otherwise("") for letter, fail in fails.items()])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failing, good, toxic) for every row of `docs`: its source, the letters of
    all filters that it fails, and its labels as 0 or 1."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("content"),
        own_failures(text).alias("own"),
    )
    rows = materialise(rows.join(materialise(known, "labels"), "doc_id", "left"), "failures")
    # Only contents that occur again can fail E; where a content is hot, its rows are one
    # side of a plain join, which adaptive execution deals to several tasks.
    earliest = rows.groupBy("content").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = rows.join(materialise(earliest.select("content", "first"), "copies"), "content", "left")
    failing = F.concat("own", F.when(F.col("doc_id") > F.col("first"), "E").otherwise(""))
    flags = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    return copies.select("part", failing.alias("failing"), *flags)


def _orders() -> Column:
    return F.array(*[F.array(*map(F.lit, order)) for order in permutations(FILTERS)])


def _fold(failing: Column, n: Column, good: Column, toxic: Column) -> Column:
    """What one cell adds to each order and step, orders and steps in a row."""
    none = F.lit(0).cast("long")

    def step(acc: Column, letter: Column) -> Column:
        alive, fails = acc["alive"], F.contains(failing, letter)
        here = alive & fails
        counts = {
            "kept": F.when(alive & ~fails, n), "removed": F.when(here, n), "redundant": F.when(~alive & fails, n),
            "unique_fails": F.when(failing == letter, n), "good_lost": F.when(here, good), "toxic_lost": F.when(here, toxic),
        }
        one = F.struct(*[c.otherwise(none).alias(name) for name, c in counts.items()])
        return F.struct((alive & ~fails).alias("alive"), F.array_append(acc["out"], one).alias("out"))

    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(kind).alias("out"))
    return F.flatten(F.transform(_orders(), lambda order: F.aggregate(order, start, step, lambda acc: acc["out"])))


def _sum(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per source of `docs` (doc_id, text, source), order of the filters and step, the
    documents kept, removed, redundant and lost (see `COUNTS`), zeros included, and the
    filter's removals summed over all orders (`shapley`).

    A null text is empty, a null source the empty string. E holds for texts equal to that
    of a smaller doc_id in any source; a row without id is nobody's copy and has none, and
    rows of one id are no copies of each other. Repeated rows count each. Of several
    labels of an id any 1 counts; null labels and labels of no document count nothing.
    Other columns are not read; an empty table gives no rows.
    """
    cells = failures(docs, labels).groupBy("part", "failing").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    folded = cells.select("part", _fold(*[F.col(c) for c in ("failing", "n", "good", "toxic")]).alias("cell"))
    merged = folded.groupBy("part").agg(F.collect_list("cell").alias("cells")).select(
        "part", F.aggregate(F.slice("cells", F.lit(2), F.size("cells")), F.col("cells")[0], _sum).alias("sums")
    )
    letters = F.flatten(_orders())
    removed = F.zip_with("sums", letters, lambda s, letter: F.struct(letter.alias("letter"), s["removed"].alias("removed")))
    by_filter = F.transform(
        F.array(*map(F.lit, FILTERS)),
        lambda f: F.aggregate(
            F.filter("removed", lambda r: r["letter"] == f), F.lit(0).cast("long"), lambda acc, r: acc + r["removed"]
        ),
    )
    rows = merged.withColumn("removed", removed).select("part", by_filter.alias("shapley"), F.posexplode("sums").alias("at", "sums"))
    order = F.element_at(_orders(), (F.floor(F.col("at") / len(FILTERS)) + 1).cast("int"))
    place = (F.col("at") % len(FILTERS) + 1).cast("int")
    shapley = F.element_at("shapley", F.position(F.element_at("order", F.col("step")), F.lit(FILTERS)))
    return (
        rows.withColumn("order", order).withColumn("step", place)
        .select("part", F.array_join("order", "").alias("filter_order"), "step", *[f"sums.{c}" for c in COUNTS], shapley.alias("shapley"))
    )
