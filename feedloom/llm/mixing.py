"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a target of words: a share of the budget by weight, never above `most` times its
size, the excess reshared by weight. Within a source documents stand in a fixed pseudo-random order
and its passes follow each other until the target is met. A schedule says how a source's weight
changes over training time 0 to 1; its integral is the cumulative demand for the source's words, so a
document whose words begin at some place of its source is due when the demand reaches that place. The
demand is inverted in closed form, and documents are range-sorted by that position.

DataFrame functions only. Places within a source are prefix sums over BUCKETS parts of each source's
order, so no task holds a whole source. The order is md5 of the id, so that reruns agree.

Nulls: a null text has size 0; a null source is a source of its own, last; a null id has its place by
the empty text. Documents of size 0 take 0 words. Rows alike in id, source and text share what falls to
them, a whole number of words each. Very long texts are only counted, whole. Empty tables give no rows; if no document has words, targets are 0. A column of the input that has the
name of a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import table, without
from feedloom.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
# Parts of a source's order; a source of a third of 10**10 rows has under a million rows in each.
BUCKETS = 4096

# Relative weight of a source at knots of training time, by the source's place in the cycle of WEIGHTS:
# the heavy sources begin strong and fade, the light ones come late.
Schedule = tuple[tuple[float, float], ...]
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 0.75), (1.0, 2.25)),
)

RESULT = ("size", "source_size", "target", "taken", "position", "again")
_WORDS = r"[^\x20\x09-\x0D]+"


def demand_position(fraction: Column, schedule: Schedule) -> Column:
    """Training time at which the cumulative demand of a piecewise linear schedule reaches `fraction`.

    Between two knots the weight is a + b x, its integral a x + b x^2 / 2; the root gives the time.
    """
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False)]
    whole, before, out = sum(areas), 0.0, None
    for ((t0, w0), (t1, w1)), area in zip(zip(schedule, schedule[1:], strict=False), areas, strict=True):
        due = fraction * F.lit(whole) - F.lit(before)
        slope = (w1 - w0) / (t1 - t0)
        if slope == 0:
            at = due / F.lit(w0) + F.lit(t0)
        else:
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + due * F.lit(2 * slope), F.lit(0.0)))
            at = (root - F.lit(w0)) / F.lit(slope) + F.lit(t0)
        inside = due <= F.lit(area)
        out = F.when(inside, at) if out is None else out.when(inside, at)
        before += area
    return F.least(F.greatest(out.otherwise(F.lit(schedule[-1][0])), F.lit(0.0)), F.lit(1.0))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(name, bare, source_size, target, cycle) of each source of `sizes` (name, bare, size).

    With caps `most` times the sizes, the targets are min(cap, level * weight) for the level at which
    they add up to the budget: sources in order of cap by weight are capped while the level of the
    rest is not below theirs.
    """
    totals = sizes.groupBy("name", "bare").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("cycle", (F.row_number().over(Window.orderBy("bare", "name")) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("cycle") + 1)
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "bare", "name")
    whole = Window.partitionBy()
    level = (
        F.lit(float(share)) * F.sum("source_size").over(whole)
        - (F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    ) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = capped.withColumn("level", level).withColumn("at", F.row_number().over(order))
    free = F.when(F.col("level") < F.col("cap") / F.col("weight"), F.struct("at", "level"))
    final = F.min(free).over(whole)["level"]
    return levels.withColumn("final", final).select(
        "name",
        "bare",
        "source_size",
        "cycle",
        F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight"))).alias("target"),
    )


def _measured(docs: DataFrame, key: str, text: str, source: str) -> list[Column]:
    """Columns of a document's place in its source's order and of the key that rows alike share."""
    place = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return [
        F.col(key).alias("id"),
        place.alias("place"),
        F.concat(place, F.hex(F.xxhash64(F.col(text), F.col(source)))).alias("mix_key"),
        F.coalesce(F.col(source), F.lit("")).alias("name"),
        F.col(source).isNull().cast("int").alias("bare"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(_WORDS)).cast("long"), F.lit(0)).alias("size"),
    ]


def mix(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    schedules: Sequence[Schedule] = SCHEDULES,
) -> DataFrame:
    """(mix_key, size, source_size, target, taken, position, again), a row for each document.

    `sizes` has id, place, mix_key, name, bare and size. Rows with the same mix_key are counted first
    and stand together; each of them takes the same whole number of words. `taken` counts the words
    that the mix takes of one document, repeats included; `position` is the training time of its first
    pass, `again` that of its second, null if there is none.
    """
    targets = source_targets(sizes, weights, share, most)
    alike = sizes.groupBy("mix_key", "place", "id", "name", "bare", "size").agg(F.count("*").alias("copies"))
    part = F.conv(F.substring("place", 1, 3), 16, 10).cast("int") % BUCKETS
    dealt = alike.withColumn("bucket", part).withColumn("words", F.col("size") * F.col("copies"))
    buckets = dealt.groupBy("name", "bare", "bucket").agg(F.sum("words").alias("held"))
    along = Window.partitionBy("name", "bare").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    before = buckets.withColumn("before", F.sum("held").over(along) - F.col("held")).drop("held")
    ahead = cut_lineage(before.join(targets, ["name", "bare"]))
    within = Window.partitionBy("name", "bare", "bucket").orderBy("place", "id", "size", "mix_key").rowsBetween(
        Window.unboundedPreceding, 0
    )
    placed = dealt.join(ahead, ["name", "bare", "bucket"]).withColumn(
        "begin", F.sum("words").over(within) - F.col("words") + F.col("before")
    )
    goal = F.floor(F.col("target"))
    due = [F.col("begin"), F.col("begin") + F.col("source_size")]
    parts = [F.greatest(F.least(goal - d, F.col("words")), F.lit(0)) for d in due]

    def time_of(begin: Column, words: Column) -> Column:
        fraction = begin / F.col("target")
        out = None
        for i in range(len(weights)):
            at = demand_position(fraction, schedules[i % len(schedules)])
            out = F.when(F.col("cycle") == i, at) if out is None else out.when(F.col("cycle") == i, at)
        return F.when(words > 0, F.round(out, 9))

    return placed.select(
        "mix_key",
        "size",
        "source_size",
        "target",
        F.floor((parts[0] + parts[1]) / F.col("copies")).cast("long").alias("taken"),
        time_of(due[0], parts[0]).alias("position"),
        time_of(due[1], parts[1]).alias("again"),
    )


def in_training_order(frame: DataFrame, key: str = "doc_id") -> DataFrame:
    """Range-sorted by training position; rows that are not taken come last."""
    return frame.orderBy(F.col("position").asc_nulls_last(), key)


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, in training order."""
    docs = table(spark, sf_dir, "documents")
    sizes = cut_lineage(docs.select(*_measured(docs, "doc_id", "text", "source")))
    out = sizes.select(F.col("id").alias("doc_id"), "mix_key").join(mix(sizes), "mix_key")
    return in_training_order(out.select("doc_id", *RESULT))


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options: object
) -> DataFrame:
    """Rows of `docs` that the mix takes, with their columns and the mix's, in training order."""
    sizes = cut_lineage(docs.select(*_measured(docs, key, text, source)))
    taken = mix(sizes, **options).where("taken > 0").withColumnRenamed("mix_key", "taken_key")
    own = without(docs, RESULT)
    mine = docs.select(*own, _measured(docs, key, text, source)[2].alias("own_key"))
    both = mine.join(taken, mine["own_key"] == taken["taken_key"])
    return in_training_order(both.select(*[mine[c] for c in own], *[taken[c] for c in RESULT]), key)


def oracle() -> str:
    """The same mix in SQL, with one window over each source."""

    def position(schedule: Schedule, x: str) -> str:
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False)]
        whole, before, cases = sum(areas), 0.0, ""
        for ((t0, w0), (t1, w1)), area in zip(zip(schedule, schedule[1:], strict=False), areas, strict=True):
            due = f"({x} * {whole}::DOUBLE - {before}::DOUBLE)"
            slope = (w1 - w0) / (t1 - t0)
            at = (
                f"{due} / {w0}::DOUBLE + {t0}::DOUBLE"
                if slope == 0
                else f"(sqrt(greatest({w0 * w0}::DOUBLE + {due} * {2 * slope}::DOUBLE, 0)) - {w0}::DOUBLE) / ({slope}::DOUBLE) + {t0}::DOUBLE"
            )
            cases += f" WHEN {due} <= {area}::DOUBLE THEN {at}"
            before += area
        return f"least(greatest(CASE{cases} ELSE {schedule[-1][0]}::DOUBLE END, 0.0), 1.0)"

    def time_of(begin: str, words: str) -> str:
        cases = " ".join(
            f"WHEN cycle = {i} THEN {position(SCHEDULES[i % len(SCHEDULES)], f'(({begin}) / target)')}"
            for i in range(len(WEIGHTS))
        )
        return f"CASE WHEN {words} > 0 THEN round(CASE {cases} END, 9) END"

    weights = " ".join(f"WHEN {i} THEN {w}::DOUBLE" for i, w in enumerate(WEIGHTS))
    first, second = ("greatest(least(goal - {}, size), 0)".format(b) for b in ("start", "(start + source_size)"))
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS cycle
  FROM sized GROUP BY source),
capped AS (SELECT *, CASE cycle {weights} END AS weight, {MOST}::DOUBLE * source_size AS cap FROM ranked),
levels AS (
  SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST) - cap))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM capped),
targets AS (
  SELECT *, coalesce(least(cap, weight * (SELECT arg_max(level, -cap / weight) FROM levels WHERE level < cap / weight)), cap) AS target
  FROM levels),
placed AS (
  SELECT s.*, source_size, target, cycle, floor(target) AS goal,
         sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST({first} + {second} AS BIGINT) AS taken,
       {time_of("start", first)} AS position, {time_of("start + source_size", second)} AS again
FROM placed"""
