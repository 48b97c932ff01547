"""Quality rules: limits on text statistics, then robust outliers within each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanweave.llm.common import SPACE, text_of, with_group, words_of
from urbanweave.session import cut_lineage

# Fixed values.
SYMBOLS = "#*$%&|<>"
SHARE = 0.75  # of a group's rows that the estimate rests on
CONSISTENCY = 1.485  # for 4 dimensions and that share: 0.75 / P(chi2 with 6 degrees < the 0.75 quantile with 4)
DIMS = ("v1", "v2", "v3", "v4")
FLOORS = (0.15, 0.25, 0.69, 0.69)  # smallest standard deviations: a repeated line or two is no fault by itself
TOGETHER = 0.7  # correlation within the floors of v3 and v4, as repeated lines repeat their words
PRIOR_ROWS = 50.0  # weight of the whole corpus in the estimate of a group
STEPS = 4
STARTS = (0, 1, 2)  # of the concentration steps: whole group, median and median deviation, values clipped around the median
BINS = 64.0  # parts of a unit in which medians are counted
CLIP = 1.5
CUTOFF = 30.0
UNIT = 1024.0  # vectors are rounded to this part, so sums of doubles do not depend on their order


def text_stats(text: Column) -> dict[str, Column]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words`` of a text column.

    The column ``words`` must hold its words. Windows of three words are compared by a 64-bit hash within the text; the
    positions of repeated ones are found by sorting, so the cost is n log n for a text of any length.
    """
    bare = F.translate(text, SPACE, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    n = F.size("words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return {
        "n_words": n.cast("long"),
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "windows": windows,
    }


def repeated_words() -> Column:
    """Words inside windows that occur twice or more, from the array ``windows``; each word counts once."""
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = lambda s: F.filter(
        s,
        lambda x, k: (x["h"] == F.get(s, k - 1)["h"]).eqNullSafe(True) | (x["h"] == F.get(s, k + 1)["h"]).eqNullSafe(True),
    )
    # nested transforms bind the sorted array once instead of sorting it again for every element
    starts = F.transform(F.array(placed), lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"])))
    spread = F.transform(
        starts,
        lambda s: F.aggregate(
            F.transform(s, lambda x, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), x - F.get(s, k - 1)))),
            F.lit(0), lambda a, b: a + b,
        ),
    )
    some = F.size("windows") > F.size(F.array_distinct("windows"))
    return F.when(some, F.get(spread, F.lit(0))).otherwise(0).cast("long")


def rule_stats(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``row`` (the whole input row) with its statistics, ``base_failed`` and the transformed vector ``v1`` to ``v4``.

    A null text has no words and fails. A null language or source counts as the empty one.
    """
    rows = docs.select(
        F.struct("*").alias("row"), text_of(text_col).alias("text"), text_of(lang_col).alias("g1"), text_of(source_col).alias("g2")
    )
    rows = rows.withColumn("words", words_of(F.col("text")))
    rows = rows.select("row", "g1", "g2", *[c.alias(name) for name, c in text_stats(F.col("text")).items()])
    rows = rows.withColumn("n_repeat_words", repeated_words()).drop("windows")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    part = lambda a, b: F.log1p(100.0 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    vector = [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        part("n_symbols", "word_chars"), part("n_dup_lines", "n_lines"), part("n_repeat_words", "n_words"),
    ]
    return rows.withColumn("base_failed", failed).withColumns(
        {name: F.round(c * UNIT) / UNIT for name, c in zip(DIMS, vector, strict=True)}
    )


KEYS = ["g1", "g2", "start"]
PAIRS = [(a, b) for i, a in enumerate(DIMS) for b in DIMS[: i + 1]]


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").cast("double").alias("n"), *[F.sum(a).alias(f"s_{a}") for a in DIMS],
        *[F.sum(F.col(a) * F.col(b)).alias(f"q_{a}{b}") for a, b in PAIRS],
    )


def _floor(a: str, b: str) -> float:
    both = FLOORS[DIMS.index(a)] * FLOORS[DIMS.index(b)]
    return both if a == b else TOGETHER * both if {a, b} == {"v3", "v4"} else 0.0


def _estimate(moments: DataFrame, scale: float) -> DataFrame:
    """Mean ``m_*`` and Cholesky factor ``l_*`` per group and start, shrunk towards the whole corpus and floored."""
    names = [c for c in moments.columns if c[:2] in ("s_", "q_")]
    whole = moments.groupBy("start").agg(F.sum("n").alias("wn"), *[F.sum(c).alias(f"w{c}") for c in names])
    both = moments.join(F.broadcast(whole), "start")  # one row per start
    w = F.lit(PRIOR_ROWS) / F.col("wn")
    total = F.col("n") + PRIOR_ROWS
    both = both.select(
        *KEYS, total.alias("t"), *[(F.col(c) + w * F.col(f"w{c}")).alias(c) for c in names]
    )
    both = both.withColumns({f"m_{a}": F.col(f"s_{a}") / F.col("t") for a in DIMS})
    cov = {
        (a, b): scale * F.greatest(F.col(f"q_{a}{b}") / F.col("t") - F.col(f"m_{a}") * F.col(f"m_{b}"), F.lit(0.0))
        + _floor(a, b)
        if a == b
        else scale * (F.col(f"q_{a}{b}") / F.col("t") - F.col(f"m_{a}") * F.col(f"m_{b}")) + _floor(a, b)
        for a, b in PAIRS
    }
    both = both.withColumns({f"c_{a}{b}": c for (a, b), c in cov.items()})
    for i, a in enumerate(DIMS):
        for j, b in enumerate(DIMS[: i + 1]):
            rest = F.col(f"c_{a}{b}")
            for c in DIMS[:j]:
                rest = rest - F.col(f"l_{a}{c}") * F.col(f"l_{b}{c}")
            both = both.withColumn(f"l_{a}{b}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if a == b else rest / F.col(f"l_{b}{b}"))
    return both.select(*KEYS, *[f"m_{a}" for a in DIMS], *[f"l_{a}{b}" for a, b in PAIRS])


def _middles(rows: DataFrame) -> DataFrame:
    """Median ``m_*`` and scaled median deviation ``d_*`` (floored) per group, from counts per bin of ``1 / BINS``."""
    long = rows.select("g1", "g2", F.explode(F.array(*[F.struct(F.lit(a).alias("dim"), F.round(F.col(a) * BINS).cast("int").alias("bin")) for a in DIMS])).alias("x"))
    bins = long.groupBy("g1", "g2", "x.dim", "x.bin").agg(F.count("*").alias("n"))
    group = W.partitionBy("g1", "g2", "dim")

    def middle(counts: DataFrame, value: str, name: str) -> DataFrame:
        upto = F.sum("n").over(group.orderBy(value).rangeBetween(W.unboundedPreceding, 0))
        reached = 2 * upto >= F.sum("n").over(group)
        counts = counts.withColumn("reached", reached)
        return counts.withColumn(name, F.min(F.when(F.col("reached"), F.col(value))).over(group)).drop("reached")

    bins = middle(bins, "bin", "m").withColumn("off", F.abs(F.col("bin") - F.col("m")))
    bins = middle(bins, "off", "d")
    pick = lambda c, a: F.max(F.when(F.col("dim") == a, F.col(c))) / BINS
    out = bins.groupBy("g1", "g2").agg(*[pick("m", a).alias(f"m_{a}") for a in DIMS], *[pick("d", a).alias(f"d_{a}") for a in DIMS])
    return out.withColumns({f"d_{a}": F.greatest(1.4826 * F.col(f"d_{a}"), F.lit(f)) for a, f in zip(DIMS, FLOORS, strict=True)})


def _starts(rows: DataFrame) -> DataFrame:
    """The estimates that the concentration steps of each group set out from, one per number of ``STARTS``."""
    middles = cut_lineage(_middles(rows))
    near = with_group(rows, middles, ["g1", "g2"])
    clipped = near.withColumns(
        {
            a: F.round(F.greatest(F.least(F.col(a), F.col(f"m_{a}") + CLIP * F.col(f"d_{a}")), F.col(f"m_{a}") - CLIP * F.col(f"d_{a}")) * UNIT) / UNIT
            for a in DIMS
        }
    ).select("g1", "g2", *DIMS)
    moments = _moments(rows.withColumn("start", F.lit(0)).unionByName(clipped.withColumn("start", F.lit(2))), KEYS)
    diagonal = {f"l_{a}{b}": F.col(f"d_{a}") if a == b else F.lit(0.0) for a, b in PAIRS}
    return _estimate(moments, 1.0).unionByName(middles.withColumn("start", F.lit(1)).select(*KEYS, *[f"m_{a}" for a in DIMS], *[c.alias(k) for k, c in diagonal.items()]))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    solved: list[Column] = []
    for i, a in enumerate(DIMS):
        rest = F.col(a) - F.col(f"m_{a}")
        for b, z in zip(DIMS[:i], solved, strict=True):
            rest = rest - F.col(f"l_{a}{b}") * z
        solved.append(rest / F.col(f"l_{a}{a}"))
    total = F.lit(0.0)
    for z in solved:
        total = total + z * z
    return total


def fit_groups(stats: DataFrame, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimate per group of a materialised table of statistics.

    Concentration steps from each of ``STARTS``: distances, the ``SHARE`` of the rows that are closest, their mean and
    covariance. Of the estimates that a group ends with, the one of least determinant stays. The share is cut at a bin
    of the logarithm of the distance, counted with map-side combining, so no group is sorted or gathered. Small groups
    lean on the whole corpus.
    """
    rows = stats.where(~F.col("base_failed")).select("g1", "g2", *DIMS)
    groups = cut_lineage(_starts(rows))
    every = rows.withColumn("start", F.explode(F.array(*map(F.lit, STARTS))))
    for _ in range(steps):
        far = with_group(every, groups, KEYS)
        far = far.withColumn("bin", F.floor(16 * F.log1p(_distance())).cast("int")).select(*KEYS, *DIMS, "bin")
        bins = far.groupBy(*KEYS, "bin").agg(F.count("*").alias("n"))
        group = W.partitionBy(*KEYS)
        below = F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        inner = bins.withColumn("below", below).withColumn("all", F.sum("n").over(group))
        inner = inner.where(F.col("below") < SHARE * F.col("all")).groupBy(*KEYS).agg(F.max("bin").alias("last"))
        inner = cut_lineage(inner)
        core = with_group(far, inner, KEYS).where(F.col("bin") <= F.col("last"))
        groups = cut_lineage(_estimate(_moments(core, KEYS), CONSISTENCY))
    spread = F.lit(1.0)
    for a in DIMS:
        spread = spread * F.col(f"l_{a}{a}")
    least = groups.groupBy("g1", "g2").agg(F.min(F.struct(spread.alias("spread"), "start")).alias("least"))
    least = least.select("g1", "g2", F.col("least.start").alias("start"))
    return cut_lineage(groups.join(least, KEYS).drop("start"))


def judge(stats: DataFrame, groups: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics with ``distance`` (null where the base rules reject) and ``kept``."""
    # a group without a row that passes the base rules has no estimate, and needs none
    judged = with_group(stats, groups, ["g1", "g2"], "left").withColumn("distance", _distance())
    judged = judged.withColumn("distance", F.when(~F.col("base_failed"), F.col("distance")))
    return judged.withColumn("kept", F.coalesce(F.col("distance") <= cutoff, F.lit(False)))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Every input row as ``row`` with its statistics, ``base_failed``, ``distance`` and ``kept``.

    Rows are judged one by one: repeated rows, null or repeated ids each get a verdict of their own, an empty table
    gives an empty one, and other columns stay inside ``row``.
    """
    stats = rule_stats(docs, text_col, lang_col, source_col)
    return judge(stats, fit_groups(cut_lineage(stats.drop("row"))))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", **cols: str) -> DataFrame:
    """As ``quality_rules``, with ``doc_id`` instead of the whole row: texts are read once."""
    stats = rule_stats(docs, **cols)
    thin = cut_lineage(stats.withColumn("doc_id", F.col(f"row.{id_col}")).drop("row"))
    return judge(thin, fit_groups(thin))
