"""Quality rules: robust multivariate outliers of text statistics, per language and source.

Native: DataFrame expressions only. One pass over the texts makes a few counts for each document.
Their transformed statistics are counted in cells of a fixed grid (`GRID` steps a unit), for each
group (language and source); the estimates need these cells only, whose number the grid bounds,
however many documents there are.

For each group a minimum-covariance-determinant estimate is sought by concentration steps, each of
which keeps the `support` share of documents that are nearest under the present estimate and takes
mean and covariance of these. They start from medians and quartile ranges, from medians and equal
variances, and from mean and covariance of all, and go on until no determinant changes by more
than `tolerance` (or `steps` times); the least determinant decides.

Statistics are rates of few or many trials, so each comes with the variance that sampling alone
gives it (about 1 / 4n for a rate of n trials after the transformation; trials are characters, lines, and disjoint
windows of words). Where most documents of a group agree exactly, as with no symbol and no repeated line, the
least covariance is singular, and that variance alone says how far from them is far: a repeated line
of five is little, one symbol in four characters is much. Concentration steps add the group's mean
of it; a document's own distance adds its own. The estimate itself is widened so that the median
distance is that of chi-square with as many degrees as statistics vary (it is never narrowed).
A document is rejected if its squared distance is beyond the chi-square quantile that clean
documents pass with probability `tail`.

Order statistics come from counts over fixed bins, which are pre-aggregated before the shuffle
and don't depend on partitioning; a group that holds most rows therefore costs one row per cell
and task. Groups below `min_group` documents use the estimate of their language, languages below
it that of the corpus.

Defined results: a null or empty text has zero words and fails the base rule; null language or
source form a group of their own; repeated rows are judged alike; an empty table gives no rows;
columns other than those named are ignored or, in `quality_filter`, returned untouched.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, broadcast_if, dropped, let, space_words, stored, value_bytes

WINDOW = 8
DIMS = ["x_word", "x_symbol", "x_lines", "x_repeat"]
#: Their sampling variances.
NOISE = ["v_word", "v_symbol", "v_lines", "v_repeat"]
#: Medians of the chi-square distribution with 1 to 4 degrees of freedom.
CHI2_MEDIAN = [0.4549, 1.3863, 2.3660, 3.3567]
#: A variance below it is the rounding error of a constant.
CONSTANT = 1e-10
BINS = 200
GRID = 100
TAIL = 1e-6


def base_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of a text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def neighbours(k: int):
        """Hashes of each value with the one k places on."""
        return lambda h: F.zip_with(F.slice(h, 1, F.size(h) - k), F.slice(h, k + 1, F.size(h) - k), lambda x, y: F.xxhash64(x, y))

    def repeated(words: Column) -> Column:
        # hashes of 1, 2, 4 and at last 8 consecutive words
        hashes, width = F.transform(words, lambda w: F.xxhash64(w)), 1
        while width < WINDOW:
            hashes = let(hashes, neighbours(width))
            width *= 2

        def covered(h: Column) -> Column:
            ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
            starts = let(
                ordered,
                lambda s: F.filter(
                    F.transform(
                        s,
                        lambda e, j: F.when(
                            F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)),
                            e["i"],
                        ),
                    ),
                    lambda p: p.isNotNull(),
                ),
            )
            return let(
                F.sort_array(starts),
                lambda p: F.aggregate(
                    F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
                    F.lit(0),
                    lambda a, x: a + x,
                ),
            )

        return F.when(F.size(words) > WINDOW, let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))).otherwise(0)

    return let(
        space_words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            repeated(w).cast("long").alias("n_repeat_words"),
        ),
    )


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the struct column _q of base counts."""
    return docs.withColumn("_q", base_counts(F.col(text_col)))


def _vector(q: str = "") -> dict[str, Column]:
    """Transformed statistics: logarithm of the mean word length, variance-stabilised rates of the rest. And their sampling variances."""
    n, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    share = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), a / b)))
    return {
        "x_word": F.log(chars / n),
        "x_symbol": share(F.col("n_symbols").cast("double"), chars),
        "x_lines": share(F.col("n_dup_lines").cast("double"), lines),
        "x_repeat": share(F.col("n_repeat_words").cast("double"), n),
        "v_word": F.lit(1.0) / chars,  # lengths that vary as counts do
        "v_symbol": F.lit(0.25) / chars,
        "v_lines": F.lit(0.25) / lines,
        "v_repeat": F.lit(0.25 * WINDOW) / n,
    }


def cutoff(tail: float) -> float:
    """The value that a chi-square variable with as many degrees of freedom as there are statistics (four) exceeds with probability `tail`."""
    low, high = 0.0, 1e4
    while high - low > 1e-9:
        mid = (low + high) / 2
        low, high = (mid, high) if math.exp(-mid / 2) * (1 + mid / 2) > tail else (low, mid)
    return low


def _at_shares(bins: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """For each key the first bin at which the running count reaches a share of all."""
    w = Window.partitionBy(*keys)
    run = bins.withColumns({"_run": F.sum("_n").over(w.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)), "_all": F.sum("_n").over(w)})
    return run.groupBy(*keys).agg(*[F.min(F.when(F.col("_run") >= F.ceil(F.col("_all") * s), F.col("_bin"))).alias(k) for k, s in shares.items()])


def _distance(df: DataFrame) -> DataFrame:
    """Adds _d2 from mean columns m_* and lower Cholesky columns l_*."""
    z: list[Column] = []
    for i, d in enumerate(DIMS):
        v = F.col(d) - F.col(f"m_{d}")
        for j in range(i):
            v = v - F.col(f"l_{i}{j}") * F.col(f"_z{j}")
        z.append((v / F.col(f"l_{i}{i}")).alias(f"_z{i}"))
    total = reduce(Column.__add__, [F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(len(DIMS))])
    # each column may name those before it; one select is analysed once
    return df.select("*", *z, total.alias("_d2")).drop(*[f"_z{i}" for i in range(len(DIMS))])


def _cholesky(params: DataFrame) -> DataFrame:
    """Adds l_ij of the covariance columns c_ij with the sampling variances v_* added."""
    lower: list[Column] = []
    for i, d in enumerate(NOISE):
        for j in range(i + 1):
            v = F.col(f"c_{i}{j}")
            if i == j:
                v = F.greatest(v, F.lit(0.0)) + F.col(d)
            for k in range(j):
                v = v - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
            lower.append((F.sqrt(F.greatest(v, F.lit(1e-12))) if i == j else v / F.col(f"l_{j}{j}")).alias(f"l_{i}{j}"))
    return params.select("*", *lower)


def _own_distance(scale: Column) -> Column:
    """Squared distance from mean columns m_* under the covariance columns c_* times scale with the row's own sampling variances v_* added.

    As above, but one expression: a filter on the result is pushed below projections, which would write out each column of a chain wherever it is named.
    """
    dims = range(len(DIMS))

    def column(j: int, found: list[Column]) -> Column:
        """The distance, given columns 0 to j - 1 of the Cholesky factor (from their diagonal down) with the z of each."""
        if j == len(DIMS):
            return reduce(Column.__add__, [f["z"] * f["z"] for f in found])

        def rest(i: int) -> Column:
            v = F.col(f"c_{i}{j}") * scale
            if i == j:
                v = F.greatest(v, F.lit(0.0)) + F.col(NOISE[i])
            return reduce(lambda v, f: v - f[f"l_{i}"] * f[f"l_{j}"], found, v)

        def below(root: Column) -> Column:
            z = reduce(lambda v, f: v - f[f"l_{j}"] * f["z"], found, F.col(DIMS[j]) - F.col(f"m_{DIMS[j]}")) / root
            return let(F.struct(*[(rest(i) / root).alias(f"l_{i}") for i in dims[j + 1 :]], z.alias("z")), lambda f: column(j + 1, [*found, f]))

        return let(F.sqrt(F.greatest(rest(j), F.lit(1e-12))), below)

    return column(0, [])


def _sums() -> list[Column]:
    """Weighted sums of cells' statistics and of their products."""
    n = F.col("_n")
    out = [F.sum(n).alias("_n"), *[F.sum(n * F.col(d)).alias(f"s_{i}") for i, d in enumerate(DIMS)]]
    return out + [F.sum(n * F.col(a) * F.col(b)).alias(f"p_{i}{j}") for i, a in enumerate(DIMS) for j, b in enumerate(DIMS[: i + 1])]


def _moments() -> list[Column]:
    """Mean and covariance from such sums."""
    total = lambda c: F.sum(c) / F.sum("_n")
    out = [total(f"s_{i}").alias(f"m_{d}") for i, d in enumerate(DIMS)]
    return out + [(total(f"p_{i}{j}") - total(f"s_{i}") * total(f"s_{j}")).alias(f"c_{i}{j}") for i in range(len(DIMS)) for j in range(i + 1)]


def _bin(d2: Column) -> Column:
    return F.floor(F.log1p(F.least(d2, F.lit(1e12))) * BINS).cast("long")


def _starts(cells: DataFrame) -> DataFrame:
    """Columns _g, _s (which start), means m_* and covariances c_*."""
    long = cells.select("_g", "_n", F.explode(F.array(*[F.struct(F.lit(i).alias("_dim"), F.col(d).alias("_bin")) for i, d in enumerate(DIMS)])).alias("_e")).groupBy("_g", "_e._dim", "_e._bin").agg(F.sum("_n").alias("_n"))
    quart = _at_shares(long, ["_g", "_dim"], {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    median = [F.max(F.when(F.col("_dim") == i, F.col("q2"))).alias(f"m_{d}") for i, d in enumerate(DIMS)]
    spread = [F.max(F.when(F.col("_dim") == i, F.pow((F.col("q3") - F.col("q1")) / 1.349, 2))).alias(f"c_{i}{i}") for i in range(len(DIMS))]
    robust = quart.groupBy("_g").agg(*median, *spread).withColumns({f"c_{i}{j}": F.lit(0.0) for i in range(len(DIMS)) for j in range(i)})
    # the second start has equal variances instead
    robust = robust.withColumn("_s", F.explode(F.array(F.lit(0), F.lit(1))))
    robust = robust.withColumns({f"c_{i}{i}": F.when(F.col("_s") == 0, F.col(f"c_{i}{i}")).otherwise(1.0) for i in range(len(DIMS))})
    return robust.unionByName(cells.groupBy("_g").agg(*_sums()).groupBy("_g").agg(*_moments()).withColumn("_s", F.lit(2)))


def estimates(stats: DataFrame, *, support: float = 0.75, steps: int = 12, tolerance: float = 0.01) -> DataFrame:
    """One row for each _g of stats (_g, x_*, v_*): mean m_*, covariance c_* and its Cholesky factor with mean
    sampling variances v_*, logarithm of the determinant and scale `c` of the robust estimate.

    The result is a stored table.
    """
    grid = {d: F.round(F.col(d) * GRID) / GRID for d in DIMS}
    cells = stored(stats.groupBy("_g", *[v.alias(d) for d, v in grid.items()]).agg(F.count("*").alias("_n"), *[F.sum(v).alias(v) for v in NOISE]), "mcd-cells")
    noise = stored(cells.groupBy("_g").agg(*[(F.sum(v) / F.sum("_n")).alias(v) for v in NOISE]), "mcd-noise")
    cells = cells.drop(*NOISE)
    few = value_bytes(noise) * 10 * len(DIMS) <= BROADCAST_BYTES  # so are the tables of all steps, with a row for each group and start
    log_det = sum((2 * F.log(F.col(f"l_{i}{i}")) for i in range(len(DIMS))), F.lit(0.0))
    with_det = lambda p: stored(_cholesky(p).withColumn("log_det", log_det), "mcd-params")
    key = ["_g", "_s"]

    def placed(params: DataFrame) -> DataFrame:
        """Cells with their distance bins, and the parameters that the next step hands on."""
        joined = _distance(cells.join(F.broadcast(params) if few else params, "_g"))
        return joined.select(*key, *DIMS, *NOISE, "log_det", "_n", _bin(F.col("_d2")).alias("_bin"))

    params = with_det(_starts(cells).join(F.broadcast(noise) if few else noise, "_g"))
    w = Window.partitionBy(*key)
    same = [F.first(c).alias(c) for c in [*NOISE, "log_det"]]  # alike in all rows of a group and start
    for _ in range(steps):
        # sums of each bin, so that cells are placed once a step; then of the bins up to the support share
        bins = placed(params).groupBy(*key, "_bin").agg(*_sums(), *same)
        before = F.sum("_n").over(w.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
        bins = bins.withColumn("_near", before < F.ceil(F.sum("_n").over(w) * support)).where("_near")
        following = bins.groupBy(*key).agg(*_moments(), *same).withColumnRenamed("log_det", "_was")
        following = with_det(following)
        moved = following.agg(F.max(F.abs(F.col("log_det") - F.col("_was")))).first()[0]
        dropped(params)
        params = following.drop("_was")
        params._stored_at = following._stored_at
        if moved is None or moved <= tolerance:
            break
    # of starts that end alike the first
    best = params.groupBy("_g").agg(F.min_by(F.struct(*params.columns), F.struct(F.round("log_det", 6), "_s")).alias("p")).select("p.*")
    best = stored(best, "mcd-best")
    vary = sum((F.when(F.col(f"c_{i}{i}") > CONSTANT, 1).otherwise(0) for i in range(len(DIMS))), F.lit(0))
    median = F.element_at(F.array(*map(F.lit, CHI2_MEDIAN)), F.greatest(vary, F.lit(1)))
    scale = F.greatest((F.exp((F.col("_half") + 0.5) / BINS) - 1) / median, F.lit(1.0))
    half = _at_shares(placed(best).groupBy(*key, "_bin").agg(F.sum("_n").alias("_n")), key, {"_half": 0.5})
    return stored(best.join(half, key).withColumn("c", scale), "mcd-estimates")


def judge(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    carry: tuple[str, ...] = ("doc_id",),
    support: float = 0.75,
    tail: float = TAIL,
    min_group: int = 100,
) -> DataFrame:
    """Counts, robust distance and verdict for each row of docs.

    Returns the `carry` columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance, kept.
    """
    name = lambda c: F.concat(F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(F.col(c).cast("string"), F.lit("")))
    facts = stored(
        with_counts(docs, text_col).select(*carry, "_q.*", F.concat(F.lit("l"), name(lang_col)).alias("_lang"), F.concat(F.lit("s"), name(lang_col), F.lit("\x1f"), name(source_col)).alias("_src")),
        "quality-counts",
    )
    facts = facts.withColumns(_vector()).withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    # estimates come from documents that the base rules pass
    passing = facts.where(~F.col("base_failed"))
    sizes = stored(passing.groupBy("_lang", "_src").agg(F.count("*").alias("_ns")).withColumn("_nl", F.sum("_ns").over(Window.partitionBy("_lang"))), "quality-groups")
    level = sizes.select("_src", F.when(F.col("_ns") >= min_group, F.col("_src")).when(F.col("_nl") >= min_group, F.col("_lang")).otherwise(F.lit("all")).alias("_g"), "_lang")
    by_lang = level.groupBy("_lang").agg(F.max(F.col("_g") == F.col("_lang")).alias("_need_l"))
    any_all = bool(level.where("_g = 'all'").limit(1).count())
    need = broadcast_if(stored(level.join(by_lang, "_lang").select("_src", "_g", "_need_l"), "quality-levels"))
    spread = passing.join(need, "_src").select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("_g") == F.col("_src"), F.col("_src")),
                    F.when(F.col("_need_l"), F.col("_lang")),
                    F.lit("all") if any_all else F.lit(None).cast("string"),
                )
            )
        ).alias("_g"),
        *DIMS,
        *NOISE,
    )
    found = estimates(spread, support=support)
    params = broadcast_if(found.drop("log_det", *NOISE, *[c for c in found.columns if c.startswith("l_")]))
    mine = facts.join(need.select("_src", "_g"), "_src", "left")
    out = mine.join(params, "_g", "left").withColumn("distance", _own_distance(F.col("c")))
    return out.select(*carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff(tail))).alias("kept"))


def quality_filter(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    names = docs.columns
    out = judge(docs.withColumn("_row", F.struct(*names)), carry=("_row",), **options)
    return out.where("kept").select("_row.*")
