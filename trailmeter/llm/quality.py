"""Quality rules: base counts of a text and robust multivariate outliers.

Statistics of each text become a vector of transformed values. For each language and source the minimum
covariance determinant method looks for the half or more of the vectors that lie closest together: it
starts from medians and spreads, and each concentration step keeps the vectors of smallest Mahalanobis
distance and takes their mean and covariance anew. A text is rejected if its distance to the result is
beyond a cut-off. Only DataFrame functions are used, and a group's rows never meet: means, covariances and
quantiles are sums over integers and counts over bins, so results don't depend on the order of rows.

Nulls, ties and odd rows: a null or empty text has no words and fails the base rule; null languages and
sources form groups of their own; groups too small for an estimate use that of their language, then that
of all rows; repeated rows count once each; columns other than the five of documents may be present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmeter.llm.common import stored

SPACES = "[\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
STATISTICS = ["length", "word_size", "symbols", "repeats", "lines"]
#: Statistics are kept as integers of this many steps a unit, so that sums are exact.
STEPS = 1000
#: Share of a group's rows in the concentrated part, steps, and rows that an estimate needs.
SHARE, ROUNDS, LEAST_ROWS = 0.75, 4, 50
#: Bins a unit of the logarithm of a squared distance.
BINS = 64


def counted(docs: DataFrame, whole: bool = False) -> DataFrame:
    """docs (doc_id, text, lang, source) with the base counts, without the text; whole: with the row as it
    was in __llm_row."""
    row = ["__llm_row"] if whole else []
    docs = docs.withColumn("__llm_row", F.struct("*")) if whole else docs
    text = docs.select(
        "doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("t"), *row
    ).select(
        "doc_id",
        "lang",
        "source",
        *row,
        F.filter(F.split("t", f"{SPACES}+"), lambda w: w != "").alias("w"),
        (F.size(F.split("t", SYMBOLS)) - 1).alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("l"),
    )
    hashed = text.select(
        "doc_id",
        "lang",
        "source",
        *row,
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("h"),
    )
    # A window's hash is made of its words' hashes; 2 + 2 + 4 words by shifted copies of one array.
    doubled = hashed.withColumn("h2", _pairs("h", 1)).withColumn("h4", _pairs("h2", 2))
    wide = doubled.withColumn("h8", _pairs("h4", 4)).drop("h", "h2", "h4")
    twice = F.size(F.array_distinct("h8")) < F.size("h8")
    return wide.withColumn(
        "n_repeat_words", F.when(twice, _covered("h8", 8)).otherwise(F.lit(0)).cast("long")
    ).drop("h8")


def _pairs(name: str, step: int) -> Column:
    """The hash of each element with the one step places on; as many fewer elements."""
    size = F.size(name)
    ahead = F.slice(name, F.lit(step + 1), F.greatest(size - step, F.lit(0)))
    here = F.slice(name, F.lit(1), F.greatest(size - step, F.lit(0)))
    return F.zip_with(here, ahead, lambda x, y: F.xxhash64(x, y))


def _covered(name: str, window: int) -> Column:
    """How many words lie in windows whose hash is there twice or more."""
    placed = F.array_sort(F.transform(name, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        # In order of hash and place: a window is repeated if a neighbour has its hash.
        last = F.size(s) - 1
        same = F.zip_with(F.slice(s, F.lit(1), last), F.slice(s, F.lit(2), last), lambda x, y: x["h"] == y["h"])
        no = F.array(F.lit(False))
        before = F.zip_with(s, F.concat(no, same), lambda x, y: F.struct(x["i"].alias("i"), y.alias("y")))
        return F.zip_with(before, F.concat(same, no), lambda x, y: F.when(x["y"] | y, x["i"]))

    marked = F.transform(F.array(placed), places)[0]
    return F.aggregate(
        F.sort_array(F.array_compact(marked)),
        F.expr("named_struct('end', 0, 'n', 0)"),
        lambda a, i: F.struct(
            (i + window).alias("end"),
            (a["n"] + F.least(F.lit(window), i + window - a["end"])).alias("n"),
        ),
        lambda a: a["n"],
    )


#: Least standard deviation of each statistic: many texts have no symbol, repeat or double line at all.
FLOORS = {"length": 0.3, "word_size": 0.08, "symbols": 0.35, "repeats": 0.08, "lines": 0.45}
#: Squared distances beyond this are outliers; for five normal values it is passed once in a million.
CUT = 36.0
#: For five normal values: share / P(chi-squared of 7 degrees < its quantile of share at 5 degrees).
CONSISTENCY = 1.41


def vectors(counts: DataFrame) -> DataFrame:
    """Statistics in STEPS of a unit, each about normal for ordinary prose."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = {
        "length": F.log1p("n_words"),
        "word_size": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "symbols": F.log1p(F.lit(20) * F.col("n_symbols") / words),
        "repeats": F.col("n_repeat_words") / words,
        "lines": F.log1p("n_dup_lines"),
    }
    return counts.withColumns({k: F.round(v * STEPS).cast("long") for k, v in values.items()})


def _levels(rows: DataFrame) -> DataFrame:
    """Each row once for its language and source, once for its language, once for all."""
    level = F.explode(F.array(F.lit(2), F.lit(1), F.lit(0))).alias("level")
    return rows.select("*", level).withColumns(
        {
            "g_lang": F.when(F.col("level") >= 1, F.col("lang")),
            "g_source": F.when(F.col("level") == 2, F.col("source")),
        }
    )


GROUP = ["level", "g_lang", "g_source"]


def _on_group(rows: DataFrame, params: DataFrame) -> DataFrame:
    named = params.withColumnsRenamed({k: f"p_{k}" for k in GROUP})
    same = [F.col(k).eqNullSafe(F.col(f"p_{k}")) for k in GROUP]
    return rows.join(named, same).drop(*[f"p_{k}" for k in GROUP])


def _started(rows: DataFrame) -> DataFrame:
    """Medians and quartile spreads of each group, from counts of the values."""
    long = rows.select(*GROUP, F.posexplode(F.array(*STATISTICS)).alias("k", "v"))
    cells = long.groupBy(*GROUP, "k", "v").agg(F.count(F.lit(1)).alias("n"))
    key = Window.partitionBy(*GROUP, "k")
    cells = cells.withColumn("before", F.sum("n").over(key.orderBy("v")))
    cells = cells.withColumn("all", F.sum("n").over(key))
    at = {
        q: F.min(F.when(F.col("before") >= F.col("all") * share, F.col("v"))).alias(q)
        for q, share in (("q1", 0.25), ("mid", 0.5), ("q3", 0.75))
    }
    found = cells.groupBy(*GROUP, "k").agg(*at.values(), F.first("all").alias("n"))
    wide = []
    for i, name in enumerate(STATISTICS):
        own = F.when(F.col("k") == i, F.col("mid"))
        spread = F.when(F.col("k") == i, F.pow((F.col("q3") - F.col("q1")) / 1.349, F.lit(2)))
        wide += [F.max(own).cast("double").alias(f"m{i}"), F.max(spread).alias(f"c{i}{i}")]
    out = found.groupBy(*GROUP).agg(F.max("n").alias("n"), *wide)
    zero = {f"c{i}{j}": F.lit(0.0) for i in range(5) for j in range(i)}
    return out.withColumns(zero)


def _factored(params: DataFrame, scale: float) -> DataFrame:
    """Cholesky factor l of the covariance c, scaled, with the floors added."""
    out = params
    for j, name in enumerate(STATISTICS):
        floor = (FLOORS[name] * STEPS) ** 2
        square = F.col(f"c{j}{j}") * scale + floor
        for k in range(j):
            square = square - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(square, F.lit(floor / 4))))
        for i in range(j + 1, len(STATISTICS)):
            value = F.col(f"c{i}{j}") * scale
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", value / F.col(f"l{j}{j}"))
    names = [f"l{i}{j}" for i in range(5) for j in range(i + 1)]
    return out.select(*GROUP, "n", *[f"m{i}" for i in range(5)], *names)


def _distanced(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows with d2, the squared Mahalanobis distance to their group's estimate."""
    out = _on_group(rows, params)
    total = F.lit(0.0)
    for i, name in enumerate(STATISTICS):
        value = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    out = out.withColumn("d2", total)
    extra = [f"m{i}" for i in range(5)] + [f"l{i}{j}" for i in range(5) for j in range(i + 1)]
    return out.drop(*extra, *[f"z{i}" for i in range(5)])


def _concentrated(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Mean and covariance of the SHARE of each group's rows that are nearest to the estimate so far.

    Rows of the last bin all count, so ties can't make a difference.
    """
    near = _distanced(rows, params).withColumn(
        "bin", F.floor(F.log(F.col("d2") + 1e-3) * BINS).cast("long")
    )
    cells = near.groupBy(*GROUP, "bin").agg(F.count(F.lit(1)).alias("k"))
    key = Window.partitionBy(*GROUP)
    cells = cells.withColumn("before", F.sum("k").over(key.orderBy("bin")))
    cells = cells.withColumn("all", F.sum("k").over(key))
    enough = F.when(F.col("before") >= F.col("all") * SHARE, F.col("bin"))
    edge = cells.groupBy(*GROUP).agg(F.min(enough).alias("edge"))
    chosen = _on_group(near, edge).where("bin <= edge")
    sums = [F.count(F.lit(1)).alias("h"), F.max("n").alias("n")]
    for i, x in enumerate(STATISTICS):
        sums.append(F.sum(x).alias(f"s{i}"))
        sums += [
            F.sum((F.col(x) * F.col(y)).cast("decimal(38,0)")).cast("double").alias(f"s{i}{j}")
            for j, y in enumerate(STATISTICS[: i + 1])
        ]
    got = chosen.groupBy(*GROUP).agg(*sums)
    means = {f"m{i}": F.col(f"s{i}") / F.col("h") for i in range(5)}
    parts = {
        f"c{i}{j}": F.col(f"s{i}{j}") / F.col("h") - F.col(f"m{i}") * F.col(f"m{j}")
        for i in range(5)
        for j in range(i + 1)
    }
    return got.withColumns(means).withColumns(parts).select(*GROUP, "n", *means, *parts)


def _judged(docs: DataFrame, whole: bool = False) -> DataFrame:
    """The base counts with base_failed, kept and d2 for each row of docs, and the row if whole."""
    counts = stored(vectors(counted(docs, whole)))
    # The estimates are of texts with words enough; the base rule has rejected the others.
    words = F.col("n_words")
    base_failed = (words < 20) | (100 * F.col("n_repeat_words") > 30 * words)
    rows = _levels(counts.where(words >= 20))
    params = stored(_factored(_started(rows), 1.0))
    for _ in range(ROUNDS):
        params = stored(_factored(_concentrated(rows, params), CONSISTENCY))
    # The narrowest group that has rows enough judges.
    narrow = counts.select("lang", "source").distinct()
    fits = params.where((F.col("n") >= LEAST_ROWS) | (F.col("level") == 0))
    options = narrow.withColumns({"own_lang": F.col("lang"), "own_source": F.col("source")})
    options = _on_group(_levels(options).select("own_lang", "own_source", *GROUP), fits)
    columns = [c for c in params.columns if c not in GROUP]
    best = options.groupBy("own_lang", "own_source").agg(
        F.max(F.struct("level", *columns)).alias("best")
    )
    best = best.select("own_lang", "own_source", *[F.col(f"best.{c}").alias(c) for c in columns])
    judged = counts.join(
        best,
        F.col("lang").eqNullSafe(F.col("own_lang")) & F.col("source").eqNullSafe(F.col("own_source")),
        "left",
    )
    total, z = F.lit(0.0), {}
    for i, name in enumerate(STATISTICS):
        value = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        z = {f"z{i}": value / F.col(f"l{i}{i}")}
        judged = judged.withColumns(z)
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    # Without any estimate, the base rule alone decides.
    inside = F.coalesce(total <= CUT, F.lit(True))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & inside).alias("kept"),
        total.alias("d2"),
        *(["__llm_row"] if whole else []),
    )


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, the base counts, base_failed, kept, d2) for each row of docs."""
    return _judged(docs)


def passed(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept. Each row carries its own verdict, so nothing is joined by id."""
    return _judged(docs, whole=True).where("kept").select("__llm_row.*")
