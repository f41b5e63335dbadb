"""Quality rules whose cutoffs are chosen under a guaranteed rate of false rejections.

Every rule compares one number of a text with a cutoff.  ``LADDER`` lists cutoffs from lenient to
strict; a level uses one of each rule, and a text is rejected if it passes any.  For each stratum
(by language) the labelled good texts of the holdout say how many a level would reject.  A level
may be used if that many or fewer would be seen with a chance of at most ``delta`` (divided by the
number of strata: Bonferroni) were the true rate of false rejections ``alpha``: the exact binomial
bound.  Levels are tested from the lenient side and the last to pass is taken; in such a fixed
sequence no further correction is due.  With probability 1 - delta no stratum rejects more than
``alpha`` of its good texts; a stratum with too few labels rejects nothing by these rules.

All of it is SQL expressions; texts never meet Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import written

_SPACE = r"\\x20\\x09-\\x0D"
ALPHA = 0.01
DELTA = 0.05
WINDOW = 8

#: value, and the cutoff above which each level rejects, lenient to strict.
LADDER: dict[str, tuple[float, ...]] = {
    "symbols": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1),
    "bangs": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1),
    "doubled": (0.5, 0.3, 0.2, 0.15, 0.1, 0.08),
    "lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4),
    "repeats": (0.3, 0.28, 0.26, 0.24, 0.22, 0.2),
    "long_words": (20.0, 17.0, 15.0, 14.0, 13.0, 12.0),
    "short_words": (-1.5, -1.7, -1.9, -2.1, -2.3, -2.5),
}
LEVELS = 6


def _repeat_words(words: str, window: int) -> str:
    """Words that lie in windows of ``window`` words found twice or more in the text.

    Windows are hashed; only if two agree are they sorted by hash to find which, and their
    positions summed up so that a word in several windows counts once.
    """
    parts = ", ".join(f"h[i + {k}]" for k in range(window))
    return f"""
    transform(array(transform({words}, w -> xxhash64(w))), h ->
      IF(size(h) < {window}, 0, transform(array(transform(sequence(0, size(h) - {window}), i -> xxhash64({parts}))), g ->
        IF(size(array_distinct(g)) = size(g), 0, transform(array(sort_array(transform(g, (x, i) -> struct(x AS x, i AS i)))), s ->
          aggregate(
            sort_array(transform(
              filter(s, (e, k) -> coalesce(get(s, k - 1).x = e.x, false) OR coalesce(get(s, k + 1).x = e.x, false)),
              e -> e.i)),
            struct(0 AS n, -{window} AS last),
            (a, p) -> struct(a.n + least({window}, p - a.last) AS n, p AS last),
            a -> a.n))[0]))[0]))[0]
    """


def features(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without its text, with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``

    and ``n_bangs, n_lines, n_doubled``: exclamation marks, lines with a word, and words equal to
    the one before.  A null text counts as empty.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    body = docs.select(*kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    words = body.withColumn("_words", F.expr(f"regexp_extract_all(_text, '[^{_SPACE}]+', 0)")).withColumn(
        "_lines", F.expr(f"filter(split(_text, '\\n', -1), l -> l RLIKE '[^{_SPACE}]')")
    )
    return words.select(
        *kept,
        F.expr("CAST(size(_words) AS BIGINT)").alias("n_words"),
        F.expr("CAST(char_length(array_join(_words, '')) AS BIGINT)").alias("word_chars"),
        F.expr("CAST(regexp_count(_text, '[#*$%&|<>]') AS BIGINT)").alias("n_symbols"),
        F.expr("CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)").alias("n_dup_lines"),
        F.expr(f"CAST({_repeat_words('_words', window)} AS BIGINT)").alias("n_repeat_words"),
        F.expr("CAST(regexp_count(_text, '!') AS BIGINT)").alias("n_bangs"),
        F.expr("CAST(size(_lines) AS BIGINT)").alias("n_lines"),
        F.expr(
            "CAST(aggregate(_words, struct(0 AS n, '' AS last), (a, w) -> struct(a.n + IF(w = a.last, 1, 0) AS n, w AS last), a -> a.n) AS BIGINT)"
        ).alias("n_doubled"),
    )


def _values() -> dict[str, str]:
    """The number each rule looks at; higher is worse."""
    return {
        "symbols": "n_symbols / greatest(n_words, 1)",
        "bangs": "n_bangs / greatest(n_words, 1)",
        "doubled": "n_doubled / greatest(n_words, 1)",
        "lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeats": "n_repeat_words / greatest(n_words, 1)",
        "long_words": "word_chars / greatest(n_words, 1)",
        "short_words": "-(word_chars / greatest(n_words, 1))",
    }


def strictest(level_of: str = "level") -> str:
    """The first level (1 to ``LEVELS``) that rejects a text; one more if none does."""
    cases = []
    for level in range(1, LEVELS + 1):
        tests = " OR ".join(f"{v} > {LADDER[name][level - 1]}D" for name, v in _values().items())
        cases.append(f"WHEN {tests} THEN {level}")
    return f"CASE {' '.join(cases)} ELSE {LEVELS + 1} END"


def _log_binomial_cdf(k: str, n: str, p: float) -> str:
    """ln P(X <= k) for X binomial (n, p), summed term by term in logarithms."""
    step = f"a.t + ln(({n} - j + 1) / j * {p!r}D / (1 - {p!r}D))"
    return f"""
    aggregate(
      IF({k} < 1, array(), sequence(1L, {k})),
      named_struct('t', {n} * ln(1 - {p!r}D), 's', {n} * ln(1 - {p!r}D)),
      (a, j) -> named_struct('t', {step},
        's', greatest(a.s, {step}) + ln(1 + exp(least(a.s, {step}) - greatest(a.s, {step})))),
      a -> a.s)
    """


def chosen_levels(counted: DataFrame, labels: DataFrame, stratum: str, alpha: float, delta: float) -> DataFrame:
    """``stratum, n_good, level``: the level each stratum may use, 0 if none.

    ``counted`` has ``doc_id, _stratum, _first`` (the first level that rejects the text) and
    whether the base failed; texts that the base rejects are no part of the holdout.  An id
    labelled twice is good only if both labels say so.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = counted.where("NOT base_failed").join(good.where("quality = 1").select("doc_id"), "doc_id")
    firsts = held.groupBy("_stratum", "_first").agg(F.count(F.lit(1)).alias("n"))
    strata = firsts.groupBy("_stratum").agg(
        F.sum("n").alias("n_good"),
        *[F.sum(F.when(F.col("_first") <= level, F.col("n")).otherwise(0)).alias(f"k{level}") for level in range(1, LEVELS + 1)],
    )
    strata = strata.withColumn("_bar", F.log(F.lit(float(delta)) / F.count(F.lit(1)).over(Window.partitionBy())))
    level = F.lit(0)
    for k in range(1, LEVELS + 1):
        # Beyond the expected number the chance is about a half or more: never enough.
        enough = F.expr(f"k{k} <= {alpha!r}D * n_good AND IF(k{k} <= {alpha!r}D * n_good, {_log_binomial_cdf(f'k{k}', 'n_good', alpha)}, 0D) <= _bar")
        level = F.when((level == k - 1) & enough, k).otherwise(level)
    return strata.select("_stratum", "n_good", level.alias("level"))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """``doc_id``, the numbers of ``features``, ``base_failed``, ``level`` (the level the document's

    stratum uses) and ``kept``; other columns are left out.  ``docs`` needs ``doc_id, text`` and the stratum column
    (null is a stratum of its own); ``labels`` needs ``doc_id, quality`` (1: good).
    """
    slim = docs.select("doc_id", "text", F.col(f"`{stratum}`").alias("_given"))
    counted = (
        features(slim)
        .withColumn("_stratum", F.coalesce(F.concat(F.lit("="), F.col("_given").cast("string")), F.lit("none")))
        .withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
        .withColumn("_first", F.expr(strictest()))
        .drop("_given")
    )
    counted = written(counted, "quality-features")
    levels = written(chosen_levels(counted, labels, stratum, alpha, delta), "quality-levels")
    level = F.coalesce("level", F.lit(0))
    joined = counted.join(levels.select("_stratum", "level"), "_stratum", "left")
    return joined.select(
        *[c for c in counted.columns if not c.startswith("_")],
        level.alias("level"),
        (~F.col("base_failed") & (F.col("_first") > level)).alias("kept"),
    )
