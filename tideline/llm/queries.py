"""The registered queries of this subpackage, with the SQL that defines the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bpe, chat, leaks, licenses, mixing, near, quality, ranked, resample, secrets, shards, tokens, toxicity
from tideline.llm.common import WORD, written
from tideline.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under piece_bpe_32k.model."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = tokens.with_token_counts(docs, "piece_bpe_32k.model")
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 4096).alias("over_limit"),
    )


_NEAR_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), g AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d
), u AS (
  SELECT DISTINCT doc_id, s FROM g
), n AS (
  SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id
), o AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM u x JOIN u y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE shared >= 0.8 * (p.n + q.n - shared) - 1e-9
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM d
  UNION
  SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b
), c AS (
  SELECT node, min(root) AS class_id FROM r GROUP BY node
), k AS (
  SELECT a, count(*) AS links FROM e GROUP BY a
)
SELECT doc_id, class_id, coalesce(links, 0) AS links
FROM d JOIN c ON c.node = d.doc_id LEFT JOIN k ON k.a = d.doc_id
"""


@query("op3_jaccard_join", _NEAR_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near copies of every document and its number of links."""
    return near.near_copies(table(spark, folder, "documents")).select("doc_id", "class_id", "links")


# The cutoffs, stated apart from the operator's own.
_CUTOFFS = {
    "symbols": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1),
    "bangs": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1),
    "doubled": (0.5, 0.3, 0.2, 0.15, 0.1, 0.08),
    "lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4),
    "repeats": (0.3, 0.28, 0.26, 0.24, 0.22, 0.2),
    "long_words": (20.0, 17.0, 15.0, 14.0, 13.0, 12.0),
    "short_words": (-1.5, -1.7, -1.9, -2.1, -2.3, -2.5),
}


def _quality_sql(alpha: float = 0.01, delta: float = 0.05, level: str = "") -> str:
    value = {
        "symbols": "n_symbols / greatest(n_words, 1)",
        "bangs": "n_bangs / greatest(n_words, 1)",
        "doubled": "n_doubled / greatest(n_words, 1)",
        "lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeats": "n_repeat_words / greatest(n_words, 1)",
        "long_words": "word_chars / greatest(n_words, 1)",
        "short_words": "-(word_chars / greatest(n_words, 1))",
    }
    levels = " ".join(
        f"WHEN {' OR '.join(f'{value[n]} > CAST({cuts[k]} AS DOUBLE)' for n, cuts in _CUTOFFS.items())} THEN {k + 1}"
        for k in range(6)
    )
    last = 7
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '{WORD}') AS w,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS l FROM d
), p AS (
  SELECT r, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8
), g AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM p
), x AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1
), y AS (
  SELECT r, sum(least(8, i - coalesce(b, i - 8))) AS n FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS b FROM x) GROUP BY r
), f AS (
  SELECT doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(y.n, 0) AS n_repeat_words, len(regexp_extract_all(t, '!')) AS n_bangs, len(l) AS n_lines,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_doubled
  FROM w LEFT JOIN y USING (r)
), v AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, CASE {levels} ELSE {last} END AS first FROM f
), q AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), h AS (
  SELECT lang, first FROM v JOIN q USING (doc_id) WHERE NOT base_failed
), s AS (
  SELECT lang, count(*) AS n FROM h GROUP BY lang
), k AS (
  SELECT s.lang, s.n, z.level, (SELECT count(*) FROM h WHERE h.lang IS NOT DISTINCT FROM s.lang AND h.first <= z.level) AS k
  FROM s, (SELECT unnest(range(1, {last})) AS level) z
), b AS (
  SELECT lang, level, coalesce((SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({alpha}::DOUBLE) + (n - j) * ln(1 - {alpha}::DOUBLE)))
         FROM (SELECT unnest(range(0, k + 1)) AS j)), 1) <= {delta}::DOUBLE / (SELECT count(*) FROM s) AS fine
  FROM k
), c AS (
  SELECT lang, coalesce(min(level) FILTER (WHERE NOT fine), {last}) - 1 AS level FROM b GROUP BY lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       {level}NOT base_failed AND first > coalesce(level, 0) AS kept
FROM v LEFT JOIN c ON v.lang IS NOT DISTINCT FROM c.lang
"""


@query("op2_quality_rules", _quality_sql())
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """The quality verdict on every document."""
    found = quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op2_quality_rules_at_three_percent", _quality_sql(0.03, level="coalesce(level, 0) AS level, "))
def op2_at_three_percent(spark: SparkSession, folder: str) -> DataFrame:
    """The same where 3 % of the good texts may be rejected, which fewer labels can vouch for."""
    found = quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"), alpha=0.03)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "level", "kept"]
    return found.select(*columns)


@query("op4_training_order")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Every training sequence of the documents, read back from the shards."""
    return shards.training_order(table(spark, folder, "documents").select("doc_id", "text"))


def held_out(doc_id: str = "doc_id"):
    """Rows that no classifier learns from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels").where(~held_out()))
    return toxicity.with_scores(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op6_secret_scan")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate for a secret in the documents, with the forest's verdict."""
    docs = table(spark, folder, "documents")
    return secrets.scan(docs, secrets.trained_on(docs), path="source")


_LEAK_SQL = f"""
WITH i AS (
  SELECT row_number() OVER () AS k, item_id, w, least(5, len(w)) AS l
  FROM (SELECT DISTINCT item_id, text, regexp_extract_all(text, '{WORD}') AS w FROM benchmark WHERE text IS NOT NULL)
  WHERE len(w) > 0
), s AS (
  SELECT DISTINCT k, item_id, l, unnest(list_transform(range(1, len(w) - l + 2), lambda j: array_to_string(w[j:j + l - 1], ' '))) AS s
  FROM i
), n AS (
  SELECT k, count(*) AS n_item FROM s GROUP BY k
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), g AS (
  SELECT DISTINCT r, doc_id, l, unnest(list_transform(range(1, len(w) - l + 2), lambda j: array_to_string(w[j:j + l - 1], ' '))) AS s
  FROM d, (SELECT DISTINCT l FROM i)
), m AS (
  SELECT g.r, g.doc_id, s.k, s.item_id, count(*) AS n_shared
  FROM g JOIN s ON g.l = s.l AND g.s = s.s GROUP BY ALL
)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM m JOIN n USING (k) WHERE n_shared >= 0.8 * n_item - 1e-9
"""


@query("op7_benchmark_leaks", _LEAK_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item that stands in a document."""
    return leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s
), c AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS cap
  FROM w
), r AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, place) AS turn,
         sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(weight) OVER () AS weights
  FROM c
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER b, 0)) / (weights - coalesce(sum(weight) OVER b, 0)) AS level
  FROM r WINDOW b AS (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), h AS (
  SELECT arg_min(level, turn) FILTER (WHERE level <= cap / weight) AS held FROM l
), t AS (
  SELECT source, source_size, least(cap, weight * coalesce(held, 'inf'::DOUBLE)) AS target FROM l, h
), p AS (
  SELECT d.*, t.source_size, t.target,
         row_number() OVER (PARTITION BY d.source
           ORDER BY size, CAST('0x' || substr(key, 1, 6) AS BIGINT) % 4096, key, doc_id) AS place,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS each,
         CAST('0x' || substr(md5('{mixing.SEED}' || coalesce('s' || d.source, 'null')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS shift
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN size * CAST(floor(place * each + shift) - floor((place - 1) * each + shift) AS BIGINT) ELSE 0 END AS taken
FROM p
"""


_CHAT_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, v.turn, v.role, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|turn:|><|end|>') + length(replace(replace(role, '~', '~0'), '<', '~1')) + len(regexp_extract_all(role, '[|]'))
           + length(replace(replace(text, '~', '~0'), '<', '~1'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


@query("op8_chat_format", _CHAT_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    records = chat.conversations_to_records(given.unionByName(control))
    # What follows sees the output alone: the formatted text and the spans of the loss mask.
    output = written(chat.formatted_records(records).select("conv_id", "formatted", "loss"), "chat-formatted")
    back = output.withColumn("turns", chat.parsed("formatted"))
    every = "array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')"
    span = "substring(formatted, s.start + 1, s.end - s.start)"
    masked = f"array_join(transform(loss, s -> {chat.unescaped(span)}), '')"
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr(every).cast("binary"), 256).alias("turns_sha256"),
        F.char_length(F.expr(masked)).cast("long").alias("loss_chars"),
        F.sha2(F.expr(masked).cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op9_mix_sources", _MIX_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """The words of every document that a mix of 150 % of all words takes."""
    docs = table(spark, folder, "documents")
    sized = written(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("_size")), "mix-sizes")
    return mixing.copies(sized, weights=(5, 2, 1), share=1.5, most=2.0).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


@query("op10_license_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and labels of every document."""
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op11_bpe_round_trip")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document under byte_bpe_50k.json, and the text they decode to."""
    ids = bpe.with_ids(table(spark, folder, "documents").select("doc_id", "text"), "byte_bpe_50k.json")
    back = bpe.with_text(ids.select("doc_id", "ids"), "byte_bpe_50k.json")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_RESAMPLE_SQL = rf"""
WITH crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), w AS (
  SELECT 0 AS part, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), d AS (
  SELECT part, r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM w
), f AS (
  SELECT part, r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM d
), u AS (
  SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM f)
), k AS (
  SELECT f, xor(list_reduce(
           [4294967295] || list_transform(range(1, length(x) // 2 + 1), lambda i: CAST('0x' || substr(x, 2 * i - 1, 2) AS BIGINT)),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM u, crc
), n AS (
  SELECT bucket, count(*) FILTER (WHERE part = 0) AS s, count(*) FILTER (WHERE part = 1) AS t FROM f JOIN k USING (f) GROUP BY bucket
), g AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE)
                                      / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM n
), m AS (
  SELECT r, count(*) AS n_features, sum(gain) AS gain FROM f JOIN k USING (f) JOIN g USING (bucket) WHERE part = 0 GROUP BY r
), z AS (
  SELECT d.r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features > 0 THEN CAST((gain - ((gain % n_features) + n_features) % n_features) / n_features AS BIGINT) ELSE 0 END AS weight,
         CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN m USING (r) WHERE part = 0
), y AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM z
), v AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM y WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= 25 * (SELECT count(*) FROM v) // 100 THEN rank END AS rank
FROM y LEFT JOIN v USING (r)
"""


@query("op12_importance_resample", _RESAMPLE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the documents, drawn by importance towards the benchmark."""
    found = resample.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


_RANKED_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), c AS (
  SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0
), t AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term
), f AS (
  SELECT term, count(*) AS df FROM t GROUP BY term
), q AS (
  SELECT DISTINCT i, item_id, unnest(w) AS term FROM (
    SELECT row_number() OVER () AS i, item_id,
           regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark)
), g AS (
  SELECT i, item_id, term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight FROM q JOIN f USING (term), c
), s AS (
  SELECT i, item_id, doc_id, r,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * docs) // total)))) AS BIGINT) AS score
  FROM g JOIN t USING (term) JOIN d USING (r), c GROUP BY ALL
), k AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50
"""


@query("op13_ranked_search", _RANKED_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    index = ranked.indexed(table(spark, folder, "documents"))
    return ranked.searched(index, table(spark, folder, "benchmark"))
