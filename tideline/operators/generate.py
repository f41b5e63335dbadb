"""Test events and user sessions as a deterministic, distributed Spark job.

Every value is a function of the row id, the seed and the field name, so a row comes out the
same whatever partition or attempt computes it.  The ids come from a *spine*: ``spark.range``
or any table with an integer id and an event time.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import topic_for
from tideline.plans.schema import EVENT_ID, TIMESTAMP, fields_of
from tideline.plans.spec import Domain, EventType
from tideline.sources.decode import once

# A prime below 2**31: products of two residues stay inside a 64-bit long.
_PRIME = 2_147_483_647
_NULL_PER_MILLE = 100
# The JIT compiler leaves methods of over 8,000 bytes interpreted; a group of this many fields
# is computed in an operator, and so a method, of its own.
_FIELDS_PER_METHOD = 6
_MONEY_RANGE = (100, 100_000)


def factors(seed: int, purpose: str) -> tuple[int, int]:
    """Multiplier and offset of the universal hash for one purpose."""
    slope, offset = (zlib.crc32(f"{seed}:{purpose}:{part}".encode()) for part in ("slope", "offset"))
    return slope % (_PRIME - 1) + 1, offset % _PRIME


def _residue(id_column: str) -> str:
    """SQL text folding an id into [0, 2**31 - 1)."""
    return f"((`{id_column}` % {_PRIME}L + `{id_column}` div {_PRIME}L % {_PRIME}L * 16807L) % {_PRIME}L)"


def _draw(residue: str, seed: int, purpose: str) -> str:
    """SQL text of a number in [0, 2**31 - 1); as text it costs one call to build a column."""
    slope, offset = factors(seed, purpose)
    return f"(({residue} * {slope}L + {offset}L) % {_PRIME}L)"


def _between(residue: str, seed: int, purpose: str, low: int, high: int) -> str:
    return f"({_draw(residue, seed, purpose)} % {high - low + 1}L + {low}L)"


def draw(id_column: str, seed: int, purpose: str) -> Column:
    """A pseudo-random integer in [0, 2**31 - 1) for this id and purpose, all in codegen."""
    return F.expr(_draw(_residue(id_column), seed, purpose))


def draw_between(id_column: str, seed: int, purpose: str, low: int, high: int) -> Column:
    """An integer in [low, high]."""
    return F.expr(_between(_residue(id_column), seed, purpose, low, high))


def draw_chance(id_column: str, seed: int, purpose: str, probability: float) -> Column:
    return F.expr(f"{_draw(_residue(id_column), seed, purpose)} % 10000L < {round(probability * 10_000)}L")


def spine(spark: SparkSession, rows: int, start_millis: int, step_millis: int = 1) -> DataFrame:
    """``id, at_millis`` for a table made from nothing."""
    return spark.range(rows).select("id", (F.lit(start_millis) + F.col("id") * step_millis).alias("at_millis"))


# What all fields of a row share, in a projection of its own below them: the folded id and one
# digest.  Repeated in every field they would make the generated method too long to compile.
_DIGEST, _X = "digest__", "x__"


def _prepared(rows: DataFrame, seed: int) -> DataFrame:
    digest = F.expr(f"md5(concat('{seed}:{EVENT_ID}:', cast(id as string)))")
    return rows.withColumns({_X: F.expr(_residue("id")), _DIGEST: digest})


def _uuid() -> str:
    """A version-4 shaped id from the row's digest."""
    cuts = ((1, 8, "-"), (9, 4, "-4"), (14, 3, "-a"), (18, 3, "-"), (21, 12, ""))
    return "concat(" + ", ".join(f"substring({_DIGEST}, {at}, {n}), '{after}'" for at, n, after in cuts) + ")"


def _tag(seed: int, purpose: str) -> str:
    """Eight hex digits."""
    return f"lpad(lower(hex({_draw(_X, seed, purpose)})), 8, '0')"


def user_name(number: str) -> str:
    """SQL text of ``user_%06d``, without a formatter object per row."""
    return f"concat('user_', if({number} < 1000000L, lpad(cast({number} as string), 6, '0'), cast({number} as string)))"


def _choice(name: str, choices: tuple[str, ...], seed: int) -> str:
    """SQL text that draws one of the sample values of a field."""
    listed = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in choices)
    # The array folds to one constant; elt() would generate a branch per choice.
    return f"element_at(array({listed}), cast({_between(_X, seed, name, 1, len(choices))} as int))"


# What a field's kind alone says about its values.
_BY_KIND = {
    "money": lambda name, seed: _between(_X, seed, name, *_MONEY_RANGE),
    "long": lambda name, seed: _between(_X, seed, name, *_MONEY_RANGE),
    "float": lambda name, seed: f"({_between(_X, seed, name, 0, 10_000)} / 100D)",
    "double": lambda name, seed: f"({_between(_X, seed, name, 0, 10_000)} / 100D)",
    "int": lambda name, seed: f"cast({_between(_X, seed, name, 1, 100)} as int)",
    "boolean": lambda name, seed: f"({_draw(_X, seed, name)} % 2L = 0L)",
    "string": lambda name, seed: f"concat('{name}_', {_tag(seed, name)})" if "id" in name.lower() else f"'sample_{name}'",
}


def _by_name(domain: Domain, seed: int) -> dict[str, str]:
    """Fields whose values follow from their names: ids, entities, and those with samples."""
    pool = domain.synthetic.get("user_pool_size", 10_000)
    named = {EVENT_ID: _uuid(), domain.entity_key: user_name(_between(_X, seed, domain.entity_key, 1, pool))}
    return named | {name: _choice(name, choices, seed) for name, choices in domain.samples.items() if choices}


def _fields(kind_of: EventType, domain: Domain, seed: int, given: dict[str, str]) -> dict[str, str]:
    """SQL text of every field of one event type, in record order."""
    fields, named = {}, _by_name(domain, seed)
    for name, kind, nullable in fields_of(kind_of, domain.entity_key):
        if kind not in _BY_KIND and name != TIMESTAMP and name not in named:
            raise ValueError(f"{name}: no generator for {kind}")
        if name in given:
            fields[name] = given[name]
            continue
        if name == TIMESTAMP:
            fields[name] = "at_millis"
            continue
        value = named[name] if name in named else _BY_KIND[kind](name, seed)
        if nullable:
            value = f"if({_draw(_X, seed, name + '?')} % 1000L >= {_NULL_PER_MILLE}L, {value}, null)"
        fields[name] = value
    return fields


def generate_events(
    rows: DataFrame,
    domain: Domain,
    event_type: str | EventType,
    seed: int = 42,
    given: dict[str, str] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One event per spine row.

    ``given`` fixes fields to SQL expressions over the spine (a known user, a known amount);
    ``keep`` carries spine columns along.  Nullable fields are null one time in ten.
    """
    kind_of = event_type if isinstance(event_type, EventType) else domain.event_type(event_type)
    fields = _fields(kind_of, domain, seed, given or {})
    return _prepared(rows, seed).selectExpr(*keep, *[f"{text} as `{name}`" for name, text in fields.items()])


def generate_messages(
    rows: DataFrame,
    domain: Domain,
    event_types: list[str] | None = None,
    seed: int = 42,
    given: dict[str, str] | None = None,
    prefix: str = "events",
) -> DataFrame:
    """A mixed topic table in one scan: every spine row is one JSON event of a drawn type.

    ``event_types`` subscribes to some types: rows of other types are dropped before any
    payload is built.
    """
    names = [t.name for t in domain.event_types]
    wanted = [t for t in domain.event_types if t.name in (event_types or names)]
    topics = ", ".join(f"'{topic_for(n, prefix)}'" for n in names)
    typed = _prepared(rows, seed).withColumn(
        "topic", F.expr(f"element_at(array({topics}), cast({_between(_X, seed, 'event_type', 1, len(names))} as int))")
    )
    if len(wanted) < len(names):
        typed = typed.filter(F.col("topic").isin([topic_for(t.name, prefix) for t in wanted]))
    # One record over the fields of all types; to_json leaves out what a type lacks.
    carriers: dict[str, dict[str, str]] = {}
    for event_type in domain.event_types:
        for name, text in _fields(event_type, domain, seed, given or {}).items():
            carriers.setdefault(name, {})[topic_for(event_type.name, prefix)] = text
    subscribed = {topic_for(t.name, prefix) for t in wanted}
    entries = []
    for name, by_topic in carriers.items():
        by_text: dict[str, list[str]] = {}
        for topic, text in by_topic.items():
            if topic in subscribed:
                by_text.setdefault(text, []).append(topic)
        if len(by_text) == 1 and len(next(iter(by_text.values()))) == len(subscribed):
            entries.append((name, next(iter(by_text))))
        elif by_text:
            cases = (f"when topic in ({', '.join(repr(t) for t in ts)}) then {text}" for text, ts in by_text.items())
            entries.append((name, f"case {' '.join(cases)} end"))
    entity = (given or {}).get(domain.entity_key) or _by_name(domain, seed)[domain.entity_key]
    members = []
    for part in range(0, len(entries), _FIELDS_PER_METHOD):
        group, column = entries[part : part + _FIELDS_PER_METHOD], f"part_{part}__"
        record = ", ".join(f"'{name}', {text}" for name, text in group)
        typed = typed.select("*", once(F.expr(f"named_struct({record})"), column))
        members += [f"'{name}', {column}.`{name}`" for name, _ in group]
    return typed.selectExpr(
        f"cast({entity} as binary) as key",
        f"cast(to_json(named_struct({', '.join(members)})) as binary) as value",
        "topic",
        "cast(id % 8 as int) as partition",
        "id as offset",
        "timestamp_millis(at_millis) as timestamp",
    )


def generate_sessions(rows: DataFrame, domain: Domain, seed: int = 42) -> DataFrame:
    """User journeys: one spine row becomes one to five ordered events of one user.

    page_view, then 60 % product_view, of those 40 % add_to_cart, of those the domain's
    conversion rate purchase; independently 20 % search at the end.
    Result: ``session_id, step, user_id, event_type, timestamp``.
    """
    patterns = domain.synthetic.get("patterns", {})
    conversion = patterns.get("purchase_conversion_rate", 0.03)
    pool = domain.synthetic.get("user_pool_size", 10_000)

    def chance(name: str, probability: float) -> Column:
        return draw_chance("id", seed, f"session:{name}", probability)

    def gap(name: str, low: int, high: int) -> Column:
        return draw_between("id", seed, f"gap:{name}", low, high)

    # Step probabilities and gaps in milliseconds.
    viewed = chance("product_view", 0.6)
    carted = viewed & chance("add_to_cart", 0.4)
    bought = carted & chance("purchase", conversion)
    searched = chance("search", 0.2)
    steps = [
        ("page_view", F.lit(True), F.lit(0)),
        ("product_view", viewed, gap("product_view", 5_000, 30_000)),
        ("add_to_cart", carted, gap("add_to_cart", 10_000, 60_000)),
        ("purchase", bought, gap("purchase", 30_000, 120_000)),
        ("search", searched, gap("search", 1_000, 10_000)),
    ]
    elapsed, entries = F.lit(0).cast("bigint"), []
    for event_type, happened, wait in steps:
        elapsed = elapsed + F.when(happened, wait).otherwise(0)
        entry = F.struct(F.lit(event_type).alias("event_type"), (F.col("at_millis") + elapsed).alias("timestamp"))
        entries.append(F.when(happened, entry))
    journey = F.filter(F.array(*entries), lambda e: e.isNotNull())
    user = F.expr(user_name(_between(_residue("id"), seed, domain.entity_key, 1, pool)))
    return rows.select(
        F.col("id").alias("session_id"), user.alias(domain.entity_key), F.posexplode(journey).alias("pos", "e")
    ).select(
        "session_id",
        (F.col("pos") + 1).alias("step"),
        domain.entity_key,
        F.col("e.event_type").alias("event_type"),
        F.col("e.timestamp").alias("timestamp"),
    )


def shape_traffic(rows: DataFrame, domain: Domain, seed: int = 42, off_peak: float = 0.5) -> DataFrame:
    """Thin spine rows to the domain's daily and weekly rhythm.

    A row's weight is 1 in a peak hour and ``off_peak`` otherwise, times the weekend
    multiplier on Saturdays and Sundays; it stays with probability weight / largest weight.
    """
    patterns = domain.synthetic.get("patterns", {})
    peak_hours = list(patterns.get("peak_hours", (10, 11, 12, 19, 20, 21)))
    weekend = patterns.get("weekend_multiplier", 1.3)
    hour = F.floor(F.col("at_millis") / 3_600_000) % 24
    # Day 0 of the epoch was a Thursday, so days 2 and 3 of each week are the weekend.
    is_weekend = (F.floor(F.col("at_millis") / 86_400_000) % 7).isin(2, 3)
    weight = F.when(hour.isin(peak_hours), 1.0).otherwise(off_peak) * F.when(is_weekend, weekend).otherwise(1.0)
    per_mille = F.floor(weight * 1000 / max(weekend, 1.0))
    return rows.filter(draw("id", seed, "traffic") % 1000 < per_mille)
