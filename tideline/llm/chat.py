"""Chat formatting: records of many layouts to one canonical conversation, one template, and back.

A record is a JSON object.  Its fingerprint is a hash of its sorted nested field paths, over all
elements of its arrays, so records of one layout share it whatever they say.  ``MAPPINGS`` declares for each known layout where the
turns come from; the fingerprint picks the mapping.  The template writes every turn as

    <|turn:role|>text<|end|>

Inside roles and texts ``~`` is written ``~0`` and ``<`` is written ``~1``, so no text can hold a
marker and both steps are undone exactly.  Everything is SQL expressions; no row meets Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|turn:", "|>", "<|end|>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """One layout: its field paths and either a list of turns or single fields as turns.

    ``paths`` are as ``paths_of`` gives them: top-level fields, ``field[].inner`` for the fields of
    an array's objects, and the shape of what is nested deeper.
    ``turns`` names array, role field and text field; ``fields`` lists (role, field) in order;
    a field that the record lacks or has as null gives no turn where it is in ``optional``.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


MAPPINGS: tuple[Mapping, ...] = (
    Mapping("messages", ("id", "messages", "messages[].content", "messages[].role"), turns=("messages", "role", "content")),
    Mapping("messages-bare", ("messages", "messages[].content", "messages[].role"), turns=("messages", "role", "content")),
    Mapping(
        "from-value",
        ("conversations", "conversations[].from", "conversations[].value", "id"),
        turns=("conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Mapping("prompt-response", ("id", "prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt-completion", ("completion", "id", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping(
        "instruction",
        ("id", "input", "instruction", "output"),
        fields=(("system", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=("input",),
    ),
    Mapping("question-answer", ("answer", "id", "question"), fields=(("user", "question"), ("assistant", "answer"))),
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fingerprint_of(paths: Sequence[str]) -> Column:
    """The fingerprint of declared paths."""
    return F.xxhash64(F.lit("\n".join(sorted(paths))))


def paths_of(record: str) -> Column:
    """The sorted field paths of a JSON object, over all elements of its arrays; null if the text is none.

    A field is its name.  An array field adds ``field[].inner`` for every field of any of its
    objects and ``field[]`` if any element is no object.  A path whose value is nested deeper
    (an object, or an object or array inside an array's object) ends in ``:`` and its shape,
    types of single values left out: ``messages[].content:ARRAY<OBJECT<text: , type: >>``.
    """
    scalar = r"(?<=: |<)(?:VOID|BOOLEAN|BIGINT|FLOAT|DOUBLE|STRING|DECIMAL\\(\\d+,\\d+\\))(?=,|>)"

    def entries(value: str) -> str:
        return f"map_entries(try_variant_get({value}, '$', 'map<string,variant>'))"

    def shaped(path: str, value: str) -> str:
        shape = f"schema_of_variant({value})"
        return f"concat({path}, IF({shape} RLIKE '^(OBJECT|ARRAY)<', concat(':', regexp_replace({shape}, '{scalar}', '')), ''))"

    field = shaped("concat(e.key, '[].', f.key)", "f.value")
    inner = (
        f"transform(try_variant_get(e.value, '$', 'array<variant>'), "
        f"m -> coalesce(transform({entries('m')}, f -> {field}), array(concat(e.key, '[]'))))"
    )
    top = entries(f"from_json({record}, 'variant')")
    paths = (
        f"transform({top}, e -> IF(schema_of_variant(e.value) LIKE 'ARRAY<%', "
        f"concat(array(e.key), flatten({inner})), array({shaped('e.key', 'e.value')})))"
    )
    return F.expr(f"sort_array(array_distinct(flatten({paths})))")


def _hashed(paths: Column) -> Column:
    return F.when(paths.isNotNull(), F.xxhash64(F.array_join(paths, "\n")))


def fingerprint(record: str) -> Column:
    """The hash of the sorted field paths of a JSON object; null if the text is none."""
    return _hashed(paths_of(record))


def _turns(mapping: Mapping, record: str) -> str:
    """SQL for the turns of a record in ``mapping``'s layout.

    Null roles and texts are empty, but for an optional field, which gives no turn if it is null.
    """
    if mapping.turns:
        array, role, text = mapping.turns
        kind = f"STRUCT<`{array}`: ARRAY<STRUCT<`{role}`: STRING, `{text}`: STRING>>>"
        named = f"coalesce(m.`{role}`, '')"
        if mapping.roles:
            cases = " ".join(f"WHEN {_quoted(a)} THEN {_quoted(b)}" for a, b in mapping.roles)
            named = f"CASE {named} {cases} ELSE {named} END"
        return (
            f"transform(from_json({record}, '{kind}').`{array}`, "
            f"m -> named_struct('role', {named}, 'text', coalesce(m.`{text}`, '')))"
        )
    kind = ", ".join(f"`{f}` STRING" for _, f in mapping.fields)
    turns = []
    for role, field in mapping.fields:
        text = f"from_json({record}, '{kind}').`{field}`"
        turn = f"array(named_struct('role', {_quoted(role)}, 'text', coalesce({text}, '')))"
        turns.append(f"IF({text} IS NULL, array(), {turn})" if field in mapping.optional else turn)
    return f"concat({', '.join(turns)})"


def canonical(records: DataFrame, record: str = "record", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``records`` with ``layout`` (the mapping's name, null if none fits) and ``turns``.

    ``turns`` is an array of (role, text); of an unknown layout or a text that is no JSON object
    it is null, so such rows can be told and routed elsewhere.  So is a record of more than 128 MB,
    which Spark's variant does not hold.  Columns of these names that ``records`` has are replaced.
    """
    name = f"`{record}`"
    rows = records.withColumn("_paths", paths_of(name))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for mapping in reversed(mappings):
        given, needed = F.col("_paths"), sorted(set(mapping.paths) - set(mapping.optional))
        if mapping.optional:
            given = F.array_except(given, F.array(*[F.lit(f) for f in mapping.optional]))
        fits = _hashed(given) == fingerprint_of(needed)
        layout = F.when(fits, F.lit(mapping.name)).otherwise(layout)
        turns = F.when(fits, F.expr(_turns(mapping, name)).cast(TURNS)).otherwise(turns)
    return rows.withColumn("layout", layout).withColumn("turns", turns).drop("_paths")


def escaped(text: str) -> str:
    """SQL that writes a text so that no marker can stand in it."""
    return f"replace(replace({text}, '~', '~0'), '<', '~1')"


def unescaped(text: str) -> str:
    return f"replace(replace({text}, '~1', '<'), '~0', '~')"


def formatted(turns: str = "turns") -> Column:
    """The template over canonical turns; null turns give null, no turns an empty text."""
    # In a role the end of the opening marker must not occur either.
    role = f"replace({escaped('t.role')}, '|', '~2')"
    return F.expr(
        f"array_join(transform(`{turns}`, t -> concat('{OPEN}', {role}, '{CLOSE}', {escaped('t.text')}, '{END}')), '')"
    )


def parsed(text: str = "formatted") -> Column:
    """The turns read back from a formatted text, with where each text stands in it.

    An array of (role, text, start, end): characters ``start`` to ``end`` (from 0) of the
    formatted text hold the turn's escaped text.
    """
    # '<' occurs in markers only, so splitting at the end marker finds exactly the turns.
    end = END.replace("|", "\\\\|")
    blocks = f"filter(split(`{text}`, '{end}', -1), b -> b <> '')"
    head = f"locate('{CLOSE}', b)"
    begin = len(OPEN) + 1
    role = f"replace(substring(b, {begin}, {head} - {begin}), '~2', '|')"
    body = f"substring(b, {head} + {len(CLOSE)}, char_length(b))"
    made = (
        f"transform({blocks}, b -> named_struct('role', {unescaped(role)}, 'text', {unescaped(body)}, "
        f"'before', {head} + {len(CLOSE)} - 1, 'size', char_length(b)))"
    )
    placed = (
        f"aggregate({made}, named_struct('at', 0, 'all', CAST(array() AS array<struct<role:string,text:string,start:int,end:int>>)), "
        f"(a, m) -> named_struct('at', a.at + m.size + {len(END)}, 'all', concat(a.all, array(named_struct("
        "'role', m.role, 'text', m.text, 'start', a.at + m.before, 'end', a.at + m.size)))), a -> a.all)"
    )
    return F.expr(placed)


def loss_spans(turns: str = "turns", role: str = "assistant") -> Column:
    """(start, end) in the formatted text of what counts for the loss: the texts of one role."""
    return F.expr(
        f"transform(filter(`{turns}`, t -> t.role = '{role}'), t -> named_struct('start', t.start, 'end', t.end))"
    )


def conversations_to_records(rows: DataFrame) -> DataFrame:
    """One JSON record per conversation from rows by turn (``conv_id, turn, role, text``).

    Conversations of one user and one assistant turn become prompt and response, those with a
    system turn before them an instruction record, those of users and assistants alone
    from/value lists, all others message lists: the layouts that real collections mix.  Turns are
    in order of turn (null first), then role, then text; a null role or text is empty.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    roles = "transform(_turns, t -> t.role)"
    record = f"""
    CASE
      WHEN {roles} = array('user', 'assistant') THEN to_json(named_struct('id', string(coalesce(conv_id, 'none')), 'prompt', _turns[0].text, 'response', _turns[1].text))
      WHEN {roles} = array('system', 'user', 'assistant') THEN to_json(named_struct('id', string(coalesce(conv_id, 'none')), 'instruction', _turns[0].text, 'input', _turns[1].text, 'output', _turns[2].text))
      ELSE IF(forall(_turns, t -> t.role IN ('user', 'assistant')),
        to_json(named_struct('id', string(coalesce(conv_id, 'none')), 'conversations', transform(_turns, t -> named_struct('from', IF(t.role = 'user', 'human', 'gpt'), 'value', t.text)))),
        to_json(named_struct('id', string(coalesce(conv_id, 'none')), 'messages', transform(_turns, t -> named_struct('role', t.role, 'content', t.text)))))
    END
    """.replace("coalesce(conv_id, 'none')", "coalesce(string(conv_id), 'none')")
    return grouped.select("conv_id", F.expr(record).alias("record"))


def formatted_records(records: DataFrame) -> DataFrame:
    """``records`` with ``layout, formatted, turns`` (read back from it) and ``loss`` (spans).

    Columns of these names that ``records`` has are replaced, others stay.
    """
    made = canonical(records).withColumn("formatted", formatted("turns"))
    return made.withColumn("turns", parsed("formatted")).withColumn("loss", loss_spans("turns"))
