"""Chat formatting: records of many layouts become turns, turns become one marked text.

A record is JSON. Its schema is fingerprinted by hashing the nested field paths, and the
fingerprint selects a declared layout, which says where the turns are. Turns are then
written between marks; marks inside a text are escaped so that reading gives the text
back. Every step works on its own row, so no row moves.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspan.llm.frames import pack, unpack

# The marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURNS = "ARRAY<STRUCT<role: STRING, text: STRING>>"

# JSON strings and numbers, without recursion in Java's regex; the length below
# which the parser has no limit that a record can meet; the size from which a blanked record
# may be too large for a variant (128 MiB); and reading without limits on values.
_STRING = r'''"(?:[^"\\\x00-\x1F]++|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+"'''
_NUMBER = r"(-?+(?:[1-9]|0(?!\d)))\d*+(?:\.\d++)?+(?:[eE][+-]?+\d++)?+(?![\w.+-])"
UNLIMITED, TOO_LARGE = 1000, 1 << 24
READING = {"maxStringLen": "2147483647", "maxNumLen": "2147483647"}


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``paths`` are its nested field paths, ``name[]`` being the items of an array;
    ``optional`` ones may be absent. Either ``each`` names an array with the fields of role
    and text in its items, or ``turns`` lists (role, fields), where several fields are
    joined by an empty line and absent or empty ones are left out.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    each: tuple[str, str, str] | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


# The layouts in common use.
LAYOUTS = (
    Layout(
        "messages",
        ("messages[].role", "messages[].content"),
        ("id", "messages[].name", "messages[].weight"),
        each=("messages", "role", "content"),
    ),
    Layout(
        "conversations",
        ("conversations[].from", "conversations[].value"),
        ("id", "system"),
        each=("conversations", "from", "value"),
        turns=(("system", ("system",)),),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout(
        "prompt_response",
        ("prompt", "response"),
        ("id", "system"),
        turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        ("id", "input", "system"),
        turns=(
            ("system", ("system",)),
            ("user", ("instruction", "input")),
            ("assistant", ("output",)),
        ),
    ),
    Layout(
        "question_answer",
        ("question", "answer"),
        ("id",),
        turns=(("user", ("question",)), ("assistant", ("answer",))),
    ),
)


def _shape(paths: tuple[str, ...]) -> str:
    """Nested paths as Spark writes a variant's schema, with ``_`` for every plain value."""
    tree: dict = {}
    for path in paths:
        at = tree
        for part in path.split("."):
            at = at.setdefault(part, {})
    return _written(tree)


def _written(tree: dict) -> str:
    if not tree:
        return "_"
    fields = []
    for name in sorted(tree, key=lambda x: x.removesuffix("[]")):
        inner = _written(tree[name])
        bare = name.removesuffix("[]")
        fields.append(f"{bare}: ARRAY<{inner}>" if bare != name else f"{bare}: {inner}")
    return f"OBJECT<{', '.join(fields)}>"


def blanked(record: Column) -> Column:
    """A record with its strings emptied and its numbers cut to a digit; names stay.

    Its paths are those of the record, but no value is long. Text that is not JSON stays so.
    """
    value = _STRING.replace('"(?:', '(")(?:', 1).removesuffix('"') + '(")'
    pattern = rf"({_STRING}(?=\s*+:))|{value}|(?<![\w.+-]){_NUMBER}"
    return F.regexp_replace(record, pattern, "$1$2$3$4")


def fingerprint(record: Column) -> Column:
    """Hash of a record's nested field paths; null for null and for text that is not JSON.

    Names of values' types are taken out, so a null and a number have the same path. Long
    records that the parser refuses are hashed from their blanked text; one that is JSON and
    still too large for a variant raises an error.
    """
    short = blanked(record)
    is_json = F.from_json(record, "_corrupt_record STRING", READING)["_corrupt_record"].isNull()
    refused = (F.length(short) > TOO_LARGE) & is_json
    error = F.raise_error(F.lit("A chat record has too many values to be parsed"))
    return (
        F.when(F.try_parse_json(record).isNotNull(), _shape_hash(record))
        .when(F.length(record) <= UNLIMITED, None)
        .when(F.try_parse_json(short).isNotNull(), _shape_hash(short))
        .when(refused, error.cast("long"))
    )


def _shape_hash(record: Column) -> Column:
    schema = F.schema_of_variant(F.try_parse_json(record))
    plain = r"(?<=: |ARRAY<|^)(?!OBJECT<|ARRAY<)[A-Z_]+(\(\d+,\s*\d+\))?(?=[,>]|$)"
    return F.xxhash64(F.regexp_replace(schema, plain, "_"))


def layout_table(spark: SparkSession, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Every shape of every layout: one row for each choice of optional paths.

    An array of turns that is empty has a shape of its own.
    """
    rows = []
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for extra in combinations(layout.optional, n):
                paths = layout.paths + extra
                rows.append((layout.name, _shape(paths)))
                if layout.each:
                    at = f"{layout.each[0]}[]"
                    outer = tuple(p for p in paths if not p.startswith(at))
                    rows.append((layout.name, _shape((*outer, at))))
    shapes = spark.createDataFrame(list(dict.fromkeys(rows)), "layout string, shape string")
    return shapes.select("layout", F.xxhash64("shape").alias("schema_hash"))


def _turns(layout: Layout) -> str:
    """The turns of a record of this layout, as SQL.

    They are read from the variant ``v``, or from the text of a record that has none.
    """
    names = [name for _, fields in layout.turns for name in fields]
    columns = [f"`{name}` STRING" for name in names]
    array, kind = "", ""
    if layout.each:
        array, role, text = layout.each
        kind = f"ARRAY<STRUCT<`{role}`: STRING, `{text}`: STRING>>"
        columns.append(f"`{array}` {kind}")
    options = {**READING, "mode": "FAILFAST"}.items()
    options = ", ".join(f"'{key}', '{value}'" for key, value in options)
    typed = f"from_json(record, '{', '.join(columns)}', map({options}))"
    short = _listed(
        layout,
        "try_variant_get(v, '$.{}', 'string')",
        f"try_variant_get(v, '$.{array}', '{kind}')",
    )
    long = _listed(layout, "r.`{}`", f"r.`{array}`")
    return f"IF(v IS NOT NULL, {short}, transform(array({typed}), r -> {long})[0])"


def _listed(layout: Layout, field: str, items: str) -> str:
    """The turns of a layout, given SQL for a field (``{}`` is its name) and for its array."""
    fixed = []
    for role, names in layout.turns:
        parts = ", ".join(f"nullif({field.format(name)}, '')" for name in names)
        text = f"concat_ws('\\n\\n', {parts})"
        optional = all(name in layout.optional for name in names)
        turn = f"array(struct('{role}' AS role, {text} AS text))"
        absent = f"CAST(array() AS {TURNS})"
        fixed.append(f"IF({text} = '', {absent}, {turn})" if optional else turn)
    if layout.each is None:
        return f"concat({', '.join(fixed)})"
    _, role, text = layout.each
    name = f"coalesce(x.`{role}`, '')"
    named = "".join(f" WHEN {name} = '{a}' THEN '{b}'" for a, b in layout.roles)
    shown = f"CASE{named} ELSE {name} END" if named else name
    listed = (
        f"transform(coalesce({items}, array()),"
        f" x -> struct({shown} AS role, coalesce(x.`{text}`, '') AS text))"
    )
    return f"concat({', '.join([*fixed, listed])})"


def canonical_turns(
    records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """The rows with ``schema_hash``, ``layout`` and ``turns`` (array of role, text).

    The declared layouts, one row for each shape, are joined by the fingerprint. A record
    of no declared shape keeps its fingerprint, with a null layout and null turns, as does
    one that is null or not JSON (with a null fingerprint). Texts may be of any length; JSON
    with too many values for the parser raises an error. Null roles and texts are empty.
    Input columns of the added names are replaced.
    """
    shapes = layout_table(records.sparkSession, layouts)
    rows = pack(records, record=record).withColumn("schema_hash", fingerprint(F.col("record")))
    turns = " ".join(f"WHEN '{x.name}' THEN {_turns(x)}" for x in layouts)
    found = (
        rows.join(F.broadcast(shapes), "schema_hash", "left")
        .withColumn("v", F.try_parse_json("record"))
        .withColumn("turns", F.expr(f"CASE layout {turns} END").cast(TURNS))
    )
    added = {name: F.col(name) for name in ("schema_hash", "layout", "turns")}
    return unpack(found, records.columns, **added)


def escaped(text: str) -> str:
    """SQL that makes a text free of marks: backslashes doubled, ``<|`` written ``<\\|``."""
    return rf"replace(replace({text}, r'\', r'\\'), '<|', r'<\|')"


def unescaped(text: str) -> str:
    """SQL that undoes :func:`escaped`. Backslashes come in pairs except before a bar."""
    return (
        rf"array_join(transform(split({text}, r'\\\\', -1),"
        r" p -> replace(p, r'<\|', '<|')), r'\')"
    )


def _escaped_role(role: str) -> str:
    """A role ends at the first line break, so its own are written ``\\/``."""
    return rf"replace({escaped(role)}, '\n', r'\/')"


def _unescaped_role(role: str) -> str:
    return (
        rf"array_join(transform(split({role}, r'\\\\', -1),"
        r" p -> replace(replace(p, r'\/', '\n'), r'<\|', '<|')), r'\')"
    )


def format_chat(
    rows: DataFrame, turns: str = "turns", learned: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """The rows with ``segments`` (array of text, loss) and ``formatted``, their text joined.

    A turn is the opening mark, the role, a line break, the text, the closing mark and a
    line break. The loss mask covers the texts of the learned roles, without their marks.
    Null turns are no turns; a null role or text is empty. Input columns of the added
    names are replaced.
    """
    roles = ", ".join(f"'{role}'" for role in learned)
    loss = f"coalesce(t.role, '') IN ({roles})" if learned else "false"
    segments = (
        f"flatten(transform(coalesce(turns, CAST(array() AS {TURNS})), t -> array("
        f"struct(concat('{OPEN}', {_escaped_role("coalesce(t.role, '')")}, '\\n') AS text,"
        f" false AS loss),"
        f" struct({escaped("coalesce(t.text, '')")} AS text, {loss} AS loss),"
        f" struct('{CLOSE}\\n' AS text, false AS loss))))"
    )
    done = (
        pack(rows, turns=turns)
        .withColumn("segments", F.expr(segments))
        .withColumn("formatted", F.expr("array_join(transform(segments, s -> s.text), '')"))
    )
    return unpack(
        done, rows.columns, segments=F.col("segments"), formatted=F.col("formatted")
    )


def read_turns(formatted: str) -> Column:
    """The turns that a formatted text holds: array of (role, text)."""
    mark = OPEN.replace("|", "[|]")
    tail = len(CLOSE) + 1
    inner = f"substring(p, n + 2, length(p) - n - 1 - {tail})"
    return F.expr(
        f"transform(filter(split({formatted}, '{mark}', -1), (p, i) -> i > 0), p ->"
        " transform(array(CAST(length(substring_index(p, '\\n', 1)) AS INT)), n ->"
        f" struct({_unescaped_role('substring(p, 1, n)')} AS role,"
        f" {unescaped(inner)} AS text))[0])"
    )


def read_loss(segments: str) -> Column:
    """All text under the loss mask, as it was before it was escaped."""
    return F.expr(
        f"array_join(transform(filter({segments}, s -> s.loss), s -> {unescaped('s.text')}), '')"
    )


CHAT_ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(role) + length(text)
           + length(text) - length(replace(text, '\', ''))
           + (length(text) - length(replace(text, '<|', ''))) // 2)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
