"""Repair of conversations: the cheapest edits that give a legal order of roles.

A conversation is a lattice with one layer per row and one node per role that may stand
last. Keeping, renaming or deleting a row leads to the next layer, inserting an empty turn to
another node of the same one. Node prices come from the auction algorithm for shortest
paths: a path grows along the arc with the least cost and price ahead; where even that arc
costs more than its node's price, the price is raised to it and the path loses its last
node. Layers are priced from the last one, each node in turn being the origin, so that in
the end all prices are distances to the end, and an arc is on a cheapest path if and only if
cost and prices agree. Such arcs are followed from the start, the least letter first.

Rows are range-partitioned by conversation and turn, so a large conversation is read by many
tasks, in pieces. A piece that does not hold a whole conversation is priced for each node
that it may end on; the prices of its conversation are then put together from those
figures, and texts pass one by one, as a digest of them asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspan.llm.frames import pick, small
from panelspan.operators.lookup import fits_broadcast, lookup
from panelspan.sinks.scratch import staged

# White space, and what ends a sentence.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = (".", "!", "?")

DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3

# Nodes of a layer: the role that stands last. The end may follow NOTHING and ASSISTANT.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NODES = range(4)
INITIALS = "sua"
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEXT = (USER, USER, ASSISTANT, USER)
AT_END = (0, 2 * INSERT_COST, INSERT_COST, 0)
LEGAL_PAIRS = {"su", "ua", "au"}

NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Prices of one layer differ by at most 10: whatever follows one node can, with at most a
#: deletion and two insertions more, follow every other.
FAR = 16

PIECE_ROWS = 4096
PIECE_CHARS = 1 << 22
LEADING = 64


def kind_of(initial: str, fault: int) -> int:
    """What the arcs of a row depend on: 0 must go, else initial (of 4) and truncation."""
    if fault in (BLANK, DUPLICATE):
        return 0
    place = INITIALS.index(initial) if initial and initial in INITIALS else len(INITIALS)
    return 1 + 2 * place + (fault == TRUNCATED)


@lru_cache(None)
def arcs(kind: int, node: int) -> tuple[tuple[str, int, bool, int], ...]:
    """Letter, cost, whether it leads to the next layer, and node; the least letter first."""
    found = [(DELETE, DELETE_COST, True, node), (INSERT, INSERT_COST, False, NEXT[node])]
    if kind:
        place, more = divmod(kind - 1, 2)
        more *= TRUNCATED_COST
        if place == 0 and node == NOTHING:
            found.append((KEEP, more, True, SYSTEM))
        elif place in (1, 2) and NEXT[node] == place + 1:
            found.append((KEEP, more, True, NEXT[node]))
        found.append((REROLE, REROLE_COST + more, True, NEXT[node]))
    return tuple(found)


@lru_cache(1 << 16)
def layer_prices(kind: int, ahead: tuple[int, ...]) -> tuple[int, ...]:
    """Prices of a layer's nodes by auction, given the final ones of the layer ahead.

    Layers recur, so prices are asked for relative to the least one ahead, and kept.
    """
    prices = [0] * len(NODES)
    final = [False] * len(NODES)
    for origin in reversed(NODES):
        path = [origin]
        while not final[origin]:
            node = path[-1]
            offer, on, to = min(
                (cost + (ahead[to] if on else prices[to]), not on, to)
                for _, cost, on, to in arcs(kind, node)
            )
            if prices[node] < offer:
                prices[node] = offer
                if len(path) > 1:
                    path.pop()
            elif not on or final[to]:
                for each in path:
                    final[each] = True
            else:
                path.append(to)
    return tuple(prices)


def prices_of(kinds: bytes, end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Final prices of all layers, the given one behind the last row included."""
    prices = [end]
    for kind in reversed(kinds):
        least = min(prices[-1])
        layer = layer_prices(kind, tuple(p - least for p in prices[-1]))
        prices.append(tuple(p + least for p in layer))
    prices.reverse()
    return prices


def edits_of(kinds: bytes, prices: list[tuple[int, ...]], node: int) -> Iterator[tuple]:
    """(letter, cost, row or None, node) of the least path of tight arcs from a node."""
    for at, kind in enumerate(kinds):
        moved = False
        while not moved:
            for letter, cost, moved, to in arcs(kind, node):
                if cost + prices[at + moved][to] == prices[at][node]:
                    break
            node = to
            yield letter, cost, at if moved else None, node


def closing_edits(node: int) -> Iterator[tuple]:
    """Insertions after the last row."""
    while node not in (NOTHING, ASSISTANT):
        node = NEXT[node]
        yield INSERT, INSERT_COST, None, node


@dataclass
class Piece:
    """Consecutive rows of one conversation, and what is counted in them."""

    kinds: bytearray = field(default_factory=bytearray)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    chars: int = 0
    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    gaps: int = 0
    first: tuple[str, int | None] | None = None
    last: tuple[str, int | None] = ("", None)

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        here = (role[:1], turn)
        if self.first is None:
            self.first = here
        else:
            illegal, gaps = between(self.last, here)
            self.illegal += illegal
            self.gaps += gaps
        self.last = here
        self.kinds.append(kind_of(role[:1], fault))
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text) + len(role)
        self.counts[fault] += 1

    def full(self) -> bool:
        return len(self.kinds) >= PIECE_ROWS or self.chars >= PIECE_CHARS


def between(before: tuple[str, int | None], after: tuple[str, int | None]) -> tuple[int, int]:
    """Whether two adjacent roles are illegal, and how many turns lie between the two rows."""
    illegal = before[0] + after[0] not in LEGAL_PAIRS
    missing = 0
    if before[1] is not None and after[1] is not None:
        missing = max(0, after[1] - before[1] - 1)
    return int(illegal), missing


@dataclass
class Repair:
    """A conversation while its pieces pass."""

    node: int = NOTHING
    digest: "hashlib._Hash" = field(default_factory=hashlib.sha256)
    written: bool = False
    last: tuple[str, int | None] | None = None

    def take(self, piece: Piece, end: tuple[int, ...], closes: bool, turns: bool) -> dict:
        """The report on one piece, by the prices behind it."""
        kinds = bytes(piece.kinds)
        edits = list(edits_of(kinds, prices_of(kinds, end), self.node))
        self.node = edits[-1][3] if edits else self.node
        if closes:
            edits += closing_edits(self.node)
        roles, texts = [], []
        for letter, _, row, node in edits:
            if letter == DELETE:
                continue
            role = piece.roles[row] if letter == KEEP else NAMES[node]
            text = "" if row is None else piece.texts[row]
            self.digest.update((("\n" if self.written else "") + f"{role}:{text}").encode())
            self.written = True
            if turns:
                roles.append(role)
                texts.append(text)
        illegal, gaps = (0, 0) if self.last is None else between(self.last, piece.first)
        self.last = piece.last
        return {
            "edits": "".join(letter for letter, *_ in edits),
            "cost": sum(cost for _, cost, *_ in edits),
            "blank": piece.counts[BLANK],
            "duplicate": piece.counts[DUPLICATE],
            "truncated": piece.counts[TRUNCATED],
            "illegal": piece.illegal + illegal,
            "gaps": piece.gaps + gaps,
            "roles": roles if turns else None,
            "texts": texts if turns else None,
            "sha256": self.digest.hexdigest() if closes else None,
        }


_REPORT = {
    "edits": "string", "cost": "bigint", "blank": "bigint", "duplicate": "bigint",
    "truncated": "bigint", "illegal": "bigint", "gaps": "bigint",
    "roles": "array<string>", "texts": "array<string>", "sha256": "string",
}
# What an unfinished piece carries besides its roles, texts and counts.
_OPEN = {
    "step": "int", "seq": "bigint", "matrix": "array<bigint>", "kinds": "binary",
    "first_initial": "string", "first_turn": "bigint",
    "last_initial": "string", "last_turn": "bigint",
}
DONE, PRICED, WAITING = range(3)
_ARROW = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
    "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64()),
}


def repair_conversations(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    turns: bool = True,
) -> DataFrame:
    """The cheapest repair of each conversation, one row per piece of at most 4,096 rows.

    Columns: ``conv`` and ``seq`` (the order of a conversation's pieces); ``edits``, one
    letter each: K a row is kept (cost 0), R its role becomes user or assistant (3), D it is
    deleted (4), I an empty user or assistant turn is inserted (3); ``cost``; ``blank``,
    ``duplicate`` and ``truncated``, rows by their first fault; ``illegal``, adjacent roles
    that may not follow each other; ``gaps``, turns that no row has; ``roles`` and ``texts``
    of the repaired turns (null without ``turns``); and ``sha256``, on the last piece, of the
    conversation's ``role:text`` lines.

    The roles that are left start with ``(s?(ua)+)?``. Blank rows (white space only) and
    those whose role and text stood before are always deleted; a row that does not end with
    ``.``, ``!`` or ``?`` costs 3 more unless it is deleted. Of equally cheap repairs the
    least sequence of letters is taken.

    Rows go by turn, null first, and within a turn by the first 64 characters of the role,
    then by a hash of role and text. A null role or text is an empty one; other roles than
    s..., u... and a... cannot be kept. Rows without a conversation are one conversation.
    An empty table gives no rows. Other columns are not looked at.
    """
    picked = pick(rows, conv=conversation, turn=turn, role=role, text=text)
    picked = picked.select(
        "conv",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "leading", "same"]
    placed = _faults(picked).withColumn("leading", F.left("role", F.lit(LEADING)))
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    conv_type = picked.schema["conv"].dataType
    fields = [f"{name} {kind}" for name, kind in (_OPEN | _REPORT).items()]
    schema = T.StructType(
        [T.StructField("conv", conv_type), *T._parse_datatype_string(", ".join(fields))]
    )
    found = staged(
        placed.select("conv", "turn", "role", "text", "fault", "times").mapInArrow(
            _cut(turns), schema
        )
    )
    waiting = (
        found.filter(F.col("step") != DONE)
        .repartition("conv")
        .sortWithinPartitions("conv", "step", F.expr(f"IF(step = {PRICED}, -seq, seq)"))
        .mapInArrow(_joined(turns), schema)
    )
    result = ["conv", "seq", *_REPORT]
    return found.filter(F.col("step") == DONE).select(*result).union(waiting.select(*result))


def _faults(rows: DataFrame) -> DataFrame:
    """Rows with their first fault; equal rows of one turn are one, with ``times``.

    Roles and texts that occur once in their conversation, nearly all, do not move here.
    """
    bare = F.rtrim("text", F.lit(WHITE))
    rows = rows.withColumns({"same": _same(), "bare": F.right(bare, F.lit(1))})
    again = staged(
        rows.groupBy("same")
        .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("same", "first")
    )
    small_again = fits_broadcast(again)
    marked = lookup(rows, again, "same", "left", small_again, spread_by=["turn", "conv"])
    repeated = (
        marked.filter("first IS NOT NULL")
        .groupBy("conv", "turn", "role", "text", "same", "bare", "first")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    once = marked.filter("first IS NULL").withColumn("times", F.lit(1).cast("long"))
    fault = (
        F.when(F.col("bare") == "", BLANK)
        .when(~F.col("first.turn").eqNullSafe(F.col("turn")) & F.col("first").isNotNull(), DUPLICATE)
        .when(~F.col("bare").isin(*ENDS), TRUNCATED)
        .otherwise(NO_FAULT)
    )
    return once.unionByName(repeated).withColumn("fault", fault)


def _same() -> Column:
    """A hash of conversation, role and text, each with its length or null."""
    conv = F.col("conv").cast("string")
    parts = [F.coalesce(F.length(conv).cast("string"), F.lit("-")), F.coalesce(conv, F.lit("")),
             F.length("role").cast("string"), F.col("role"), F.col("text")]
    return F.unhex(F.md5(F.concat_ws(":", *parts)))


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, piece, whether it is new), in the order of the rows of a partition."""
    piece, current, new = None, None, True
    for batch in small(batches):
        for conv, turn, role, text, fault, times in zip(*[c.to_pylist() for c in batch.columns]):
            if piece is None or conv != current:
                if piece is not None:
                    yield current, piece, new
                piece, current, new = Piece(), conv, True
            for copy in range(times):
                if piece.full():
                    yield current, piece, new
                    piece, new = Piece(), False
                piece.add(turn, role, text, DUPLICATE if copy and fault != BLANK else fault)
    if piece is not None:
        yield current, piece, new


def _cut(turns: bool):
    """Finish the conversations that lie whole in a partition, cut the others to pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 40
        writer = _Writer()
        held = None
        count = 0

        def out(conv, piece: Piece, whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal count
            count += 1
            seq = base + count
            if whole:
                report = Repair().take(piece, AT_END, True, turns)
                yield from writer.add({"conv": conv, "step": DONE, "seq": seq, **report})
                return
            matrix = _matrix(bytes(piece.kinds))
            yield from writer.add({"conv": conv, "step": PRICED, "seq": seq, "matrix": matrix})
            yield from writer.add({"conv": conv, "step": WAITING, "seq": seq, **_packed(piece)})

        # The first and the last conversation of a partition may go on in another.
        for conv, piece, new in _conversations(writer.typed(batches)):
            if held is not None:
                yield from out(held[0], held[1], held[2] and new)
            held = conv, piece, new and held is not None
        if held is not None:
            yield from out(held[0], held[1], False)
        yield from writer.rest()

    return cut


def _matrix(kinds: bytes) -> list[int]:
    """For each node behind the piece, the prices before it if the path must end there."""
    found = []
    for end in NODES:
        found += prices_of(kinds, tuple(0 if n == end else FAR for n in NODES))[0]
    return found


def _before(matrix: list[int], behind: tuple[int, ...]) -> tuple[int, ...]:
    """Prices before a piece from those behind it, relative to the least one."""
    n = len(NODES)
    found = [min(matrix[end * n + node] + behind[end] for end in NODES) for node in NODES]
    return tuple(p - min(found) for p in found)


def _packed(piece: Piece) -> dict:
    return {
        "kinds": bytes(piece.kinds),
        "roles": piece.roles,
        "texts": piece.texts,
        "first_initial": piece.first[0],
        "first_turn": piece.first[1],
        "last_initial": piece.last[0],
        "last_turn": piece.last[1],
        "blank": piece.counts[BLANK],
        "duplicate": piece.counts[DUPLICATE],
        "truncated": piece.counts[TRUNCATED],
        "illegal": piece.illegal,
        "gaps": piece.gaps,
    }


def _unpacked(row: dict) -> Piece:
    return Piece(
        kinds=bytearray(row["kinds"]),
        roles=row["roles"],
        texts=row["texts"],
        counts=[0, row["blank"], row["duplicate"], row["truncated"]],
        illegal=row["illegal"],
        gaps=row["gaps"],
        first=(row["first_initial"], row["first_turn"]),
        last=(row["last_initial"], row["last_turn"]),
    )


def _joined(turns: bool):
    """Finish conversations in pieces: first their prices, from the last piece on, then the
    pieces in order. Of a conversation only four numbers per piece are held."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer()
        current, behind, repair = None, None, None
        for batch in writer.typed(batches):
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if behind is None or row["conv"] != current:
                    current, behind, repair = row["conv"], [AT_END], None
                if row["step"] == PRICED:
                    behind.append(_before(row["matrix"], behind[-1]))
                    continue
                if repair is None:
                    repair = Repair()
                    behind.pop()
                end = behind.pop()
                report = repair.take(_unpacked(row), end, not behind, turns)
                kept = {"conv": row["conv"], "step": DONE, "seq": row["seq"]}
                yield from writer.add({**kept, **report})
        yield from writer.rest()

    return joined


class _Writer:
    """Rows to Arrow batches of bounded size, with the conversation's own type."""

    def __init__(self) -> None:
        self._conv = pa.null()
        self._rows: list[dict] = []
        self._chars = 0

    def typed(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            self._conv = batch.schema.field("conv").type
            yield batch

    def add(self, row: dict) -> Iterator[pa.RecordBatch]:
        self._rows.append(row)
        self._chars += 256 + sum(map(len, row.get("texts") or ())) + len(row.get("edits") or "")
        if self._chars >= PIECE_CHARS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            kinds = {"conv": self._conv} | {k: _ARROW[t] for k, t in (_OPEN | _REPORT).items()}
            yield pa.RecordBatch.from_pylist(self._rows, schema=pa.schema(kinds.items()))
        self._rows, self._chars = [], 0


def conversation_reports(pieces: DataFrame) -> DataFrame:
    """One row per conversation: sums, ``audit`` (all edits in order) and ``sha256``.

    No text moves. The audit of a conversation is a text of its own, as long as its edits.
    """
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    listed = F.sort_array(F.collect_list(F.struct("seq", "edits")))
    return pieces.groupBy("conv").agg(
        *[F.sum(name).alias(name) for name in sums],
        F.array_join(F.transform(listed, lambda x: x["edits"]), "").alias("audit"),
        F.max("sha256").alias("sha256"),
    )


# One CRC step of 8 bits, for texts of ASCII characters.
_CRC = """
  xor(list_reduce(list_prepend(4294967295, list_transform(string_split(place, ''),
        lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295)
"""

REPAIR_ORACLE = rf"""
WITH RECURSIVE placed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
  FROM conversations
),
drawn AS (SELECT *, {_CRC} % 20 AS draw FROM placed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                   ELSE text END AS text,
         unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE draw <> 0
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
            AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
  FROM damaged
),
faulty AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN bare = '' THEN 'blank'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1
         THEN 'duplicate'
         WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         coalesce(lag(left(role, 1)) OVER w || left(role, 1) NOT IN ('su', 'ua', 'au'), false)
         AS illegal
  FROM numbered WINDOW w AS (PARTITION BY conv_id ORDER BY i)
),
follows(node, initial, next) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
),
inserts(node, next, letters, cost, lines) AS (
  VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
         (0, 2, 'I', 3, ['user:']), (1, 2, 'I', 3, ['user:']),
         (2, 3, 'I', 3, ['assistant:']), (3, 2, 'I', 3, ['user:']),
         (0, 3, 'II', 6, ['user:', 'assistant:']), (1, 3, 'II', 6, ['user:', 'assistant:']),
         (2, 2, 'II', 6, ['assistant:', 'user:']), (3, 3, 'II', 6, ['user:', 'assistant:'])
),
edits AS (
  SELECT f.conv_id, f.i, n.node, n.node AS next, 'D' AS letter, 4 AS cost,
         []::VARCHAR[] AS lines
  FROM faulty f, (VALUES (0), (1), (2), (3)) n(node)
  UNION ALL
  SELECT conv_id, i, node, next, 'K', CASE WHEN fault IS NULL THEN 0 ELSE 3 END,
         [role || ':' || text]
  FROM faulty JOIN follows USING (initial) WHERE fault IS NULL OR fault = 'truncated'
  UNION ALL
  SELECT conv_id, i, node, next, 'R', CASE WHEN fault IS NULL THEN 3 ELSE 6 END,
         [CASE o.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
  FROM faulty f, follows o
  WHERE (fault IS NULL OR fault = 'truncated') AND o.initial <> 's'
),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS node, 0 AS cost, '' AS audit,
         []::VARCHAR[] AS lines
  FROM conversations
  UNION ALL
  SELECT b.conv_id, e.i, e.next, b.cost + s.cost + e.cost, b.audit || s.letters || e.letter,
         b.lines || s.lines::VARCHAR[] || e.lines
  FROM best b JOIN inserts s ON s.node = b.node
       JOIN edits e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i + 1
                   AND e.node = s.next
  QUALIFY row_number() OVER (PARTITION BY b.conv_id, e.next
            ORDER BY b.cost + s.cost + e.cost, b.audit || s.letters || e.letter) = 1
),
counted AS (
  SELECT c.conv_id, count(f.i) AS n, coalesce(max(f.turn) - min(f.turn) + 1
           - count(DISTINCT f.turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (illegal) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c
       LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
  GROUP BY c.conv_id
)
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal,
       (b.cost + s.cost)::BIGINT AS cost, b.audit || s.letters AS audit,
       sha256(array_to_string(b.lines || s.lines::VARCHAR[], chr(10))) AS repaired_sha256
FROM counted c
     JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n
     JOIN inserts s ON s.node = b.node AND s.next IN (0, 3)
QUALIFY row_number() OVER (PARTITION BY c.conv_id
          ORDER BY b.cost + s.cost, b.audit || s.letters) = 1
"""
