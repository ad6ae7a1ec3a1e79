"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

A candidate is a run of one character class. A window slides over it; the counts of
characters in the window, and the sum of n * log2(n) over them, change by the character
that leaves and the one that enters. Where the entropy of a window reaches the class's
threshold, the stretch from the first such window to the last is a span, unless the
candidate is on the allow-list.

Everything is one pass over each row: no row moves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspan.llm.frames import pack, unpack
from panelspan.llm.wording import running_totals


@dataclass(frozen=True)
class Pattern:
    """A fixed kind of secret: matches whose group is shorter than ``least`` are dropped."""

    kind: str
    regex: str
    group: int
    least: int


@dataclass(frozen=True)
class CharacterClass:
    """Runs of one class, and the entropy in bits at which a window of them is a secret.

    Only runs that hold one of each of the sets in ``needs`` are looked at.
    """

    kind: str
    characters: str
    window: int
    threshold: float
    needs: tuple[str, ...] = ()


# The base patterns, in the order in which kinds are listed.
PATTERNS = (
    Pattern(
        "assign",
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
        r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        r"[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    Pattern("access", "AKIA[A-Z0-9]+", 0, 16),
    Pattern("hex", "(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
)

#: Thresholds by the part of random strings that stay below them, in a simulation of 4,000
#: strings of 20 characters: hexadecimal 3 %; letters of one case with digits 3 %; letters of
#: both cases with digits 0.2 %, and 8 % of those of 16, most of them without a digit. Words have as much entropy, but no
#: digits; with marks between them they may have both, so that class asks for more (of 20
#: random base64 characters it misses 17 %, of 32 2 %).
CLASSES = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", 20, 3.0, ("0-9", "A-Fa-f")),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 20, 3.9),
    CharacterClass("entropy_alnum", "A-Za-z0-9", 20, 3.5, ("0-9", "A-Za-z")),
    CharacterClass("entropy_short", "A-Za-z0-9", 16, 3.4, ("0-9", "A-Z", "a-z")),
)

# Whole candidates that are not secrets. Groups repeat possessively, as Java's
# regex calls itself once per repetition of any other group.
ALLOWED = (
    r"[0-9]+",  # long numbers
    r"[a-z]++(?:[-_/+=][a-z]++)++",  # words joined by marks, as in addresses
    r"[A-Z]?[a-z]++(?:[A-Z][a-z]++)++",  # names in camel case
    r"[A-Z]?[a-z]++(?:[A-Z][a-z]++)*+[0-9]{1,4}",  # words or names with a number behind
    r"[A-Z]++(?:_[A-Z]++)++",  # names of constants
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # random identifiers
    r"[A-Za-z]*abcdefghijklmnopqrstuvwxyz[A-Za-z0-9+/_=-]*",  # alphabets
    r"[-_=+/]+",  # rules between sections
)

SPAN = "STRUCT<start: BIGINT, end: BIGINT, rank: INT, kind: STRING>"
NO_SPANS = f"CAST(array() AS ARRAY<{SPAN}>)"


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    patterns: tuple[Pattern, ...] = PATTERNS,
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """The rows with ``spans``: array of (start, end, rank, kind), sorted in this order.

    Positions count code points, ends are exclusive. ``rank`` is the kind's place among
    ``patterns`` and ``classes``; the spans of the patterns do not depend on the classes.
    Spans of different kinds may overlap. A null or empty text has no spans. An input
    column named ``spans`` is replaced.
    """
    rows = pack(docs, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    found = []
    for rank, pattern in enumerate(patterns):
        rows = _with_matches(rows, f"p{rank}", pattern.regex, pattern.group)
        found.append(
            f"transform(filter(p{rank}, x -> length(x.part) >= {pattern.least}),"
            f" x -> struct(x.at AS start, x.at + length(x.whole) AS end,"
            f" {rank} AS rank, '{pattern.kind}' AS kind))"
        )
    permitted = "^(" + "|".join(allowed) + ")$" if allowed else "^$"
    for i, kind in enumerate(classes):
        rank = len(patterns) + i
        run = f"(?<![{kind.characters}])[{kind.characters}]{{{kind.window},}}"
        rows = _with_matches(rows, f"c{i}", run, 0).withColumn(
            f"e{i}", F.expr(_entropy_spans(f"c{i}", kind, permitted))
        )
        found.append(
            f"transform(e{i}, x -> struct(x.start AS start, x.end AS end,"
            f" {rank} AS rank, '{kind.kind}' AS kind))"
        )
    spans = F.expr(f"array_sort(concat({', '.join(found)}))").cast(f"ARRAY<{SPAN}>")
    return unpack(rows, docs.columns, spans=spans)


def _quoted(regex: str) -> str:
    return "r'" + regex + "'"


def _with_matches(rows: DataFrame, name: str, regex: str, group: int) -> DataFrame:
    """Leftmost non-overlapping matches as structs (at, whole, part).

    Places are sums of the lengths of the matches and of the text between them. Rows
    without a match cost one search.
    """
    pattern = _quoted(regex)
    found = f"text RLIKE {pattern}"
    none = "CAST(array() AS ARRAY<STRING>)"
    whole, part, gaps = f"{name}_whole", f"{name}_part", f"{name}_gaps"
    columns = {
        whole: f"regexp_extract_all(text, {pattern}, 0)",
        part: f"regexp_extract_all(text, {pattern}, {group})",
        gaps: f"split(text, {pattern}, -1)",
    }
    rows = rows.withColumn(f"{name}_found", F.expr(found)).withColumns(
        {
            column: F.expr(f"IF({name}_found, {value}, {none})")
            for column, value in columns.items()
            if group or column != part
        }
    )
    parts = part if group else whole
    lengths = f"zip_with({whole}, {gaps}, (x, y) -> CAST(length(x) + length(y) AS BIGINT))"
    return (
        rows.withColumn(f"{name}_lengths", F.expr(f"slice({lengths}, 1, size({whole}))"))
        .withColumn(f"{name}_before", F.expr(running_totals(f"{name}_lengths")))
        .withColumn(
            name,
            F.expr(
                f"transform({whole}, (x, i) -> struct({name}_before[i] + length({gaps}[i]) AS at,"
                f" x AS whole, {parts}[i] AS part))"
            ),
        )
    )


def _change(sign: int, count: str) -> str:
    """What n * log2(n) changes by when a count goes up or down by one, as SQL."""
    term = "IF({0} > 1, {0} * log2({0}), 0D)"
    return f"({term.format(f'({count} + {sign})')} - {term.format(count)})"


def _entropy_spans(candidates: str, kind: CharacterClass, permitted: str) -> str:
    """Spans (start, end) of the candidates that hold a window of enough entropy, as SQL.

    The state is the map of counts in the window, the sum of n * log2(n) over them, and the
    first and last place where a window reached the threshold.
    """
    size = kind.window
    most = f"{size} * (log2({size}D) - {kind.threshold}D) + 1e-9D"
    left = f"IF(i >= {size}, chars[i - {size}], null)"
    out = (
        f"transform(array(struct(s, {left} AS gone)), g -> IF(g.gone IS NULL, g.s, struct("
        f"map_concat(map_filter(g.s.counts, (c, n) -> c <> g.gone),"
        f" IF(g.s.counts[g.gone] > 1, map(g.gone, g.s.counts[g.gone] - 1),"
        f" CAST(map() AS MAP<STRING, INT>))) AS counts,"
        f" g.s.total + {_change(-1, 'g.s.counts[g.gone]')} AS total,"
        f" g.s.first AS first, g.s.last AS last)))[0]"
    )
    into = (
        "transform(array(struct(o, chars[i] AS come, coalesce(o.counts[chars[i]], 0) AS n)),"
        " g -> struct(map_concat(map_filter(g.o.counts, (c, n) -> c <> g.come),"
        " map(g.come, g.n + 1)) AS counts,"
        f" g.o.total + {_change(1, 'g.n')} AS total, g.o.first AS first, g.o.last AS last))[0]"
    )
    reached = f"i >= {size} - 1 AND w.total <= {most}"
    mark = (
        f"struct(w.counts AS counts, w.total AS total,"
        f" IF({reached}, coalesce(w.first, i - {size} + 1), w.first) AS first,"
        f" IF({reached}, i + 1, w.last) AS last)"
    )
    step = (
        f"transform(transform(transform(array({out}), o -> {into}), w -> {mark}), z -> z)[0]"
    )
    start = (
        "struct(CAST(map() AS MAP<STRING, INT>) AS counts, 0D AS total,"
        " CAST(null AS INT) AS first, CAST(null AS INT) AS last)"
    )
    found = (
        f"transform(array(split(x.whole, '')), chars -> aggregate("
        f"sequence(0, size(chars) - 1), {start}, (s, i) -> {step}))[0]"
    )
    needed = "".join(f"x.whole RLIKE '[{members}]' AND " for members in kind.needs)
    return (
        "filter(transform(filter("
        f"{candidates}, x -> {needed}NOT x.whole RLIKE {_quoted(permitted)}),"
        f" x -> transform(array({found}), r -> struct(x.at + r.first AS start,"
        " x.at + r.last AS end))[0]), x -> x.start IS NOT NULL)"
    )


def listed(spans: str, first_ranks: int | None = None) -> Column:
    """Spans as text, ``kind:start:end`` joined by commas; only the first kinds if asked."""
    kept = spans if first_ranks is None else f"filter({spans}, x -> x.rank < {first_ranks})"
    return F.expr(
        f"array_join(transform({kept}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    )


def count_of(spans: str, kind: str) -> Column:
    return F.expr(f"CAST(size(filter({spans}, x -> x.kind = '{kind}')) AS BIGINT)")
