"""Fill-in-the-middle: texts cut in three, their parts reordered behind sentinels.

Both ways work on one bytearray for each text. The cuts are found by a scan, a sentinel is
put before each part, and parts change places by rotation: two neighbouring blocks are
exchanged by reversing each of them and then both together. The way back finds the
sentinels, rotates the blocks home and takes the sentinels out.

The cuts depend on the seed and the row's key alone, not on partitions or retries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspan.llm.frames import SMALL_BATCH, pack, unpack

# What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

SEED = 1
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SWAP = 1 << 16

_MADE = "form string, n long, prefix_chars long, middle_chars long, output binary"


def reverse(data: np.ndarray, start: int, end: int) -> None:
    """Reverse bytes in place, by swaps from both ends."""
    while end - start > 1:
        size = min(SWAP, (end - start) // 2)
        head = data[start : start + size].copy()
        data[start : start + size] = data[end - size : end][::-1]
        data[end - size : end] = head[::-1]
        start, end = start + size, end - size


def rotate(data: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the neighbouring blocks start..middle and middle..end in place."""
    view = np.frombuffer(data, np.uint8)
    reverse(view, start, middle)
    reverse(view, middle, end)
    reverse(view, start, end)


def token_starts(text: bytes) -> np.ndarray:
    """Where tokens start: runs of ASCII letters, and every other code point."""
    data = np.frombuffer(text, np.uint8)
    low = data | 0x20
    letter = (low >= ord("a")) & (low <= ord("z"))
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def code_points(text: bytes, start: int, end: int) -> int:
    data = np.frombuffer(text, np.uint8)[start:end]
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def make(text: bytes, draws: tuple[int, int, int, int], plain: int, spm: int) -> tuple:
    """``form``, tokens, code points of prefix and middle, and the output, of one text."""
    starts = token_starts(text)
    n = len(starts)
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or draws[2] % 100 >= 100 - plain:
        return PLAIN, n, None, None, text
    first, last = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    one, two = (int(starts[x]) if x < n else len(text) for x in (first, last))
    data = bytearray(text)
    data[two:two] = SUFFIX
    data[one:one] = MIDDLE
    data[0:0] = PREFIX
    middle = one + len(PREFIX)
    suffix = two + len(PREFIX) + len(MIDDLE)
    form = SPM if draws[3] % 100 < spm else PSM
    rotate(data, 0 if form == SPM else middle, suffix, len(data))
    return form, n, code_points(text, 0, one), code_points(text, one, two), bytes(data)


def unmake(output: bytes, form: str) -> bytes:
    """The text that an output of ``make`` came from."""
    if form == PLAIN:
        return output
    data = bytearray(output)
    if form == SPM:
        rotate(data, 0, data.index(PREFIX), len(data))
    else:
        rotate(data, data.index(SUFFIX), data.index(MIDDLE), len(data))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = data.index(mark)
        del data[at : at + len(mark)]
    return bytes(data)


def _draws(seed: int) -> list[Column]:
    """Four numbers hashed from the seed and the key."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    digest = F.sha2(named.cast("binary"), 256)
    return [
        F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)
    ]


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    seed: int = SEED,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """The rows with ``form``, ``n``, ``prefix_chars``, ``middle_chars`` and ``output``.

    A text has ``n`` tokens (runs of ASCII letters, and every other code point); the cuts
    lie between tokens, drawn from the seed and the key. ``plain_percent`` of the texts stay
    as they are, and so do empty ones and those that hold a sentinel; ``spm_percent`` of the
    others start with the suffix, the rest with the prefix. Parts may be empty.

    A null text is an empty one. A null key is drawn as an empty one; rows that share a key
    share the draw, each on its own text. Lengths are in code points, null where the form is
    plain. Input columns of the added names are replaced.
    """

    def made(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *draws in batches:
            found = [
                make(body or b"", chance, plain_percent, spm_percent)
                for body, chance in _rows(texts, draws)
            ]
            forms, n, before, middle, output = map(list, zip(*found)) if found else [[]] * 5
            yield pa.StructArray.from_arrays(
                [
                    pa.array(forms, pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(before, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()),
                ],
                names=["form", "n", "prefix_chars", "middle_chars", "output"],
            )

    function = F.arrow_udf(made, _MADE)
    found = pack(docs, text=text, key=key).withColumn(
        "made", function(F.col("text").cast("binary"), *_draws(seed))
    )
    added = {name: F.col(f"made.{name}") for name in ("form", "n", "prefix_chars", "middle_chars")}
    return unpack(found, docs.columns, **added, output=F.expr("CAST(made.output AS STRING)"))


def _rows(texts: pa.Array, draws: list[pa.Array]) -> Iterator[tuple]:
    """Rows of a batch, of which few are copied out at once."""
    for at in range(0, len(texts), SMALL_BATCH):
        chances = zip(*[x.slice(at, SMALL_BATCH).to_pylist() for x in draws])
        yield from zip(texts.slice(at, SMALL_BATCH).to_pylist(), chances)


def restore_text(output: str = "output", form: str = "form") -> Column:
    """The text from the output and the form alone; null where either is null."""

    def restored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            found: list[bytes | None] = []
            for body, (shape,) in _rows(outputs, [forms]):
                found.append(None if body is None or shape is None else unmake(body, shape))
            yield pa.array(found, pa.binary())

    function = F.arrow_udf(restored, "binary")
    return function(F.col(output).cast("binary"), F.col(form)).cast("string")


INFILL_ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t
  FROM documents
),
c AS (
  SELECT doc_id, text, t, len(t) AS n,
         ('0x' || substr(h, 1, 8))::BIGINT % (len(t) + 1) AS h1,
         ('0x' || substr(h, 9, 8))::BIGINT % (len(t) + 1) AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3,
         ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4
  FROM d
),
p AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(t[1:least(h1, h2)], '') AS a,
         array_to_string(t[least(h1, h2) + 1:greatest(h1, h2)], '') AS b,
         array_to_string(t[greatest(h1, h2) + 1:], '') AS c
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(a) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
                        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
