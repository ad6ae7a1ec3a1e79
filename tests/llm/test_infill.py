"""Fill-in-the-middle against a plain reading of its contract, and exact round trips."""

import hashlib
import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from panelspan.llm.infill import fill_in_middle, make, restore_text, reverse, rotate, unmake
from tests.llm.messy import LONG, ROWS, as_rows, docs, empty, messy


def brute(key, text, seed=1, plain=10, spm=20):
    """(form, n, code points of prefix and middle, output), by joining lists of tokens."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted(x % (len(tokens) + 1) for x in h[:2])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 100 - plain:
        return "plain", len(tokens), None, None, text
    a, b, c = ("".join(tokens[i:j]) for i, j in ((0, low), (low, high), (high, None)))
    if h[3] % 100 < spm:
        return "spm", len(tokens), len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return "psm", len(tokens), len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


SHAPE = ("form", "n", "prefix_chars", "middle_chars", "output")
SPECIAL = [
    "", " ", "x", "<P>", "a<S>b", "<M", "<<P", "P>", "<", "S><M", "äöü 😀x", "\n\n", "a1b2\r\n",
    "\x00", "é" * 50, "word " * 300,
]


@given(st.binary(max_size=60), st.integers(0, 60), st.integers(0, 60), st.integers(0, 60))
def test_a_rotation_exchanges_neighbouring_blocks(data, x, y, z):
    a, b, c = sorted(min(v, len(data)) for v in (x, y, z))
    changed = bytearray(data)
    rotate(changed, a, b, c)
    assert bytes(changed) == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_blocks_longer_than_one_swap_are_reversed(monkeypatch):
    import numpy as np

    monkeypatch.setattr("panelspan.llm.infill.SWAP", 3)
    for n in range(20):
        data = np.arange(n, dtype=np.uint8)
        reverse(data, 0, n)
        assert data.tolist() == list(range(n))[::-1]


@given(st.text(alphabet="ab1 <PSM>\né😀", max_size=30), st.integers(0, 10**6))
def test_every_text_comes_back(text, key):
    body = text.encode()
    expected = brute(key, text)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    draws = tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    form, n, before, middle, output = make(body, draws, 10, 20)
    assert (form, n, before, middle, output.decode()) == expected
    assert unmake(output, form) == body


def test_all_documents_match_brute_force(spark):
    random_ = random.Random(5)
    texts = SPECIAL + [
        "".join(random_.choice("ab <>PSM é😀\n.") for _ in range(random_.randrange(60)))
        for _ in range(300)
    ]
    made = fill_in_middle(docs(spark, texts)).withColumn("back", restore_text())
    found = {r["doc_id"]: r for r in made.collect()}
    assert {r["form"] for r in found.values()} == {"plain", "psm", "spm"}
    for key, text in enumerate(texts):
        assert tuple(found[key][x] for x in SHAPE) == brute(key, text)
        assert found[key]["back"] == text


@pytest.mark.parametrize("seed, plain, spm", [(7, 0, 0), (8, 0, 100), (9, 100, 20)])
def test_parameters(spark, seed, plain, spm):
    texts = [f"some words {i} of a text" for i in range(40)]
    made = fill_in_middle(
        docs(spark, texts), seed=seed, plain_percent=plain, spm_percent=spm
    ).collect()
    for r in made:
        assert tuple(r[x] for x in SHAPE) == brute(r["doc_id"], r["text"], seed, plain, spm)


def test_messy_rows_and_empty_tables(spark):
    source = messy(spark).withColumnRenamed("name", "Output").withColumnRenamed("key", "TEXT2")
    made = fill_in_middle(source)
    # A column of an added name is replaced, whatever its case.
    assert "Output" not in made.columns and made.columns[-5:] == [
        "form", "n", "prefix_chars", "middle_chars", "output",
    ]
    found = as_rows(made.withColumn("back", restore_text()), "doc_id", *SHAPE, "back")
    expected = [(r[0], *brute(r[0], r[1]), r[1] or "") for r in ROWS]
    names = ("doc_id", *SHAPE, "back")
    assert found == sorted(
        "Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, row)) + ")" for row in expected
    )
    assert LONG in {r[1] for r in ROWS}
    assert fill_in_middle(empty(spark)).count() == 0
