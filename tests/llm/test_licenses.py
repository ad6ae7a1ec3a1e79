import random
import re
from collections import defaultdict

import pytest

from panelspan.llm.licenses import TEMPLATES, find_licenses
from tests.llm.messy import docs, empty, messy, prose
from tests.llm.test_winnowing import words


def shingles(w):
    return {i: " ".join(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(text, templates, least=0.8):
    """The best containment, number of windows and first window of each license."""
    found = {}
    at = shingles(words(text))
    for name, body in templates.items():
        w = words(body)
        group = 8
        while group < len(w):
            group *= 2
        own, held = set(shingles(w).values()), defaultdict(set)
        for place, shingle in at.items():
            for k in range(place // (group // 2) + 1):
                if place + 5 <= k * group // 2 + 1.5 * group and shingle in own:
                    held[k].add(shingle)
        good = {k: len(x) / len(own) for k, x in held.items() if len(x) / len(own) >= least}
        if good:
            found[name] = (max(good.values()), len(good), min(good) * group // 2)
    return found


def test_windows_hold_what_brute_force_says(spark):
    random_ = random.Random(1)
    bodies = list(TEMPLATES.values())
    texts = []
    for i in range(60):
        body = random_.choice(bodies).split()
        for _ in range(random_.randrange(0, 4)):
            body[random_.randrange(len(body))] = "changed"
        texts.append(f"{prose(i, i)} {' '.join(body)} {prose(i % 7, i + 100)}".upper())
    texts.append(" ".join(bodies))
    texts.append(" ".join(x for _ in range(30) for x in bodies))
    rows = find_licenses(docs(spark, texts)).collect()
    found = defaultdict(dict)
    for r in rows:
        found[r["key"]][r["license"]] = (r["containment"], r["windows"], r["word"])
    assert found[len(texts) - 2].keys() == TEMPLATES.keys()
    for i, text in enumerate(texts):
        assert found[i] == brute(text, TEMPLATES), i


def test_templates_are_parameters(spark):
    body = "no part of this may ever be used by anyone at all"
    found = find_licenses(docs(spark, [f"x {body} y", "z"]), {"None": body}).collect()
    assert [(r["key"], r["license"], r["containment"]) for r in found] == [(0, "None", 1.0)]
    with pytest.raises(ValueError):
        find_licenses(docs(spark, ["a"]), {"Short": "too short"})


def test_messy_and_empty_tables(spark):
    assert find_licenses(empty(spark)).collect() == []
    assert find_licenses(messy(spark)).collect() == []
    copy = "the same words stand here in every copy of this one"
    found = find_licenses(messy(spark), {"Copy": copy}).collect()
    assert sorted(r["key"] for r in found) == [5, 6, 9]


def test_words_are_those_of_the_operator():
    assert re.fullmatch("mit", words("MIT!")[0])
