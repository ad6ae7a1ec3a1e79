import random

import numpy as np
from pyspark.sql import functions as F

from panelspan.llm import quality
from panelspan.llm.frames import table
from panelspan.llm.quality import FEATURES, fit, keep_good, passages, score_quality, train
from tests.llm.messy import LONG, as_rows, docs, empty, messy

SF = "/root/testdata/sf0.01"


def labelled(spark, n=240, seed=1):
    random_ = random.Random(seed)
    texts, marks = [], []
    for i in range(n):
        body = [f"word{random_.randrange(300)}" for _ in range(random_.randrange(5, 300))]
        if i % 3 == 0:
            at = random_.randrange(len(body))
            body[at : at + 60] = ["$$ ##"] * 60
        texts.append(" ".join(body))
        marks.append((i, int(i % 3 != 0), "x"))
    return docs(spark, texts), spark.createDataFrame(
        marks, "doc_id long, quality int, text string"
    )


def test_gradients_are_those_of_the_loss():
    random_ = np.random.default_rng(0)
    w = {
        "W": random_.normal(size=(FEATURES, 5)) / 9, "Wb": random_.normal(size=5),
        "V": random_.normal(size=(5, 4)), "Vb": random_.normal(size=4),
        "U": random_.normal(size=(5, 4)), "Ub": random_.normal(size=4),
        "w": random_.normal(size=4), "c": random_.normal(size=5), "cb": np.array([0.3]),
    }
    rows, starts = random_.normal(size=(9, FEATURES)), np.array([0, 2, 3])
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        p = quality._forward(w, rows, starts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = quality._gradients(w, rows, starts, y)
    for name, g in found.items():
        flat = w[name].reshape(-1)
        for at in range(0, len(flat), max(1, len(flat) // 5)):
            old, step = flat[at], 1e-6
            flat[at] = old + step
            high = loss()
            flat[at] = old - step
            low = loss()
            flat[at] = old
            assert np.isclose((high - low) / (2 * step), g.reshape(-1)[at], atol=1e-6), name


def test_held_out_documents_are_told_apart(spark):
    source, labels = labelled(spark)
    model = train(source, labels)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = score_quality(source, model).join(labels.drop("text"), "doc_id").filter(held)
    rows = found.collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_documents_of_the_given_tables(spark):
    source, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = score_quality(source, train(source, labels)).join(labels, "doc_id").filter(held)
    rows = found.collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.97


def test_held_out_labels_are_not_read(spark):
    source, labels = labelled(spark)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = score_quality(source, train(source, labels))
    two = score_quality(source, train(source.repartition(5), turned))
    assert as_rows(one, "doc_id", "score") == as_rows(two, "doc_id", "score")


def test_messy_and_empty_tables(spark):
    source, labels = labelled(spark, 60)
    odd = labels.union(spark.createDataFrame(
        [(None, 1, "x"), (3, None, "x"), (5, 7, "x"), (4, 0, "x"), (4, 1, "x"), (999, 1, "x")],
        labels.schema,
    ))
    model = train(source, odd)
    found = score_quality(messy(spark), model)
    rows = found.collect()
    assert len(rows) == 13 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["text"] in (None, "", " \n\t ")}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (5, 6, 9)}) == 1
    assert score_quality(empty(spark), model).collect() == []
    assert train(empty(spark), odd) is None and train(source, odd.limit(0)) is None
    assert {r["score"] for r in score_quality(messy(spark), None).collect()} == {0.5}
    assert keep_good(messy(spark), odd.limit(0)).columns == messy(spark).columns


def test_whole_texts_are_described(monkeypatch):
    assert passages(b"").shape == (1, FEATURES) and not passages(b" \n").any()
    words = len(LONG.split())
    assert len(passages(LONG.encode())) == -(-words // 64)
    monkeypatch.setattr(quality, "PIECE", 1000)
    assert len(passages(LONG.encode())) > -(-words // 64)
    assert passages("ä".encode() * 5000).shape == (1, FEATURES)


def test_one_odd_passage_among_many_gets_the_attention():
    random_ = np.random.default_rng(5)
    bags, labels = [], []
    for i in range(700):
        bag = random_.normal(size=(random_.integers(3, 12), FEATURES)) * 0.1
        if i % 2:
            bag[random_.integers(len(bag)), 7] += 3
        bags.append(bag)
        labels.append(i % 2)
    model = fit(bags[:500], np.array(labels[:500], float))
    scores = model.scores(bags[500:])
    assert np.mean((scores >= 0.5) == np.array(labels[500:])) > 0.95


def plain_features(text):
    """The features of each passage of 64 words, byte by byte and word by word."""
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
             " \t\r\x0b\x0c", "\n", ".,;:", "!?'\"()-"]

    def kind(byte):
        if byte >= 128:
            return 8
        return next((i for i, members in enumerate(kinds) if chr(byte) in members), 7)

    space = b" \t\n\r\x0b\x0c"
    words, word_of, at = [], [], -1
    for i, byte in enumerate(text):
        if byte not in space and (i == 0 or text[i - 1] in space):
            words.append(bytearray())
        if byte not in space:
            words[-1].append(byte)
        word_of.append(max(0, len(words) - 1))
    hashes = [int(quality.piece_hashes(np.frombuffer(bytes(w), np.uint8))[0]) for w in words]
    n = -(-len(words) // 64)
    found = np.zeros((n, FEATURES))
    for p in range(n):
        own = hashes[64 * p : 64 * p + 64]
        pairs = np.zeros(81)
        for i in range(1, len(text)):
            if word_of[i] // 64 == p:
                pairs[kind(text[i - 1]) * 9 + kind(text[i])] += 1
        bags = np.zeros(64)
        for h in own:
            bags[h >> 58] += 1
        again = sum(h in own[:i] for i, h in enumerate(own))
        before = sum(hashes.index(h) != 64 * p + i for i, h in enumerate(own))
        threes = [tuple(hashes[i : i + 3]) for i in range(len(hashes) - 2)]
        runs = sum(threes.index(threes[i]) != i for i in range(64 * p, min(64 * p + 64, len(threes))))
        inside = sum(b not in space and word_of[i] // 64 == p for i, b in enumerate(text))
        found[p] = [*(pairs / max(1, pairs.sum()) * 8), *(bags / len(own) * 4),
                    again / len(own), before / len(own), runs / len(own),
                    inside / len(own) / 8, np.log1p(len(own)) / 4, np.log1p(len(words)) / 8]
    return found


def plain_score(model, bag):
    """Gated attention in loops over passages and units."""
    w, hidden, logits = model.weights, [], []
    for row in bag:
        x = [(v - m) / s for v, m, s in zip(row, model.mean, model.scale)]
        h = [np.tanh(sum(a * b for a, b in zip(x, w["W"][:, j])) + w["Wb"][j])
             for j in range(quality.HIDDEN)]
        gate = 0.0
        for k in range(quality.ATTENTION):
            v = np.tanh(sum(a * b for a, b in zip(h, w["V"][:, k])) + w["Vb"][k])
            u = 1 / (1 + np.exp(-(sum(a * b for a, b in zip(h, w["U"][:, k])) + w["Ub"][k])))
            gate += w["w"][k] * v * u
        hidden.append(h)
        logits.append(gate)
    weights = np.exp(np.array(logits) - max(logits))
    weights /= weights.sum()
    mean = [sum(a * h[j] for a, h in zip(weights, hidden)) for j in range(quality.HIDDEN)]
    return 1 / (1 + np.exp(-(sum(a * b for a, b in zip(mean, w["c"])) + w["cb"][0])))


def test_scores_match_a_plain_computation(spark):
    source, labels = labelled(spark, 90)
    model = train(source, labels)
    texts = [r["text"] for r in source.collect()][:12] + ["One. Two!", "äö 😀 ß\n\nx", "a a a a a a"]
    found = {r["doc_id"]: r["score"] for r in score_quality(docs(spark, texts), model).collect()}
    for key, text in enumerate(texts):
        features = plain_features(text.encode())
        assert np.allclose(passages(text.encode()), features, atol=1e-5)
        assert abs(found[key] - plain_score(model, passages(text.encode()).astype(float))) < 1e-6


def test_the_sample_is_bounded_and_holds_whole_texts(spark, monkeypatch):
    """What reaches the driver: few texts where ids and texts repeat, all passages of each."""
    seen = []

    def kept(bags, labels, seed=0):
        seen.append((bags, labels))
        return fit(bags, labels, seed)

    monkeypatch.setattr(quality, "fit", kept)
    texts = [" ".join(f"t{i}w{j}" for j in range(70)) for i in range(400)]
    rows = [(1, t, "x") for t in texts] + [(1, texts[0], "x")] * 600
    source = spark.createDataFrame(rows, "doc_id long, text string, other string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    train(source, labels, fit_docs=5)
    assert len(seen[-1][0]) == 5
    train(source, labels)
    assert len(seen[-1][0]) == 400
    mean = sum(map(len, texts)) / len(texts)
    train(source, labels, fit_bytes=int(9.5 * mean))
    assert 9 <= len(seen[-1][0]) <= 11
    # A long text is used with all its passages, or not at all.
    long = spark.createDataFrame([(1, LONG, "x")], source.schema)
    train(long, labels)
    (bag,) = seen[-1][0]
    assert len(bag) == len(passages(LONG.encode())) > 900
    assert train(long, labels, fit_bytes=1000) is None


def test_keys_of_any_type(spark):
    source, labels = labelled(spark, 120)
    named = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    one = score_quality(
        source, train(source.withColumn("doc_id", named), labels.withColumn("doc_id", named))
    )
    assert {0, 1} == {r["predicted"] for r in one.collect()}
