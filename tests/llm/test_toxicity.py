import itertools
import random
import zlib

import numpy as np
import pytest

from sendgate.llm import string_kernel as kernel, toxicity
from sendgate.llm.queries import QUERIES

SYLLABLES = ["the", "an", "on", "re", "ti", "ble", "ou", "st", "nd", "wh", "ea", "in"]
INSULTS = ["blorgo", "krumpf", "zwickel"]


def word(draw):
    return "".join(draw.choices(SYLLABLES, k=draw.randint(1, 4)))


def text(draw, insults=0, length=60):
    words = [word(draw) for _ in range(length)]
    for _ in range(insults):
        words[draw.randrange(length)] = draw.choice(INSULTS) + draw.choice(["", "!", "en", "s,"])
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def model():
    draw = random.Random(3)
    toxic = [text(draw, insults=2) for _ in range(150)]
    clean = [text(draw) for _ in range(300)]
    return toxicity.train(toxic + clean, [True] * 150 + [False] * 300)


def test_held_out_accuracy(model):
    draw = random.Random(4)
    assert (model.score([text(draw, insults=1, length=400) for _ in range(60)]) >= 0.5).mean() > 0.95
    assert (model.score([text(draw, length=400) for _ in range(60)]) < 0.5).mean() > 0.95


@pytest.mark.parametrize(
    "insult",
    ["blorgo", "BLORGO", "b.l.o.r.g.o", "b l o r g o", "bl*orgo", "b1orgo bl0rg0", "bloorgo", "blorgoish"],
)
def test_disguised_insults(model, insult):
    draw = random.Random(5)
    clean = text(draw)
    assert model.score([clean])[0] < 0.5
    assert model.score([f"{clean} {insult} {clean}"])[0] >= 0.5


def test_long_texts_are_read_whole(model, monkeypatch):
    draw = random.Random(6)
    clean = " ".join(text(draw) for _ in range(300))
    plain = model.score([clean, clean + " krumpf " + clean])
    monkeypatch.setattr(kernel, "PIECE", 1_000)
    assert np.allclose(plain, model.score([clean, clean + " krumpf " + clean]))
    assert plain[0] < 0.5 <= plain[1]
    assert model.score(["x" * 50_000])[0] <= 1.0


def kernel_value(a, b):
    """The kernel by its definition."""

    def sets(s):
        found = {}
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i <= 4:
                key = s[i] + s[j] + s[k]
                found.setdefault(key, []).append(kernel.DECAY ** (k - i - 2))
        norm = sum(w * w for ws in found.values() for w in ws) ** 0.5
        return {key: sum(ws) / max(norm, 1.0) for key, ws in found.items()}

    left, right = sets(a), sets(b)
    return sum(w * right.get(key, 0.0) for key, w in left.items())


def test_kernel_by_definition():
    words = ["idiot", "idxiot", "banana", "abc", "abcdefghij", "aaaa"]
    units = kernel.read_units([" ".join(words)])
    sets = kernel.window_sets(units, np.arange(len(words)))
    values = toxicity._kernel(sets, sets)
    expected = [[kernel_value(a, b) for b in words] for a in words]
    assert np.allclose(values, expected)
    weights = np.zeros(kernel.SIZE)
    one = sets.take(np.array([0]))
    np.add.at(weights, one.codes, one.weights)
    assert np.allclose(kernel.window_scores(units, weights), values[:, 0])


def test_units():
    units = kernel.read_units(["i.d i\nA b c def", "", "zz yyy"])
    assert [int(x) for x in units.text_of[units.starts]] == [0, 0, 2]
    spelled = units.letters[units.starts[0] :][:4]
    assert list(spelled) == list(kernel.read_units(["iabc"]).letters[:4]) == [9, 1, 2, 3]


def test_nothing_to_learn_from():
    for texts, toxic in (([], []), (["a b"], [True]), (["abc"], [False]), (["", ""], [True, False])):
        assert toxicity.train(texts, toxic).score(["abc def", None]).tolist() == [0.0, 0.0]


def test_frames(spark, model):
    rows = [(1, "the krumpf on", "a"), (1, None, "b"), (None, "", "c"), (2, "the on", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Score string")
    found = toxicity.score_texts(df, model)
    assert found.columns == ["doc_id", "text", "score", "predicted"]
    got = {row.text: (row.score, row.predicted) for row in found.collect()}
    assert got["the krumpf on"][1] == 1 and got["the on"][1] == 0
    assert got[None] == got[""] and got[""][0] <= got["the on"][0] < 0.5
    assert toxicity.score_texts(df.limit(0), model).count() == 0


def test_sample_is_bounded_and_labels_may_repeat(spark):
    docs = spark.createDataFrame(
        [(i, f"text {i}") for i in range(50)] + [(3, None), (None, "x")], "doc_id long, text string"
    )
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(0, 1), (2, None), (None, 1)], "doc_id long, toxic int"
    )
    sample = toxicity.labelled_sample(docs, labels, toxicity.Settings(toxic=5, clean=7))
    assert sample["toxic"].sum() == 5 and len(sample) == 12
    everything = toxicity.labelled_sample(docs, labels, toxicity.Settings())
    assert len(everything) == 40 and everything["toxic"].sum() == 21


def test_sample_takes_each_text_once(spark):
    rows = [(i, f"text {i % 10}" if i < 400 else f"text {i}") for i in range(420)]
    docs = spark.createDataFrame(rows + [(415, "text 415")] * 300, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 400)) for i in range(420)] + [(3, 1)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, toxicity.Settings())
    assert sorted(sample["text"]) == sorted({text for _, text in rows})
    assert set(sample["text"][sample["toxic"]]) == {"text 3", *(f"text {i}" for i in range(400, 420))}
    few = toxicity.labelled_sample(docs, labels, toxicity.Settings(toxic=5, clean=7))
    assert len(set(few["text"])) == 12 and few["toxic"].sum() == 5


def test_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op7_toxicity"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = {
        r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    }
    assert len(rows) == docs
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(p and y for p, y in held)
    assert hits / sum(y for _, y in held) > 0.7  # some labelled texts hold no insult at all
    assert hits / sum(p for p, _ in held) > 0.75
