"""Substring dedup against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sendgate.llm import substring_dedup as S

DOCS = "doc_id long, text string"


def brute(rows, length):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()) for _, text in rows]
    least = {}
    for (doc, _), words in zip(rows, split):
        for i in range(len(words) - length + 1):
            run = tuple(words[i : i + length])
            if doc is not None:
                least[run] = min(least.get(run, doc), doc)
    found = []
    for (doc, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - length + 1):
            if doc is not None and least[tuple(words[i : i + length])] < doc:
                gone.update(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        found.append((doc, len(words), len(gone), kept))
    return sorted(found, key=str)


def cut(spark, rows, length=13):
    frame = S.drop_repeats(spark.createDataFrame(rows, DOCS), length).collect()
    for r in frame:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(s.end - s.start >= length for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in frame], key=str)


def made_up(seed, n=120, vocabulary=40):
    """Texts of shared passages of all lengths, exact copies, and few different words."""
    draw = random.Random(seed)
    words = [draw.choice("abcdeéß") * draw.randrange(1, 4) + str(i) for i in range(vocabulary)]
    passages = [[draw.choice(words) for _ in range(draw.choice([4, 12, 13, 14, 30, 80]))] for _ in range(12)]
    rows = []
    for doc in range(n):
        parts = []
        for _ in range(draw.randrange(6)):
            parts += draw.choice(passages) if draw.random() < 0.6 else draw.choices(words, k=draw.randrange(20))
        rows.append((doc, draw.choice([" ", "\n", "\t \x0b"]).join(parts)))
    rows += [(n + i, rows[draw.randrange(n)][1]) for i in range(20)]
    rows += [rows[3], (3, rows[5][1]), (None, rows[7][1]), (None, rows[7][1]), (n + 50, None), (n + 51, ""),
             (n + 52, " \n "), (-5, rows[9][1])]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "length"), [(1, 13), (2, 5), (3, 20)])
def test_made_up_texts(spark, seed, length):
    rows = made_up(seed)
    assert cut(spark, rows, length) == brute(rows, length)


def test_small_chunks_and_copies_that_ask(spark, monkeypatch):
    """Answers come back to the chunk that asked, also where copies are too many to broadcast."""
    monkeypatch.setattr(S, "CHUNK", 3)
    monkeypatch.setattr(S, "BROADCAST_COPIES", 0)
    rows = made_up(4, vocabulary=4)
    assert cut(spark, rows) == brute(rows, 13)


def test_hot_passage_and_hot_copy(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"own{i} {passage} end{i}") for i in range(400)] + [(1000 + i, passage) for i in range(400)]
    assert cut(spark, rows) == brute(rows, 13)


def test_long_text_and_long_word(spark):
    long = " ".join(str(i) for i in range(200_000))
    rows = [(1, long), (2, "x " + long[1000:] + " y"), (3, "z" * 3_000_000), (4, "z" * 3_000_000)]
    assert [x[1:3] for x in cut(spark, rows)] == [x[1:3] for x in brute(rows, 13)]


def test_empty_table_and_extra_columns(spark):
    assert cut(spark, []) == []
    clash = spark.createDataFrame([(1, "a " * 20), (2, "a " * 20)], DOCS).withColumns(
        {"row": F.lit("x"), "kept": F.lit(1), "chunk": F.lit(None), "pack": F.lit(2)}
    )
    assert {(r.doc_id, r.n_removed) for r in S.drop_repeats(clash).collect()} == {(1, 0), (2, 20)}


def test_seed_longer_than_repeat(spark):
    with pytest.raises(ValueError):
        S.drop_repeats(spark.createDataFrame([], DOCS), 4)
