import random

import pytest

from sendgate.llm.line_dedup import WHOLE, drop_recurring_lines

WORDS = ["the", "an", "on", "re", "ti", "ble", "ou", "st", "nd", "wh", "ea", "in", "or", "es"]


def line(draw, n=12):
    return " ".join("".join(draw.choices(WORDS, k=draw.randint(1, 3))) for _ in range(n))


def run(spark, texts, **options):
    df = spark.createDataFrame(
        [(i, text, "x", [9]) for i, text in enumerate(texts)],
        "doc_id long, text string, key string, Dropped array<int>",
    ).repartition(3)
    found = drop_recurring_lines(df, **options)
    assert found.columns == ["doc_id", "text", "key", "n_lines", "dropped"]
    rows = sorted(found.collect())
    for row, text in zip(rows, texts, strict=True):
        if text is None:
            assert (row.text, row.n_lines, row.dropped) == (None, None, [])
        else:
            lines = text.split("\n")
            assert row.n_lines == len(lines)
            assert row.text == "\n".join(l for i, l in enumerate(lines) if i not in row.dropped)
    return rows


def test_templates_with_variable_fields(spark):
    draw = random.Random(1)
    names = ["Ada", "Grace", "Alan", "Edsger", "Barbara", "Tony", "Donald", "John"]
    texts = [
        "\n".join(
            [line(draw), f"Posted on day {i} by {name} in the daily news section", line(draw)]
        )
        for i, name in enumerate(names)
    ]
    assert [row.dropped for row in run(spark, texts)] == [[1]] * len(names)


def test_passages_go_and_other_lines_stay(spark):
    draw = random.Random(2)
    passage = line(draw, 60)
    texts = [f"{line(draw)}\n{passage}\n{line(draw)}\n{line(draw)} " for _ in range(9)]
    texts += [f"{line(draw)}\n{line(draw)}" for _ in range(30)]
    texts += [f"short one\n{passage}"]  # most of this text, yet the passage is no part of copies
    rows = run(spark, texts)
    assert [row.dropped for row in rows[:9]] == [[1]] * 9
    assert all(row.dropped == [] for row in rows[9:39])
    assert rows[39].text == "short one"


def test_copies_keep_their_lines(spark):
    draw = random.Random(3)
    lines = [line(draw) for _ in range(12)]
    licence = "This work is licensed under version 3 of the licence"
    copies = []
    for i in range(20):
        copy = list(lines)
        copy[i % 12] = line(draw)
        copies.append("\n".join(copy + [licence] * (i % 3 == 0)))
    others = [f"{line(draw)}\n{line(draw)}\n{licence}" for _ in range(10)]
    rows = run(spark, copies + others + ["\n".join(lines)] * 7)
    assert all(row.text.count("\n") == 11 for row in rows[:20])
    assert all(licence not in row.text for row in rows)
    assert all(row.dropped == [] for row in rows[30:])


def test_repeats_inside_one_text_count_once(spark):
    draw = random.Random(4)
    again = line(draw)
    rows = run(spark, ["\n".join([again] * 50 + [line(draw)] * 3)] * 8 + [line(draw)] * 8)
    assert all(row.dropped == [] for row in rows)


def test_nulls_empty_and_long(spark):
    draw = random.Random(5)
    common = line(draw)
    texts = [None, "", "\n\n", "a\r", None, " \t ", line(draw, 30_000)]
    texts += [f"{line(draw, 20)}\r\n{common}\n" for _ in range(6)]
    rows = run(spark, texts)
    assert all(row.dropped == [] for row in rows[:7])
    assert all(row.dropped == [1] for row in rows[7:])
    assert run(spark, []) == []


@pytest.mark.parametrize("n", [1, 2])
def test_short_lines_stay(spark, n):
    texts = [f"{'The end'.split()[0] if n == 1 else 'The end'}\n{line(random.Random(i))}" for i in range(9)]
    assert all(row.dropped == [] for row in run(spark, texts))


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([("a b c",)], "text string")
    assert "Python" not in drop_recurring_lines(df)._jdf.queryExecution().toString()


def test_long_passages_that_few_texts_share(spark):
    draw = random.Random(6)
    texts, places = [], []
    for texts_with in (2, 3, 4):
        passage = line(draw, 60)
        for _ in range(texts_with):
            texts.append("\n".join([line(draw, 40), passage, line(draw, 40)]))
            places.append([1])
    short = line(draw, 49)
    texts += [f"{line(draw, 40)}\n{short}" for _ in range(4)]
    # A copy with a line changed is no other document: both keep what they share.
    copied = [line(draw, 60) for _ in range(9)]
    texts += ["\n".join(copied + [line(draw, 60)]) for _ in range(2)]
    places += [[]] * 6
    assert [row.dropped for row in run(spark, texts, tree=WHOLE)] == places
    assert all(row.dropped == [] for row in run(spark, texts))


def test_lines_of_digits_go(spark):
    draw = random.Random(7)
    phone = "Call 0171 555 0199 or 0171 555 0198 from 9 to 5"
    table = " ".join(f"{i} Team{i}" for i in range(30))
    texts = [f"{line(draw, 40)}\n{phone}\n{line(draw, 40)}\n{table}" for _ in range(5)]
    texts += [f"{line(draw, 40)}\n{phone.replace('9', str(i))}" for i in range(3)]  # other numbers
    rows = run(spark, texts, tree=WHOLE)
    assert [row.dropped for row in rows] == [[1, 3]] * 5 + [[]] * 3
    assert all(row.dropped == [] for row in run(spark, texts))


def test_short_lines_take_more_texts(spark):
    draw = random.Random(8)
    held = [("Read more", 8), ("Go on", 7), ("Share", 15), ("Top", 14)]
    texts = [f"{line(draw, 40)}\n\n{short}" for short, n in held for _ in range(n)]
    rows = run(spark, texts, tree=WHOLE)
    places = [[2] if short in ("Read more", "Share") else [] for short, n in held for _ in range(n)]
    assert [row.dropped for row in rows] == places


def test_blocks_that_come_together_go(spark):
    draw = random.Random(9)
    header, footer = line(draw, 60), line(draw, 60)
    pages = ["\n".join([header, line(draw, 40), footer]) for _ in range(12)]
    copied = [line(draw) for _ in range(12)]
    copies = ["\n".join([*copied[:i], line(draw), *copied[i + 1 :]]) for i in range(12)]
    rows = run(spark, pages + copies, tree=WHOLE)
    assert [row.dropped for row in rows] == [[0, 2]] * 12 + [[]] * 12
    assert all(row.dropped == [] for row in run(spark, pages))
