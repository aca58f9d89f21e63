import random

import pytest

from tidemark.llm import lines


def test_patience_aligns_equal_lines_in_order():
    rng = random.Random(0)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randrange(15))]
        b = [rng.randrange(12) for _ in range(rng.randrange(15))]
        pairs = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert lines.patience([1, 2, 3, 4], [9, 1, 2, 8, 4]) == [(0, 1), (1, 2), (3, 4)]
    assert lines.patience([1, 1, 2], [1, 1, 2]) == [(0, 0), (1, 1), (2, 2)]


def test_short_blocks_stay():
    later = [(0, 1, 10), (1, 2, 10)]
    assert lines.common_blocks([1, 2], later, [], least=21) == set()
    assert lines.common_blocks([1, 2], [(0, 1, 10), (1, 2, 11)], [(0, 1)], least=21) == {0, 1}


def test_blocks_in_another_order_are_found():
    later = [(k, h, 40) for k, h in enumerate([3, 4, 1, 2])]
    assert lines.common_blocks([1, 2, 9, 3, 4], later, [(k, k) for k in range(4)]) == {0, 1, 2, 3}


def test_runs_are_the_shortest():
    assert lines.runs_of([40, 1, 31, 2], 32) == [(0, 0), (0, 1), (1, 2), (2, 3)]
    assert lines.runs_of([5, 5], 32) == [] and lines.runs_of([], 32) == []


def brute(rows: list[tuple], least: int = lines.MIN_CHARS) -> dict:
    """Every document against every earlier one: all their common runs of lines, however short the lines are."""
    docs = {d: (t.split("\n"), [k for k, x in enumerate(t.split("\n")) if x.strip(" \t\n\x0b\x0c\r")]) for d, t in rows if d is not None and t is not None}
    out = {}
    for d, (own, places) in docs.items():
        gone = set()
        mine = [own[k] for k in places]
        for e, (other, there) in docs.items():
            theirs = [other[k] for k in there]
            for i in range(len(mine)) if e < d else []:
                for j in range(len(theirs)):
                    n = 0
                    while i + n < len(mine) and j + n < len(theirs) and mine[i + n] == theirs[j + n]:
                        n += 1
                    if sum(map(len, mine[i : i + n])) >= least:
                        gone.update(places[i : i + n])
        out[d] = "\n".join(x for k, x in enumerate(own) if k not in gone)
    return out


def deduped(spark, rows: list[tuple]) -> dict:
    got = lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    return {r["doc_id"]: r["text"] for r in got}


@pytest.mark.parametrize("seed", [3, 4])
def test_equals_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(lines, "PAIRS", 3)
    rng = random.Random(seed)
    pool = [f"a line that many documents have, number {i}" for i in range(8)] + ["short", "tiny one", "verse of song", "and another é", "fifteen letters", "", " "]
    rows = [(d, "\n".join(rng.choice(pool) if rng.random() < 0.8 else f"own {rng.randrange(10**6)}" for _ in range(rng.randrange(0, 14)))) for d in range(80)]
    assert deduped(spark, rows) == brute(rows)


def test_an_earlier_holder_of_the_lines_does_not_hide_a_block(spark):
    block = ["short line of verse", "and the next of it", "and its end"]
    rows = [(1, "\n".join([block[0], "x" * 40, block[1], "y" * 40, block[2]])), (2, "\n".join(["of the second"] + block)), (3, "\n".join(["of the third"] + block))]
    assert deduped(spark, rows)[3] == "of the third" and deduped(spark, rows[1:])[3] == "of the third"


def test_a_line_of_every_document_goes_from_all_but_the_first(spark):
    line = "a license line that stands in each and every document"
    rows = [(d, f"own text {d}\n{line}") for d in range(60)]
    assert deduped(spark, rows) == {d: f"own text {d}" + (f"\n{line}" if d == 0 else "") for d in range(60)}


def test_rows_of_one_doc_id_with_several_texts(spark):
    a, b = "a" * 40, "b" * 40
    got = lines.without_repeated_lines(spark.createDataFrame([(1, a), (2, f"{b}\nz"), (2, f"{a}\nz")], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, a), (2, f"{b}\nz"), (2, "z")] or sorted((r["doc_id"], r["text"]) for r in got)[1:] == [(2, f"{b}\nz"), (2, "z")]


def test_long_documents(spark):
    """Time is in proportion: 100,000 lines, all of them repeated."""
    text = "\n".join(f"line number {k} of a very long document" for k in range(100_000))
    got = deduped(spark, [(1, text), (2, text + "\nend")])
    assert got == {1: text, 2: "end"}


def test_edges(spark, edges, nothing):
    got = lines.without_repeated_lines(edges)
    assert set(got.columns) == {*edges.columns, "n_lines"} and got.schema["n_removed"].dataType.simpleString() == "bigint"
    rows = {(r["doc_id"], r["source"]): r for r in got.collect()}
    assert len(rows) == 13 and rows[1, "s"]["text"] is None and rows[6, "s"]["text"] == "" and rows[5, "s"]["n_removed"] == 0
    assert rows[12, "s"]["n_removed"] == 1 and rows[None, None]["n_removed"] == 0 and rows[12, "s"]["gone"] == "z"
    assert lines.without_repeated_lines(nothing).count() == 0
