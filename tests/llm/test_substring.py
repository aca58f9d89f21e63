import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import substring
from tidemark.llm.common import hash_words


def brute(rows: list[tuple]) -> dict:
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - 19):
            g = tuple(words[s : s + 20])
            if g in seen:
                gone.update(range(s, s + 20))
            seen.add(g)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def spliced(seed: int) -> list[tuple]:
    """Texts that share passages of 10 to 60 words, in themselves too, with runs of one word and of few words."""
    rng = random.Random(seed)
    pool = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(10, 60))] for _ in range(12)]
    pool += [["a"] * 45, ["a", "b"] * 25, ["x", "y", "z"] * 12, ["a"] * 19, ["a"] * 20]
    rows = []
    for doc in range(60):
        words = []
        for _ in range(rng.randrange(0, 8)):
            words += rng.choice(pool) if rng.random() < 0.6 else [f"v{rng.randrange(9999)}" for _ in range(rng.randrange(1, 40))]
        rows.append((doc, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed):
    rows = spliced(seed)
    got = substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute(rows)


def test_equal_windows_have_equal_anchors():
    rows = spliced(5)
    words, bounds = hash_words([t.encode() for _, t in rows])
    by_window: dict = {}
    for key, _, doc, at, n in zip(*substring.anchors(words, bounds)):
        for s in range(bounds[doc] + at, bounds[doc] + at + n):
            by_window.setdefault(words[s : s + 20].tobytes(), set()).add(key)
    assert sum(max(0, b - a - 19) for a, b in zip(bounds, bounds[1:])) >= len(by_window)
    assert all(len(keys) == 1 for keys in by_window.values())


def test_words_are_split_as_bytes_are():
    texts = [b"", b" a\tb\nc\x0bd\x0ce\rf ", "é\xa0x\x1fy".encode(), b"one"]
    words, bounds = hash_words(texts)
    assert np.diff(bounds).tolist() == [len(t.split()) for t in texts]
    assert words[bounds[3]] == hash_words([b"one"])[0][0]


def test_edges(spark, edges, nothing):
    rows = {(r["doc_id"], r["kept"]): r for r in substring.without_repeats(edges, with_text=True).collect()}
    texts = {r["doc_id"]: r["text"] for r in edges.collect()}
    removed = {d: r["n_removed"] for (d, _), r in rows.items()}
    assert removed[5] == 0 and removed[6] == 120 and removed[None] == 0 and removed[12] == 25 and removed[1] == removed[4] == 0
    assert (4, texts[4]) in rows
    assert substring.without_repeats(nothing).count() == 0


def test_words_that_a_polynomial_hash_confuses(spark):
    a = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    b = "".join("ba"[bin(k).count("1") % 2] for k in range(1024))
    words = [f"w{k}" for k in range(30)]
    rows = [(1, " ".join([*words[:15], a, *words[15:]])), (2, " ".join([*words[:15], b, *words[15:]]))]
    got = {r["doc_id"]: r["n_removed"] for r in substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0}
