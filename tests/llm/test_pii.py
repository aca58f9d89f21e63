import hashlib
import math
import random
import re
import time

import pytest
from samples import prose

from tidemark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def kept(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")), "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def base(text: str) -> list[tuple]:
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if kept(k, m[0])]


def texts() -> list[str | None]:
    rng = random.Random(5)
    out = [None, "", "a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8 256.1.1.1", "é😀 a@b.co 4512463504900732 4512 4635-0490 0732", "+1 (582) 555-6684", "1 " * 5000, "9" * 20_000, "a" * 20_000, "1.1.1.1 " * 800]
    return out + ["".join(rng.choice("ab1 9.@+-()_%5") for _ in range(rng.randint(1, 90))) for _ in range(400)]


def test_base_spans_equal_the_plain_patterns(spark, tmp_path):
    rows = list(enumerate(texts())) + [(None, "x@y.zz"), (3, texts()[3])]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, base int").write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.op3_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = dict(rows)
    for r in got:
        found = base(by_id[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == x[0] for x in found) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


@pytest.mark.parametrize("digits,valid", [("4512463504900732", luhn("4512463504900732")), ("0000000000000000", True), ("79927398713", True), ("79927398710", False)])
def test_luhn(spark, digits, valid):
    from pyspark.sql import functions as F

    assert spark.range(1).select(pii.passes_luhn(F.lit(digits))).first()[0] == valid


def found(spark, rows: list[tuple]) -> dict:
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.personal_data(docs).collect()}


def test_contexts_of_seeds_discover_other_identifiers(spark):
    rows = [(i, f"please write to user{i}@mail.example soon") for i in range(40)]
    rows += [(100, "please write to agent-7 soon"), (101, "there were agents 8 in all"), (102, "see room 12 there"), (103, "call (agent-7), please"), (104, "write to Ludmila soon. Ludmila waits"), (105, None)]
    spans = found(spark, rows)
    assert spans[100] == [("ctx", 16, 23)] and not spans[101] and not spans[102] and not spans[105]
    assert spans[103] == [("ctx", 6, 13)]  # a known value with a digit wherever it stands
    assert spans[104] == [("ctx", 9, 16)]  # a word without one only where its context tells
    assert all([s[0] for s in spans[i]] == ["email"] for i in range(40))


def test_identifiers_lead_to_patterns_and_these_to_more(spark):
    """Seeds tell `reach`, its instances tell `handle`, whose instances nothing but these tells."""
    rows = [(i, f"you reach user{i}@mail.example today") for i in range(30)]
    rows += [(100 + i, f"you reach name{i}x today or handle name{i}x here") for i in range(10)]
    rows += [(200 + i, f"use handle other{i} here") for i in range(4)] + [(300 + i, f"use anything word{i} there") for i in range(20)]
    spans = found(spark, rows)
    assert all([s[0] for s in spans[100 + i]] == ["ctx", "ctx"] for i in range(10))
    assert all(spans[200 + i] == [("ctx", 11, 17)] for i in range(4)) and not any(spans[300 + i] for i in range(20))


@pytest.mark.parametrize("words", [16, 1])
def test_recall_of_planted_contexts(spark, monkeypatch, words):
    """Identifiers of no known form, in the contexts of known ones, among prose: nearly all are found, and next to nothing else. With a sketch that is full, too."""
    monkeypatch.setattr(pii, "WORDS", words)
    monkeypatch.setattr(pii, "FULL", 64 * words * math.log(64 * words))
    rng, rows, planted, clean = random.Random(2), [], {}, []
    frames = ["my account {} please", "contact me as {} tonight", "badge no {} issued"]
    for d in range(400):
        words = prose(d, 40).split()
        at = rng.randrange(5, 35)
        if d < 200:
            value = f"u{d}@mail.example" if d < 150 else f"QX-{d * 7}"
            words[at:at] = rng.choice(frames).format(value).split()
            if d >= 150:
                planted[d] = value
        else:
            clean.append(d)
        rows.append((d, " ".join(words)))
    spans = found(spark, rows)
    texts = dict(rows)
    hits = [any(k == "ctx" and texts[d][a:b] == v for k, a, b in spans[d]) for d, v in planted.items()]
    assert sum(hits) >= 0.95 * len(hits) and not any(spans[d] for d in clean)
    assert not any(k == "ctx" and texts[d][a:b] != planted.get(d) for d in texts for k, a, b in spans[d])


def test_long_texts_take_time_in_proportion(spark):
    """100,000 words with digits, and 20,000 base spans."""
    text = " ".join(f"w{k} 1.2.3.{k % 250} x{k}" if k % 2 else f"w{k} y{k}z" for k in range(40_000))
    began = time.monotonic()
    spans = found(spark, [(1, text), (2, "short")])
    assert len(spans[1]) == 20_000 and spans[1][:2] == [("ip", text.index("1.2.3.1 "), text.index("1.2.3.1 ") + 7), ("ip", text.index("1.2.3.3 "), text.index("1.2.3.3 ") + 7)]
    assert time.monotonic() - began < 60


@pytest.mark.parametrize("bound", [0, pii.BROADCAST_KEYS])
def test_spans_touching_base_spans_are_left_out(spark, monkeypatch, bound):
    monkeypatch.setattr(pii, "BROADCAST_KEYS", bound)
    rows = [(i, f"please dial +1 (499) 555-{6500 + i} now") for i in range(12)] + [(50, "please dial 77-ab now"), (51, "please dial a77@b.co/77-ab now")]
    spans = found(spark, rows)
    assert spans[50] == [("ctx", 12, 17)] and [s[0] for s in spans[51]] == ["email"]
    assert all([s[0] for s in spans[i]] == ["phone"] for i in range(12))


def test_edges(spark, edges):
    rows = pii.personal_data(edges).collect()
    assert len(rows) == edges.count() and all(r["spans"] is not None for r in rows)


def test_no_rows(spark, nothing):
    assert pii.personal_data(nothing).count() == 0
