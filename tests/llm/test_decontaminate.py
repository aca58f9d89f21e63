import random

import pytest
from samples import prose
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as dec

ITEM = "How many red apples did Tom Smith buy on the market for 12.5 euros after he walked 3 km? Later Tom paid 12.5 more."


def found(spark, texts: dict, items: dict) -> dict:
    docs = spark.createDataFrame([(d, t, 1) for d, t in texts.items()], "doc_id long, text string, hash int")
    rows = dec.contaminated(docs, spark.createDataFrame([(i, t, 2) for i, t in items.items()], "item_id long, text string, place int")).collect()
    return {(r["doc_id"], r["item_id"]): r for r in rows}


def test_template(spark):
    docs = spark.createDataFrame([(1, "It cost Anna SS 1,000.50 kg, or 7km. NOT so; 3 + x 4*(5) Tag 2 Tage don't")], "doc_id long, text string")
    held = {(r["place"], r["kind"], r["value"]) for r in dec.slots(docs, "doc_id").collect()}
    tokens = ["It", "cost", "Anna", "SS", "1,000.50", "kg", "or", "7", "km", "NOT", "so", "3", "x", "4", "*", "5", "Tag", "2", "Tage", "don't"]
    assert docs.select(dec.tokens(F.col("text")).alias("t")).first()["t"] == tokens
    names, numbers, units = {0: "it", 2: "anna", 16: "tag", 18: "tage"}, {4: "1,000.50", 7: "7", 11: "3", 13: "4", 15: "5", 17: "2"}, {5: "kg", 8: "km"}
    assert held == {(p, k, v) for k, own in ((dec.NAME, names), (dec.NUMBER, numbers), (dec.UNIT, units)) for p, v in own.items()}


STORY = "Alice has 3 apples. Bob has 4 pears. Carol takes 2 plums. How many do Alice and Bob have?"


def test_names_wherever_they_stand(spark):
    plain = STORY.replace("Alice", "Peter").replace("Bob", "Quentin").replace("Carol", "Rose").replace("3", "7").replace("4", "9")
    texts = {1: f"{prose(1, 30)} {plain} {prose(2, 30)}", 2: plain, 3: f"see\n{plain}", 4: f'in 12 {plain}', 5: f'"{plain}"', 6: f"({plain})", 7: plain.replace(". ", ".\n")}
    assert set(found(spark, texts, {1: STORY})) == {(d, 1) for d in texts}


def test_slots_are_one_to_one_but_for_numbers(spark):
    two_as_one = STORY.replace("Alice", "Peter").replace("Bob", "Peter").replace("3", "8")
    one_as_two = STORY.replace("Alice", "Peter", 1).replace("Alice", "Paul").replace("3", "8")
    same_numbers = STORY.replace("Alice", "Peter").replace("3", "5").replace("4", "5")
    assert set(found(spark, {1: two_as_one, 2: one_as_two, 3: same_numbers}, {1: STORY})) == {(3, 1)}


def test_copies_in_other_case(spark):
    assert set(found(spark, {1: STORY.upper(), 2: f"{prose(1, 9)} {STORY.lower()}", 3: STORY.title()}, {1: STORY})) == {(1, 1), (2, 1), (3, 1)}


def test_variants_equal_their_construction(spark):
    """Items with names and numbers, put into documents with their slots replaced: consistently, or one place apart."""
    rng = random.Random(8)
    people = [a + b for a in ("Al", "Ber", "Cor", "Dan", "Eli", "Fin") for b in ("na", "to", "ria", "mund", "sa")]
    items, texts, expected = {}, {}, set()
    for i in range(20):
        own, filler = rng.sample(people, 3), prose(3000 + i, 24).split()
        shape = [f"{{{rng.randrange(3)}}}" if k % 6 == 0 else f"[{rng.randrange(2)}]" if k % 7 == 3 else filler[k] for k in range(24)]
        fill = lambda names, numbers, shape=shape: " ".join(names[int(x[1])] if x[0] == "{" else str(numbers[int(x[1])]) if x[0] == "[" else x for x in shape)
        numbers = rng.sample(range(10, 99), 2)
        items[i] = fill(own, numbers)
        others, more = rng.sample([p for p in people if p not in own], 3), rng.sample(range(100, 999), 2)
        texts[3 * i] = f"{prose(i, 30)}. {fill(others, more)}. {prose(i + 50, 30)}"
        expected.add((3 * i, i))
        # the second place of a name that comes twice gets a name of its own
        words = fill(others, more).split()
        places = [[k for k, x in enumerate(shape) if x == f"{{{j}}}"] for j in range(3)]
        twice = next(p for p in places if len(p) > 1)
        words[twice[-1]] = "Zoran"
        texts[3 * i + 1] = f"{prose(i, 30)}. {' '.join(words)}. {prose(i + 50, 30)}"
        texts[3 * i + 2] = prose(7000 + i, 80)
    assert set(found(spark, texts, items)) == expected


def test_other_values_are_caught_if_consistent(spark):
    other = ITEM.replace("12.5", "88").replace("3 km", "9 miles").replace("Tom", "Bob").replace("Smith", "Jones")
    mixed = other.replace("paid 88", "paid 87")
    texts = {1: f"{prose(1, 50)} {ITEM} {prose(2, 50)}", 2: f"{prose(3, 9)}. {other} {prose(4, 9)}", 3: f"{prose(3, 9)}. {mixed} {prose(4, 9)}", 4: prose(5, 400), 5: ITEM.upper(), 6: ITEM[:40]}
    got = found(spark, texts, {7: ITEM, 8: prose(99, 40)})
    assert set(got) == {(1, 7), (2, 7), (5, 7)}
    assert got[2, 7]["n_slots"] >= 6


def test_passages_equal_brute_force(spark):
    rng = random.Random(0)
    items = {i: prose(1000 + i, rng.randrange(5, 40)) for i in range(15)}
    texts, expected = {}, set()
    for d in range(60):
        parts = [prose(d, 60)]
        for i in rng.sample(sorted(items), rng.randrange(3)):
            parts += [items[i].upper() if rng.random() < 0.2 else items[i], prose(500 + d, 20)]
            expected.add((d, i))
        texts[d] = ". ".join(parts)
    assert set(found(spark, texts, items)) == expected


@pytest.mark.parametrize("bound", [0, dec.BROADCAST_WINDOWS])
def test_edges(spark, edges, nothing, monkeypatch, bound):
    monkeypatch.setattr(dec, "BROADCAST_WINDOWS", bound)
    items = [(1, prose(2, 120)), (1, prose(2, 120)), (2, None), (None, "a b"), (3, ""), (4, "a"), (5, "1 2 3 4 5 6 7 8 9"), (6, prose(7, 25))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = {(r["doc_id"], r["item_id"]) for r in dec.contaminated(edges, benchmark).collect()}
    assert rows >= {(5, 1), (6, 1), (7, 1), (12, 6)} and not rows & {(4, 1), (11, 6), (10, 1)}
    assert dec.contaminated(nothing, benchmark).count() == 0
    assert dec.contaminated(edges, benchmark.limit(0)).count() == 0


def test_each_alignment_is_judged_alone(spark):
    other = ITEM.replace("12.5", "88").replace("3 km", "9 miles").replace("Tom", "Bob").replace("Smith", "Jones")
    third = ITEM.replace("12.5", "41").replace("Tom", "Jim")
    cut_in = f"{ITEM[:60]} and some apples more {ITEM[60:]}"
    mixed = other.replace("paid 88", "paid 87")
    chance = "the market for 99 euros after he walked 5 miles"
    texts = {
        1: f"{ITEM} {prose(1, 30)} {other}", 2: f"{other} {prose(2, 30)} {third}", 3: f"{prose(3, 300)} {ITEM} {prose(4, 300)} on {chance} {prose(5, 40)}",
        4: f"{ITEM} {other}", 5: f"{mixed} {prose(6, 30)} {mixed}", 6: f"{cut_in} {prose(7, 40)} {cut_in.replace('12.5', '7')}",
    }
    got = found(spark, texts, {7: ITEM})
    assert set(got) == {(d, 7) for d in (1, 2, 3, 4, 6)}
    assert all(r["n_slot_conflicts"] == 0 and 2 * r["n_matched"] >= r["n_windows"] for r in got.values())


def test_items_of_numbers_are_looked_for(spark):
    items = {1: "What is 3 + 4 * 5 - 6 / 7?", 2: "1, 2, 3, 5, 8, 13, 21, 34, 55, 89", 3: "12 13"}
    texts = {1: f"{prose(1, 30)} WHAT is 3 + 4 * 5 - 6 / 7? {prose(2, 30)}", 2: f"so {items[2]}", 3: "What is 3 - 4 * 5 + 6 / 7?", 4: "it is 12 13 or 13 12"}
    assert set(found(spark, texts, items)) == {(1, 1), (2, 2), (4, 3)}
    assert set(found(spark, texts, items | {4: prose(1, 30)})) == {(1, 1), (2, 2), (4, 3), (1, 4)}
