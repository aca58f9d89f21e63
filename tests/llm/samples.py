"""Rows that the tests of several operators use."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class string, band long, spans string, gone string, key string, n_removed string, score string"
WORDS = "time year people way day man thing woman life child world school state family student group country problem hand part place case week company system program question work government number night point home water room mother area money story fact month lot right study book eye job word business issue side kind head house service friend father power hour game line end member law car city community name".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(3)).replace("0", "").replace("1", "s").replace("2", "ed") for _ in range(n))


#: Nulls in any column, empty, blank and very long texts, copies, near copies, repeated rows, and characters beyond the BMP.
def edge_rows() -> list[tuple]:
    long = prose(1, 30_000)
    base = prose(2, 120)
    near = base.split()
    near[60] = "changed"
    texts = {
        1: None, 2: "", 3: " \n\t ", 4: long, 5: base, 6: base, 7: " ".join(near), 8: "a", 9: "a a a a a a a a a a a a " * 30, 10: "é😀 𝒳 " + prose(3, 40),
        11: prose(4, 25) + "\n" + prose(5, 25) + "\n" + prose(6, 25), 12: prose(7, 25) + "\n" + prose(5, 25) + "\n" + prose(8, 25),
    }
    rows = [(i, t, "en" if i % 2 else None, "s", None if t is None else len(t), "x", 1, "y", "z", "k", "n", "q") for i, t in texts.items()]
    rows.append((5, base, "en", "s", len(base), None, None, None, None, None, None, None))
    rows.append((None, base, None, None, None, None, None, None, None, None, None, None))
    return rows
