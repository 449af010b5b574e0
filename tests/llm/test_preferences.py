from pyspark.sql import functions as F

from demandlake.llm.preferences import mask_text, preference_pairs

SCHEMA = "pair_id long, chosen boolean, turn long, role string, text string"


def shown(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def brute(sides):
    key = lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or "")
    c, r = ([(x[1] or "", x[2] or "") for x in sorted(s, key=key)] for s in sides)
    n = 0
    while n < min(len(c), len(r)) and c[n] == r[n]:
        n += 1
    masks = []
    for rest in (c[n:], r[n:]):
        at, spans = 0, []
        for role, text in rest:
            end = at + len(shown([(role, text)]))
            if role == "assistant":
                spans.append(f"{at + 5 + len(role)}:{end}")
            at = end
        masks.append(",".join(spans))
    return (len(c), len(r), n, shown(c[:n]), shown(c[n:]), shown(r[n:]), *masks)


PAIRS = {
    1: ([(0, "user", "hi"), (1, "assistant", "yes"), (2, "user", "more"), (3, "assistant", "é🙂")], [(0, "user", "hi"), (1, "assistant", "yes"), (2, "user", "more"), (3, "assistant", "no")]),
    2: ([(0, "user", "a")], [(0, "user", "b")]),
    3: ([(0, "user", "same"), (1, "assistant", "same")], [(0, "user", "same"), (1, "assistant", "same")]),
    4: ([(0, "user", "p")], [(0, "user", "p"), (1, "assistant", "longer")]),
    5: ([(0, "user", "alone"), (1, "assistant", "x")], []),
    6: ([(None, None, None), (1, "assistant", "")], [(None, None, None), (1, "assistant", None)]),
    7: ([(0, "user", "b"), (0, "user", "a"), (1, "assistant", "t")], [(0, "user", "a"), (0, "user", "b"), (1, "assistant", "u")]),
    8: ([(0, "user", "twice"), (0, "user", "twice")], [(0, "user", "twice")]),
}


def test_equals_brute_force(spark):
    rows = [(p, side == 0, *t) for p, sides in PAIRS.items() for side in (0, 1) for t in sides[side]]
    rows += [(None, True, 0, "user", "stray"), (9, None, 0, "user", "stray")]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("c", "r", "t", "side", "n_common", "prompt")}).repartition(4)
    masks = {c: mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")}
    got = {r["pair_id"]: tuple(r)[1:] for r in preference_pairs(table).withColumns(masks).collect()}
    assert got == {p: brute(sides) for p, sides in PAIRS.items()}


def test_a_long_conversation_and_an_empty_table(spark):
    turns = [(1, s, i, "assistant" if i % 2 else "user", "word " * 500 + str(i if s or i < 900 else -i)) for s in (True, False) for i in range(1000)]
    r = preference_pairs(spark.createDataFrame(turns, SCHEMA)).first()
    assert r["n_common"] == 900 and len(r["chosen_mask"]) == 50
    assert preference_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
