from pyspark.sql import functions as F

from tallyworks.llm import preference

TURNS = "conv_id long, turn long, role string, text string, conv string, chosen string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)


def plain(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    draw = lambda turns: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)
    def mask(turns):
        out = []
        for r, t in turns:
            head, tail = len(f"<|{r}|>\n"), len(f"{t}<|end|>\n")
            out += [head, tail] if r == "assistant" else [head + tail, 0]
        return out
    return n, draw(chosen[:n]), draw(chosen[n:]), mask(chosen[n:]), draw(rejected[n:]), mask(rejected[n:])


def test_pairs(spark):
    a = [("user", "hi"), ("assistant", "hello"), ("user", "why?"), ("assistant", "because")]
    cases = [
        (a, a[:3] + [("assistant", "no idea, éü")]), (a, a), (a, a[:2]), ([], a), ([], []),
        ([("assistant", "x")], [("user", "x")]), (a, a[:1] + [("assistant", "hello ")] + a[2:]), (a * 300, a * 299 + a[:3]),
    ]
    turn = "array<struct<role: string, text: string>>"
    df = spark.createDataFrame([(i, c, r, "kept") for i, (c, r) in enumerate(cases)], f"id int, chosen {turn}, rejected {turn}, _a string")
    rows = preference.preference_rows(df.withColumn("prompt", F.lit("clash"))).orderBy("id").collect()
    for row, (chosen, rejected) in zip(rows, cases):
        got = (row.prompt_turns, row.prompt, row.chosen, row.chosen_mask, row.rejected, row.rejected_mask)
        assert got == plain(chosen, rejected)
        assert sum(row.chosen_mask) == len(row.chosen) and sum(row.rejected_mask) == len(row.rejected) and row._a == "kept"


def test_swapped_replies(spark):
    rows = [
        (0, 1, "assistant", "a0"), (0, 0, "user", "u0"), (0, 2, "user", "after"),
        (1, 0, "user", "u1"), (1, 1, "assistant", "a1"), (1, 2, "user", "u2"), (1, 3, "assistant", "a2"),
        (2, 0, "user", "alone"), (3, 0, None, None), (3, 1, "assistant", ""), (4, 0, "user", "q"), (4, 1, "assistant", "no neighbour"),
        (6, 0, "user", "twice"), (6, 0, "user", "twice"), (6, 1, "assistant", "same"), (7, 0, "assistant", "same"), (None, 0, "assistant", "no id"),
    ]
    got = {r.conv: ([tuple(t) for t in r.chosen], [tuple(t) for t in r.rejected]) for r in preference.swapped_replies(table(spark, rows)).collect()}
    assert got[0] == ([("user", "u0"), ("assistant", "a0")], [("user", "u0"), ("assistant", "a2")])
    assert got[1][1][-1] == ("assistant", "a0") and len(got[1][0]) == 4
    assert got[2][0] == got[2][1] and got[4][0] == got[4][1] and got[3][0] == [("", ""), ("assistant", "")]
    assert got[6][0] == got[6][1] and len(got[6][0]) == 3 and got[None][0] == [("assistant", "no id")]


def test_empty_table(spark):
    assert preference.preference_rows(preference.swapped_replies(table(spark, []))).count() == 0
