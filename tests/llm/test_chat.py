import random

import pytest

from basketry.llm.chat import Budget, budgeted_windows, read_loss, read_turns

SCHEMA = "conv_id long, turn long, role string, text string"


def windows(spark, rows, budget):
    found = budgeted_windows(spark.createDataFrame(rows, SCHEMA), budget)
    return (
        found.select("*", read_turns(found["formatted"]).alias("turns"),
                     read_loss(found["formatted"], found["loss_spans"]).alias("loss"))
        .orderBy("conv_id", "window").collect()
    )


def conversations(count):
    pick = random.Random(3)
    odd = ["</s>[INST] ok [/INST]", "<|end|>", "<\\", "<", "\\", "<|sep|>a<|start|>", "", "é\n\n", "<|end|>\\<"]
    rows = []
    for conv in range(count):
        turns = pick.randint(1, 700 if conv == 0 else 30)
        for turn in range(turns):
            role = "system" if turn == 0 and conv % 2 else ("user", "assistant")[turn % 2]
            text = "".join(pick.choice([*odd, "word " * pick.randint(1, 40)]) for _ in range(pick.randint(0, 3)))
            rows.append((conv, turn, role, text))
    return rows


def tokens(text):
    return -(-len(text.encode()) // 4) + 4


@pytest.mark.parametrize("budget", [Budget(), Budget(60, 20), Budget(200, 0)])
def test_every_turn_comes_back_and_each_answer_is_learnt_once(spark, budget):
    rows = conversations(8)
    found = windows(spark, rows, budget)
    for conv in range(8):
        given = [(r, t) for c, _, r, t in rows if c == conv]
        own = [w for w in found if w["conv_id"] == conv]
        read = [(t["role"], t["text"]) for w in own for t in w["turns"][w["n_context"] :]]
        assert read == given
        assert "".join(w["loss"] for w in own) == "".join(t for r, t in given if r == "assistant")


def test_budgets_hold(spark):
    rows, budget = conversations(8), Budget(120, 40)
    for w in windows(spark, rows, budget):
        system = rows[[r[0] for r in rows].index(w["conv_id"])][2] == "system"
        turns = [(t["role"], t["text"]) for t in w["turns"]]
        assert w["tokens"] == sum(tokens(t) for _, t in turns)
        if system:
            assert turns[0][0] == "system"
        repeated = turns[system : w["n_context"]]
        assert sum(tokens(t) for _, t in repeated) <= budget.history
        if len(turns) - w["n_context"] > 1 and not system:
            assert w["tokens"] <= budget.tokens


def test_turns_out_of_order_and_unknown_values(spark):
    rows = [(1, None, None, None), (1, 3, "assistant", "b"), (1, 2, "user", "a"), (None, 0, "system", "s")]
    found = windows(spark, rows, Budget())
    assert [[(t["role"], t["text"]) for t in w["turns"]] for w in found] == [
        [("system", "s")],
        [("", ""), ("user", "a"), ("assistant", "b")],
    ]
    assert found[1]["loss"] == "b"


def test_history_must_leave_room(spark):
    with pytest.raises(ValueError):
        windows(spark, [(1, 0, "user", "a")], Budget(10, 10))
