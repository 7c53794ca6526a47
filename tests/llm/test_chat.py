"""Chat windows: everything comes back from the output, windows stay near their budget, repeats are masked."""

import random
import re

from palaver.llm.op9_chat import END, TEXT, TOKEN, TURN, read_back, windows

PARTS = ["</s>", "[INST]", "<|end|>", "<|turn|>", "\\", "<", "[", "<\\", "word ", "é", "\n", "<|text|>user"]


def fixture():
    r = random.Random(4)
    rows = []
    for conv in range(30):
        roles = (["system"] if conv % 3 == 0 else []) + ["user", "assistant"] * r.randint(1, 12)
        rows += [(conv, i, role, "".join(r.choice(PARTS) for _ in range(r.choice([0, 3, 30])))) for i, role in enumerate(roles)]
    rows += [(40, i, "assistant", "x") for i in range(700)] + [(41, 0, "user", "long " * 5000), (41, 1, "assistant", "ok")]
    return rows + [(42, None, None, None), (42, 1, "assistant", None), (None, 1, "user", "hi"), (43, 1, "user", "a"), (43, 1, "user", "a")]


def test_turns_and_targets_come_back(spark):
    rows = fixture()
    table = spark.createDataFrame([(*x, 1, "p") for x in rows], "conv_id bigint, turn bigint, role string, text string, window int, place string")
    made = windows(table.repartition(4), span=60, history=25)
    turns, targets = {}, {}
    for row in sorted(read_back(made).collect(), key=lambda x: x.window):
        turns.setdefault(row.conv_id, []).extend((t.role, t.text) for t in row.turns)
        targets.setdefault(row.conv_id, []).extend(row.targets)
    expected = {}
    for conv, turn, role, text in sorted(rows, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0)):
        expected.setdefault(conv, []).append((role or "", text or ""))
    assert turns == expected
    assert targets == {c: [t for role, t in x if role == "assistant"] for c, x in expected.items()}


def test_windows_keep_the_system_turn_and_limited_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, ["assistant", "user"][i % 2], f"w{i} w w w") for i in range(1, 60)]
    made = sorted(windows(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), span=60, history=25).collect(), key=lambda x: x.window)
    assert len(made) > 4
    for number, row in enumerate(made):
        pieces = [x for x in row.formatted.split(END) if x]
        assert pieces[0] == f"{TURN}system{TEXT}be kind"
        tokens = [len(re.findall(r"[^\W_]+|[^\w\s]|_", x.split(TEXT)[1])) + 3 for x in pieces]
        assert sum(tokens[row.n_repeated :]) < 60 + max(tokens)
        if number:
            assert row.n_repeated >= 2 and sum(tokens[1 : row.n_repeated]) <= 25
            before = [x for x in made[number - 1].formatted.split(END) if x]
            assert pieces[1 : row.n_repeated] == before[len(before) - row.n_repeated + 1 :]
    assert windows(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).collect() == []
    assert TOKEN
